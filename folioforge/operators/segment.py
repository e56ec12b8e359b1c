"""Segmentation of record bodies: lines, blocks with kinds and markers, structure, carried context, furniture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators.refs import NUMBER

#: The words of the structure, from the highest level. Fixed values.
LEVELS = ("Libro", "Título", "Capítulo", "Sección")

KINDS = (
    ("breadcrumb", r"^> "),
    ("heading", r"^# "),
    ("fraccion", r"^[IVXLCDM]+\.-? "),
    ("numeral", r"^[0-9]+\.-? "),
    ("inciso", r"^[a-zA-Z](?:\)|\.-?) "),
    ("annotation", r"^(?:Artículo|Artic[uú]lo|Párrafo|Fracción|Inciso|Numeral|Apartado|Capítulo|Sección|Epígrafe|Denominación) [^.]*DOF [0-9]"),
    ("structure", r"^(?:Libro|Título|Capítulo|Sección|LIBRO|TÍTULO|CAPÍTULO|SECCIÓN) [^ ]+( [^ ]+)?$"),
    ("mark", r"^(?:\([0-9]{1,3}\) ?)+$"),
)


#: Headings of a raw text: an article's, that of the transitory part, and a transitory provision's. Whole lines or line heads.
ARTICLE_HEAD = rf"(?im)^(?:# )?art[ií]culo ({NUMBER}) ?(?:\.-|[.\-–]|$)"
TRANSITORY_PART = r"(?im)^(?:# )?(?:(?:art[ií]culos|disposiciones) )?transitori[oa]s?:?[ \t]*$"
TRANSITORY_HEAD = r"(?im)^(?:# )?(?:art[ií]culo )?((?:(?:d[eé]cim|vig[eé]sim|trig[eé]sim|cuadrag[eé]sim|quincuag[eé]sim)[oa] ?)?(?:primer|segund|tercer|cuart|quint|sext|s[eé]ptim|octav|noven)[oa]|(?:d[eé]cim|vig[eé]sim|trig[eé]sim|cuadrag[eé]sim|quincuag[eé]sim)[oa]|[uú]nico|[0-9]+[oa°º]?) ?(?:\.-|[.\-–]|$)"
#: Lines that a page leaves in a text: page numbers, running heads, dates of the last reform. Whole lines.
FURNITURE = r"(?im)^[ \t=\-–—]*(?:(?:fin de )?p[aá]g(?:ina|\.)? ?[0-9]+(?: de [0-9]+)?|page ?[0-9]+(?: (?:of|sur|de) [0-9]+)?|[0-9]+ (?:de|of|sur|/) [0-9]+|[0-9]{1,4}|c[aá]mara de diputados.*|[uú]ltima reforma.*dof.*)[ \t=\-–—\r]*$\n?"


def split_provisions(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos from 1, provision_type, number, body) of a raw text: one row an article, then one a transitory provision.

    An article begins at a line `Artículo N`, bare or followed by a stop or a dash. Behind a line `Transitorios`, ordinal
    words or digits begin transitory provisions, and article headings none. What stands before the first heading belongs
    to no provision. Null texts and texts without headings give no row. A narrow pass: each text is cut where it stands.
    """
    t = F.regexp_replace(F.translate(text_col, "\x01\x02", ""), "\r\n?", "\n")
    halves = F.split(F.regexp_replace(t, "(?du)" + TRANSITORY_PART, "\x02"), "\x02")
    late = F.array_join(F.slice("halves", 2, 1 << 30), "\n")

    def cut(text: Column, head: str, kind: str) -> Column:
        parts = F.slice(F.split(F.regexp_replace(text, "(?du)" + head, "\x01$1\x02"), "\x01"), 2, 1 << 30)
        return F.transform(parts, lambda x: F.struct(F.lit(kind).alias("provision_type"), F.trim(F.substring_index(x, "\x02", 1)).alias("number"), F.btrim(F.substring_index(x, "\x02", -1), F.lit(" \t\n")).alias("body")))

    # each text is cut in two once; most have no transitory part
    rows = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), halves.alias("halves"))
    articles, transitory = cut(F.col("halves")[0], ARTICLE_HEAD, "article"), cut(late, TRANSITORY_HEAD, "transitory")
    rows = rows.select("id", F.posexplode(F.when(F.size("halves") > 1, F.concat(articles, transitory)).otherwise(articles)).alias("p", "x"))
    return rows.select(F.col("id").alias(id_col), (F.col("p") + 1).alias("pos"), "x.provision_type", "x.number", "x.body")


def sql_split_provisions(key: str, text: str, table: str) -> str:
    """The same as a query; headings of transitory provisions are those behind the first line of the transitory part."""
    cut = lambda t, head, kind: f"list_transform(string_split(regexp_replace({t}, '{head}', chr(1) || '\\1' || chr(2), 'g'), chr(1))[2:], lambda x: {{provision_type: '{kind}', number: trim(split_part(x, chr(2), 1)), body: trim(split_part(x, chr(2), 2), ' ' || chr(9) || chr(10))}})"
    return f"""(with h as (select {key}, string_split(regexp_replace(regexp_replace({text}, '\\r\\n?', chr(10), 'g'), '{TRANSITORY_PART}', chr(2), 'g'), chr(2)) as h from {table} where {text} is not null),
      x as (select {key}, list_concat({cut('h[1]', ARTICLE_HEAD, 'article')}, {cut("array_to_string(h[2:], chr(10))", TRANSITORY_HEAD, 'transitory')}) as x from h),
      r as (select {key}, generate_subscripts(x, 1) as pos, unnest(x) as x from x)
      select {key}, pos, x.provision_type as provision_type, x.number as number, x.body as body from r)"""


def strip_furniture(text: Column) -> Column:
    """The text without the lines that pages leave in it."""
    return F.regexp_replace(text, "(?du)" + FURNITURE, "")


def lines_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, line_no from 1, line): every line of every non-null text; an empty text is one empty line."""
    return df.where(F.col(text_col).isNotNull()).select(id_col, F.posexplode(F.split(text_col, "\n")).alias("p", "line")).select(id_col, (F.col("p") + 1).alias("line_no"), "line")


def block_kind(line: Column) -> Column:
    out = F.lit("paragraph")
    for name, pattern in reversed(KINDS):
        out = F.when(line.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def block_marker(line: Column) -> Column:
    """The marker that opens a list item, without its marks; null for other blocks."""
    return F.nullif(F.regexp_extract(line, r"^([IVXLCDM]+|[0-9]+|[a-zA-Z])(?:\.-|\.|\)) ", 1), F.lit(""))


def blocks_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos from 1, kind, marker, text): the non-blank lines as blocks, numbered without the blank ones."""
    kept = F.filter(F.transform(F.split(text_col, "\n"), lambda x: F.rtrim(x)), lambda x: x != "")
    rows = df.where(F.col(text_col).isNotNull()).select(id_col, F.posexplode(kept).alias("p", "text"))
    return rows.select(id_col, (F.col("p") + 1).alias("pos"), block_kind(F.col("text")).alias("kind"), block_marker(F.col("text")).alias("marker"), "text")


def breadcrumb(text: Column) -> Column:
    """array<struct<level, label>> of the breadcrumb line, deepest two levels, level words in title case; empty if none."""
    line = F.regexp_extract(text, r"(?m)^> (.*)$", 1)
    parts = F.filter(F.split(line, " · "), lambda x: x != "")
    pairs = F.transform(parts, lambda x: F.struct(F.initcap(F.substring_index(x, " ", 1)).alias("level"), F.substr(x, F.length(F.substring_index(x, " ", 1)) + 2).alias("label")))
    return F.slice(pairs, F.greatest(F.size(pairs) - 1, F.lit(1)), 2)


def reflow(text: Column) -> Column:
    """Hard-wrapped lines joined by a space; blank lines and indented ones stay; a break after a hyphen is not closed."""
    unified = F.regexp_replace(text, "\r\n?", "\n")
    return F.regexp_replace(unified, r"([^\n])\n(?=[^ \t\n\r\f])", "$1 ")


def split_run_on(text: Column) -> Column:
    """Items that were left in one line, cut before `; y II. ` and `; II. `."""
    return F.split(text, r"(?<=;)\s+(?:y )?(?=[IVXLC]+\. )")


def amendment_marks(text: Column) -> Column:
    """Numbers of leading footnote marks `(36)`, `(19)(20)`; null if there are none."""
    lead = F.regexp_extract(text, r"^((?:\([0-9]{1,3}\) ?)+)", 1)
    marks = F.transform(F.regexp_extract_all(lead, F.lit(r"\(([0-9]{1,3})\)"), F.lit(1)), lambda x: x.cast("int"))
    return F.when(F.size(marks) > 0, marks)


def carried_context(lines: DataFrame, id_col: str, order_col: str = "line_no", line_col: str = "line") -> DataFrame:
    """Adds a column for each level: the last label seen above, reset by a change of a higher level.

    The window runs within one document, whose lines are bounded by one text.
    """
    above = Window.partitionBy(id_col).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    label = {w: F.when(F.lower(F.substring_index(line_col, " ", 1)) == w.lower(), F.substr(line_col, F.lit(len(w) + 2))) for w in LEVELS}
    out = lines
    for i, w in enumerate(LEVELS):
        changed = F.coalesce(*[F.when(label[h].isNotNull(), F.col(order_col)) for h in LEVELS[:i]], F.lit(None).cast("int")) if i else None
        own = F.last(F.when(label[w].isNotNull(), F.struct(F.col(order_col).alias("o"), label[w].alias("l"))), True).over(above)
        if changed is None:
            out = out.withColumn(w, own["l"])
        else:
            higher = F.last(changed, True).over(above)
            out = out.withColumn(w, F.when(own["o"] > F.coalesce(higher, F.lit(0)), own["l"]))
    return out


def strip_markup(text: Column) -> Column:
    """Text of a page: scripts, styles and tags removed, common entities resolved, white space runs as one space."""
    t = F.regexp_replace(text, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, "[ \t\r\n]+", " "))
