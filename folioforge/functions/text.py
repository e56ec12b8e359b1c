"""Column functions of the identity rules: folding, slugs, number keys, URNs, file names, aliases, ordinals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented letters and what they fold to, one to one; degree signs of ordinals fold to `o`, feminine ones to `a`.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ°ºª"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyAAAAAAEEEEIIIIOOOOOUUUUNCYooa"

#: Masculine ordinal words of transitory provisions; feminine forms end in `a`. Fixed values.
UNITS = "primero segundo tercero cuarto quinto sexto septimo octavo noveno".split()
TENS = {"decimo": 10, "vigesimo": 20, "trigesimo": 30, "cuadragesimo": 40, "quincuagesimo": 50}
#: Suffixes of inserted articles, in order. Fixed values.
SUFFIXES = "bis ter quater quinquies quintus sexies septies octies nonies decies".split()


def fold(c: Column) -> Column:
    """Lower case without accents."""
    return F.lower(F.translate(c, ACCENTED, PLAIN))


def slug(c: Column) -> Column:
    """Folded, each run of other characters than a-z and 0-9 as one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-|-$", "")


def number_key(number: Column, kind: Column) -> Column:
    """Key of a provision number: articles lose an ordinal `o` behind the digits, transitories keep it."""
    article = F.regexp_replace(slug(number), "^([0-9]+)[oa](-|$)", "$1$2")
    return F.when(kind == "article", article).otherwise(slug(number))


def urn(instrument_id: Column, kind: Column, number: Column) -> Column:
    return F.concat_ws(":", instrument_id, kind, number_key(number, kind))


def file_name(number: Column, kind: Column) -> Column:
    """`articulo-` and the number with hyphens for spaces, or `transitorio-` and the folded number."""
    return F.when(kind == "article", F.concat(F.lit("articulo-"), F.regexp_replace(number, " +", "-"))).otherwise(F.concat(F.lit("transitorio-"), slug(number)))


def alias(abbrev: Column, kind: Column, number: Column) -> Column:
    return F.array(F.concat(abbrev, F.lit(" — "), F.when(kind == "article", F.lit("Artículo ")).otherwise(F.lit("")), number))


def article_parts(number: Column) -> Column:
    """(base int, letter, suffix, sub) of an article number such as `172 Bis 5`, `195-L-4`, `1o. Bis`, `53-G`."""
    n = fold(number)
    base = F.regexp_extract(n, "^([0-9]+)", 1)
    names = "|".join(SUFFIXES)
    none = lambda c: F.nullif(c, F.lit(""))
    return F.struct(
        none(base).cast("int").alias("base"),
        none(F.regexp_extract(n, "^[0-9]+o?[.]?-([a-z])(?:-|$)", 1)).alias("letter"),
        none(F.regexp_extract(n, rf"(?:^|[^a-z])({names})(?:[^a-z]|$)", 1)).alias("suffix"),
        none(F.regexp_extract(n, "[a-z][ -]([0-9]+)$", 1)).cast("int").alias("sub"),
    )


def _ordinal_table() -> dict[str, int]:
    """Every ordinal word up to 59, joined or in two words, both genders, built from the units and tens."""
    out = {"unico": 1, "unica": 1, "primer": 1, "tercer": 3}
    for i, u in enumerate(UNITS, 1):
        out[u] = i
    for t, n in TENS.items():
        out[t] = n
        for i, u in enumerate(UNITS, 1):
            for join in ("", "-"):
                out[f"{t}{join}{u}"] = n + i
            out[f"{t[:-1]}a-{u[:-1]}a"] = n + i
    for k, v in list(out.items()):
        if k.endswith("o"):
            out[k[:-1] + "a"] = v
    return out


def ordinal_value(word: Column) -> Column:
    """The number that an ordinal word or digits stand for; null if neither."""
    key = slug(word)
    table = F.create_map(*[F.lit(x) for kv in sorted(_ordinal_table().items()) for x in kv])
    digits = F.nullif(F.regexp_extract(key, "^([0-9]+)[oa]?$", 1), F.lit("")).cast("int")
    return F.coalesce(digits, F.try_element_at(table, key))


def sql_fold(x: str) -> str:
    return f"lower(translate({x}, '{ACCENTED}', '{PLAIN}'))"


def sql_slug(x: str) -> str:
    return f"regexp_replace(regexp_replace({sql_fold(x)}, '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')"


def sql_number_key(number: str, kind: str) -> str:
    s = sql_slug(number)
    return f"case when {kind} = 'article' then regexp_replace({s}, '^([0-9]+)[oa](-|$)', '\\1\\2') else {s} end"
