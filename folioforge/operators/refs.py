"""References: links already in bodies, references still in prose, defined terms, resolution and rewriting."""

from __future__ import annotations

import re
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from folioforge.functions.text import fold, slug, sql_number_key, sql_slug
from folioforge.runtime import bounded_broadcast, staged

#: A provision's number in prose, and a list of them behind `artículo(s)`. No look-around, so that other engines read it too.
NUMBER = r"[0-9]+(?:,[0-9]{3}\b)*(?:[oa°º]\.?)?(?:-(?:[A-Z]\b|Ñ))?(?:-[0-9]+)?(?:[ -](?:bis|ter|qu[aá]ter|quinquies|quintus|sexies|septies|octies)\b(?:[ -][0-9]+)?)?"
LIST = rf"art[ií]culos? ({NUMBER}(?:(?:, | y | e | o | al | a ){NUMBER})*)"
RELATIVE = r"\bart[ií]culo (anterior|siguiente)\b"
LINK = r"\[([^\]\n]+)\]\([^)\s]+\)"
_WORD = re.compile(r"[^\W_]+")
#: What follows a number that belongs to another norm, and what stands before that norm's name.
OTHER = r"^,? (?:de la|del|de los|de las|de) (?:Ley|Código|Reglamento|Constitución|Carta|Decreto|Estatuto|Disposiciones|citad[ao]|propi[ao]|referid[ao])"
BEFORE_NAME = r"^,? (?:de la|del|de los|de las|de) "
#: Openings of a list of definitions.
DEFINES = r"(?i)se (?:entender[aá]n?|entienden?) por"
DEFINED = r"^(?:[IVXLCDM]+|[0-9]+|[a-z])(?:\.-|\.|\)) ([^:\n]+): (.+)$"


def body_text(text: Column) -> Column:
    """The text without heading and breadcrumb lines, links as their labels."""
    kept = F.regexp_replace(F.translate(text, "\x01\x02\x03", ""), r"(?m)^[>#] .*$", "")
    return F.regexp_replace(kept, LINK, "$1")


def links_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos from 1, label, target_path) of the inline links of each body, in order."""
    rows = df.where(F.col(text_col).isNotNull()).select(id_col, F.posexplode(F.regexp_extract_all(text_col, F.lit(LINK), F.lit(0))).alias("p", "link"))
    return rows.select(id_col, (F.col("p") + 1).alias("pos"), F.regexp_extract("link", r"^\[([^\]]+)\]", 1).alias("label"), F.regexp_extract("link", r"\(([^)]+)\)$", 1).alias("target_path"))


def link_kind(label: Column, path: Column) -> Column:
    return (
        F.when(path.contains("/markdown/"), "cross_instrument")
        .when(fold(label).isin("anterior", "siguiente"), "relative")
        .when(label.rlike("^[0-9]"), "numeric")
        .otherwise("term")
    )


def numbers_key(raw: Column) -> Column:
    """Key of a number in prose: thousands separators and ordinal endings gone, folded, hyphens for other marks."""
    n = F.regexp_replace(raw, r",(?=[0-9]{3}(?![0-9]))", "")
    n = F.regexp_replace(n, r"^([0-9]+) ?- ([A-Z])$", "$1-$2")
    return F.regexp_replace(slug(n), "^([0-9]+)[oa](-|$)", "$1$2")


def prose_references(df: DataFrame, id_col: str, text_col: str, own_key: str | None = None) -> DataFrame:
    """(id, pos, raw, key, external, range_end, tail): numbers after `artículo(s)`: single, listed, and the ends of ranges.

    Heading and breadcrumb lines are no references. `external` tells that another norm's name follows, so that the number
    is not one of this instrument; `range_end` that the number closes a range begun by the one before; `tail` is what
    follows the list on its line, up to the next one. With `own_key`, a column that holds the row's own key, references of a row to itself are left out.
    Null texts give no row; equal numbers each give theirs.
    """
    own = F.lit(None).cast("string") if own_key is None else F.col(own_key)
    # each match is marked in place, so what follows it stays whole and may begin with the next match
    marked = F.regexp_replace(body_text(F.col(text_col)), "(?iu)" + LIST, "\x01$1\x02")
    rows = df.where(F.col(text_col).isNotNull()).select(id_col, own.alias("own"), F.posexplode(F.slice(F.split(marked, "\x01"), 2, 1 << 30)).alias("p", "m"))
    rows = rows.select(id_col, "own", "p", F.substring_index("m", "\x02", 1).alias("list"), F.regexp_extract("m", "\x02([^\n]*)", 1).alias("tail"))
    items = F.split(F.regexp_replace("list", "(?i) al? ([0-9])", " y \x03$1"), "(?i), | y | e | o ")
    rows = rows.select(id_col, "own", "p", "tail", F.col("tail").rlike(OTHER).alias("external"), F.posexplode(items).alias("i", "item"))
    raw = F.translate("item", "\x03", "")
    rows = rows.select(id_col, "own", (F.col("p") * 1000 + F.col("i") + 1).alias("pos"), raw.alias("raw"), numbers_key(raw).alias("key"), "external", F.col("item").startswith("\x03").alias("range_end"), "tail")
    return rows.where(F.col("external") | ~F.col("key").eqNullSafe(F.col("own"))).drop("own")


def reference_ranges(refs: DataFrame, id_col: str) -> DataFrame:
    """(id, pos, low, high) of the ranges `A al B` among references of `prose_references`: whole numbers, ends included."""
    whole = F.nullif(F.regexp_extract("key", "^([0-9]{1,9})$", 1), F.lit("")).cast("int")
    ends = refs.select(id_col, "pos", "external", "range_end", whole.alias("n"))
    low = ends.select(id_col, (F.col("pos") + 1).alias("pos"), F.col("n").alias("low"))
    return ends.where("range_end and not external").join(low, [id_col, "pos"]).where("low <= n").select(id_col, "pos", "low", F.col("n").alias("high"))


def expand_ranges(ranges: DataFrame, articles: DataFrame, keys: list[str], width: int = 64) -> DataFrame:
    """Ranges with the `articles(keys, n, id)` inside: both in buckets of `width` numbers, joined by equality.

    A range is cut to the numbers that its group has, so a mistyped end opens no more buckets than there are.
    """
    known = articles.groupBy(*keys).agg(F.min("n").alias("__low"), F.max("n").alias("__high"))
    cut = ranges.join(known, keys).withColumns({"low": F.greatest("low", "__low"), "high": F.least("high", "__high")}).drop("__low", "__high")
    r = cut.where("low <= high").withColumn("bucket", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor(F.col("high") / width))))
    a = articles.withColumn("bucket", F.floor(F.col("n") / width))
    return r.join(a, [*keys, "bucket"]).where("n between low and high").drop("bucket")


def relative_references(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, label): `artículo anterior` and `artículo siguiente`; plurals and synonyms name no single provision."""
    found = F.regexp_extract_all(body_text(F.col(text_col)), F.lit("(?iu)" + RELATIVE), F.lit(1))
    rows = df.where(F.col(text_col).isNotNull()).select(id_col, F.posexplode(found).alias("p", "label"))
    return rows.select(id_col, (F.col("p") + 1).alias("pos"), F.lower("label").alias("label"))


def missed_tails(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, number): numbers whose mark is set off by a blank (`87- I`), which a reference would cut short or misread."""
    found = F.regexp_extract_all(body_text(F.col(text_col)), F.lit(r"\b([0-9]+- [A-Z])\b"), F.lit(1))
    return df.where(F.col(text_col).isNotNull()).select(id_col, F.explode(found).alias("number"))


def sql_numbers_key(raw: str) -> str:
    n = f"regexp_replace(regexp_replace({raw}, ',([0-9]{{3}})', '\\1', 'g'), '^([0-9]+) ?- ([A-Z])$', '\\1-\\2')"
    return f"regexp_replace({sql_slug(n)}, '^([0-9]+)[oa](-|$)', '\\1\\2')"


def sql_body_text(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '(?m)^[>#] .*$', '', 'g'), '{LINK}', '\\1', 'g')"


def sql_prose_references(table: str = "provisions") -> str:
    """A query for (row_id, instrument_id, pos, raw, key, external, range_end, tail) of a table of provisions."""
    return rf"""(with m as (select row_id, instrument_id, own, unnest(x[2:]) as m, generate_subscripts(x[2:], 1) - 1 as p
      from (select row_id, instrument_id, case when provision_type = 'article' then {sql_number_key('number', 'provision_type')} end as own,
        string_split(regexp_replace({sql_body_text('markdown')}, '(?i){LIST}', chr(1) || '\1' || chr(2), 'g'), chr(1)) as x from {table} where markdown is not null)),
      l as (select row_id, instrument_id, own, p, split_part(m, chr(2), 1) as list, split_part(split_part(m, chr(2), 2), chr(10), 1) as tail from m),
      i as (select row_id, instrument_id, own, p, tail, unnest(k) as item, generate_subscripts(k, 1) as i from (select *, regexp_split_to_array(regexp_replace(list, '(?i) al? ([0-9])', ' y ' || chr(3) || '\1', 'g'), '(?i), | y | e | o ') as k from l)),
      r as (select row_id, instrument_id, own, p * 1000 + i as pos, replace(item, chr(3), '') as raw, regexp_matches(tail, '{OTHER}') as external, starts_with(item, chr(3)) as range_end, tail from i)
      select * from (select row_id, instrument_id, own, pos, raw, {sql_numbers_key('raw')} as key, external, range_end, tail from r) where external or key is distinct from own)"""


def resolve(refs: DataFrame, targets: DataFrame, keys: list[str], target_id: str) -> DataFrame:
    """References with the id they resolve to (the smallest of several), or null; the join's strategy is the optimizer's."""
    return refs.join(targets.groupBy(*keys).agg(F.min(target_id).alias("target_id")), keys, "left")


def cross_references(refs: DataFrame, names: DataFrame, owner: str = "instrument_id") -> DataFrame:
    """External references with the instrument that the words behind them name, the longest name first.

    `names(name, target, owner)`: names, abbreviations and aliases of instruments; an owner limits a name to one
    instrument's texts, as a term defined there does. The words that follow a reference are opened to their beginnings
    and joined to the names by equality, folded; nothing is crossed. References without a name found have a null target.
    """
    names = names.where("name is not null").select(fold(F.col("name")).alias("named"), "target", F.col("owner").alias("name_owner")).distinct()
    most = names.agg(F.max(F.size(F.split("named", " ")))).first()[0] or 0
    words = F.split(fold(F.regexp_replace(F.regexp_replace("tail", BEFORE_NAME, ""), r"\s+", " ")), " ")
    begins = F.transform(F.sequence(F.lit(1), F.least(F.size(words), F.lit(max(most, 1)))), lambda n: F.regexp_replace(F.array_join(F.slice(words, F.lit(1), n), " "), r"[.,;:)\]]+$", ""))
    key = [c for c in refs.columns if c != "tail"]
    hits = refs.where(F.col("external") & F.col("tail").rlike(BEFORE_NAME)).select(*key, F.explode(F.array_distinct(begins)).alias("named"))
    hits = hits.join(bounded_broadcast(names), "named").where(F.col("name_owner").isNull() | (F.col("name_owner") == F.col(owner)))
    best = hits.groupBy(*key).agg(F.max(F.struct(F.length("named"), F.col("name_owner").isNotNull(), "target")).alias("x")).select(*key, F.col("x.target").alias("target_instrument"))
    return refs.where("external").drop("tail").join(best, key, "left")


def defined_terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, definition) of the items `I. Term: …` of bodies that define terms (`se entenderá por`)."""
    rows = df.where(F.col(text_col).rlike(DEFINES)).select(id_col, F.explode(F.split(body_text(F.col(text_col)), "\n")).alias("line"))
    rows = rows.where(F.col("line").rlike(DEFINED))
    return rows.select(id_col, F.regexp_extract("line", DEFINED, 1).alias("term"), F.regexp_extract("line", DEFINED, 2).alias("definition"))


def number_variants(term: Column) -> Column:
    """The term in the plural and in the singular, by the last letter of its first word; the term itself first."""
    head = F.substring_index(term, " ", 1)
    rest = F.substr(term, F.length(head) + 1)
    forms = [
        head,
        F.when(head.rlike("(?i)[aeiouáéó]$"), F.concat(head, F.lit("s"))).when(head.rlike("(?i)z$"), F.regexp_replace(head, "(?i)z$", "ces")).when(head.rlike(r"(?iu)[^\Waeiousx]$"), F.concat(F.regexp_replace(head, "ón$", "on"), F.lit("es"))),
        F.when(head.rlike("(?i)ces$"), F.regexp_replace(head, "(?i)ces$", "z")).when(head.rlike("(?i)iones$"), F.regexp_replace(head, "(?i)iones$", "ión")).when(head.rlike("(?i)[lrndj]es$"), F.regexp_replace(head, "(?i)es$", "")).when(head.rlike("(?i)[aeo]s$"), F.regexp_replace(head, "(?i)s$", "")),
    ]
    return F.array_distinct(F.filter(F.array(*[F.concat(f, rest) for f in forms]), lambda x: x.isNotNull()))


def neighbours(df: DataFrame, group: list[str], order: str, id_col: str) -> DataFrame:
    """Adds `previous_id` and `next_id` in the order of `order`, then of the id, within each group.

    Rows are sorted in ranges over group and order, so a group of any size is many tasks' work; at the seams of ranges the
    neighbour comes from the first or last row of the group in the next range that holds it, a row a range and group.
    """
    clash = "__range"
    w = Window.partitionBy(clash, *group).orderBy(order, id_col)
    rows = staged(df.repartitionByRange(*group, order, id_col).withColumn(clash, F.spark_partition_id()), "ordered")
    seams = rows.groupBy(*group, clash).agg(F.min_by(id_col, F.struct(order, id_col)).alias("first"), F.max_by(id_col, F.struct(order, id_col)).alias("last"))
    across = Window.partitionBy(*group).orderBy(clash)
    seams = seams.select(*group, clash, F.lag("last").over(across).alias("__before"), F.lead("first").over(across).alias("__after"))
    near = rows.select("*", F.lag(id_col).over(w).alias("previous_id"), F.lead(id_col).over(w).alias("next_id"))
    same = [near[c].eqNullSafe(seams[c]) for c in (*group, clash)]
    joined = near.join(seams, reduce(lambda x, y: x & y, same), "left")
    return joined.select(*[near[c] for c in df.columns], F.coalesce(near["previous_id"], "__before").alias("previous_id"), F.coalesce(near["next_id"], "__after").alias("next_id"))


def _grams(batches, lengths: list[int]):
    """(id, term, start_pos) of each run of as many words as one of `lengths` says, as it stands in the text."""
    for batch in batches:
        rows, keys, starts = [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            words = [(m.group(), m.start()) for m in _WORD.finditer(text)]
            for n in lengths:
                for k in range(len(words) - n + 1):
                    rows.append(i), keys.append(text[words[k][1] : words[k + n - 1][1] + len(words[k + n - 1][0])]), starts.append(words[k][1])
        ids = batch.column(0).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.string()), pa.array(starts, pa.int32())], ["id", "term", "start_pos"])


def term_matches(texts: DataFrame, id_col: str, text_col: str, terms: DataFrame, later: bool = False, masks: DataFrame | None = None) -> DataFrame:
    """(id, term, start_pos): whole-word occurrences of terms of any number of words, the first of each term in a text.

    Texts are cut into word n-grams, of the lengths that terms have, with their places; they are joined to the terms by
    equality, texts and terms are never crossed. The longest term at a place wins: a term whose first place a longer one
    takes is left out, or, with `later`, found where it first stands outside of every longer one. `masks(term)` are proper
    names in which no term is found. Matching is exact in case, as terms are capitalised, and in what stands between the
    words.
    """
    terms = terms.select("term").where("term is not null").distinct()
    wanted = terms.withColumn("masked", F.lit(False))
    if masks is not None:
        wanted = terms.select("term", F.lit(False).alias("masked")).union(masks.select("term", F.lit(True)).where("term is not null"))
        wanted = wanted.groupBy("term").agg(F.min("masked").alias("masked"))
    n_words = F.size(F.regexp_extract_all("term", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    lengths = sorted(r[0] for r in wanted.select(n_words).distinct().collect() if r[0])
    rows = texts.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([StructField("id", texts.schema[id_col].dataType), StructField("term", StringType()), StructField("start_pos", IntegerType())])
    hits = rows.mapInArrow(partial(_grams, lengths=lengths), schema).join(bounded_broadcast(wanted), "term")
    if later:  # inside a hit that begins before it, or as early and is longer; a text's hits are bounded by the text
        end = F.col("start_pos") + F.length("term")
        before = Window.partitionBy("id").orderBy("start_pos", F.length("term").desc()).rowsBetween(Window.unboundedPreceding, -1)
        hits = hits.select("id", "term", "start_pos", "masked", F.coalesce(F.max(end).over(before) >= end, F.lit(False)).alias("covered")).where("not covered and not masked")
    else:
        longest = F.max(F.length("term")).over(Window.partitionBy("id", "start_pos"))
        hits = hits.select("id", "term", "start_pos", (F.col("masked") | (F.length("term") < longest)).alias("covered"))
    first = hits.groupBy("id", "term").agg(F.min(F.struct("start_pos", "covered")).alias("f"))
    return first.where("not f.covered").select(F.col("id").alias(id_col), "term", "f.start_pos")


def rewrite_spans(text: Column, spans: Column) -> Column:
    """The text with links put in at spans (start from 0, end, target), all found in the original; they must not overlap."""
    done = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda s, x: F.struct(
            F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit("["), F.substring(text, x["start"] + 1, x["end"] - x["start"]), F.lit("]("), x["target"], F.lit(")")).alias("out"),
            x["end"].cast("int").alias("at"),
        ),
    )
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.lit(1 << 30)))
