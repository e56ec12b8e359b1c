"""The training-data queries (pN_) and their SQL, registered by the entry file if this subpackage is present."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from folioforge.llm.chunks import split_oversized
from folioforge.llm.encode import decode_column, encode_column
from folioforge.llm.leakage import find_edited_items, find_leaks
from folioforge.llm.near_dup import near_duplicates
from folioforge.llm.pii import personal_mentions, redacted_texts
from folioforge.llm.sentences import sentences
from folioforge.llm.token_budget import count_tokens, one_language, one_spelling, token_budget
from folioforge.runtime import bounded_broadcast, table

#: Key of the pseudonyms in the queries; a deployment passes its own.
DEMO_KEY = b"folioforge-demonstration-key"


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(table(spark, sf_dir, "provisions"), "row_id", "markdown", threshold=0.5, run=3, least_words=40)
    return groups.where("row_id <> group_id").select("group_id", "row_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_oversized(table(spark, sf_dir, "provisions"), "row_id", "markdown", limit=1500, overlap=200, lang_col="lang")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences(table(spark, sf_dir, "provisions"), "row_id", "markdown", "lang")


def _sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisions with the dimensions of the token budget in one spelling each."""
    domains = table(spark, sf_dir, "instruments").select("instrument_id", one_spelling(F.col("domain")).alias("domain"))
    rows = table(spark, sf_dir, "provisions").select(
        "row_id", "instrument_id", "markdown", one_spelling(F.col("provider")).alias("provider"), one_language(F.col("lang")).alias("lang")
    )
    return rows.join(bounded_broadcast(domains.groupBy("instrument_id").agg(F.min("domain").alias("domain"))), "instrument_id", "left")


def p3_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_budget(_sliced(spark, sf_dir), "markdown", ["provider", "lang", "domain"])


def p3_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "provisions"), "markdown", ["row_id"]).select("row_id", "n_chars", "n_tokens")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_column(table(spark, sf_dir, "documents"), "doc_id", "text", "byte_bpe_50k")


def p6_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts decoded from their ids, by their digest: equal to the digest of the texts themselves."""
    texts = decode_column(p6_ids(spark, sf_dir), "doc_id", "ids", "byte_bpe_50k")
    return texts.select("doc_id", F.sha2("text", 256).alias("text_sha256"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), run=12)


def p7_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose opening or end stands in a document with an edit or, from 24 words on, two."""
    return find_edited_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every item, in how many documents it leaked."""
    items = table(spark, sf_dir, "eval_items").select("item_id", "task")
    hits = p7_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n_docs"))
    return items.join(hits, "item_id", "left").select("item_id", "task", F.coalesce("n_docs", F.lit(0)).alias("n_docs"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_mentions(table(spark, sf_dir, "documents"), DEMO_KEY).select("doc_id", "kind", "value").distinct()


def p8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mention's value with its placeholder and the documents that it links: equal values have equal ones."""
    rows = personal_mentions(table(spark, sf_dir, "documents"), DEMO_KEY).select("doc_id", "kind", "value", "placeholder").distinct()
    return rows.groupBy("kind", "value", "placeholder").agg(F.count("*").alias("n_docs"))


def p8_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redacted_texts(table(spark, sf_dir, "documents"), DEMO_KEY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found,
    "p3_budget": p3_budget,
    "p3_documents": p3_documents,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p6_ids": p6_ids,
    "p6_round_trip": p6_round_trip,
    "p7_found": p7_found,
    "p7_edited": p7_edited,
    "p7_items": p7_items,
    "p8_found": p8_found,
    "p8_pseudonyms": p8_pseudonyms,
    "p8_redacted": p8_redacted,
}

_WORDS = "regexp_extract_all(strip_accents(lower({})), '[a-z0-9]+')"

#: Every pair of rows with a common run of words, its exact similarity, and what can be reached over links.
_GROUPS = f"""
with recursive w as (select row_id, {_WORDS.format('markdown')} as w from provisions where markdown is not null),
s as (select distinct row_id, unnest(list_transform(generate_series(1, len(w) - 2), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) as g from w where len(w) >= 40),
n as (select row_id, count(*) as n from s group by 1),
p as (select a.row_id as a, b.row_id as b, count(*) as c from s a join s b on a.g = b.g and a.row_id < b.row_id group by 1, 2),
l as (select a, b from p join n x on x.row_id = a join n y on y.row_id = b where 2 * c >= x.n + y.n - c),
e as (select a, b from l union all select b, a from l),
r(node, other) as (select distinct a, a from e union select r.node, e.b from r join e on e.a = r.other)
select min(other) as group_id, node as row_id from r group by node having min(other) <> node"""

#: Every run of twelve words of the items in every run of the documents.
_LEAKS = f"""(
with d as (select doc_id, {_WORDS.format('text')} as w from documents where text is not null),
i as (select item_id, {_WORDS.format('text')} as w from eval_items where text is not null),
x as (select doc_id, unnest(list_transform(generate_series(1, len(w) - 11), lambda k: array_to_string(w[k : k + 11], ' '))) as g from d),
y as (select distinct item_id, unnest(list_transform(generate_series(1, len(w) - 11), lambda k: array_to_string(w[k : k + 11], ' '))) as g from i)
select distinct doc_id, item_id from x join y using (g))"""

ORACLES: dict[str, str] = {
    "p2_found": _GROUPS,
    "p7_found": f"select doc_id, item_id from {_LEAKS}",
    "p7_items": f"select item_id, task, coalesce(n, 0)::bigint as n_docs from eval_items left join (select item_id, count(*) as n from {_LEAKS} group by 1) using (item_id)",
    "p6_round_trip": "select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents",
}
