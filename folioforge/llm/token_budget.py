"""Token budget of slices: tokens of each text under a public tokenizer, rolled up exactly.

A text is cut into pre-tokens. Each distinct pre-token of a worker is counted once: a linked list of symbols, a priority
queue of merges, the surviving symbols are its tokens. A text's tokens are the counts weighted by frequency. Slices are
added up with map-side combine, so a source that holds a third of all rows is one row a task before the shuffle.
"""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.bpe import LONGEST, MEMORY, count_symbols, pre_token_pattern, read_ranks, vocabulary_path
from folioforge.llm.words import slices


def _counts(batches, path: str):
    ranks, split, memory = read_ranks(path), pre_token_pattern().findall, {}
    for batch in (part for whole in batches for part in slices(whole, 0)):
        pieces = [split(t) if t else [] for t in batch.column(0).to_pylist()]
        if len(memory) > MEMORY:
            memory = {}
        new = set().union(*pieces).difference(memory.keys())
        memory.update((p, count_symbols(p.encode("utf-8", "replace"), ranks)) for p in new)
        at = memory.__getitem__
        totals = [sum(map(at, ps)) for ps in pieces]
        for p in new:
            if len(p) > LONGEST:
                del memory[p]
        yield pa.RecordBatch.from_arrays([pa.array(totals, pa.int64()), *batch.columns[1:]], ["n_tokens", *batch.schema.names[1:]])


def count_tokens(df: DataFrame, text_col: str, keep: list[str], vocabulary: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(n_tokens, n_chars, *keep) of every row; null and empty texts have no tokens and no characters. A narrow pass."""
    rows = df.select(F.col(text_col).cast("string").alias("__text"), F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("n_chars"), *keep)
    fields = ", ".join(["n_tokens long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])])
    return rows.mapInArrow(partial(_counts, path=vocabulary_path(vocabulary, folder)), fields)


def one_language(lang: Column) -> Column:
    """The primary language of a tag, in lower case: `ES`, ` es`, `es-MX` are `es`; null and blank are null."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(lang)), "^([a-z]+)", 1), F.lit(""))


def one_spelling(name: Column) -> Column:
    """One spelling of a name: trimmed, lower case, runs of marks and spaces as one underscore; null and blank are null."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(name)), r"[^\p{L}\p{N}]+", "_"), F.lit(""))


def token_budget(df: DataFrame, text_col: str, dimensions: list[str], vocabulary: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """Totals for each combination of the dimensions, each alone, and all: (*dimensions, slice, n_rows, n_chars, n_tokens).

    `slice` names the dimensions that a row stands for, joined by `+` (`all` for the total), so that a null value, which
    is a slice of its own, differs from a dimension that is rolled up. Null texts count as rows without tokens. An empty
    table gives no rows.
    """
    counted = count_tokens(df, text_col, dimensions, vocabulary, folder)
    # one row a combination first: the grouping sets expand these, not the texts' rows
    base = counted.groupBy(*dimensions).agg(F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_chars"), F.sum("n_tokens").alias("n_tokens"))
    sets = [[F.col(d) for d in dimensions], *([F.col(d)] for d in dimensions), []]
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_chars", "n_tokens")]
    out = base.groupingSets(sets, *[F.col(d) for d in dimensions]).agg(*sums, F.grouping_id().alias("__id"))
    k = len(dimensions)
    named = [F.when(F.col("__id").bitwiseAND(1 << (k - 1 - i)) == 0, F.lit(d)) for i, d in enumerate(dimensions)]
    label = F.coalesce(F.nullif(F.concat_ws("+", *named), F.lit("")), F.lit("all"))
    return out.select(*dimensions, label.alias("slice"), "n_rows", "n_chars", "n_tokens").where("n_rows is not null")
