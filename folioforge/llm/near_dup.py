"""Near-duplicate groups: fingerprints, pigeonhole blocks, exact Hamming verification, components.

A row's text is the set of its distinct k-word runs, hashed into a universe of 2^32 bits: a sparse bit vector. Two sets
have a Jaccard similarity of t or more exactly if the Hamming distance of their vectors is at most
(|A| + |B|) (1 - t) / (1 + t). The fingerprint is `SYMBOLS` min-wise symbols of the set, split into blocks of `WIDTH`
symbols. Two fingerprints that differ in fewer symbols than there are blocks share a block for certain (pigeonhole);
at t = 0.5 a pair misses all 32 blocks with a chance of 0.75^32 = 1e-4, at 0.6 of 6e-7.

Pairs that share a block are first held against the sizes of their sets (the distance is at least their difference) and
the Hamming distance of their fingerprints, `SKETCH` bits a symbol, 32 bytes a row; only those within both get the whole
sets, and the exact distance decides.

Buckets are never expanded into all pairs. Each batch links equal blocks to its smallest row, each bucket links the
batches' leaders to their smallest one; links that verification refutes mark their bucket, and only buckets that still
hold more than one class are compared across classes, each pair that shares a block.
"""

from __future__ import annotations

import math
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.words import mix, shingles_of, slices, words_of
from folioforge.operators.components import connected_components
from folioforge.runtime import release, staged

SYMBOLS, WIDTH, SKETCH = 64, 2, 4
#: Bits of a filter for each of its values, and values up to which there is a filter (32 MB); beyond, rows are joined instead.
BITS_A_VALUE, FILTER_VALUES = 32, 1 << 22
#: Columns of a row that pairs are filtered by: the size of its set and one bit of each symbol a column.
FORM = ("n", *(f"s{k}" for k in range(SKETCH)))
FORM_SCHEMA = "n int, " + ", ".join(f"{c} long" for c in FORM[1:])
_U = np.uint64
_ODD = mix(np.arange(1, SYMBOLS + 1, dtype=_U) * _U(0xA0761D6478BD642F)) | _U(1)


def _symbols(flat: np.ndarray, starts: np.ndarray):
    """The min-wise symbols of each set, one array a symbol; `flat` holds the sets' members, `starts` where each begins."""
    flat = mix(flat.astype(_U) + _U(1))
    for odd in _ODD:
        x = flat * odd
        yield np.minimum.reduceat(x ^ (x >> _U(32)), starts)


def _sets(batches, run: int, least_words: int):
    for batch in (part for whole in batches for part in slices(whole, 1)):
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        w = words_of(texts)
        owner, h = shingles_of(w, run)
        keep = (np.diff(w.first) >= least_words)
        mine = keep[owner] if len(owner) else np.zeros(0, bool)
        owner, bits = owner[mine], (h[mine] >> _U(32)).astype(np.uint32)
        # distinct in the smaller universe; already sorted within a text
        new = np.ones(len(bits), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (bits[1:] != bits[:-1])
        owner, bits = owner[new], bits[new]
        rows = np.flatnonzero(np.bincount(owner, minlength=len(texts)) > 0) if len(owner) else np.zeros(0, np.int64)
        offsets = np.append(np.searchsorted(owner, rows), len(owner)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bits.view(np.int32)))
        sketch = np.zeros((SKETCH, len(rows)), _U)
        if len(rows):
            for j, symbol in enumerate(_symbols(bits, offsets[:-1].astype(np.int64))):
                some = mix(symbol)
                for k in range(SKETCH):
                    sketch[k] |= ((some >> _U(k)) & _U(1)) << _U(j)
        cells = [ids.take(pa.array(rows)), lists, pa.array(np.diff(offsets)), *(pa.array(x.view(np.int64)) for x in sketch)]
        yield pa.RecordBatch.from_arrays(cells, ["row_id", "bits", *FORM])


def bit_filter(values: DataFrame, most: int = FILTER_VALUES) -> np.ndarray | None:
    """The single column's values as a bitmap by their low bits, made on the executors; None if there are more than `most`.

    It has 32 to 64 bits a value, whatever their number, so that it lets through one other value in 32 at the most.
    """
    at, n = values.columns[0], values.count()
    if n > most:
        return None
    size = 1 << max(20, (BITS_A_VALUE * n).bit_length())
    place = F.col(at).bitwiseAND(F.lit(size - 1)) + 1
    rows = values.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros(size // 8, np.uint8)
    for k, bits in rows:
        out[(k - 1) * 4096 : k * 4096] = np.frombuffer(bits, np.uint8)
    return out


def _passes(bitmap: np.ndarray | None, values: np.ndarray) -> np.ndarray:
    """Whether each value may be in the filter; without a filter, all may."""
    if bitmap is None:
        return np.ones(len(values), bool)
    at = values & (8 * len(bitmap) - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _some(batches, bitmap: np.ndarray | None, passing: bool = True):
    """Rows whose first column may be among the bitmap's values, or the others."""
    for batch in batches:
        yield batch.filter(pa.array(_passes(bitmap, batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)) == passing))


def _maybe_classed(batches, bitmap: np.ndarray | None):
    """Links with a mark whether either end may be among the bitmap's values; where neither is, each is a class alone."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_passes(bitmap, a) | _passes(bitmap, b))], ["key", "a", "b", "classed"])


def _blocks(batches, combine: bool, bitmap: np.ndarray | None = None):
    """Block rows (key, a = row, b = null). With `combine`, of equal blocks in a batch only the smallest row stays and
    links (key, a = that row, b = other row) replace the rest. With a bitmap, only keys that it may hold."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        lists = batch.column(1)
        starts = lists.offsets.to_numpy()[:-1].astype(np.int64)
        flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint32)
        base = starts[0]
        keys = []
        for i, symbol in enumerate(_symbols(flat[base : lists.offsets[-1].as_py()], starts - base)):
            if i % WIDTH == 0:
                keys.append(np.full(len(ids), i + 1, _U))
            keys[-1] = mix(keys[-1] * _U(0x9E3779B97F4A7C15) + symbol)
        key = np.concatenate(keys).view(np.int64)
        row = np.tile(ids, len(keys))
        if bitmap is not None:
            some = _passes(bitmap, key)
            key, row = key[some], row[some]
        none = np.zeros(len(key), bool)
        if combine:
            order = np.lexsort((row, key))
            key, row = key[order], row[order]
            head = np.ones(len(key), bool)
            head[1:] = key[1:] != key[:-1]
            leader = row[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
            a, b = np.where(head, row, leader), np.where(head, 0, row)
            none = head
        else:
            a, b, none = row, np.zeros(len(key), np.int64), ~none
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(a), pa.array(b, mask=none)], ["key", "a", "b"])


def most_differing(threshold: float) -> int:
    """Symbols whose sketches differ in a pair at the threshold, at the most but for a chance of 1e-4."""
    p = (1 - 0.5**SKETCH) * (1 - threshold)
    below = np.cumsum([math.comb(SYMBOLS, i) * p**i * (1 - p) ** (SYMBOLS - i) for i in range(SYMBOLS + 1)])
    return int(np.flatnonzero(below >= 1 - 1e-4)[0])


def _near(threshold: float) -> Column:
    """Whether sizes and sketches, between the columns of `_sketched`, let a pair be close enough."""
    differing = reduce(Column.bitwiseOR, [F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")) for c in FORM[1:]])
    sizes = F.abs(F.col("n_a") - F.col("n_b")) * (1 + threshold) <= (F.col("n_a") + F.col("n_b")) * (1 - threshold) + 1e-9
    return sizes & (F.bit_count(differing) <= most_differing(threshold))


def _sketched(sets: DataFrame, side: str) -> DataFrame:
    # filters are the same on either side of a join, so that both share one shuffle
    there = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in ("row_id", *FORM)])
    return sets.where(there).select(F.col("row_id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in FORM))


def _linked(pairs: DataFrame, sets: DataFrame, threshold: float, filter_values: int) -> DataFrame:
    """Staged pairs (a, b) whose bit vectors are close enough; exact. Only sets that a pair needs are shuffled."""
    needed = bit_filter(pairs.select("a").union(pairs.select("b")), filter_values)
    sets = sets.select("row_id", "bits").mapInArrow(partial(_some, bitmap=needed), "row_id long, bits array<int>")
    right = pairs.join(sets.withColumnsRenamed({"row_id": "b", "bits": "bits_b"}), "b")
    both = right.join(sets.withColumnsRenamed({"row_id": "a", "bits": "bits_a"}), "a")
    total = F.size("bits_a") + F.size("bits_b")
    distance = total - 2 * F.size(F.array_intersect("bits_a", "bits_b"))
    out = staged(both.where(distance * (1 + threshold) <= total * (1 - threshold) + 1e-9).select("a", "b"), "links")
    release(out.sparkSession, pairs)
    return out


def _open_blocks(batches, bitmap: np.ndarray | None):
    """(key, row, class, size and sketch) of the blocks whose keys the bitmap may hold, of rows (row, bits, class, size and sketch)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        for part in _blocks([batch.select([0, 1])], False, bitmap):
            row = part.column(1).to_numpy(zero_copy_only=False)
            at = pa.array(order[np.searchsorted(ids, row, sorter=order)])
            cells = [part.column(0), part.column(1), *(batch.column(c).take(at) for c in ("class", *FORM))]
            yield pa.RecordBatch.from_arrays(cells, ["key", "row", "class", *FORM])


def near_duplicates(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, run: int = 5, least_words: int = 0, filter_values: int = FILTER_VALUES) -> DataFrame:
    """(row_id, group_id) for every row in a group of two or more; group_id is the group's smallest row id.

    Rows are linked if the Jaccard similarity of their distinct `run`-word runs is at least `threshold`; a group is all
    rows joined by links. Null, empty and wordless texts, texts of fewer than `least_words` words and of fewer than
    `run` words belong to no group. Equal texts are a group. Row ids must be unique; other columns are ignored. An empty
    table gives an empty result.
    """
    rows = df.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).alias("text")).where("text is not null")
    sets = staged(rows.mapInArrow(partial(_sets, run=run, least_words=least_words), f"row_id long, bits array<int>, {FORM_SCHEMA}"), "sets")
    spark = df.sparkSession
    members = sets.select("row_id", "bits")
    blocks = members.mapInArrow(partial(_blocks, combine=True), "key long, a long, b long")
    # a key's leaders, one a batch at the most, are a group, and each link is one of its own: no key gathers all its rows
    low = F.min(F.when(F.col("b").isNull(), F.col("a"))).over(Window.partitionBy("key", "b"))
    star = blocks.withColumn("low", low).where("b is not null or a > low")
    edges = staged(star.select("key", F.when(F.col("b").isNull(), F.col("low")).otherwise(F.col("a")).alias("a"), F.coalesce("b", "a").alias("b")), "edges")
    release(spark)
    # joined by a first: rows of an a are then together, and repeated pairs go without another shuffle
    near = edges.select("a", "b").join(_sketched(sets, "a"), "a").dropDuplicates(["a", "b"]).join(_sketched(sets, "b"), "b")
    near = staged(near.where(_near(threshold)).select("a", "b"), "pairs")
    release(spark)
    links = _linked(near, sets, threshold, filter_values)
    classes = staged(connected_components(links), "classes")

    # buckets that hold more than one class: all pairs of different classes whose fingerprints are near
    named = lambda c: classes.select(F.col("node").alias(c), F.col("root").alias(f"class_{c}"))
    known = bit_filter(classes.select("node"), filter_values)
    some = edges.mapInArrow(partial(_maybe_classed, bitmap=known), "key long, a long, b long, classed boolean")
    alone = some.where("not classed").select("key")
    split = some.where("classed").join(named("a"), "a", "left").join(named("b"), "b", "left")
    split = split.where("coalesce(class_a, a) <> coalesce(class_b, b)").select("key")
    keys = staged(alone.union(split), "keys")
    release(spark, edges)
    open_ = bit_filter(keys, filter_values)
    # rows that may have a class get it before they are cut into blocks, so that block rows take part in one shuffle only
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sets.schema)
    own = sets.mapInArrow(partial(_some, bitmap=known, passing=False), kind)
    classed = sets.mapInArrow(partial(_some, bitmap=known), kind).join(classes.select(F.col("node").alias("row_id"), "root"), "row_id", "left")
    form = [F.col(c) for c in FORM]
    again = own.select("row_id", "bits", F.col("row_id").alias("class"), *form).union(classed.select("row_id", "bits", F.coalesce("root", "row_id").alias("class"), *form))
    again = again.mapInArrow(partial(_open_blocks, bitmap=open_), f"key long, row long, class long, {FORM_SCHEMA}")
    if open_ is None:
        again = again.join(keys.distinct(), "key", "left_semi")
    again = staged(again, "again")
    release(spark, keys)
    # both sides have the same plan but for names, so that they share one shuffle
    side = lambda c: again.select(F.col("key").alias(f"key_{c}"), F.col("row").alias(c), F.col("class").alias(f"class_{c}"), *(F.col(x).alias(f"{x}_{c}") for x in FORM))
    pairs = side("a").join(side("b"), F.expr("key_a = key_b and a < b and class_a <> class_b") & _near(threshold))
    pairs = staged(pairs.select("a", "b").distinct(), "pairs")
    release(spark, again)
    late = _linked(pairs, sets, threshold, filter_values)
    if late.isEmpty():
        found = classes
    else:  # classes that the late links join; the smallest root is the smallest row
        roots = late.join(named("a"), "a", "left").join(named("b"), "b", "left")
        roots = staged(roots.select(F.coalesce("class_a", "a").alias("a"), F.coalesce("class_b", "b").alias("b")), "roots")
        top = connected_components(roots).select(F.col("node").alias("root"), F.col("root").alias("top"))
        both = classes.select("node", "root").union(roots.select("a", "a").union(roots.select("b", "b"))).distinct()
        found = both.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    release(spark)
    return found.select(F.col("node").alias("row_id"), F.col("root").alias("group_id"))
