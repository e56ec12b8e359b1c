"""Consolidating many tiny record files into few well-sized ones, whole records exactly once.

1. Each file is judged in one narrow pass: broken off or not, and a 128-bit digest of its record, blind to entry order,
   byte-order marks, line ends, trailing white space and Unicode composition.
2. Of equal whole records the smallest file id stays: a grouped minimum over digests with map-side combine. Only ids,
   digests and byte counts take part, never the texts, so a record that fills a third of the files is no hot group.
3. A sample of the survivors, bounded whatever their number, gives the boundaries of ranges over the clustering key (record
   key, file id); a hot key is cut at file ids. Ranges of more than `target_bytes` are cut again by running bytes.
4. Texts are joined to the survivors and shuffled once, each output file to one task, sorted and written to a staging folder.
5. Count, bytes and a checksum over ids and texts of what was written must equal what was planned; then the result is put
   in place by renaming folders or, for stores that can't rename, by one small pointer file.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
import unicodedata
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.runtime import release, staged

JUDGED = "file_id long, whole boolean, d1 long, d2 long, key string, bytes long, check long"
#: Ranges at the most, and sampled keys a range; the standard error of a range's size is about 1 / sqrt of it. Together they
#: bound what the driver gets: 200,000 keys.
MOST_RANGES, SAMPLES_PER_RANGE = 1000, 200
POINTER = "_current"
_FRONT = re.compile(r"---\n(.*?)\n---(?:\n(.*))?\Z", re.S)
_ENTRY = re.compile(r"\n(?=[^\s#\-])")


def canonical_record(text: str) -> tuple[list[str], str]:
    """Sorted frontmatter entries and body of a file, without what makes no difference.

    Byte-order marks, the kind of line end, white space at line ends and at the end, and Unicode composition make none;
    the order of entries neither. A text without a closed frontmatter is a body alone.
    """
    t = text.replace("\ufeff", "").replace("\r\n", "\n").replace("\r", "\n")
    if not t.isascii() and not unicodedata.is_normalized("NFC", t):
        t = unicodedata.normalize("NFC", t)
    t = "\n".join([line.rstrip() for line in t.split("\n")]).rstrip()
    m = _FRONT.match(t)
    if not m:
        return [], t
    entries = sorted(e for e in _ENTRY.split(m[1]) if e)
    return entries, m[2] or ""


def _judge(batches):
    for batch in batches:
        whole, d1, d2, keys, sizes = [], [], [], [], []
        for text, announced in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if text is None:
                whole.append(False), d1.append(None), d2.append(None), keys.append(None), sizes.append(0)
                continue
            n = len(text.encode("utf-8", "surrogatepass"))
            entries, body = canonical_record(text)
            h = hashlib.blake2b(digest_size=16)
            for part in (*entries, "", body):
                h.update(part.encode("utf-8", "surrogatepass") + b"\x00")
            d = h.digest()
            whole.append(announced is None or n >= announced)
            d1.append(int.from_bytes(d[:8], "big", signed=True)), d2.append(int.from_bytes(d[8:], "big", signed=True))
            keys.append(next((e[3:].strip() for e in entries if e.startswith("id:")), "")), sizes.append(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(whole, pa.bool_()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(keys, pa.string()), pa.array(sizes, pa.int64()), batch.column(3)],
            ["file_id", "whole", "d1", "d2", "key", "bytes", "check"],
        )


def content_check(file_id: Column, text: Column) -> Column:
    """A digest of a row's id and text; null ids count as such."""
    return F.xxhash64(F.coalesce(file_id, F.lit(-1)), file_id.isNull(), text)


def judge_files(df: DataFrame, id_col: str = "file_id", text_col: str = "markdown", size_col: str = "size_bytes") -> DataFrame:
    """(file_id, whole, d1, d2, key, bytes, check): one row a file. A null text is not whole; a null size announces nothing."""
    i, t = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    rows = df.select(i.alias("file_id"), t.alias("text"), F.col(size_col).cast("long").alias("size"), content_check(i, t).alias("check"))
    return rows.mapInArrow(_judge, JUDGED)


def survivors(judged: DataFrame) -> DataFrame:
    """(file_id, key, bytes, check) of the files to keep: of each record's whole files the one with the smallest id.

    A null id comes after every other; equal ids are told apart by their content.
    """
    first = F.min(F.struct(F.col("file_id").isNull().alias("none"), "file_id", "check", "key", "bytes"))
    return judged.where("whole").groupBy("d1", "d2").agg(first.alias("x")).select("x.file_id", "x.key", "x.bytes", "x.check")


def totals(df: DataFrame, octets: Column, check: Column) -> tuple:
    """(rows, bytes, checksum)."""
    return tuple(df.agg(F.count("*"), F.coalesce(F.sum(octets), F.lit(0)), F.coalesce(F.sum(check.cast("decimal(38,0)")), F.lit(0))).first())


def range_boundaries(kept: DataFrame, target_bytes: int) -> tuple[list[tuple[str, int]], tuple]:
    """Boundaries of ranges of about `target_bytes`, or of more where there would be over `MOST_RANGES`, and `totals`.

    Rows enter the sample with a chance in proportion to their bytes, decided by a hash of the file id, so that equal
    shares of the sample hold equal bytes.
    """
    plan = totals(kept, F.col("bytes"), F.col("check"))
    ranges = min(MOST_RANGES, max(1, math.ceil(plan[1] / target_bytes)))
    if ranges == 1:
        return [], plan
    per_byte = ranges * SAMPLES_PER_RANGE / plan[1]
    draw = F.pmod(F.xxhash64("check", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    sample = sorted(_place(*r) for r in kept.where(draw < F.col("bytes") * per_byte).select("key", "file_id").collect())
    cuts = [sample[min(len(sample) - 1, len(sample) * i // ranges)] for i in range(1, ranges)] if sample else []
    return sorted(set(cuts)), plan


def _place(key: str | None, file_id: int | None) -> tuple[str, int]:
    return key or "", (1 << 63) if file_id is None else file_id


def _ranged(batches, cuts):
    for batch in batches:
        at = [bisect.bisect_right(cuts, _place(k, i)) for k, i in zip(batch.column("key").to_pylist(), batch.column("file_id").to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], [*batch.schema.names, "range_no"])


def planned_files(kept: DataFrame, cuts: list, target_bytes: int) -> tuple[DataFrame, int]:
    """(file_id, key, check, file_no) of the survivors, and how many files: each range as so many as its bytes need.

    Within a range, files are cut by running bytes. Only ids, keys and sizes take part.
    """
    placed = kept.mapInArrow(lambda batches: _ranged(batches, cuts), "file_id long, key string, bytes long, check long, range_no int")
    sizes = dict(placed.groupBy("range_no").agg(F.sum("bytes")).collect())
    shares, first, n = {}, {}, 0
    for r in range(len(cuts) + 1):
        shares[r], first[r] = max(1, round((sizes.get(r) or 0) / target_bytes)), n
        n += shares[r]
    if n == len(cuts) + 1:
        return placed.select("file_id", "key", "check", F.col("range_no").alias("file_no")), n
    running = F.sum("bytes").over(Window.partitionBy("range_no").orderBy("key", "file_id", "check").rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes")
    of = lambda d: F.element_at(F.array(*[F.lit(d[r]) for r in range(len(cuts) + 1)]), F.col("range_no") + 1)
    whole = {r: max(1, sizes.get(r) or 0) for r in shares}
    file_no = of(first) + F.least(of(shares) - 1, F.floor(running * of(shares) / of(whole)))
    return placed.select("file_id", "key", "check", file_no.cast("int").alias("file_no")), n


def _written(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def compact_files(df: DataFrame, out: str, target_bytes: int = 128 << 20, id_col: str = "file_id", text_col: str = "markdown", size_col: str = "size_bytes", pointer: bool = False) -> dict:
    """Write the whole, distinct records of `df` to the Parquet folder `out`, in files of about `target_bytes` of text.

    Kept rows hold all columns of `df` unchanged. Returns counts: files in, broken, repeated, kept, bytes, output files.
    Raises and leaves an older `out` untouched if what was written differs from what was planned. With `pointer`, `out`
    holds versions and a pointer file that one small write replaces; read it with `read_compacted`. A record whose ids are
    null comes after those with an id and is kept once; rows of one id with different records are kept each, and repeated
    rows once. An empty table gives an empty folder; texts without frontmatter are records of body alone.
    """
    spark = df.sparkSession
    judged = staged(judge_files(df, id_col, text_col, size_col), "judged")
    kept = staged(survivors(judged), "kept")
    cuts, plan = range_boundaries(kept, target_bytes)
    places, files = planned_files(kept, cuts, target_bytes)
    clash = ("__id", "__key", "__check", "__file")
    i, t = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    rows = df.withColumn("__own", content_check(i, t)).join(places.toDF("__id", "__key", "__check", "__file"), i.eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__check")))
    twice = judged.where("whole").groupBy("file_id", "check").count().where("count > 1").limit(1).count()
    if twice:  # a row that was delivered again as it is
        rows = rows.withColumn("__n", F.row_number().over(Window.partitionBy("__id", "__check").orderBy("__key"))).where("__n = 1").drop("__n")
    rows = rows.repartitionById(files, F.col("__file")).sortWithinPartitions("__file", "__key", "__id").drop(*clash, "__own")
    version = uuid.uuid4().hex
    staging = f"{out}/{version}" if pointer else f"{out}.staging"
    _written(rows, staging)
    back = spark.read.schema(df.schema).parquet(staging)
    found = totals(back, F.octet_length(t), content_check(i, t))
    n, whole = judged.agg(F.count("*"), F.count_if("whole")).first()
    release(spark, judged, kept)
    if found != plan:
        raise RuntimeError(f"written {found}, planned {plan}: {out} is left as it was")
    if pointer:
        _point(spark, out, version)
    else:
        swap_folders(spark, staging, out)
    return {"files_in": n, "broken": n - whole, "repeated": whole - plan[0], "kept": plan[0], "bytes": plan[1], "files_out": files}


def _file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _point(spark: SparkSession, out: str, version: str) -> None:
    """Make `version` the current one: one write that a store shows whole or not at all. Older versions stay for readers."""
    fs, p = _file(spark, f"{out}/{POINTER}")
    stream = fs.create(p, True)
    stream.write(bytearray(version.encode()))
    stream.close()


def read_compacted(spark: SparkSession, out: str, schema=None) -> DataFrame:
    """The rows of a folder written by `compact_files`, with or without a pointer."""
    fs, p = _file(spark, f"{out}/{POINTER}")
    path = out
    if fs.exists(p):
        stream = fs.open(p)
        path = f"{out}/{bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()}"
        stream.close()
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def swap_folders(spark: SparkSession, staging: str, out: str) -> None:
    """Put `staging` in the place of `out`; the old folder is set aside until the new one stands."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = path(f"{out}.old")
    fs.delete(old, True)
    if fs.exists(path(out)) and not fs.rename(path(out), old):
        raise RuntimeError(f"{out} can't be set aside")
    if not fs.rename(path(staging), path(out)):
        fs.rename(old, path(out))
        raise RuntimeError(f"{staging} can't be put in place")
    fs.delete(old, True)
