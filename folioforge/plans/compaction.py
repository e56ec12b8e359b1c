"""Queries of the small-file problem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.compaction import compact_files, read_compacted
from folioforge.plans.registry import query
from folioforge.runtime import release, scratch, staged, table

#: Bytes of text an output file.
TARGET_BYTES = 128 << 20

_CLEAN = r"""
with whole as (
  select file_id,
    rtrim(regexp_replace(nfc_normalize(replace(replace(replace(markdown, chr(65279), ''), chr(13) || chr(10), chr(10)), chr(13), chr(10))),
      '[ \t\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+(\n|$)', '\1', 'g'), chr(10)) as t
  from md_files where markdown is not null and (size_bytes is null or octet_length(encode(markdown)) >= size_bytes)),
parts as (
  select file_id, regexp_extract(t, '(?s)^---\n(.*?)\n---(?:\n|$)', 1) as front, regexp_replace(t, '(?s)^---\n.*?\n---(?:\n|$)', '') as body from whole),
firsts as (
  select min(file_id) as file_id from parts group by list_sort(regexp_split_to_array(front, '\n')), body)
"""


@query("p1_found", _CLEAN + "select file_id from md_files where file_id not in (select file_id from firsts)")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that the consolidated folder leaves out, by comparing it with the files that went in."""
    files = table(spark, sf_dir, "md_files")
    return files.select("file_id").join(_kept(spark, files).select("file_id"), "file_id", "left_anti")


def _kept(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(file_id, path, bytes) of what the consolidated folder holds; the folder itself goes once it was read."""
    out = scratch(spark, "compacted")
    compact_files(files, out, TARGET_BYTES)
    whole = read_compacted(spark, out, files.schema)
    whole._folioforge_path = out
    held = staged(whole.select("file_id", "path", F.octet_length("markdown").cast("long").alias("bytes")), "held")
    release(spark, whole)
    return held


@query("p1_compacted", _CLEAN + "select m.file_id, m.path, octet_length(encode(m.markdown)) as bytes from md_files m join firsts using (file_id)")
def p1_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that the consolidated folder holds."""
    return _kept(spark, table(spark, sf_dir, "md_files"))
