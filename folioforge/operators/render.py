"""Rendering of records as frontmatter and Markdown, of instrument indexes and of JSON, and reading them back."""

from __future__ import annotations

import os
import uuid
from functools import partial
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys of the frontmatter in their fixed order; only the last but two is optional.
KEYS = ("id", "instrument_id", "instrument", "name", "provision_type", "number", "aliases", "generated", "temporal_status", "review_status", "amendment_marks", "source_url", "source_sha256")
QUOTED = ("name", "number")


def frontmatter() -> Column:
    """The frontmatter of a row that has the columns of `KEYS`; null values are left out."""
    parts = []
    for k in KEYS:
        c = F.col(k)
        if k == "aliases":
            v = F.concat(F.lit('["'), F.array_join(c, '", "'), F.lit('"]'))
        elif k == "amendment_marks":
            v = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: x.cast("string")), ","), F.lit("]"))
        elif k in QUOTED:
            v = F.concat(F.lit('"'), c, F.lit('"'))
        else:
            v = c.cast("string")
        parts.append(F.concat(F.lit(f"{k}: "), v))
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *parts), F.lit("\n---\n"))


def record(body: Column) -> Column:
    return F.concat(frontmatter(), F.lit("\n"), body, F.lit("\n"))


def parse_frontmatter(text: Column) -> Column:
    """map<key, value> of a rendered record, quotes of quoted values removed; empty if there is no frontmatter."""
    front = F.regexp_extract(text, r"(?s)^﻿?---\r?\n(.*?)\r?\n---", 1)
    lines = F.filter(F.split(front, r"\r?\n"), lambda x: x.rlike("^[a-z_0-9]+:"))
    pairs = F.transform(lines, lambda x: F.struct(F.substring_index(x, ":", 1).alias("key"), F.regexp_replace(F.trim(F.regexp_replace(x, "^[^:]+:", "")), '^"|"$', "").alias("value")))
    return F.map_from_entries(F.array_distinct(F.filter(pairs, lambda p: p["key"] != "")))


def index_pages(df: DataFrame) -> DataFrame:
    """(instrument_id, page): a page an instrument, articles, then transitory provisions, in source order (`ord`).

    The page of an instrument is one value, so its lines are gathered; a line is a name and a path, not a text.
    """
    line = F.concat(F.lit("- ["), "number", F.lit("](") , "file_name", F.lit(".md)"))
    lists = [F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("provision_type") == kind, F.struct("ord", line.alias("l"))))), lambda x: x["l"]), "\n") for kind in ("article", "transitory")]
    page = F.concat_ws("\n\n", F.concat(F.lit("# "), F.first("name")), F.nullif(lists[0], F.lit("")), F.nullif(lists[1], F.lit("")))
    return df.groupBy("instrument_id").agg(page.alias("page"))


def write_records(df: DataFrame, out: str, by: str = "instrument", mode: str = "errorifexists") -> None:
    """Rendered records as text files, a folder for each value of `by`; `df` holds `by` and `record`."""
    df.select(by, F.col("record").alias("value")).write.mode(mode).partitionBy(by).text(out, lineSep="\x1e\n")


def _one_file_each(batches, root: str):
    for batch in batches:
        for folder, name, text in zip(*(c.to_pylist() for c in batch.columns)):
            path = Path(root, folder, "markdown", f"{name}.md")
            path.parent.mkdir(parents=True, exist_ok=True)
            part = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
            part.write_text(text, encoding="utf-8", newline="")
            os.replace(part, path)  # a task that runs again puts the same file in place
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])


def write_record_files(df: DataFrame, out: str, by: str = "instrument", name: str = "file_name", record: str = "record") -> int:
    """One file a record, `<out>/<by>/markdown/<name>.md`, for readers that want files; returns how many were written.

    `out` is a folder that all executors have mounted (`file:` or a plain path). Rows with a null among the three columns
    are left out; of rows with the same name the last to be written stays. For data that is read again by an engine,
    `write_records` or a table is the better sink.
    """
    root = out.removeprefix("file://").removeprefix("file:")
    if "://" in root:
        raise ValueError("records are written as files to a mounted folder only")
    rows = df.select(by, name, record).dropna()
    return rows.mapInArrow(partial(_one_file_each, root=root), "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_records(spark: SparkSession, out: str) -> DataFrame:
    """Records written by `write_records`, with the partition column."""
    return spark.read.text(out, lineSep="\x1e\n").withColumnRenamed("value", "record")
