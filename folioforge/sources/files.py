"""Sources and sinks: text trees, tables in several formats, URL parts, bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def walk(spark: SparkSession, glob: str) -> DataFrame:
    """(path, text) of every file below a glob, each as one row."""
    return spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def load(spark: SparkSession, path: str, kind: str, schema: str | None = None) -> DataFrame:
    """A table of a format: parquet, orc, json, csv (with header) or text."""
    reader = spark.read.schema(schema) if schema else spark.read
    if kind not in ("parquet", "orc", "json", "csv", "text"):
        raise ValueError(f"unknown format {kind}")
    return reader.option("header", True).csv(path) if kind == "csv" else reader.format(kind).load(path)


def save(df: DataFrame, path: str, kind: str, mode: str = "errorifexists", by: list[str] | None = None) -> None:
    writer = df.write.mode(mode).format(kind)
    if kind == "csv":
        writer = writer.option("header", True)
    (writer.partitionBy(*by) if by else writer).save(path)


def url_parts(url: Column) -> Column:
    """struct(host, path, ext, decoded) of a URL; the extension in lower case, `pdf` or `doc` decide the reader."""
    path = F.try_parse_url(url, F.lit("PATH"))
    return F.struct(
        F.try_parse_url(url, F.lit("HOST")).alias("host"),
        path.alias("path"),
        F.lower(F.regexp_extract(url, r"\.([A-Za-z0-9]+)(?:[?#].*)?$", 1)).alias("ext"),
        F.url_decode(url).alias("decoded"),
    )


def reader_of(ext: Column) -> Column:
    return F.when(ext == "pdf", "pdf").when(ext.isin("doc", "docx"), "legacy_doc").when(ext.isin("html", "htm"), "html").otherwise("other")


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with the names of the rules they break); a rule that is null counts as broken."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    marked = df.withColumn("errors", broken)
    return marked.where(F.size("errors") == 0).drop("errors"), marked.where(F.size("errors") > 0)
