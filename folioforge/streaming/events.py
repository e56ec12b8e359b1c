"""Event streams: windows with watermarks, and the last event of each key as keyed state."""

from __future__ import annotations

from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from folioforge.runtime import scratch


def read_events(spark: SparkSession, folder: str, schema, name: str = "*.parquet", files: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", files).parquet(folder)


def windowed_counts(events: DataFrame, at: str, keys: list[str], size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts of each window and key.

    Drained in `append` mode, a window comes out once the watermark has passed its end, its state is dropped and later
    rows of it are left out; in `complete` mode every window is kept, the watermark does nothing and no row is late.
    """
    w = F.window(at, size, slide) if slide else F.window(at, size)
    rows = events.withWatermark(at, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"))
    return rows.select(F.col("w.start").alias("start"), *keys, "n")


def drain(stream: DataFrame, mode: str = "complete", schema=None, latest: list[str] | None = None) -> DataFrame:
    """Run a stream over all that is there now and give its result as a table in the shared folder.

    Each micro-batch writes a folder of its own, named by its number, so that a batch that is run again replaces its rows.
    In `complete` mode the last batch is the result, in `append` mode all of them together, in `update` mode the last row
    of each key (the columns `latest`).
    """
    spark = stream.sparkSession
    out, state = scratch(spark, "stream"), scratch(spark, "state")

    def sink(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    kind = StructType([*(schema or stream.schema).fields, StructField("batch", LongType())])
    rows = spark.read.schema(kind).parquet(out)
    if mode == "complete":
        last = rows.agg(F.max("batch")).first()[0]
        rows = rows.where(F.col("batch") == F.lit(last))
    elif mode == "update":
        names = [c for c in rows.columns if c not in (*latest, "batch")]
        rows = rows.groupBy(*latest).agg(F.max_by(F.struct(*names), "batch").alias("x")).select(*latest, "x.*")
        return rows.select(stream.columns)
    return rows.drop("batch")


def last_by_key(events: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """The last value of each key so far, in `complete` mode."""
    return events.groupBy(key).agg(F.max_by(value, F.struct(at, value)).alias(value), F.max(at).alias(at))


def _count_gaps(key, frames, state, name: str, at: str, gap: float):
    """Rows of a key so far, and how many of them came `gap` seconds or more behind the latest one before."""
    n, breaks, last = state.get if state.exists else (0, 0, None)
    times = sorted(t for frame in frames for t in frame[at])
    for t in times:
        n, breaks, last = n + 1, breaks + (last is not None and t.timestamp() - last >= gap), max(t.timestamp(), last or t.timestamp())
    state.update((n, breaks, last))
    yield pd.DataFrame([(key[0], n, breaks)], columns=[name, "n", "breaks"])


def gaps_by_key(events: DataFrame, key: str, at: str, gap: float) -> DataFrame:
    """(key, n, breaks) in `update` mode: state of our own a key, kept across micro-batches.

    A row that is older than one of an earlier batch counts and breaks nothing. Keys must not be null.
    """
    kind = events.schema[key].dataType.simpleString()
    rows = events.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, at)
    return rows.groupBy(key).applyInPandasWithState(partial(_count_gaps, name=key, at=at, gap=gap), f"{key} {kind}, n long, breaks long", "n long, breaks long, last double", "update", GroupStateTimeout.NoTimeout)
