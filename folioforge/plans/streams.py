"""Streaming queries, drained over the tables; their results equal the batch ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.plans.registry import query
from folioforge.runtime import table
from folioforge.streaming.events import drain, gaps_by_key, last_by_key, read_events, windowed_counts


def _events(spark: SparkSession, d: str) -> DataFrame:
    e = read_events(spark, d, table(spark, d, "events").schema, "events.parquet")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_tumbling", "select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events group by 1, 2")
def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    out = drain(windowed_counts(_events(spark, d), "ts", ["event_type"], "1 hour"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("stream_last_event", "select user_id, arg_max(event_type, (ts, event_type)) as event_type from events group by 1")
def stream_last_event(spark: SparkSession, d: str) -> DataFrame:
    return drain(last_by_key(_events(spark, d), "user_id", "ts", "event_type")).select("user_id", "event_type")


@query("stream_closed_windows", "with m as (select max(ts) - interval '10 minutes' as mark from events) select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events, m where time_bucket(interval '1 hour', ts) + interval '1 hour' <= mark group by 1, 2")
def stream_closed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows that the watermark has closed, each once; the state of the others is still open."""
    out = drain(windowed_counts(_events(spark, d), "ts", ["event_type"], "1 hour"), "append")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("stream_gaps", "with g as (select user_id, date_diff('microsecond', lag(ts) over (partition by user_id order by ts), ts) >= 7200000000 as b from events) select user_id, count(*) as n, count(*) filter (b) as breaks from g where user_id is not null group by 1")
def stream_gaps(spark: SparkSession, d: str) -> DataFrame:
    """State of a key across micro-batches: its events, and gaps of two hours or more between them."""
    return drain(gaps_by_key(_events(spark, d), "user_id", "ts", 7200.0), "update", latest=["user_id"])
