"""Relational shapes over event and star tables: as-of and interval joins, sessions, buckets, chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.runtime import release, staged


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str, strict: bool = True) -> DataFrame:
    """Left rows with the right side's last `value` before (or at) their time: one shuffle by key, no join.

    Both sides are stacked and a running last value goes over them; ties in time count as before only if not `strict`.
    """
    side = F.lit(1 if strict else 0)
    a = left.select("*", F.lit(0 if strict else 1).alias("__side"), F.lit(None).cast(right.schema[value].dataType).alias("__v"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema if f.name not in (*keys, at)]
    b = right.select(*keys, at, *missing, side.alias("__side"), F.col(value).alias("__v")).select(a.columns)
    w = Window.partitionBy(*keys).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, 0)
    out = a.unionByName(b).withColumn("asof_value", F.last("__v", True).over(w))
    return out.where(F.col("__side") != side).drop("__side", "__v")


def interval_join(points: DataFrame, intervals: DataFrame, at: str, low: str, high: str, width: int) -> DataFrame:
    """Points with the intervals that hold them (low <= at < high): both in buckets of `width`, joined by equality.

    An interval is repeated for each bucket that it touches, so `width` should be about the usual length.
    """
    p = points.withColumn("__bucket", F.floor(F.col(at) / width))
    i = intervals.where(F.col(low) < F.col(high)).withColumn("__bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor((F.col(high) - 1) / width))))
    return p.join(i, "__bucket").where((F.col(low) <= F.col(at)) & (F.col(at) < F.col(high))).drop("__bucket")


def salted_sum(df: DataFrame, key: str, value: str, salts: int = 32) -> DataFrame:
    """(key, n, total) in two steps, for aggregates whose state is large; plain sums combine on the map side anyway."""
    part = df.groupBy(key, F.pmod(F.xxhash64(value), F.lit(salts)).alias("s")).agg(F.count("*").alias("n"), F.sum(value).alias("t"))
    return part.groupBy(key).agg(F.sum("n").alias("n"), F.sum("t").alias("total"))


def session_starts(df: DataFrame, key: str, at: str, gap: str) -> DataFrame:
    """(key, start, n): sessions of events closer than `gap`."""
    return df.groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), "n")


def hourly(at: Column, size: str, slide: str | None = None) -> Column:
    return F.window(at, size, slide) if slide else F.window(at, size)


def follow_chains(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(root, last, steps) of every source: where its chain ends and how many steps away, of any length.

    Of several targets the smallest is followed. Pointers are doubled: each round, an equi-join of one row a source, makes
    chains twice as long known, so a chain of n steps takes log2(n) rounds. Chains that run into a circle never end: their
    `last` and `steps` are null. Null ends count as no edge.
    """
    spark = edges.sparkSession
    step = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).groupBy(F.col(src).alias("root")).agg(F.min(dst).alias("last"))
    at = staged(step.withColumns({"steps": F.lit(1).cast("long"), "ended": F.lit(False)}), "chains")
    reach, n = 1, at.count()
    while reach <= 2 * n:
        onward = at.select(F.col("root").alias("last"), F.col("last").alias("__to"), F.col("steps").alias("__more"), F.col("ended").alias("__ended"))
        joined = at.join(onward, "last", "left")
        go = ~F.col("ended") & F.col("__to").isNotNull()
        moved = joined.select("root", F.when(go, F.col("__to")).otherwise(F.col("last")).alias("last"), F.when(go, F.col("steps") + F.col("__more")).otherwise(F.col("steps")).alias("steps"), F.when(go, F.col("__ended")).otherwise(F.lit(True)).alias("ended"))
        before, at = at, staged(moved, "chains")
        release(spark, before)
        reach *= 2
        if at.where("not ended").isEmpty():
            break
    return at.select("root", F.when(F.col("ended"), F.col("last")).alias("last"), F.when(F.col("ended"), F.col("steps")).alias("steps"))
