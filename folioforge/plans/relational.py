"""Relational coverage over the star and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.operators import relational as R
from folioforge.plans.registry import query
from folioforge.runtime import bounded_broadcast, table


@query("pricing_summary", "select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, round(sum(l_extendedprice), 2) as sum_price, round(sum(l_extendedprice * (1 - l_discount)), 2) as sum_disc, round(avg(l_quantity), 6) as avg_qty, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2")
def pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02'")
    price = F.col("l_extendedprice")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(price), 2).alias("sum_price"), F.round(F.sum(price * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.count("*").alias("n"))


@query("star_join_revenue", "select r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from region join nation on n_regionkey = r_regionkey join customer on c_nationkey = n_nationkey join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey group by 1, 2")
def star_join_revenue(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    dims = bounded_broadcast(t("region").join(t("nation"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name"))
    items = t("lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("x"))
    rows = items.join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    by_nation = rows.groupBy("c_nationkey").agg(F.sum("x").alias("x"))
    return by_nation.join(dims, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("r_name", "n_name").agg(F.round(F.sum("x"), 2).alias("revenue"))


@query("topk_per_group", "select c_nationkey, c_custkey, c_acctbal from customer qualify rank() over (partition by c_nationkey order by c_acctbal desc) <= 3")
def topk_per_group(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("c_nationkey").orderBy(F.col("c_acctbal").desc())
    rows = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal").withColumn("r", F.rank().over(w))
    return rows.where("r <= 3").drop("r")


@query("top_orders", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def top_orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("status_rollup", "select provision_type, temporal_status, count(*) as n, grouping(provision_type) + grouping(temporal_status) as depth from provisions group by rollup (provision_type, temporal_status)")
def status_rollup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "provisions").rollup("provision_type", "temporal_status")
    return rows.agg(F.count("*").alias("n"), (F.grouping("provision_type") + F.grouping("temporal_status")).cast("long").alias("depth"))


@query("source_cube", "select source, domain, count(*) as n, grouping_id(source, domain) as g from documents group by cube (source, domain)")
def source_cube(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").cube("source", "domain").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))


@query("grouping_sets", "select o_orderstatus, o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by grouping sets ((o_orderstatus), (o_orderpriority), ())")
def grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, d, "orders").groupingSets([[a], [b], []], a, b).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).select("o_orderstatus", "o_orderpriority", "n", "total")


@query("set_union", "select c_nationkey as k from customer union select s_nationkey from supplier")
def set_union(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("set_intersect", "select provision_id as id from gazette_events intersect select src_id from ref_edges")
def set_intersect(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gazette_events").select(F.col("provision_id").alias("id")).intersect(table(spark, d, "ref_edges").select("src_id"))


@query("set_except", "select id from provisions except select provision_id from gazette_events")
def set_except(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").select("id").subtract(table(spark, d, "gazette_events").select("provision_id"))


@query("customers_without_orders", "select c_custkey from customer c where not exists (select 1 from orders where o_custkey = c_custkey)")
def customers_without_orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey").join(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("quantile_rank", "select c_custkey, ntile(4) over (order by c_acctbal, c_custkey) as quarter, round(percent_rank() over (partition by c_mktsegment order by c_acctbal), 9) as share from customer")
def quantile_rank(spark: SparkSession, d: str) -> DataFrame:
    """Quarters over the whole table and ranks within segments, both from exact positions, so that no task sorts them whole."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    placed = global_rank(c, ["c_acctbal", "c_custkey"])
    n = c.count()
    q, r = divmod(n, 4)
    i = F.col("position")
    quarter = F.when(i < r * (q + 1), F.floor(i / (q + 1)) + 1).otherwise(F.floor((i - r * (q + 1)) / max(q, 1)) + r + 1)
    share = percent_rank(c, "c_mktsegment", "c_acctbal", "c_custkey")
    return placed.select("c_custkey", quarter.cast("int").alias("quarter")).join(share, "c_custkey")


def percent_rank(df: DataFrame, group: str, value: str, key: str) -> DataFrame:
    """(key, share): `percent_rank` of the value within its group, without a task that holds a whole group.

    Rows get their position over group and value; a value's rank is its first position less that of its group.
    """
    placed = global_rank(df.select(key, group, value), [group, value, key])
    firsts = placed.groupBy(group, value).agg(F.min("position").alias("first"))
    groups = placed.groupBy(group).agg(F.min("position").alias("start"), F.count("*").alias("n"))
    ranks = firsts.join(groups, firsts[group].eqNullSafe(groups[group])).select(firsts[group].alias("__g"), firsts[value].alias("__v"), F.when(F.col("n") == 1, 0.0).otherwise((F.col("first") - F.col("start")) / (F.col("n") - 1)).alias("share"))
    rows = df.select(key, group, value)
    return rows.join(ranks, rows[group].eqNullSafe(F.col("__g")) & rows[value].eqNullSafe(F.col("__v"))).select(key, F.round("share", 9).alias("share"))


def global_rank(df: DataFrame, by: list[str]) -> DataFrame:
    """Adds `position` from 0 in the order of `by`: ranges are sorted apart, then shifted by the rows before them."""
    from folioforge.runtime import staged

    parts = max(df.sparkSession.sparkContext.defaultParallelism, 1)
    ranged = staged(df.repartitionByRange(parts, *by).withColumn("__part", F.spark_partition_id()), "ranked")
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("n"))
    before = sizes.select("__part", (F.sum("n").over(Window.orderBy("__part")) - F.col("n")).alias("shift"))  # a row a range
    local = F.row_number().over(Window.partitionBy("__part").orderBy(*by)) - 1
    return ranged.withColumn("__local", local).join(F.broadcast(before), "__part").withColumn("position", F.col("__local") + F.col("shift")).drop("__part", "__local", "shift")


@query("event_json", "select event_id, cast(json_extract(props, '$.k') as integer) as k from events")
def event_json(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("tumbling", "select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events group by 1, 2")
def tumbling(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select("w.start", "event_type", "n")


@query("sliding", "select b as start, count(*) as n from (select unnest([time_bucket(interval '30 minutes', ts), time_bucket(interval '30 minutes', ts) - interval '30 minutes']) as b from events) group by 1")
def sliding(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select("w.start", "n")


@query("sessions", "with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval '2 hours' then 0 else 1 end as new from events), s as (select user_id, ts, sum(new) over (partition by user_id order by ts, new rows unbounded preceding) as k from g) select user_id, min(ts) as start, count(*) as n from s group by user_id, k")
def sessions(spark: SparkSession, d: str) -> DataFrame:
    return R.session_starts(table(spark, d, "events"), "user_id", "ts", "2 hours")


@query("asof_view", "select p.event_id, v.value as asof_value from (select * from events where event_type = 'purchase') p asof left join (select user_id, ts, max(value) as value from events where event_type = 'view' group by 1, 2) v on p.user_id = v.user_id and p.ts > v.ts")
def asof_view(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return R.asof_join(left, right, ["user_id"], "ts", "value").select("event_id", "asof_value")


@query("interval_join", "select e.event_id, i.i from events e join (select i, i * 700 as lo, i * 700 + 900 as hi from generate_series(0, 20) t(i)) i on e.event_id >= i.lo and e.event_id < i.hi")
def interval_join(spark: SparkSession, d: str) -> DataFrame:
    spans = spark.range(0, 21).select(F.col("id").alias("i"), (F.col("id") * 700).alias("lo"), (F.col("id") * 700 + 900).alias("hi"))
    return R.interval_join(table(spark, d, "events").select("event_id"), spans, "event_id", "lo", "hi", 800).select("event_id", "i")


@query("moving_average", "select o_orderkey, round(avg(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows between 2 preceding and current row), 4) as avg3 from orders")
def moving_average(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(-2, 0)
    return table(spark, d, "orders").select("o_orderkey", F.round(F.avg("o_totalprice").over(w), 4).alias("avg3"))


@query("pivot_priority", "select o_orderstatus, count(*) filter (o_orderpriority like '1%') as urgent, count(*) filter (o_orderpriority like '5%') as low from orders group by 1")
def pivot_priority(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").groupBy("o_orderstatus")
    return rows.agg(F.count_if(F.col("o_orderpriority").startswith("1")).alias("urgent"), F.count_if(F.col("o_orderpriority").startswith("5")).alias("low"))


@query("array_functions", "select vec_id, len(embedding) as dims, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 6) as norm from embeddings")
def array_functions(spark: SparkSession, d: str) -> DataFrame:
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return table(spark, d, "embeddings").select("vec_id", F.size("embedding").alias("dims"), F.round(norm, 6).alias("norm"))


@query("distinct_counts", "select source, count(distinct lang) as langs, count(distinct instrument_id) as instruments from documents group by 1")
def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.countDistinct("lang").alias("langs"), F.countDistinct("instrument_id").alias("instruments"))


@query("term_map", "select instrument_id, label as term, min(target_path) as target from ref_edges where kind = 'term' group by 1, 2")
def term_map(spark: SparkSession, d: str) -> DataFrame:
    """Every instrument's map of terms to targets, and its entries; an instrument's terms are few, its links are not gathered."""
    pairs = table(spark, d, "ref_edges").where("kind = 'term'").groupBy("instrument_id", "label").agg(F.min("target_path").alias("t"))
    maps = pairs.groupBy("instrument_id").agg(F.map_from_entries(F.collect_list(F.struct("label", "t"))).alias("m"))
    return maps.select("instrument_id", F.explode("m").alias("term", "target"))


@query("date_parts", "select date_trunc('month', o_orderdate) as month, count(*) as n, sum(date_diff('day', timestamp '1992-01-01', o_orderdate))::bigint as days from orders group by 1")
def date_parts(spark: SparkSession, d: str) -> DataFrame:
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))
    rows = table(spark, d, "orders").groupBy(F.date_trunc("month", F.col("o_orderdate")).cast("timestamp_ntz").alias("month"))
    return rows.agg(F.count("*").alias("n"), F.sum(days).alias("days"))


@query("chain", "with recursive e as (select src_id, min(target_id) as target_id from ref_edges where kind = 'relative' and resolved and src_id <> target_id group by 1), c(root, node, steps, path) as (select src_id, target_id, 1, [src_id, target_id] from e union all select c.root, e.target_id, c.steps + 1, list_append(c.path, e.target_id) from c join e on e.src_id = c.node where not list_contains(c.path, e.target_id)), l as (select root, arg_max(node, steps) as node, max(steps) as steps from c group by 1) select root, case when e.src_id is null then node end as last, case when e.src_id is null then steps end::bigint as steps from l left join e on e.src_id = l.node")
def chain(spark: SparkSession, d: str) -> DataFrame:
    """Where chains of relative references end, whatever their length."""
    e = table(spark, d, "ref_edges").where("kind = 'relative' and resolved and src_id <> target_id")
    return R.follow_chains(e, "src_id", "target_id")
