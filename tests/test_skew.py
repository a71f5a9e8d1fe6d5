"""A warehouse-hour that holds a third of all statements: the shuffle join
is split by AQE's skew handling, the salted join spreads the key, and all
strategies give the broadcast result."""

import datetime as dt

from pyspark.sql import functions as F

from spendscope.operators import cost
from spendscope.plans.joins import materialize

PRICE_SCHEMA = "cloud string, sku_name string, price_start_time timestamp_ntz, price_end_time timestamp_ntz, price_usd double"


def hot_history(spark, n=30000):
    hot = F.col("id") % 3 == 0
    base = spark.range(n).select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("statement_id"),
        F.lit("ws").alias("workspace_id"), F.lit("u").alias("executed_by"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("w"), (F.col("id") % 97).cast("string"))).alias("warehouse_id"),
        *[F.lit(None).cast("string").alias(c) for c in ["dashboard_id", "genie_space_id", "notebook_id", "alert_id", "job_id"]],
        F.lit("app").alias("client_application"), F.lit("FINISHED").alias("execution_status"),
        F.timestamp_add("HOUR", F.when(hot, 0).otherwise(F.col("id") % 24).cast("int"),
                        F.lit("2024-01-01 10:05:00").cast("timestamp_ntz")).alias("start_time"),
        (F.col("id") % 1000).alias("compilation_duration_ms"),
        F.lit(10).cast("bigint").alias("execution_duration_ms"),
        F.lit(0).cast("bigint").alias("result_fetch_duration_ms"),
    )
    return base.withColumn("end_time", F.timestamp_add("MINUTE", F.lit(20), F.col("start_time")))


def test_hot_hour_key(spark):
    qh = hot_history(spark)
    usage = qh.select(
        "workspace_id", "warehouse_id", F.lit("AWS").alias("cloud"), F.lit("SKU").alias("sku_name"),
        F.lit("SQL").alias("billing_origin_product"),
        F.date_trunc("hour", "start_time").cast("timestamp_ntz").alias("usage_start_time"),
        F.lit(1.0).alias("usage_quantity"),
    ).distinct()
    prices = spark.createDataFrame([("AWS", "SKU", dt.datetime(2020, 1, 1), None, 2.0)], PRICE_SCHEMA)
    as_of = dt.datetime(2024, 2, 1)

    confs = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        work = cost.statement_hour_work(cost.statement_hours(cost.statements(qh, as_of)))
        rates = materialize(cost.hour_rates(cost.hour_totals(work), cost.hourly_cost(usage, prices, as_of)), "rates")
        shuffled = cost.roll_up_statements(cost.attribute_hours(work, rates))  # no hint, no salt
        got_shuffled = {r["statement_id"]: r["attributed_cost_usd"] for r in shuffled.collect()}
        plan = shuffled._jdf.queryExecution().executedPlan().toString()  # final AQE plan of what ran
        assert "skewed" in plan  # AQE split the hot partition
        salted = cost.query_cost_attribution(qh, usage, prices, as_of, salt_buckets=8)
        got_salted = {r[0]: r[1] for r in salted.select("statement_id", "attributed_cost_usd").collect()}
        split = cost.query_cost_attribution(qh, usage, prices, as_of, max_broadcast_rows=0)
        got_split = {r[0]: r[1] for r in split.select("statement_id", "attributed_cost_usd").collect()}
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    broadcast = cost.query_cost_attribution(qh, usage, prices, as_of, materialize_rates=True)
    expected = {r[0]: r[1] for r in broadcast.select("statement_id", "attributed_cost_usd").collect()}
    assert len(expected) == 30000
    for k, v in expected.items():
        assert abs(got_shuffled[k] - v) < 1e-9 and abs(got_salted[k] - v) < 1e-9 and abs(got_split[k] - v) < 1e-9
    # every billed hour has work, so the whole bill is attributed
    total = sum(expected.values())
    assert abs(total - 2.0 * usage.count()) < 1e-6


def rows_per_task(spark, df):
    """Rows of every task of ``df``'s last stage, without adaptive execution."""
    old = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[1])
    return sorted([r["count"] for r in found] + [0] * (int(spark.conf.get("spark.sql.shuffle.partitions")) - len(found)))


def test_heavy_hours_are_found_and_split(spark):
    """A third of the statements in one warehouse-hour: no salt is given, and no task of the
    join holds twice the median."""
    work = cost.statement_hour_work(cost.statement_hours(cost.statements(hot_history(spark), dt.datetime(2024, 2, 1))))
    totals = cost.hour_totals(work)
    rates = materialize(totals.withColumns({"dbus": F.lit(1.0), "list_cost_usd": F.lit(2.0)}), "rates")
    split = cost.attribute_hours(work, rates, written=True, max_broadcast_rows=0)
    tasks = rows_per_task(spark, split)
    assert sum(tasks) == work.count() and tasks[-1] <= 2 * tasks[len(tasks) // 2], tasks
    whole = cost.attribute_hours(work, rates)
    assert rows_per_task(spark, whole)[-1] >= work.count() // 3  # what it would be
    got, want = (df.agg(F.sum("cost_usd_in_hour"), F.count("*")).first() for df in (split, whole))
    assert got[1] == want[1] and abs(got[0] - want[0]) < 1e-6


def test_interval_join_with_millions_of_prices_and_a_hot_sku(spark):
    """3 million price intervals, one SKU with half of the usage: equal to the plain range join
    on the SKUs that are used, and no task holds twice the median."""
    from spendscope.plans.skew import interval_left_join

    start = F.lit("2023-01-01").cast("timestamp_ntz")
    n_skus = 1_000_000
    sku = F.concat(F.lit("k"), (F.col("id") % n_skus).cast("string"))
    period = F.floor(F.col("id") / n_skus).cast("int")
    prices = spark.range(3 * n_skus).select(
        F.lit("AWS").alias("cloud"), sku.alias("sku_name"),
        F.timestamp_add("DAY", period * 130 + (F.col("id") % 20).cast("int"), start).alias("price_start_time"),
        F.when(period < 2, F.timestamp_add("DAY", (period + 1) * 130 + (F.col("id") % 17).cast("int"), start)).alias("price_end_time"),
        (F.col("id") % 1000 / 1000).alias("price_usd"))
    usage = spark.range(60_000).select(
        "id", F.when(F.col("id") % 500 == 1, F.lit(None).cast("string")).otherwise(F.lit("AWS")).alias("cloud"),
        F.when(F.col("id") % 2 == 0, "k7").otherwise(F.concat(F.lit("k"), (F.col("id") * 31 % (n_skus + 500)).cast("string"))).alias("sku_name"),
        F.timestamp_add("MINUTE", (F.col("id") * 7 % 200_000).cast("int"), F.lit("2023-08-01").cast("timestamp_ntz")).alias("usage_start_time"))
    on = ["cloud", "sku_name"]
    joined = interval_left_join(usage, prices, on, "usage_start_time", "price_start_time", "price_end_time")
    assert joined.columns == [*usage.columns, "price_start_time", "price_end_time", "price_usd"]
    tasks = rows_per_task(spark, joined)
    assert tasks[-1] <= 2 * tasks[len(tasks) // 2], tasks
    used = usage.select(*on).distinct()
    near = prices.join(F.broadcast(used), on, "left_semi").withColumnsRenamed({"cloud": "c", "sku_name": "s"})
    plain = usage.join(F.broadcast(near), (F.col("cloud") == F.col("c")) & (F.col("sku_name") == F.col("s"))
                       & (F.col("usage_start_time") >= F.col("price_start_time"))
                       & (F.col("price_end_time").isNull() | (F.col("usage_start_time") < F.col("price_end_time"))), "left")
    digest = [F.count("*"), F.count("price_usd"), F.sum("price_usd"), F.sum(F.xxhash64("id", "price_start_time") % 1_000_003)]
    got, want = joined.agg(*digest).first(), plain.agg(*digest).first()
    assert got[0] > 60_000 and (got[0], got[1], got[3]) == (want[0], want[1], want[3]) and abs(got[2] - want[2]) < 1e-6


def test_interval_join_edges(spark):
    """Bin borders, open ends, overlaps, empty sides, null keys and points."""
    from spendscope.plans.skew import interval_left_join

    schema = "k string, at timestamp_ntz, n int"
    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    points = [("a", t(1), 1), ("a", t(2), 2), ("a", t(3), 3), ("a", None, 4), (None, t(2), 5), ("b", t(2), 6), ("c", t(2), 7)]
    spans = [("a", t(1), t(2), "x"), ("a", t(2), None, "y"), ("a", t(1), t(9), "z"), ("b", t(2, 1), None, "u"), ("b", t(3), t(1), "never"),
             (None, t(1), None, "w"), ("c", t(1), t(2), "v"), ("a", None, None, "no start")]
    big = spark.createDataFrame(points, schema)
    small = spark.createDataFrame(spans, "k string, b timestamp_ntz, e timestamp_ntz, v string")
    want = sorted((n, v) for k, at, n in points for v in
                  [v for kk, b, e, v in spans if k is not None and k == kk and at and b and b <= at and (e is None or at < e)] or [None])
    for hours in (1, 24, 720):
        got = interval_left_join(big, small, ["k"], "at", "b", "e", bin_hours=hours).select("n", "v").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert interval_left_join(big.limit(0), small, ["k"], "at", "b", "e").count() == 0
    assert interval_left_join(big, small.limit(0), ["k"], "at", "b", "e").where("v IS NULL").count() == len(points)


def test_hot_group_percentiles_are_exact(spark):
    """One group holds a third of the rows (10,000 distinct values): the
    distributed exact percentiles equal Spark's in-memory percentile."""
    from spendscope.operators.metrics import exact_percentiles

    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string")))
        .alias("g"),
        ((F.col("id") * 7919) % 100003).alias("v"),
    )
    ps = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", ps).collect()}
    want = {r["g"]: r for r in df.groupBy("g").agg(
        *[F.percentile(F.col("v").cast("double"), F.lit(p)).alias(n) for n, p in ps.items()]).collect()}
    assert got.keys() == want.keys()
    for g in want:
        for n in ps:
            assert got[g][n] == want[g][n], (g, n)
    glob = exact_percentiles(df, [], "v", ps).collect()[0]
    ref = df.agg(*[F.percentile(F.col("v").cast("double"), F.lit(p)).alias(n) for n, p in ps.items()]).collect()[0]
    assert all(glob[n] == ref[n] for n in ps)
