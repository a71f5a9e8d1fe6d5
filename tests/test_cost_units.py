"""Hand-made rows for the attribution rules (R2-R6) and properties."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendscope.operators import cost, prices

T = dt.datetime
AS_OF = T(2024, 2, 1)
QH_SCHEMA = (
    "statement_id string, workspace_id string, executed_by string, warehouse_id string, dashboard_id string, "
    "genie_space_id string, notebook_id string, alert_id string, job_id string, client_application string, "
    "execution_status string, start_time timestamp_ntz, end_time timestamp_ntz, compilation_duration_ms bigint, "
    "execution_duration_ms bigint, result_fetch_duration_ms bigint"
)
USAGE_SCHEMA = (
    "workspace_id string, warehouse_id string, cloud string, sku_name string, billing_origin_product string, "
    "usage_start_time timestamp_ntz, usage_quantity double"
)
PRICE_SCHEMA = "cloud string, sku_name string, price_start_time timestamp_ntz, price_end_time timestamp_ntz, price_usd double"


def qh(spark, rows):
    full = [(r[0], r[1], "u", "w1", None, None, None, None, None, "app", r[2], r[3], r[4], r[5], 0, 0) for r in rows]
    return spark.createDataFrame(full, QH_SCHEMA)


def usage(spark, rows):
    return spark.createDataFrame([("ws", "w1", "AWS", "SKU", "SQL", t, q) for t, q in rows], USAGE_SCHEMA)


def price(spark, p=2.0):
    return spark.createDataFrame([("AWS", "SKU", T(2020, 1, 1), None, p)], PRICE_SCHEMA)


def attribute(spark, stmts, bills, **kw):
    return {
        r["statement_id"]: r
        for r in cost.query_cost_attribution(qh(spark, stmts), usage(spark, bills), price(spark), AS_OF, **kw).collect()
    }


def test_two_statements_share_an_hour_by_work(spark):
    out = attribute(spark, [
        ("a", "ws", "FINISHED", T(2024, 1, 1, 10, 0), T(2024, 1, 1, 10, 10), 300),
        ("b", "ws", "FINISHED", T(2024, 1, 1, 10, 20), T(2024, 1, 1, 10, 30), 100),
    ], [(T(2024, 1, 1, 10), 10.0)])
    assert abs(out["a"]["attributed_cost_usd"] - 15.0) < 1e-9
    assert abs(out["b"]["attributed_cost_usd"] - 5.0) < 1e-9
    assert abs(out["a"]["attributed_dbus"] + out["b"]["attributed_dbus"] - 10.0) < 1e-9


def test_statement_ending_on_the_hour_gets_zero_width_bucket(spark):
    s = cost.statements(qh(spark, [("a", "ws", "FINISHED", T(2024, 1, 1, 10, 30), T(2024, 1, 1, 11, 0), 600)]),
                        AS_OF)
    rows = cost.statement_hour_work(cost.statement_hours(s)).orderBy("hour_start").collect()
    assert [r["hour_start"] for r in rows] == [T(2024, 1, 1, 10), T(2024, 1, 1, 11)]
    assert rows[1]["work_ms_in_hour"] == 0.0 and rows[0]["work_ms_in_hour"] == 600.0


def test_end_before_start_keeps_one_hour_with_all_work(spark):
    s = cost.statements(qh(spark, [("a", "ws", "FINISHED", T(2024, 1, 1, 10, 30), T(2024, 1, 1, 9, 0), 500)]), AS_OF)
    rows = cost.statement_hour_work(cost.statement_hours(s)).collect()
    assert len(rows) == 1 and rows[0]["work_ms_in_hour"] == 500.0


def test_zero_total_work_gives_null_cost(spark):
    out = attribute(spark, [("a", "ws", "FINISHED", T(2024, 1, 1, 10, 0), T(2024, 1, 1, 10, 5), 0)],
                    [(T(2024, 1, 1, 10), 1.0)])
    assert out["a"]["attributed_cost_usd"] is None


def test_null_workspace_never_joins(spark):
    out = attribute(spark, [("a", None, "FINISHED", T(2024, 1, 1, 10, 0), T(2024, 1, 1, 10, 5), 10)],
                    [(T(2024, 1, 1, 10), 1.0)])
    assert out["a"]["attributed_cost_usd"] is None


def test_no_bill_costs_zero_and_unfinished_is_dropped(spark):
    out = attribute(spark, [
        ("a", "ws", "FINISHED", T(2024, 1, 1, 10, 0), T(2024, 1, 1, 10, 5), 10),
        ("b", "ws", "FAILED", T(2024, 1, 1, 10, 0), T(2024, 1, 1, 10, 5), 10),
    ], [(T(2024, 1, 2, 10), 1.0)])
    assert set(out) == {"a"} and out["a"]["attributed_cost_usd"] == 0.0


def test_salted_and_shuffle_joins_agree_with_broadcast(spark):
    stmts = [(f"s{i}", "ws", "FINISHED", T(2024, 1, 1, 10, i), T(2024, 1, 1, 12, i), 100 + i) for i in range(30)]
    bills = [(T(2024, 1, 1, h), 1.0 + h) for h in (10, 11, 12)]
    a = attribute(spark, stmts, bills, materialize_rates=True)
    b = attribute(spark, stmts, bills, max_broadcast_rows=0, salt_buckets=4)
    c = attribute(spark, stmts, bills, max_broadcast_rows=0, materialize_rates=False)
    d = attribute(spark, stmts, bills)
    for k in a:
        assert abs(a[k]["attributed_cost_usd"] - d[k]["attributed_cost_usd"]) < 1e-9
        assert abs(a[k]["attributed_cost_usd"] - b[k]["attributed_cost_usd"]) < 1e-9
        assert abs(a[k]["attributed_cost_usd"] - c[k]["attributed_cost_usd"]) < 1e-9


def test_discount_factor_clamps():
    assert cost.discount_factor(35) == 0.65
    assert cost.discount_factor(-10) == 1.1
    assert cost.discount_factor(150) == 0.0


def test_contract_price_overrides_and_overlap_is_reported(spark):
    lst = spark.createDataFrame([("AWS", "SKU", T(2024, 1, 1), None, 1.0), ("AWS", "SKU", T(2023, 1, 1), None, 0.9)],
                                PRICE_SCHEMA)
    acct = spark.createDataFrame([("AWS", "SKU", T(2024, 1, 1), None, 0.5)], PRICE_SCHEMA)
    eff = prices.effective_prices(acct, lst)
    assert sorted(r["price_usd"] for r in eff.collect()) == [0.5, 0.9]
    assert prices.overlapping_prices(eff).count() == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50_000), st.integers(0, 30_000), st.integers(0, 10_000)), min_size=1, max_size=6))
def test_hour_split_preserves_work(spark_session_for_hypothesis, spans):
    spark = spark_session_for_hypothesis
    base = T(2024, 1, 1, 0, 0)
    rows = [(f"s{i}", "ws", "FINISHED", base + dt.timedelta(seconds=a), base + dt.timedelta(seconds=a + d), w)
            for i, (a, d, w) in enumerate(spans)]
    s = cost.statements(qh(spark, rows), AS_OF)
    per = cost.statement_hour_work(cost.statement_hours(s)).groupBy("statement_id", "work_ms").agg(
        F.sum("work_ms_in_hour").alias("t")).collect()
    for r in per:
        assert abs(r["t"] - r["work_ms"]) < 1e-6 * max(1, r["work_ms"])


def test_billed_hours_with_work_are_fully_attributed(spark):
    """Σ attributed cost of an hour = the hour's bill, for every billed hour
    whose total work is positive (idle hours are not attributed)."""
    from spendscope import fixtures as fx

    sf = "/root/testdata/sf0.001"
    eff = prices.effective_prices(fx.account_prices(spark, sf), fx.list_prices(spark, sf))
    hourly = cost.hourly_cost(fx.usage(spark, sf), eff, fx.AS_OF)
    shw = cost.statement_hour_work(cost.statement_hours(cost.statements(fx.query_history(spark, sf), fx.AS_OF)))
    totals = cost.hour_totals(shw)
    att = cost.attribute_hours(shw, cost.hour_rates(totals, hourly))
    per_hour = att.groupBy(*cost.HOUR_KEY).agg(F.sum("cost_usd_in_hour").alias("a"), F.sum("dbus_in_hour").alias("d"))
    rows = (per_hour.join(totals.where(F.col("total_work_ms_in_hour") > 0), cost.HOUR_KEY)
            .join(hourly, cost.HOUR_KEY).collect())
    assert rows
    for r in rows:
        assert abs(r["a"] - r["list_cost_usd"]) <= 1e-9 * max(1.0, abs(r["list_cost_usd"]))
        assert abs(r["d"] - r["dbus"]) <= 1e-9 * max(1.0, abs(r["dbus"]))


def test_percentiles_equal_the_builtin_ones(spark):
    from spendscope import fixtures as fx
    from spendscope.operators import metrics

    base = metrics.metric_base(fx.metric_history(spark, "/root/testdata/sf0.001"))
    for by in ([], ["executed_by"], ["query_date", "query_source_type"]):
        got = metrics.QUERY_HISTORY_METRICS.query(base, by=by, measures=["p50_duration_sec", "p95_duration_sec"])
        x = F.col("duration_ms").cast("double")
        want = base.groupBy(*by).agg(*[F.round(F.percentile(x, F.lit(p)) / 1000, 2) for p in (0.5, 0.95)])
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_optional_source_ids_and_grains(spark):
    from spendscope import fixtures as fx
    from spendscope.operators import metrics

    history = fx.metric_history(spark, "/root/testdata/sf0.001").withColumn("pipeline_id", F.lit("p1"))
    base = metrics.metric_base(history)
    for dim in ("pipeline_id", "query_hour", "day_of_week", "is_slow_query", "is_tableau"):
        got = metrics.QUERY_HISTORY_METRICS.query(base, by=[dim], measures=["total_queries"])
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, base.groupBy(dim).count().collect())))
