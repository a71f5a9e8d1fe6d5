"""Plan-shape regression tests: the properties the design relies on at scale."""

import re

import __spark_entry__ as entry
from spendscope import fixtures as fx
from spendscope.operators import cost
from spendscope.queries import QUERIES, _prices

SF = "/root/testdata/sf0.01"


def executed(df):
    """The final (post-AQE) physical plan of an executed DataFrame."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_written_rates_leave_one_shuffle_of_the_statement_side(spark):
    qca = cost.query_cost_attribution(fx.query_history(spark, SF), fx.usage(spark, SF), _prices(spark, SF), fx.AS_OF,
                                      materialize_rates=True)
    plan = executed(qca)
    exchanges = re.findall(r"Exchange hashpartitioning\(([a-z_]+)", plan)
    assert exchanges == ["statement_id"], exchanges  # only the final per-statement aggregate
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "partial_sum" in plan  # hour rows merged per statement before the shuffle


def test_time_filter_reaches_the_scan(spark):
    df = entry.queries()["statements_in_window"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2023-02-01", plan)


def test_no_python_evaluation_outside_the_landing_source(spark):
    for name, q in QUERIES.items():
        if name.startswith("snapshot_"):
            continue
        plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def test_date_partitioned_history_is_pruned(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "qh")
    fx.query_history(spark, "/root/testdata/sf0.001").withColumn("start_date", F.to_date("start_time")) \
        .write.partitionBy("start_date").parquet(path)
    qh = spark.read.parquet(path)
    stmts = cost.statements(qh, fx.AS_OF, window_days=20, partition_date_col="start_date")
    plan = stmts._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*start_date[^\]]*2024-01-12", plan), plan
    full = cost.statements(qh, fx.AS_OF, window_days=20)
    assert stmts.count() == full.count() > 0
