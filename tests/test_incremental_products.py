"""Products built step by step: roll-ups from increments, histories from a stream of snapshots, as-of reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spendscope import fixtures as fx
from spendscope.operators import cost, prices, rollup_states, rollups, scd2
from spendscope.operators.metrics import QUERY_HISTORY_METRICS, measure_states, metric_base
from spendscope.streaming import snapshots

SF = "/root/testdata/sf0.001"


def same(got, want, key):
    a, b = ({r[key]: r.asDict() for r in df.collect()} for df in (got, want))
    assert a.keys() == b.keys()
    for k in a:
        for c, x in b[k].items():
            assert a[k][c] == pytest.approx(x, abs=1e-9) if isinstance(x, float) else a[k][c] == x, (k, c)


def test_rollups_from_increments_equal_a_rebuild(spark, tmp_path):
    pr = prices.effective_prices(fx.account_prices(spark, SF), fx.list_prices(spark, SF))
    qca = cost.query_cost_attribution(fx.query_history(spark, SF), fx.usage(spark, SF), pr, fx.AS_OF)
    # a statement without a cost counts, but not in the average
    none = qca.orderBy("statement_id").limit(1).withColumns({"statement_id": F.lit("none"), "attributed_cost_usd": F.lit(None).cast("double")})
    path = str(tmp_path / "qca")
    qca.unionByName(none).write.parquet(path)
    qca = spark.read.parquet(path)
    store = rollup_states.RollupStore(spark, str(tmp_path / "rollups"))
    with pytest.raises(ValueError):
        store.states()
    part = F.pmod(F.xxhash64("statement_id"), F.lit(3))
    for n in range(3):
        assert store.apply(qca.where(part == n), n + 1)
        assert not store.apply(qca, n + 1)  # a repeated step changes nothing
        if n == 1:
            store.compact()
    boards = fx.dashboard_current(spark, SF).withColumn("owner", F.lit("o"))
    spaces, houses = fx.space_current(spark, SF), fx.warehouse_current(spark, SF)
    same(store.dashboard_cost(boards), rollups.dashboard_cost(boards, qca), "dashboard_id")
    same(store.space_cost(spaces), rollups.space_cost(spaces, qca), "space_id")
    same(store.warehouse_cost(houses), rollups.warehouse_cost(houses, qca), "warehouse_id")


def test_measures_of_coarser_grains_come_from_the_states(spark):
    base = metric_base(fx.metric_history(spark, SF)).where("execution_status = 'FINISHED'")
    states = measure_states(base, ["query_date", "workspace_id"])
    for by in ([], ["workspace_id"], ["query_date", "workspace_id"]):
        got = QUERY_HISTORY_METRICS.query_states(states, by).collect()
        want = QUERY_HISTORY_METRICS.query(base, by).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and got
    empty = QUERY_HISTORY_METRICS.query(base.limit(0)).first()
    assert empty["total_queries"] == 0 and empty["unique_users"] == 0 and empty["p50_duration_sec"] is None


def test_stream_of_snapshots_restarts_and_repeats(spark, tmp_path):
    """Warehouses landed in three versions: an unmarked folder is not read, a failed fetch keeps its
    object open, a repeated marker changes nothing, and as-of reads open only what overlaps."""
    root, kind = str(tmp_path), "warehouse"
    store = snapshots.history(spark, f"{root}/store", kind)

    def objects(states):
        return spark.createDataFrame([(i, None if s is None else f'{{"id":"{i}","state":"{s}"}}', "invalid" if s is None else "ok")
                                      for i, s in states.items()], "object_id string, raw_json string, status string")

    def run():
        snapshots.run_stream(spark, f"{root}/landed", f"{root}/store", f"{root}/stream").awaitTermination()

    snapshots.land(spark, f"{root}/landed", kind, 10, objects({"a": "ON", "b": "ON", "c": "ON"}))
    objects({"a": "HALF"}).write.parquet(f"{root}/landed/{kind}/version=20")  # no marker yet
    run()
    assert store.last_version() == 10
    snapshots.land(spark, f"{root}/landed", kind, 20, objects({"a": "OFF", "b": None}))  # b's fetch failed, c is gone
    snapshots.land(spark, f"{root}/landed", kind, 30, objects({"a": "OFF", "b": "ON", "c": "ON"}))
    run()
    snapshots.land(spark, f"{root}/landed", kind, 30, objects({"a": "NEW"}))  # the same version again
    run()
    rows = sorted((r["id"], r["state"], r[scd2.START], r[scd2.END]) for r in store.read().collect())
    assert rows == [("a", "OFF", 20, None), ("a", "ON", 10, 20), ("b", "ON", 10, None), ("c", "ON", 10, 20), ("c", "ON", 30, None)]


def test_as_of_opens_only_overlapping_folders(spark, tmp_path):
    store = scd2.HistoryStore(spark, str(tmp_path / "h"), ["k"], ["v"])
    for version in range(1, 9):
        rows = [(k, version if k % 3 == version % 3 else 0) for k in range(30) if k % 10 != version]
        store.apply(spark.createDataFrame(rows, "k int, v int").coalesce(1), version)
    whole = store.read()
    folders = lambda df: {f.split("/")[-3] for f in df.inputFiles()}
    before = None
    for version in (1, 4, 7):
        got = store.as_of(version)
        assert sorted(got.collect()) == sorted(scd2.as_of(whole, version).collect())
        assert all(f.startswith("v8-") or int(f.split("-")[0][1:]) > version for f in folders(got))
        assert before is None or len(folders(got)) < before
        before = len(folders(got))
    store.compact()
    for version in (2, 6):
        assert sorted(store.as_of(version).collect()) == sorted(scd2.as_of(whole, version).collect())
