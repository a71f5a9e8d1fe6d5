"""End to end: two landed dashboard snapshots → history → current → cost tables."""

import tempfile

import pytest

from pyspark.sql import functions as F

from spendscope import fixtures as fx
from spendscope import schemas, tables
from spendscope.operators import scd2
from spendscope.sources import system_tables

SF = "/root/testdata/sf0.001"


def test_inventory_history_and_cost_tables(spark):
    root = tempfile.mkdtemp(prefix="tables-")
    raw = fx.raw_dashboards(spark, SF)
    sched = fx.raw_schedules(spark, SF)
    n = raw.count()
    outcomes = {}
    tables.apply_inventory_snapshot(spark, root, "dashboard", raw, 1000, sched, outcomes=outcomes)
    assert outcomes["objects"] == n and outcomes["ok"] == n and outcomes["invalid"] == 0
    # second snapshot: ids ending in 5 deleted, ids ending in 3 renamed
    v2 = raw.where(~F.col("object_id").endswith("5")).withColumn(
        "raw_json",
        F.when(F.col("object_id").endswith("3"), F.regexp_replace("raw_json", "Customer", "Client"))
        .otherwise(F.col("raw_json")),
    )
    hist = tables.apply_inventory_snapshot(spark, root, "dashboard", v2, 2000, sched)
    # re-applying an older version is a no-op
    assert tables.apply_inventory_snapshot(spark, root, "dashboard", raw, 1500, sched).count() == hist.count()
    deleted = raw.where(F.col("object_id").endswith("5")).count()
    renamed = raw.where(F.col("object_id").endswith("3")).count()
    assert hist.count() == n + renamed
    assert hist.where(F.col("__END_AT") == 2000).count() == deleted + renamed
    assert hist.schema["owner"].metadata["comment"]
    current = scd2.current(hist)
    assert current.count() == n - deleted
    assert set(current.columns) == set(schemas.snapshot_schema("dashboard").fieldNames())

    nested = tables.SystemTables(
        system_tables.nest_query_history(fx.query_history(spark, SF)),
        system_tables.nest_usage(fx.usage(spark, SF)),
        system_tables.nest_prices(fx.account_prices(spark, SF)),
        system_tables.nest_prices(fx.list_prices(spark, SF)),
        system_tables.nest_audit(fx.audit(spark, SF), request_params_as_map=False),
    ).flat()
    built = tables.cost_tables(nested, current, fx.space_current(spark, SF), fx.warehouse_current(spark, SF), fx.AS_OF)
    paths = tables.write_tables(built, f"{root}/tables")
    assert set(paths) == {"query_cost_attribution", "dashboard_cost", "space_cost", "warehouse_cost",
                          "dashboard_denormalized"}
    assert spark.read.parquet(paths["dashboard_cost"]).count() == current.count()
    assert tables.read_table(spark, f"{root}/tables", "space_cost").count() == built["space_cost"].count()
    tables.register_views(built)
    assert spark.sql("select count(*) from warehouse_cost").collect()[0][0] == 5


def test_failed_fetches_keep_their_keys_open(spark):
    root = tempfile.mkdtemp(prefix="tables-fail-")
    raw = fx.raw_spaces(spark, SF)
    n_open = scd2.current(tables.apply_inventory_snapshot(spark, root, "space", raw, 1)).count()
    ids = [r[0] for r in raw.select("object_id").orderBy("object_id").limit(4).collect()]
    status = F.when(F.col("object_id") == ids[0], "missing").when(F.col("object_id") == ids[1], "invalid") \
        .when(F.col("object_id") == ids[2], "throttled").otherwise(F.col("status"))
    second = tables.apply_inventory_snapshot(spark, root, "space", raw.withColumn("status", status), 2)
    assert scd2.current(second).count() == n_open - 1  # only the missing one is closed
    third = tables.apply_inventory_snapshot(spark, root, "space", raw.where(F.col("object_id") == ids[3]).unionByName(
        raw.limit(1).withColumn("object_id", F.lit("")).withColumn("status", F.lit("invalid"))), 3)
    assert scd2.current(third).count() == n_open - 1  # an unnamed failure: nothing is closed
    with pytest.raises(ValueError):
        tables.apply_inventory_snapshot(spark, root, "space", raw.limit(0), 4)


def test_missing_landing_folder_is_an_error(spark, tmp_path):
    from spendscope.sources import landing

    with pytest.raises(Exception):
        landing.read_landing(spark, str(tmp_path / "nowhere")).count()


def test_lost_state_never_starts_a_new_history(spark, tmp_path):
    store = scd2.HistoryStore(spark, str(tmp_path / "h"), ["k"], ["v"])
    snap = spark.createDataFrame([(i, "a") for i in range(3)], "k int, v string")
    store.apply(snap, 1)
    (tmp_path / "h" / "_state").rename(tmp_path / "elsewhere")
    with pytest.raises(RuntimeError):
        store.apply(snap.limit(1), 2)


def test_ship_package_adds_an_importable_archive(spark):
    import zipfile

    from spendscope.session import ship_package

    target = ship_package(spark)
    path = target[len("file:"):] if target.startswith("file:") else target
    with zipfile.ZipFile(path) as z:
        assert "spendscope/sources/landing.py" in z.namelist()


def test_one_row_group_is_dealt_over_all_tasks(spark, tmp_path, monkeypatch):
    """A file whose many splits hold one row group is one scan task; its rows still spread, in more tasks as they grow."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    n = 20_000
    pq.write_table(pa.table({"k": list(range(n)), "v": [i * 7919 % 104729 for i in range(n)]}), str(tmp_path / "events.parquet"), row_group_size=n)
    monkeypatch.setattr(fx, "ROWS_PER_TASK", 500, raising=False)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = fx.table(spark, str(tmp_path), "events")
        held = df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert sum(held) == n and len([h for h in held if h]) >= n // 500 and max(held) <= 1000
        assert df.agg({"v": "sum"}).first()[0] == sum(i * 7919 % 104729 for i in range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
