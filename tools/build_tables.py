"""Build every table of the product from the generated data, end to end:
landed snapshots → histories → current views → cost and usage tables,
written as parquet under a target folder (default: the session's
checkpoint folder).  Prints one line per table with its row count.

    python tools/build_tables.py [--sf-dir DIR] [--target DIR]
"""

from __future__ import annotations

import argparse
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--target", default=None)
    args = ap.parse_args()

    from spendscope import fixtures as fx
    from spendscope import tables
    from spendscope.operators import scd2
    from spendscope.functions.normalize import owner_from_path
    from spendscope.session import ensure_checkpoint_dir, local_session
    from spendscope.sources import system_tables as st

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    target = args.target or f"{ensure_checkpoint_dir(spark).rstrip('/')}/spendscope/tables-{uuid.uuid4().hex[:8]}"
    version = int(time.time() * 1000)
    t0 = time.perf_counter()

    # snapshots → histories → current views
    current = {}
    for kind, raw, sched in (
        ("dashboard", fx.raw_dashboards(spark, args.sf_dir), fx.raw_schedules(spark, args.sf_dir)),
        ("space", fx.raw_spaces(spark, args.sf_dir), None),
        ("warehouse", fx.raw_warehouses(spark, args.sf_dir), None),
    ):
        outcomes: dict = {}
        hist = tables.apply_inventory_snapshot(spark, f"{target}/histories", kind, raw, version, sched,
                                               outcomes=outcomes)
        current[kind] = scd2.current(hist)
        print(f"{kind}_history: {hist.count()} rows; fetch outcomes {outcomes}")

    # system tables in their nested layout → flat inputs
    system = tables.SystemTables(
        st.nest_query_history(fx.query_history(spark, args.sf_dir)),
        st.nest_usage(fx.usage(spark, args.sf_dir)),
        st.nest_prices(fx.account_prices(spark, args.sf_dir)),
        st.nest_prices(fx.list_prices(spark, args.sf_dir)),
        st.nest_audit(fx.audit(spark, args.sf_dir)),
    ).flat()
    dashboards = current["dashboard"]
    if "owner" not in dashboards.columns:
        dashboards = dashboards.withColumn("owner", owner_from_path("parent_path"))
    built = tables.cost_tables(system, dashboards, current["space"], current["warehouse"], fx.AS_OF)
    built.update({f"{k}_current": v for k, v in current.items()})
    paths = tables.write_tables(built, f"{target}/tables")
    for name, path in sorted(paths.items()):
        print(f"{name}: {spark.read.parquet(path).count()} rows → {path}")
    print(f"built in {time.perf_counter() - t0:.1f}s")
    spark.stop()


if __name__ == "__main__":
    main()
