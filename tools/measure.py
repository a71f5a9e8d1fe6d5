"""
read from storage, rows out, shuffle bytes written, shuffle exchanges and
broadcast joins in the plan, and the DuckDB time of the oracle SQL.

Stage metrics come from Spark's event log, written to a fresh scratch
folder (``mktemp``-style, never the Spark UI).  Prints a markdown table.
"""

from __future__ import annotations

import glob
import io
import json
import os
import re
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

from compare import duck  # noqa: E402


def _events(folder: str):
    for path in glob.glob(os.path.join(folder, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", errors="ignore").splitlines():
            try:
                yield json.loads(line)
            except ValueError:
                continue


def stage_metrics(folder: str) -> dict[str, dict[str, int]]:
    """Per job group: records read from storage and shuffle bytes written."""
    group_of_stage, out = {}, {}
    for ev in _events(folder):
        if ev.get("Event") == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in ev.get("Stage IDs", []):
                group_of_stage[sid] = group
        elif ev.get("Event") == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            group = group_of_stage.get(info["Stage ID"])
            if group is None:
                continue
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            m = out.setdefault(group, {"rows_in": 0, "shuffle_bytes": 0})
            m["rows_in"] += int(acc.get("internal.metrics.input.recordsRead", 0) or 0)
            m["shuffle_bytes"] += int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    from pyspark.sql import SparkSession

    from bench import HEADLINE
    from spendscope.queries import ORACLE, QUERIES
    from spendscope.session import prepare

    logs = tempfile.mkdtemp(prefix="spendscope-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("spendscope-measure")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs)
             .getOrCreate())
    prepare(spark)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    QUERIES["query_cost_attribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    rows = []
    for name in HEADLINE:
        spark.sparkContext.setJobGroup(name, name)
        df = QUERIES[name](spark, sf_dir)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        secs = time.perf_counter() - t0
        spark.sparkContext.setJobGroup(f"count-{name}", "count")
        out_rows = df.count()
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges = len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning", plan))
        broadcasts = len(re.findall(r"BroadcastHashJoin|BroadcastNestedLoopJoin", plan))
        d = "-"
        if name in ORACLE:
            con.execute(ORACLE[name]).fetchall()
            t1 = time.perf_counter()
            con.execute(ORACLE[name]).fetchall()
            d = f"{time.perf_counter() - t1:.3f}"
        rows.append((name, secs, out_rows, exchanges, broadcasts, d))
    spark.stop()
    metrics = stage_metrics(logs)
    print("| query | spark s | rows in | rows out | shuffle bytes | exchanges | broadcasts | duckdb s |")
    print("|---|---|---|---|---|---|---|---|")
    for name, secs, out_rows, ex, bc, d in rows:
        m = metrics.get(name, {})
        print(f"| {name} | {secs:.2f} | {m.get('rows_in', 0)} | {out_rows} | {m.get('shuffle_bytes', 0)} | {ex} | {bc} | {d} |")


if __name__ == "__main__":
    main()
