"""bench.py prints exactly one JSON line with every headline query (driver contract)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPEAT="1", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    from bench import HEADLINE

    assert doc["unit"] == "sec" and doc["sf"] == 0.001 and set(doc["queries"]) == set(HEADLINE)
    assert abs(doc["value"] - sum(doc["queries"].values())) < 0.01


def test_source_queries_work_from_any_working_directory(tmp_path):
    """The landing source runs in Python workers: they must import the
    package even when the driver process starts outside the repository."""
    script = (
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('entry', {os.path.join(ROOT, '__spark_entry__.py')!r})\n"
        "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.ui.showConsoleProgress', 'false').getOrCreate()\n"
        "q = m.queries()\n"
        "print('ROWS', q['snapshot_source_scan'](s, '/root/testdata/sf0.001').count(),"
        " q['snapshot_source_jsonl'](s, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    line = [x for x in out.stdout.splitlines() if x.startswith("ROWS")][0]
    scan, jsonl = map(int, line.split()[1:])
    assert scan > 0 and jsonl > scan
