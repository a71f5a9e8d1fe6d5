"""Time the oracle SQL of the benchmark queries in DuckDB (single node) at
$BENCH_SF_DIR, as a point of comparison for bench.py.  Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from compare import duck  # noqa: E402
from spendscope.queries import ORACLE  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    threads = int(os.environ.get("BENCH_CPUS", "8"))
    con = duck(sf_dir)
    con.execute(f"SET threads = {threads}")
    out = {}
    for name in HEADLINE:
        if name not in ORACLE:
            continue
        con.execute(ORACLE[name]).fetchall()  # warm
        t0 = time.perf_counter()
        con.execute(ORACLE[name]).fetchall()
        out[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "duckdb_total_seconds", "value": round(sum(out.values()), 3), "queries": out}))


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    main()
