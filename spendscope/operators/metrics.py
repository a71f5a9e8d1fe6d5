"""Semantic layer over query history: named dimensions and measures,
aggregated at whatever grain the caller asks for.

``metric_base`` derives the per-statement columns (times in integer ms,
sizes in bytes, flags).  ``measure_states`` aggregates them once, at a grain
of dimensions, into states that can be merged:

* a histogram ``duration_ms → statements``, each of its rows with the sums,
  counts and flag counts of those statements;
* the distinct users and the distinct warehouses, as rows.

Every measure at that grain or a coarser one comes from these rows alone:
sums add up, distinct values are counted again, and exact percentiles
(linear interpolation between closest ranks, as PERCENTILE_CONT) are read
off the merged histogram.  States written by the caller answer any number of
queries at their grain or a coarser one (``query_states``); for a single one,
``QUERY_HISTORY_METRICS.query(base, by=[...])`` aggregates the sums and the
values apart, so that the many rows of values stay narrow.

Sums are taken over integer ms/bytes and converted to seconds/GB after
aggregation, so they are exact and independent of summation order.  All
aggregates have map-side partials, and no task holds a whole group: a
percentile first finds, among at most a few thousand logarithmic buckets of
values, those that hold its ranks, and only their values are sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GB = float(1024 ** 3)
TB = float(1024 ** 4)
BUCKETS_PER_DOUBLING = 64  # logarithmic buckets of a histogram's values

# What the states of a group of statements hold, beside the count.
SUMS = ["compilation_ms", "execution_ms", "result_fetch_ms", "compute_wait_ms", "capacity_wait_ms", "read_bytes",
        "written_bytes", "shuffle_bytes", "spill_bytes", "read_rows", "produced_rows"]
FLAGS = ["is_slow_query", "is_very_slow_query", "has_disk_spill", "is_cached", "is_failed", "had_long_wait",
         "has_poor_scan_efficiency"]
MEANS = ["wait_pct_of_total", "scan_to_output_ratio"]
DISTINCT = {"user": "executed_by", "warehouse": "warehouse_id"}


def _bucket(v: Column) -> Column:
    """A number that never falls as ``v`` grows."""
    size = F.floor(F.log2(F.abs(v) + 1) * BUCKETS_PER_DOUBLING)
    return F.when(v < 0, -size).otherwise(size)


def percentiles_of_histogram(hist: DataFrame, by: Sequence[str], value: str, n: str, ps: dict[str, float]) -> DataFrame:
    """Exact percentiles per ``by`` group of ``hist`` (one row a group and value, ``n`` its count).

    1. counts per logarithmic bucket of values, at most a few thousand a group;
    2. running counts over the buckets give the buckets that hold a rank floor or
       ceil of (n - 1)·p;
    3. running counts over the values of those buckets give the values at the ranks,
       interpolated as ``(hi_rank - pos)·v_lo + (pos - lo_rank)·v_hi``."""
    keys = list(by) or ["__g"]
    src = hist if by else hist.withColumn("__g", F.lit(0))
    src = src.select(*keys, F.col(value).cast("double").alias("__v"), F.col(n).alias("__c")).withColumn("__b", _bucket(F.col("__v")))
    total = F.col("__n").cast("double")
    ranks = [r for p in ps.values() for r in (F.floor((total - 1) * F.lit(float(p))), F.ceil((total - 1) * F.lit(float(p))))]

    def holds_any(first: Column, last: Column) -> Column:
        found = F.lit(False)
        for r in ranks:
            found = found | ((first <= r) & (r <= last))
        return found

    group = Window.partitionBy(*keys)
    upto = group.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = src.groupBy(*keys, "__b").agg(F.sum("__c").alias("__bc")) \
        .withColumns({"__n": F.sum("__bc").over(group), "__off": F.sum("__bc").over(upto) - F.col("__bc")})
    hit = buckets.where(holds_any(F.col("__off"), F.col("__off") + F.col("__bc") - 1)) \
        .select(*[F.col(k).alias(f"__h_{k}") for k in keys], F.col("__b").alias("__hb"), "__n", "__off")
    same = F.col("__b") == F.col("__hb")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__h_{k}"))
    inside = Window.partitionBy(*keys, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = src.join(hit, same).withColumn("__last", F.col("__off") + F.sum("__c").over(inside) - 1) \
        .withColumn("__first", F.col("__last") - F.col("__c") + 1)
    picks = [F.min(F.when((F.col("__first") <= r) & (r <= F.col("__last")), F.col("__v"))).alias(f"__r{i}") for i, r in enumerate(ranks)]
    picked = ranked.groupBy(*keys).agg(F.max("__n").alias("__n"), *picks)
    out = []
    for i, (name, p) in enumerate(ps.items()):
        pos, lo, hi = (total - 1) * F.lit(float(p)), F.col(f"__r{2 * i}"), F.col(f"__r{2 * i + 1}")
        between = (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi
        out.append(F.when((F.ceil(pos) == F.floor(pos)) | (lo == hi), lo).otherwise(between).alias(name))
    return picked.select(*by, *out)


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str, ps: dict[str, float]) -> DataFrame:
    """Exact percentiles of ``value`` per ``by`` group, with no task holding a whole
    group: one row per group with a column per name in ``ps``."""
    v = F.col(value).cast("double")
    hist = df.where(F.col(value).isNotNull()).groupBy(*by, v.alias("__value")).agg(F.count(F.lit(1)).alias("__count"))
    return percentiles_of_histogram(hist, by, "__value", "__count", ps)


def metric_base(history: DataFrame) -> DataFrame:
    """Per-statement metric columns."""
    c = F.col
    zero = F.lit(0).cast("bigint")
    compile_ms = F.coalesce(c("compilation_duration_ms"), zero)
    exec_ms = F.coalesce(c("execution_duration_ms"), zero)
    fetch_ms = F.coalesce(c("result_fetch_duration_ms"), zero)
    cw_ms = F.coalesce(c("waiting_for_compute_duration_ms"), zero)
    cap_ms = F.coalesce(c("waiting_at_capacity_duration_ms"), zero)
    duration_ms = compile_ms + exec_ms + fetch_ms + cw_ms + cap_ms

    def source_id(name: str) -> Column:
        """A source's id where the history has it (older exports lack some)."""
        return (c(name) if name in history.columns else F.lit(None)).cast("string").alias(name)

    # The source labels of the query-history metric view.
    source_type = (
        F.when(c("dashboard_id").isNotNull(), "AI/BI Dashboard")
        .when(c("genie_space_id").isNotNull(), "Genie Space")
        .when(c("notebook_id").isNotNull(), "Notebook")
        .when(c("alert_id").isNotNull(), "Alert")
        .when(c("job_id").isNotNull(), "Job")
        .otherwise("Other")
    )
    app = F.lower(F.coalesce(c("client_application"), F.lit("")))
    ratio = F.try_divide(c("read_rows").cast("double"), F.nullif(c("produced_rows"), F.lit(0)).cast("double"))
    return history.select(
        c("start_time"),
        F.to_date(c("start_time")).alias("query_date"),
        F.hour(c("start_time")).alias("query_hour"),
        F.dayofweek(c("start_time")).alias("day_of_week"),
        "executed_by", "warehouse_id", "account_id", "workspace_id",
        "statement_type", "execution_status", "compute_type",
        source_type.alias("query_source_type"), "client_application",
        "notebook_id", "dashboard_id", source_id("legacy_dashboard_id"),
        "job_id", "alert_id", "genie_space_id",
        source_id("pipeline_id"), source_id("sql_query_id"),
        duration_ms.alias("duration_ms"),
        compile_ms.alias("compilation_ms"), exec_ms.alias("execution_ms"), fetch_ms.alias("result_fetch_ms"),
        cw_ms.alias("compute_wait_ms"), cap_ms.alias("capacity_wait_ms"),
        F.try_divide((cw_ms + cap_ms).cast("double") * 100, duration_ms.cast("double")).alias("wait_pct_of_total"),
        c("read_bytes"), c("written_bytes"), c("shuffle_read_bytes").alias("shuffle_bytes"),
        c("spilled_local_bytes").alias("spill_bytes"), c("read_rows"), c("produced_rows"),
        ratio.alias("scan_to_output_ratio"),
        (duration_ms > 60000).alias("is_slow_query"),
        (duration_ms > 300000).alias("is_very_slow_query"),
        (F.coalesce(c("spilled_local_bytes"), zero) > 0).alias("has_disk_spill"),
        F.coalesce(c("from_result_cache"), F.lit(False)).alias("is_cached"),
        (c("execution_status") == "FAILED").alias("is_failed"),
        ((cw_ms > 30000) | (cap_ms > 30000)).alias("had_long_wait"),
        F.coalesce(ratio >= 1000, F.lit(False)).alias("has_poor_scan_efficiency"),
        app.contains("tableau").alias("is_tableau"),
        app.contains("power bi").alias("is_power_bi"),
        app.contains("dbt").alias("is_dbt"),
    )


def _cells(base: DataFrame, dims: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Each statement as its duration and its distinct values, one row each: kind, number, text."""
    cells = [F.struct(F.lit("duration").alias("kind"), F.col("duration_ms").alias("number"), F.lit(None).cast("string").alias("text"))]
    cells += [F.struct(F.lit(k).alias("kind"), F.lit(None).cast("bigint").alias("number"), F.col(c).alias("text"))
              for k, c in DISTINCT.items()]
    return base.select(*[F.col(d).alias(f"__{d}") for d in dims], *extra, F.explode(F.array(*cells)).alias("c"))


def _cell_keys(dims: Sequence[str]) -> list:
    return [*[F.col(f"__{d}").alias(d) for d in dims], "c.kind", "c.number", "c.text"]


def measure_states(base: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Mergeable states of the statements in ``base`` per ``dims`` (columns of ``base``): rows of
    kind ``duration`` (``number``: duration_ms; n, sums, flag counts of its statements) and
    of the kinds of ``DISTINCT`` (``text``: a value).  One scan, one shuffle."""
    rows = _cells(base, dims, [*SUMS, *FLAGS, *MEANS])
    own = F.col("c.kind") == "duration"
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(F.when(own, F.col(c))).alias(c) for c in [*SUMS, *MEANS]]
    aggs += [F.count(F.when(own, F.col(c))).alias(f"{c}_n") for c in MEANS]
    aggs += [F.count_if(own & F.col(c)).alias(f"{c}_rows") for c in FLAGS]
    return rows.groupBy(*_cell_keys(dims)).agg(*aggs)


@dataclass
class MetricSet:
    dimensions: dict[str, tuple[str, str]] = field(default_factory=dict)  # id -> (display, column)
    measures: dict[str, tuple[str, Callable[[], Column]]] = field(default_factory=dict)  # over merged states
    percentile_measures: dict[str, float] = field(default_factory=dict)  # id -> p over duration_ms
    distinct_measures: dict[str, str] = field(default_factory=dict)  # id -> kind of state

    def dimension(self, ident: str, display: str, column: str) -> None:
        self.dimensions[ident] = (display, column)

    def measure(self, ident: str, display: str, build: Callable[[], Column]) -> None:
        self.measures[ident] = (display, build)

    def query(
        self,
        base: DataFrame,
        by: Sequence[str] = (),
        measures: Sequence[str] | None = None,
        where: Column | None = None,
    ) -> DataFrame:
        """Measures (all by default) at the grain of the ``by`` dimensions."""
        df = base if where is None else base.where(where)
        columns = [self.dimensions[d][1] for d in by]
        adds = [F.count(F.lit(1)).alias("n"), F.sum("duration_ms").alias("duration_total_ms"), F.max("duration_ms").alias("max_duration_ms")]
        adds += [F.sum(c).alias(f"{c}_sum") for c in [*SUMS, *MEANS]] + [F.count(c).alias(f"{c}_n") for c in MEANS]
        adds += [F.count_if(F.col(c)).alias(f"{c}_rows") for c in FLAGS]
        sums = (df.groupBy(*columns) if columns else df).agg(*adds)
        # the values themselves in a second, narrow aggregate of three columns of the base
        values = _cells(df, columns).groupBy(*_cell_keys(columns)).agg(F.count(F.lit(1)).alias("n"))
        out = self._measures(sums, values, columns, measures, merged=True)
        return out.withColumnsRenamed(dict(zip(columns, by)))

    def query_states(self, states: DataFrame, by: Sequence[str] = (), measures: Sequence[str] | None = None) -> DataFrame:
        """Measures per ``by`` (columns of the states, as many or fewer than they have), from
        written ``measure_states`` alone."""
        own = states.where(F.col("kind") == "duration")
        adds = [F.sum("n").alias("n"), F.sum(F.col("number") * F.col("n")).alias("duration_total_ms"), F.max("number").alias("max_duration_ms")]
        adds += [F.sum(c).alias(f"{c}_sum") for c in [*SUMS, *MEANS]]
        adds += [F.sum(c).alias(c) for c in [*[f"{c}_rows" for c in FLAGS], *[f"{c}_n" for c in MEANS]]]
        return self._measures((own.groupBy(*by) if by else own).agg(*adds), states, list(by), measures, merged=False)

    def _measures(self, sums: DataFrame, states: DataFrame, by: list[str], measures: Sequence[str] | None, merged: bool) -> DataFrame:
        """The measures from the sums per group and the values in ``states``; ``merged`` says that
        these have no other dimensions."""
        names = list(self.measures) if measures is None else list(measures)
        out, parts = sums, []
        percent = {m: p for m, p in self.percentile_measures.items() if m in names}
        if percent:
            hist = states.where(F.col("kind") == "duration")
            hist = hist if merged else hist.groupBy(*by, "number").agg(F.sum("n").alias("n"))
            parts.append(percentiles_of_histogram(hist, by, "number", "n", {f"__{m}": p for m, p in percent.items()}))
        distinct = {m: k for m, k in self.distinct_measures.items() if m in names}
        if distinct:
            kinds = states.where(F.col("kind").isin(*distinct.values()) & F.col("text").isNotNull()).select(*by, "kind", "text")
            kinds = kinds if merged else kinds.distinct()
            counts = [F.count_if(F.col("kind") == k).alias(f"__{m}") for m, k in distinct.items()]
            parts.append((kinds.groupBy(*by) if by else kinds).agg(*counts))
        for i, part in enumerate(parts):  # one row a group on both sides; NULL dimension values match
            part = part.select(*[F.col(k).alias(f"__{i}_{k}") for k in by], *[c for c in part.columns if c not in by])
            same = F.lit(True)
            for k in by:
                same = same & F.col(k).eqNullSafe(F.col(f"__{i}_{k}"))
            out = out.join(part, same, "left")
        return out.select(*by, *[self.measures[m][1]().alias(m) for m in names])


def _r(x: Column, d: int = 2) -> Column:
    return F.round(x, d)


def _flag_count(col: str) -> Callable[[], Column]:
    return lambda: F.coalesce(F.col(f"{col}_rows"), F.lit(0).cast("bigint"))


def _mean(col: str, count: str = "n") -> Column:
    return F.try_divide(F.col(col).cast("double"), F.col(count).cast("double"))


def _sum(col: str) -> Column:
    return F.col(f"{col}_sum")


def _rate(col: str) -> Callable[[], Column]:
    return lambda: _r(_mean(f"{col}_rows") * 100)


def _pct(ident: str) -> Callable[[], Column]:
    return lambda: _r(F.col(f"__{ident}") / 1000)


def _build_query_history_metrics() -> MetricSet:
    m = MetricSet()
    # The dimension names of the query-history metric view.
    for ident, display, col in [
        ("start_time", "Start Time", "start_time"), ("query_date", "Query Date", "query_date"),
        ("query_hour", "Query Hour", "query_hour"), ("day_of_week", "Day of Week", "day_of_week"),
        ("executed_by", "Executed By", "executed_by"), ("warehouse_id", "Warehouse ID", "warehouse_id"),
        ("account_id", "Account ID", "account_id"), ("workspace_id", "Workspace ID", "workspace_id"),
        ("statement_type", "Statement Type", "statement_type"),
        ("execution_status", "Execution Status", "execution_status"),
        ("compute_type", "Compute Type", "compute_type"),
        ("query_source_type", "Query Source Type", "query_source_type"),
        ("client_application", "Client Application", "client_application"),
        ("notebook_id", "Notebook ID", "notebook_id"), ("dashboard_id", "Dashboard ID", "dashboard_id"),
        ("legacy_dashboard_id", "Legacy Dashboard ID", "legacy_dashboard_id"), ("job_id", "Job ID", "job_id"),
        ("alert_id", "Alert ID", "alert_id"), ("genie_space_id", "Genie Space ID", "genie_space_id"),
        ("pipeline_id", "Pipeline ID", "pipeline_id"), ("sql_query_id", "SQL Query ID", "sql_query_id"),
        ("is_slow_query", "Is Slow Query", "is_slow_query"),
        ("is_very_slow_query", "Is Very Slow Query", "is_very_slow_query"),
        ("has_disk_spill", "Has Disk Spill", "has_disk_spill"), ("is_cached", "Is Cached", "is_cached"),
        ("is_failed", "Is Failed", "is_failed"), ("had_long_wait", "Had Long Wait", "had_long_wait"),
        ("has_poor_scan_efficiency", "Has Poor Scan Efficiency", "has_poor_scan_efficiency"),
        ("is_tableau", "Is Tableau", "is_tableau"), ("is_power_bi", "Is Power BI", "is_power_bi"),
        ("is_dbt", "Is dbt", "is_dbt"),
    ]:
        m.dimension(ident, display, col)

    # The measure names of the query-history metric view.
    m.measure("total_queries", "Total Queries", lambda: F.coalesce(F.col("n"), F.lit(0).cast("bigint")))
    m.measure("unique_users", "Unique Users", lambda: F.coalesce(F.col("__unique_users"), F.lit(0).cast("bigint")))
    m.measure("warehouses_used", "Warehouses Used", lambda: F.coalesce(F.col("__warehouses_used"), F.lit(0).cast("bigint")))
    m.measure("total_duration_sec", "Total Duration Sec", lambda: F.col("duration_total_ms") / 1000)
    m.measure("avg_duration_sec", "Avg Duration Sec", lambda: _r(_mean("duration_total_ms") / 1000))
    m.measure("max_duration_sec", "Max Duration Sec", lambda: _r(F.col("max_duration_ms") / 1000))
    m.measure("p50_duration_sec", "P50 Duration Sec", _pct("p50_duration_sec"))
    m.measure("p95_duration_sec", "P95 Duration Sec", _pct("p95_duration_sec"))
    m.measure("p99_duration_sec", "P99 Duration Sec", _pct("p99_duration_sec"))
    m.distinct_measures.update({"unique_users": "user", "warehouses_used": "warehouse"})
    m.percentile_measures.update({"p50_duration_sec": 0.50, "p95_duration_sec": 0.95, "p99_duration_sec": 0.99})
    m.measure("total_compute_wait_sec", "Total Compute Wait Sec", lambda: _r(_sum("compute_wait_ms") / 1000))
    m.measure("total_capacity_wait_sec", "Total Capacity Wait Sec", lambda: _r(_sum("capacity_wait_ms") / 1000))
    m.measure("avg_wait_pct", "Avg Wait Pct", lambda: _r(_mean("wait_pct_of_total_sum", "wait_pct_of_total_n")))
    m.measure("avg_compilation_sec", "Avg Compilation Sec", lambda: _r(_mean("compilation_ms_sum") / 1000))
    m.measure("avg_execution_sec", "Avg Execution Sec", lambda: _r(_mean("execution_ms_sum") / 1000))
    m.measure("avg_result_fetch_sec", "Avg Result Fetch Sec", lambda: _r(_mean("result_fetch_ms_sum") / 1000))
    m.measure("total_read_gb", "Total Read GB", lambda: _r(_sum("read_bytes") / GB))
    m.measure("total_read_tb", "Total Read TB", lambda: _r(_sum("read_bytes") / TB, 4))
    m.measure("total_written_gb", "Total Written GB", lambda: _r(_sum("written_bytes") / GB))
    m.measure("total_shuffle_gb", "Total Shuffle GB", lambda: _r(_sum("shuffle_bytes") / GB))
    m.measure("total_spill_gb", "Total Spill GB", lambda: _r(_sum("spill_bytes") / GB))
    m.measure("total_read_rows", "Total Read Rows", lambda: _sum("read_rows"))
    m.measure("total_produced_rows", "Total Produced Rows", lambda: _sum("produced_rows"))
    m.measure("avg_scan_to_output_ratio", "Avg Scan to Output Ratio", lambda: _r(_mean("scan_to_output_ratio_sum", "scan_to_output_ratio_n")))
    m.measure("slow_query_count", "Slow Query Count", _flag_count("is_slow_query"))
    m.measure("very_slow_query_count", "Very Slow Query Count", _flag_count("is_very_slow_query"))
    m.measure("spill_query_count", "Spill Query Count", _flag_count("has_disk_spill"))
    m.measure("cached_query_count", "Cached Query Count", _flag_count("is_cached"))
    m.measure("failed_query_count", "Failed Query Count", _flag_count("is_failed"))
    m.measure("long_wait_query_count", "Long Wait Query Count", _flag_count("had_long_wait"))
    m.measure("poor_scan_query_count", "Poor Scan Query Count", _flag_count("has_poor_scan_efficiency"))
    m.measure("cache_hit_rate_pct", "Cache Hit Rate Pct", _rate("is_cached"))
    m.measure("failure_rate_pct", "Failure Rate Pct", _rate("is_failed"))
    m.measure("spill_rate_pct", "Spill Rate Pct", _rate("has_disk_spill"))
    return m


QUERY_HISTORY_METRICS = _build_query_history_metrics()
