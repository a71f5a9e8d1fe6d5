"""Data-quality checks over the attribution output.  Each returns a small
DataFrame (one row, or a top-k list) computed in one pass where possible."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from spendscope.functions.time import hour_floor
from spendscope.operators import rollups
from spendscope.operators.cost import HOUR_KEY


def check_rowcount(qca: DataFrame) -> DataFrame:
    """Statements attributed (expect > 0)."""
    return qca.agg(F.count(F.lit(1)).alias("statements_attributed"))


def check_variance(qca: DataFrame, hourly_undiscounted: DataFrame) -> DataFrame:
    """Attributed total vs raw billed total (idle hours explain a gap).

    Both totals come from one union + one global aggregate (no join of
    two one-row tables)."""
    parts = qca.select(F.lit(0).alias("__src"), F.col("attributed_cost_usd").alias("__v")).unionByName(
        hourly_undiscounted.select(F.lit(1).alias("__src"), F.col("list_cost_usd").alias("__v"))
    )
    totals = parts.agg(
        F.sum(F.when(F.col("__src") == 0, F.col("__v"))).alias("mv_total_usd"),
        F.sum(F.when(F.col("__src") == 1, F.col("__v"))).alias("raw_total_usd"),
    )
    return totals.select(
        "mv_total_usd", "raw_total_usd",
        F.try_divide(F.abs(F.col("mv_total_usd") - F.col("raw_total_usd")), F.col("raw_total_usd")).alias(
            "variance_pct"
        ),
    )


def check_bad_cost(qca: DataFrame) -> DataFrame:
    """Statements with negative or NULL cost (expect 0)."""
    c = F.col("attributed_cost_usd")
    return qca.where((c < 0) | c.isNull()).agg(F.count(F.lit(1)).alias("bad_rows"))


def check_hour_overattributed(qca: DataFrame, hourly_undiscounted: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Hours whose attributed cost (booked on each statement's start
    hour) exceeds the billed cost by more than ``tolerance``."""
    per_hour = qca.groupBy(
        "workspace_id", "warehouse_id", hour_floor(F.col("start_time")).alias("hour_start")
    ).agg(F.sum("attributed_cost_usd").alias("hour_attributed"))
    raw = hourly_undiscounted.select(*HOUR_KEY, F.col("list_cost_usd").alias("raw_hour_cost"))
    j = per_hour.join(raw, HOUR_KEY, "inner")
    return j.where(F.col("hour_attributed") > F.col("raw_hour_cost") * (1.0 + tolerance)).agg(
        F.count(F.lit(1)).alias("hours_overattributed")
    )


def check_hour_overattributed_exact(attributed_hours: DataFrame, hourly: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """J4, exact variant: uses the per-hour split (H7), so a multi-hour
    statement's cost is compared with the hours it actually ran in."""
    per_hour = attributed_hours.groupBy(*HOUR_KEY).agg(F.sum("cost_usd_in_hour").alias("hour_attributed"))
    raw = hourly.select(*HOUR_KEY, F.col("list_cost_usd").alias("raw_hour_cost"))
    j = per_hour.join(raw, HOUR_KEY, "inner")
    return j.where(F.col("hour_attributed") > F.col("raw_hour_cost") * (1.0 + tolerance)).agg(
        F.count(F.lit(1)).alias("hours_overattributed")
    )


def top_dashboards(dashboard_cost: DataFrame, k: int = 10) -> DataFrame:
    """The k most expensive dashboards (ties broken by id)."""
    return (
        dashboard_cost.where(F.col("cost_usd") > 0)
        .orderBy(F.col("cost_usd").desc(), F.col("dashboard_id"))
        .limit(k)
        .select("dashboard_name", "owner", "statements", "cost_usd", "dbus")
    )


def top_spaces(space_cost: DataFrame, k: int = 10) -> DataFrame:
    """The k most expensive spaces (ties broken by id)."""
    return (
        space_cost.where(F.col("cost_usd") > 0)
        .orderBy(F.col("cost_usd").desc(), F.col("space_id"))
        .limit(k)
        .select("genie_space_title", "creator_id", "statements", "cost_usd", "unique_users")
    )


def check_unbilled(qca: DataFrame) -> DataFrame:
    """Statements with zero or NULL cost, count and percent — one
    aggregate computes both the count and the denominator."""
    c = F.col("attributed_cost_usd")
    unbilled = (c == 0) | c.isNull()
    agg = qca.agg(
        F.sum(F.when(unbilled, 1).otherwise(0)).alias("unbilled_statements"),
        F.count(F.lit(1)).alias("__n"),
    )
    return agg.select(
        F.coalesce(F.col("unbilled_statements"), F.lit(0).cast("bigint")).alias("unbilled_statements"),
        F.try_divide(F.lit(100.0) * F.col("unbilled_statements"), F.col("__n")).alias("unbilled_pct"),
    )


def write_checked(qca: DataFrame, hourly_undiscounted: DataFrame, dashboards: DataFrame, spaces: DataFrame, path: str) -> DataFrame:
    """J1-J8 in one evaluation: the cost table is written to ``path``, and what it takes over all
    statements (counts, bad and unbilled rows, the total) is observed while it is written; the
    checks by hour, object and source read the written table.  ``hourly_undiscounted`` should be
    a written table.  One row per check and item: (check_name, item, value)."""
    cost = F.col("attributed_cost_usd")
    seen = Observation("cost_checks")
    qca.observe(
        seen, F.count(F.lit(1)).alias("statements"), F.count_if((cost < 0) | cost.isNull()).alias("bad"),
        F.count_if((cost == 0) | cost.isNull()).alias("unbilled"), F.sum(cost).alias("total"),
    ).write.parquet(path)
    found = seen.get
    written = qca.sparkSession.read.parquet(path)
    billed = hourly_undiscounted.agg(F.sum("list_cost_usd").alias("raw"))
    scalars = billed.select(F.explode(F.array(*[
        F.struct(F.lit(check).alias("check_name"), F.lit(item).alias("item"), value.cast("double").alias("value"))
        for check, item, value in (
            ("rowcount", "statements_attributed", F.lit(found["statements"])),
            ("variance", "mv_total_usd", F.lit(found["total"])),
            ("variance", "raw_total_usd", F.col("raw")),
            ("variance", "variance_pct", F.try_divide(F.abs(F.lit(found["total"]) - F.col("raw")), F.col("raw"))),
            ("bad_cost", "bad_rows", F.lit(found["bad"])),
            ("unbilled", "unbilled_statements", F.lit(found["unbilled"])),
            ("unbilled", "unbilled_pct", F.try_divide(F.lit(100.0 * found["unbilled"]), F.lit(found["statements"]))),
        )])).alias("r")).select("r.*")

    def rows(df: DataFrame, check: str, item, value) -> DataFrame:
        return df.select(F.lit(check).alias("check_name"), item.alias("item"), value.cast("double").alias("value"))

    by_source = rollups.cost_by_source_type(written)
    parts = [
        rows(check_hour_overattributed(written, hourly_undiscounted), "hour_overattributed", F.lit("hours_overattributed"), F.col("hours_overattributed")),
        rows(top_dashboards(rollups.dashboard_cost(dashboards, written)), "top_dashboards", F.col("dashboard_name"), F.col("cost_usd")),
        rows(top_spaces(rollups.space_cost(spaces, written)), "top_spaces", F.col("genie_space_title"), F.col("cost_usd")),
        rows(by_source, "coverage", F.col("source_type"), F.col("pct_of_total")),
    ]
    for p in parts:
        scalars = scalars.unionByName(p)
    return scalars
