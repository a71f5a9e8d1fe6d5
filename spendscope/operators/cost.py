"""Uptime-cost attribution to statements.

The bill is per (workspace, warehouse, hour).  Each statement's work
(compile + execute + fetch ms) is split over the hours it spans in
proportion to wall-clock overlap; each billed hour is shared among the
statements active in it in proportion to their work in that hour; the
hour rows are then summed back to one row per statement.

Plan shape (see ``README.md``):

* usage ⋈ prices: a price list counted small is broadcast, with the validity
  range as residual; a larger one is joined by time bins, heavy SKUs split
  (``plans.skew.interval_left_join``).  Usage is aggregated to hour grain.
* statements → statement-hours: a narrow ``explode`` (no shuffle).
* hour totals: ``groupBy`` with map-side partial aggregation, so a busy
  warehouse-hour (one hot key) never lands whole in one task.
* hour totals ⋈ hourly cost → ``hour_rates`` (one row per active
  warehouse-hour), written once to the shared checkpoint folder.  Counted
  small, it is broadcast: the statement-hours stay in their scan partitions
  and the final per-statement ``groupBy`` collapses each statement's hours in
  its partial aggregate before the one remaining shuffle.  Beyond the bound
  the statement-hours shuffle to it, the hours that its own statement counts
  show to be heavy split into buckets.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.functions.time import epoch_seconds, one_hour, hour_floor, lookback_start, ntz_literal
from spendscope.plans.joins import DEFAULT_MAX_BROADCAST_ROWS, has_at_most, materialize, salted_left_join
from spendscope.plans.skew import heavy_keys, interval_left_join, spread_left_join

HOUR_KEY = ["workspace_id", "warehouse_id", "hour_start"]

# The statement columns of the cost table.
STATEMENT_COLUMNS = [
    "statement_id", "workspace_id", "executed_by", "warehouse_id",
    "dashboard_id", "genie_space_id", "notebook_id", "alert_id", "job_id",
    "client_application",
]

ATTRIBUTION_COLUMNS = STATEMENT_COLUMNS + [
    "start_time", "end_time", "work_ms", "attributed_cost_usd", "attributed_dbus",
]


def discount_factor(discount_pct: float) -> float:
    """``max(0, 1 - pct/100)``: a negative pct is a surcharge, > 100 is free."""
    return max(0.0, 1.0 - float(discount_pct) / 100.0)


# --------------------------------------------------------------------- H2
def partition_bound(df: DataFrame, date_col: str | None, since: dt.datetime) -> DataFrame:
    """For a table partitioned by a DATE column: add the bound implied by a
    timestamp lower bound, so whole partitions are skipped before any file
    is opened (a filter on the timestamp column alone cannot prune them)."""
    if not date_col:
        return df
    return df.where(F.col(date_col) >= F.lit(since.date()))


def hourly_cost(
    usage: DataFrame,
    prices: DataFrame,
    as_of: dt.datetime,
    window_days: int = 365,
    discount_pct: float = 0.0,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    partition_date_col: str | None = None,
) -> DataFrame:
    """DBUs and (discounted) cost per (workspace, warehouse, hour).

    ``usage``: workspace_id, warehouse_id, cloud, sku_name,
    billing_origin_product, usage_start_time, usage_quantity.
    ``prices``: cloud, sku_name, price_start_time, price_end_time, price_usd.
    A usage row without a matching price costs 0 but keeps its DBUs.
    """
    cutoff = ntz_literal(lookback_start(as_of, window_days))
    u = partition_bound(usage, partition_date_col, lookback_start(as_of, window_days)).where(
        (F.col("billing_origin_product") == "SQL")
        & F.col("warehouse_id").isNotNull()
        & (F.col("usage_start_time") >= cutoff)
    ).select("workspace_id", "warehouse_id", "cloud", "sku_name", "usage_start_time", "usage_quantity")
    p = prices.select(
        F.col("cloud").alias("p_cloud"), F.col("sku_name").alias("p_sku_name"),
        "price_start_time", "price_end_time", "price_usd",
    )
    if has_at_most(prices, max_broadcast_rows):
        held = (
            (F.col("cloud") == F.col("p_cloud")) & (F.col("sku_name") == F.col("p_sku_name"))
            & (F.col("usage_start_time") >= F.col("price_start_time"))
            & (F.col("price_end_time").isNull() | (F.col("usage_start_time") < F.col("price_end_time")))
        )
        priced = u.join(F.broadcast(p), held, "left")
    else:
        # equal records are summed before they move; what is left is dealt by (SKU, time bin)
        u = u.groupBy("workspace_id", "warehouse_id", "cloud", "sku_name", "usage_start_time").agg(
            F.sum("usage_quantity").alias("usage_quantity"))
        p = p.withColumnsRenamed({"p_cloud": "cloud", "p_sku_name": "sku_name"})
        priced = interval_left_join(u, p, ["cloud", "sku_name"], "usage_start_time", "price_start_time", "price_end_time")
    factor = discount_factor(discount_pct)
    return priced.groupBy(
        "workspace_id", "warehouse_id", hour_floor(F.col("usage_start_time")).alias("hour_start")
    ).agg(
        F.sum("usage_quantity").alias("dbus"),
        (F.sum(F.col("usage_quantity") * F.coalesce(F.col("price_usd"), F.lit(0.0))) * F.lit(factor)).alias(
            "list_cost_usd"
        ),
    )


# --------------------------------------------------------------------- H3
def work_ms(c: str = "compilation_duration_ms", e: str = "execution_duration_ms",
            r: str = "result_fetch_duration_ms") -> Column:
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.col(c), zero) + F.coalesce(F.col(e), zero) + F.coalesce(F.col(r), zero)


def statements(query_history: DataFrame, as_of: dt.datetime, window_days: int = 365,
               partition_date_col: str | None = None) -> DataFrame:
    """Finished warehouse statements that started in the window and ended.
    ``partition_date_col`` names a DATE partition column of the history
    (derived from ``start_time``) to prune on."""
    cutoff = ntz_literal(lookback_start(as_of, window_days))
    qh = partition_bound(query_history, partition_date_col, lookback_start(as_of, window_days))
    return qh.where(
        F.col("warehouse_id").isNotNull()
        & (F.col("start_time") >= cutoff)
        & (F.col("execution_status") == "FINISHED")
        & F.col("end_time").isNotNull()
    ).select(*STATEMENT_COLUMNS, "start_time", "end_time", work_ms().alias("work_ms"))


# --------------------------------------------------------------------- H4
def statement_hours(stmts: DataFrame) -> DataFrame:
    """One row per statement and clock hour it touches, both ends inclusive
    (a statement ending exactly on the hour gets a zero-width last hour).

    An end before the start would make ``sequence`` fail in Spark; the
    stop is ``greatest(start, end)`` so such a statement keeps one hour.
    """
    start_h = hour_floor(F.col("start_time"))
    stop_h = hour_floor(F.greatest(F.col("start_time"), F.col("end_time")))
    return stmts.select("*", F.explode(F.sequence(start_h, stop_h, one_hour())).alias("hour_start"))


# --------------------------------------------------------------------- H5
def work_in_hour() -> Column:
    """Work prorated by the second-granularity overlap with the hour; a
    statement with no positive duration puts all its work in each row."""
    dur = epoch_seconds(F.col("end_time")) - epoch_seconds(F.col("start_time"))
    overlap = epoch_seconds(F.least(F.col("end_time"), F.col("hour_start") + one_hour())) - epoch_seconds(
        F.greatest(F.col("start_time"), F.col("hour_start"))
    )
    return F.when(dur <= 0, F.col("work_ms").cast("double")).otherwise(F.col("work_ms") * overlap / dur)


def statement_hour_work(stmt_hours: DataFrame) -> DataFrame:
    return stmt_hours.withColumn("work_ms_in_hour", work_in_hour())


# --------------------------------------------------------------------- H6
def hour_totals(stmt_hour_work: DataFrame) -> DataFrame:
    """Total work and statements per (workspace, warehouse, hour); partial aggregation
    runs map-side, so skew in a busy hour is absorbed before the shuffle."""
    return stmt_hour_work.groupBy(*HOUR_KEY).agg(
        F.sum("work_ms_in_hour").alias("total_work_ms_in_hour"), F.count(F.lit(1)).alias("statements_in_hour"))


def hour_rates(totals: DataFrame, hourly: DataFrame) -> DataFrame:
    """Hours with at least one statement, with their total work and bill
    (an hour without statements is idle and is not attributed)."""
    return totals.join(hourly, HOUR_KEY, "left")


# --------------------------------------------------------------------- H7
def attribute_hours(
    stmt_hour_work: DataFrame,
    rates: DataFrame,
    salt_buckets: int = 0,
    written: bool = False,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Cost and DBUs per statement-hour: share of the hour's work times
    the hour's bill.  No bill → 0; zero or unknown total work → NULL.

    ``rates`` holds total work and bill per hour key.  When it is ``written``, it is
    counted: up to ``max_broadcast_rows`` it is broadcast, beyond them the heavy hours
    are split by the statements counted in them.  Otherwise the join carries no hint
    (``salt_buckets`` deals every hour to that many buckets)."""
    if written and salt_buckets <= 1:
        if has_at_most(rates, max_broadcast_rows, written=True):
            joined = stmt_hour_work.join(F.broadcast(rates.drop("statements_in_hour")), HOUR_KEY, "left")
        else:
            heavy = heavy_keys(rates, HOUR_KEY, "statements_in_hour")
            joined = spread_left_join(stmt_hour_work, rates.drop("statements_in_hour"), HOUR_KEY, heavy, ["statement_id", "start_time"])
    else:
        joined = salted_left_join(stmt_hour_work, rates, HOUR_KEY, salt_buckets, ["statement_id", "hour_start"])
    share = F.try_divide(F.col("work_ms_in_hour"), F.col("total_work_ms_in_hour"))
    return joined.select(
        *STATEMENT_COLUMNS, "start_time", "end_time", "work_ms", "hour_start", "work_ms_in_hour",
        (share * F.coalesce(F.col("list_cost_usd"), F.lit(0.0))).alias("cost_usd_in_hour"),
        (share * F.coalesce(F.col("dbus"), F.lit(0.0))).alias("dbus_in_hour"),
    )


# --------------------------------------------------------------------- H8
def roll_up_statements(attributed: DataFrame) -> DataFrame:
    return attributed.groupBy(*STATEMENT_COLUMNS).agg(
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.max("work_ms").alias("work_ms"),
        F.sum("cost_usd_in_hour").alias("attributed_cost_usd"),
        F.sum("dbus_in_hour").alias("attributed_dbus"),
    )


def query_cost_attribution(
    query_history: DataFrame,
    usage: DataFrame,
    prices: DataFrame,
    as_of: dt.datetime,
    window_days: int = 365,
    discount_pct: float = 0.0,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    salt_buckets: int = 0,
    materialize_rates: bool = True,
    history_date_col: str | None = None,
    usage_date_col: str | None = None,
    hourly: DataFrame | None = None,
) -> DataFrame:
    """Per-statement attributed cost (the whole H2-H8 chain).

    ``history_date_col`` / ``usage_date_col`` name DATE partition columns
    of the inputs for partition pruning on the lookback window.

    The hour-rate table (one row per active warehouse-hour) is written once to the
    shared checkpoint folder and joined to the statement-hours by its measured size
    (``materialize_rates=False`` leaves the join to Spark's estimates).  A caller that
    has the hourly bill passes it as ``hourly``.
    """
    if hourly is None:
        hourly = hourly_cost(usage, prices, as_of, window_days, discount_pct, max_broadcast_rows, usage_date_col)
    stmts = statements(query_history, as_of, window_days, history_date_col)
    shw = statement_hour_work(statement_hours(stmts))
    rates = hour_rates(hour_totals(shw), hourly)
    if materialize_rates:
        rates = materialize(rates, "hour_rates")
    attributed = attribute_hours(shw, rates, salt_buckets, materialize_rates, max_broadcast_rows)
    return roll_up_statements(attributed).select(*ATTRIBUTION_COLUMNS)
