"""Usage enrichment of the dashboard inventory (audit log + query history)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.functions.time import first_date_on_or_after, lookback_start, ntz_literal

PUBLISHED = "getPublishedDashboard"
DRAFT = "getDashboard"


def dashboard_views(audit: DataFrame, as_of: dt.datetime, window_days: int = 30) -> DataFrame:
    """Views and distinct viewers per dashboard, published vs draft.

    ``audit``: event_date (DATE), action_name, dashboard_id, email.  The
    cutoff is a timestamp; a DATE compares as its midnight, so the filter
    becomes a plain date bound that reaches the parquet scan.
    """
    first_day = first_date_on_or_after(lookback_start(as_of, window_days))
    a = audit.where(
        (F.col("event_date") >= F.lit(first_day))
        & F.col("action_name").isin(PUBLISHED, DRAFT)
        & F.col("dashboard_id").isNotNull()
    )
    pub = F.col("action_name") == PUBLISHED
    draft = F.col("action_name") == DRAFT
    return a.groupBy("dashboard_id").agg(
        F.sum(F.when(pub, 1).otherwise(0)).alias("published_l30d"),
        F.countDistinct(F.when(pub, F.col("email"))).alias("published_users_l30d"),
        F.sum(F.when(draft, 1).otherwise(0)).alias("draft_l30d"),
        F.countDistinct(F.when(draft, F.col("email"))).alias("draft_users_l30d"),
    )


def dashboard_query_load(query_history: DataFrame, as_of: dt.datetime, window_days: int = 30) -> DataFrame:
    """Statements (any status) and task time per dashboard in the window."""
    cutoff = ntz_literal(lookback_start(as_of, window_days))
    q = query_history.where((F.col("start_time") >= cutoff) & F.col("dashboard_id").isNotNull())
    return q.groupBy("dashboard_id").agg(
        F.coalesce(F.sum("total_task_duration_ms"), F.lit(0).cast("bigint")).alias("total_task_duration_l30d"),
        F.count("statement_id").alias("count_queries_l30d"),
    )


VIEW_FIELDS = ["published_l30d", "published_users_l30d", "draft_l30d", "draft_users_l30d"]


def dashboard_denormalized(
    dashboards: DataFrame,
    audit: DataFrame,
    query_history: DataFrame,
    as_of: dt.datetime,
    window_days: int = 30,
) -> DataFrame:
    """Current dashboards + 30-day load + ``views`` struct (NULL when never
    viewed).  Both facts are aggregated to one row per dashboard before the
    joins, so the joins never fan out and a hot dashboard is absorbed by
    partial aggregation."""
    load = dashboard_query_load(query_history, as_of, window_days)
    views = dashboard_views(audit, as_of, window_days).select(
        "dashboard_id", F.struct(*VIEW_FIELDS).alias("views")
    )
    return (
        dashboards.join(load, "dashboard_id", "left")
        .join(views, "dashboard_id", "left")
        .select(
            *[dashboards[c] for c in dashboards.columns],
            F.coalesce(F.col("total_task_duration_l30d"), F.lit(0).cast("bigint")).alias("total_task_duration_l30d"),
            F.coalesce(F.col("count_queries_l30d"), F.lit(0).cast("bigint")).alias("count_queries_l30d"),
            F.col("views"),
        )
    )
