"""Cost roll-ups by dashboard, space and warehouse; source classification.

The reference shape is ``dimension LEFT JOIN fact GROUP BY dimension``.
Here the fact (one row per statement) is aggregated by the join key
first — map-side partial aggregation, one row per key leaves each task —
and only then joined to the dimension.  A key that holds a third of all
statements is therefore never shipped to one task, and the join is
between two tables of one row per object.  Unused objects keep a zero
row (left join + coalesce).  The dimension's key must be unique (it is
for a current view of an SCD2 history).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fact_by(qca: DataFrame, key: str, extra: list[Column]) -> DataFrame:
    return (
        qca.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__key"))
        .agg(
            F.count("statement_id").alias("statements"),
            F.sum("attributed_cost_usd").alias("__cost"),
            F.sum("attributed_dbus").alias("__dbus"),
            *extra,
            F.max("end_time").alias("last_statement_at"),
        )
    )


def _zero(c: str, zero) -> Column:
    return F.coalesce(F.col(c), F.lit(zero)).alias(c)


def dashboard_cost(dashboards: DataFrame, qca: DataFrame) -> DataFrame:
    """H9: statements, cost, DBUs, average cost and last run per dashboard."""
    fact = _fact_by(qca, "dashboard_id", [F.avg("attributed_cost_usd").alias("__avg")])
    return dashboard_table(dashboards, fact)


def dashboard_table(dashboards: DataFrame, fact: DataFrame) -> DataFrame:
    """The dashboard roll-up of the facts per dashboard: objects without any keep a zero row."""
    dim = dashboards.select(
        "dashboard_id", F.col("display_name").alias("dashboard_name"), "owner",
        F.col("warehouse_id").alias("configured_warehouse_id"),
    )
    j = dim.join(fact, dim["dashboard_id"] == fact["__key"], "left")
    return j.select(
        "dashboard_id", "dashboard_name", "owner", "configured_warehouse_id",
        _zero("statements", 0),
        F.coalesce(F.col("__cost"), F.lit(0.0)).alias("cost_usd"),
        F.coalesce(F.col("__dbus"), F.lit(0.0)).alias("dbus"),
        F.coalesce(F.col("__avg"), F.lit(0.0)).alias("avg_cost_per_statement_usd"),
        "last_statement_at",
    )


def space_cost(spaces: DataFrame, qca: DataFrame) -> DataFrame:
    """As H9 per conversational space, plus distinct users."""
    fact = _fact_by(qca, "genie_space_id", [
        F.avg("attributed_cost_usd").alias("__avg"),
        F.countDistinct("executed_by").alias("unique_users"),
    ])
    return space_table(spaces, fact)


def space_table(spaces: DataFrame, fact: DataFrame) -> DataFrame:
    """The space roll-up of the facts per space: objects without any keep a zero row."""
    dim = spaces.select(
        "space_id", F.col("title").alias("genie_space_title"),
        F.col("warehouse_id").alias("configured_warehouse_id"), "creator_id",
    )
    j = dim.join(fact, dim["space_id"] == fact["__key"], "left")
    return j.select(
        "space_id", "genie_space_title", "configured_warehouse_id", "creator_id",
        _zero("statements", 0),
        F.coalesce(F.col("__cost"), F.lit(0.0)).alias("cost_usd"),
        F.coalesce(F.col("__dbus"), F.lit(0.0)).alias("dbus"),
        F.coalesce(F.col("__avg"), F.lit(0.0)).alias("avg_cost_per_statement_usd"),
        _zero("unique_users", 0),
        "last_statement_at",
    )


def warehouse_cost(warehouses: DataFrame, qca: DataFrame) -> DataFrame:
    """Per warehouse, with distinct users, dashboards and spaces."""
    fact = _fact_by(qca, "warehouse_id", [
        F.countDistinct("executed_by").alias("unique_users"),
        F.countDistinct("dashboard_id").alias("dashboards_touched"),
        F.countDistinct("genie_space_id").alias("genie_spaces_touched"),
    ])
    return warehouse_table(warehouses, fact)


def warehouse_table(warehouses: DataFrame, fact: DataFrame) -> DataFrame:
    """The warehouse roll-up of the facts per warehouse: objects without any keep a zero row."""
    dim = warehouses.select(
        F.col("id").alias("warehouse_id"), F.col("name").alias("warehouse_name"),
        "cluster_size", "warehouse_type", "enable_serverless_compute",
    )
    j = dim.join(fact, dim["warehouse_id"] == fact["__key"], "left")
    return j.select(
        "warehouse_id", "warehouse_name", "cluster_size", "warehouse_type", "enable_serverless_compute",
        _zero("statements", 0),
        F.coalesce(F.col("__cost"), F.lit(0.0)).alias("cost_usd"),
        F.coalesce(F.col("__dbus"), F.lit(0.0)).alias("dbus"),
        _zero("unique_users", 0), _zero("dashboards_touched", 0), _zero("genie_spaces_touched", 0),
        "last_statement_at",
    )


def source_type() -> Column:
    """The first non-NULL source id decides."""
    return (
        F.when(F.col("dashboard_id").isNotNull(), "dashboard")
        .when(F.col("genie_space_id").isNotNull(), "genie_space")
        .when(F.col("notebook_id").isNotNull(), "notebook")
        .when(F.col("alert_id").isNotNull(), "alert")
        .when(F.col("job_id").isNotNull(), "job")
        .otherwise("other / direct")
    )


def cost_by_source_type(qca: DataFrame) -> DataFrame:
    """Statements and cost per source type with the share of the total.

    The share needs the grand total next to each per-type row.  The
    per-type aggregate has at most six rows (one per source type, a fixed
    set), so they are gathered into one row together with their total and
    exploded again — a bounded gather, computed from a single evaluation
    of the attribution (a total aggregated separately and joined back
    would evaluate the whole chain twice).
    """
    agg = qca.groupBy(source_type().alias("source_type")).agg(
        F.count(F.lit(1)).alias("statements"),
        F.sum("attributed_cost_usd").alias("cost_usd"),
    )
    packed = agg.agg(
        F.collect_list(F.struct("source_type", "statements", "cost_usd")).alias("__rows"),
        F.sum("cost_usd").alias("__total"),
    )
    rows = packed.select(F.explode("__rows").alias("__r"), "__total")
    return rows.select(
        "__r.source_type", "__r.statements", "__r.cost_usd",
        F.try_divide(F.lit(100.0) * F.col("__r.cost_usd"), F.col("__total")).alias("pct_of_total"),
    )
