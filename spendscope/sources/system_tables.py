"""Adapters from the nested system-table layouts to the flat inputs the
operators take.

The system tables carry nested structs (``compute.warehouse_id``,
``query_source.job_info.job_id``, ``usage_metadata.warehouse_id``,
``pricing.default``, ``request_params.dashboard_id``,
``user_identity.email``).  Selecting the nested fields by path lets
Catalyst prune the parquet read to exactly those leaves (nested schema
pruning) and push the filters on them into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERY_HISTORY_FIELDS = {
    "statement_id": "statement_id",
    "workspace_id": "workspace_id",
    "executed_by": "executed_by",
    "warehouse_id": "compute.warehouse_id",
    "dashboard_id": "query_source.dashboard_id",
    "genie_space_id": "query_source.genie_space_id",
    "notebook_id": "query_source.notebook_id",
    "alert_id": "query_source.alert_id",
    "job_id": "query_source.job_info.job_id",
    "client_application": "client_application",
    "execution_status": "execution_status",
    "start_time": "start_time",
    "end_time": "end_time",
    "compilation_duration_ms": "compilation_duration_ms",
    "execution_duration_ms": "execution_duration_ms",
    "result_fetch_duration_ms": "result_fetch_duration_ms",
    "total_task_duration_ms": "total_task_duration_ms",
}


def flatten_query_history(history: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Query history → flat statement columns (+ ``extra`` top-level columns)."""
    cols = [F.col(path).alias(name) for name, path in QUERY_HISTORY_FIELDS.items()]
    return history.select(*cols, *(extra or []))


def flatten_usage(usage: DataFrame) -> DataFrame:
    return usage.select(
        "workspace_id",
        F.col("usage_metadata.warehouse_id").alias("warehouse_id"),
        "cloud", "sku_name", "billing_origin_product", "usage_start_time", "usage_quantity",
    )


def flatten_prices(prices: DataFrame) -> DataFrame:
    return prices.select(
        "cloud", "sku_name", "price_start_time", "price_end_time",
        F.col("pricing.default").cast("double").alias("price_usd"),
    )


def flatten_audit(audit: DataFrame) -> DataFrame:
    """``request_params`` may be a map or a struct: both take ``a.b`` access."""
    rp = audit.schema["request_params"].dataType.typeName()
    dash = F.col("request_params")["dashboard_id"] if rp == "map" else F.col("request_params.dashboard_id")
    return audit.select(
        "event_date", "action_name", dash.alias("dashboard_id"), F.col("user_identity.email").alias("email"),
    )


# ---------------------------------------------------------------- nesting
# The inverse direction: used by tests and the driver queries to present
# the derived fixtures in the system tables' nested layout.
def nest_query_history(flat: DataFrame) -> DataFrame:
    return flat.select(
        "statement_id", "workspace_id", "executed_by", "client_application", "execution_status",
        F.struct(F.col("warehouse_id")).alias("compute"),
        F.struct(
            "dashboard_id", "genie_space_id", "notebook_id", "alert_id",
            F.struct(F.col("job_id")).alias("job_info"),
        ).alias("query_source"),
        "start_time", "end_time", "compilation_duration_ms", "execution_duration_ms",
        "result_fetch_duration_ms", "total_task_duration_ms",
    )


def nest_usage(flat: DataFrame) -> DataFrame:
    return flat.select(
        "workspace_id", F.struct("warehouse_id").alias("usage_metadata"), "cloud", "sku_name",
        "billing_origin_product", "usage_start_time", "usage_quantity",
    )


def nest_prices(flat: DataFrame) -> DataFrame:
    return flat.select(
        "cloud", "sku_name", "price_start_time", "price_end_time",
        F.struct(F.col("price_usd").alias("default")).alias("pricing"),
    )


def nest_audit(flat: DataFrame, request_params_as_map: bool = True) -> DataFrame:
    rp = (F.create_map(F.lit("dashboard_id"), F.col("dashboard_id")) if request_params_as_map
          else F.struct("dashboard_id"))
    return flat.select("event_date", "action_name", rp.alias("request_params"),
                       F.struct("email").alias("user_identity"))
