"""The whole data product as plain functions: snapshots → histories →
current views → usage enrichment → per-statement cost → roll-ups.

The table graph is explicit in the arguments (no name-based discovery):

    landing (per object type) ─► normalize ─► HistoryStore.apply(version) ─► current
    system tables ─► query_cost_attribution ─► dashboard / space / warehouse cost
    current dashboards + audit + history ─► dashboard_denormalized

``write_tables`` materializes each table to its own folder (the
"materialized view" of the reference), ``register_views`` exposes them to
SQL users by name.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscope import schemas
from spendscope.operators import cost, prices, rollups, scd2, usage
from spendscope.plans import state
from spendscope.plans.joins import materialize
from spendscope.sources import normalize, system_tables


@dataclass
class SystemTables:
    """System tables in their nested layout (flattened on use)."""

    query_history: DataFrame
    usage: DataFrame
    account_prices: DataFrame
    list_prices: DataFrame
    audit: DataFrame

    def flat(self) -> "SystemTables":
        return SystemTables(
            system_tables.flatten_query_history(self.query_history),
            system_tables.flatten_usage(self.usage),
            system_tables.flatten_prices(self.account_prices),
            system_tables.flatten_prices(self.list_prices),
            system_tables.flatten_audit(self.audit),
        )


NORMALIZERS = {
    "dashboard": lambda raw, sched: normalize.dashboard_rows(raw, sched),
    "space": lambda raw, _s: normalize.space_rows(raw),
    "warehouse": lambda raw, _s: normalize.warehouse_rows(raw),
}


def apply_inventory_snapshot(
    spark: SparkSession,
    store_root: str,
    kind: str,
    landing: DataFrame,
    version: int,
    schedules: DataFrame | None = None,
    complete: bool = True,
    allow_empty: bool = False,
    outcomes: dict | None = None,
) -> DataFrame:
    """Normalize one landed snapshot and apply it to the ``kind`` history
    (a version at or below the last applied one is a no-op).  Returns the
    history as stored.

    Only an object that the listing lacks, or that was ``missing`` when
    fetched, is closed: keys whose fetch failed otherwise stay open, and
    when such a failure does not name its object the snapshot counts as
    incomplete.  An empty snapshot is refused unless ``allow_empty``.  Pass a dict as ``outcomes`` to receive
    the fetch-outcome counters, collected during the same pass."""
    if not allow_empty and landing.isEmpty():
        raise ValueError(f"the {kind} snapshot {version} has no object; it would close the whole inventory")
    failed = landing.where(~F.coalesce(F.col("status"), F.lit("")).isin("ok", "missing"))
    unresolved = failed.select(F.col("object_id").alias(schemas.KEYS[kind][0]))
    if complete and not failed.where(F.coalesce("object_id", F.lit("")) == "").isEmpty():
        complete = False
    landing, obs = normalize.observe_outcomes(landing, f"{kind}_outcomes_{version}")
    rows = schemas.conform(NORMALIZERS[kind](landing, schedules), schemas.snapshot_schema(kind))
    store = scd2.HistoryStore(spark, f"{store_root.rstrip('/')}/{kind}_history", schemas.KEYS[kind],
                              schemas.TRACKED[kind])
    applied = store.apply(rows, version, complete=complete, unresolved=unresolved)
    if outcomes is not None and applied is not None:
        outcomes.update(obs.get)
    return store.read()


def cost_tables(
    system: SystemTables,
    dashboards: DataFrame,
    spaces: DataFrame,
    warehouses: DataFrame,
    as_of: dt.datetime,
    window_days: int = 365,
    discount_pct: float = 0.0,
    audit_window_days: int = 30,
) -> dict[str, DataFrame]:
    """All cost and usage tables from flat system tables and current inventories."""
    eff = prices.effective_prices(system.account_prices, system.list_prices)
    qca = cost.query_cost_attribution(system.query_history, system.usage, eff, as_of, window_days, discount_pct)
    qca = materialize(qca, "query_cost_attribution")  # read by three roll-ups
    return {
        "query_cost_attribution": qca,
        "dashboard_cost": rollups.dashboard_cost(dashboards, qca),
        "space_cost": rollups.space_cost(spaces, qca),
        "warehouse_cost": rollups.warehouse_cost(warehouses, qca),
        "dashboard_denormalized": usage.dashboard_denormalized(
            dashboards, system.audit, system.query_history, as_of, audit_window_days),
    }


def write_tables(tables: dict[str, DataFrame], target: str) -> dict[str, str]:
    """Each table to a folder of its own that no later run overwrites; the
    newest state record under ``target`` names the current ones, so a failed
    run leaves the previous tables."""
    run = uuid.uuid4().hex[:12]
    paths = {}
    spark = None
    for name, df in tables.items():
        spark = df.sparkSession
        paths[name] = f"{target.rstrip('/')}/{name}/{run}"
        df.write.parquet(paths[name])
    if spark is not None:
        state.write_state(spark, target, {"tables": paths})
    return paths


def read_table(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A table as last written to ``target``."""
    found = state.read_state(spark, target)
    if found is None or name not in found["tables"]:
        raise ValueError(f"{target} has no table {name}")
    return spark.read.parquet(found["tables"][name])


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
