"""Cost roll-ups (H9-H11) maintained from the increments of the cost history.

An increment's statements are aggregated once into delta rows: per object (a
dashboard, space or warehouse) its counts and sums, and each distinct user,
dashboard or space seen with it as a row of its own.  Deltas add up: counts and
sums are summed, the latest end is kept, equal distinct rows become one.  A
:class:`RollupStore` writes one delta a version, so a step reads its own
increment and nothing else; the tables are read off the merged deltas, and
``compact`` folds these into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscope.operators import rollups
from spendscope.plans import state

KEYS = {"dashboard": "dashboard_id", "space": "genie_space_id", "warehouse": "warehouse_id"}
# Distinct values kept with each kind of object: name of the count -> column.
DISTINCT = {
    "dashboard": {},
    "space": {"unique_users": "executed_by"},
    "warehouse": {"unique_users": "executed_by", "dashboards_touched": "dashboard_id", "genie_spaces_touched": "genie_space_id"},
}
STATE_KEYS = ["entity", "key", "kind", "value"]


def delta(statements: DataFrame) -> DataFrame:
    """Mergeable rows (``STATE_KEYS``; statements, usd, dbus, priced, last) of some statements:
    one pass, partial aggregation before the shuffle."""
    cells = []
    for entity, key in KEYS.items():
        for kind, column in {"fact": None, **DISTINCT[entity]}.items():
            value = F.lit(None).cast("string") if column is None else F.col(column)
            row = F.struct(F.lit(entity).alias("entity"), F.col(key).alias("key"), F.lit(kind).alias("kind"), value.alias("value"))
            there = F.col(key).isNotNull() if column is None else F.col(key).isNotNull() & F.col(column).isNotNull()
            cells.append(F.when(there, row))
    rows = statements.select(F.explode(F.array_compact(F.array(*cells))).alias("s"), "attributed_cost_usd", "attributed_dbus",
                             "end_time")
    own = F.col("s.kind") == "fact"  # the other rows only say that a value was seen
    return _merged(rows.select(
        "s.*", F.when(own, 1).otherwise(0).cast("bigint").alias("statements"), F.when(own, F.col("attributed_cost_usd")).alias("usd"),
        F.when(own, F.col("attributed_dbus")).alias("dbus"),
        F.when(own & F.col("attributed_cost_usd").isNotNull(), 1).otherwise(0).cast("bigint").alias("priced"),
        F.when(own, F.col("end_time")).alias("last")))


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*STATE_KEYS).agg(F.sum("statements").alias("statements"), F.sum("usd").alias("usd"), F.sum("dbus").alias("dbus"),
                                         F.sum("priced").alias("priced"), F.max("last").alias("last"))


def facts(states: DataFrame, entity: str) -> DataFrame:
    """The facts per object that the tables of ``rollups`` are made of, from merged states."""
    own = F.col("kind") == "fact"
    counts = [F.count_if(F.col("kind") == kind).alias(kind) for kind in DISTINCT[entity]]
    return states.where(F.col("entity") == entity).groupBy(F.col("key").alias("__key")).agg(
        F.sum("statements").alias("statements"), F.sum("usd").alias("__cost"), F.sum("dbus").alias("__dbus"),
        F.try_divide(F.sum(F.when(own, F.col("usd"))), F.sum("priced").cast("double")).alias("__avg"), *counts,
        F.max("last").alias("last_statement_at"))


class RollupStore:
    """Deltas under ``root``, one folder a version, and a record of the folders that count."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def record(self) -> dict:
        return state.read_state(self.spark, self.root) or {"version": 0, "folders": [], "record": 0}

    def apply(self, statements: DataFrame, version: int) -> bool:
        """Add the statements of an increment; False when that version is in already."""
        record = self.record()
        if version <= record["version"]:
            return False
        folder = f"delta-{version}"
        delta(statements).write.mode("overwrite").parquet(f"{self.root}/{folder}")
        state.write_state(self.spark, self.root, {**record, "version": version, "folders": [*record["folders"], folder]})
        return True

    def follow(self, history) -> int:
        """Apply the increments of a cost history that are not in yet, each read alone; returns how many."""
        done, last = self.record()["version"], history.record()["increments"]
        for n in range(done + 1, last + 1):
            self.apply(history.increment(n), n)
        return last - done

    def states(self) -> DataFrame:
        folders = [f"{self.root}/{f}" for f in self.record()["folders"]]
        if not folders:
            raise ValueError(f"{self.root} has no increment yet")
        return _merged(self.spark.read.parquet(*folders))

    def compact(self) -> None:
        """Fold the deltas into one; later steps and reads go on from it."""
        record = self.record()
        folder = f"upto-{record['version']}-of-{len(record['folders'])}"
        self.states().write.mode("overwrite").parquet(f"{self.root}/{folder}")
        state.write_state(self.spark, self.root, {**record, "folders": [folder]})
        for old in record["folders"]:
            state.remove(self.spark, f"{self.root}/{old}")

    def dashboard_cost(self, dashboards: DataFrame) -> DataFrame:
        return rollups.dashboard_table(dashboards, facts(self.states(), "dashboard"))

    def space_cost(self, spaces: DataFrame) -> DataFrame:
        return rollups.space_table(spaces, facts(self.states(), "space"))

    def warehouse_cost(self, warehouses: DataFrame) -> DataFrame:
        return rollups.warehouse_table(warehouses, facts(self.states(), "warehouse"))
