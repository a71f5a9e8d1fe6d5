"""Inventory histories fed by a stream of landed snapshots.

A snapshot of one kind of object is landed as a folder of its own,
``<root>/<kind>/version=<v>/`` (dashboards with their schedules beside it), and
counts as complete once a marker, one JSON line in ``<root>/markers/``, names it;
the marker is written last.  The stream reads the markers; every batch applies
the snapshots it names, oldest first, to the history of their kind.  A snapshot
at or below the last applied version changes nothing, so a batch that is repeated
after a failure does no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendscope import schemas, tables
from spendscope.operators import scd2
from spendscope.plans import state
from spendscope.sources import landing

MARKER_SCHEMA = "kind string, version long, complete boolean"


def land(spark: SparkSession, root: str, kind: str, version: int, objects: DataFrame, schedules: DataFrame | None = None,
         complete: bool = True) -> None:
    """Land one snapshot (object_id, raw_json, status), then its marker.  ``complete=False``:
    the listing may lack objects, which then stay open."""
    folder = f"{root.rstrip('/')}/{kind}/version={version}"
    objects.write.mode("overwrite").parquet(folder)
    if schedules is not None:
        schedules.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{kind}_schedules/version={version}")
    spark.createDataFrame([(kind, version, complete)], MARKER_SCHEMA).coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/markers")


def history(spark: SparkSession, store_root: str, kind: str) -> scd2.HistoryStore:
    return scd2.HistoryStore(spark, f"{store_root.rstrip('/')}/{kind}_history", schemas.KEYS[kind], schemas.TRACKED[kind])


def apply_landed(spark: SparkSession, root: str, store_root: str, kind: str, version: int, complete: bool = True) -> None:
    """Apply one landed snapshot to the history of its kind."""
    objects = landing.read_landing(spark, f"{root.rstrip('/')}/{kind}/version={version}",
                                   parallelism=max(8, 2 * spark.sparkContext.defaultParallelism))
    beside = f"{root.rstrip('/')}/{kind}_schedules/version={version}"
    schedules = spark.read.parquet(beside) if state.exists(spark, beside) else None
    tables.apply_inventory_snapshot(spark, store_root, kind, objects, version, schedules, complete)


def run_stream(spark: SparkSession, root: str, store_root: str, checkpoint: str, available_now: bool = True):
    """Start the stream of markers; with ``available_now`` it ends with the snapshots landed so far."""
    markers = spark.readStream.schema(MARKER_SCHEMA).json(f"{root.rstrip('/')}/markers")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        for m in sorted(batch.collect(), key=lambda r: (r["version"], r["kind"])):  # one row a snapshot
            apply_landed(spark, root, store_root, m["kind"], m["version"], m["complete"])

    writer = markers.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
