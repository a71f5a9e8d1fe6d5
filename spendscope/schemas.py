"""Declared schemas (with column comments) of the snapshot and history tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from spendscope.sources import normalize as N

S, I, T, L = StringType(), IntegerType(), TimestampNTZType(), LongType()

_TYPES = {
    "create_time": T, "update_time": T, "schedule_count": I,
    "table_count": I, "instruction_count": I, "sample_question_count": I, "curated_question_count": I,
    "min_num_clusters": I, "max_num_clusters": I, "auto_stop_mins": I, "num_clusters": I,
    "num_active_sessions": I,
}

_COMMENTS = {
    "dashboard_id": "dashboard key", "space_id": "space key", "id": "warehouse key",
    "owner": "owner taken from a /Users/<owner>/ parent path",
    "dashboard_metadata_json": "canonical JSON of the dashboard without its definition",
    "serialized_dashboard": "dashboard definition (canonical JSON text)",
    "schedules_json": "canonical JSON array of schedules, sorted by id and name",
    "space_metadata_json": "canonical JSON of the space record",
    "warehouse_metadata_json": "canonical JSON of the warehouse record",
    "__START_AT": "version (epoch ms) at which this row became current",
    "__END_AT": "version at which this row stopped being current; NULL = current",
}


def _field(name: str) -> StructField:
    if name.startswith("schedule_frequency_"):
        dtype = I
    else:
        dtype = _TYPES.get(name, S)
    comment = _COMMENTS.get(name) or (f"SHA-256 of {name[:-7]}" if name.endswith("_sha256") else name.replace("_", " "))
    return StructField(name, dtype, name not in ("dashboard_id", "space_id", "id"), {"comment": comment})


def snapshot_schema(kind: str) -> StructType:
    cols = {"dashboard": N.DASHBOARD_COLUMNS, "space": N.SPACE_COLUMNS, "warehouse": N.WAREHOUSE_COLUMNS}[kind]
    return StructType([_field(c) for c in cols])


def history_schema(kind: str) -> StructType:
    return StructType(snapshot_schema(kind).fields + [
        StructField("__START_AT", L, True, {"comment": _COMMENTS["__START_AT"]}),
        StructField("__END_AT", L, True, {"comment": _COMMENTS["__END_AT"]}),
    ])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select ``schema``'s columns in order, cast to its types, and attach
    its column comments."""
    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields
    ])


KEYS = {"dashboard": ["dashboard_id"], "space": ["space_id"], "warehouse": ["id"]}
TRACKED = {"dashboard": N.DASHBOARD_TRACKED, "space": N.SPACE_TRACKED, "warehouse": N.WAREHOUSE_TRACKED}
