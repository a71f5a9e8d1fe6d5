"""Type-2 slowly changing dimension from periodic full snapshots.

A history row is a version interval ``[__START_AT, __END_AT)`` of one key;
``__END_AT IS NULL`` marks the open (current) row.  A change of any
tracked column (NULL-safe) closes the open row and opens a new one; a key
missing from a snapshot is closed at that snapshot's version; a key that
comes back opens a new interval.  A change of untracked columns only
(e.g. raw JSON whose hash is tracked) updates the open row in place.

Two ways to build it, which give identical tables:

* :func:`backfill` — all snapshots at once (gaps-and-islands with
  windows partitioned by key; one shuffle on the key).
* :func:`apply_snapshot` — one snapshot onto an existing history (a full
  outer join of the open rows with the snapshot on the key; closed rows
  pass through untouched, without a shuffle).

:class:`HistoryStore` keeps versions on storage: each applied snapshot is
written to a fresh folder and the last applied version is recorded beside
it, so a snapshot version at or below it is a no-op.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from spendscope.plans import state

START = "__START_AT"
END = "__END_AT"


def _tracked(cols: Sequence[str], prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in cols])


def _untracked(df_cols: Sequence[str], keys: Sequence[str], tracked: Sequence[str], skip=("version",)) -> list[str]:
    return [c for c in df_cols if c not in keys and c not in tracked and c not in skip and c not in (START, END)]


def _versions(snapshots: DataFrame, version_col: str, versions: Sequence[int] | None = None) -> DataFrame:
    """One row per snapshot version with its neighbours.

    The versions (one per snapshot taken — a few thousand at most, never
    data rows) are gathered into one sorted array and exploded with their
    positions.  Pass ``versions`` when some snapshots may be empty: an
    empty snapshot leaves no row to derive its version from, yet it closes
    every open key."""
    if versions is not None:
        spark = snapshots.sparkSession
        vtype = snapshots.schema[version_col].dataType
        listed = spark.createDataFrame([(int(v),) for v in sorted(set(versions))], f"{version_col} bigint")
        src = listed.select(F.col(version_col).cast(vtype).alias(version_col))
    else:
        src = snapshots.select(version_col).distinct()
    arr = src.agg(F.sort_array(F.collect_list(version_col)).alias("__v"))
    pos = arr.select("__v", F.posexplode("__v").alias("__i", version_col))
    n = F.size("__v")
    return pos.select(
        version_col,
        F.when(F.col("__i") > 0, F.element_at("__v", F.col("__i"))).alias("__prev_version"),
        F.when(F.col("__i") + 1 < n, F.element_at("__v", F.col("__i") + 2)).alias("__next_version"),
    )


# ------------------------------------------------------------------- C6
def backfill(
    snapshots: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    version_col: str = "version",
    versions: Sequence[int] | None = None,
) -> DataFrame:
    """History from many full snapshots (``version_col`` tells them apart;
    ``versions`` lists all snapshot versions when some may be empty)."""
    keys, tracked = list(keys), list(tracked)
    untracked = _untracked(snapshots.columns, keys, tracked, (version_col,))
    vers = F.broadcast(_versions(snapshots, version_col, versions))  # one row per snapshot
    s = snapshots.join(vers, version_col, "inner")
    w = Window.partitionBy(*keys).orderBy(version_col)
    tr = _tracked(tracked)
    prev_v = F.lag(version_col).over(w)
    prev_tr = F.lag(tr).over(w)
    is_new = (
        prev_v.isNull()
        | ~prev_v.eqNullSafe(F.col("__prev_version"))
        | ~tr.eqNullSafe(prev_tr)
    ).cast("int")
    flagged = s.withColumn("__is_new", is_new)
    runs = flagged.withColumn(
        "__run", F.sum("__is_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    # grouping by (keys, run) reuses the hash partitioning on keys: no shuffle
    agg = runs.groupBy(*keys, "__run").agg(
        *[F.first(c, ignorenulls=False).alias(c) for c in tracked],
        *[F.max_by(F.col(c), F.col(version_col)).alias(c) for c in untracked],
        F.min(version_col).cast("bigint").alias(START),
        F.max_by(F.col("__next_version"), F.col(version_col)).cast("bigint").alias(END),
    )
    return agg.select(*keys, *tracked, *untracked, START, END)


# ------------------------------------------------------------------- C2
def apply_snapshot(
    history: DataFrame | None,
    snapshot: DataFrame,
    version: int,
    keys: Sequence[str],
    tracked: Sequence[str],
    complete: bool = True,
    unresolved: DataFrame | None = None,
) -> DataFrame:
    """History after one full snapshot taken at ``version``.

    ``complete=False`` (a partial listing, e.g. a failed fetch) keeps keys
    that are missing from the snapshot open instead of closing them;
    ``unresolved`` names the keys for which this holds in a complete one.
    Duplicate keys in the snapshot fail the job.
    """
    keys, tracked = list(keys), list(tracked)
    cols = [c for c in snapshot.columns if c != "version"]
    untracked = _untracked(cols, keys, tracked)
    value_cols = tracked + untracked
    v = F.lit(int(version)).cast("bigint")

    # duplicate keys: counted in a window partitioned like the join below
    dup = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    snap = snapshot.select(*cols).withColumn("__n", dup)
    if history is None:
        first = snap.select(
            *keys, *value_cols, v.alias(START), F.lit(None).cast("bigint").alias(END),
            F.when(F.col("__n") > 1, F.raise_error(F.lit("duplicate key in snapshot"))).alias("__chk"),
        )
        return first.where(F.col("__chk").isNull()).drop("__chk")

    closed = history.where(F.col(END).isNotNull()).select(*keys, *value_cols, START, END)
    open_ = history.where(F.col(END).isNull()).select(
        *keys, *[F.col(c).alias(f"__o_{c}") for c in value_cols], F.col(START).alias("__o_start"), F.lit(1).alias("__in_open")
    )
    if unresolved is None:
        open_ = open_.withColumn("__held", F.lit(None).cast("int"))
    else:
        open_ = open_.join(unresolved.select(*keys).distinct().withColumn("__held", F.lit(1)), keys, "left")
    s = snap.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in value_cols], F.lit(1).alias("__in_snap"), "__n")
    j = open_.join(s, keys, "full_outer")
    in_open = F.col("__in_open").isNotNull()
    in_snap = F.col("__in_snap").isNotNull()
    same = _tracked(tracked, "__o_").eqNullSafe(_tracked(tracked, "__s_"))
    # per joined key: which rows leave the step
    old_row = F.struct(
        *[F.col(f"__o_{c}").alias(c) for c in value_cols],
        F.col("__o_start").alias(START),
        F.when(in_snap | F.col("__held").isNotNull() | F.lit(not complete), F.lit(None).cast("bigint")).otherwise(v).alias(END),
    )
    closed_old = F.struct(
        *[F.col(f"__o_{c}").alias(c) for c in value_cols], F.col("__o_start").alias(START), v.alias(END)
    )
    new_row = F.struct(
        *[F.col(f"__s_{c}").alias(c) for c in value_cols], v.alias(START), F.lit(None).cast("bigint").alias(END)
    )
    kept_row = F.struct(  # unchanged tracked values: update untracked in place
        *[F.col(f"__s_{c}").alias(c) for c in value_cols],
        F.col("__o_start").alias(START), F.lit(None).cast("bigint").alias(END),
    )
    rows = (
        F.when(F.col("__n") > 1, F.raise_error(F.lit("duplicate key in snapshot")))
        .when(in_open & in_snap & same, F.array(kept_row))
        .when(in_open & in_snap, F.array(closed_old, new_row))
        .when(in_open, F.array(old_row))
        .otherwise(F.array(new_row))
    )
    out = j.select(*keys, F.explode(rows).alias("__r"))
    changed = out.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in value_cols], F.col(f"__r.{START}").alias(START),
                         F.col(f"__r.{END}").alias(END))
    return closed.unionByName(changed)


# ------------------------------------------------------------------- C4/C5
def current(history: DataFrame) -> DataFrame:
    """Open rows without the interval columns."""
    return history.where(F.col(END).isNull()).drop(START, END)


def as_of(history: DataFrame, version: int) -> DataFrame:
    """Rows valid at ``version`` ("what did it look like then")."""
    v = F.lit(int(version)).cast("bigint")
    return history.where((F.col(START) <= v) & (F.col(END).isNull() | (F.col(END) > v))).drop(START, END)


# ------------------------------------------------------------------- C1 + storage
class HistoryStore:
    """A history kept as immutable parquet folders under ``root``.

    Version ``n`` is written once to ``root/v<n>-<id>/`` partitioned by
    ``__state``: ``closed`` holds the rows closed by that snapshot (they
    never change again), ``open`` the open rows after it.  The history is
    every version's ``closed`` part plus the latest ``open`` part, so an
    applied snapshot writes only the open set and that version's changes
    — not the whole history.  Immutable numbered records under ``_state``
    name the applied versions (the snapshot gate: a ``version`` at or below
    the last is a no-op and ``apply`` returns ``None``); a record is added only
    after the data is written, so a failed run leaves the previous one.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], tracked: Sequence[str]):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.tracked = list(keys), list(tracked)

    def state(self) -> dict | None:
        found = state.read_state(self.spark, self.root)
        if found is None and state.holds_data(self.spark, self.root):
            raise RuntimeError(f"{self.root} holds data but no state record; a new history there would lose it")
        return found

    def _write_state(self, record: dict) -> None:
        state.write_state(self.spark, self.root, record)

    def last_version(self) -> int | None:
        st = self.state()
        return None if st is None else int(st["version"])

    def _part(self, folder: str, kind: str) -> str:
        return f"{folder}/__state={kind}"

    def compact(self) -> None:
        """Rewrite every version's closed rows into one folder (a new,
        immutable version of the layout; the old folders are left for the
        storage's retention to remove).  Keeps reads to two parts after
        years of snapshots."""
        st = self.state()
        if st is None or len(st["folders"]) < 2:
            return
        schema = StructType.fromJson(json.loads(st["schema"]))
        closed = self._read_parts(st).where(F.col(END).isNotNull())
        folder = os.path.join(self.root, f"compact-v{int(st['version'])}-{uuid.uuid4().hex[:8]}")
        # clustered by interval: an as-of read skips the row groups that ended before
        closed = closed.select(*schema.fieldNames()).repartitionByRange(F.col(END), F.col(START)).sortWithinPartitions(END, START)
        closed.withColumn("__state", F.lit("closed")).write.partitionBy("__state").parquet(folder)
        latest = st["folders"][-1]
        # the latest folder's open part stays current; its closed part is now in the compacted folder
        self._write_state({**st, "folders": [folder, latest], "skip_closed": [latest]})

    def _read_parts(self, st: dict, open_only: bool = False) -> DataFrame:
        skip = set(st.get("skip_closed", []))
        paths = [] if open_only else [self._part(f, "closed") for f in st["folders"] if f not in skip]
        paths.append(self._part(st["folders"][-1], "open"))
        existing = [p for p in paths if state.exists(self.spark, p)]
        schema = StructType.fromJson(json.loads(st["schema"]))
        if not existing:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*existing)

    def as_of(self, version: int) -> DataFrame | None:
        """The rows valid at ``version``.  A folder's closed rows all ended at the version that
        wrote it, so those of versions up to ``version`` are not opened; in a compacted folder
        the filter on the end reaches the scan."""
        st = self.state()
        if st is None:
            return None
        skip = set(st.get("skip_closed", []))
        skip |= {f for f in st["folders"] if (m := re.match(r"v(\d+)-", os.path.basename(f))) and int(m[1]) <= version}
        return as_of(self._read_parts({**st, "skip_closed": sorted(skip)}), version)

    def read(self) -> DataFrame | None:
        st = self.state()
        return None if st is None else self._read_parts(st)

    def read_open(self) -> DataFrame | None:
        st = self.state()
        return None if st is None else self._read_parts(st, open_only=True)

    def apply(self, snapshot: DataFrame, version: int, complete: bool = True,
              unresolved: DataFrame | None = None) -> DataFrame | None:
        """``unresolved``: keys whose fetch failed; their open rows stay as they are."""
        st = self.state()
        if st is not None and int(st["version"]) >= int(version):
            return None
        open_rows = None if st is None else self._read_parts(st, open_only=True)
        if open_rows is not None and unresolved is not None:
            lacking = [f for f in open_rows.schema if f.name not in (*snapshot.columns, START, END)]
            snapshot = snapshot.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})
        step = apply_snapshot(open_rows, snapshot, version, self.keys, self.tracked, complete, unresolved)
        schema = step.schema
        folder = os.path.join(self.root, f"v{int(version)}-{uuid.uuid4().hex[:8]}")
        (step.withColumn("__state", F.when(F.col(END).isNull(), "open").otherwise("closed"))
         .write.partitionBy("__state").parquet(folder))
        folders = ([] if st is None else st["folders"]) + [folder]
        skip = [] if st is None else st.get("skip_closed", [])
        self._write_state({"version": int(version), "folders": folders, "schema": schema.json(), "skip_closed": skip,
                           "record": 0 if st is None else st["record"]})
        return self.read()
