"""A small state record beside written data: immutable numbered files, newest wins.

A record is written to a temporary name and renamed; no record is ever
replaced or deleted, so a run that fails leaves the previous one in place.
A record that was read carries its number as ``record``; what is written with
that number is refused if another run has recorded anything since, so of two
runs that begin at one record only one succeeds.  (Where renaming is not atomic,
as on some object stores, runs that end within the same moment need a lock of
their own.)
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = filesystem(spark, path)
    return fs.exists(hpath)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    hpath, fs = filesystem(spark, path)
    fs.delete(hpath, True)


def holds_data(spark: SparkSession, path: str) -> bool:
    """Whether the folder has anything but hidden files and state records."""
    hpath, fs = filesystem(spark, path)
    return fs.exists(hpath) and any(s.getPath().getName()[0] not in "_." for s in fs.listStatus(hpath))


def _newest(spark: SparkSession, root: str) -> str | None:
    folder, fs = filesystem(spark, f"{root.rstrip('/')}/_state")
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return max((n for n in names if n.startswith("v") and n.endswith(".json")), default=None)


def read_state(spark: SparkSession, root: str) -> dict | None:
    name = _newest(spark, root)
    if name is None:
        return None
    path, fs = filesystem(spark, f"{root.rstrip('/')}/_state/{name}")
    stream = fs.open(path)
    try:
        found = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        return {**found, "record": int(name[1:-5])}
    finally:
        stream.close()


def write_state(spark: SparkSession, root: str, state: dict) -> None:
    """Record ``state``.  Its ``record`` is the number of the record that it follows (0: none yet);
    without one it follows whatever is the newest."""
    name = _newest(spark, root)
    newest = int(name[1:-5]) if name else 0
    number = 1 + state.get("record", newest)
    if number <= newest:
        raise RuntimeError(f"another run has recorded state {newest} of {root} since record {number - 1} was read")
    folder = f"{root.rstrip('/')}/_state"
    target, fs = filesystem(spark, f"{folder}/v{number:012d}.json")
    tmp, _ = filesystem(spark, f"{folder}/{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps({k: v for k, v in state.items() if k != "record"}).encode("utf-8")))
    out.close()
    if fs.exists(target) or not fs.rename(tmp, target):
        raise RuntimeError(f"another run has recorded state {number} of {root}")
