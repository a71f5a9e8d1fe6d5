"""Session setup shared by the library, the tests and the benchmark."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every operator relies on.  Timestamps are TIMESTAMP_NTZ end to
# end; ``date_trunc`` goes through the session zone, so it must be UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # a repeated key in a JSON object: the last value counts
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that matter for scale; applied only where the user has not set them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to an existing session."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    directory = spark.sparkContext.getCheckpointDir()
    if directory:
        return directory
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``.  Where it is unset, a
    ``local`` master (tests) gets a fresh scratch folder; on a cluster that
    would be the driver's own disk, so it is an error."""
    directory = spark.sparkContext.getCheckpointDir()
    if directory:
        return directory
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="spendscope-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> str:
    """Make ``spendscope`` importable on executors (the landing data source's
    reader runs in executor Python workers): the package is zipped in
    memory, written to the shared checkpoint folder and added with
    ``addPyFile``.  Not needed when the package is installed on the
    cluster image."""
    import io
    import os
    import uuid
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/spendscope/pkg-{uuid.uuid4().hex[:8]}.zip"
    jvm = spark.sparkContext._jvm
    dst = jvm.org.apache.hadoop.fs.Path(target)
    out = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(dst, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    spark.sparkContext.addPyFile(target)
    return target


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "spendscope") -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    return prepare(builder.getOrCreate())
