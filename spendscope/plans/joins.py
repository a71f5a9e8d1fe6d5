"""Join strategy helpers.

A side is broadcast only when its rows have been counted (a written table's
count is a metadata read); beyond the bound the join shuffles, with heavy
keys split (``spendscope.plans.skew``).
"""

from __future__ import annotations

import uuid
import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.session import ensure_checkpoint_dir

# A broadcast side is shipped to every executor and held in memory: bound it by rows
# (rows of the sides used here are ~100 bytes).
DEFAULT_MAX_BROADCAST_ROWS = 500_000


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts lineage (an executor lost later does not recompute the inputs)
    and makes a later ``count()`` a metadata read.  Uses the folder the
    cluster names in ``spark.checkpoint.dir``; only when unset (local
    tests) a scratch folder is chosen.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/spendscope/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# What has been counted: a DataFrame is an immutable plan over fixed files.
_SMALL: "weakref.WeakKeyDictionary[DataFrame, tuple[int, bool]]" = weakref.WeakKeyDictionary()


def has_at_most(df: DataFrame, rows: int, written: bool = False) -> bool:
    """Whether ``df`` has at most ``rows`` rows; counted, up to one row more, once a DataFrame.
    The count of a ``written`` table is read from its files' metadata."""
    if rows <= 0:
        return False
    bound, small = _SMALL.get(df, (None, False))
    if bound != rows:
        small = (df if written else df.limit(rows + 1)).count() <= rows
        _SMALL[df] = (rows, small)
    return small


def salted_left_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    salt_buckets: int,
    salt_cols: list[str],
) -> DataFrame:
    """Left join with the large side's keys spread over ``salt_buckets``.

    Each small-side row is replicated once per bucket (the small side has
    one row per key), the large side gets a bucket from a hash of
    ``salt_cols`` (deterministic, so a recomputed task lands the same
    way), so a key that holds a third of all rows is split over
    ``salt_buckets`` tasks.
    """
    if salt_buckets <= 1:
        return big.join(small, on, "left")
    salt = "__salt"
    big_s = big.withColumn(salt, F.pmod(F.xxhash64(*salt_cols), F.lit(salt_buckets)).cast("int"))
    small_s = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return big_s.join(small_s, on + [salt], "left").drop(salt)
