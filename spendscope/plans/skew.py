"""Joins that stay balanced whatever the keys look like, by measuring them.

Keys are counted exactly (an aggregate with map-side partials).  A key is
heavy when it holds more than one ``PIECES``-th of an average partition; at
most ``PIECES`` x partitions keys can be, which bounds the list of heavy keys
that is broadcast.  Only heavy keys are split: their rows on the large side
go to as many buckets as they need, and only their rows on the small side
are repeated, once a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.functions.time import epoch_seconds
from spendscope.plans.joins import materialize

PIECES = 16  # parts of an average partition's rows that one (key, bucket) holds at most


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(counts: DataFrame, keys: list[str], n: str = "n", partitions: int | None = None) -> DataFrame:
    """(keys, ``__buckets``) of the heavy keys in ``counts``, a written table with one row a key."""
    parts = partitions or shuffle_partitions(counts)
    total = counts.agg(F.sum(n)).first()[0] or 0
    piece = max(1, total // (PIECES * parts))
    return counts.where(F.col(n) > piece).select(*keys, F.ceil(F.col(n) / piece).cast("int").alias("__buckets"))


def _nullable(keys: list[str]) -> Column:
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return any_null


def spread_left_join(big: DataFrame, small: DataFrame, on: list[str], heavy: DataFrame, salt_cols: list[str],
                     condition: Column | None = None) -> DataFrame:
    """``big`` left join ``small`` on equal ``on`` (and ``condition``), heavy keys in buckets.

    The bucket is a hash of ``salt_cols``, so a repeated task deals its rows alike.  Rows of
    ``big`` with a null key match nothing and are dealt over all partitions.  The other
    columns of the two sides have different names."""
    spread_over = shuffle_partitions(big)
    hash_ = F.xxhash64(*salt_cols)
    left = big.join(F.broadcast(heavy), on, "left").withColumn(
        "__bucket", F.when(_nullable(on), F.pmod(hash_, F.lit(spread_over)))
        .otherwise(F.pmod(hash_, F.coalesce("__buckets", F.lit(1)))).cast("int")).select(*big.columns, "__bucket")
    right = small.join(F.broadcast(heavy), on, "left").withColumn(
        "__bucket", F.explode(F.sequence(F.lit(0), F.coalesce("__buckets", F.lit(1)) - 1))).drop("__buckets")
    if condition is None:
        return left.join(right, [*on, "__bucket"], "left").drop("__bucket")
    equal = F.col("__bucket") == F.col("__r___bucket")
    for k in on:
        equal = equal & (F.col(k) == F.col(f"__r_{k}"))
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in [*on, "__bucket"]})
    return left.join(right, equal & condition, "left").drop("__bucket", *[f"__r_{k}" for k in [*on, "__bucket"]])


def interval_left_join(big: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, end: str,
                       bin_hours: int = 720) -> DataFrame:
    """``big`` left join ``intervals`` on equal ``on`` and ``start <= at < end`` (a null end is open).

    Time is cut into bins of ``bin_hours``; an interval goes to each bin it touches within the
    range of ``at``, so the join is an equi join on (``on``, bin) with the range as residual
    condition, and a key with many intervals or many rows is many smaller keys.  Heavy
    (key, bin) pairs are split further (:func:`spread_left_join`).  Both sides shuffle; no
    size is assumed.  Intervals may overlap: a row has one result for each that holds it."""
    def bin_of(c: Column) -> Column:
        return F.floor(epoch_seconds(c) / (3600 * bin_hours)).cast("int")

    left = big.withColumn("__bin", bin_of(F.col(at)))
    counts = materialize(left.groupBy(*on, "__bin").agg(F.count(F.lit(1)).alias("n")), "interval_bins")
    ends = counts.agg(F.min("__bin").alias("first"), F.max("__bin").alias("last")).first()
    first, last = F.lit(ends["first"]).cast("int"), F.lit(ends["last"]).cast("int")
    from_bin, to_bin = F.greatest(bin_of(F.col(start)), first), F.least(F.coalesce(bin_of(F.col(end)), last), last)
    cut = intervals.withColumns({"__from": from_bin, "__to": to_bin}).where("__from <= __to") \
        .withColumn("__bin", F.explode(F.sequence("__from", "__to"))).drop("__from", "__to")
    held = (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    keys = [*on, "__bin"]
    return spread_left_join(left, cut, keys, heavy_keys(counts, keys), [c for c in big.columns], held).drop("__bin")
