"""Helpers shared by the operators: written intermediate tables, distributed
prefix sums, connected components and streaming over sorted groups."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendscope.session import ensure_checkpoint_dir


class Scratch:
    """Intermediate tables of one operator run, as Parquet in the shared
    folder that ``spark.checkpoint.dir`` names.  A written table cuts the
    lineage, so a lost executor costs the running tasks only."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{self.n}-{name}"
        self.n += 1
        # shuffle files of earlier jobs go once the driver's JVM sees that nothing holds them
        self.spark.sparkContext._jvm.System.gc()
        df.write.parquet(path)
        out = self.spark.read.parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that nothing reads any more."""
        for t in tables:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(df: DataFrame, scratch: Scratch, group: list[str], order: list[str],
                value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` (never null) over the earlier rows of the
    same group, in ``order``.

    ``df`` should be a written, narrow table.  It is dealt by range of
    (group, order), so a hot group lies in many partitions; each partition
    sums its own rows, and the sums of the earlier partitions of the group
    are added.  Rows that tie in ``order`` get distinct ranges in any order.
    """
    n = shuffle_partitions(df.sparkSession)
    keys = [c for k in group for c in (F.col(k).isNull(), F.col(k))]
    t = scratch.table(df.repartitionByRange(n, *keys, *order).withColumn("__pid", F.spark_partition_id()), "ranged")
    earlier = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = t.groupBy(*group, "__pid").agg(F.sum(value).alias("__sum"))
    sums = sums.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__pid").alias("__p"),
                       F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*group, "__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    on = F.col("__pid") == F.col("__p")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return t.join(sums, on).withColumn(out, F.col("__before") + F.col("__inside")) \
        .drop("__pid", "__p", "__before", "__inside", *[f"__g{i}" for i in range(len(group))])


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for the undirected ``edges`` (a, b: long): the
    component is its smallest node.

    Alternating large-star and small-star steps: every round each node is
    linked to the smallest node it sees, so stars form in a number of
    rounds that grows with the logarithm of the size.  Rows stay at most
    as many as the edges; each round is written, and its predecessor
    removed.  Neighbourhoods are only ever aggregated (min), not collected.
    """
    e = scratch.table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "edges")
    known = None
    while True:
        # large star: the neighbours above a node join its smallest neighbour
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.table(large.where("a <> b").distinct(), "large")
        # small star: a node and its smaller neighbours join the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        nxt = scratch.table(small.where("a <> b").distinct(), "small")
        state = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        scratch.drop(e, large)
        e = nxt
        if state == known:
            break
        known = state
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def sorted_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups, one after the other, of a partition that is sorted by ``keys``."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if pdf.empty:
            continue
        change = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy()
        change[0] = not held or any(held[-1][k].iloc[-1] != pdf[k].iloc[0] for k in keys)
        starts = [*change.nonzero()[0], len(pdf)]
        if starts[0] > 0:
            held.append(pdf.iloc[:starts[0]])
        if len(starts) > 1 and held:
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        for a, b in zip(starts[:-2], starts[1:-1]):
            yield pdf.iloc[a:b]
        if len(starts) > 1:
            held = [pdf.iloc[starts[-2]:]]
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]
