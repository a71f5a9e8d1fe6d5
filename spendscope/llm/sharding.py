"""Sharding by extendible hashing.

A document's hash (60 bits of the md5 of its id) names its bucket by a
prefix; the directory starts with one bucket (no bit), and only buckets
above the byte limit split on one more bit, until every one fits.  The
bits are taken ``STEP`` at a time: one pre-aggregated pass over the rows that
have no shard yet sums the bytes of all buckets on the next ``STEP`` levels.

Documents of one hash (repeated ids) cannot be told apart by bits; where
they exceed the limit together they go to overflow pages of their bucket.
Only a document that alone exceeds the limit makes a shard that does.

Defined results: a null text has 0 bytes; a null id is hashed as empty text;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.llm.common import Scratch, prefix_sums

SHARD_BYTES = 64 * 1024 * 1024
BITS = 60
STEP = 8


def id_hash(id_col: str):
    """The first 60 bits of the id's md5, as a number."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10) \
        .cast("long")


def shards(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES,
           row_col: str | None = None) -> DataFrame:
    """One row per input row: ``id_col``, n_bytes, depth (bits of its bucket), prefix (their
    value), page (null, or the overflow page), shard (the bits as text, and the page), and
    ``row_col``, a column of ``df`` that tells rows of one id apart."""
    own = [row_col] if row_col else []
    scratch = Scratch(df.sparkSession, "sharding")
    left = scratch.table(df.select(F.col(id_col).alias("id"), id_hash(id_col).alias("h"),
                                   F.octet_length(F.coalesce(text_col, F.lit(""))).cast("long").alias("n_bytes"), *own), "rows")
    placed = []
    for depth in range(0, BITS, STEP):
        below = min(BITS, depth + STEP)
        fine = F.shiftright("h", BITS - below)
        buckets = left.groupBy(fine.alias("fine")).agg(F.sum("n_bytes").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        nodes = scratch.table(buckets.withColumn("depth", F.explode(F.sequence(F.lit(depth), F.lit(below))))
                              .withColumn("prefix", F.expr(f"shiftright(fine, cast({below} - depth AS int))")), "nodes")
        fits = nodes.groupBy("depth", "prefix").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")) \
            .where((F.col("n") <= limit) | (F.col("lo") == F.col("hi"))) \
            .select("depth", "prefix", (F.col("n") > limit).alias("over"))
        directory = scratch.table(nodes.join(fits, ["depth", "prefix"]).groupBy("fine")
                                  .agg(F.min(F.struct("depth", "over")).alias("leaf")).select("fine", "leaf.*"), "directory")
        rows = left.withColumn("fine", fine)
        placed.append(rows.join(directory, "fine").drop("fine"))
        if directory.count() == buckets.count():
            break
        rest = scratch.table(rows.join(directory, "fine", "left_anti").drop("fine"), "rest")
        left = rest
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    out = scratch.table(out.withColumn("prefix", F.expr(f"shiftright(h, cast({BITS} - depth AS int))")), "placed")

    half = limit // 2
    over = scratch.table(out.where("over").withColumn("large", F.col("n_bytes") > half)
                         .withColumn("weight", F.when(F.col("large"), F.lit(half)).otherwise(F.col("n_bytes"))), "over")
    # pages of half the limit take one more document of at most half; larger ones have a page each
    paged = prefix_sums(over, scratch, ["depth", "prefix", "large"], ["id", "n_bytes", *own], "weight", "before") \
        .withColumn("page", F.floor(F.col("before") / max(1, half)).cast("long")) \
        .withColumn("page", F.when(F.col("large"), -1 - F.col("page")).otherwise(F.col("page")))
    out = out.where("NOT over").withColumn("page", F.lit(None).cast("long")) \
        .unionByName(paged.drop("large", "weight", "before"))
    bits = F.lpad(F.conv("prefix", 10, 2), F.col("depth"), F.lit("0"))
    return out.select(F.col("id").alias(id_col), "n_bytes", F.col("depth").cast("int").alias("depth"), "prefix", "page",
                      F.concat(F.when(F.col("depth") == 0, "").otherwise(bits),
                               F.when(F.col("page").isNotNull(), F.concat(F.lit("."), "page")).otherwise("")).alias("shard"), *own)


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES) -> None:
    """Write ``df`` as Parquet, one folder per shard."""
    if "shard" in df.columns:
        raise ValueError("the column shard names the folders")
    scratch = Scratch(df.sparkSession, "write-shards")
    # rows are numbered in a written table, as an id may repeat on several pages
    rows = scratch.table(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    where = shards(rows, id_col, text_col, limit, "__row").select("__row", F.concat(F.lit("s"), "shard").alias("shard"))
    rows.join(where, "__row").drop("__row").repartition("shard").write.partitionBy("shard").parquet(path)
    scratch.drop(rows)
