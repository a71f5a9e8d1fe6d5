"""Exact dedup by a heavy-hitter split (DataFrame functions only).

Texts are equal when identical after deleting ``[\\x20\\x09-\\x0D]``; null
counts as empty.  A Misra-Gries sketch over the digests (Spark's
``approx_top_k``, a frequent-items sketch with a fixed number of counters)
names the digests that may hold many rows.  Their winners are found
exactly with one pre-aggregated pass and broadcast (at most ``HEAVY``
rows), so the rows of large groups are settled map-side and never
shuffled.  All other digests have few rows each and take an ordinary
shuffle by digest.

Defined results: null text equals empty text; of equal texts the row with
the most code points stays, then the smallest id (null ids last); of rows
that tie in both exactly one stays; an empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendscope.llm.common import Scratch

HEAVY = 1000  # most digests that are broadcast
COUNTERS = 10_000  # counters of the sketch: a digest above 1/2000 of all rows is found for certain


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for c in (" ", "\n", "\t", "\r", "\x0b", "\x0c"):
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def digest_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_cp, text_sha256, row): row tells repeated rows apart once written."""
    return df.select(F.col(id_col).alias("id"), F.length(F.coalesce(text_col, F.lit(""))).cast("long").alias("n_cp"),
                     F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"),
                     F.monotonically_increasing_id().alias("row"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256, n_cp."""
    scratch = Scratch(df.sparkSession, "exact-dedup")
    rows = scratch.table(digest_table(df, id_col, text_col), "digests")

    sketch = rows.agg(F.expr(f"approx_top_k(text_sha256, {HEAVY}, {COUNTERS})").alias("top"))
    candidates = sketch.select(F.explode("top.item").alias("text_sha256"))
    rank = F.struct((-F.col("n_cp")).alias("n"), F.col("id").isNull().alias("no_id"), "id", "row")
    winners = scratch.table(
        rows.join(F.broadcast(candidates), "text_sha256").groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), F.min(rank).alias("best")).where("group_size > 1")
        .select("text_sha256", "group_size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row")),
        "winners")

    heavy = rows.join(F.broadcast(winners), "text_sha256")
    group = Window.partitionBy("text_sha256")
    first = group.orderBy(F.desc("n_cp"), F.asc_nulls_last("id"), "row")
    light = rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti") \
        .withColumn("group_size", F.count("*").over(group)) \
        .withColumn("keep_id", F.first("id").over(first)).withColumn("keep_row", F.first("row").over(first))
    columns = [F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
               "text_sha256", "n_cp"]
    return heavy.select(*columns).unionByName(light.select(*columns))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with ``df``'s own columns."""
    own = [F.col(f"`{c}`") for c in df.columns]
    kept = exact_dedup(df, id_col, text_col).where("kept") \
        .select(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha"), F.col("n_cp").alias("__n"))
    # rows equal in id, digest and length are repeats of one row: one of them stays
    marked = df.withColumn("__sha", F.sha2(normalised(F.col(text_col)), 256)) \
        .withColumn("__n", F.length(F.coalesce(text_col, F.lit(""))).cast("long")).withColumn("__id", F.col(id_col))
    keys = ["__id", "__sha", "__n"]
    k = kept.select(*[F.col(c).alias(f"k{c}") for c in keys])
    on = [F.col(c).eqNullSafe(F.col(f"k{c}")) for c in keys]
    return marked.join(k, on, "left_semi").dropDuplicates(keys).select(*own)
