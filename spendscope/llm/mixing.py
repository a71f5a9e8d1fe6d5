"""Mixing sources to target weights.

Every document gets a hash-random key (md5 of its id).  Sources are
range-sorted by key, distributed prefix sums of the sizes place each
document in its source, and the source is cut at its exact budget:
whole epochs first, then the documents up to the rest.

Sizes are numbers of ``[^\\x20\\x09-\\x0D]+`` in the text (null: 0).  Sources
in code point order (null last) weigh 5, 2, 1, repeating; together they
get ``SHARE`` of all sizes, none more than ``MOST`` times its own size, and
what that leaves over is shared again by weight.

Defined results: a null source is a source of its own; an empty text has
size 0 and is taken 0 times; repeated rows are separate documents; rows
with the same id order by size; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.llm.common import Scratch, prefix_sums

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2


def source_targets(sizes: DataFrame, scratch: Scratch, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    The fair level (words per unit of weight) rises while sources that
    reach their cap drop out; each step is one aggregate over the table of
    sources, until no further source is above its cap."""
    per = scratch.table(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                        .withColumn("one", F.lit(1)).withColumn("all", F.lit(0)), "sources")
    # the rank of a source: a prefix sum of ones, its nulls last
    ranked = prefix_sums(per.withColumn("last", F.col("source").isNull()), scratch, ["all"], ["last", "source"],
                         "one", "rank")
    cycle = F.array(*[F.lit(w) for w in weights])
    per = scratch.table(ranked.select("source", "source_size", F.element_at(
        cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight")), "weights")
    total = share * (per.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        above = (F.col("source_size") * most) < F.lit(level) * F.col("weight")
        n, full, rest = per.agg(F.count(F.when(above, 1)), F.sum(F.when(above, F.col("source_size") * most)),
                                F.sum(F.when(~above, F.col("weight")))).first()
        if n == capped or not rest:
            break
        level, capped = (total - (full or 0)) / rest, n
    target = F.when((F.col("source_size") * most) < F.lit(level) * F.col("weight"),
                    (F.col("source_size") * most).cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share=SHARE, most=MOST, extra: dict | None = None) -> DataFrame:
    """One row per input row: ``id_col``, source, size, source_size, target,
    taken (words), and the columns of ``extra`` (name: expression)."""
    scratch = Scratch(df.sparkSession, "mixing")
    extra = extra or {}
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
    docs = scratch.table(df.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key"),
        *[e.alias(n) for n, e in extra.items()]), "sizes")
    targets = source_targets(docs, scratch, weights, share, most) \
        .select(F.col("source").alias("__source"), "source_size", "target")
    placed = prefix_sums(docs, scratch, ["source"], ["key", "id", "size"], "size", "start")
    out = placed.join(targets, F.col("source").eqNullSafe(F.col("__source")))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("start")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return out.select(F.col("id").alias(id_col), "source", "size", "source_size", "target",
                      taken.cast("long").alias("taken"), *extra)


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **options) -> DataFrame:
    """The documents of the mix with ``df``'s own columns, each as often as its
    taken words, rounded to whole documents, say (half and more counts up)."""
    own = [F.col(f"`{c}`") for c in df.columns]
    sha = F.sha2(F.coalesce(text_col, F.lit("")), 256)
    decided = mix(df, id_col, text_col, source_col, extra={"__sha": sha}, **options) \
        .withColumn("times", F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0))
    # repeats of one row are settled together: their times add up
    decided = decided.groupBy(F.col(id_col).alias("k__id"), F.col("source").alias("k__source"), F.col("__sha").alias("k__sha")) \
        .agg(F.sum("times").alias("__times")).where("__times > 0")
    keys = ["__id", "__source", "__sha"]
    marked = df.withColumn("__id", F.col(id_col)).withColumn("__source", F.col(source_col)).withColumn("__sha", sha)
    on = [F.col(c).eqNullSafe(F.col(f"k{c}")) for c in keys]
    return marked.dropDuplicates(keys).join(decided, on) \
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(*own)
