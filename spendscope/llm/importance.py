"""Importance resampling towards a target distribution.

Words (ASCII lower-cased) and their runs of up to ``max_n`` are hashed into
``buckets``; the corpus and the target texts are counted per bucket, and a
bucket's gain is its scaled log ratio, one dense array.  A document's
weight is the sum of the array over its features; hash-seeded Gumbel noise
makes the top scores a draw without replacement in proportion to the
weights.

The draw is a distributed quickselect: a round takes a few random
candidates as pivot keys, one aggregation counts exactly what lies below,
at and above each, and the candidates narrow to the gap that holds the
k-th composite key (score downwards, id, row).  Only the winners are then
sorted, by range, and ranked by prefix sums.

Defined results: null text has no word and weighs 0; a null id is hashed
as empty text and comes last in ties; rows that tie in score and id are
taken in any order, one at a time, so exactly k are drawn; without target
texts the gains only follow the smoothing; an empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.llm.common import Scratch, prefix_sums

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
PIVOTS = 24  # random pivot keys of a round


def _separators() -> bytes:
    """A byte table: letters A-Z to lower case, bytes that end words to spaces."""
    kept = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
    return bytes(c + 32 if 65 <= c <= 90 else c if c in kept else 32 for c in range(256))


TABLE = _separators()


def feature_buckets(text: bytes, max_n: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the buckets of all runs of 1 to ``max_n`` words."""
    words = text.translate(TABLE).split()
    sums = list(map(zlib.crc32, words))
    found = list(sums)
    for k in range(1, max_n):
        sums = [zlib.crc32(b" " + w, c) for w, c in zip(words[k:], sums)]
        found += sums
    return len(words), (np.array(found, np.int64) % buckets)


def bucket_counts(texts: DataFrame, max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over the one text column; every task hands on one row per bucket it saw."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for b in pc.fill_null(batch.column(0), "").cast(pa.binary()).to_pylist():
                total += np.bincount(feature_buckets(b, max_n, buckets)[1], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    return texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of every bucket (add-one smoothing), floors go down."""
    all_s, all_t, k = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_s + k) / ((s + 1.0) * (all_t + k))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(seeded: str) -> int:
    h = int(hashlib.sha256(seeded.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(df: DataFrame, gain: np.ndarray, id_col: str, text_col: str, max_n: int, seed: int) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rows = []
            for b, seeded in zip(pc.fill_null(batch.column(2), "").cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                n, found = feature_buckets(b, max_n, len(own))
                weight = int(own[found].sum())
                rows.append((n, len(found), weight, weight + noise(seeded)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]],
                                             names=["id", "n_words", "n_features", "weight", "score"])

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType)] + T._parse_datatype_string(
        "n_words long, n_features long, weight long, score long").fields)
    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return df.select(F.col(id_col).alias("id"), seeded.alias("seeded"), F.col(text_col).alias("text")).mapInArrow(score, schema)


ORDER = ("down", "no_id", "id", "row")  # the composite key: -score, null ids last, id, row


def _key(values=None, id_type: T.DataType | None = None) -> Column:
    if values is None:
        return F.struct(*ORDER)
    down, no_id, i, row = values
    return F.struct(F.lit(down).cast("long").alias("down"), F.lit(no_id).alias("no_id"), F.lit(i).cast(id_type).alias("id"),
                    F.lit(row).cast("long").alias("row"))


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS):
    """The k-th smallest composite key (from 1) of a written table with the columns of
    ``ORDER``, whose keys differ; None if there are fewer rows."""
    id_type = rows.schema["id"].dataType
    low = high = None
    before, round_no = 0, 0  # rows at or below ``low``
    while True:
        left = rows
        if low is not None:  # the first part of the key alone reaches the scan
            left = left.where((F.col("down") >= low[0]) & (_key() > _key(low, id_type)))
        if high is not None:
            left = left.where((F.col("down") <= high[0]) & (_key() < _key(high, id_type)))
        drawn = left.orderBy(F.xxhash64("row", F.lit(round_no)), "row").limit(pivots).select(*ORDER).collect()
        if not drawn:
            return None
        drawn = sorted((tuple(r) for r in drawn), key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0, r[3]))
        counted = left.agg(*[f(c) for p in drawn for c in [_key(p, id_type)]
                             for f in (lambda c: F.count_if(_key() < c), lambda c: F.count_if(_key() == c))]).first()
        reached = before
        for i, p in enumerate(drawn):
            below, at = before + counted[2 * i], counted[2 * i + 1]
            if below < k <= below + at:
                return p
            if k <= below:
                high = p
                break
            low, reached = p, below + at
        before = reached
        round_no += 1


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, max_n: int = 1, buckets: int = BUCKETS,
             seed: int = SEED) -> DataFrame:
    """``id_col``, n_features, weight, score and rank (null: not drawn) of every row: of the rows
    with ``least_words`` words, ``percent`` in a hundred are drawn."""
    scratch = Scratch(df.sparkSession, "importance")

    def dense(texts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for r in bucket_counts(texts, max_n, buckets).collect():  # at most ``buckets`` rows
            out[r["bucket"]] = r["n"]
        return out

    gain = gains(dense(df.select(text_col)), dense(target.select(target_text_col)))
    rows = scratch.table(
        scores(df, gain, id_col, text_col, max_n, seed).select(
            "*", (-F.col("score")).alias("down"), F.col("id").isNull().alias("no_id"),
            F.monotonically_increasing_id().alias("row")), "scores")
    able = F.col("n_words") >= least_words
    k = rows.where(able).count() * percent // 100
    last = kth_key(rows.where(able), k) if k else None
    if last is None:
        drawn, rest = rows.where(F.lit(False)), rows
    else:
        wins = able & (_key() <= _key(last, rows.schema["id"].dataType))
        drawn, rest = rows.where(wins), rows.where(~wins)
    ranked = prefix_sums(drawn.withColumn("one", F.lit(1).cast("long")), scratch, [], list(ORDER), "one", "earlier")
    both = ranked.withColumn("rank", F.col("earlier") + 1).drop("one", "earlier") \
        .unionByName(rest.withColumn("rank", F.lit(None).cast("long")))
    return both.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
