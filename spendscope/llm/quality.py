"""Quality classifier: random Fourier features over document statistics.

Every text becomes ``STATISTICS`` numbers (lengths, shares of character
classes, repetition of words and lines).  Cosines of random projections of
the standardised numbers approximate a Gaussian kernel; each partition of
the training rows sums its part of the normal equations, one matrix per
fold, and the folds' sums solve the ridge regression.  Leaving a fold's
matrix out gives scores for its rows that never saw them: these choose the
penalty and fit the isotonic (pool adjacent violators) calibration that
turns raw scores into probabilities.

At most ``TRAIN_ROWS`` labelled texts are learned from, drawn by hash of
their ids; the statistics cover every whole text.

Defined results: null text equals empty text, whose statistics are all
zero, and is scored like any other; null labels teach nothing, and of
labels that disagree the lower counts; rows that repeat an id with
different texts all teach; without training rows of both classes the score
is the only class seen, or 0 without any; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.llm.common import Scratch

TRAIN_ROWS = 50_000  # most labelled rows that are learned from
FEATURES = 256  # random cosines
FOLDS = 5
PARTS = 16  # partitions of the training rows
PENALTIES = (0.01, 0.1, 1.0, 10.0, 100.0)
SEED = 12
CLIP = 6.0  # standardised statistics end here
TIE_SHARE = 0.001  # part of the score that keeps the raw order within a calibrated plateau

#: Character classes by byte; bytes from 128 on are parts of other letters.
CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"#$%&*", b"|", b"@/\\_=+~^`",
           b"()[]{}<>", b"\"'-", b"\n", bytes(range(128, 256))]


def statistics(text: bytes) -> list[float]:
    """The numbers that describe a text (UTF-8)."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * STATISTICS
    present = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = present / len(text)
    some = share[share > 0]
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    follows = sum(map(eq, words, words[1:]))
    triples = len(set(zip(words, words[1:], words[2:])))
    return [
        np.log1p(n), np.log1p(len(lines)), np.log1p(n / len(lines)),
        *[np.sqrt(present[list(c)].sum() / len(text)) for c in CLASSES],
        float(-(some * np.log(some)).sum()),
        np.log1p(lengths.mean()), np.log1p(lengths.std()), np.log1p(float(lengths.max())),
        len(counts) / n, np.log(len(counts)) / np.log(n + 1), counts.most_common(1)[0][1] / n, follows / n,
        triples / max(1, n - 2), len(set(lines)) / len(lines),
        sum(w.isupper() for w in words) / n, sum(w.istitle() for w in words) / n,
    ]


STATISTICS = 3 + len(CLASSES) + 12


def document_statistics(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, x): every row's statistics."""
    kind = pa.list_(pa.float64())

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([statistics(b) for b in texts], kind)], names=["id", "x"])

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(describe, schema)


class Kernel:
    """Standardisation and random cosines: a Gaussian kernel whose width is the root of the number of statistics."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int, seed: int):
        draw = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = draw.standard_normal((len(mean), features)) / np.sqrt(len(mean))
        self.b = draw.uniform(0, 2 * np.pi, features)

    def features(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        return np.hstack([np.ones((len(x), 1)), np.sqrt(2 / len(self.b)) * np.cos(x @ self.w + self.b)])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def normal_equations(train: DataFrame, kernel: Kernel, folds: int = FOLDS) -> list[np.ndarray]:
    """Per fold the summed matrix [Z y]'[Z y] of the training rows (x, y, fold): each partition
    sums its own, and the partitions' matrices are added, in the order of their numbers."""
    shared = train.sparkSession.sparkContext.broadcast(kernel)
    size = len(kernel.b) + 2

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, sums = shared.value, {}
        for batch in batches:
            z = np.hstack([own.features(matrix(batch.column(0), len(own.mean))), batch.column(1).to_numpy()[:, None]])
            fold = batch.column(2).to_numpy()
            for f in np.unique(fold):
                sums[int(f)] = sums.get(int(f), 0) + z[fold == f].T @ z[fold == f]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([part] * len(sums), pa.int32()),
                                          pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["fold", "part", "m"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:  # at most PARTS rows
        m = sum(np.frombuffer(b) for b in pdf.sort_values("part")["m"])
        return pd.DataFrame({"fold": pdf["fold"].iloc[:1], "m": [m.tobytes()]})

    found = train.select("x", "y", "fold").mapInArrow(add, "fold int, part int, m binary") \
        .groupBy("fold").applyInPandas(total, "fold int, m binary").collect()
    out = [np.zeros((size, size)) for _ in range(folds)]
    for r in found:
        out[r["fold"]] = np.frombuffer(r["m"]).reshape(size, size)
    return out


def ridge(m: np.ndarray, penalty: float) -> np.ndarray:
    a = m[:-1, :-1] + penalty * np.eye(len(m) - 1)
    a[0, 0] -= penalty * 0.999  # the constant is hardly held back
    return np.linalg.solve(a, m[:-1, -1])


def squared_error(m: np.ndarray, w: np.ndarray) -> float:
    v = np.append(w, -1.0)
    return float(v @ m @ v)


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (mean score, mean label) of the blocks, both increasing."""
    at, where = np.unique(score, return_inverse=True)
    n = np.bincount(where).astype(float)
    blocks: list[list[float]] = []  # rows, sum of labels, sum of scores
    for x, k, s in zip(at, n, np.bincount(where, y)):
        blocks.append([k, s, k * x])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 2] / b[:, 0], b[:, 1] / b[:, 0]


class Model:
    def __init__(self, kernel: Kernel, w: np.ndarray, at: np.ndarray, value: np.ndarray):
        self.kernel, self.w, self.at, self.value = kernel, w, at, value

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.kernel.features(x) @ self.w

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        even = 1 / (1 + np.exp(-4 * np.clip(raw - 0.5, -8, 8)))
        return (1 - TIE_SHARE) * np.interp(raw, self.at, self.value) + TIE_SHARE * even


def learn(stats: DataFrame, labels: DataFrame, scratch: Scratch, train_rows: int, features: int, seed: int) -> Model | float:
    """Fit on (id, x) and labels (id, y); without both classes, the only one."""
    labels = labels.where("y IN (0, 1) AND id IS NOT NULL").groupBy("id").agg(F.min("y").cast("double").alias("y"))
    drawn = labels.orderBy(F.xxhash64("id"), "id").limit(train_rows)
    fold = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(FOLDS)).cast("int")
    train = scratch.table(stats.join(F.broadcast(drawn), "id").select("id", "x", "y", fold.alias("fold"))
                          .repartition(PARTS, "id").sortWithinPartitions("id", F.xxhash64("x")), "train")
    shape = train.agg(F.count("*").alias("n"), F.sum("y").alias("good"), *[
        f(F.col("x")[i]).alias(f"{k}{i}") for i in range(STATISTICS) for k, f in (("m", F.mean), ("s", F.stddev_pop))]).first()
    if not shape["n"] or shape["good"] in (0, shape["n"]):
        return 1.0 if shape["good"] else 0.0
    mean, scale = (np.array([shape[f"{k}{i}"] for i in range(STATISTICS)]) for k in "ms")
    kernel = Kernel(mean, np.maximum(scale, 1e-3), features, seed)
    per_fold = normal_equations(train, kernel)
    every = sum(per_fold)
    rest = [every - m for m in per_fold]
    penalty = min(PENALTIES, key=lambda p: sum(squared_error(m, ridge(r, p)) for m, r in zip(per_fold, rest)))
    unseen = np.stack([ridge(r, penalty) for r in rest])
    pdf = train.select("x", "y", "fold").toPandas()  # at most train_rows (more only where ids repeat)
    z = kernel.features(np.stack(pdf["x"].to_numpy()))
    raw = (z * unseen[pdf["fold"].to_numpy()]).sum(axis=1)
    return Model(kernel, ridge(every, penalty), *isotonic(raw, pdf["y"].to_numpy()))


def quality(df: DataFrame, labels: DataFrame, trained_on: Column, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", train_rows: int = TRAIN_ROWS, features: int = FEATURES, seed: int = SEED) -> DataFrame:
    """``id_col`` and score (0 to 1, higher: the label is likelier 1) of every row.
    ``trained_on`` says over ``labels`` which of them may be learned."""
    scratch = Scratch(df.sparkSession, "quality")
    stats = scratch.table(document_statistics(df, id_col, text_col), "statistics")
    model = learn(stats, labels.where(trained_on).select(F.col(id_col).alias("id"), F.col(label_col).alias("y")), scratch,
                  train_rows, features, seed)
    if isinstance(model, float):
        return stats.select(F.col("id").alias(id_col), F.lit(model).alias("score"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = own.score(matrix(batch.column(1), len(own.kernel.mean)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["id", "score"])

    schema = T.StructType([stats.schema["id"], T.StructField("score", T.DoubleType())])
    return stats.mapInArrow(score, schema).select(F.col("id").alias(id_col), "score")
