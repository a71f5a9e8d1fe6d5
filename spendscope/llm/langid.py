"""Language ID by hierarchical discrimination.

Texts are vectors of hashed letter 1- to 3-grams (lower case, word edges
included).  One-versus-one linear support vector machines first choose the
language family, then those of the family's languages choose among them.
All machines are fitted on a bounded sample (``PER_LANGUAGE`` labelled
texts of each language), each in a Spark task of its own.

Defined results: a null text, or one without a letter, is ``und`` with
score 0; texts of any length are read whole; labels that are null teach
nothing; a language outside ``FAMILIES`` is a family of its own; without
any label every text is ``und``; an empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from spendscope.llm.common import Scratch
from spendscope.llm.text import chunks, code_points, is_letter, which

DIMENSIONS = 4096
PER_LANGUAGE = 800  # most labelled texts of a language that are learned from
LEAST_SCORE = 0.5  # below, the best language has lost to another one
MAX_MACHINES = 5000  # of 16 KB each, broadcast
STEPS = 200
RIDGE = 1e-4
UNDETERMINED = "und"

FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk"),
}


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), f"only:{lang}")


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (square roots of the gram counts), and which texts have a letter."""
    codes, starts = code_points([t.lower() for t in texts])
    letter = which(codes, is_letter)
    c = np.where(letter, codes, 0).astype(np.uint32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64) * DIMENSIONS, np.diff(starts))
    counts = np.zeros(len(texts) * DIMENSIONS)
    before, after = np.roll(c, 1), np.roll(c, -1)  # a newline ends every text, so none reaches into the next
    for gram in (c * np.uint32(0x9E3779B1), before * np.uint32(0x85EBCA6B) + c * np.uint32(0xC2B2AE35) + np.uint32(1),
                 before * np.uint32(0x27D4EB2F) + c * np.uint32(0x165667B1) + after * np.uint32(0xD3A2646D) + np.uint32(2)):
        gram ^= gram >> np.uint32(15)
        gram *= np.uint32(0x2C1B3C6D)
        at = (gram >> np.uint32(20)).astype(np.int64) + doc
        counts += np.bincount(at[letter], minlength=len(counts))
    x = np.sqrt(counts.reshape(len(texts), DIMENSIONS)).astype(np.float32)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.maximum(norm, 1e-9), norm[:, 0] > 0


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Linear support vector machine (squared hinge, classes of equal weight), the
    last weight being the bias; accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = v = np.zeros(x.shape[1], np.float32)
    t = 1.0
    for _ in range(STEPS):
        gap = np.maximum(0, 1 - y * (x @ v))
        step = v + (2 * (x.T @ (share * y * gap)) - RIDGE * v) / (4 + RIDGE)
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        w, v, t = step, step + (t - 1) / after * (step - w), after
    return w.astype(np.float32)


def learn(labelled: DataFrame, scratch: Scratch, per_language: int = PER_LANGUAGE) -> list[tuple[str, str, str, bytes]]:
    """Machines (level, a, b, weights): positive speaks for a.  ``labelled`` has
    (id, text, lang); level is "family" or a family's name, or "lang" for the
    mere name of a learned language."""
    counts = scratch.table(labelled.where("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n")), "counts")
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(1 << 30)) / float(1 << 30)
    drawn = labelled.where("text IS NOT NULL").join(counts, "lang").withColumn("draw", draw) \
        .where(F.col("draw") * F.col("n") < 1.5 * per_language).select("lang", "draw", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch.column(2).to_pylist()):
                for a in range(0, len(texts), 64):
                    x, ok = features(texts[a:a + 64])
                    rows = ok.nonzero()[0]
                    at = pa.array(rows + first + a)
                    grams = [x[r].nonzero()[0].astype(np.uint16) for r in rows]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(1).take(at), pa.array([g.tobytes() for g in grams], pa.binary()),
                         pa.array([x[r][g].tobytes() for r, g in zip(rows, grams)], pa.binary())],
                        names=["lang", "draw", "grams", "vals"])

    sample = drawn.mapInArrow(vectors, "lang string, draw double, grams binary, vals binary")
    order = Window.partitionBy("lang").orderBy("draw", "grams", "vals")
    sample = scratch.table(sample.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language), "sample")
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().limit(MAX_MACHINES + 1).collect())
    families = sorted({family_of(x) for x in langs})
    pairs = [("family", a, b) for i, a in enumerate(families) for b in families[i + 1:]]
    pairs += [(family_of(a), a, b) for i, a in enumerate(langs) for b in langs[i + 1:] if family_of(a) == family_of(b)]
    if len(pairs) > MAX_MACHINES:
        raise ValueError(f"{len(langs)} languages need {len(pairs)} machines; at most {MAX_MACHINES} are broadcast")
    known = [("lang", x, x, b"") for x in langs]
    if not pairs:
        return known
    spark = labelled.sparkSession
    roles = [(x, level, a, b, 1 if (family_of(x) if level == "family" else x) == a else -1)
             for level, a, b in pairs for x in langs if (family_of(x) if level == "family" else x) in (a, b)]
    roles_df = spark.createDataFrame(roles, "lang string, level string, a string, b string, y int")

    def fit_one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["lang", "nth"])
        x = np.zeros((len(pdf), DIMENSIONS), np.float32)
        for i, (g, v) in enumerate(zip(pdf.grams, pdf.vals)):
            x[i, np.frombuffer(g, np.uint16)] = np.frombuffer(v, np.float32)
        return pd.DataFrame({"level": [key[0]], "a": [key[1]], "b": [key[2]],
                             "w": [fit(x, pdf.y.to_numpy(np.float32)).tobytes()]})

    machines = sample.join(F.broadcast(roles_df), "lang").groupBy("level", "a", "b") \
        .applyInPandas(fit_one, "level string, a string, b string, w binary")
    return known + sorted((r["level"], r["a"], r["b"], bytes(r["w"])) for r in machines.collect())


def winners(margins: np.ndarray, pairs: list[tuple[int, int]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the class with most won duels (then the larger sum of margins, then
    the first), and the probability of its weakest duel."""
    votes = np.zeros((len(margins), n))
    for j, (a, b) in enumerate(pairs):
        m = margins[:, j]
        votes[:, a] += (m >= 0) + 1e-3 * np.tanh(m)
        votes[:, b] += (m < 0) - 1e-3 * np.tanh(m)
    best = votes.argmax(axis=1)
    sure = np.ones(len(margins))
    for j, (a, b) in enumerate(pairs):
        p = 1 / (1 + np.exp(-4 * margins[:, j]))
        sure = np.where(best == a, np.minimum(sure, p), np.where(best == b, np.minimum(sure, 1 - p), sure))
    return best, sure


class Identifier:
    """The fitted machines: family first, then the languages within it."""

    def __init__(self, machines: list[tuple[str, str, str, bytes]]):
        self.langs = sorted(a for level, a, _, _ in machines if level == "lang")
        levels: dict[str, list] = {}
        for level, a, b, w in machines:
            if w:
                levels.setdefault(level, []).append((a, b, np.frombuffer(w, np.float32)))
        self.families = sorted({family_of(x) for x in self.langs})
        self.levels = {}
        for level, ms in levels.items():
            classes = sorted({x for a, b, _ in ms for x in (a, b)})
            self.levels[level] = (classes, [(classes.index(a), classes.index(b)) for a, b, _ in ms],
                                  np.stack([w for _, _, w in ms]))

    def _choose(self, level: str, x: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        classes, pairs, w = self.levels[level]
        return classes, *winners(x @ w[:, :-1].T + w[:, -1], pairs, len(classes))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        x, ok = features(texts)
        lang, score = np.empty(len(texts), object), np.ones(len(texts))
        if "family" in self.levels:
            classes, best, score = self._choose("family", x)
            family = np.array(classes, object)[best]
        else:
            family = np.full(len(texts), self.families[0], object)
        for f in set(family):
            at = (family == f).nonzero()[0]
            members = [m for m in self.langs if family_of(m) == f]
            if f in self.levels:
                classes, best, sure = self._choose(f, x[at])
                lang[at] = np.array(classes, object)[best]
                score[at] = np.minimum(score[at], sure)
            else:
                lang[at] = members[0]
        lang[~ok], score[~ok] = UNDETERMINED, 0.0
        return list(lang), score


def _predicted(df: DataFrame, trained_on: Column, id_col: str, text_col: str, lang_col: str, columns: list[str],
               per_language: int) -> DataFrame:
    """``columns`` as c0, c1, ..., with lang_pred and score; learns from the rows where
    ``trained_on`` holds."""
    spark = df.sparkSession
    scratch = Scratch(spark, "langid")
    labelled = df.where(trained_on).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    machines = spark.sparkContext.broadcast(learn(labelled, scratch, per_language))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Identifier(machines.value)
        for batch in batches:
            lang, score = [], []
            for _, texts in chunks([t or "" for t in batch.column(0).to_pylist()]):
                for a in range(0, len(texts), 64):
                    found, sure = model.predict(texts[a:a + 64])
                    lang += found
                    score += sure.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*[f"c{i}" for i in range(len(columns))], "lang_pred", "score"])

    schema = T.StructType([T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(columns)]
                          + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return df.select(F.col(text_col).alias("t"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]) \
        .mapInArrow(predict, schema)


def identify(df: DataFrame, trained_on: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_language: int = PER_LANGUAGE) -> DataFrame:
    """``id_col``, lang_pred and score of every row."""
    return _predicted(df, trained_on, id_col, text_col, lang_col, [id_col], per_language) \
        .select(F.col("c0").alias(id_col), "lang_pred", "score")


def of_known_language(df: DataFrame, trained_on: Column, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang", per_language: int = PER_LANGUAGE, languages: Sequence[str] | None = None,
                      least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``df``, with its own columns, whose predicted language is one of ``languages``
    (without them: any learned one) and is told with ``least_score``: a text that no machine
    tells, or whose best language loses to another one, is rejected."""
    found = _predicted(df, trained_on, id_col, text_col, lang_col, df.columns, per_language)
    wanted = F.col("lang_pred") != UNDETERMINED if languages is None else F.col("lang_pred").isin(*languages)
    return found.where(wanted & (F.col("score") >= least_score)).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])
