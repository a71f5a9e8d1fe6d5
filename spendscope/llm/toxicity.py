"""Toxicity by maximum-scoring segment search.

Tokens are lower-case letter runs and their beginnings of ``PREFIXES``
letters (so that inflected words count), as 64-bit hashes.  Those of toxic
training texts score their log-odds between toxic and clean training
texts, counted once a text, with Dirichlet priors in proportion to their counts
over the whole corpus, less ``CERTAINTY`` standard deviations; a word scores the highest of
its tokens.  Words without certain odds all score the same small negative
value, so that passages without toxic words have none.  A linear-time scan finds all
maximal scoring segments of a text (disjoint, none extensible); those above
the significance bound are its toxic passages.  Their scores add up to the
text's statistic, whose tail under clean training texts follows an
extreme-value law in the text's length; a logistic curve over the negative
log tail probability, fitted on the training texts, gives the score.

The training sample has at most ``TRAIN_ROWS`` labelled texts, drawn by
hash; corpus counts cover every text.

Defined results: null text equals empty text; texts without a word have no
passage and get the score of no evidence; null labels teach nothing, and of
labels that disagree the toxic one counts; without training texts of both
classes every score is 0; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.llm.common import Scratch
from spendscope.llm.text import chunks, is_letter, word_hashes

TRAIN_ROWS = 20_000  # most labelled texts that are learned from
PRIOR_WORDS = 10_000.0  # weight of the corpus counts, in words
CERTAINTY = 2.0
GAP_SHARE = 2.0  # a word without certain odds costs this times the mean gain per clean word
LEAST_GAP = 0.05
LEAST_ODDS = 1.0  # words with less certain odds than this are priced like all others
MOST_ODDS = 8.0
PREFIXES = (5, 6, 7, 8, 9)
LEAST_COUNT = 4  # toxic training texts that a token must occur in
SIGNIFICANT = 2.0  # least score of a passage


def _words(batches: Iterator[pa.RecordBatch]):
    """Chunks of the texts in the first column (lower-cased letter by letter, so that places stay): batch, index of the first text, texts, their
    words' tokens (a row for the words, one for each prefix length; 0: the word is no
    longer than that), starts and ends, the texts' starts, and their first words."""
    for batch in batches:
        texts = pc.fill_null(batch.column(0), "").to_pylist()
        for first, part in chunks([t.replace("\u0130", "i").lower() for t in texts]):
            h, begin, end, starts, of, begins_with = word_hashes(part, is_letter)
            tokens = np.zeros((1 + len(PREFIXES), len(h)), np.uint64)
            tokens[0] = h
            for i, k in enumerate(PREFIXES, 1):
                longer = end - begin > k
                tokens[i, longer] = begins_with(begin[longer], k)
            yield batch, first, part, tokens, begin, end, starts, of


class Table:
    """Sorted hashes; most others are told apart by a bitmap of their first 20 bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.bits = np.zeros(1 << 20, bool)
        self.bits[hashes >> np.uint64(44)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``h`` the table's hashes are, and which they are."""
        maybe = self.bits[h >> np.uint64(44)].nonzero()[0]
        at = np.minimum(np.searchsorted(self.hashes, h[maybe]), max(0, len(self.hashes) - 1))
        there = self.hashes[at] == h[maybe] if len(self.hashes) else np.zeros(0, bool)
        return maybe[there], at[there]


def word_counts(texts: DataFrame, wanted: np.ndarray | None = None, labelled: bool = False) -> DataFrame:
    """Numbers of texts that tokens occur in: (word, n), or, labelled, (word, clean, toxic)
    over (text, toxic).  The null word's n is the number of words.

    Every task adds its texts up before it hands its counts on; ``wanted`` (sorted) limits the words."""
    known = texts.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        every = 0
        table = Table(known.value) if known.value is not None else None
        total = np.zeros(len(known.value), np.int64) if table else None
        for batch, first, part, tokens, _, _, _, of in _words(batches):
            every += tokens.shape[1]
            text = np.repeat(np.arange(len(part)), np.diff(of))
            if table:
                for h in tokens:
                    at, which = table.find(h)
                    once = np.unique(which * len(part) + text[at])
                    total += np.bincount(once // len(part), minlength=len(total))
                continue
            some = tokens.ravel() != 0
            token, text = tokens.ravel()[some], np.tile(text, len(tokens))[some]
            order = np.lexsort((text, token))
            token, text = token[order], text[order]
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (text[1:] != text[:-1])
            toxic = batch.column(1).slice(first, len(part)).to_numpy(zero_copy_only=False)[text[new]]
            word, where = np.unique(token[new], return_inverse=True)
            held.append(pd.DataFrame({"word": word, "clean": np.bincount(where, toxic == 0, len(word)),
                                      "toxic": np.bincount(where, toxic == 1, len(word))}))
            if len(held) > 8:
                held = [pd.concat(held).groupby("word", as_index=False).sum()]
        if total is not None:
            found = total.nonzero()[0]
            # without a word: how many words there are
            yield pa.RecordBatch.from_arrays([pa.array([*known.value[found].view(np.int64).tolist(), None], pa.int64()),
                                              pa.array([*total[found].tolist(), every], pa.int64())], names=["word", "n"])
        elif held:
            sums = pd.concat(held).groupby("word", as_index=False).sum()
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums["word"].to_numpy().view(np.int64)), pa.array(sums["clean"].to_numpy().astype(np.int64)),
                 pa.array(sums["toxic"].to_numpy().astype(np.int64))], names=["word", "clean", "toxic"])

    if labelled:
        return texts.select("text", "toxic").mapInArrow(count, "word long, clean long, toxic long") \
            .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    return texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), in linear time: each positive
    score opens a candidate, which joins the nearest earlier candidate that begins
    lower, as long as it also ends higher than that one."""
    found: list[tuple[int, int, float, float]] = []  # first, last, sum before it, sum at its end
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        first, low, high = i, before, total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= high:
                found.append((first, i, low, high))
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, high - low) for a, b, low, high in found]


class Model:
    """Word odds (sorted hashes), the price of other words, the tail of clean texts
    and the curve of the score."""

    def __init__(self, words: np.ndarray, odds: np.ndarray, gap: float):
        self.words, self.odds, self.gap = words, odds, gap
        self.decay, self.rate = 1.0, 1.0  # tail: 1 - exp(-rate * n * exp(-decay * s))
        self.slope, self.base = 0.0, -30.0

    def word_scores(self, tokens: np.ndarray) -> np.ndarray:
        """The highest odds of each word's tokens; 0: none."""
        out = np.zeros(tokens.shape[1])
        table = Table(self.words)
        for h in tokens:
            at, which = table.find(h)
            out[at] = np.maximum(out[at], self.odds[which])
        return out

    def passages(self, scores: np.ndarray) -> list[tuple[int, int, float]]:
        """Significant segments of one text's words."""
        hit = scores.nonzero()[0]
        if not len(hit):
            return []
        # runs of priced words count as one score between the hits
        both = np.empty(2 * len(hit) - 1)
        both[::2], both[1::2] = scores[hit], -self.gap * (np.diff(hit) - 1)
        return [(int(hit[a // 2]), int(hit[b // 2]), s) for a, b, s in maximal_segments(both.tolist()) if s >= SIGNIFICANT]

    def surprise(self, statistic: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Negative log10 of the tail probability, 0 to 50."""
        mean = self.rate * np.maximum(n, 1) * np.exp(-np.minimum(self.decay * statistic, 600))
        tail = np.where(statistic > 0, -np.expm1(-mean), 1.0)
        return np.clip(-np.log10(np.maximum(tail, 1e-50)), 0, 50)

    def score(self, statistic: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.surprise(statistic, n) + self.base, -30, 30)))


def restored(fields: dict) -> Model:
    model = Model.__new__(Model)
    vars(model).update(fields)
    return model


def fit_tail(model: Model, statistic: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> None:
    """Extreme-value law of the clean texts, then the logistic curve over all."""
    clean = toxic == 0
    s, m = statistic[clean], np.maximum(n[clean], 1)
    some = s > 0
    if some.sum() >= 20:
        # texts without a passage are censored: the rest give the decay, all of them the rate
        model.decay = float(np.clip(1 / max(1e-3, (s[some] - SIGNIFICANT).mean()), 0.2, 3.0))
    expected = m.sum() * math.exp(-model.decay * SIGNIFICANT)
    model.rate = float((some.sum() + 0.5) / max(expected, 1e-9))
    x, y = model.surprise(statistic, n), toxic.astype(float)
    slope, base = 1.0, -2.0
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))  # classes of equal weight
    for _ in range(100):  # Newton steps on the penalised likelihood
        p = 1 / (1 + np.exp(-np.clip(slope * x + base, -30, 30)))
        w = share * np.maximum(p * (1 - p), 1e-9)
        g = np.array([(share * (p - y) * x).sum() + 1e-4 * slope, (share * (p - y)).sum() + 1e-4 * base])
        hess = np.array([[(w * x * x).sum() + 1e-4, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-4]])
        d = np.linalg.solve(hess, g)
        d *= min(1.0, 2.0 / max(1e-9, np.abs(d).max()))
        slope, base = slope - d[0], base - d[1]
    model.slope, model.base = max(0.0, float(slope)), float(base)


def _scan(df: DataFrame, model, columns: list[str]) -> DataFrame:
    """``columns`` with n_words, statistic and passages of every row's text."""
    shared = df.sparkSession.sparkContext.broadcast(vars(model))
    passage = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = restored(shared.value)
        for batch, first, part, tokens, begin, end, starts, of in _words(batches):
            spans, statistic = [], []
            scores = own.word_scores(tokens)
            for i in range(len(part)):
                a, b = int(of[i]), int(of[i + 1])
                found = own.passages(scores[a:b])
                spans.append([{"start": int(begin[a + x] - starts[i]), "end": int(end[a + y] - starts[i]), "score": s}
                              for x, y, s in found])
                statistic.append(sum(s for _, _, s in found))
            yield pa.RecordBatch.from_arrays(
                [*[c.slice(first, len(part)) for c in batch.columns[1:]], pa.array(np.diff(of).astype(np.int64)),
                 pa.array(statistic, pa.float64()), pa.array(spans, passage)],
                names=[*columns, "n_words", "statistic", "passages"])

    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in columns] + T._parse_datatype_string(
        "n_words long, statistic double, passages array<struct<start:int,end:int,score:double>>").fields)
    return df.select("text", *columns).mapInArrow(scan, schema)


def learn(texts: DataFrame, labels: DataFrame, scratch: Scratch, train_rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on (id, text) and labels (id, toxic); None without both classes."""
    labels = labels.where("toxic IN (0, 1) AND id IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
    drawn = labels.orderBy(F.xxhash64("id"), "id").limit(train_rows)
    train = scratch.table(texts.join(F.broadcast(drawn), "id").select("text", "toxic").dropDuplicates(), "train")
    counts = scratch.table(word_counts(train, labelled=True), "counts")
    total = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).first()
    if not total["clean"] or not total["toxic"]:
        return None
    # tokens of the toxic training texts only, so as many as the sample allows; rarer ones are never certain
    likelier = F.col("toxic") * total["clean"] > math.exp(LEAST_ODDS) * F.col("clean") * total["toxic"]
    pdf = counts.where((F.col("toxic") >= LEAST_COUNT) & likelier).toPandas().sort_values("word")
    words = np.sort(pdf["word"].to_numpy().view(np.uint64))
    corpus = scratch.table(word_counts(texts, wanted=words), "corpus")
    everywhere = corpus.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
    n = pdf.merge(corpus.where("word IS NOT NULL").toPandas(), on="word", how="left")["n"].fillna(0).to_numpy()
    prior = PRIOR_WORDS * (n + 0.5) / (everywhere + 1)
    t, c = pdf["toxic"].to_numpy(), pdf["clean"].to_numpy()
    odds = np.log((t + prior) / (total["toxic"] + PRIOR_WORDS - t - prior)) \
        - np.log((c + prior) / (total["clean"] + PRIOR_WORDS - c - prior))
    sure = np.minimum(odds - CERTAINTY * np.sqrt(1 / (t + prior) + 1 / (c + prior)), MOST_ODDS)
    use = sure >= LEAST_ODDS
    gap = max(LEAST_GAP, GAP_SHARE * float((c[use] * sure[use]).sum()) / total["clean"])
    hashes = pdf["word"].to_numpy()[use].view(np.uint64)
    order = np.argsort(hashes)
    model = Model(hashes[order], sure[use][order], gap)
    seen = _scan(train, model, ["toxic"]).select("toxic", "n_words", "statistic").toPandas()
    fit_tail(model, seen["statistic"].to_numpy(), seen["n_words"].to_numpy(), seen["toxic"].to_numpy())
    return model


def toxicity(df: DataFrame, labels: DataFrame, trained_on: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``id_col``, score, passages (start and end in the text, score), n_words of every
    row.  ``trained_on`` says over ``labels`` which of them may be learned."""
    spark = df.sparkSession
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = labels.where(trained_on).select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic"))
    model = learn(texts, chosen, Scratch(spark, "toxicity"), train_rows)
    if model is None:
        model = Model(np.zeros(0, np.uint64), np.zeros(0), LEAST_GAP)
    curve = {k: v for k, v in vars(model).items() if k not in ("words", "odds")}

    @F.pandas_udf("double")
    def score(statistic: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(restored(curve).score(statistic.to_numpy(), n.to_numpy()))

    return _scan(texts, model, ["id"]).select(F.col("id").alias(id_col), score("statistic", "n_words").alias("score"),
                                              "passages", "n_words")
