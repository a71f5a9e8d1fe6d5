"""Filter audit, quality classifier and importance resampling on small tables with nulls, empty and
long texts, ties, repeated rows and clashing extra columns, held against plain Python."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendscope.llm import filter_audit, importance, quality
from spendscope.llm.queries import remainder

from test_operators import DE, EN, FR

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, part string, word int, fails int, id string, "
          "digest string, x string, row long, score string, rank string")
EXTRA = ("p", 1, 2, "i", "d", "x", 3, "s", "r")


def rows():
    clean = " ".join(f"word{i}é" for i in range(120))
    texts = [None, "", " \n\t", EN, clean, clean, clean.upper(), clean + " #", "a " * 150, EN * 40, "x|y", DE, FR, clean + " Z" * 9,
             "lange" * 30000, "wort " * 30000, "a b\x1fc\x0bd", "Ünï " * 40]
    out = [(i, t, [None, "en", "de", ""][i % 4], "ab"[i % 2], 1, *EXTRA) for i, t in enumerate(texts)]
    return out + [out[4], (None, clean, "en", None, None, *EXTRA), (None, clean, "en", None, None, *EXTRA),
                  (4, "another text", "de", None, None, *EXTRA), (99, clean, "en", "a", 0, *EXTRA)]


LABELS = [(0, 1, 0), (1, 0, 1), (3, 1, None), (4, 0, 0), (4, 1, 1), (5, 1, 0), (6, None, 1), (8, 0, None), (99, 1, 1), (None, 1, 1), (500, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fails_of(row, data):
    i, text = row[0], row[1] or ""
    words = words_of(text)
    return {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and any(r[0] is not None and r[0] < i and (r[1] or "") == text for r in data)}


def test_positional_popcount():
    draw = np.random.default_rng(3)
    for n in [0, 1, 2, 3, 4, 7, 100, 12345]:
        words = draw.integers(0, 2**32, n, dtype=np.uint32)
        assert filter_audit.positional_popcount(words).tolist() == [int(((words >> np.uint32(b)) & 1).sum()) for b in range(32)]


def test_filter_audit(spark, docs, nothing, labels, monkeypatch):
    data = rows()
    good = {i for i, q, _ in LABELS if q == 1 and i is not None}
    toxic = {i for i, _, t in LABELS if t == 1 and i is not None}
    fails = [fails_of(r, data) for r in data]
    want = {}
    for part in {r[2] or "" for r in data}:
        mine = [(r, f) for r, f in zip(data, fails) if (r[2] or "") == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                shapley[f] += len(gone)
                want[part, "".join(order), step] = [
                    len(left), len(gone), sum(x[1][f] for x in mine) - len(gone), sum([k for k in "ABCDE" if x[1][k]] == [f] for x in mine),
                    sum(x[0][0] in good for x in gone), sum(x[0][0] in toxic for x in gone)]
        for (p, order, step), v in want.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    for held in (1, 4096):  # with one part held, a task hands its counts on after every batch
        monkeypatch.setattr(filter_audit, "HELD_PARTS", held)
        got = {tuple(r[:3]): list(r[3:]) for r in filter_audit.filter_audit(docs, labels).collect()}
        assert got == want
    assert filter_audit.filter_audit(nothing, labels).count() == 0
    assert filter_audit.filter_audit(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_survival_words(docs, labels):
    got = filter_audit.survival_words(docs, labels).collect()
    assert len(got) == len(rows())
    for r in got:
        assert r["word"] % 2**32 == sum(1 << s for s in range(32) if not s & r["fails"])


def resampled(data, target, percent=10, least=20, max_n=1, buckets=10_000, seed=2024):
    def features(text):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return len(ws), [zlib.crc32(" ".join(ws[i:i + k]).encode()) % buckets for k in range(1, max_n + 1) for i in range(len(ws) - k + 1)]

    s, t = (collections.Counter(b for x in texts for b in features(x)[1]) for texts in ([r[1] for r in data], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for r in data:
        n, found = features(r[1])
        w = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in found)
        h = int(hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append((r[0], n, len(found), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    ranks = collections.defaultdict(list)
    for k, x in enumerate(able[:percent * len(able) // 100], 1):
        ranks[x].append(k)
    return sorted(map(str, [(x[0], *x[2:], ranks[x].pop(0) if ranks[x] else None) for x in out]))


@pytest.mark.parametrize("settings", [{}, {"percent": 100}, {"percent": 60, "max_n": 3, "least_words": 1, "buckets": 97}])
def test_resample(spark, docs, nothing, settings):
    target = [EN, None, "", "word1é word2é Ünï", "wort wort"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, score string")
    got = sorted(str(tuple(r)) for r in importance.resample(docs, bench, **settings).collect())
    brute = {"least": settings.get("least_words", 20), **{k: v for k, v in settings.items() if k != "least_words"}}
    assert got == resampled(rows(), target, **brute)
    assert importance.resample(nothing, bench).count() == 0
    assert importance.resample(docs, bench.limit(0)).count() == len(rows())


def test_kth_key(spark):
    draw = np.random.default_rng(5)
    data = [(int(s), i is None, i, k) for k, (s, i) in enumerate(zip(draw.integers(-3, 3, 500), [None, 1, 2, 3, 4] * 100))]
    table = spark.createDataFrame(data, "down long, no_id boolean, id long, row long").repartition(5)
    order = sorted(data, key=lambda r: (r[0], r[1], r[2] or 0, r[3]))
    for k in (1, 2, 249, 500):
        assert importance.kth_key(table, k, pivots=3) == order[k - 1]
    assert importance.kth_key(table, 501, pivots=7) is None


def test_isotonic():
    at, value = quality.isotonic(np.array([3.0, 1.0, 2.0, 2.0, 5.0, 4.0]), np.array([0, 0, 1, 0, 1, 1]))
    assert value.tolist() == [0.0, 1 / 3, 1.0] and at.tolist() == [1.0, 7 / 3, 4.5]
    draw = np.random.default_rng(1)
    score, y = draw.normal(size=300), draw.integers(0, 2, 300)
    at, value = quality.isotonic(score, y)
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
    # the blocks hold the best increasing fit: the greatest of least averages
    ys = y[np.argsort(score)]
    best = [max(min(ys[a:b].mean() for b in range(i + 1, 301)) for a in range(i + 1)) for i in range(0, 300, 37)]
    assert set(np.round(best, 9)) <= set(np.round(value, 9))


def test_normal_equations(spark):
    """The folds' summed matrices are those of all rows at once, and ridge solves them."""
    draw = np.random.default_rng(2)
    x, y = draw.normal(size=(200, 4)), draw.integers(0, 2, 200).astype(float)
    kernel = quality.Kernel(x.mean(axis=0), x.std(axis=0), 24, 7)
    train = spark.createDataFrame([(r.tolist(), v, k % 5) for k, (r, v) in enumerate(zip(x, y.tolist()))], "x array<double>, y double, fold int")
    per_fold = quality.normal_equations(train.repartition(6), kernel)
    z = kernel.features(x)
    assert np.allclose(sum(per_fold)[:-1, :-1], z.T @ z) and np.allclose(sum(per_fold)[:-1, -1], z.T @ y)
    only = np.arange(200) % 5 == 3
    assert np.allclose(per_fold[3][-1, -1], (y[only] ** 2).sum())
    w = quality.ridge(sum(per_fold), 1.0)
    held = np.append(0.001, np.ones(24))
    assert np.allclose(z.T @ (z @ w - y) + held * w, 0, atol=1e-8)
    assert np.isclose(quality.squared_error(sum(per_fold), w), ((z @ w - y) ** 2).sum())
    wide = quality.Kernel(np.zeros(4), np.ones(4), 20_000, 1)  # cosines approximate the Gaussian kernel
    a, b = np.full((1, 4), 0.3), np.array([[0.1, -0.4, 0.9, 0.0]])
    near = float((wide.features(a)[:, 1:] * wide.features(b)[:, 1:]).sum())
    assert abs(near - math.exp(-((a - b) ** 2).sum() / 8)) < 0.03


def test_quality(spark, docs, nothing):
    draw = np.random.default_rng(0)
    words = [f"{a}{b}" for a in EN.split() for b in ("", "ing", "ed", "s")]
    texts = [" ".join(draw.choice(words, draw.integers(20, 200))) for _ in range(400)]
    texts = [t if i % 3 else " ".join(w + draw.choice(["%%%", "&&&"]) for w in t.split()) if i % 2 else t.upper() for i, t in enumerate(texts)]
    data = [(i, t, "en", "a", 1, *EXTRA) for i, t in enumerate(texts)]
    corpus = docs.withColumn("doc_id", F.col("doc_id") + 10_000).union(spark.createDataFrame(data, SCHEMA))
    marks = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(400)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in quality.quality(corpus, marks, remainder("doc_id", 5) != 0).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((got[i] >= 0.3) == (i % 3 > 0) for i in held) and all(0 <= s <= 1 for s in got.values())
    assert quality.quality(corpus, marks, remainder("doc_id", 5) != 0).count() == 400 + len(rows())
    # the held-out labels teach nothing
    turned = marks.withColumn("quality", F.when(remainder("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.quality(corpus, turned, remainder("doc_id", 5) != 0).collect()}
    assert all(abs(again[i] - got[i]) < 1e-6 for i in got)
    one = quality.quality(docs, marks.where("quality = 1").withColumn("doc_id", F.col("doc_id") % 4), F.lit(True))
    assert {r["score"] for r in one.collect()} == {1.0}
    assert {r["score"] for r in quality.quality(docs, marks.limit(0), F.lit(True)).collect()} == {0.0}
    assert quality.quality(nothing, marks, F.lit(True)).count() == 0


def test_statistics_of_edge_texts():
    for t in ["", " \n", "a", "é", "\n\nx\n", "lange" * 1000, "a b c", "\x00"]:
        found = quality.statistics(t.encode())
        assert len(found) == quality.STATISTICS and np.isfinite(found).all()
