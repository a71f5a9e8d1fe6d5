"""No link of the n-gram join is lost: excerpts that come first in a band, hot bands in blocks, chains."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendscope.llm import ngram_join

SCHEMA = "doc_id long, text string"


def grams(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()


def brute(texts):
    """class id, number of links and group id of every text, by comparing all pairs."""
    sets = [grams(t) for t in texts]
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(frozenset(s), i)
    heads = sorted(first.values())
    links, parent = collections.Counter(), {h: h for h in heads}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(heads):
        for b in heads[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return [(i, first[frozenset(s)], links[first[frozenset(s)]], find(first[frozenset(s)])) for i, s in enumerate(sets)]


def joined(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).coalesce(1)
    got = ngram_join.similarity_join(df).select("doc_id", "class_id", "n_links", "group_id").collect()
    return sorted(map(tuple, got))


def words(draw, n):
    return [f"w{x}" for x in draw.integers(0, 10**9, n)]


def test_links_survive_excerpts_that_come_first(spark):
    """Before two near copies stand short texts made of just the grams behind their shared bands,
    so that each of these bands begins with a text far from both."""
    draw = np.random.default_rng(4)
    passages = [words(draw, 30) for _ in range(25)]
    one, two = (sum(p, []) for p in (passages[:24], passages[:23] + passages[24:]))
    a, b = " ".join(one), " ".join(two)
    sets, starts = ngram_join.gram_sets([a, b])
    sig = ngram_join.signatures(sets, starts)
    shared = np.flatnonzero((ngram_join.band_keys(sig)[0] == ngram_join.band_keys(sig)[1]))
    plain = [" ".join(one[i:i + 5]) for i in range(len(one) - 4)]
    which = ngram_join.gram_sets(plain)[0]
    excerpts = []
    for band in shared:
        columns = range(band * ngram_join.ROWS, (band + 1) * ngram_join.ROWS)
        least = [plain[int(np.argmin(((which * ngram_join.FACTORS[c] + ngram_join.OFFSETS[c]) >> np.uint64(32)).astype(np.uint32)))]
                 for c in columns]
        for text in (" . ".join(least), " | ".join(reversed(least))):
            s = ngram_join.signatures(*ngram_join.gram_sets([text]))
            if ngram_join.band_keys(s)[0][band] == ngram_join.band_keys(sig)[0][band]:
                excerpts.append(text)
                break
    assert len(excerpts) >= len(shared) // 2 > 2  # most shared bands begin with an excerpt
    texts = [*excerpts, a, b]
    got = joined(spark, texts)
    assert [r[2] for r in got[-2:]] == [1, 1] and got == brute(texts)


@pytest.mark.parametrize("block", [3, 512])
def test_equal_to_brute_force(spark, monkeypatch, block):
    """Families of edited copies, a hot band (one long passage in many texts) and a chain in which
    only neighbours are alike, with blocks of three and of the usual size."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    draw = np.random.default_rng(8)
    texts = [None, "", " \n", "one two", "one  two", "one two three"]
    for size in (1, 2, 5, 12):
        base = words(draw, 80)
        for _ in range(size):
            copy = list(base)
            for at in draw.integers(0, 80, draw.integers(0, 4)):
                copy[at] = words(draw, 1)[0]
            texts.append(" ".join(copy))
    passage = words(draw, 60)
    texts += [" ".join(passage + words(draw, n)) for n in (3, 5, 9, 14, 30, 60, 4, 6)]
    chain = words(draw, 300)
    texts += [" ".join(chain[k:k + 100]) for k in range(0, 200, 8)]
    texts += texts[7:12]
    assert joined(spark, texts) == brute(texts)


def test_a_chain_stays_in_proportion(spark, monkeypatch):
    """Rows that the bands of a chain are dealt to grow with its length, not with its square."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    draw = np.random.default_rng(6)
    text = words(draw, 4000)
    counted = []

    for n in (100, 400):
        sets = [" ".join(text[8 * k:8 * k + 100]) for k in range(n)]
        df = spark.createDataFrame(list(enumerate(sets)), "id long, text string")
        rows = ngram_join.gram_classes(df, 5).withColumn("node", F.col("id"))
        met = rows.select("node", "low", F.explode("keys").alias("key"))
        sizes = met.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        met = met.join(sizes, "key").select("key", "n", "node", "low")
        counted.append(met.select(F.sum(F.ceil(F.col("n") / 16))).first()[0])
        edges = {tuple(r) for r in ngram_join.met_edges(met, 0.8, 16).collect()}
        assert {(k, k + 1) for k in range(n - 1)} <= edges | {(k, k + 1) for k in range(n - 1) if joined_by(edges, k)}
    assert counted[1] < 6 * counted[0]


def joined_by(edges, k):
    """Whether k and k + 1 are connected by the edges near them."""
    near = [e for e in edges if k - 6 <= e[0] <= k + 6]
    seen, todo = {k}, [k]
    while todo:
        x = todo.pop()
        for a, b in near:
            for p, q in ((a, b), (b, a)):
                if p == x and q not in seen:
                    seen.add(q)
                    todo.append(q)
    return k + 1 in seen
