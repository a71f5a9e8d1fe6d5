"""Operators of the llm subpackage on small tables with nulls, empty and long texts,
ties, repeated rows and clashing extra columns, held against plain Python."""

import collections
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendscope.llm import (exact_dedup, langid, merkle, mixing, ngram_join, packing, sharding, suffix_dedup, toxicity,
                            url_filter)
from spendscope.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, page string"
EN = "the quick brown fox jumps over the lazy dog and runs through the green field while birds sing in tall trees near water"
DE = "der schnelle braune Fuchs springt über den faulen Hund und läuft durch das grüne Feld während Vögel in Bäumen singen"
FR = "le rapide renard brun saute par dessus le chien paresseux et court dans le champ vert pendant que chantent les oiseaux"


def rows():
    near = EN.split()
    texts = [None, "", " \n\t", EN, EN + " ", EN.replace(" ", "  "), DE, FR, "x", "x", "a. b.\nc d",
             " ".join(near + near[::-1] + [f"w{i}" for i in range(40)]),
             " ".join(near + near[::-1] + [f"w{i}" for i in range(40)] + ["tail"]), "lange" * 3000, "é" * 60 + "!" * 60, "é" * 60]
    out = [(i, t, [None, "en", "de", "fr"][i % 4], [None, "b", "a"][i % 3], 1, "k", "s", "p") for i, t in enumerate(texts)]
    return out + [out[3], (None, EN, None, None, None, None, None, None), (7, "another text of id seven", "en", "a", 1, "", "", "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(spark, docs, nothing):
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == len(rows())
    norm = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = collections.defaultdict(list)
    for r in rows():
        groups[hashlib.sha256(norm(r[1]).encode()).hexdigest()].append(r)
    best = {k: min(v, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0] for k, v in groups.items()}
    for r in got:
        assert (r["keep_id"], r["group_size"]) == (best[r["text_sha256"]], len(groups[r["text_sha256"]]))
    assert sum(r["kept"] for r in got) == len(groups)
    stay = exact_dedup.keep_first(docs)
    assert stay.columns == docs.columns and stay.count() == len(groups)
    assert exact_dedup.keep_first(nothing).count() == 0


def test_mixing(spark, docs, nothing):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows()) and sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect()))
    per = collections.defaultdict(list)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        per[r["source"]].append(r)
    total = sum(r["size"] for r in got)
    assert abs(sum(v[0]["target"] for v in per.values()) - 1.5 * total) < 1e-6
    for v in per.values():
        assert sum(r["taken"] for r in v) == int(v[0]["target"]) and v[0]["target"] <= 2 * v[0]["source_size"]
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert mixing.mix(nothing).count() == 0


def test_packing(spark, docs, nothing):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    got = packing.pack(docs, tokenizer_path(), capacity=64).collect()
    want = collections.Counter()
    for r in rows():
        ids = np.array(tok.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        for k, s in enumerate(range(0, len(ids), 64)):
            want[(r[0], k, s, len(ids[s:s + 64]), zlib.crc32(ids[s:s + 64].tobytes()))] += 1
    assert collections.Counter((r[0], r[1], r[2], r[3], r[4]) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(nothing, tokenizer_path()).count() == 0


def test_packing_plan_is_tight():
    rng = np.random.default_rng(3)
    lengths, counts = np.unique(rng.integers(1, 256, 3000), return_counts=True)
    plan = packing.solve(dict(zip(lengths.tolist(), counts.tolist())), 256, 50)
    used = collections.Counter()
    for config, times in plan:
        assert sum(config) <= 256
        for x in config:
            used[x] += times
    assert used == dict(zip(lengths.tolist(), counts.tolist()))
    assert sum(t for _, t in plan) <= 1.02 * (lengths * counts).sum() / 256 + 1


def test_packing_linear_program_is_covered():
    rng = np.random.default_rng(6)
    a, b, c = rng.integers(-50, 51, (3, 30_000))
    lengths = np.concatenate([2048 + a, 2048 - a, 1024 + b, 1024 - b, 1024 + c, 1024 - c])  # fill 60,000 sequences
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    packed = packing.Packing(histogram)
    used = collections.Counter()
    for config, times in packed.plan:
        assert sum(config) <= 4096
        for x in config:
            used[x] += times
    assert used == histogram
    assert packed.low <= 60_000.001 and 60_000 <= packed.high <= 60_000 * 1.005
    assert sum(t for _, t in packed.plan) <= 60_000 * 1.005 and packed.best_fit < 0.05
    # two of each sequence's 4096 tokens only: the tokens are no tight bound
    wide = packing.Packing({x: 50 for x in range(1400, 2000)})
    assert 14_999 <= wide.low and sum(t for _, t in wide.plan) <= 15_000 * 1.001
    assert sum(t for _, t in packing.solve({3000: 2, 10: 1})) == 2


def test_packing_words_with_number_signs():
    words = packing.WordIds(tokenizer_path())
    signs = [chr(c) for c in range(33, 256) if not chr(c).isspace()]
    texts = ["m²", "km²", "cm³.", "x¹", "½", "1½x!", *[f"ab{c}" for c in signs], *[f"{c}Cd." for c in signs], *[f"É{c}ß," for c in signs]]
    for t, entries in zip(texts, words.of(pa.array(texts))):
        ids = [i for k in entries for i in words.pool[words.starts[k]:words.starts[k] + words.lens[k]]]
        assert ids == words.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_url_filter_trie_and_join_agree(spark):
    urls = ["http://A.Example.net/en/1?x", "https://x.org/fr", "https://x.org/fr/a", "https://example.com/de/", "ftp://net/",
            "http://net", "http://foo.net/en/", "http://notexample.com/de/", None, "nothing", "http://h.example.net/english",
            "http://example.com?de/", "x://y://example.net/", ""]
    df = spark.createDataFrame(list(enumerate(urls)) + [(0, urls[0])], "page_id long, url string")
    a = sorted(map(tuple, url_filter.filter_urls(df).collect()), key=str)
    b = sorted(map(tuple, url_filter.filter_urls(df, max_broadcast_rules=0).collect()), key=str)
    assert a == b
    clash = df.selectExpr("*", "'h' AS host", "'p' AS path", "'r' AS rule", "'v' AS verdict", "1 AS node")
    assert sorted(map(tuple, url_filter.filter_urls(clash).collect()), key=str) == a
    assert url_filter.filter_urls(df.limit(0)).count() == 0
    rule = {r[0]: (r[3], r[4]) for r in a}
    assert rule[0] == ("example.net/en/", "allow") and rule[2] == ("org/fr/", "allow") and rule[1] == (None, "allow")
    assert rule[3] == ("example.com/de/", "block") and rule[4] == ("net/", "block") and rule[5] == (None, "allow")
    assert rule[6] == ("net/", "block") and rule[7] == (None, "allow") and rule[10] == ("net/", "block")


def test_toxicity_learns_words_and_finds_passages(spark, nothing, monkeypatch):
    monkeypatch.setattr(toxicity, "PRIOR_WORDS", 20.0)  # the corpus has a few thousand words only
    base, rng = EN.split(), np.random.default_rng(4)
    docs, labels = [], []
    for i in range(240):
        words = rng.permutation(base).tolist()
        if i % 4 == 0:
            words = words[:5] + ["vile", "wicked"] + words[5:]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs += [(500, None), (501, ""), (502, "12 34"), (0, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(df, lab, F.col("doc_id") % 3 != 1).collect()
    assert len(got) == len(docs)
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] < 240:
            assert (r["score"] >= 0.7) == (r["doc_id"] % 4 == 0)
            if r["passages"]:
                text = docs[r["doc_id"]][1]
                assert "vile" in text[r["passages"][0]["start"]:r["passages"][0]["end"]]
    # a letter that grows when it is lower-cased moves no place; a very long text; columns with clashing names
    odd = ["\u0130\u0130 " * 3 + docs[0][1], " ".join(base * 3000 + ["vile", "wicked"] + base * 3000)]
    more = df.unionByName(spark.createDataFrame(list(enumerate(odd, 600)), df.schema)) \
        .selectExpr("*", "1 AS score", "'p' AS passages", "'t' AS toxic", "2 AS word")
    monkeypatch.setattr(toxicity, "PRIOR_WORDS", 500.0)  # in proportion to the corpus, which the long text makes 25 times as large
    passages = {r["doc_id"]: r["passages"] for r in toxicity.toxicity(more, lab, F.col("doc_id") % 3 != 1).collect()}
    for i, text in enumerate(odd, 600):
        assert [text[p["start"]:p["end"]].split()[0] in ("vile", "wicked") for p in passages[i]] == [True]
    assert toxicity.toxicity(nothing, lab, F.lit(True)).count() == 0
    assert {r["score"] < 0.7 for r in toxicity.toxicity(df, lab.limit(0), F.lit(True)).collect()} == {True}


def test_maximal_segments_against_definition():
    rng = np.random.default_rng(5)
    for _ in range(100):
        x = rng.integers(-5, 6, rng.integers(1, 12)).tolist()
        left, want = [(0, len(x))], []
        while left:  # the best segment, then left and right of it
            a, b = left.pop()
            best = max(((sum(x[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
            if best[0] > 0:
                want.append((best[3], best[4] - 1, float(best[0])))
                left += [(a, best[3]), (best[4], b)]
        got = toxicity.maximal_segments([float(v) for v in x])
        assert sum(s for _, _, s in got) == sum(s for _, _, s in want)


def test_sharding(spark, docs, nothing):
    limit = 300
    got = sharding.shards(docs, limit=limit).collect()
    assert len(got) == len(rows())
    size = collections.Counter()
    for r in got:
        size[r["shard"]] += r["n_bytes"]
    alone = collections.Counter(r["shard"] for r in got)
    assert all(n <= limit or alone[s] == 1 for s, n in size.items())
    h = {r: int(hashlib.md5((str(r) if r is not None else "").encode()).hexdigest()[:15], 16) for r in {x[0] for x in rows()}}
    for r in got:
        bits = format(h[r["doc_id"]], "060b")[:r["depth"]]
        assert r["shard"].split(".")[0] == bits
    assert sharding.shards(nothing).count() == 0


def test_write_shards_keeps_each_row_once(spark, docs, tmp_path):
    hot = spark.createDataFrame([(7, f"{i:02d}" + "t" * 98, None, None, i, None, None, None) for i in range(20)], SCHEMA)
    whole = docs.union(hot)
    sharding.write_shards(whole, str(tmp_path / "out"), limit=300)
    written = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, written.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    pages = written.groupBy("shard").agg(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("n"), F.count("*").alias("rows"))
    assert all(r["n"] <= 300 or r["rows"] == 1 for r in pages.collect())


def test_merkle(spark, docs, nothing):
    got = merkle.compare_with_edited(docs).collect()
    order = sorted(rows(), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = collections.Counter()
    for r, n in zip(order, order[1:] + order[:1]):
        new = merkle.edited(r[1] or "", n[1] or "")
        want[(r[0], len(r[1] or ""), hashlib.sha256(new.encode()).hexdigest())] += 1
    assert collections.Counter((r[0], r[1], r[2]) for r in got) == want
    assert merkle.compare_with_edited(nothing).count() == 0
    tree = merkle.Tree("One. Two two.\nThree.\n\nFour five six.")
    assert merkle.parse(tree.text()).text() == tree.text()
    assert merkle.likeness(tree, merkle.Tree("One. Two two.\nThree.\n\nFour five six.")) == 1
    other = merkle.Tree("One. Two two.\nThree!\n\nFour five six.")
    assert 0 < merkle.likeness(tree, other) < 1 and len(merkle.differing(tree, other)) == 1


def test_merkle_likeness_does_not_depend_on_the_length():
    rng = np.random.default_rng(9)
    for n in (236, 242, 300, 470, 490, 900):
        text = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz      "), n))
        for following in ("", "thirteen char", text[::-1]):
            new = merkle.edited(text, following)
            share = (n - n // 2) / max(n, 2 * len(new) - (n - n // 2))  # about the shared part of both
            assert abs(merkle.likeness(merkle.Tree(text), merkle.Tree(new)) - share) < 0.3
            assert merkle.likeness(merkle.Tree(text), merkle.Tree(new)) > 0.1


def test_merkle_likeness_follows_the_shared_text(spark):
    rng = np.random.default_rng(8)
    letters = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz      "), n))
    chinese = lambda n: "".join(map(chr, rng.integers(0x4E00, 0x9000, n)))

    def shingles(t):
        return {t[k:k + 8] for k in range(max(1, len(t) - 7))}

    def shared(a, b):
        return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))

    long = letters(6000)
    period = "".join(rng.permutation(list("0123456789"))) * 400
    texts = [letters(300), "", letters(460), letters(13), chinese(560), chinese(900), letters(230), letters(700), long,
             long[:50] + " inserted " + long[50:], chinese(40) + long, period, "x" + period[1:], letters(241)]
    texts = [t.strip() for t in texts]
    df = spark.createDataFrame(list(enumerate(texts[::-1])), "doc_id long, text string")
    got = [r for r in merkle.compare_with_edited(df).orderBy(F.desc("doc_id")).collect()]
    for i, (r, t) in enumerate(zip(got, texts)):
        following = texts[(i + 1) % len(texts)]
        if len(t) > 200 and t[:50] != period[:50] and t[1:50] != period[1:50]:
            assert abs(r["near_edited"] - shared(t, merkle.edited(t, following))) < 0.2, i
            assert r["near_edited"] > 0.1
            assert abs(r["near_next"] - shared(t, following)) < 0.1, i
    assert got[8]["near_next"] > 0.9 and got[9]["near_next"] > 0.9 and got[11]["near_next"] > 0.9
    for t in (period, "a" * 5000, long, texts[4]):
        cut = merkle.chunks(t)
        assert "".join(cut) == t and max(map(len, cut)) <= merkle.LONGEST


def test_language_id(spark, nothing):
    rng = np.random.default_rng(1)
    data = [(i, " ".join(rng.choice(t.split(), 12)), lang, "s") for i, (lang, t) in
            enumerate([("en", EN), ("de", DE), ("fr", FR)] * 60)]
    data += [(1000, None, "en", "s"), (1001, "12 !", "de", "s"), (1002, "", None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, score string")
    got = {r["doc_id"]: r for r in langid.identify(df, F.col("doc_id") % 4 != 2).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert sum(got[i]["lang_pred"] == data[i][2] for i in range(180)) >= 175
    kept = langid.of_known_language(df, F.lit(True))
    assert kept.columns == df.columns and kept.count() == 180
    some = langid.of_known_language(df, F.lit(True), languages=["de", "fr"])
    assert {r["lang"] for r in some.collect()} == {"de", "fr"} and some.count() == 120
    sure = sorted(r["score"] for r in got.values())
    assert langid.of_known_language(df, F.col("doc_id") % 4 != 2, least_score=sure[90]).count() == sum(x >= sure[90] for x in sure)
    assert langid.identify(nothing, F.lit(True)).count() == 0
    # a very long text, repeated rows, rows without id
    more = df.union(spark.createDataFrame([(2000, " ".join([FR] * 3000), None, "s"), *[data[1]] * 3, (None, DE, None, "s")], df.schema))
    again = langid.identify(more, F.col("doc_id") % 4 != 2).collect()
    assert len(again) == len(data) + 5 and {r["lang_pred"] for r in again if r["doc_id"] == 2000} == {"fr"}
    assert len({(r["lang_pred"], r["score"]) for r in again if r["doc_id"] == 1}) == 1
    assert [r["lang_pred"] for r in again if r["doc_id"] is None] == ["de"]


def test_ngram_join(spark, docs, nothing):
    got = ngram_join.similarity_join(docs, threshold=0.8).collect()
    sets = []
    for r in rows():
        w = (r[1] or "").split()
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    kinds = set(sets)
    near = {s: sum(1 for t in kinds if t != s and s and t and len(s & t) >= 0.8 * len(s | t)) for s in kinds}
    want = collections.Counter((r[0], sets.count(s), near[s]) for r, s in zip(rows(), sets))
    assert collections.Counter((r["doc_id"], r["copies"], r["n_links"]) for r in got) == want
    assert any(near.values())
    one = ngram_join.one_of_each_group(docs)
    assert one.columns == docs.columns and one.count() == sum(r["kept"] for r in got)
    assert ngram_join.similarity_join(nothing).count() == 0


def test_pruning_bound():
    for n in (32, 160):
        least = ngram_join.least_matches(n, 0.8, 1e-6)
        assert 0 < least < 0.8 * n


def test_suffix_dedup(spark, docs, nothing):
    got = suffix_dedup.remove_repeats(docs).collect()
    first = {}
    for r in rows():
        b, o = (r[1] or "").encode(), (r[0] is None, r[0] or 0)
        for p in range(len(b) - 49):
            first[b[p:p + 50]] = min(first.get(b[p:p + 50], o), o)
    want = collections.Counter()
    for r in rows():
        b, o, gone = (r[1] or "").encode(), (r[0] is None, r[0] or 0), set()
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < o:
                gone |= set(range(p, p + 50))
        want[(r[0], len(b), bytes(x for i, x in enumerate(b) if i not in gone))] += 1
    assert collections.Counter((r["doc_id"], r["n_bytes"], bytes(r["kept"])) for r in got) == want
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_column_wise_transform_is_the_sorted_suffix_list():
    rng = np.random.default_rng(2)
    for _ in range(20):
        strings = [bytes(rng.choice([97, 98], rng.integers(1, 12)).tolist()) for _ in range(rng.integers(1, 25))]
        sizes = np.array([len(s) for s in strings])
        starts = np.cumsum(sizes) - sizes
        at, _ = suffix_dedup.column_wise(np.frombuffer(b"".join(strings), np.uint8), starts, sizes)
        own = np.searchsorted(starts, at[len(strings):], "right") - 1
        joined = b"".join(strings)
        got = [joined[a:starts[o] + sizes[o]] for a, o in zip(at[len(strings):], own)]
        assert got == sorted(s[k:] for s in strings for k in range(len(s)))
