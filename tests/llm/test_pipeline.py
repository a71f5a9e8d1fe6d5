"""The pipeline's stages on a small table, each held against plain Python on its own input."""

import collections

import corpus_pipeline as p
from spendscope.llm.common import Scratch

from test_operators import DE, EN, FR


def test_stages(spark):
    texts = [EN, EN + " ", None, "12 3", DE, FR, EN + " " + DE, DE + " " + FR + " " + EN, DE + " " + FR + " " + EN + " end", FR + " " + DE]
    data = [(i, t, ["en", "de", "fr"][i % 3], "ab"[i % 2], len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    columns, scratch = docs.columns, Scratch(spark, "test-pipeline")
    ids = []
    for name, stage in p.STAGES:
        docs = scratch.table(stage(spark, docs, ""), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
            mixed = docs.collect() if name == "source_mixing" else []
        ids.append(collections.Counter(r["doc_id"] for r in docs.collect()))
    assert set(ids[0]) == {0, 1, 4, 5, 6, 7, 8, 9}  # null text and digits have no language
    assert set(ids[1]) == {1, 4, 5, 6, 7, 8, 9}  # 0 and 1 differ by a space; the longer stays
    assert set(ids[2]) == {1, 4, 5, 6, 7, 9}  # 8 is 7 and one word more
    assert all(n <= 2 for n in ids[3].values()) and set(ids[3]) <= set(ids[2])
    assert ids[4] == collections.Counter(r["doc_id"] for r in mixed)  # every copy is one short piece


def test_stages_on_odd_tables(spark):
    """An empty table, rows without ids, repeated rows and extra columns whose names clash."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, key string, taken long"
    more = (0.5, 3, "k", 7)
    long = " ".join(f"{w}{i}" for i in range(40) for w in EN.split())
    data = [(None, EN, "en", "a", 1, *more), (None, None, None, None, None, *more), (5, DE, "de", None, 1, *more), (5, DE, "de", None, 1, *more),
            (6, FR, "fr", "b", 1, *more), (7, EN + " " + DE, "en", "b", 1, *more), (None, EN, "en", "a", 1, *more), (8, long, "en", "b", 1, *more)]
    for rows in (data, []):
        docs, scratch = spark.createDataFrame(rows, schema), Scratch(spark, "test-odd")
        columns, counts = docs.columns, []
        for name, stage in p.STAGES:
            docs = scratch.table(stage(spark, docs, ""), name)
            assert name == "best_fit_packing" or docs.columns == columns
            counts.append(docs.count())
        if rows:
            assert counts[0] == 7 and counts[1] == counts[2] == 5  # the text without words; the repeats of two texts
        else:
            assert counts == [0] * 5
