"""SCD2 sequences: incremental apply equals backfill; edge rules."""

import tempfile

import pytest
from pyspark.sql import functions as F

from spendscope.operators import scd2

SCHEMA = "object_id bigint, version int, segment string, balance double, payload string"


def snaps(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    rows = [tuple(r) for r in df.select("object_id", "segment", "balance", "payload", "__START_AT", "__END_AT").collect()]
    return sorted(rows, key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


ROWS = [
    (1, 1, "A", 1.0, "p1"), (1, 2, "A", 1.0, "p2"), (1, 3, "B", 1.0, "p3"),   # change at 3
    (2, 1, "A", 2.0, "p1"), (2, 3, "A", 2.0, "p3"),                          # gone at 2, back at 3
    (3, 1, "A", 3.0, "p1"), (3, 2, "A", 3.0, "p2"),                          # deleted at 3
    (4, 2, None, None, "p2"), (4, 3, None, None, "p3"),                      # NULLs are equal
]


def test_backfill_rules(spark):
    got = rows_of(scd2.backfill(snaps(spark, ROWS), ["object_id"], ["segment", "balance"]))
    expected = [
        (1, "A", 1.0, "p2", 1, 3), (1, "B", 1.0, "p3", 3, None),
        (2, "A", 2.0, "p1", 1, 2), (2, "A", 2.0, "p3", 3, None),
        (3, "A", 3.0, "p2", 1, 3),
        (4, None, None, "p3", 2, None),
    ]
    assert got == sorted(expected, key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def test_incremental_equals_backfill(spark):
    s = snaps(spark, ROWS)
    hist = None
    for v in (1, 2, 3):
        hist = scd2.apply_snapshot(hist, s.where(F.col("version") == v), v, ["object_id"], ["segment", "balance"])
    assert rows_of(hist) == rows_of(scd2.backfill(s, ["object_id"], ["segment", "balance"]))


def test_intervals_never_overlap(spark):
    h = scd2.backfill(snaps(spark, ROWS), ["object_id"], ["segment", "balance"]).collect()
    by_key = {}
    for r in h:
        by_key.setdefault(r["object_id"], []).append((r["__START_AT"], r["__END_AT"] or 10**9))
    for spans in by_key.values():
        spans.sort()
        for (a0, a1), (b0, _) in zip(spans, spans[1:]):
            assert a1 <= b0 and a0 < a1


def test_duplicate_keys_fail(spark):
    s = snaps(spark, [(1, 1, "A", 1.0, "p"), (1, 1, "B", 1.0, "p")])
    with pytest.raises(Exception):
        scd2.apply_snapshot(None, s, 1, ["object_id"], ["segment"]).collect()


def test_partial_snapshot_keeps_missing_keys_open(spark):
    h = scd2.apply_snapshot(None, snaps(spark, [(1, 1, "A", 1.0, "p"), (2, 1, "A", 1.0, "p")]), 1, ["object_id"], ["segment"])
    h2 = scd2.apply_snapshot(h, snaps(spark, [(1, 2, "A", 1.0, "p")]), 2, ["object_id"], ["segment"], complete=False)
    assert scd2.current(h2).count() == 2
    h3 = scd2.apply_snapshot(h, snaps(spark, [(1, 2, "A", 1.0, "p")]), 2, ["object_id"], ["segment"])
    assert scd2.current(h3).count() == 1


def test_store_gate_and_as_of(spark):
    root = tempfile.mkdtemp(prefix="scd2-store-")
    store = scd2.HistoryStore(spark, root, ["object_id"], ["segment", "balance"])
    s = snaps(spark, ROWS)
    for v in (1, 2, 3):
        assert store.apply(s.where(F.col("version") == v), v) is not None
    assert store.apply(s.where(F.col("version") == 2), 2) is None  # version <= last: no-op
    assert store.last_version() == 3
    assert rows_of(store.read()) == rows_of(scd2.backfill(s, ["object_id"], ["segment", "balance"]))
    assert store.read_open().count() == scd2.current(store.read()).count()
    before = rows_of(store.read())
    store.compact()
    assert len(store.state()["folders"]) == 2 and rows_of(store.read()) == before
    store.apply(s.where(F.col("version") == 3).withColumn("segment", F.lit("Z")).drop("version"), 4)
    after = rows_of(store.read())
    assert len(after) == len(before) + sum(1 for r in before if r[5] is None)  # every open row changed
    assert sorted(r["object_id"] for r in scd2.as_of(store.read(), 2).collect()) == [1, 3, 4]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_snapshot_seq = st.lists(  # one dict per version: key -> (segment, balance)
    st.dictionaries(st.integers(0, 5), st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from([1.0, 2.0, None])),
                    max_size=6),
    min_size=1, max_size=4,
)


@settings(max_examples=15, deadline=None)
@given(_snapshot_seq)
def test_random_sequences_incremental_equals_backfill(spark_session_for_hypothesis, seq):
    spark = spark_session_for_hypothesis
    rows = [(k, v, seg, bal, f"p{v}") for v, snap in enumerate(seq, start=1) for k, (seg, bal) in snap.items()]
    if not rows:
        return
    s = snaps(spark, rows)
    hist = None
    for v in range(1, len(seq) + 1):
        hist = scd2.apply_snapshot(hist, s.where(F.col("version") == v), v, ["object_id"], ["segment", "balance"])
    back = scd2.backfill(s, ["object_id"], ["segment", "balance"], versions=range(1, len(seq) + 1))
    assert rows_of(hist) == rows_of(back)


def test_empty_snapshot_closes_every_key(spark):
    s = snaps(spark, [(1, 1, "A", 1.0, "p1"), (2, 1, "A", 2.0, "p1"), (1, 3, "A", 1.0, "p3")])
    back = scd2.backfill(s, ["object_id"], ["segment", "balance"], versions=[1, 2, 3])
    assert rows_of(back) == [(1, "A", 1.0, "p1", 1, 2), (1, "A", 1.0, "p3", 3, None), (2, "A", 2.0, "p1", 1, 2)]


def test_of_two_runs_that_begin_at_one_record_one_succeeds(spark, tmp_path):
    rows = lambda seg: spark.createDataFrame([(1, seg), (2, "x")], "k int, segment string")
    root = str(tmp_path / "history")
    store, other = (scd2.HistoryStore(spark, root, ["k"], ["segment"]) for _ in range(2))
    store.apply(rows("a"), 1)
    write, calls = scd2.state.write_state, []

    def overtaken(spark, root, record):
        if not calls:  # the other run applies its version while this one has written its data
            calls.append(record)
            other.apply(rows("b"), 2)
        write(spark, root, record)

    scd2.state.write_state = overtaken
    try:
        with pytest.raises(RuntimeError, match="since record 1 was read"):
            store.apply(rows("c"), 3)
    finally:
        scd2.state.write_state = write
    assert store.last_version() == 2
    assert {r["segment"] for r in store.read_open().collect()} == {"b", "x"}
    store.apply(rows("c"), 3)  # begun again, from the newest record
    assert store.read().where("k = 1").count() == 3


def test_a_snapshot_with_failed_fetches_is_evaluated_once(spark, tmp_path):
    """the failed keys stay open without a second evaluation of the (costly) snapshot."""
    seen = spark.sparkContext.accumulator(0)

    def note(k):
        seen.add(1)
        return k

    key = F.udf(note, "string").asNondeterministic()
    store = scd2.HistoryStore(spark, str(tmp_path / "h"), ["k"], ["v"])
    store.apply(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int"), 1)
    snapshot = spark.createDataFrame([("a", 1), ("d", 4)], "k string, v int").select(key("k").alias("k"), "v")
    failed = spark.createDataFrame([("b",), ("b",), ("a",), (None,), ("x",)], "k string")
    rows = store.apply(snapshot, 2, unresolved=failed).select("k", "v", scd2.START, scd2.END).collect()
    assert sorted(map(tuple, rows), key=str) == [("a", 1, 1, None), ("b", 2, 1, None), ("c", 3, 1, 2), ("d", 4, 2, None)]
    assert seen.value == 2
