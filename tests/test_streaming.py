"""K1: the streaming append equals the batch rebuild once all hours close."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from spendscope import fixtures as fx
from spendscope.operators import cost, prices
from spendscope.streaming import incremental

SF = "/root/testdata/sf0.001"


def attribution(rows):
    return {r["statement_id"]: (r["attributed_cost_usd"], r["attributed_dbus"]) for r in rows.collect()}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for k in got:
        for a, b in zip(got[k], want[k]):
            assert (a is None) == (b is None) and abs((a or 0) - (b or 0)) < 1e-9


def inputs(spark):
    pr = prices.effective_prices(fx.account_prices(spark, SF), fx.list_prices(spark, SF))
    return fx.query_history(spark, SF), fx.usage(spark, SF), pr


def like(row, sid, start, end, status="FINISHED", **more):
    """``row`` with another id, times and status."""
    out = row.withColumn("statement_id", F.lit(sid)).withColumn("execution_status", F.lit(status)) \
        .withColumn("start_time", F.lit(start).cast("timestamp_ntz")).withColumn("end_time", F.lit(end).cast("timestamp_ntz"))
    return out.withColumns({k: F.lit(v).cast("string") for k, v in more.items()})


def test_stream_append_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="k1-")
    qh, us, pr = inputs(spark)
    qh.write.parquet(f"{root}/history")

    def run(until):
        return incremental.run_stream(spark, f"{root}/history", f"{root}/sink", f"{root}/ckpt", us, pr, fx.AS_OF,
                                      complete_until=lambda: until)

    run(dt.datetime(2024, 1, 20))
    sink = spark.read.parquet(f"{root}/sink")
    batch = cost.query_cost_attribution(qh, us, pr, fx.AS_OF)
    final = incremental.final_statements(batch, dt.datetime(2024, 1, 20))
    assert_same(attribution(sink), attribution(final))
    # a later horizon adds the rest, a repeated one nothing
    run(dt.datetime(2024, 3, 1))
    run(dt.datetime(2024, 3, 1))
    again = spark.read.parquet(f"{root}/sink")
    assert again.count() == batch.count()
    assert_same(attribution(again), attribution(batch))


def test_stream_in_any_order_with_restarts_reads_new_files_only(spark, tmp_path):
    """Files of mixed ages, out of order, some statements first seen while running, over three
    runs of the stream: the history equals the rebuild, and every file is read once."""
    qh, us, pr = inputs(spark)
    root = str(tmp_path)
    one = qh.where("execution_status = 'FINISHED'").orderBy("statement_id").limit(1)
    n = F.expr("cast(substr(statement_id, 2) as int)")
    # every 40th statement of the second half is landed as running before it is landed as finished
    slow = (n % 40 == 7) & (F.col("start_time") >= F.lit("2024-01-14").cast("timestamp_ntz"))
    began = qh.where(slow) \
        .withColumn("execution_status", F.lit("RUNNING")).withColumn("end_time", F.lit(None).cast("timestamp_ntz"))
    noise = like(one, "old", "2021-01-01 05:00:00", None, "RUNNING") \
        .unionByName(like(one, "nowhere", "2024-01-02 01:00:00", None, "RUNNING", warehouse_id=None)) \
        .unionByName(like(one, "gone", "2024-01-02 02:00:00", None, "CANCELED"))
    early, rest = F.col("start_time") < F.lit("2024-01-16").cast("timestamp_ntz"), ~slow
    pieces = [
        [qh.where(early & rest & (n % 3 == 2)), began, noise, qh.where(~early & (n % 2 == 0) & rest)],
        [qh.where(early & rest & (n % 3 == 0)), qh.where(early & rest & (n % 3 == 1)), qh.where(early & rest & (n % 3 == 1))],
        [qh.where(~early & (n % 2 == 1) & rest), qh.where(~rest)],
    ]
    # what is promised to be complete after each piece: nothing of the first days, then all up to the running ones
    until = [dt.datetime(2023, 12, 31), dt.datetime(2024, 1, 13), dt.datetime(2024, 3, 1)]
    read, boundaries = [], []
    for piece, horizon in zip(pieces, until):
        for df in piece:
            df.coalesce(1).write.mode("append").parquet(f"{root}/landed")
        query = incremental.run_stream(spark, f"{root}/landed", f"{root}/sink", f"{root}/ckpt", us, pr, fx.AS_OF,
                                       complete_until=lambda: horizon, max_files_per_batch=2)
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
        boundaries.append(incremental.read_boundary(spark, f"{root}/sink"))
    assert read == [sum(df.count() for df in piece) for piece in pieces]
    history = incremental.CostHistory(spark, f"{root}/sink", fx.AS_OF)
    want = cost.query_cost_attribution(qh, us, pr, fx.AS_OF)
    assert boundaries[:2] == until[:2] and history.read().count() == want.count()
    assert_same(attribution(history.read()), attribution(want))
    assert history.open_statements().count() == 0


def test_what_holds_hours_open(spark, tmp_path):
    """Only running statements that could share a bill hold hours; old ones are counted instead."""
    qh, us, pr = inputs(spark)
    one = qh.where("execution_status = 'FINISHED'").orderBy("statement_id").limit(1)
    D = dt.datetime
    harmless = like(one, "old", "2021-01-01 05:00:00", None, None).unionByName(
        like(one, "nowhere", "2024-01-02 01:00:00", None, "RUNNING", warehouse_id=None)).unionByName(
        like(one, "dead", "2024-01-02 02:00:00", None, "FAILED"))
    held = qh.unionByName(harmless).unionByName(like(one, "slow", "2024-01-05 03:10:00", None, "RUNNING"))

    def closed(rows, until, **more):
        return incremental.closed_until(rows, until, fx.AS_OF, **more)

    assert closed(qh.unionByName(harmless), D(2024, 1, 11, 4, 30)) == D(2024, 1, 11, 4)
    assert closed(held, D(2024, 1, 11)) == D(2024, 1, 5, 3)
    assert closed(held, D(2024, 1, 11), running_limit_hours=48) == D(2024, 1, 11)
    history = incremental.CostHistory(spark, str(tmp_path / "a"), fx.AS_OF)
    history.absorb(held)
    assert history.close(us, pr, D(2024, 1, 11)) == D(2024, 1, 5, 3)
    patient = incremental.CostHistory(spark, str(tmp_path / "b"), fx.AS_OF, running_limit_hours=48)
    patient.absorb(held)
    assert patient.close(us, pr, D(2024, 1, 11)) == D(2024, 1, 11) and patient.record()["abandoned"] == 1
    # the abandoned one ends after all: it is late, and appended
    patient.absorb(like(one, "slow", "2024-01-05 03:10:00", "2024-01-12 01:00:00"))
    patient.close(us, pr, D(2024, 3, 1))
    assert patient.record()["abandoned"] == 0 and patient.read().where("statement_id = 'slow'").count() == 1


def test_late_and_repeated_rows_and_a_lost_run(spark, tmp_path, monkeypatch):
    qh, us, pr = inputs(spark)
    one = qh.where("execution_status = 'FINISHED'").orderBy("statement_id").limit(1)
    late = like(one, "late", "2024-01-09 01:00:00", "2024-01-09 03:10:00")
    history = incremental.CostHistory(spark, str(tmp_path / "sink"), fx.AS_OF)
    assert history.absorb(qh, 0) and not history.absorb(qh, 0)  # a repeated batch adds nothing
    write, lost = incremental.state.write_state, []

    def dies(spark, root, record):
        lost.append(record)
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental.state, "write_state", dies)
    with pytest.raises(RuntimeError, match="lost"):
        history.close(us, pr, dt.datetime(2024, 1, 15))
    assert lost and history.read().count() == 0  # written but not recorded: not part of the history
    monkeypatch.setattr(incremental.state, "write_state", write)
    history.close(us, pr, dt.datetime(2024, 1, 15))
    first = attribution(history.read())
    assert_same(first, attribution(incremental.final_statements(cost.query_cost_attribution(qh, us, pr, fx.AS_OF), dt.datetime(2024, 1, 15))))
    history.absorb(late.unionByName(qh.orderBy("statement_id").limit(50)), 1)
    assert history.close(us, pr, dt.datetime(2024, 1, 15)) == dt.datetime(2024, 1, 15)  # only the late one is appended
    assert history.close(us, pr, dt.datetime(2024, 1, 15)) is None
    got = attribution(history.read())
    assert got.keys() == first.keys() | {"late"} and history.read().count() == len(got)
    want = attribution(cost.query_cost_attribution(qh.unionByName(late), us, pr, fx.AS_OF))
    assert all(abs(a - b) < 1e-9 for a, b in zip(got["late"], want["late"]))
    history.close(us, pr, dt.datetime(2024, 3, 1))
    assert attribution(history.read()).keys() == want.keys()


def test_weekly_increments_equal_rebuild(spark):
    root = tempfile.mkdtemp(prefix="k1w-")
    qh = fx.query_history(spark, SF)
    pr = prices.effective_prices(fx.account_prices(spark, SF), fx.list_prices(spark, SF))
    us = fx.usage(spark, SF)
    for day in (3, 8, 9, 15, 22, 29):
        incremental.append_closed(f"{root}/sink", qh, us, pr, dt.datetime(2024, 1, day), fx.AS_OF)
    assert incremental.append_closed(f"{root}/sink", qh, us, pr, dt.datetime(2024, 1, 20), fx.AS_OF) is None
    incremental.append_closed(f"{root}/sink", qh, us, pr, fx.AS_OF, fx.AS_OF)
    sink = spark.read.parquet(f"{root}/sink")
    batch = cost.query_cost_attribution(qh, us, pr, fx.AS_OF)
    cols = ["statement_id", "attributed_cost_usd", "attributed_dbus"]
    a = {r[0]: r for r in sink.select(*cols).collect()}
    b = {r[0]: r for r in batch.select(*cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert abs((a[k][1] or 0) - (b[k][1] or 0)) < 1e-9 and abs((a[k][2] or 0) - (b[k][2] or 0)) < 1e-9


def test_lateness_holds_the_boundary_back(spark):
    root = tempfile.mkdtemp(prefix="k1l-")
    qh = fx.query_history(spark, SF)
    pr = prices.effective_prices(fx.account_prices(spark, SF), fx.list_prices(spark, SF))
    us = fx.usage(spark, SF)
    b0 = incremental.append_closed(f"{root}/a", qh, us, pr, dt.datetime(2024, 1, 15), fx.AS_OF)
    b1 = incremental.append_closed(f"{root}/b", qh, us, pr, dt.datetime(2024, 1, 15), fx.AS_OF,
                                   allowed_lateness_hours=24)
    assert b1 == b0 - dt.timedelta(hours=24)
    a = spark.read.parquet(f"{root}/a").count()
    b = spark.read.parquet(f"{root}/b").count()
    assert 0 < b < a


def test_long_running_late_statements_and_lost_state(spark, tmp_path):
    """A 30-hour statement holds its hours open while it runs; a late statement and a lost
    state record neither lose nor double a row."""
    from pyspark.sql import functions as F

    base = fx.query_history(spark, SF)
    one = base.limit(1)
    D = dt.datetime

    def stmt(sid, start, end):
        return one.withColumn("statement_id", F.lit(sid)).withColumn("start_time", F.lit(start).cast("timestamp_ntz")) \
            .withColumn("end_time", F.lit(end).cast("timestamp_ntz"))

    long_open, long_done = stmt("long", "2024-01-10 02:10:00", None), stmt("long", "2024-01-10 02:10:00", "2024-01-11 08:20:00")
    short, late = stmt("short", "2024-01-10 05:00:00", "2024-01-10 05:30:00"), stmt("late", "2024-01-09 01:00:00", "2024-01-09 01:10:00")
    us = fx.usage(spark, SF)
    pr = prices.effective_prices(fx.account_prices(spark, SF), fx.list_prices(spark, SF))
    sink = str(tmp_path / "sink")
    b0 = incremental.append_closed(sink, base.unionByName(long_open).unionByName(short), us, pr, D(2024, 1, 11), fx.AS_OF)
    assert b0 == D(2024, 1, 10, 2)  # held by the running statement
    ids = {r[0] for r in spark.read.parquet(sink).select("statement_id").collect()}
    assert not ids & {"long", "short", "late"}
    full = base.unionByName(long_done).unionByName(short).unionByName(late)
    incremental.append_closed(sink, full, us, pr, D(2024, 1, 20), fx.AS_OF)
    (tmp_path / "sink" / "_state").rename(tmp_path / "lost")
    incremental.append_closed(sink, full, us, pr, fx.AS_OF, fx.AS_OF)
    got = {r[0]: r[1] for r in spark.read.parquet(sink).select("statement_id", "attributed_cost_usd").collect()}
    assert spark.read.parquet(sink).count() == len(got)
    want = {r[0]: r[1] for r in cost.query_cost_attribution(full, us, pr, fx.AS_OF).select(
        "statement_id", "attributed_cost_usd").collect()}
    assert got.keys() == want.keys()
    # the late one shares hours that were closed before it came: only their rows may differ
    for k in ("long", "short", "late"):
        assert abs((got[k] or 0) - (want[k] or 0)) < 1e-9


def test_empty_feed(spark, tmp_path):
    """No rows, and no absorbed batch at all: the boundary moves, the history stays empty."""
    qh, us, pr = inputs(spark)
    for name, rows in (("none", None), ("empty", qh.limit(0))):
        history = incremental.CostHistory(spark, str(tmp_path / name), fx.AS_OF)
        if rows is not None:
            history.absorb(rows)
        assert history.close(us, pr, dt.datetime(2024, 1, 15)) == dt.datetime(2024, 1, 15)
        assert history.close(us, pr, dt.datetime(2024, 1, 15)) is None
        assert history.read().count() == 0 and history.open_statements().count() == 0
