"""Append-only per-statement cost history that outlives the source tables.

An hour's bill is shared by the work of every statement active in it, so a
statement's cost is final only when all its hours are closed: history is
complete up to ``complete_until`` (an input: only the owner of the feed
knows it), and no statement of an hour is still running.  A running
statement (no ``end_time`` yet) holds the hours from its start on open if it
could still share a bill: it has a warehouse, started in the window, and has
not failed or been cancelled.  ``running_limit_hours`` declares an age from
which a statement is taken for abandoned; these are counted and hold nothing.

Two ways to build the history:

* :class:`CostHistory` keeps the open statements as state.  ``absorb`` adds
  a micro-batch's rows to it and reads nothing else; ``close`` attributes the
  hours that the boundary passes, moves statements whose last hour it passed
  to the history and keeps the rest, with the cost of their closed hours.
  :func:`run_stream` drives it from a Structured Streaming file source.
* :func:`append_closed` keeps no state but the boundary: it looks for final
  statements in the history table it is given and rereads the slice that
  shares hours with them.

The state is versioned Parquet on shared storage rather than one state
value per (workspace, warehouse, hour): a busy hour may hold a third of all
statements, and here its total is a partial aggregate and its rows stay
spread over tasks.  Every version is written to a folder of its own and
counts once its state record is there, so a lost run is simply repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.functions.time import hour_floor, lookback_start, ntz_literal
from spendscope.operators import cost
from spendscope.plans import state
from spendscope.plans.joins import materialize

# Statuses of statements that ended without sharing a bill.
DEAD_STATUSES = ("FAILED", "CANCELED")

DONE, VOID, RUNNING = 2, 1, 0  # what is known of a statement; the highest counts


def _last_hour_end() -> Column:
    return hour_floor(F.greatest(F.col("start_time"), F.col("end_time"))) + F.expr("INTERVAL 1 HOUR")


def still_running(as_of: dt.datetime, window_days: int) -> Column:
    """Rows that may yet share a bill: on a warehouse, in the window, not ended, not dead."""
    return (
        F.col("end_time").isNull() & F.col("warehouse_id").isNotNull()
        & (F.col("start_time") >= ntz_literal(lookback_start(as_of, window_days)))
        & (F.col("execution_status").isNull() | ~F.col("execution_status").isin(*DEAD_STATUSES))
    )


def closed_until(query_history: DataFrame, complete_until: dt.datetime, as_of: dt.datetime, window_days: int = 365,
                 running_limit_hours: int | None = None) -> dt.datetime:
    """The hour before which no statement that could still share a bill is running and no row is missing."""
    whole = complete_until.replace(minute=0, second=0, microsecond=0)
    running = query_history.where(still_running(as_of, window_days) & (F.col("start_time") < ntz_literal(whole)))
    if running_limit_hours is not None:
        running = running.where(F.col("start_time") >= ntz_literal(complete_until - dt.timedelta(hours=running_limit_hours)))
    first = running.agg(F.min(hour_floor(F.col("start_time"))).alias("t")).first()["t"]
    return whole if first is None else min(whole, first)


def final_statements(rows: DataFrame, boundary: dt.datetime) -> DataFrame:
    """Statements whose last hour ends at or before the closed boundary."""
    return rows.where(F.col("end_time").isNotNull() & (_last_hour_end() <= ntz_literal(boundary)))


def read_boundary(spark: SparkSession, sink_path: str) -> dt.datetime | None:
    """The closed boundary recorded by the last increment (None before the first)."""
    found = state.read_state(spark, sink_path)
    return None if found is None or not found.get("closed_until") else dt.datetime.fromisoformat(found["closed_until"])


# Columns of the open statements: what a statement is, how far it is attributed, and its cost so far.
OPEN_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in cost.STATEMENT_COLUMNS]
    + [T.StructField("start_time", T.TimestampNTZType()), T.StructField("end_time", T.TimestampNTZType()),
       T.StructField("work_ms", T.LongType()), T.StructField("known", T.IntegerType()),
       T.StructField("attributed_until", T.TimestampNTZType()), T.StructField("attributed_cost_usd", T.DoubleType()),
       T.StructField("attributed_dbus", T.DoubleType())]
)


class CostHistory:
    """The cost history under ``root`` and its open statements.

    ``increment=<n>/`` holds the statements that version n made final;
    ``_open/`` the open statements, ``_rates/`` the total work and bill of every
    closed warehouse-hour, ``_state/`` the records.  A folder of a version that
    has no record yet is written anew by the run that repeats it."""

    def __init__(self, spark: SparkSession, root: str, as_of: dt.datetime, window_days: int = 365,
                 discount_pct: float = 0.0, running_limit_hours: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.as_of, self.window_days, self.discount_pct = as_of, window_days, discount_pct
        self.running_limit_hours = running_limit_hours

    def record(self) -> dict:
        """The last committed version: number of increments, boundary, last batch, open folders, abandoned statements."""
        return state.read_state(self.spark, self.root) or {
            "increments": 0, "closed_until": None, "last_batch": -1, "open": [], "step": 0, "abandoned": 0,
            "record": 0}

    def read(self) -> DataFrame:
        """The final statements of all committed increments, with the ``increment`` that brought them."""
        n = self.record()["increments"]
        schema = T.StructType([f for f in OPEN_SCHEMA if f.name in cost.ATTRIBUTION_COLUMNS] + [T.StructField("increment", T.IntegerType())])
        if not n:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.root).where(F.col("increment") <= n)

    def increment(self, n: int) -> DataFrame:
        """The statements that increment ``n`` made final; reads its folder only."""
        if not 1 <= n <= self.record()["increments"]:
            raise ValueError(f"{self.root} has no increment {n}")
        return self.spark.read.parquet(f"{self.root}/increment={n}")

    def open_statements(self) -> DataFrame:
        folders = [f"{self.root}/_open/{x}" for x in self.record()["open"]]
        return self.spark.read.schema(OPEN_SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], OPEN_SCHEMA)

    def absorb(self, rows: DataFrame, batch_id: int | None = None) -> bool:
        """Add landed query-history rows to the open statements; False if the batch is known already.

        Rows may come in any order and more than once; a statement that was running is
        replaced by its later row.  Nothing but ``rows`` is read."""
        record = self.record()
        if batch_id is not None and batch_id <= record["last_batch"]:
            return False
        usable = F.col("warehouse_id").isNotNull() & (F.col("start_time") >= ntz_literal(lookback_start(self.as_of, self.window_days)))
        known = (
            F.when(F.col("end_time").isNotNull() & (F.col("execution_status") == "FINISHED"), DONE)
            .when(still_running(self.as_of, self.window_days), RUNNING).otherwise(VOID)
        )
        kept = rows.where(usable).select(
            *cost.STATEMENT_COLUMNS, "start_time", "end_time", cost.work_ms().alias("work_ms"), known.alias("known"),
            F.lit(None).cast("timestamp_ntz").alias("attributed_until"), F.lit(None).cast("double").alias("attributed_cost_usd"),
            F.lit(None).cast("double").alias("attributed_dbus"))
        step = record["step"] + 1
        kept.write.mode("overwrite").parquet(f"{self.root}/_open/rows-{step}")
        record |= {"step": step, "open": [*record["open"], f"rows-{step}"]}
        if batch_id is not None:
            record["last_batch"] = batch_id
        state.write_state(self.spark, self.root, record)
        return True

    def close(self, usage: DataFrame, prices: DataFrame, complete_until: dt.datetime,
              usage_date_col: str | None = None) -> dt.datetime | None:
        """Attribute what the boundary passes; returns the boundary, or None when it did not
        move and no late statement came.

        All rows up to ``complete_until`` must have been absorbed, and ``usage`` must be
        complete up to it.  A statement that comes after its hours were closed (late) is
        still appended, once: its share is taken over the recorded work of its hours plus
        that of the late statements; rows appended before stay as they are."""
        record, spark = self.record(), self.spark
        n = record["increments"] + 1
        since = None if record["closed_until"] is None else dt.datetime.fromisoformat(record["closed_until"])
        # one row a statement: what is known best of it; a row with attributed hours before any repeat of it
        best = F.struct(F.col("attributed_until").isNotNull().alias("begun"), "known", *[c for c in OPEN_SCHEMA.names if c != "known"])
        live_path = f"{self.root}/_open/live-{n}"
        running, done = F.col("known") == RUNNING, F.col("known") == DONE
        oldest = None if self.running_limit_hours is None else complete_until - dt.timedelta(hours=self.running_limit_hours)
        holds = running if oldest is None else running & (F.col("start_time") >= ntz_literal(oldest))
        first_hour = hour_floor(F.col("start_time"))
        late = done & F.col("attributed_until").isNull() & (first_hour < ntz_literal(since)) if since else F.lit(False)
        counted = Observation("open_statements")
        self.open_statements().groupBy("statement_id").agg(F.max(best).alias("b")).select("b.*").where(F.col("known") != VOID).observe(
            counted,
            F.min(F.when(holds, first_hour)).cast("string").alias("held"), F.count_if(running & ~holds).alias("abandoned"),
            F.count_if(late).alias("late"), F.min(F.when(late, F.col("start_time"))).cast("string").alias("late_from"),
            F.min(F.when(done, F.coalesce("attributed_until", first_hour))).cast("string").alias("lower"),
        ).write.mode("overwrite").parquet(live_path)
        live = spark.read.schema(OPEN_SCHEMA).parquet(live_path)
        seen = {k: dt.datetime.fromisoformat(v) if isinstance(v, str) else v for k, v in counted.get.items()}
        boundary = complete_until.replace(minute=0, second=0, microsecond=0)
        boundary = min(boundary, seen["held"]) if seen["held"] else boundary
        boundary = max(boundary, since) if since else boundary
        if boundary == since and not seen["late"]:
            return None
        if seen["late"]:  # those that the history has already are repeats
            there = self.read().where(F.col("start_time") >= ntz_literal(seen["late_from"])).select("statement_id")
            live = live.join(there, "statement_id", "left_anti")
        lower = min(seen["lower"] or boundary, boundary)
        end = ntz_literal(boundary)

        hours = cost.statement_hours(live.where(done & (first_hour < end))).where(
            (F.col("hour_start") < end) & (F.col("hour_start") >= F.coalesce("attributed_until", "hour_start")))
        work = cost.statement_hour_work(hours)
        totals = cost.hour_totals(work).withColumn("new_work_ms", F.col("total_work_ms_in_hour"))
        if seen["late"]:
            old = self._rates().where((F.col("hour_start") >= ntz_literal(lower)) & (F.col("hour_start") < ntz_literal(since)))
            old = old.groupBy(*cost.HOUR_KEY).agg(F.sum("new_work_ms").alias("__old"))
            totals = totals.join(old, cost.HOUR_KEY, "left").withColumn(
                "total_work_ms_in_hour", F.col("new_work_ms") + F.coalesce("__old", F.lit(0.0))).drop("__old")
        billed = usage.where((F.col("usage_start_time") >= ntz_literal(lower)) & (F.col("usage_start_time") < end))
        bill = cost.hourly_cost(billed, prices, self.as_of, self.window_days, self.discount_pct, partition_date_col=usage_date_col)
        cost.hour_rates(totals, bill).write.mode("overwrite").parquet(f"{self.root}/_rates/increment={n}")
        rates = spark.read.parquet(f"{self.root}/_rates/increment={n}")

        names = [*cost.STATEMENT_COLUMNS, "start_time", "end_time", "work_ms", "cost_usd_in_hour", "dbus_in_hour"]
        shares = cost.attribute_hours(work, rates, written=True).select(*names)
        so_far = live.where(done).withColumnsRenamed({"attributed_cost_usd": "cost_usd_in_hour", "attributed_dbus": "dbus_in_hour"})
        summed = cost.roll_up_statements(shares.unionByName(so_far.select(*names)))
        summed = summed.select("*", F.lit(DONE).alias("known"), F.when(first_hour < end, end).alias("attributed_until"),
                               (_last_hour_end() <= end).alias("is_final"))
        waiting = live.where(running).withColumn("is_final", F.lit(False))
        out = f"{self.root}/_open/sums-{n}"
        summed.unionByName(waiting).write.mode("overwrite").partitionBy("is_final").parquet(out)
        sums = spark.read.schema(T.StructType([*OPEN_SCHEMA, T.StructField("is_final", T.BooleanType())])).parquet(out)
        sums.where("is_final").select(*cost.ATTRIBUTION_COLUMNS).write.mode("overwrite").parquet(f"{self.root}/increment={n}")

        before = record["open"]
        left = f"sums-{n}/is_final=false"
        record |= {"increments": n, "closed_until": boundary.isoformat(), "abandoned": seen["abandoned"],
                   "open": [left] if state.exists(spark, f"{self.root}/_open/{left}") else []}
        state.write_state(spark, self.root, record)
        for folder in [*before, f"live-{n}", f"sums-{n}/is_final=true"]:  # nothing reads them any more
            state.remove(spark, f"{self.root}/_open/{folder}")
        return boundary

    def _rates(self) -> DataFrame:
        n = self.record()["increments"]
        return self.spark.read.parquet(f"{self.root}/_rates").where(F.col("increment") <= n)


def append_closed(
    sink_path: str,
    query_history: DataFrame,
    usage: DataFrame,
    prices: DataFrame,
    complete_until: dt.datetime,
    as_of: dt.datetime,
    window_days: int = 365,
    discount_pct: float = 0.0,
    allowed_lateness_hours: int = 0,
    late_by_hours: int | None = None,
    history_date_col: str | None = None,
    usage_date_col: str | None = None,
    running_limit_hours: int | None = None,
) -> dt.datetime | None:
    """Append newly final statements of a whole history table to the parquet sink; returns
    the closed boundary (None when it did not move and nothing late was found).

    Final statements that the sink does not have are taken (left anti join on
    ``statement_id``: a lost state record, a repeated run or a late statement neither
    doubles nor loses a row), and history and usage are read from the first hour of the
    earliest of them on.  ``allowed_lateness_hours`` holds the boundary back, like a
    watermark.  ``late_by_hours`` promises that no statement is reported later than that
    after it ended, so older ones need not be looked for in the sink; without it every
    final statement is.  ``history_date_col`` / ``usage_date_col`` name DATE partition
    columns of the inputs."""
    spark = query_history.sparkSession
    boundary = closed_until(query_history, complete_until - dt.timedelta(hours=allowed_lateness_hours), as_of, window_days,
                            running_limit_hours)
    since = read_boundary(spark, sink_path)
    boundary = boundary if since is None else max(boundary, since)
    stmts = cost.statements(query_history, as_of, window_days, history_date_col)
    fresh = final_statements(stmts, boundary).select("statement_id", "start_time", "end_time")
    if late_by_hours is not None and since is not None:
        fresh = fresh.where(F.col("end_time") > ntz_literal(since - dt.timedelta(hours=late_by_hours)))
    if state.holds_data(spark, sink_path):
        fresh = fresh.join(spark.read.parquet(sink_path).select("statement_id"), "statement_id", "left_anti")
    fresh = materialize(fresh, "fresh_statements")
    lower = fresh.agg(F.min(hour_floor(F.col("start_time"))).alias("t")).first()["t"]
    if lower is None:
        if since is None or boundary > since:
            state.write_state(spark, sink_path, {"closed_until": boundary.isoformat()})
            return boundary
        return None
    # every statement that shares an hour with a fresh one ends after its first hour begins
    history = query_history.where(F.col("end_time").isNull() | (F.col("end_time") >= ntz_literal(lower)))
    used = usage.where(F.col("usage_start_time") >= ntz_literal(lower))
    qca = cost.query_cost_attribution(history, used, prices, as_of, window_days, discount_pct,
                                      history_date_col=history_date_col, usage_date_col=usage_date_col)
    new = qca.join(fresh.select("statement_id"), "statement_id", "left_semi")
    # append first, then record the boundary: a failure in between only makes
    # the next increment look again, and the anti join finds the rows there
    new.select(*cost.ATTRIBUTION_COLUMNS).write.mode("append").parquet(sink_path)
    state.write_state(spark, sink_path, {"closed_until": boundary.isoformat()})
    return boundary


def run_stream(
    spark: SparkSession,
    history_dir: str,
    sink_path: str,
    checkpoint: str,
    usage: DataFrame,
    prices: DataFrame,
    as_of: dt.datetime,
    complete_until: Callable[[], dt.datetime],
    window_days: int = 365,
    discount_pct: float = 0.0,
    available_now: bool = True,
    allowed_lateness_hours: int = 0,
    running_limit_hours: int | None = None,
    max_files_per_batch: int | None = None,
):
    """Structured Streaming driver: a file source over ``history_dir`` (landed query-history
    parquet) feeds a :class:`CostHistory` under ``sink_path``; every batch reads its new
    files only.

    ``complete_until`` is asked before the files of a batch are listed, so what it promises
    has landed by then.  With ``available_now`` the files landed so far are absorbed, in
    as many batches as ``max_files_per_batch`` makes of them, and then the hours it allows
    are closed, before this returns; call it again for more.  Otherwise the started query
    is returned, and every batch closes what was promised before the batch began
    (``max_files_per_batch`` must be unset, as a batch then holds all that has landed)."""
    schema = spark.read.parquet(history_dir).schema
    history = CostHistory(spark, sink_path, as_of, window_days, discount_pct, running_limit_hours)
    late = dt.timedelta(hours=allowed_lateness_hours)
    promised = complete_until()
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_batch is not None:
        if not available_now:
            raise ValueError("max_files_per_batch needs available_now: a promise covers all landed files")
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        nonlocal promised
        history.absorb(batch, batch_id)
        if not available_now:
            history.close(usage, prices, promised - late)
            promised = complete_until()

    writer = reader.load(history_dir).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if not available_now:
        return writer.trigger(processingTime="1 minute").start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    history.close(usage, prices, promised - late)
    return query
