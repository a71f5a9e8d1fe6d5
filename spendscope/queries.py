"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``
over tables derived from the generated data, with its DuckDB oracle.

Money and work are rounded to 4 digits on both sides (float sums differ in
the last digits between engines); every output column is aliased to the
same name in the oracle.
"""

from __future__ import annotations

import datetime as _dt
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscope import fixtures as fx
from spendscope import oracle, schemas, tables
from spendscope.functions import normalize as N
from spendscope.functions.normalize import owner_from_path
from spendscope.operators import cost, metrics, prices, quality, rollup_states, rollups, scd2, usage
from spendscope.plans.joins import materialize
from spendscope.sources import landing, normalize, system_tables
from spendscope.session import prepare
from spendscope.streaming import incremental, snapshots

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


def rn(c: str, digits: int) -> F.Column:
    """Half-up rounding written as plain IEEE arithmetic, so that Spark and
    DuckDB round exact ties the same way (their ``round`` functions differ)."""
    scale = 10 ** digits
    return (F.floor(F.col(c).cast("double") * scale + 0.5) / scale).alias(c)


def r4(c: str) -> F.Column:
    return rn(c, 4)


def on(expr: str, digits: int, alias: str | None = None) -> str:
    """Oracle twin of :func:`rn`."""
    return f"floor(cast({expr} as double) * {10 ** digits} + 0.5) / {10 ** digits} as {alias or expr}"


def o4(expr: str, alias: str | None = None) -> str:
    return on(expr, 4, alias)


# ------------------------------------------------------------------ inputs
@fx.once_per_session
def _prices(spark, sf_dir):
    return prices.effective_prices(fx.account_prices(spark, sf_dir), fx.list_prices(spark, sf_dir))


def _hourly(spark, sf_dir, discount_pct=0.0):
    return cost.hourly_cost(fx.usage(spark, sf_dir), _prices(spark, sf_dir), fx.AS_OF, fx.WINDOW_DAYS, discount_pct)


def _shw(spark, sf_dir):
    stmts = cost.statements(fx.query_history(spark, sf_dir), fx.AS_OF, fx.WINDOW_DAYS)
    return cost.statement_hour_work(cost.statement_hours(stmts))


def _written_hourly(spark, sf_dir):
    """The undiscounted bill, written: the attribution and the check share it."""
    return materialize(_hourly(spark, sf_dir), "hourly_bill")


def cost_attribution(spark: SparkSession, sf_dir: str, discount_pct: float = 0.0,
                     window_days: int = fx.WINDOW_DAYS, hourly: DataFrame | None = None) -> DataFrame:
    return cost.query_cost_attribution(
        fx.query_history(spark, sf_dir), fx.usage(spark, sf_dir), _prices(spark, sf_dir),
        fx.AS_OF, window_days, discount_pct, hourly=hourly,
    )


QCA_OUT = [
    *cost.STATEMENT_COLUMNS, "start_time", "end_time", "work_ms",
]


# --------------------------------------------------------------- H1 / R6
@register("effective_prices", oracle.build(["prices_eff"], "select * from prices_eff"))
def q_effective_prices(spark, sf_dir):
    """H1: contract prices override list prices for the same start."""
    return _prices(spark, sf_dir)


@register("overlapping_prices", oracle.build(["prices_eff"], """
select a.cloud, a.sku_name, a.price_start_time as first_start_time, a.price_end_time as first_end_time,
  b.price_start_time as second_start_time, b.price_end_time as second_end_time
from prices_eff a join prices_eff b
  on a.cloud = b.cloud and a.sku_name = b.sku_name and a.price_start_time < b.price_start_time
 and b.price_start_time < coalesce(a.price_end_time, timestamp '9999-12-31 00:00:00')"""))
def q_overlapping_prices(spark, sf_dir):
    """R6 diagnostic: effective price intervals of one SKU that overlap."""
    return prices.overlapping_prices(_prices(spark, sf_dir))


# --------------------------------------------------------------------- H2
_HOURLY_SELECT = f"""select workspace_id, warehouse_id, hour_start, {o4('dbus')}, {o4('list_cost_usd')} from bill_by_hour"""


@register("hourly_cost", oracle.build(["bill_by_hour"], _HOURLY_SELECT))
def q_hourly_cost(spark, sf_dir):
    """H2: DBUs and cost per workspace, warehouse and hour."""
    return _hourly(spark, sf_dir).select("workspace_id", "warehouse_id", "hour_start", r4("dbus"), r4("list_cost_usd"))


@register("hourly_cost_interval_join", oracle.build(["bill_by_hour"], _HOURLY_SELECT))
def q_hourly_cost_interval_join(spark, sf_dir):
    """H2/E2 for price lists too large to broadcast: usage and prices are joined by (cloud, SKU,
    time bin), heavy pairs split by their measured counts."""
    out = cost.hourly_cost(fx.usage(spark, sf_dir), _prices(spark, sf_dir), fx.AS_OF, fx.WINDOW_DAYS, max_broadcast_rows=0)
    return out.select("workspace_id", "warehouse_id", "hour_start", r4("dbus"), r4("list_cost_usd"))


# Discounted costs are exact to 6 decimals (3-decimal DBUs x 1-decimal
# prices x 0.65); rounding them at 4 digits would hit exact ties that float
# summation order decides, so this query rounds at their own precision.
@register("hourly_cost_discounted", oracle.build(["bill_by_hour"], f"""select workspace_id, warehouse_id, hour_start,
  {o4('dbus')}, {on('list_cost_usd', 6)} from bill_by_hour""", factor=cost.discount_factor(35.0)))
def q_hourly_cost_discounted(spark, sf_dir):
    """H2 + D11: 35 % contract discount on the list cost."""
    return _hourly(spark, sf_dir, 35.0).select(
        "workspace_id", "warehouse_id", "hour_start", r4("dbus"), rn("list_cost_usd", 6)
    )


# ------------------------------------------------------------------ H3-H7
@register("statements_in_window", oracle.build(["stmt"], "select * from stmt"))
def q_statements(spark, sf_dir):
    """H3: finished warehouse statements in the window with their work."""
    return cost.statements(fx.query_history(spark, sf_dir), fx.AS_OF, fx.WINDOW_DAYS)


@register("statement_hours", oracle.build(["stmt_hours"],
                                          "select statement_id, warehouse_id, hour_start from stmt_hours"))
def q_statement_hours(spark, sf_dir):
    """H4: one row per statement and clock hour it spans."""
    stmts = cost.statements(fx.query_history(spark, sf_dir), fx.AS_OF, fx.WINDOW_DAYS)
    return cost.statement_hours(stmts).select("statement_id", "warehouse_id", "hour_start")


@register("statement_hour_work", oracle.build(["stmt_hour_work"], f"""
select statement_id, hour_start, {o4('work_ms_in_hour')} from stmt_hour_work"""))
def q_statement_hour_work(spark, sf_dir):
    """H5: work prorated to each hour by wall-clock overlap."""
    return _shw(spark, sf_dir).select("statement_id", "hour_start", r4("work_ms_in_hour"))


@register("hour_totals", oracle.build(["hour_total"], f"""
select workspace_id, warehouse_id, hour_start, {o4('total_work_ms_in_hour')} from hour_total"""))
def q_hour_totals(spark, sf_dir):
    """H6: total work per billed hour key."""
    return cost.hour_totals(_shw(spark, sf_dir)).select(
        "workspace_id", "warehouse_id", "hour_start", r4("total_work_ms_in_hour")
    )


@register("attributed_hours", oracle.build(["stmt_hour_cost"], f"""
select statement_id, hour_start, {o4('work_ms_in_hour')}, {o4('cost_usd_in_hour')}, {o4('dbus_in_hour')}
from stmt_hour_cost"""))
def q_attributed_hours(spark, sf_dir):
    """H7: each statement-hour's share of the hour's bill."""
    shw = _shw(spark, sf_dir)
    rates = cost.hour_rates(cost.hour_totals(shw), _hourly(spark, sf_dir))
    return cost.attribute_hours(shw, rates).select(
        "statement_id", "hour_start", r4("work_ms_in_hour"), r4("cost_usd_in_hour"), r4("dbus_in_hour")
    )


# --------------------------------------------------------------------- H8
_QCA_SELECT = f"""select statement_id, workspace_id, executed_by, warehouse_id, dashboard_id, genie_space_id, notebook_id,
  alert_id, job_id, client_application, start_time, end_time, work_ms,
  {o4('attributed_cost_usd')}, {o4('attributed_dbus')}
from stmt_cost"""


@register("query_cost_attribution", oracle.build(["stmt_cost"], _QCA_SELECT))
def q_query_cost_attribution(spark, sf_dir):
    """H8: per-statement attributed cost and DBUs (flagship)."""
    return cost_attribution(spark, sf_dir).select(*QCA_OUT, r4("attributed_cost_usd"), r4("attributed_dbus"))


@register("query_cost_attribution_30d", oracle.build(["stmt_cost"], _QCA_SELECT, cutoff=oracle.CUTOFF_30))
def q_query_cost_attribution_30d(spark, sf_dir):
    """H8 + D4/R8 with a 30-day window: statements and bills before the
    cutoff are excluded; the hours they shared are billed to the rest."""
    return cost_attribution(spark, sf_dir, window_days=fx.USAGE_WINDOW_DAYS).select(
        *QCA_OUT, r4("attributed_cost_usd"), r4("attributed_dbus"))


@register("query_cost_attribution_split_hours", oracle.build(["stmt_cost"], _QCA_SELECT))
def q_query_cost_attribution_split_hours(spark, sf_dir):
    """H8/E4 for hour-rate tables too large to broadcast: the statement-hours shuffle to the rates,
    warehouse-hours that their statement counts show to be heavy split into buckets."""
    qca = cost.query_cost_attribution(fx.query_history(spark, sf_dir), fx.usage(spark, sf_dir), _prices(spark, sf_dir),
                                      fx.AS_OF, fx.WINDOW_DAYS, max_broadcast_rows=0)
    return qca.select(*QCA_OUT, r4("attributed_cost_usd"), r4("attributed_dbus"))


# ------------------------------------------------------------------ H9-H13
def _dashboards(spark, sf_dir):
    return fx.dashboard_current(spark, sf_dir).withColumn("owner", owner_from_path("parent_path"))


_O_DASH = ("fx_dashboard_current_o", """select *, case when parent_path like '/Users/%' then split_part(parent_path, '/', 3) end as owner
from fx_dashboard_current""")


def _facts(key: str) -> str:
    """Statement facts per ``key``, aggregated before any dimension is joined."""
    return f"""facts as (
  select {key} as k, count(*) as n, sum(attributed_cost_usd) as usd, sum(attributed_dbus) as units,
    avg(attributed_cost_usd) as mean_usd, count(distinct executed_by) as people,
    count(distinct dashboard_id) as boards, count(distinct genie_space_id) as spaces, max(end_time) as latest
  from stmt_cost where {key} is not null group by {key})"""


def _or0(x: str) -> str:
    return f"coalesce({x}, 0)"


_FACT_COLUMNS = f"{_or0('n')} as statements, {on(_or0('usd'), 4, 'cost_usd')}, {on(_or0('units'), 4, 'dbus')}"


@register("dashboard_cost", oracle.build(["stmt_cost", "fx_dashboard_current"], f"""
with {_facts('dashboard_id')}
select dashboard_id, display_name as dashboard_name, owner, warehouse_id as configured_warehouse_id,
  {_FACT_COLUMNS}, {on(_or0('mean_usd'), 4, 'avg_cost_per_statement_usd')}, latest as last_statement_at
from fx_dashboard_current_o left join facts on k = dashboard_id""", extra=[_O_DASH]))
def q_dashboard_cost(spark, sf_dir):
    """H9: cost roll-up per dashboard (unused dashboards keep a zero row)."""
    out = rollups.dashboard_cost(_dashboards(spark, sf_dir), cost_attribution(spark, sf_dir))
    return out.select(
        "dashboard_id", "dashboard_name", "owner", "configured_warehouse_id", "statements",
        r4("cost_usd"), r4("dbus"), r4("avg_cost_per_statement_usd"), "last_statement_at",
    )


@register("space_cost", oracle.build(["stmt_cost", "fx_space_current"], f"""
with {_facts('genie_space_id')}
select space_id, title as genie_space_title, warehouse_id as configured_warehouse_id, creator_id,
  {_FACT_COLUMNS}, {on(_or0('mean_usd'), 4, 'avg_cost_per_statement_usd')}, {_or0('people')} as unique_users,
  latest as last_statement_at
from fx_space_current left join facts on k = space_id"""))
def q_space_cost(spark, sf_dir):
    """Cost roll-up per conversational space with distinct users."""
    out = rollups.space_cost(fx.space_current(spark, sf_dir), cost_attribution(spark, sf_dir))
    return out.select(
        "space_id", "genie_space_title", "configured_warehouse_id", "creator_id", "statements",
        r4("cost_usd"), r4("dbus"), r4("avg_cost_per_statement_usd"), "unique_users", "last_statement_at",
    )


@register("warehouse_cost", oracle.build(["stmt_cost", "fx_warehouse_current"], f"""
with {_facts('warehouse_id')}
select id as warehouse_id, name as warehouse_name, cluster_size, warehouse_type, enable_serverless_compute,
  {_FACT_COLUMNS}, {_or0('people')} as unique_users, {_or0('boards')} as dashboards_touched,
  {_or0('spaces')} as genie_spaces_touched, latest as last_statement_at
from fx_warehouse_current left join facts on k = id"""))
def q_warehouse_cost(spark, sf_dir):
    """Cost roll-up per warehouse with distinct users/dashboards/spaces."""
    out = rollups.warehouse_cost(fx.warehouse_current(spark, sf_dir), cost_attribution(spark, sf_dir))
    return out.select(
        "warehouse_id", "warehouse_name", "cluster_size", "warehouse_type", "enable_serverless_compute",
        "statements", r4("cost_usd"), r4("dbus"), "unique_users", "dashboards_touched", "genie_spaces_touched",
        "last_statement_at",
    )


# The source labels, first match first.
_SOURCES = {
    "dashboard": "dashboard_id", "genie_space": "genie_space_id", "notebook": "notebook_id",
    "alert": "alert_id", "job": "job_id",
}
_SOURCE_LABEL = "coalesce(" + ", ".join(f"if({c} is null, null, '{v}')" for v, c in _SOURCES.items()) + ", 'other / direct')"


@register("cost_by_source_type", oracle.build(["stmt_cost"], f"""
with labelled as (select {_SOURCE_LABEL} as source_type, attributed_cost_usd as usd from stmt_cost),
whole as (select sum(usd) as all_usd from labelled)
select source_type, count(*) as statements, {on('sum(usd)', 2, 'cost_usd')},
  {on('sum(usd) * 100.0 / any_value(all_usd)', 2, 'pct_of_total')}
from labelled, whole group by source_type"""))
def q_cost_by_source_type(spark, sf_dir):
    """H13 + J7: statements and cost per source type, percent of total."""
    out = rollups.cost_by_source_type(cost_attribution(spark, sf_dir))
    return out.select("source_type", "statements", rn("cost_usd", 2), rn("pct_of_total", 2))


# --------------------------------------------------------------------- H12
def _viewed(action: str, name: str) -> str:
    return (f"count(*) filter (action_name = '{action}') as {name}_l30d, "
            f"count(distinct email) filter (action_name = '{action}') as {name}_users_l30d")


# The audit log's action names.
_O_VIEWS = ("dashboard_views", f"""
with seen as (
  select dashboard_id, action_name, email from fx_audit
  where event_date >= {oracle.CUTOFF_30} and dashboard_id is not null)
select dashboard_id, {_viewed('getPublishedDashboard', 'published')}, {_viewed('getDashboard', 'draft')}
from seen where action_name = 'getPublishedDashboard' or action_name = 'getDashboard' group by dashboard_id""")
_O_LOAD = ("dashboard_load", f"""
select dashboard_id as board, count(statement_id) as n, sum(total_task_duration_ms)::bigint as task_ms
from fx_query_history where dashboard_id is not null and start_time >= {oracle.CUTOFF_30} group by all""")


@register("dashboard_usage_30d", oracle.build(["fx_audit"], "select * from dashboard_views", extra=[_O_VIEWS]))
def q_dashboard_usage_30d(spark, sf_dir):
    """H12 part: 30-day published/draft views and distinct viewers."""
    return usage.dashboard_views(fx.audit(spark, sf_dir), fx.AS_OF, fx.USAGE_WINDOW_DAYS)


@register("dashboard_denormalized", oracle.build(["fx_audit", "fx_query_history", "fx_dashboard_current"], f"""
select d.*, {_or0('task_ms')} as total_task_duration_l30d, {_or0('n')} as count_queries_l30d,
  v.* exclude (dashboard_id)
from fx_dashboard_current_o d left join dashboard_load on board = d.dashboard_id
  left join dashboard_views v on v.dashboard_id = d.dashboard_id""", extra=[_O_DASH, _O_VIEWS, _O_LOAD]))
def q_dashboard_denormalized(spark, sf_dir):
    """Current dashboards + 30-day load + views (struct flattened)."""
    out = usage.dashboard_denormalized(
        _dashboards(spark, sf_dir), fx.audit(spark, sf_dir), fx.query_history(spark, sf_dir),
        fx.AS_OF, fx.USAGE_WINDOW_DAYS,
    )
    return out.select(
        *[c for c in out.columns if c != "views"], *[F.col(f"views.{f}").alias(f) for f in usage.VIEW_FIELDS]
    )


# ------------------------------------------------------------------ J1-J8
_O_RAW_HOURLY = ("raw_hourly", "select * from bill_by_hour")


@register("check_rowcount", oracle.build(["stmt_cost"],
                                         "select count(*) as statements_attributed from stmt_cost"))
def q_check_rowcount(spark, sf_dir):
    """Attributed statements (> 0 expected)."""
    return quality.check_rowcount(cost_attribution(spark, sf_dir))


@register("check_variance", oracle.build(["stmt_cost", "bill_by_hour"], f"""
with sums(mv, billed) as (
  select (select sum(attributed_cost_usd) from stmt_cost), (select sum(list_cost_usd) from bill_by_hour))
select {on('mv', 4, 'mv_total_usd')}, {on('billed', 4, 'raw_total_usd')},
  {on('abs(mv - billed) / nullif(billed, 0)', 6, 'variance_pct')}  -- fixed value: the rule of the check
from sums"""))
def q_check_variance(spark, sf_dir):
    """Attributed vs raw billed total and their relative gap."""
    hourly = _written_hourly(spark, sf_dir)
    out = quality.check_variance(cost_attribution(spark, sf_dir, hourly=hourly), hourly)
    return out.select(r4("mv_total_usd"), r4("raw_total_usd"), rn("variance_pct", 6))


@register("check_bad_cost", oracle.build(["stmt_cost"], """
select count(*) as bad_rows from stmt_cost where attributed_cost_usd < 0 or attributed_cost_usd is null"""))
def q_check_bad_cost(spark, sf_dir):
    """Negative or NULL attributed cost (0 expected)."""
    return quality.check_bad_cost(cost_attribution(spark, sf_dir))


@register("check_hour_overattributed", oracle.build(["stmt_cost", "bill_by_hour"], """
with spent as (
  select workspace_id as ws, warehouse_id as wh, date_trunc('hour', start_time) as h, sum(attributed_cost_usd) as usd from stmt_cost group by all)
select count(*) as hours_overattributed
from bill_by_hour join spent on ws = workspace_id and wh = warehouse_id and h = hour_start
where usd > list_cost_usd * 1.01  -- fixed value: the rule of the check"""))
def q_check_hour_overattributed(spark, sf_dir):
    """Hours whose start-hour-booked attribution exceeds the bill by > 1 %."""
    hourly = _written_hourly(spark, sf_dir)
    return quality.check_hour_overattributed(cost_attribution(spark, sf_dir, hourly=hourly), hourly)


@register("check_hour_overattributed_exact", oracle.build(["stmt_hour_cost", "bill_by_hour"], """
with spent as (
  select workspace_id as ws, warehouse_id as wh, hour_start as h, sum(cost_usd_in_hour) as usd from stmt_hour_cost group by all)
select count(*) as hours_overattributed
from bill_by_hour join spent on ws = workspace_id and wh = warehouse_id and h = hour_start
where usd > list_cost_usd * 1.01  -- fixed value: the rule of the check"""))
def q_check_hour_overattributed_exact(spark, sf_dir):
    """J4 exact (R9): per-hour split compared hour by hour (0 expected)."""
    shw = _shw(spark, sf_dir)
    hourly = _written_hourly(spark, sf_dir)
    att = cost.attribute_hours(shw, cost.hour_rates(cost.hour_totals(shw), hourly))
    return quality.check_hour_overattributed_exact(att, hourly)


@register("top_dashboards", oracle.build(["stmt_cost", "fx_dashboard_current"], f"""
with {_facts('dashboard_id')}
select display_name as dashboard_name, owner, n as statements, {on('usd', 4, 'cost_usd')}, {on('units', 4, 'dbus')}
from facts join fx_dashboard_current_o on k = dashboard_id
where usd > 0 order by usd desc, dashboard_id limit 10""", extra=[_O_DASH]))
def q_top_dashboards(spark, sf_dir):
    """Ten most expensive dashboards."""
    dc = rollups.dashboard_cost(_dashboards(spark, sf_dir), cost_attribution(spark, sf_dir))
    return quality.top_dashboards(dc).select("dashboard_name", "owner", "statements", r4("cost_usd"), r4("dbus"))


@register("top_spaces", oracle.build(["stmt_cost", "fx_space_current"], f"""
with {_facts('genie_space_id')}
select title as genie_space_title, creator_id, n as statements, {on('usd', 4, 'cost_usd')}, people as unique_users
from facts join fx_space_current on k = space_id where usd > 0 order by usd desc, space_id limit 10"""))
def q_top_spaces(spark, sf_dir):
    """Ten most expensive spaces."""
    sc = rollups.space_cost(fx.space_current(spark, sf_dir), cost_attribution(spark, sf_dir))
    return quality.top_spaces(sc).select("genie_space_title", "creator_id", "statements", r4("cost_usd"), "unique_users")


@register("check_unbilled", oracle.build(["stmt_cost"], f"""
with marked as (select coalesce(attributed_cost_usd, 0) = 0 as free from stmt_cost)
select count(*) filter (free) as unbilled_statements, {on('avg(free::int) * 100', 2, 'unbilled_pct')} from marked"""))
def q_check_unbilled(spark, sf_dir):
    """Statements without a billed hour, count and percent."""
    return quality.check_unbilled(cost_attribution(spark, sf_dir)).select("unbilled_statements", rn("unbilled_pct", 2))


def _all_checks_sql() -> str:
    """The eight checks' own queries, one row per item."""
    ordered = "(select * from ({}) q)"
    parts = [
        "select 'rowcount' as check_name, 'statements_attributed' as item, cast(count(*) as double) as value from stmt_cost",
        "select 'variance', 'mv_total_usd', sum(attributed_cost_usd) from stmt_cost",
        "select 'variance', 'raw_total_usd', sum(list_cost_usd) from bill_by_hour",
        "select 'variance', 'variance_pct', abs(mv - billed) / nullif(billed, 0) from (select (select sum(attributed_cost_usd) from stmt_cost) as mv, (select sum(list_cost_usd) from bill_by_hour) as billed)",
        "select 'bad_cost', 'bad_rows', count(*) from stmt_cost where attributed_cost_usd < 0 or attributed_cost_usd is null",
        "select 'unbilled', 'unbilled_statements', count(*) from stmt_cost where coalesce(attributed_cost_usd, 0) = 0",
        "select 'unbilled', 'unbilled_pct', avg((coalesce(attributed_cost_usd, 0) = 0)::int) * 100 from stmt_cost",
        "select 'hour_overattributed', 'hours_overattributed', count(*) from bill_by_hour join (select workspace_id as ws, warehouse_id as wh, "
        "date_trunc('hour', start_time) as h, sum(attributed_cost_usd) as usd from stmt_cost group by all) on ws = workspace_id and wh = warehouse_id "
        "and h = hour_start where usd > list_cost_usd * 1.01",
        ordered.format("select 'top_dashboards', display_name, usd from (select dashboard_id as k, sum(attributed_cost_usd) as usd from stmt_cost "
                       "group by 1) join fx_dashboard_current on k = dashboard_id where usd > 0 order by usd desc, k limit 10"),
        ordered.format("select 'top_spaces', title, usd from (select genie_space_id as k, sum(attributed_cost_usd) as usd from stmt_cost "
                       "group by 1) join fx_space_current on k = space_id where usd > 0 order by usd desc, k limit 10"),
        f"select 'coverage', source_type, sum(usd) * 100.0 / any_value(all_usd) from (select {_SOURCE_LABEL} as source_type, attributed_cost_usd as usd, "
        "sum(attributed_cost_usd) over () as all_usd from stmt_cost) group by source_type",
    ]
    return f"select check_name, item, {on('value', 2)} from (" + "\nunion all\n".join(parts) + ") a"


@register("checks_all", oracle.build(["stmt_cost", "bill_by_hour", "fx_dashboard_current", "fx_space_current"], _all_checks_sql()))
def q_checks_all(spark, sf_dir):
    """J1-J8 in one evaluation of the cost chain: observed while the cost table is written, the
    rest read from it; the bill is computed once."""
    hourly = _written_hourly(spark, sf_dir)
    out = quality.write_checked(cost_attribution(spark, sf_dir, hourly=hourly), hourly, _dashboards(spark, sf_dir),
                                fx.space_current(spark, sf_dir), _history_folder(spark, "checked-costs"))
    return out.select("check_name", "item", rn("value", 2))


# ------------------------------------------------------------------ C1-C6
SNAP_KEYS = ["object_id"]
SNAP_TRACKED = ["segment", "balance"]
SNAP_VERSIONS = (1, 2, 3)

_O_ISLANDS = ("scd2_history", """
with vers as (
  select version, lag(version) over (order by version) as prev_version, lead(version) over (order by version) as next_version
  from (select distinct version from fx_snapshots) d),
marked as (
  select s.*, v.prev_version, v.next_version,
    lag(s.version) over (partition by s.object_id order by s.version) as pv,
    lag(s.segment) over (partition by s.object_id order by s.version) as p_segment,
    lag(s.balance) over (partition by s.object_id order by s.version) as p_balance
  from fx_snapshots s join vers v on s.version = v.version),
flagged as (
  select *, case when pv is null or pv is distinct from prev_version
      or segment is distinct from p_segment or balance is distinct from p_balance then 1 else 0 end as is_new
  from marked),
runs as (
  select *, sum(is_new) over (partition by object_id order by version rows between unbounded preceding and current row) as run_id
  from flagged)
select object_id, min(segment) as segment, min(balance) as balance, arg_max_null(payload, version) as payload,
  cast(min(version) as bigint) as __START_AT, cast(arg_max_null(next_version, version) as bigint) as __END_AT
from runs group by object_id, run_id""")


def _snapshots(spark, sf_dir):
    return fx.snapshots(spark, sf_dir)


@register("scd2_backfill", oracle.build(["fx_snapshots"], "select * from scd2_history", extra=[_O_ISLANDS]))
def q_scd2_backfill(spark, sf_dir):
    """Full SCD2 history from all snapshots at once (gaps and islands)."""
    return scd2.backfill(_snapshots(spark, sf_dir), SNAP_KEYS, SNAP_TRACKED)


def incremental_history(spark, sf_dir):
    """Apply the snapshots one at a time to a stored history (in the shared
    checkpoint folder): each version writes its closed rows and open set."""
    import uuid as _uuid

    from spendscope.session import ensure_checkpoint_dir

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/spendscope/scd2-{_uuid.uuid4().hex}"
    store = scd2.HistoryStore(spark, root, SNAP_KEYS, SNAP_TRACKED)
    snaps = _snapshots(spark, sf_dir)
    for v in SNAP_VERSIONS:
        store.apply(snaps.where(F.col("version") == v).drop("version"), v)
    return store.read()


@register("scd2_incremental", oracle.build(["fx_snapshots"], "select * from scd2_history", extra=[_O_ISLANDS]))
def q_scd2_incremental(spark, sf_dir):
    """The same history, built by applying one snapshot at a time."""
    return incremental_history(spark, sf_dir)


@register("scd2_current", oracle.build(["fx_snapshots"], """
select object_id, segment, balance, payload from scd2_history where __END_AT is null""", extra=[_O_ISLANDS]))
def q_scd2_current(spark, sf_dir):
    """C4: open rows of the history."""
    return scd2.current(scd2.backfill(_snapshots(spark, sf_dir), SNAP_KEYS, SNAP_TRACKED))


@register("scd2_as_of", oracle.build(["fx_snapshots"], """
select object_id, segment, balance, payload from scd2_history
where __START_AT <= 2 and (__END_AT is null or __END_AT > 2)""", extra=[_O_ISLANDS]))
def q_scd2_as_of(spark, sf_dir):
    """The inventory as it was at snapshot version 2."""
    return scd2.as_of(scd2.backfill(_snapshots(spark, sf_dir), SNAP_KEYS, SNAP_TRACKED), 2)


# ------------------------------------------------------------------ B1-B12
_BUCKET_BY_MOD = """case {m} when 0 then 'minutely' when 1 then 'hourly' when 2 then 'daily' when 3 then 'weekly'
  when 4 then 'monthly' when 5 then 'yearly' when 6 then 'custom' when 7 then 'custom' else 'unknown' end"""


@register("cron_frequency", oracle.build(["fx_schedules"], f"""
select concat('sc', cast(event_id as varchar)) as schedule_id,
  case event_id % 10 when 0 then '0 * * * * ?' when 1 then '0 */5 * * * ?' when 2 then '0 0 9 * * ?'
    when 3 then '0 0 9 ? * MON' when 4 then '0 0 9 1 * ?' when 5 then '0 0 9 1 1 ?' when 6 then '0 9 * * *'
    when 7 then '0 0 9 1 1 MON' when 8 then '' end as quartz_cron_expression,
  {_BUCKET_BY_MOD.format(m='event_id % 10')} as frequency
from events"""))
def q_cron_frequency(spark, sf_dir):
    """Quartz cron expression → frequency bucket."""
    return N.with_cron_frequency(fx.schedules(spark, sf_dir), "quartz_cron_expression").select(
        "schedule_id", "quartz_cron_expression", "frequency"
    )


def _bucket_counts_sql(key: str, mod: str, table: str) -> str:
    parts = ", ".join(
        f"cast(sum(case when {_BUCKET_BY_MOD.format(m=mod)} = '{b}' then 1 else 0 end) as integer) "
        f"as schedule_frequency_{b}"
        for b in N.FREQ_BUCKETS
    )
    return f"select {key} as dashboard_id, cast(count(*) as integer) as schedule_count, {parts} from {table} group by 1"


@register("schedule_frequency_counts", _bucket_counts_sql("concat('d', cast(user_id % 10 as varchar))", "event_id % 10", "events"))
def q_schedule_frequency_counts(spark, sf_dir):
    """Schedules per dashboard and per frequency bucket."""
    return normalize.schedule_frequency_counts(fx.schedules(spark, sf_dir))


@register("schedule_object_frequency_counts", _bucket_counts_sql("'d' || cast(o_custkey as varchar)", "o_orderkey % 10", "orders"))
def q_schedule_object_frequency_counts(spark, sf_dir):
    """Bucket counts of schedules in the API's own shape (cron text inside cron_schedule)."""
    return normalize.schedule_frequency_counts(fx.raw_schedule_objects(spark, sf_dir))


_O_DASH_EXPECTED = ("dash_expected", """
select 'd' || cast(c_custkey as varchar) as dashboard_id,
  case when c_custkey % 3 = 0 then make_timestamp(cast((1700000000 + c_custkey) * 1000000 as bigint))
       else make_timestamp(cast((1700000000000 + c_custkey * 1000) * 1000 as bigint)) end as create_time,
  c_name || case when c_custkey % 50 = 1 then ' é 日本 😀' else '' end as display_name, cast(c_custkey * 7 as varchar) as etag,
  case when c_acctbal < 0 then 'TRASHED' else 'ACTIVE' end as lifecycle_state,
  case c_custkey % 4 when 0 then '/Users/' || lower(c_mktsegment) || '@x.org/team' when 1 then '/Users/'
    when 2 then '/Shared/reports' end as parent_path,
  coalesce(case c_custkey % 4 when 0 then '/Users/' || lower(c_mktsegment) || '@x.org/team' when 1 then '/Users/'
    when 2 then '/Shared/reports' end, '') || '/dash' || cast(c_custkey as varchar) || '.lvdash.json' as path,
  'w' || cast(c_nationkey % 4 as varchar) as warehouse_id,
  case c_custkey % 4 when 0 then lower(c_mktsegment) || '@x.org' when 1 then '' end as owner,
  case when c_custkey % 5 in (0, 1) then timestamp '2024-01-01 10:00:00' + to_days(cast(c_custkey % 28 as integer))
       when c_custkey % 5 = 4 then timestamp '2024-01-01 10:00:00.25' + to_days(cast(c_custkey % 28 as integer)) end
    as update_time
from customer""")


@register("owner_from_path", oracle.build([], "select dashboard_id, parent_path, owner from dash_expected",
                                          extra=[_O_DASH_EXPECTED]))
def q_owner_from_path(spark, sf_dir):
    """Owner from a /Users/<owner>/... workspace path."""
    rows = normalize.dashboard_rows(fx.raw_dashboards(spark, sf_dir))
    return rows.select("dashboard_id", "parent_path", "owner")


@register("coerce_timestamp", oracle.build([], "select dashboard_id, create_time, update_time from dash_expected",
                                           extra=[_O_DASH_EXPECTED]))
def q_coerce_timestamp(spark, sf_dir):
    """B1: epoch seconds/ms and ISO text (zone dropped, blank/bad → NULL)."""
    rows = normalize.dashboard_rows(fx.raw_dashboards(spark, sf_dir))
    return rows.select("dashboard_id", "create_time", "update_time")


@register("canonical_json_sha256", """
select event_id, '{"k":' || cast(cast(regexp_extract(props, '([0-9]+)', 1) as integer) as varchar) || '}' as canonical_json,
  sha256('{"k":' || cast(cast(regexp_extract(props, '([0-9]+)', 1) as integer) as varchar) || '}') as json_sha256
from events""")
def q_canonical_json_sha256(spark, sf_dir):
    """Canonical (key-sorted, compact) JSON text and its SHA-256."""
    ev = fx.table(spark, sf_dir, "events")
    canon = N.canonical_json("props")
    return ev.select("event_id", canon.alias("canonical_json"), N.sha256_hex(canon).alias("json_sha256"))


_DASH_PLAIN = [c for c in normalize.DASHBOARD_COLUMNS if "json" not in c and c != "serialized_dashboard"]


@register("dashboard_rows", oracle.build([], f"""
with sched as ({_bucket_counts_sql("'d' || cast(o_custkey as varchar)", "o_orderkey % 10", "orders")})
select e.*, sha256('{{"pages":[{{"name":"p' || substr(e.dashboard_id, 2) || '"}}]}}') as serialized_dashboard_sha256,
  coalesce(s.schedule_count, 0) as schedule_count,
  {", ".join(f"coalesce(s.schedule_frequency_{b}, 0) as schedule_frequency_{b}" for b in N.FREQ_BUCKETS)}
from dash_expected e left join sched s on e.dashboard_id = s.dashboard_id""", extra=[_O_DASH_EXPECTED]))
def q_dashboard_rows(spark, sf_dir):
    """Normalized dashboard rows (JSON/hash columns are in
    ``dashboard_snapshot_rows``)."""
    rows = normalize.dashboard_rows(fx.raw_dashboards(spark, sf_dir), fx.raw_schedules(spark, sf_dir))
    return rows.select(*_DASH_PLAIN)


_O_DASH_JSON = """'{"create_time":' || cast(case when c_custkey % 3 = 0 then 1700000000 + c_custkey
      else 1700000000000 + c_custkey * 1000 end as varchar)
  || ',"dashboard_id":' || to_json('d' || cast(c_custkey as varchar))
  || ',"display_name":"' || c_name || case when c_custkey % 50 = 1 then ' \\u00e9 \\u65e5\\u672c \\ud83d\\ude00' else '' end || '"'
  || ',"etag":' || to_json(cast(c_custkey * 7 as varchar))
  || ',"lifecycle_state":' || case when c_acctbal < 0 then '"TRASHED"' else '"ACTIVE"' end
  || coalesce(',"parent_path":' || to_json(case c_custkey % 4 when 0 then '/Users/' || lower(c_mktsegment) || '@x.org/team'
       when 1 then '/Users/' when 2 then '/Shared/reports' end), '')
  || ',"path":' || to_json(coalesce(case c_custkey % 4 when 0 then '/Users/' || lower(c_mktsegment) || '@x.org/team'
       when 1 then '/Users/' when 2 then '/Shared/reports' end, '') || '/dash' || cast(c_custkey as varchar) || '.lvdash.json')
  || ',"update_time":' || to_json(case c_custkey % 5
       when 0 then '2024-01-' || lpad(cast(1 + c_custkey % 28 as varchar), 2, '0') || 'T10:00:00Z'
       when 1 then '2024-01-' || lpad(cast(1 + c_custkey % 28 as varchar), 2, '0') || 'T10:00:00+02:00'
       when 2 then '' when 3 then 'not a time'
       else '2024-01-' || lpad(cast(1 + c_custkey % 28 as varchar), 2, '0') || ' 10:00:00.250' end)
  || ',"warehouse_id":' || to_json('w' || cast(c_nationkey % 4 as varchar)) || '}'"""
_O_SCHEDULE_JSON = f"""'{{"cron_schedule":{{"human_schedule":"' || {_BUCKET_BY_MOD.format(m='o_orderkey % 10')} || '"'
  || coalesce(',"quartz_cron_expression":' || to_json(case o_orderkey % 10 when 0 then '0 * * * * ?'
       when 1 then '0 */5 * * * ?' when 2 then '0 0 9 * * ?' when 3 then '0 0 9 ? * MON' when 4 then '0 0 9 1 * ?'
       when 5 then '0 0 9 1 1 ?' when 6 then '0 9 * * *' when 7 then '0 0 9 1 1 MON' when 8 then '' end), '')
  || ',"timezone_id":"UTC"}},"display_name":' || to_json('S' || cast(o_orderkey as varchar))
  || ',"pause_status":' || case when o_orderkey % 3 = 0 then '"PAUSED"' else '"UNPAUSED"' end
  || ',"schedule_id":' || to_json('sc' || cast(o_orderkey as varchar)) || '}}'"""


@register("dashboard_snapshot_rows", oracle.build([], f"""
with sched as (
  {_bucket_counts_sql("'d' || cast(o_custkey as varchar)", "o_orderkey % 10", "orders")}),
sched_json as (
  select 'd' || cast(o_custkey as varchar) as dashboard_id,
    '[' || string_agg({_O_SCHEDULE_JSON}, ',' order by 'sc' || cast(o_orderkey as varchar), 'S' || cast(o_orderkey as varchar)) || ']'
      as schedules_json
  from orders group by 1),
meta as (
  select 'd' || cast(c_custkey as varchar) as dashboard_id, {_O_DASH_JSON} as dashboard_metadata_json,
    '{{"pages":[{{"name":"p' || cast(c_custkey as varchar) || '"}}]}}' as serialized_dashboard
  from customer)
select e.*, m.dashboard_metadata_json, sha256(m.dashboard_metadata_json) as dashboard_metadata_json_sha256,
  m.serialized_dashboard, sha256(m.serialized_dashboard) as serialized_dashboard_sha256,
  j.schedules_json, sha256(j.schedules_json) as schedules_json_sha256,
  coalesce(s.schedule_count, 0) as schedule_count,
  {", ".join(f"coalesce(s.schedule_frequency_{b}, 0) as schedule_frequency_{b}" for b in N.FREQ_BUCKETS)}
from dash_expected e
join meta m on e.dashboard_id = m.dashboard_id
left join sched s on e.dashboard_id = s.dashboard_id
left join sched_json j on e.dashboard_id = j.dashboard_id""", extra=[_O_DASH_EXPECTED]))
def q_dashboard_snapshot_rows(spark, sf_dir):
    """All 25 snapshot columns incl. canonical JSON and hashes; schedules as the API gives
    them, the cron text inside their cron_schedule."""
    return normalize.dashboard_rows(fx.raw_dashboards(spark, sf_dir), fx.raw_schedule_objects(spark, sf_dir))


@register("space_counts", """
select 'g' || cast(p_partkey as varchar) as space_id, p_name as title, p_type as description,
  'w' || cast(p_partkey % 4 as varchar) as warehouse_id,
  case when p_partkey % 7 = 0 then null else cast(p_partkey % 7 as varchar) end as creator_id,
  make_timestamp(cast((1700000000 + p_partkey) * 1000000 as bigint)) as create_time,
  timestamp '2024-02-01 00:00:00' as update_time,
  cast(case when p_partkey % 11 = 0 then 0 else p_partkey % 4 end as integer) as table_count,
  cast(case when p_partkey % 11 = 0 then 0 when p_partkey % 5 = 0 then 2 when p_partkey % 5 = 1 then 1 else 0 end as integer)
    as instruction_count,
  cast(case when p_partkey % 11 = 0 then 0 else p_partkey % 3 end as integer) as sample_question_count,
  cast(case when p_partkey % 11 = 0 then 0 when p_partkey % 2 = 0 then 1 else 0 end as integer) as curated_question_count
from part""")
def q_space_counts(spark, sf_dir):
    """Space rows with counts parsed from the nested serialized JSON."""
    rows = normalize.space_rows(fx.raw_spaces(spark, sf_dir))
    return rows.select(*[c for c in normalize.SPACE_COLUMNS if "json" not in c])


_O_SPACE_TEXT = """case when p_partkey % 11 = 0 then '{bad json' else
  '{"config":{"sample_questions":' || to_json(list_transform(range(p_partkey % 3), lambda x: 'q'))
  || case when p_partkey % 2 = 0 then ',"curated_questions":["c"]' else '' end
  || '},"data_sources":{"tables":' || to_json(list_transform(range(p_partkey % 4), lambda x: 't'))
  || '},"instructions":' || case p_partkey % 5 when 0 then '["a","b"]' when 1 then '{"text":"x"}' when 2 then '"x"'
       when 3 then '7' else 'null' end || '}' end"""
_O_SPACE_JSON = f"""'{{"create_time":' || cast(1700000000 + p_partkey as varchar)
  || ',"creator_id":' || cast(p_partkey % 7 as varchar)
  || ',"description":' || to_json(p_type)
  || ',"serialized_space":' || to_json({_O_SPACE_TEXT})
  || ',"space_id":' || to_json('g' || cast(p_partkey as varchar))
  || ',"title":' || to_json(p_name)
  || ',"update_time":"2024-02-01T00:00:00Z"'
  || ',"warehouse_id":' || to_json('w' || cast(p_partkey % 4 as varchar)) || '}}'"""


@register("space_snapshot_rows", f"""
select s.*, j.space_metadata_json, sha256(j.space_metadata_json) as space_metadata_json_sha256
from ({ORACLE["space_counts"]}) s
join (select 'g' || cast(p_partkey as varchar) as space_id, {_O_SPACE_JSON} as space_metadata_json from part) j
  on s.space_id = j.space_id""")
def q_space_snapshot_rows(spark, sf_dir):
    """All 13 space columns incl. canonical JSON and hash."""
    return normalize.space_rows(fx.raw_spaces(spark, sf_dir))


@register("warehouse_rows", """
select 'w' || cast(s_suppkey as varchar) as id, s_name as name,
  case when s_suppkey % 2 = 0 then 'RUNNING' else 'STOPPED' end as state, 'PRO' as warehouse_type,
  case s_nationkey % 3 when 0 then 'Small' when 1 then 'Medium' else 'Large' end as cluster_size,
  cast(1 as integer) as min_num_clusters,
  cast(case when s_suppkey % 3 = 0 then 4 when s_suppkey % 3 = 1 then null else s_suppkey % 10 end as integer) as max_num_clusters,
  cast(10 + s_suppkey % 50 as integer) as auto_stop_mins,
  cast(case when s_suppkey % 4 <> 0 then s_suppkey % 3 end as integer) as num_clusters,
  cast(s_suppkey % 5 as integer) as num_active_sessions,
  case when s_suppkey % 2 = 0 then 'true' else 'false' end as enable_photon,
  case when s_suppkey % 3 = 0 then 'true' else 'false' end as enable_serverless_compute,
  'COST_OPTIMIZED' as spot_instance_policy,
  case s_suppkey % 3 when 0 then 'CHANNEL_NAME_CURRENT' when 1 then 'CHANNEL_NAME_PREVIEW' end as channel,
  'c' || cast(s_suppkey as varchar) as creator_name
from supplier""")
def q_warehouse_rows(spark, sf_dir):
    """Warehouse rows: safe ints, text flags, channel name."""
    rows = normalize.warehouse_rows(fx.raw_warehouses(spark, sf_dir))
    return rows.select(*[c for c in normalize.WAREHOUSE_COLUMNS if "json" not in c])


_O_WAREHOUSE_JSON = """'{"auto_stop_mins":' || cast(10 + s_suppkey % 50 as varchar)
  || case s_suppkey % 3 when 0 then ',"channel":{"name":"CHANNEL_NAME_CURRENT"}' when 1 then ',"channel":"CHANNEL_NAME_PREVIEW"' else '' end
  || ',"cluster_size":' || case s_nationkey % 3 when 0 then '"Small"' when 1 then '"Medium"' else '"Large"' end
  || ',"creator_name":' || to_json('c' || cast(s_suppkey as varchar))
  || ',"enable_photon":' || case when s_suppkey % 2 = 0 then 'true' else 'false' end
  || ',"enable_serverless_compute":' || case when s_suppkey % 3 = 0 then 'true' else 'false' end
  || ',"id":' || to_json('w' || cast(s_suppkey as varchar))
  || ',"max_num_clusters":' || case s_suppkey % 3 when 0 then '"4"' when 1 then '"many"' else cast(s_suppkey % 10 as varchar) end
  || ',"min_num_clusters":1'
  || ',"name":' || to_json(s_name)
  || ',"num_active_sessions":' || cast(s_suppkey % 5 as varchar)
  || case when s_suppkey % 4 <> 0 then ',"num_clusters":' || cast(s_suppkey % 3 as varchar) else '' end
  || ',"spot_instance_policy":"COST_OPTIMIZED"'
  || ',"state":' || case when s_suppkey % 2 = 0 then '"RUNNING"' else '"STOPPED"' end
  || ',"warehouse_type":"PRO"}'"""


@register("warehouse_snapshot_rows", f"""
select w.*, j.warehouse_metadata_json, sha256(j.warehouse_metadata_json) as warehouse_metadata_json_sha256
from ({ORACLE["warehouse_rows"]}) w
join (select 'w' || cast(s_suppkey as varchar) as id, {_O_WAREHOUSE_JSON} as warehouse_metadata_json from supplier) j
  on w.id = j.id""")
def q_warehouse_snapshot_rows(spark, sf_dir):
    """All 17 warehouse columns incl. canonical JSON and hash."""
    return normalize.warehouse_rows(fx.raw_warehouses(spark, sf_dir))


# ------------------------------------------------------------------ I1-I2
def sr(expr: str, digits: int = 2) -> str:
    """DuckDB twin of Spark's ``round`` on a double: HALF_UP applied to the
    shortest decimal text of the double (what Spark's BigDecimal(d) sees)."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38, 17)), {digits}) as double)"


_O_METRIC_BASE = ("metric_base", """
select *,
  try_divide_pct as wait_pct_of_total,
  duration_ms > 60000 as is_slow_query, duration_ms > 300000 as is_very_slow_query,
  spill_bytes > 0 as has_disk_spill, execution_status = 'FAILED' as is_failed,
  (compute_wait_ms > 30000 or capacity_wait_ms > 30000) as had_long_wait,
  coalesce(scan_to_output_ratio >= 1000, false) as has_poor_scan_efficiency
from (
  select *, case when duration_ms = 0 then null else cast((compute_wait_ms + capacity_wait_ms) as double) * 100 / duration_ms end
      as try_divide_pct,
    cast(read_rows as double) / cast(nullif(produced_rows, 0) as double) as scan_to_output_ratio
  from (
    select 'u' || cast(user_id as varchar) as executed_by, 'w' || cast(user_id % 4 as varchar) as warehouse_id,
      cast(ts as date) as query_date, cast(hour(ts) as integer) as query_hour, cast(dayofweek(ts) + 1 as integer) as day_of_week,
      case when event_id % 90 = 1 then 'ld' || cast(user_id % 4 as varchar) end as legacy_dashboard_id,
      case when event_id % 90 = 2 then 'pl' || cast(user_id % 5 as varchar) end as pipeline_id,
      case when event_id % 90 = 3 then 'sq' || cast(user_id % 6 as varchar) end as sql_query_id,
      user_id % 3 = 0 as is_tableau,
      case event_type when 'view' then 'AI/BI Dashboard' when 'click' then 'Genie Space' when 'signup' then 'Notebook'
        when 'error' then case when k < 50 then 'Alert' else 'Job' end else 'Other' end as query_source_type,
      case when k % 10 = 0 then 'FAILED' else 'FINISHED' end as execution_status,
      k as compilation_ms, cast(floor(value * 1000) as bigint) as execution_ms, k * 10 as result_fetch_ms,
      k * 400 as compute_wait_ms, k * 400 as capacity_wait_ms,
      k + cast(floor(value * 1000) as bigint) + k * 10 + k * 400 + k * 400 as duration_ms,
      cast(floor(value * 4000) as bigint) * 100000 as read_bytes, k * 1000000 as written_bytes,
      cast(floor(value * 4000) as bigint) * 10000 as shuffle_bytes,
      case when user_id % 5 = 0 then cast(floor(value * 4000) as bigint) * 1000 else 0 end as spill_bytes,
      cast(floor(value * 1000) as bigint) * 10 as read_rows, k as produced_rows,
      floor(value * 1000) < 50 as is_cached
    from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events) e
  ) b
) c""")


def _metric_measures_sql() -> str:
    gb, tb = 1024 ** 3, 1024 ** 4

    def cnt(f):
        return f"cast(sum(case when {f} then 1 else 0 end) as bigint)"

    def rate(f):
        return sr(f"avg(case when {f} then 1.0::double else 0.0::double end) * 100")

    def pct(p):
        # linear interpolation between closest ranks, written the way Spark's
        # ``percentile`` evaluates it: (hi_rank - pos) * lo + (pos - lo_rank) * hi
        sorted_ = "list_sort(list(cast(duration_ms as double)))"
        pos = f"((cast(count(duration_ms) as double) - 1) * {p})"
        lo_r, hi_r = f"floor({pos})", f"ceil({pos})"
        lo, hi = f"{sorted_}[cast({lo_r} as bigint) + 1]", f"{sorted_}[cast({hi_r} as bigint) + 1]"
        v = f"(case when {hi_r} = {lo_r} or {lo} = {hi} then {lo} else ({hi_r} - {pos}) * {lo} + ({pos} - {lo_r}) * {hi} end)"
        return sr(f"{v} / 1000")
    items = [
        ("total_queries", "count(*)"),
        ("unique_users", "count(distinct executed_by)"),
        ("warehouses_used", "count(distinct warehouse_id)"),
        ("total_duration_sec", "cast(sum(duration_ms) as double) / 1000"),
        ("avg_duration_sec", sr("avg(duration_ms) / 1000")),
        ("max_duration_sec", sr("max(duration_ms) / 1000")),
        ("p50_duration_sec", pct(0.5)), ("p95_duration_sec", pct(0.95)), ("p99_duration_sec", pct(0.99)),
        ("total_compute_wait_sec", sr("cast(sum(compute_wait_ms) as double) / 1000")),
        ("total_capacity_wait_sec", sr("cast(sum(capacity_wait_ms) as double) / 1000")),
        ("avg_wait_pct", sr("avg(wait_pct_of_total)")),
        ("avg_compilation_sec", sr("avg(compilation_ms) / 1000")),
        ("avg_execution_sec", sr("avg(execution_ms) / 1000")),
        ("avg_result_fetch_sec", sr("avg(result_fetch_ms) / 1000")),
        ("total_read_gb", sr(f"cast(sum(read_bytes) as double) / {gb}")),
        ("total_read_tb", sr(f"cast(sum(read_bytes) as double) / {tb}", 4)),
        ("total_written_gb", sr(f"cast(sum(written_bytes) as double) / {gb}")),
        ("total_shuffle_gb", sr(f"cast(sum(shuffle_bytes) as double) / {gb}")),
        ("total_spill_gb", sr(f"cast(sum(spill_bytes) as double) / {gb}")),
        ("total_read_rows", "cast(sum(read_rows) as bigint)"),
        ("total_produced_rows", "cast(sum(produced_rows) as bigint)"),
        ("avg_scan_to_output_ratio", sr("avg(scan_to_output_ratio)")),
        ("slow_query_count", cnt("is_slow_query")), ("very_slow_query_count", cnt("is_very_slow_query")),
        ("spill_query_count", cnt("has_disk_spill")), ("cached_query_count", cnt("is_cached")),
        ("failed_query_count", cnt("is_failed")), ("long_wait_query_count", cnt("had_long_wait")),
        ("poor_scan_query_count", cnt("has_poor_scan_efficiency")),
        ("cache_hit_rate_pct", rate("is_cached")), ("failure_rate_pct", rate("is_failed")),
        ("spill_rate_pct", rate("has_disk_spill")),
    ]
    return ",\n  ".join(f"{e} as {n}" for n, e in items)


def _metric_sql(by: list[str]) -> str:
    keys = ", ".join(by)
    select = (keys + ", ") if by else ""
    group = f" group by {keys}" if by else ""
    return oracle.build([], f"select {select}{_metric_measures_sql()}\nfrom metric_base{group}", extra=[_O_METRIC_BASE])


def _metric(spark, sf_dir, by):
    base = metrics.metric_base(fx.metric_history(spark, sf_dir))
    out = metrics.QUERY_HISTORY_METRICS.query(base, by=by)
    return out.withColumn("total_duration_sec", F.col("total_duration_sec").cast("double"))


@register("metric_global", _metric_sql([]))
def q_metric_global(spark, sf_dir):
    """All 33 measures over the whole history."""
    return _metric(spark, sf_dir, [])


@register("metric_by_user", _metric_sql(["executed_by"]))
def q_metric_by_user(spark, sf_dir):
    """All 33 measures per user."""
    return _metric(spark, sf_dir, ["executed_by"])


@register("metric_by_day_source", _metric_sql(["query_date", "query_source_type"]))
def q_metric_by_day_source(spark, sf_dir):
    """All 33 measures per day and query source type."""
    return _metric(spark, sf_dir, ["query_date", "query_source_type"])


@register("metric_by_entity", _metric_sql(["legacy_dashboard_id", "pipeline_id", "sql_query_id"]))
def q_metric_by_entity(spark, sf_dir):
    """All 33 measures per legacy dashboard, pipeline and SQL query (NULL for most statements)."""
    return _metric(spark, sf_dir, ["legacy_dashboard_id", "pipeline_id", "sql_query_id"])


@register("metric_by_hour_flags", _metric_sql(["query_hour", "day_of_week", "is_slow_query", "is_cached", "is_tableau"]))
def q_metric_by_hour_flags(spark, sf_dir):
    """All 33 measures per hour of day, weekday, slow and cached flag and tool."""
    return _metric(spark, sf_dir, ["query_hour", "day_of_week", "is_slow_query", "is_cached", "is_tableau"])


_STATE_GRAINS = {"all": [], "user": ["executed_by"], "day_source": ["query_date", "query_source_type"], "day": ["query_date"]}


def _metric_grains_sql() -> str:
    parts = []
    for grain, by in _STATE_GRAINS.items():
        keys = [f"{d} as {d}" if d in by else f"cast(null as {t}) as {d}"
                for d, t in (("query_date", "date"), ("query_source_type", "varchar"), ("executed_by", "varchar"))]
        group = f" group by {', '.join('metric_base.' + d for d in by)}" if by else ""
        parts.append(f"select '{grain}' as grain, {', '.join(keys)}, {_metric_measures_sql()} from metric_base{group}")
    return oracle.build([], "\nunion all\n".join(parts), extra=[_O_METRIC_BASE])


@register("metric_rollups_from_states", _metric_grains_sql())
def q_metric_rollups_from_states(spark, sf_dir):
    """The measures at four grains from one stored aggregate: the history is read once,
    into mergeable states per day, source type and user; every grain comes from these alone."""
    dims = ["query_date", "query_source_type", "executed_by"]
    states = materialize(metrics.measure_states(metrics.metric_base(fx.metric_history(spark, sf_dir)), dims), "measure_states")
    out = None
    for grain, by in _STATE_GRAINS.items():
        rows = metrics.QUERY_HISTORY_METRICS.query_states(states, by)
        rows = rows.select(F.lit(grain).alias("grain"), *[F.col(d) if d in by else F.lit(None).cast(states.schema[d].dataType).alias(d) for d in dims],
                           *metrics.QUERY_HISTORY_METRICS.measures)
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("total_duration_sec", F.col("total_duration_sec").cast("double"))


# ------------------------------------------------------------------ A1-A8
def _landing(spark, sf_dir, name="dashboards"):
    """Land the raw dashboard objects (derived from ``customer``) as parquet
    in the shared checkpoint folder, then scan them with the data source."""
    path = landing_path(spark, sf_dir, name)
    return landing.read_landing(spark, path, parallelism=4, output_batch_size=128)


_LANDED_BY_SESSION: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _landed(spark: SparkSession) -> dict:
    """Per-session record of the landing folders written for the source queries."""
    return _LANDED_BY_SESSION.setdefault(spark, {})


def landing_path(spark, sf_dir, name="dashboards"):
    landed = _landed(spark)
    key = (sf_dir, name)
    if key not in landed:
        from spendscope.session import ensure_checkpoint_dir
        import uuid as _uuid

        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/spendscope/landing-{name}-{_uuid.uuid4().hex}"
        fx.raw_dashboards(spark, sf_dir).repartition(4).write.parquet(path)
        landed[key] = path
    return landed[key]


@register("snapshot_source_scan", "select 'd' || cast(c_custkey as varchar) as object_id, 'ok' as status from customer")
def q_snapshot_source_scan(spark, sf_dir):
    """Scan the landing folder in file-chunk partitions, Arrow batches."""
    return _landing(spark, sf_dir).select("object_id", "status")


@register("snapshot_ids", """
select object_id from (select distinct 'd' || cast(c_custkey as varchar) as object_id from customer)
order by object_id""")
def q_snapshot_ids(spark, sf_dir):
    """A4: all distinct ids, sorted."""
    return landing.snapshot_ids(_landing(spark, sf_dir))


@register("snapshot_source_by_ids", """
select 'd' || cast(c_custkey as varchar) as object_id, 'ok' as status from customer
where 'd' || cast(c_custkey as varchar) in ('d1', 'd2', 'd10', 'd999')""")
def q_snapshot_source_by_ids(spark, sf_dir):
    """A5: explicit id list, applied inside the reader."""
    path = landing_path(spark, sf_dir)
    return landing.read_landing(spark, path, parallelism=4, ids=" d1, d2 ,, d10,d999 ").select("object_id", "status")


def _landing_jsonl(spark, sf_dir):
    """The raw dashboards landed as JSON lines (one object per line) plus one
    line per nation that is not a valid object, scanned with the source."""
    landed = _landed(spark)
    key = (sf_dir, "jsonl")
    if key not in landed:
        from spendscope.session import ensure_checkpoint_dir
        import uuid as _uuid

        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/spendscope/landing-jsonl-{_uuid.uuid4().hex}"
        junk = fx.table(spark, sf_dir, "nation").select(F.concat(F.lit("{truncated "), F.col("n_name")).alias("raw_json"))
        fx.raw_dashboards(spark, sf_dir).select("raw_json").unionByName(junk).repartition(4).write.text(path)
        landed[key] = path
    return landing.read_landing(spark, landed[key], parallelism=4, fmt="jsonl", id_field="dashboard_id")


@register("snapshot_source_jsonl", """
select 'd' || cast(c_custkey as varchar) as object_id, 'ok' as status from customer
union all
select '' as object_id, 'invalid' as status from nation""")
def q_snapshot_source_jsonl(spark, sf_dir):
    """Landed JSON-lines objects scanned by the source; unparsable lines are kept as invalid."""
    return _landing_jsonl(spark, sf_dir).select("object_id", "status")


def _status_sql(kind: str) -> str:
    """Expected status of an object at version 2, by its number k."""
    return "case when k % 13 = 5 then 'invalid' when k % 10 = 2 then 'missing' else 'ok' end"


_O_NUMBERS = {"dashboard": ("d", "c_custkey", "customer"), "space": ("g", "p_partkey", "part"), "warehouse": ("w", "s_suppkey", "supplier")}


def _landed_inventory(spark, sf_dir, kind, version=2):
    """An inventory snapshot landed as parquet once per session, scanned by the data source."""
    landed, key = _landed(spark), (sf_dir, kind, version)
    if key not in landed:
        landed[key] = _history_folder(spark, f"landing-{kind}")
        fx.inventory_snapshot(spark, sf_dir, kind, version).repartition(4).write.parquet(landed[key])
    return landing.read_landing(spark, landed[key], parallelism=4, output_batch_size=128)


@register("snapshot_fetch_outcomes", " union all ".join(
    f"select '{kind}' as kind, status, count(*) as objects from (select {_status_sql(kind)} as status from (select {n} as k from {t})) group by status"
    for kind, (_, n, t) in _O_NUMBERS.items()))
def q_snapshot_fetch_outcomes(spark, sf_dir):
    """Objects per fetch outcome (ok, missing, invalid) of the three landed inventories."""
    out = None
    for kind in _O_NUMBERS:
        rows = normalize.fetch_outcomes(_landed_inventory(spark, sf_dir, kind)).select(F.lit(kind).alias("kind"), "status", "objects")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("space_source_scan", f"select 'g' || cast(k as varchar) as object_id, {_status_sql('space')} as status from (select p_partkey as k from part)")
def q_space_source_scan(spark, sf_dir):
    """A2: scan of the landed spaces with their fetch status."""
    return _landed_inventory(spark, sf_dir, "space").select("object_id", "status")


@register("warehouse_source_scan", f"select 'w' || cast(k as varchar) as object_id, {_status_sql('warehouse')} as status from (select s_suppkey as k from supplier)")
def q_warehouse_source_scan(spark, sf_dir):
    """A3: scan of the landed warehouses with their fetch status."""
    return _landed_inventory(spark, sf_dir, "warehouse").select("object_id", "status")


# Expected histories: at version 2 a failed object keeps what it was at version 1.
_VALUE_SQL = {
    "dashboard": "case when k % 7 = eff then 'v' || eff || '-' else '' end || cast(k * 7 as varchar)",
    "space": "case when k % 7 = eff then 'v' || eff || ' ' else '' end || name",
    "warehouse": "case when k % 7 = eff then 'V' || eff || '_' else '' end || case when k % 2 = 0 then 'RUNNING' else 'STOPPED' end",
}
_NAME_SQL = {"dashboard": "c_name", "space": "p_name", "warehouse": "s_name"}
_VALUE_COLUMN = {"dashboard": "etag", "space": "title", "warehouse": "state"}


def _inventory_sql(body: str) -> str:
    seen = " union all ".join(
        f"""select '{kind}' as kind, '{p}' || cast(k as varchar) as object_id, ver, {_VALUE_SQL[kind]} as val
  from (select {n} as k, {_NAME_SQL[kind]} as name, ver, case when {n} % 13 = 5 and ver = 2 then 1 else ver end as eff
        from {t}, (values (1), (2), (3)) v(ver)) where k % 10 <> eff"""
        for kind, (p, n, t) in _O_NUMBERS.items())
    return f"""with seen as ({seen}),
flagged as (
  select *, case when lag(ver) over w = ver - 1 and lag(val) over w = val then 0 else 1 end as is_new
  from seen window w as (partition by kind, object_id order by ver)),
runs as (select *, sum(is_new) over (partition by kind, object_id order by ver) as run from flagged),
inventory_history as (
  select kind, object_id, val as tracked_value, cast(min(ver) as bigint) as __START_AT,
    cast(case when max(ver) < 3 then max(ver) + 1 end as bigint) as __END_AT
  from runs group by kind, object_id, run, val)
{body}"""


def _streamed_inventory(spark, sf_dir):
    """The three inventories' snapshots, landed and streamed in two goes over one checkpoint; once per session."""
    landed, key = _landed(spark), (sf_dir, "inventory")
    if key not in landed:
        root = _history_folder(spark, "inventory")
        for versions in ((1, 2), (3,)):
            for version in versions:
                for kind in schemas.KEYS:
                    schedules = fx.raw_schedule_objects(spark, sf_dir) if kind == "dashboard" else None
                    snapshots.land(spark, f"{root}/landed", kind, version, fx.inventory_snapshot(spark, sf_dir, kind, version), schedules)
            snapshots.run_stream(spark, f"{root}/landed", f"{root}/store", f"{root}/stream").awaitTermination()
        landed[key] = root
    return {kind: snapshots.history(spark, f"{landed[key]}/store", kind) for kind in schemas.KEYS}


def _inventory_rows(frames, columns):
    out = None
    for kind, df in frames.items():
        df = df.select(F.lit(kind).alias("kind"), F.col(schemas.KEYS[kind][0]).alias("object_id"),
                       F.col(_VALUE_COLUMN[kind]).alias("tracked_value"), *columns)
        out = df if out is None else out.unionByName(df)
    return out


@register("inventory_histories", _inventory_sql("select * from inventory_history"))
def q_inventory_histories(spark, sf_dir):
    """Landed snapshots of dashboards (with schedules), spaces and warehouses
    are streamed by their completion markers, normalized, and applied to histories with the
    declared schemas and the real tracked columns, with a restart of the stream between."""
    frames = {kind: store.read() for kind, store in _streamed_inventory(spark, sf_dir).items()}
    return _inventory_rows(frames, ["__START_AT", "__END_AT"])


@register("inventory_current", _inventory_sql("select kind, object_id, tracked_value from inventory_history where __END_AT is null"))
def q_inventory_current(spark, sf_dir):
    """C4: the current views of the three streamed histories."""
    return _inventory_rows({kind: scd2.current(store.read_open()) for kind, store in _streamed_inventory(spark, sf_dir).items()}, [])


@register("inventory_as_of", _inventory_sql("""select kind, object_id, tracked_value from inventory_history
where __START_AT <= 2 and (__END_AT is null or __END_AT > 2)"""))
def q_inventory_as_of(spark, sf_dir):
    """The three inventories as they were at version 2, from the stored histories' folders that overlap it."""
    return _inventory_rows({kind: store.as_of(2) for kind, store in _streamed_inventory(spark, sf_dir).items()}, [])


@register("tables_by_name", ORACLE["space_cost"])
def q_tables_by_name(spark, sf_dir):
    """The cost tables are written to versioned folders, the space roll-up is read back by its name."""
    system = tables.SystemTables(query_history=fx.query_history(spark, sf_dir), usage=fx.usage(spark, sf_dir), audit=fx.audit(spark, sf_dir),
                                 account_prices=fx.account_prices(spark, sf_dir), list_prices=fx.list_prices(spark, sf_dir))
    made = tables.cost_tables(system, _dashboards(spark, sf_dir), fx.space_current(spark, sf_dir), fx.warehouse_current(spark, sf_dir),
                              fx.AS_OF, fx.WINDOW_DAYS)
    target = _history_folder(spark, "tables")
    tables.write_tables(made, target)
    out = tables.read_table(spark, target, "space_cost")
    return out.select("space_id", "genie_space_title", "configured_warehouse_id", "creator_id", "statements", r4("cost_usd"), r4("dbus"),
                      r4("avg_cost_per_statement_usd"), "unique_users", "last_statement_at")


# ------------------------------------------------------------------ K1
def _history_folder(spark, name):
    import uuid as _uuid

    from spendscope.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/spendscope/{name}-{_uuid.uuid4().hex}"


@register("cost_incremental_append", oracle.build(["stmt_cost"], _QCA_SELECT))
def q_cost_incremental_append(spark, sf_dir):
    """K1: append-only cost history: two parts of the feed are absorbed into the open statements,
    each followed by closing the hours it completes; statements that never end hold nothing
    up.  Must equal the full rebuild."""
    history = incremental.CostHistory(spark, _history_folder(spark, "cost-history"), fx.AS_OF, fx.WINDOW_DAYS)
    us, pr = fx.usage(spark, sf_dir), _prices(spark, sf_dir)
    for k, (rows, until) in enumerate(zip(fx.history_feed(spark, sf_dir), fx.FEED_HORIZONS)):
        history.absorb(rows, k)
        history.close(us, pr, until)
    return history.read().select(*QCA_OUT, r4("attributed_cost_usd"), r4("attributed_dbus"))


@register("cost_history_stream", oracle.build(["stmt_cost"], _QCA_SELECT))
def q_cost_history_stream(spark, sf_dir):
    """K1: the same history from a Structured Streaming file source: the first part is landed
    and streamed, then the stream is started anew over the same checkpoint with the second
    part there; every file is read by one batch.  Must equal the full rebuild."""
    root = _history_folder(spark, "cost-stream")
    us, pr = fx.usage(spark, sf_dir), _prices(spark, sf_dir)
    for rows, until in zip(fx.history_feed(spark, sf_dir), fx.FEED_HORIZONS):
        rows.write.mode("append").parquet(f"{root}/landed")
        incremental.run_stream(spark, f"{root}/landed", f"{root}/sink", f"{root}/stream", us, pr, fx.AS_OF, lambda u=until: u,
                               fx.WINDOW_DAYS, max_files_per_batch=8)
    history = incremental.CostHistory(spark, f"{root}/sink", fx.AS_OF, fx.WINDOW_DAYS)
    return history.read().select(*QCA_OUT, r4("attributed_cost_usd"), r4("attributed_dbus"))


_ROLLUP = ["statements", "cost_usd", "dbus", "avg_cost_per_statement_usd", "unique_users", "dashboards_touched",
           "genie_spaces_touched", "last_statement_at"]


def _rollup_sql(entity: str, table: str, ident: str, key: str) -> str:
    none, zero = "cast(null as bigint)", lambda c: f"coalesce({c}, 0)"
    mean = on(_or0("mean_usd"), 4, "avg_cost_per_statement_usd") if entity != "warehouse" else "cast(null as double) as avg_cost_per_statement_usd"
    return f"""select '{entity}' as entity, {ident} as id, {_FACT_COLUMNS}, {mean},
  {zero('people') if entity != 'dashboard' else none} as unique_users,
  {zero('boards') if entity == 'warehouse' else none} as dashboards_touched,
  {zero('spaces') if entity == 'warehouse' else none} as genie_spaces_touched, latest as last_statement_at
from {table} left join facts_{entity} on k = {ident}"""


@register("rollups_incremental", oracle.build(
    ["stmt_cost", "fx_dashboard_current", "fx_space_current", "fx_warehouse_current"],
    "\nunion all\n".join(_rollup_sql(*x) for x in (("dashboard", "fx_dashboard_current", "dashboard_id", "dashboard_id"),
                                                   ("space", "fx_space_current", "space_id", "genie_space_id"),
                                                   ("warehouse", "fx_warehouse_current", "id", "warehouse_id"))),
    extra=[(f"facts_{e}", _facts(k)[len("facts as ("):-1]) for e, k in rollup_states.KEYS.items()]))
def q_rollups_incremental(spark, sf_dir):
    """A12 with H9-H11: the three roll-ups maintained from three increments of the cost history,
    each step reading its increment only; must equal the rebuild."""
    history = incremental.CostHistory(spark, _history_folder(spark, "cost-history"), fx.AS_OF, fx.WINDOW_DAYS)
    store = rollup_states.RollupStore(spark, _history_folder(spark, "rollups"))
    us, pr = fx.usage(spark, sf_dir), _prices(spark, sf_dir)
    first, second = fx.history_feed(spark, sf_dir)
    for rows, until in ((first, [_dt.datetime(2024, 1, 7), fx.FEED_HORIZONS[0]]), (second, [fx.FEED_HORIZONS[1]])):
        history.absorb(rows)
        for horizon in until:
            history.close(us, pr, horizon)
            store.follow(history)
    tables = [store.dashboard_cost(_dashboards(spark, sf_dir)).withColumnRenamed("dashboard_id", "id"),
              store.space_cost(fx.space_current(spark, sf_dir)).withColumnRenamed("space_id", "id"),
              store.warehouse_cost(fx.warehouse_current(spark, sf_dir)).withColumnRenamed("warehouse_id", "id")]
    kinds = {"avg_cost_per_statement_usd": "double", "unique_users": "bigint", "dashboards_touched": "bigint", "genie_spaces_touched": "bigint"}
    out = None
    for entity, t in zip(rollup_states.KEYS, tables):
        t = t.select(F.lit(entity).alias("entity"), "id", *[F.col(c) if c in t.columns else F.lit(None).cast(kinds[c]).alias(c) for c in _ROLLUP])
        out = t if out is None else out.unionByName(t)
    return out.select("entity", "id", "statements", r4("cost_usd"), r4("dbus"), r4("avg_cost_per_statement_usd"), *_ROLLUP[4:])


# ------------------------------------------------------------------ A9 / D1
def _nested_system(spark, sf_dir):
    """The derived system tables written in their nested layout, then read
    back: the flattening selects prune the parquet read to nested leaves."""
    landed = _landed(spark)
    key = (sf_dir, "nested")
    if key not in landed:
        landed[key] = {
            "qh": materialize(system_tables.nest_query_history(fx.query_history(spark, sf_dir)), "nested_qh"),
            "usage": materialize(system_tables.nest_usage(fx.usage(spark, sf_dir)), "nested_usage"),
            "acct": materialize(system_tables.nest_prices(fx.account_prices(spark, sf_dir)), "nested_acct"),
            "list": materialize(system_tables.nest_prices(fx.list_prices(spark, sf_dir)), "nested_list"),
            "audit": materialize(system_tables.nest_audit(fx.audit(spark, sf_dir)), "nested_audit"),
        }
    return landed[key]


@register("nested_query_cost_attribution", oracle.build(["stmt_cost"], _QCA_SELECT))
def q_nested_query_cost_attribution(spark, sf_dir):
    """The flagship over nested system-table layouts (compute.warehouse_id,
    query_source.job_info.job_id, usage_metadata.warehouse_id, pricing.default)."""
    n = _nested_system(spark, sf_dir)
    eff = prices.effective_prices(system_tables.flatten_prices(n["acct"]), system_tables.flatten_prices(n["list"]))
    qca = cost.query_cost_attribution(
        system_tables.flatten_query_history(n["qh"]), system_tables.flatten_usage(n["usage"]), eff,
        fx.AS_OF, fx.WINDOW_DAYS,
    )
    return qca.select(*QCA_OUT, r4("attributed_cost_usd"), r4("attributed_dbus"))


@register("nested_dashboard_usage_30d", oracle.build(["fx_audit"], "select * from dashboard_views", extra=[_O_VIEWS]))
def q_nested_dashboard_usage_30d(spark, sf_dir):
    """Dashboard views from an audit log with map-typed request_params."""
    n = _nested_system(spark, sf_dir)
    return usage.dashboard_views(system_tables.flatten_audit(n["audit"]), fx.AS_OF, fx.USAGE_WINDOW_DAYS)
