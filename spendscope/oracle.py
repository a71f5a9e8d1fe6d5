"""Independent DuckDB SQL for every registered query.

The driver runs each string on DuckDB with the generated tables registered
as views, and compares the result with the Spark DataFrame of the same
name.  The fixture derivations are written out as SQL CTEs here and as
DataFrame code in ``spendscope.fixtures``; the operator logic is written
from its specification, not generated from the Spark code.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
CUTOFF_365 = "TIMESTAMP '2023-02-01 00:00:00'"  # AS_OF - 365 days
CUTOFF_30 = "TIMESTAMP '2024-01-02 00:00:00'"   # AS_OF - 30 days

FIXTURES: dict[str, str] = {
    "fx_query_history": """
select concat('s', cast(event_id as varchar)) as statement_id,
  concat('ws', cast(user_id % 2 as varchar)) as workspace_id,
  concat('u', cast(user_id as varchar)) as executed_by,
  concat('w', cast(user_id % 4 as varchar)) as warehouse_id,
  case when event_type = 'view' then concat('d', cast(user_id % 10 as varchar)) end as dashboard_id,
  case when event_type = 'click' then concat('g', cast(user_id % 3 as varchar)) end as genie_space_id,
  case when event_type = 'signup' then 'nb1' end as notebook_id,
  case when event_type = 'error' and cast(regexp_extract(props, '([0-9]+)', 1) as int) < 50 then 'al1' end as alert_id,
  case when event_type = 'error' and cast(regexp_extract(props, '([0-9]+)', 1) as int) >= 50 then 'jb1' end as job_id,
  case when user_id % 3 = 0 then 'Tableau' when user_id % 3 = 1 then 'dbt' else 'SQL Editor' end as client_application,
  case when cast(regexp_extract(props, '([0-9]+)', 1) as int) % 10 = 0 then 'FAILED' else 'FINISHED' end as execution_status,
  ts as start_time,
  ts + interval '1' second * cast(floor(value * 30) as int) as end_time,
  cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as compilation_duration_ms,
  cast(floor(value * 1000) as bigint) as execution_duration_ms,
  cast(regexp_extract(props, '([0-9]+)', 1) as bigint) * 10 as result_fetch_duration_ms,
  cast(floor(value * 4000) as bigint) as total_task_duration_ms
from events""",
    "fx_usage": """
select concat('ws', cast(user_id % 2 as varchar)) as workspace_id,
  concat('w', cast(user_id % 4 as varchar)) as warehouse_id,
  'AWS' as cloud, concat('SKU_', cast(user_id % 3 as varchar)) as sku_name,
  case when event_id % 50 = 0 then 'JOBS' else 'SQL' end as billing_origin_product,
  cast(date_trunc('hour', ts) as timestamp) as usage_start_time,
  case when event_id % 400 = 9 then value / -10 else value / 10 end as usage_quantity
from events""",
    "fx_list_prices": """
select 'AWS' as cloud, concat('SKU_', cast(r_regionkey as varchar)) as sku_name,
  timestamp '2023-01-01 00:00:00' as price_start_time, timestamp '2024-01-15 00:00:00' as price_end_time,
  cast(0.5 as double) + cast(0.1 as double) * r_regionkey as price_usd from region where r_regionkey <> 2
union all
select 'AWS', concat('SKU_', cast(r_regionkey as varchar)), timestamp '2024-01-15 00:00:00', cast(null as timestamp),
  cast(0.6 as double) + cast(0.1 as double) * r_regionkey from region where r_regionkey <> 2
union all
select 'AWS', concat('SKU_S', cast(s_suppkey as varchar)), timestamp '2023-01-01 00:00:00', cast(null as timestamp),
  cast(0.01 as double) * cast(s_suppkey % 100 as double) from supplier""",
    "fx_account_prices": """
select 'AWS' as cloud, concat('SKU_', cast(r_regionkey as varchar)) as sku_name,
  timestamp '2024-01-15 00:00:00' as price_start_time, cast(null as timestamp) as price_end_time,
  cast(0.4 as double) as price_usd from region where r_regionkey = 0
union all
select 'AWS', concat('SKU_S', cast(s_suppkey as varchar)), timestamp '2023-01-01 00:00:00', cast(null as timestamp),
  cast(0.005 as double) * cast(s_suppkey % 100 as double) from supplier where s_suppkey % 10 = 0
union all
select 'AWS', concat('SKU_S', cast(s_suppkey as varchar)), timestamp '2024-01-01 00:00:00', cast(null as timestamp),
  cast(0.004 as double) * cast(s_suppkey % 100 as double) from supplier where s_suppkey % 7 = 0""",
    "fx_audit": """
select cast(ts as date) as event_date,
  case event_type when 'view' then 'getPublishedDashboard' when 'click' then 'getDashboard' else event_type end as action_name,
  case when event_id % 20 <> 0 then concat('d', cast(user_id % 10 as varchar)) end as dashboard_id,
  concat('u', cast(user_id as varchar)) as email
from events""",
    "fx_dashboard_current": """
select concat('d', cast(n_nationkey as varchar)) as dashboard_id, n_name as display_name,
  concat('/Users/owner', cast(n_regionkey as varchar), '@x.org/dash') as parent_path,
  concat('w', cast(n_nationkey % 4 as varchar)) as warehouse_id
from nation""",
    "fx_space_current": """
select concat('g', cast(r_regionkey as varchar)) as space_id, r_name as title,
  concat('w', cast(r_regionkey % 4 as varchar)) as warehouse_id, concat('c', cast(r_regionkey as varchar)) as creator_id
from region""",
    "fx_warehouse_current": """
select concat('w', cast(r_regionkey as varchar)) as id, r_name as name,
  case when r_regionkey % 2 = 0 then 'Small' else 'Large' end as cluster_size, 'PRO' as warehouse_type,
  'true' as enable_serverless_compute
from region""",
    "fx_snapshots": """
select c_custkey as object_id, ver as version, c_mktsegment as segment,
  case when c_custkey % 7 = ver then c_acctbal + ver else c_acctbal end as balance,
  concat('p', cast(ver as varchar)) as payload
from customer cross join (select 1 as ver union all select 2 union all select 3) v
where c_custkey % 10 <> ver""",
    "fx_schedules": """
select concat('d', cast(user_id % 10 as varchar)) as dashboard_id, concat('sc', cast(event_id as varchar)) as schedule_id,
  case event_id % 10 when 0 then '0 * * * * ?' when 1 then '0 */5 * * * ?' when 2 then '0 0 9 * * ?' when 3 then '0 0 9 ? * MON'
    when 4 then '0 0 9 1 * ?' when 5 then '0 0 9 1 1 ?' when 6 then '0 9 * * *' when 7 then '0 0 9 1 1 MON' when 8 then '' end
    as quartz_cron_expression
from events""",
}

# The cost chain as SQL, stated from the specification: contract prices
# replace list prices with the same start (anti join); the bill per
# workspace/warehouse/hour; each finished statement enumerated over its
# clock hours by integer offsets; work prorated by whole-second overlap; one
# per-hour book (total work + bill) that every statement-hour joins once.
STEPS: dict[str, str] = {
    "prices_eff": """
select a.cloud, a.sku_name, a.price_start_time, a.price_end_time, a.price_usd from fx_account_prices a
union all
select l.cloud, l.sku_name, l.price_start_time, l.price_end_time, l.price_usd
from fx_list_prices l
left join (select distinct cloud, sku_name, price_start_time from fx_account_prices) o
  on o.cloud = l.cloud and o.sku_name = l.sku_name and o.price_start_time = l.price_start_time
where o.sku_name is null""",
    "bill_by_hour": f"""
select u.workspace_id, u.warehouse_id, date_trunc('hour', u.usage_start_time) as hour_start,
  sum(u.usage_quantity) as dbus,
  sum(u.usage_quantity * coalesce(p.price_usd, 0)) * {{factor}} as list_cost_usd
from fx_usage u
left join prices_eff p
  on p.cloud = u.cloud and p.sku_name = u.sku_name
 and u.usage_start_time >= p.price_start_time
 and u.usage_start_time < coalesce(p.price_end_time, timestamp 'infinity')
where u.usage_start_time >= {{cutoff}} and u.billing_origin_product = 'SQL' and u.warehouse_id is not null
group by all""",
    "stmt": f"""
select statement_id, workspace_id, executed_by, warehouse_id, dashboard_id, genie_space_id, notebook_id,
  alert_id, job_id, client_application, start_time, end_time,
  coalesce(compilation_duration_ms, 0) + coalesce(execution_duration_ms, 0) + coalesce(result_fetch_duration_ms, 0) as work_ms
from fx_query_history
where execution_status = 'FINISHED' and end_time is not null and warehouse_id is not null and start_time >= {{cutoff}}""",
    "stmt_hours": """
select s.*, date_trunc('hour', s.start_time) + to_hours(t.k) as hour_start
from stmt s
cross join unnest(range(0, datediff('hour', date_trunc('hour', s.start_time),
                                     date_trunc('hour', greatest(s.start_time, s.end_time))) + 1)) as t(k)""",
    "stmt_hour_work": """
select *, case when dur_s <= 0 then cast(work_ms as double) else work_ms * overlap_s / dur_s end as work_ms_in_hour
from (
  select *,
    cast(floor(epoch(end_time)) - floor(epoch(start_time)) as bigint) as dur_s,
    cast(floor(epoch(least(end_time, hour_start + interval 1 hour))) - floor(epoch(greatest(start_time, hour_start)))
         as bigint) as overlap_s
  from stmt_hours) x""",
    "hour_total": """
select workspace_id, warehouse_id, hour_start, sum(work_ms_in_hour) as total_work_ms_in_hour
from stmt_hour_work group by all""",
    "hour_book": """
select t.workspace_id, t.warehouse_id, t.hour_start, t.total_work_ms_in_hour, b.dbus, b.list_cost_usd
from hour_total t left join bill_by_hour b
  on b.workspace_id = t.workspace_id and b.warehouse_id = t.warehouse_id and b.hour_start = t.hour_start""",
    "stmt_hour_cost": """
select s.*,
  s.work_ms_in_hour / nullif(h.total_work_ms_in_hour, 0) * coalesce(h.list_cost_usd, 0) as cost_usd_in_hour,
  s.work_ms_in_hour / nullif(h.total_work_ms_in_hour, 0) * coalesce(h.dbus, 0) as dbus_in_hour
from stmt_hour_work s left join hour_book h
  on h.workspace_id = s.workspace_id and h.warehouse_id = s.warehouse_id and h.hour_start = s.hour_start""",
    "stmt_cost": """
select statement_id, workspace_id, executed_by, warehouse_id, dashboard_id, genie_space_id, notebook_id, alert_id,
  job_id, client_application, min(start_time) as start_time, max(end_time) as end_time, max(work_ms) as work_ms,
  sum(cost_usd_in_hour) as attributed_cost_usd, sum(dbus_in_hour) as attributed_dbus
from stmt_hour_cost
group by statement_id, workspace_id, executed_by, warehouse_id, dashboard_id, genie_space_id, notebook_id, alert_id,
  job_id, client_application""",
}

# Which earlier names each step reads.
STEP_DEPS: dict[str, list[str]] = {
    "prices_eff": ["fx_account_prices", "fx_list_prices"],
    "bill_by_hour": ["fx_usage", "prices_eff"],
    "stmt": ["fx_query_history"],
    "stmt_hours": ["stmt"],
    "stmt_hour_work": ["stmt_hours"],
    "hour_total": ["stmt_hour_work"],
    "hour_book": ["hour_total", "bill_by_hour"],
    "stmt_hour_cost": ["stmt_hour_work", "hour_book"],
    "stmt_cost": ["stmt_hour_cost"],
}


def _closure(names: list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in STEP_DEPS.get(n, []):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def build(uses: list[str], body: str, factor: float = 1.0, extra: list[tuple[str, str]] | None = None,
          cutoff: str = CUTOFF_365) -> str:
    """``WITH`` every fixture/step in ``uses`` (and what they read), then
    the optional ``extra`` CTEs, then ``body``."""
    ctes = []
    for name in _closure(uses):
        text = FIXTURES.get(name) or STEPS[name].replace("{factor}", repr(float(factor))).replace("{cutoff}", cutoff)
        ctes.append(f"{name} AS ({text}\n)")
    for name, text in extra or []:
        ctes.append(f"{name} AS ({text}\n)")
    if not ctes:
        return body
    if body.lstrip().lower().startswith("with"):
        body = f"SELECT * FROM (\n{body}\n) AS q"
    return "WITH " + ",\n".join(ctes) + "\n" + body
