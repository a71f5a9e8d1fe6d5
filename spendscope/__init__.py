"""spendscope: inventory history and uptime-cost attribution as Spark DataFrame jobs.

Every operator is a function from DataFrames (plus column names and
parameters) to a DataFrame.  Nothing is collected to the driver; the
only driver-side values are plan statistics used to pick a join
strategy, single aggregates and small state files.

Modules: ``session`` (settings, checkpoint folder), ``operators`` (cost,
prices, roll-ups, usage, SCD2, metrics, quality), ``functions``
(normalizer and time expressions), ``sources`` (landing data source,
snapshot normalizers, system-table adapters), ``plans`` (join strategy
helpers), ``streaming`` (incremental cost history), ``tables`` (the whole
table graph), ``schemas`` (declared history schemas).
"""
