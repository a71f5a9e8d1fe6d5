"""Normalize raw object JSON into snapshot rows (dashboards, spaces, warehouses).

Input is a landing table ``(object_id, raw_json, status)``; only ``status =
'ok'`` rows are normalized (failed fetches are reported, not turned into
rows).  Everything is built-in column expressions: parsing, canonical JSON,
hashing and counting run in the JVM for any number of objects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.functions import normalize as N

# The snapshot columns of each object type and the columns
# whose change opens a new history version (raw JSON texts are not
# tracked; their hashes are).
DASHBOARD_COLUMNS = [
    "dashboard_id", "create_time", "display_name", "etag", "lifecycle_state", "parent_path", "path",
    "warehouse_id", "owner", "dashboard_metadata_json", "dashboard_metadata_json_sha256",
    "serialized_dashboard", "serialized_dashboard_sha256", "update_time", "schedules_json",
    "schedules_json_sha256", "schedule_count",
    *[f"schedule_frequency_{b}" for b in N.FREQ_BUCKETS],
]
DASHBOARD_TRACKED = [
    "create_time", "display_name", "etag", "lifecycle_state", "parent_path", "path",
    "warehouse_id", "owner", "dashboard_metadata_json_sha256", "serialized_dashboard_sha256",
    "update_time", "schedules_json_sha256", "schedule_count",
    *[f"schedule_frequency_{b}" for b in N.FREQ_BUCKETS],
]
SPACE_COLUMNS = [
    "space_id", "title", "description", "warehouse_id", "creator_id", "create_time", "update_time",
    "space_metadata_json", "space_metadata_json_sha256", "table_count", "instruction_count",
    "sample_question_count", "curated_question_count",
]
SPACE_TRACKED = [
    "title", "description", "warehouse_id", "creator_id", "create_time", "update_time",
    "space_metadata_json_sha256", "table_count", "instruction_count",
    "sample_question_count", "curated_question_count",
]
WAREHOUSE_COLUMNS = [
    "id", "name", "state", "warehouse_type", "cluster_size", "min_num_clusters", "max_num_clusters",
    "auto_stop_mins", "num_clusters", "num_active_sessions", "enable_photon", "enable_serverless_compute",
    "spot_instance_policy", "channel", "creator_name", "warehouse_metadata_json", "warehouse_metadata_json_sha256",
]
WAREHOUSE_TRACKED = [
    "name", "state", "warehouse_type", "cluster_size", "min_num_clusters", "max_num_clusters",
    "auto_stop_mins", "num_clusters", "num_active_sessions", "enable_photon",
    "enable_serverless_compute", "spot_instance_policy", "channel", "creator_name",
    "warehouse_metadata_json_sha256",
]


def ok_rows(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("status") == "ok")


def fetch_outcomes(raw: DataFrame) -> DataFrame:
    """Objects per fetch outcome (ok / missing / invalid …)."""
    return raw.groupBy("status").agg(F.count(F.lit(1)).alias("objects"))


def observe_outcomes(raw: DataFrame, name: str = "snapshot_outcomes"):
    """A8 without an extra job: ``(raw_observed, observation)``; the counters
    (objects, ok, missing, invalid) are filled in by whatever action later
    consumes ``raw_observed`` (e.g. writing the normalized snapshot)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    st = F.col("status")
    observed = raw.observe(
        obs,
        F.count(F.lit(1)).alias("objects"),
        F.sum(F.when(st == "ok", 1).otherwise(0)).alias("ok"),
        F.sum(F.when(st == "missing", 1).otherwise(0)).alias("missing"),
        F.sum(F.when(~st.isin("ok", "missing") | st.isNull(), 1).otherwise(0)).alias("invalid"),
    )
    return observed, obs


# ------------------------------------------------------------------ B6/B7/B12
def key_ordered(col, kind: T.DataType):
    """``col`` with the fields of its structs, at any depth, and the entries of its maps in key order."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(col.isNotNull(), F.struct(*[key_ordered(col.getField(f.name), f.dataType).alias(f.name) for f in fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: key_ordered(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.transform(F.array_sort(F.map_keys(col)), lambda k: F.struct(k, key_ordered(F.element_at(col, k), kind.valueType)))
        return F.map_from_entries(entries)
    return col


def with_schedule_bucket(schedules: DataFrame, out: str, given_wins: bool = False) -> DataFrame:
    """Add the frequency bucket of each schedule: of the cron text inside its ``cron_schedule``
    object, or of a flat ``quartz_cron_expression`` column.  ``given_wins``: a
    ``human_schedule`` that the object carries counts, ``unknown`` where it is no bucket."""
    kind = schedules.schema["cron_schedule"].dataType if "cron_schedule" in schedules.columns else None
    inside = kind.fieldNames() if isinstance(kind, T.StructType) else []
    texts = [F.col("cron_schedule.quartz_cron_expression")] if "quartz_cron_expression" in inside else []
    texts += [F.col("quartz_cron_expression")] if "quartz_cron_expression" in schedules.columns else []
    text = F.coalesce(*texts).cast("string") if texts else F.lit(None).cast("string")
    found = N.with_cron_frequency(schedules.withColumn("__cron", text), "__cron", out).drop("__cron")
    if given_wins and "human_schedule" in inside:
        given = F.col("cron_schedule.human_schedule")
        kept = F.when(given.isin(*N.FREQ_BUCKETS), given).otherwise("unknown")
        found = found.withColumn(out, F.when(F.length(given) > 0, kept).otherwise(F.col(out)))
    return found


def annotate_schedules(schedules: DataFrame) -> DataFrame:
    """Each schedule with its frequency bucket, as a struct whose fields are
    in key order (so its JSON text is canonical).  Every column but
    ``dashboard_id`` is a field of the schedule.  The cron expression lies in the
    ``cron_schedule`` object, with all its other fields; a flat cron expression and
    time zone beside it are put there."""
    bucket = F.col("bucket")
    kinds = {f.name: f.dataType for f in schedules.schema.fields if f.name != "dashboard_id"}
    cron = {"human_schedule": bucket}
    given = kinds.pop("cron_schedule", None)
    if isinstance(given, T.StructType):
        cron = {f.name: key_ordered(F.col("cron_schedule").getField(f.name), f.dataType) for f in given.fields} | cron
    for c in ("quartz_cron_expression", "timezone_id"):
        if kinds.pop(c, None):
            cron[c] = F.coalesce(cron[c], F.col(c)) if c in cron else F.col(c)
    fields = {c: key_ordered(F.col(f"`{c}`"), kind) for c, kind in kinds.items()}
    fields["cron_schedule"] = F.struct(*[cron[c].alias(c) for c in sorted(cron)])
    return with_schedule_bucket(schedules, "bucket").select(
        "dashboard_id",
        bucket,
        F.struct(
            F.coalesce(F.col("schedule_id"), F.lit("")).alias("k1"),
            F.coalesce(F.col("display_name"), F.lit("")).alias("k2"),
            N.ascii_json(F.to_json(F.struct(*[fields[c].alias(c) for c in sorted(fields)]))).alias("s"),
        ).alias("entry"),
    )


def schedule_summary(schedules: DataFrame) -> DataFrame:
    """Per dashboard: canonical JSON of its schedules sorted by (schedule_id,
    display_name) so order never creates history, count, and the eight
    bucket counts — one aggregation.  A dashboard's schedule list is one
    API page, so the collected group is bounded."""
    a = annotate_schedules(schedules)
    counts = [
        F.sum(F.when(F.col("bucket") == b, 1).otherwise(0)).cast("int").alias(f"schedule_frequency_{b}")
        for b in N.FREQ_BUCKETS
    ]
    g = a.groupBy("dashboard_id").agg(
        F.sort_array(F.collect_list("entry")).alias("__entries"),
        F.count(F.lit(1)).cast("int").alias("schedule_count"),
        *counts,
    )
    js = F.concat(F.lit("["), F.array_join(F.transform("__entries", lambda e: e["s"]), ","), F.lit("]"))
    return g.select(
        "dashboard_id",
        F.when(F.col("schedule_count") > 0, js).alias("schedules_json"),
        "schedule_count",
        *[f"schedule_frequency_{b}" for b in N.FREQ_BUCKETS],
    )


def schedule_frequency_counts(schedules: DataFrame) -> DataFrame:
    """B7 alone: schedule count and the eight bucket counts per dashboard
    (map-side partial aggregation; no list is collected)."""
    return with_schedule_bucket(schedules, "__b", given_wins=True).groupBy("dashboard_id").agg(
        F.count(F.lit(1)).cast("int").alias("schedule_count"),
        *[F.sum(F.when(F.col("__b") == b, 1).otherwise(0)).cast("int").alias(f"schedule_frequency_{b}")
          for b in N.FREQ_BUCKETS],
    )


# ------------------------------------------------------------------ B8
def dashboard_rows(raw: DataFrame, schedules: DataFrame | None = None,
                   include_serialized_dashboard: bool = True) -> DataFrame:
    """One normalized snapshot row per dashboard (25 columns)."""
    # parse each record once; every field is read once from the parsed map
    # (first projection), derived columns refer to those (second projection)
    r = ok_rows(raw).select(N.json_fields("raw_json").alias("m"))
    f = lambda k: F.col("m")[k]
    text_fields = ["dashboard_id", "display_name", "etag", "lifecycle_state", "parent_path", "path", "warehouse_id"]
    fields = r.select(
        *[N.variant_text(f(k)).alias(k) for k in text_fields],
        f("create_time").alias("__create"), f("update_time").alias("__update"),
        f("serialized_dashboard").alias("__sd"),
        N.canonical_json_of_fields("m", drop=("serialized_dashboard",)).alias("dashboard_metadata_json"),
    )
    sd_type = F.schema_of_variant("__sd")
    serialized = (
        F.when(sd_type.startswith("OBJECT") | sd_type.startswith("ARRAY"), N.ascii_json(F.to_json("__sd")))
        .otherwise(N.variant_text("__sd"))
    )
    if not include_serialized_dashboard:
        serialized = F.lit(None).cast("string")
    base = fields.select(
        "dashboard_id",
        N.coerce_timestamp_variant("__create").alias("create_time"),
        "display_name", "etag", "lifecycle_state", "parent_path", "path", "warehouse_id",
        N.owner_from_path("parent_path").alias("owner"),
        "dashboard_metadata_json",
        serialized.alias("serialized_dashboard"),
        N.coerce_timestamp_variant("__update").alias("update_time"),
    ).where(F.col("dashboard_id").isNotNull() & (F.col("dashboard_id") != ""))
    if schedules is None:
        sched = None
    else:
        sched = schedule_summary(schedules)
    out = base if sched is None else base.join(sched, "dashboard_id", "left")
    zero = F.lit(0).cast("int")
    return out.select(
        "dashboard_id", "create_time", "display_name", "etag", "lifecycle_state", "parent_path", "path",
        "warehouse_id", "owner", "dashboard_metadata_json",
        N.sha256_hex("dashboard_metadata_json").alias("dashboard_metadata_json_sha256"),
        "serialized_dashboard",
        N.sha256_hex("serialized_dashboard").alias("serialized_dashboard_sha256"),
        "update_time",
        (F.col("schedules_json") if sched is not None else F.lit(None).cast("string")).alias("schedules_json"),
        (N.sha256_hex("schedules_json") if sched is not None else F.lit(None).cast("string")).alias(
            "schedules_json_sha256"),
        (F.coalesce(F.col("schedule_count"), zero) if sched is not None else zero).alias("schedule_count"),
        *[(F.coalesce(F.col(f"schedule_frequency_{b}"), zero) if sched is not None else zero)
          .alias(f"schedule_frequency_{b}") for b in N.FREQ_BUCKETS],
    )


# ------------------------------------------------------------------ B9
def space_rows(raw: DataFrame) -> DataFrame:
    """One normalized row per conversational space, with counts read from
    the nested ``serialized_space`` JSON (bad JSON → counts 0).  A record
    without a space id (e.g. an error body) is rejected, not kept as ''."""
    r = ok_rows(raw).select(F.try_parse_json("raw_json").alias("v"))
    j = lambda p: N.variant_text("v", p)
    ss = F.try_parse_json(j("$.serialized_space"))  # the nested definition, parsed once
    meta = F.to_json(F.col("v"))
    return r.where(F.length(j("$.space_id")) > 0).select(
        j("$.space_id").alias("space_id"),
        j("$.title").alias("title"),
        j("$.description").alias("description"),
        j("$.warehouse_id").alias("warehouse_id"),
        N.truthy_text("v", "$.creator_id").alias("creator_id"),
        N.coerce_timestamp_variant(F.variant_get("v", "$.create_time", "variant")).alias("create_time"),
        N.coerce_timestamp_variant(F.variant_get("v", "$.update_time", "variant")).alias("update_time"),
        meta.alias("space_metadata_json"),
        N.sha256_hex(meta, empty_is_null=False).alias("space_metadata_json_sha256"),
        ss.alias("__ss"),
    ).select(
        *[c for c in SPACE_COLUMNS if c not in ("table_count", "instruction_count", "sample_question_count",
                                                  "curated_question_count")],
        N.variant_list_size("__ss", "$.data_sources.tables").cast("int").alias("table_count"),
        N.variant_list_or_dict_size("__ss", "$.instructions").cast("int").alias("instruction_count"),
        N.variant_list_size("__ss", "$.config.sample_questions").cast("int").alias("sample_question_count"),
        N.variant_list_size("__ss", "$.config.curated_questions").cast("int").alias("curated_question_count"),
    )


# ------------------------------------------------------------------ B10/B11
def warehouse_rows(raw: DataFrame) -> DataFrame:
    """One normalized row per warehouse: integers safe-cast, flags and
    enums as text, ``channel`` = its ``name`` when it is an object."""
    r = ok_rows(raw).select(F.try_parse_json("raw_json").alias("v"))
    j = lambda p: N.variant_text("v", p)
    channel = j("$.channel")
    meta = F.to_json(F.col("v"))
    return r.where(F.length(j("$.id")) > 0).select(
        j("$.id").alias("id"),
        j("$.name").alias("name"),
        j("$.state").alias("state"),
        j("$.warehouse_type").alias("warehouse_type"),
        j("$.cluster_size").alias("cluster_size"),
        *[N.safe_int(j(f"$.{c}")).alias(c) for c in
          ("min_num_clusters", "max_num_clusters", "auto_stop_mins", "num_clusters", "num_active_sessions")],
        j("$.enable_photon").alias("enable_photon"),
        j("$.enable_serverless_compute").alias("enable_serverless_compute"),
        j("$.spot_instance_policy").alias("spot_instance_policy"),
        F.when(F.schema_of_variant(F.variant_get("v", "$.channel", "variant")).startswith("OBJECT"),
               j("$.channel.name")).otherwise(channel).alias("channel"),
        j("$.creator_name").alias("creator_name"),
        meta.alias("warehouse_metadata_json"),
        N.sha256_hex(meta, empty_is_null=False).alias("warehouse_metadata_json_sha256"),
    )
