"""Hand-made rows for the normalizers."""

import datetime as dt
import json

from pyspark.sql import functions as F

import pytest

from spendscope.functions import normalize as N
from spendscope.sources import normalize

CRON_CASES = [
    ("0 * * * * ?", "minutely"), ("0 */1 */1 * * ?", "minutely"), ("0 */5 * * * ?", "hourly"),
    ("0 0 */2 * * ?", "daily"), ("0 0 9 * * ?", "daily"), ("0 0 9 ? * MON", "weekly"),
    ("0 0 9 1 * ?", "monthly"), ("0 0 9 1 1 ?", "yearly"), ("0 0 9 1 1 ? 2025", "yearly"),
    ("0 9 * * *", "custom"), ("0 0 9 1 1 MON", "custom"), ("   ", "custom"), ("", "unknown"), (None, "unknown"),
    ("  0   0  9 * * ?  ", "daily"), ("0 0 9 ? JAN *", "custom"),
]


def test_cron_buckets(spark):
    df = spark.createDataFrame([(e,) for e, _ in CRON_CASES], "e string")
    got = [r[0] for r in df.select(N.cron_frequency("e")).collect()]
    assert got == [b for _, b in CRON_CASES]


def test_owner_from_path(spark):
    df = spark.createDataFrame([("/Users/a@x.org/f",), ("/Users/",), ("/Shared/x",), (None,), ("/Users/b",)], "p string")
    assert [r[0] for r in df.select(N.owner_from_path("p")).collect()] == ["a@x.org", "", None, None, "b"]


def test_coerce_timestamps(spark):
    raw = [json.dumps({"t": v}) for v in [1700000000000, 1700000000, "2024-01-05T10:00:00+02:00",
                                          "2024-01-05T10:00:00Z", "", "junk", None, " 2024-01-05 10:00:00 ",
                                          "2024", "2024-01", "2024-01-05"]]
    df = spark.createDataFrame([(r,) for r in raw], "raw string").select(F.try_parse_json("raw").alias("v"))
    got = [r[0] for r in df.select(N.coerce_timestamp_variant(F.try_variant_get("v", "$.t", "variant"))).collect()]
    T = dt.datetime
    assert got == [T(2023, 11, 14, 22, 13, 20), T(2023, 11, 14, 22, 13, 20), T(2024, 1, 5, 10), T(2024, 1, 5, 10),
                   None, None, None, T(2024, 1, 5, 10), None, None, T(2024, 1, 5)]


def test_last_of_repeated_json_keys_counts(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 2, "a": 3}',)], "j string")
    row = df.select(N.canonical_json("j").alias("c"), N.canonical_json_of_fields(N.json_fields("j")).alias("f")).first()
    assert row["c"] == row["f"] == '{"a":3,"b":2}'


def test_canonical_json_and_hash(spark):
    df = spark.createDataFrame([('{"b": 1, "a": [2, {"d": 1, "c": 0}]}',), ("{bad",), ("",)], "j string")
    rows = df.select(N.canonical_json("j").alias("c"), N.sha256_hex(N.canonical_json("j")).alias("h")).collect()
    assert rows[0]["c"] == '{"a":[2,{"c":0,"d":1}],"b":1}'
    import hashlib

    assert rows[0]["h"] == hashlib.sha256(rows[0]["c"].encode()).hexdigest()
    assert rows[1]["c"] is None and rows[1]["h"] is None


def test_space_counts_edge_shapes(spark):
    def space(ss, creator=None):
        return json.dumps({"space_id": "g1", "creator_id": creator, "serialized_space": ss})

    cases = [
        (space(json.dumps({"instructions": ["a", "b"], "data_sources": {"tables": [1, 2, 3]},
                           "config": {"sample_questions": ["q"], "curated_questions": []}}), 7), (3, 2, 1, 0), "7"),
        (space(json.dumps({"instructions": {"k": 1}, "config": None}), 0), (0, 1, 0, 0), None),
        (space("{not json", ""), (0, 0, 0, 0), None),
        (space(json.dumps({"instructions": "x", "data_sources": {"tables": "no"}}), "u1"), (0, 0, 0, 0), "u1"),
    ]
    raw = spark.createDataFrame([(f"g{i}", c[0], "ok") for i, c in enumerate(cases)], "object_id string, raw_json string, status string")
    rows = normalize.space_rows(raw).collect()
    for row, (_, counts, creator) in zip(rows, cases):
        assert (row["table_count"], row["instruction_count"], row["sample_question_count"],
                row["curated_question_count"]) == counts
        assert row["creator_id"] == creator


def test_warehouse_row_shapes(spark):
    raw = json.dumps({"id": "w1", "channel": {"name": "CURRENT"}, "max_num_clusters": "x", "min_num_clusters": "2",
                      "enable_photon": True, "num_clusters": 3})
    df = spark.createDataFrame([("w1", raw, "ok"), ("w2", "{}", "missing")], "object_id string, raw_json string, status string")
    rows = normalize.warehouse_rows(df).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["channel"], r["max_num_clusters"], r["min_num_clusters"], r["enable_photon"], r["num_clusters"]) == (
        "CURRENT", None, 2, "true", 3)
    assert r["warehouse_metadata_json"] == json.dumps(json.loads(raw), sort_keys=True, separators=(",", ":"))


def test_schedule_order_does_not_change_hash(spark):
    base = [("d1", "s2", "B", "0 0 9 * * ?", "UTC", "UNPAUSED"), ("d1", "s1", "A", "0 * * * * ?", "UTC", "PAUSED")]
    schema = ("dashboard_id string, schedule_id string, display_name string, quartz_cron_expression string, "
              "timezone_id string, pause_status string")
    a = normalize.schedule_summary(spark.createDataFrame(base, schema)).collect()[0]
    b = normalize.schedule_summary(spark.createDataFrame(base[::-1], schema)).collect()[0]
    assert a["schedules_json"] == b["schedules_json"]
    parsed = json.loads(a["schedules_json"])
    assert [s["schedule_id"] for s in parsed] == ["s1", "s2"]
    assert parsed[0]["cron_schedule"]["human_schedule"] == "minutely"
    assert (a["schedule_frequency_minutely"], a["schedule_frequency_daily"], a["schedule_count"]) == (1, 1, 2)


def test_schedule_keeps_every_field(spark):
    schema = ("dashboard_id string, schedule_id string, display_name string, quartz_cron_expression string, timezone_id string, "
              "pause_status string, etag string, warehouse struct<size: int, id: string>, tags map<string,string>, "
              "cron_schedule struct<note: string, jitter: int>")
    rows = [("d1", f"s{i}", "A", "0 * * * * ?", "UTC", "PAUSED", etag, (2, "w"), {"z": "1", "a": "2"}, ("n", 3))
            for i, etag in ((1, "e1"), (2, "e2"))]
    got = normalize.schedule_summary(spark.createDataFrame(rows, schema)).collect()[0]["schedules_json"]
    want = [{"schedule_id": f"s{i}", "display_name": "A", "pause_status": "PAUSED", "etag": f"e{i}",
             "warehouse": {"size": 2, "id": "w"}, "tags": {"z": "1", "a": "2"},
             "cron_schedule": {"human_schedule": "minutely", "quartz_cron_expression": "0 * * * * ?", "timezone_id": "UTC",
                               "note": "n", "jitter": 3}} for i in (1, 2)]
    assert got == json.dumps(want, sort_keys=True, separators=(",", ":"))
    changed = [r[:6] + ("other",) + r[7:] for r in rows]
    assert normalize.schedule_summary(spark.createDataFrame(changed, schema)).collect()[0]["schedules_json"] != got


def test_dashboard_row_without_serialized_definition(spark):
    raw = json.dumps({"dashboard_id": "d1", "serialized_dashboard": {"b": 1, "a": 2}, "parent_path": "/Users/o/x"})
    df = spark.createDataFrame([("d1", raw, "ok")], "object_id string, raw_json string, status string")
    r = normalize.dashboard_rows(df).collect()[0]
    assert r["serialized_dashboard"] == '{"a":2,"b":1}'
    assert r["dashboard_metadata_json"] == '{"dashboard_id":"d1","parent_path":"/Users/o/x"}'
    assert r["owner"] == "o" and r["schedule_count"] == 0 and r["schedules_json"] is None
    r2 = normalize.dashboard_rows(df, include_serialized_dashboard=False).collect()[0]
    assert r2["serialized_dashboard"] is None and r2["serialized_dashboard_sha256"] is None


@pytest.mark.parametrize("ids,expected", [(" a, b ,,c ", ["a", "b", "c"]), ("", None), (None, None)])
def test_parse_ids(ids, expected):
    from spendscope.sources.landing import parse_ids

    assert parse_ids(ids) == expected


def test_plan_chunks():
    from spendscope.sources.landing import plan_chunks

    assert plan_chunks([], 4) == [[]]
    assert plan_chunks(list(range(5)), 2) == [[0, 1, 2], [3, 4]]
    assert plan_chunks(list(range(3)), 8) == [[0], [1], [2]]


def test_records_without_a_key_are_rejected(spark):
    """An error body or a record without its id never becomes a row."""
    schema = "object_id string, raw_json string, status string"
    spaces = spark.createDataFrame([("a", json.dumps({"error_code": "RATE_LIMITED"}), "ok"),
                                    ("b", json.dumps({"space_id": "", "title": "x"}), "ok"),
                                    ("c", json.dumps({"space_id": "g1"}), "ok")], schema)
    assert [r["space_id"] for r in normalize.space_rows(spaces).collect()] == ["g1"]
    dashboards = spark.createDataFrame([("a", json.dumps({"display_name": "no id"}), "ok"),
                                        ("b", json.dumps({"dashboard_id": "d1"}), "ok")], schema)
    assert [r["dashboard_id"] for r in normalize.dashboard_rows(dashboards).collect()] == ["d1"]
    warehouses = spark.createDataFrame([("a", "{}", "ok"), ("b", json.dumps({"id": "w1"}), "ok")], schema)
    assert [r["id"] for r in normalize.warehouse_rows(warehouses).collect()] == ["w1"]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


def _bucket_spec(expr):
    """The bucket rules, stated in plain Python for the property test."""
    if not expr:
        return "unknown"
    fields = expr.split()
    if len(fields) not in (6, 7):
        return "custom"
    _sec, minute, hour, dom, month, dow = fields[:6]
    any_ = lambda f: f in ("*", "?")
    every = lambda f: f in ("*", "*/1")
    dates_any = any_(dom) and any_(month) and any_(dow)
    if every(minute) and every(hour) and dates_any:
        return "minutely"
    if every(hour) and dates_any:
        return "hourly"
    if dates_any:
        return "daily"
    if not any_(dow) and any_(dom) and any_(month):
        return "weekly"
    if not any_(dom) and any_(month) and any_(dow):
        return "monthly"
    if not any_(dom) and not any_(month) and any_(dow):
        return "yearly"
    return "custom"


_cron_texts = st.lists(st.sampled_from(["*", "?", "*/1", "*/5", "0", "9", "1", "MON", "JAN", "2025"]),
                       min_size=0, max_size=8).flatmap(
    lambda toks: st.sampled_from([" ", "  ", "\t"]).map(lambda sep: sep.join(toks)))


@settings(max_examples=10, deadline=None)
@given(st.lists(_cron_texts, min_size=1, max_size=30))
def test_cron_buckets_match_the_rules(spark_session_for_hypothesis, texts):
    spark = spark_session_for_hypothesis
    df = spark.createDataFrame([(t,) for t in texts], "e string")
    got = [r[0] for r in N.with_cron_frequency(df, "e").select("frequency").collect()]
    assert got == [_bucket_spec(t) for t in texts]


def test_canonical_json_is_ascii_like_pythons(spark):
    """Characters beyond ~ are escaped, also in pairs; backslashes that are text stay."""
    objects = [{"b": "é日😀", "a": "plain"}, {"x": "\x0b\x1f\x7f\n\t", "é": ["ß", None, 1, True]}, {"t": "\\u001F \\\\u000B \" /"},
               {"deep": {"z": "\U0010ffff", "a": {"k": "\u2028"}}}, {"n": "\x00\x1e\\\x0f"}]
    texts = [json.dumps(o, ensure_ascii=False) for o in objects] + [json.dumps(o) for o in objects]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string") \
        .select("i", N.canonical_json("t").alias("c"), N.canonical_json_of_fields(N.json_fields("t")).alias("f")).collect()
    for r in rows:
        want = json.dumps(objects[r["i"] % len(objects)], sort_keys=True, separators=(",", ":"))
        assert r["c"] == want and r["f"] == want


def test_schedules_in_the_shape_of_the_api(spark):
    """The cron text lies in the cron_schedule object; a given human_schedule counts for the
    counts only; flat and nested shapes give the same rows."""
    cron = "quartz_cron_expression string, timezone_id string, human_schedule string"
    given = spark.createDataFrame(
        [("d1", "s1", "A", ("0 0 9 * * ?", "UTC", None)), ("d1", "s2", "é", ("0 0 9 ? * MON", "UTC", "daily")),
         ("d1", "s3", None, (None, None, "whenever")), ("d2", "s4", "B", None)],
        f"dashboard_id string, schedule_id string, display_name string, cron_schedule struct<{cron.replace(' string', ':string')}>")
    counts = {r["dashboard_id"]: r for r in normalize.schedule_frequency_counts(given).collect()}
    assert (counts["d1"]["schedule_frequency_daily"], counts["d1"]["schedule_frequency_weekly"], counts["d1"]["schedule_frequency_unknown"]) == (2, 0, 1)
    assert counts["d2"]["schedule_frequency_unknown"] == 1
    summary = {r["dashboard_id"]: r for r in normalize.schedule_summary(given).collect()}
    assert (summary["d1"]["schedule_frequency_daily"], summary["d1"]["schedule_frequency_weekly"], summary["d1"]["schedule_frequency_unknown"]) == (1, 1, 1)
    assert '"display_name":"\\u00e9"' in summary["d1"]["schedules_json"] and '"human_schedule":"weekly"' in summary["d1"]["schedules_json"]
    nested = given.select("dashboard_id", "schedule_id", "display_name", F.struct("cron_schedule.quartz_cron_expression", "cron_schedule.timezone_id").alias("cron_schedule"))
    flat = given.select("dashboard_id", "schedule_id", "display_name", "cron_schedule.quartz_cron_expression", "cron_schedule.timezone_id")
    assert sorted(map(str, normalize.schedule_summary(nested).collect())) == sorted(map(str, normalize.schedule_summary(flat).collect()))


def test_landing_splits_large_files_and_skips_row_groups(spark, tmp_path):
    """One file becomes as many balanced tasks as asked; explicit ids read only the row groups
    that may hold them; a landing that was filtered once still gives all its rows."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from spendscope.sources import landing

    n = 4000
    table = pa.table({"object_id": [f"k{i:05d}" for i in range(n)], "raw_json": ["{" + "x" * 100 + str(i) + "}" for i in range(n)], "status": ["ok"] * n})
    (tmp_path / "landed").mkdir()
    pq.write_table(table, str(tmp_path / "landed" / "one.parquet"), row_group_size=100)
    options = {"path": str(tmp_path / "landed"), "parallelism": "8", "min_split_bytes": "1000"}
    chunks = landing.LandingReader(options).partitions()
    assert len(chunks) == 8 and {len(c.pieces) for c in chunks} == {5}
    some = landing.LandingReader(options | {"ids": "k00007, k03999,absent"})
    assert sorted(g for c in some.partitions() for _, g in c.pieces) == [[0], [39]]
    assert sum(b.num_rows for c in some.partitions() for b in some.read(c)) == 2
    assert landing.plan_splits([], 4) == [[]]
    assert [[p for p, _ in b] for b in landing.plan_splits([("a", None, 9), ("b", None, 5), ("c", None, 4), ("d", None, 1)], 2)] == [["a", "d"], ["b", "c"]]
    landed = landing.read_landing(spark, options["path"])
    assert landed.where("object_id = 'k00001'").count() == 1 and landed.where("object_id = ''").isEmpty()
    assert landed.count() == n and landing.read_landing(spark, options["path"], ids="k00001").count() == 1
