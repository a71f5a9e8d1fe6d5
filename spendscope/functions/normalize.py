"""Column normalizers for snapshot rows (built-in expressions only).

They re-express per-object Python normalization as Spark column
expressions, so a snapshot of millions of objects is normalized inside
whole-stage codegen without a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source system's: the eight schedule
# frequency buckets, in this order.
FREQ_BUCKETS = ("minutely", "hourly", "daily", "weekly", "monthly", "yearly", "custom", "unknown")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------- B1
def coerce_timestamp_number(x: Column | str) -> Column:
    """Epoch number → TIMESTAMP_NTZ (UTC wall clock): above 1e12 it is
    milliseconds, otherwise seconds (fractions kept to the microsecond)."""
    v = _c(x).cast("double")
    micros = F.when(v > 1e12, v * 1000).otherwise(v * 1000000)
    return F.timestamp_micros(F.floor(micros).cast("bigint")).cast("timestamp_ntz")


def coerce_timestamp_text(x: Column | str) -> Column:
    """ISO text → TIMESTAMP_NTZ.  Blank or unparsable → NULL; a zone
    offset (``Z``, ``+02:00``) is dropped, not applied: the wall clock is kept."""
    s = F.trim(_c(x))
    no_zone = F.regexp_replace(s, r"(Z|[+-][0-9]{2}:?[0-9]{2})$", "")
    full_date = s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}")  # a year or a month alone is no timestamp
    return F.when(full_date, no_zone.try_cast("timestamp_ntz"))


_NUMERIC_VARIANT = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"


def coerce_timestamp_variant(value: Column | str) -> Column:
    """B1 on a variant value (epoch number or ISO text)."""
    v = _c(value)
    is_number = F.schema_of_variant(v).rlike(_NUMERIC_VARIANT)
    return F.when(is_number, coerce_timestamp_number(F.try_variant_get(v, "$", "double"))).otherwise(
        coerce_timestamp_text(F.try_variant_get(v, "$", "string"))
    )


def variant_text(value: Column | str, path: str = "$") -> Column:
    """Text of a variant field: strings as is, other values as JSON text."""
    return F.try_variant_get(_c(value), path, "string")


def json_fields(raw: Column | str) -> Column:
    """Top-level JSON object → ``map<string, variant>``, parsed once
    (malformed or non-object → NULL)."""
    return F.from_json(_c(raw), "map<string,variant>")


def canonical_json_of_fields(fields: Column | str, drop: tuple[str, ...] = ()) -> Column:
    """Canonical JSON text of a parsed object, optionally without some keys.
    Variant values render their nested objects key-sorted; the top level is
    sorted here, so no second parse is needed."""
    m = _c(fields)
    if drop:
        m = F.map_filter(m, lambda k, _v: ~k.isin(*drop))
    by_key = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
    return ascii_json(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m), by_key))))


def variant_list_size(value: Column | str, path: str) -> Column:
    """Length of an array at ``path``, else 0."""
    arr = F.try_variant_get(_c(value), path, "array<variant>")
    return F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr))


def variant_list_or_dict_size(value: Column | str, path: str) -> Column:
    """Length of an array, or number of keys of an object, at ``path``; else 0."""
    arr = F.try_variant_get(_c(value), path, "array<variant>")
    obj = F.try_variant_get(_c(value), path, "map<string,variant>")
    return F.when(arr.isNotNull(), F.size(arr)).when(obj.isNotNull(), F.size(obj)).otherwise(F.lit(0))


# ---------------------------------------------------------------------- B2/B3
def _escape(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))


def ascii_json(text: Column | str) -> Column:
    """JSON text in plain ASCII: characters beyond ``~`` as ``\\uXXXX`` (a surrogate pair
    beyond U+FFFF), hex digits in lower case throughout.  Equal to the text where it
    holds neither such a character nor an escaped control character."""
    def one(c: Column) -> Column:
        code = F.ascii(c)
        above = code - F.lit(0x10000)
        pair = F.concat(_escape(F.lit(0xD800) + F.shiftright(above, 10)), _escape(F.lit(0xDC00) + above.bitwiseAND(F.lit(0x3FF))))
        return F.when(code <= 0x7E, c).when(code <= 0xFFFF, _escape(code)).otherwise(pair)

    def escaped(t: Column) -> Column:
        plain = F.when(t.rlike(r"[^\x00-\x7E]"), F.array_join(F.transform(F.split(t, ""), one), "")).otherwise(t)
        # control characters come escaped already, in upper case; an even number of backslashes before is text
        lowered = plain
        for code in ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F"):
            lowered = F.regexp_replace(lowered, rf"(?<!\\)((?:\\\\)*)\\u00{code}", rf"$1\\u00{code.lower()}")
        return F.when(t.contains("\\u00"), lowered).otherwise(plain)

    # bound by a lambda, so that the text is built once
    return F.get(F.transform(F.array(_c(text)), escaped), F.lit(0))


def canonical_json(x: Column | str) -> Column:
    """Key-sorted, compact, ASCII JSON text of a JSON string (malformed → NULL)."""
    return ascii_json(F.to_json(F.try_parse_json(_c(x))))


def sha256_hex(x: Column | str, empty_is_null: bool = True) -> Column:
    """SHA-256 hex of the UTF-8 text; NULL (and, by default, empty) → NULL."""
    h = F.sha2(_c(x), 256)
    return F.when(F.length(_c(x)) > 0, h) if empty_is_null else h


# ---------------------------------------------------------------------- B4
def owner_from_path(parent_path: Column | str) -> Column:
    """``/Users/<owner>/...`` → ``<owner>``; ``/Users/`` alone → ''; other → NULL."""
    p = _c(parent_path)
    return F.when(p.startswith("/Users/"), F.split_part(p, F.lit("/"), F.lit(3)))


# ---------------------------------------------------------------------- B5
_WS = " \t\n\r\f\u000b"


def cron_fields(expr: Column | str) -> Column:
    """Whitespace-separated fields of a cron text (empty array for blank)."""
    t = F.btrim(_c(expr), F.lit(_WS))
    return F.when(F.length(t) > 0, F.split(t, r"\s+")).otherwise(F.array().cast("array<string>"))


def cron_frequency_of_fields(expr: Column | str, fields: Column | str) -> Column:
    """Bucket from the text and its pre-split fields (split once, see
    :func:`with_cron_frequency`)."""
    e, parts = _c(expr), _c(fields)
    n = F.size(parts)
    minute, hour, dom, month, dow = (F.try_element_at(parts, F.lit(i)) for i in range(2, 7))

    def any_(c: Column) -> Column:
        return c.isin("*", "?")

    def every(c: Column) -> Column:
        return c.isin("*", "*/1")

    dates_any = any_(dom) & any_(month) & any_(dow)
    return (
        F.when(e.isNull() | (F.length(e) == 0), "unknown")
        .when(~n.isin(6, 7), "custom")
        .when(every(minute) & every(hour) & dates_any, "minutely")
        .when(every(hour) & dates_any, "hourly")
        .when(dates_any, "daily")
        .when(~any_(dow) & any_(dom) & any_(month), "weekly")
        .when(~any_(dom) & any_(month) & any_(dow), "monthly")
        .when(~any_(dom) & ~any_(month) & any_(dow), "yearly")
        .otherwise("custom")
    )


def cron_frequency(expr: Column | str) -> Column:
    """Quartz cron → frequency bucket (seconds and the year field ignored).

    NULL/empty → unknown; not 6 or 7 whitespace-separated fields → custom;
    then, in order: minutely, hourly, daily, weekly, monthly, yearly, custom.
    """
    return cron_frequency_of_fields(expr, cron_fields(expr))


def with_cron_frequency(df, expr: str, out: str = "frequency"):
    """Add the bucket column, splitting the text once per row (the split
    lives in its own projection instead of being re-evaluated per branch)."""
    tmp = f"__{out}_fields"
    return df.withColumn(tmp, cron_fields(expr)).withColumn(out, cron_frequency_of_fields(expr, tmp)).drop(tmp)


# ---------------------------------------------------------------------- B11
def safe_int(x: Column | str) -> Column:
    """Integer or NULL (bad text → NULL, never an error)."""
    return _c(x).try_cast("int")


# ---------------------------------------------------------------------- JSON field access
def truthy_text(variant: Column | str, path: str) -> Column:
    """``str(x) if x else None`` for a JSON field: missing, null, '', 0, false,
    [] and {} are falsy."""
    v = _c(variant)
    t = F.schema_of_variant(F.variant_get(v, path, "variant"))
    s = F.try_variant_get(v, path, "string")
    falsy = (
        s.isNull()
        | (t == "NULL")
        | ((t == "STRING") & (s == ""))
        | ((t == "BOOLEAN") & (s == "false"))
        | (t.rlike(_NUMERIC_VARIANT) & (F.try_variant_get(v, path, "double") == 0))
        | (t.startswith("ARRAY") & (F.json_array_length(F.to_json(F.variant_get(v, path, "variant"))) == 0))
        | (t.startswith("OBJECT") & (F.to_json(F.variant_get(v, path, "variant")) == "{}"))
    )
    return F.when(~falsy, s)



