"""Decode, validate and clean raw telemetry packets.

A raw packet table has ``car_id, track_id, seq, json`` (the car and track travel
in the message key or path; the JSON body is the wire packet).  Decoding parses the
body twice in one projection: typed by the fixed wire schema (partial results: a
field of the wrong type becomes NULL, the rest survives) and as
``map<string,string>`` to tell a missing key from an explicit ``null``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.schema import ARCHIVE_FIELDS, LAP_RESULT_SCHEMA, LAP_SUMMARY_COLUMNS, PACKET_SCHEMA, WIRE_KEYS

TS_UNITS = ("ns", "us", "ms", "s")
# Columns of a packet beside its text that are kept where there are any.
RAW_COLUMNS = ["car_id", "track_id", "seq", "origin", "attempt"]
INT32_MAX = 2147483647.0


def event_time(ts, unit: str = "ns") -> Column:
    """Epoch integer in ``unit`` to TIMESTAMP (exact integer arithmetic for ns)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if unit == "ns":
        return F.timestamp_micros(floor_div(c, 1000))
    if unit == "us":
        return F.timestamp_micros(c)
    if unit == "ms":
        return F.timestamp_millis(c)
    if unit == "s":
        return F.timestamp_seconds(c)
    raise ValueError(f"unit must be one of {TS_UNITS}")


def floor_div(c: Column, n: int) -> Column:
    """Floor division of a LONG without a detour through DOUBLE (ns epochs exceed 2^53)."""
    c, by = c.cast("long"), F.lit(n).cast("long")
    return F.call_function("div", c - F.pmod(c, by), by)


def parse_packets(raw: DataFrame, json_col: str = "json", with_map: bool = True) -> DataFrame:
    """Add ``_p`` (typed struct) and, unless it isn't needed, ``_m`` (raw key/value map).

    Both parses come out of an ``inline`` generator: its outputs are new attributes,
    so a later filter on the validation result cannot be pushed below it with the
    JSON parse inlined into every reference (one parse per row, not one per use).
    """
    parts = [F.from_json(F.col(json_col), PACKET_SCHEMA).alias("_p")]
    if with_map:
        parts.append(F.from_json(F.col(json_col), "map<string,string>").alias("_m"))
    parsed = F.struct(*parts)
    return raw.select("*", F.inline(F.array(parsed)))


def _keep(raw: DataFrame) -> list[str]:
    return [c for c in RAW_COLUMNS if c in raw.columns]


def decode_packets(raw: DataFrame, ts_unit: str = "ns", json_col: str = "json") -> DataFrame:
    """D1 + D7 + D8: raw packets to telemetry rows (``car_id, track_id, seq, event_time`` + 17 keys)."""
    p = parse_packets(raw, json_col, with_map=False)
    return p.select(
        *_keep(raw),
        event_time(F.col("_p.timestamp"), ts_unit).alias("event_time"),
        *[F.col(f"_p.{k}").alias(k) for k in WIRE_KEYS],
    )


def _value(key: str) -> Column:
    """A key's value: as parsed, or, where the parse failed, numeric text and whole floats
    converted to the wire type."""
    wire, parsed = PACKET_SCHEMA[key].dataType, F.col(f"_p.{key}")
    if not isinstance(wire, T.NumericType):
        return parsed
    number = F.col("_m")[key].try_cast("double")
    if isinstance(wire, T.IntegralType):
        number = F.when(number == F.floor(number), number)
    return F.coalesce(parsed, number.try_cast(wire))


def _problems(ts_required: bool = True) -> Column:
    """Array of reasons a parsed packet cannot be used (empty when clean)."""
    m, p = F.col("_m"), F.col("_p")
    reasons = [F.when(m.isNull(), F.lit("malformed_json"))]
    if ts_required:
        reasons.append(F.when(m.isNotNull() & p["timestamp"].isNull(), F.lit("missing_timestamp")))
    for k in WIRE_KEYS:
        bad = F.map_contains_key(m, k) & m[k].isNotNull() & _value(k).isNull()
        reasons.append(F.when(bad, F.lit(f"bad_type:{k}")))
    return F.array_compact(F.array(*reasons))


def quarantine(raw: DataFrame, json_col: str = "json") -> DataFrame:
    """Packets that cannot be decoded, with every reason (malformed, no timestamp, bad type)."""
    p = parse_packets(raw, json_col).withColumn("reasons", _problems())
    return p.filter(F.size("reasons") > 0).select(*_keep(raw), F.col(json_col).alias("json"), "reasons")


def valid_packets(raw: DataFrame, ts_unit: str = "ns", json_col: str = "json") -> DataFrame:
    """The complement of ``quarantine``, decoded."""
    p = parse_packets(raw, json_col).filter(F.size(_problems()) == 0)
    return p.select(
        *_keep(raw),
        event_time(F.col("_p.timestamp"), ts_unit).alias("event_time"),
        *[_value(k).alias(k) for k in WIRE_KEYS],
    )


def schema_violations(raw: DataFrame, json_col: str = "json", expected: list[str] | None = None) -> DataFrame:
    """One row per unknown key and per missing expected key of a packet."""
    exp = F.array(*[F.lit(k) for k in (expected or WIRE_KEYS)])
    p = parse_packets(raw, json_col).filter(F.col("_m").isNotNull())
    keys = F.map_keys("_m")
    both = F.concat(
        F.transform(F.array_except(keys, exp), lambda k: F.struct(k.alias("key"), F.lit("unknown").alias("kind"))),
        F.transform(F.array_except(exp, keys), lambda k: F.struct(k.alias("key"), F.lit("missing").alias("kind"))),
    )
    return p.select(*_keep(raw), F.explode(both).alias("v")).select(*_keep(raw), "v.key", "v.kind")


def archive_points(
    raw: DataFrame,
    json_col: str = "json",
    default_tags: dict[str, object] | None = None,
    keep_seq: bool = False,
) -> DataFrame:
    """Archive rows with defaults for *missing* keys.

    A packet without a timestamp is skipped; an explicit ``null``, a value that is no
    number (numeric text is one) or a non-finite integer field makes the packet unusable (it
    goes to ``archive_rejects``).  Integers truncate toward zero.
    """
    ok, _ = _archive_split(raw, json_col, default_tags, keep_seq)
    return ok


def archive_rejects(raw: DataFrame, json_col: str = "json", default_tags: dict[str, object] | None = None) -> DataFrame:
    _, bad = _archive_split(raw, json_col, default_tags)
    return bad


def _archive_split(raw: DataFrame, json_col: str, default_tags: dict[str, object] | None, keep_seq: bool = False):
    tags = {"car_id": "unknown", "track_id": "unknown", **(default_tags or {})}
    p = parse_packets(raw, json_col)
    m, pk = F.col("_m"), F.col("_p")
    fields, errors = [], []
    for name, typ, default in ARCHIVE_FIELDS:
        present = F.map_contains_key(m, name)
        v = F.coalesce(pk[name].cast("double"), m[name].try_cast("double"))
        if typ == "int":
            finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(INT32_MAX))
            val = F.when(finite, v.cast("int"))
            errors.append(F.when(present & ~finite, F.lit(f"unusable:{name}")))
        else:
            val = v
            errors.append(F.when(present & v.isNull(), F.lit(f"unusable:{name}")))
        fields.append(F.when(~present, F.lit(default).cast(typ)).otherwise(val).alias(name))
    errors.append(F.when(m.isNull(), F.lit("malformed_json")))
    errors.append(F.when(m.isNotNull() & pk["timestamp"].isNull(), F.lit("missing_timestamp")))
    # an unkeyed message has no tags of its own
    tag_cols = [
        (F.coalesce(F.col(t), F.lit(tags[t]).try_cast(raw.schema[t].dataType)) if t in raw.columns else F.lit(tags[t])).alias(t)
        for t in ("car_id", "track_id")
    ]
    d = p.select(
        *tag_cols,
        *[c for c in ["seq"] if c in raw.columns],
        pk["timestamp"].alias("time"),
        *fields,
        F.array_compact(F.array(*errors)).alias("reasons"),
        F.col(json_col).alias("_json"),
    )
    drop_seq = [] if keep_seq else [c for c in ["seq"] if c in raw.columns]
    ok = d.filter(F.size("reasons") == 0).drop("reasons", "_json", *drop_seq)
    bad = d.filter(F.size("reasons") > 0).select(*[c for c in ["car_id", "track_id", "seq"] if c in d.columns],
                                                    F.col("_json").alias("json"), "reasons")
    return ok, bad


def lap_json(laps: DataFrame) -> DataFrame:
    """P4 + K1 framing: ``key`` = car|lap, ``value`` = the lap row as JSON (NULL fields omitted)."""
    return laps.select(
        "car_id",
        "lap_count",
        F.concat_ws("|", F.col("car_id").cast("string"), F.col("lap_count").cast("string")).alias("key"),
        F.to_json(F.struct("car_id", *LAP_SUMMARY_COLUMNS)).alias("value"),
    )


def decode_lap_json(rows: DataFrame, value_col: str = "value") -> DataFrame:
    """S3: lap result JSON back to typed columns (a car id written as text is one too)."""
    keep = [c for c in rows.columns if c not in (value_col, "car_id", "lap_count", "key")]
    wire = T.StructType([T.StructField("car_id", T.StringType())]
                        + [f for f in LAP_RESULT_SCHEMA.fields if f.name != "car_id"])
    r = rows.select(*keep, F.from_json(F.col(value_col).cast("string"), wire).alias("_r")).select(*keep, "_r.*")
    return r.withColumn("car_id", F.col("car_id").try_cast("long"))
