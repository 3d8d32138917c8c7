"""Inline edge packets (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

from pitwall.operators import clean as C

PACKETS = {
    "empty": "{}",
    "partial": '{"timestamp":1,"speed_kmh":5.0}',
    "null": '{"timestamp":1,"rpm":null}',
    "float_rpm": '{"timestamp":1,"rpm":11234.5}',
    "wrong_type": '{"timestamp":1,"speed_kmh":"x"}',
    "nan": '{"timestamp":1,"lap_count":1,"speed_kmh":NaN}',
    "not_json": "not json",
    "unknown": '{"timestamp":1,"extra":1}',
}


def _raw(spark):
    rows = [(1, "trk", i, j) for i, j in enumerate(PACKETS.values())]
    return spark.createDataFrame(rows, "car_id long, track_id string, seq long, json string")


def _by_seq(df):
    names = list(PACKETS)
    return {names[r.seq]: r for r in df.collect()}


def test_quarantine_reasons(spark):
    q = _by_seq(C.quarantine(_raw(spark)))
    assert set(q) == {"empty", "wrong_type", "not_json"}
    assert q["empty"].reasons == ["missing_timestamp"]
    assert q["wrong_type"].reasons == ["bad_type:speed_kmh"]
    assert q["not_json"].reasons == ["malformed_json"]


def test_decode_keeps_nan_and_float_rpm(spark):
    d = _by_seq(C.valid_packets(_raw(spark), ts_unit="us"))
    assert d["nan"].speed_kmh != d["nan"].speed_kmh  # NaN survives decoding
    assert d["float_rpm"].rpm == 11234.5
    assert d["partial"].lap_count is None


def test_archive_defaults_and_rejects(spark):
    a = _by_seq(C.archive_points(_raw(spark), keep_seq=True))
    assert a["partial"].speed_kmh == 5.0 and a["partial"].rpm == 0 and a["partial"].gear == 0
    assert a["float_rpm"].rpm == 11234 and a["float_rpm"].time == 1
    assert set(a) == {"partial", "float_rpm", "nan", "unknown"}
    assert a["nan"].speed_kmh != a["nan"].speed_kmh
    rej = _by_seq(C.archive_rejects(_raw(spark)))
    assert set(rej) == {"empty", "null", "wrong_type", "not_json"}
    assert rej["null"].reasons == ["unusable:rpm"]


def test_schema_violations(spark):
    v = C.schema_violations(_raw(spark)).collect()
    names = list(PACKETS)
    unknown = {(names[r.seq], r.key) for r in v if r.kind == "unknown"}
    assert unknown == {("unknown", "extra")}
    missing = {names[r.seq] for r in v if r.kind == "missing"}
    assert "not_json" not in missing and "empty" in missing


def test_timestamp_units(spark):
    raw = spark.createDataFrame(
        [(1, "t", 0, '{"timestamp":1764768000123456789}'), (1, "t", 1, '{"timestamp":1764768000123}')],
        "car_id long, track_id string, seq long, json string",
    )
    ns = C.decode_packets(raw.filter("seq = 0"), "ns").first().event_time
    ms = C.decode_packets(raw.filter("seq = 1"), "ms").first().event_time
    base = dt.datetime(2025, 12, 3, 13, 20, 0)
    assert ns.replace(tzinfo=None) == base.replace(microsecond=123456)
    assert ms.replace(tzinfo=None) == base.replace(microsecond=123000)


def test_geojson_waypoints_and_projection(spark):
    import json

    from pitwall.operators.track import project_lonlat
    from pitwall.session import scratch_path
    from pitwall.sources.tracks import geojson_waypoints

    path = scratch_path(spark, "geojson")
    import os

    os.makedirs(path, exist_ok=True)
    coords = [[-1.0, 52.0], [-0.99, 52.0], [-0.99, 52.01], [-1.0, 52.01]]
    doc = {"type": "FeatureCollection", "name": "square",
           "features": [{"type": "Feature", "properties": {"Name": "Test Ring"},
                         "geometry": {"type": "LineString", "coordinates": coords}}]}
    with open(f"{path}/square.geojson", "w") as f:
        json.dump(doc, f)
    wp = geojson_waypoints(spark, f"{path}/square.geojson")
    rows = sorted((r.track_id, r.name, r.pos, r.lon, r.lat) for r in wp.collect())
    assert rows[0] == ("square", "Test Ring", 0, -1.0, 52.0) and len(rows) == 4
    p = {r.pos: (r.x, r.y) for r in project_lonlat(wp).collect()}
    assert abs(p[0][0] + p[1][0]) < 1e-6 and abs(p[0][1] + p[2][1]) < 1e-6  # centred on the mean
