from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from pitwall.schema import WIRE_FIELDS

TEL_SCHEMA = T.StructType(
    [
        T.StructField("car_id", T.LongType()),
        T.StructField("track_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
    ]
    + [T.StructField(n, t) for n, t in WIRE_FIELDS]
)

EPOCH = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def make_tel(spark, rows: list[dict]):
    """Telemetry rows from dicts; ``t`` (seconds) sets event_time/timestamp, seq defaults to order."""
    out = []
    for i, r in enumerate(rows):
        r = dict(r)
        t = r.pop("t", float(i))
        rec = {"car_id": 1, "track_id": "trk", "seq": i, "event_time": EPOCH + dt.timedelta(seconds=t),
               "timestamp": int(t * 1e6)}
        rec.update(r)
        out.append(tuple(rec.get(f.name) for f in TEL_SCHEMA.fields))
    return spark.createDataFrame(out, TEL_SCHEMA)
