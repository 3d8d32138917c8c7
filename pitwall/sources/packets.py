"""Packet sources and the packet encoder (S1-S4, K4 framing).

Kafka needs the connector on the cluster's classpath; the deployer supplies a
version matching Spark.  File directories are the same contract for tests and
replays: one row per packet, ``car_id, track_id, seq, json``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.schema import WIRE_KEYS



def encode_packets(tel: DataFrame, ts_unit: str = "ns") -> DataFrame:
    """Telemetry rows to wire packets (JSON body, NULL keys omitted as on the wire).

    The fixture's ``timestamp`` is in microseconds; the wire carries ``ts_unit``.
    """
    ts = F.col("timestamp")
    if ts_unit == "ns":
        ts = ts * F.lit(1000)
    elif ts_unit == "ms":
        ts = F.floor(ts / 1000).cast("long")
    elif ts_unit == "s":
        ts = F.floor(ts / 1000000).cast("long")
    body = F.struct(*[(ts if k == "timestamp" else F.col(k)).alias(k) for k in WIRE_KEYS])
    return tel.select("car_id", "track_id", "seq", F.to_json(body).alias("json"))


def kafka_options(bootstrap: str, topic: str, starting: str = "latest", max_offsets: int | None = 10000,
                  group: str | None = None) -> dict[str, str]:
    """Subscribe one topic; the admission cap is set on the source itself."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    if group:
        opts["kafka.group.id"] = group
    return opts


def kafka_packets(spark: SparkSession, bootstrap: str, topic: str, streaming: bool = True, **kw) -> DataFrame:
    """S1 (streaming, ``latest``) / S2 (replay, pass ``starting='earliest'``).

    See ``packets_of_records`` for the message key.
    """
    reader = spark.readStream if streaming else spark.read
    tags = {k: kw.pop(k) for k in ("default_car", "default_track") if k in kw}
    if not streaming:
        kw["max_offsets"] = None  # batch reads take the whole offset range
    return packets_of_records(reader.format("kafka").options(**kafka_options(bootstrap, topic, **kw)).load(), **tags)


def packets_of_records(raw: DataFrame, default_car: int = 0, default_track: str = "unknown") -> DataFrame:
    """Packets from topic records ``key, value, offset``.

    The key carries ``car_id|track_id``; a record without a key (as a single car's
    transmitter sends them) or without a numeric car gets the default tags.  Car ids are
    LONG in every table of this package.  The offset orders a car's packets.
    """
    key = F.split(F.col("key").cast("string"), r"\|")
    return raw.select(
        F.coalesce(F.get(key, F.lit(0)).try_cast("long"), F.lit(default_car).cast("long")).alias("car_id"),
        F.coalesce(F.get(key, F.lit(1)), F.lit(default_track)).alias("track_id"),
        F.col("offset").alias("seq"),
        F.col("value").cast("string").alias("json"),
    )


def file_packets(spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = True,
                 max_files: int | None = None) -> DataFrame:
    """Packets from files (the test and replay stand-in for a topic)."""
    schema = "car_id long, track_id string, seq long, json string"
    if streaming:
        r = spark.readStream.schema(schema).format(fmt)
        if max_files:
            r = r.option("maxFilesPerTrigger", str(max_files))
        return r.load(path)
    return spark.read.schema(schema).format(fmt).load(path)


def write_packets_kafka(packets: DataFrame, bootstrap: str, topic: str) -> None:
    """K4: publish stored packets (replay) as key/value records."""
    (
        packets.select(
            F.concat_ws("|", F.col("car_id").cast("string"), F.col("track_id")).alias("key"),
            F.col("json").alias("value"),
        )
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .save()
    )
