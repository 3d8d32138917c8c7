"""D6 on streams: every micro-batch split into valid rows and rejected packets, and rejected ones repaired and replayed.

A batch becomes visible as a whole: rejected packets are written first, valid rows second and a
commit row with the counts last, each in a folder of the batch id.  Readers take committed batches alone.
A crash between the writes leaves folders that nobody reads; the replayed batch holds the same
packets and overwrites them.

A rejected packet keeps its text, the reasons, where it came from (``origin``) and how often it has been
tried (``attempt``).  ``replay`` repairs what it can and hands it to the source again; ``origin`` stays, so a
packet that is handed over twice is known by it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pitwall.operators import clean as C

PACKETS = "car_id long, track_id string, seq long, json string, origin string, attempt int"
REJECTED = "car_id long, track_id string, seq long, origin string, attempt int, json string, reasons array<string>"
COMMITS = "delivered long, valid long, rejected long"


def packet_files(spark: SparkSession, path: str) -> DataFrame:
    """Packets from files as a stream.  The origin of a packet is its file and row, if it names none."""
    raw = spark.readStream.schema(PACKETS).parquet(path)
    place = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
    return raw.select("car_id", "track_id", "seq", "json", F.coalesce("origin", place).alias("origin"),
                      F.coalesce("attempt", F.lit(0)).alias("attempt"))


def split_writer(path: str, ts_unit: str = "ns", after_rejected: Callable[[int], None] | None = None):
    """foreachBatch writer; ``after_rejected(batch_id)`` is called between the two writes (for tests)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        folder = f"batch_id={batch_id}"
        rejected = C.quarantine(batch.observe(seen, F.count(F.lit(1)).alias("delivered")))
        rejected.write.mode("overwrite").parquet(f"{path}/rejected/{folder}")
        if after_rejected is not None:
            after_rejected(batch_id)
        C.valid_packets(batch, ts_unit).write.mode("overwrite").parquet(f"{path}/valid/{folder}")
        # the counts of what stands there come from the files' footers
        counts = [spark.read.parquet(f"{path}/{kind}/{folder}").count() for kind in ("valid", "rejected")]
        (spark.createDataFrame([(seen.get["delivered"], *counts)], COMMITS).coalesce(1)
         .write.mode("overwrite").parquet(f"{path}/commits/{folder}"))

    return write


def commits(spark: SparkSession, path: str) -> DataFrame:
    """``delivered, valid, rejected, batch_id`` of every batch that is visible."""
    return spark.read.schema(f"{COMMITS}, batch_id long").parquet(f"{path}/commits")


def committed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """``valid`` rows or ``rejected`` packets of all visible batches, with their ``batch_id``.  A packet that was
    handed over twice (same origin and attempt) counts once."""
    rows = spark.read.option("basePath", f"{path}/{kind}").parquet(f"{path}/{kind}")
    return (rows.join(commits(spark, path).select("batch_id"), "batch_id", "left_semi")
            .dropDuplicates(["origin", "attempt"]))


def replay(spark: SparkSession, path: str, repair: Callable[[Column, Column], Column], inbox: str,
           attempts: int = 3) -> int:
    """Hands rejected packets to the source folder again for which ``repair(json, reasons)`` gives another text.

    Each batch's rejects are replayed once (a marker is written after its packets); a packet that has
    been tried ``attempts`` times stays rejected.  Gives the number of batches replayed.
    """
    done = commits(spark, path).select("batch_id")
    marks = f"{path}/replayed"
    try:
        done = done.join(spark.read.schema("packets long, batch_id long").parquet(marks), "batch_id", "left_anti")
    except Exception as e:  # noqa: BLE001 - nothing has been replayed yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    todo = sorted(r["batch_id"] for r in done.collect())
    rejected = committed(spark, path, "rejected")
    for batch_id in todo:
        bad = rejected.where(F.col("batch_id") == batch_id).withColumn("fixed", repair(F.col("json"), F.col("reasons")))
        bad = bad.where(F.col("fixed").isNotNull() & (F.col("fixed") != F.col("json")) & (F.col("attempt") + 1 < attempts))
        again = bad.select("car_id", "track_id", "seq", F.col("fixed").alias("json"), "origin",
                           (F.col("attempt") + 1).cast("int").alias("attempt"))
        again.write.mode("overwrite").parquet(f"{inbox}/replay={batch_id:06d}")
        n = spark.read.parquet(f"{inbox}/replay={batch_id:06d}").count()
        spark.createDataFrame([(n,)], "packets long").coalesce(1).write.mode("overwrite").parquet(f"{marks}/batch_id={batch_id}")
    return len(todo)
