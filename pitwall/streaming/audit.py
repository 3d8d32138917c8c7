"""What a windowed stream did with every delivered packet: emitted, still in state, or dropped as late.

Spark counts dropped rows after its partial aggregation, that is groups and not packets, and nobody is told of
them.  Here packets are accounted for from three sides: the rows read (the query's progress), the counts in
the windows that were emitted, and the counts in the windows still open, which the
``statestore`` reader takes from the checkpoint.  What is in none of the last two was dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ACCOUNT = "delivery int, delivered long, emitted long, in_state long, dropped long, groups_dropped long"


def delivered(query) -> tuple[int, int]:
    """``(packets read, groups dropped as late)`` of a finished run, from the progress of its batches."""
    progress = query.recentProgress
    if progress and progress[-1].batchId - progress[0].batchId + 1 != len({p.batchId for p in progress}):
        raise ValueError("progress of some batches is no longer kept: raise spark.sql.streaming.numRecentProgressUpdates")
    return (sum(p.numInputRows for p in progress),
            sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators))


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``car_id, window_start_us, window_end_us, samples`` of the windows that a ``window_agg_stream`` holds
    after its last batch.  Its count is the first aggregate, so it is the value's first field."""
    state = spark.read.format("statestore").load(checkpoint)
    # the aggregates' fields may share names: they are told apart by place
    fields = state.schema["value"].dataType.fields
    named = ", ".join(f"f{i}: {f.dataType.simpleString()}" for i, f in enumerate(fields))
    return state.select("key.car_id", F.unix_micros("key.window.start").alias("window_start_us"),
                        F.unix_micros("key.window.end").alias("window_end_us"),
                        F.col("value").cast(f"struct<{named}>")["f0"].alias("samples"))


def groups_in_state(spark: SparkSession, checkpoint: str) -> int:
    """Groups that a stateful query holds after its last batch."""
    return spark.read.format("statestore").load(checkpoint).count()


def account(spark: SparkSession, delivery: int, before: list[tuple], query, checkpoint: str, emitted: DataFrame) -> tuple:
    """One row of ``ACCOUNT`` (all but ``groups_dropped`` cumulative) after a delivery has been processed."""
    read, groups = delivered(query)
    total = read + (before[-1][1] if before else 0)
    out = emitted.agg(F.sum("samples")).first()[0] or 0
    held = open_windows(spark, checkpoint).agg(F.sum("samples")).first()[0] or 0
    return delivery, total, out, held, total - out - held, groups
