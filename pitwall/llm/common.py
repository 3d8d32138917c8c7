"""Helpers shared by the corpus operators: tables, shared-folder writes, small-side joins."""

from __future__ import annotations

import ctypes
import sys
import types

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.session import scratch_path

#: A side is broadcast only after a count shows at most this many (narrow) rows.
BROADCAST_ROWS = 1_000_000

#: Rows of an Arrow batch that goes to Python (a smaller setting of the session stays).
BATCH_ROWS = 1000
_HOLDER = "_pitwall_worker_cache"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship() -> None:
    """Pickle the functions of this subpackage by value, so executors need no copy of it, and
    bound the rows of an Arrow batch: whole texts are in it, in the JVM and again in Python."""
    session = SparkSession.getActiveSession()
    if session is not None and int(session.conf.get(_BATCH)) > BATCH_ROWS:
        session.conf.set(_BATCH, BATCH_ROWS)
    for name, module in list(sys.modules.items()):
        if name.startswith("pitwall.llm.") and module is not None:
            cloudpickle.register_pickle_by_value(module)


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut there, and a
    lost executor costs only the tasks that read the table."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held(documents: DataFrame) -> DataFrame:
    """The rows as one struct column ``row``: whatever the columns of ``documents`` are called, none
    meets a name in here.  ``released`` gives them back."""
    names = ["`" + c.replace("`", "``") + "`" for c in documents.columns]
    return documents.select(F.struct(*names).alias("row"))


def released(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows; larger sides are shuffled."""
    return F.broadcast(df) if df.count() <= limit else df


def worker_cache(name: str) -> dict:
    """A dict that lives in the Python worker process until a task of another operator begins there
    (results never depend on it)."""
    drop_caches(name)
    holder = sys.modules.setdefault(_HOLDER, types.ModuleType(_HOLDER))
    return holder.__dict__.setdefault("held", {}).setdefault(name, {})


def drop_caches(keep: str | None = None) -> None:
    """Free what tasks of other operators than ``keep`` hold in this worker: Spark gives a worker on
    from task to task, and its memory counts against whatever runs next."""
    held = getattr(sys.modules.get(_HOLDER), "held", {})
    others = [name for name in held if name != keep]
    for name in others:
        del held[name]
    if others:  # Arrow and the C library keep freed pages otherwise
        pa.default_memory_pool().release_unused()
        getattr(ctypes.CDLL(None), "malloc_trim", int)(0)


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` of an operator or step that keeps nothing in its workers."""
    def started(batches):
        drop_caches()
        yield from run(batches)

    return df.mapInArrow(started, schema)
