"""Token counts of flat token files that have no index, from their end-of-document ids.

A flat file is nothing but ids of a fixed width, big-endian, with the end id after each
document; documents may run on from one file to the next (in the order of the paths).
Each file is searched in blocks of about a million ids with one vectorised comparison.  A
block keeps where it found separators; a prefix scan over the blocks' sums, first within a
file and then over the files, gives each block the documents and ids before it and where
its first document began, however many blocks before.

Defined cases: an empty file and a folder without files count nothing; ids after the last
separator are one more document with ``ended`` false; two separators in a row are a document
of one id, its end id (which is what a null or empty text gives).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import save, ship, table
from pitwall.llm.tokens import encoded, tokenizer_json, vocabulary_size
from pitwall.session import scratch_path

BLOCK_IDS = 1 << 20
#: The end id of the default vocabulary, which no text yields.
END_ID = 50256


def width_of(spec: str, end_id: int) -> int:
    return 2 if max(vocabulary_size(spec), end_id + 1) <= 1 << 16 else 4


def _flat(spec, end_id: int, width: int):
    def run(batches):
        for batch in batches:
            out = []
            for _, ids in encoded(batch.column("text"), spec.value):
                # the end id's last byte is written as Spark's line separator
                out.append(np.append(ids, np.uint32(end_id)).astype(f">u{width}").tobytes()[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    return run


def write_flat(documents: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> int:
    """Write every text's ids and ``end_id`` as flat files; gives the width of an id in bytes.

    Spark's text writer puts the bytes of each row and a separator into any file system it
    knows, with the usual commit of whole files.  The separator is the last byte of the end
    id, so the file holds ids alone; that byte must be below 0x80.
    """
    ship()
    text = tokenizer_json(tokenizer)
    width = width_of(text, end_id)
    if end_id & 0xFF > 0x7F:
        raise ValueError("the last byte of the end id must be below 0x80")
    spec = documents.sparkSession.sparkContext.broadcast(text)
    (documents.select(F.col("text").cast("string").alias("text")).mapInArrow(_flat(spec, end_id, width), "value binary")
     .select(F.col("value").cast("string")).write.option("lineSep", chr(end_id & 0xFF)).text(path))
    return width


def _search(end_id: int, width: int):
    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                ids = np.frombuffer(content.as_buffer(), dtype=f">u{width}")
                for block, at in enumerate(range(0, len(ids), BLOCK_IDS)):
                    part = ids[at:at + BLOCK_IDS]
                    found = np.flatnonzero(part == end_id)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path]), pa.array([block], pa.int32()), pa.array([len(part)], pa.int64()),
                         pa.array([found], pa.list_(pa.int32()))], names=["path", "block", "size", "found"])

    return run


def scan_flat(spark: SparkSession, path: str, end_id: int = END_ID, width: int = 2) -> DataFrame:
    """``doc, file, start, n_tokens, ended`` for each document of the flat files in ``path``.

    ``doc`` counts from 0 over all files, ``file`` is where the document ends, ``start`` counts
    all ids before it and ``n_tokens`` its own with the end id.
    """
    ship()
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "[!._]*").load(path)
             .where("length > 0").select("path", "content"))
    blocks = save(files.mapInArrow(_search(end_id, width), "path string, block int, size long, found array<int>"), "found")
    sums = blocks.select("path", "block", "size", F.size("found").cast("long").alias("docs"),
                         F.try_element_at("found", F.lit(-1)).alias("last"))
    # within a file: at most 2 GB, so at most 1,024 blocks of a row each
    own = Window.partitionBy("path").orderBy("block")
    inner = sums.select("path", "block", "size", "docs", (F.sum("size").over(own) - F.col("size")).alias("ids_before"),
                        (F.sum("docs").over(own) - F.col("docs")).alias("docs_before"), "last")
    inner = inner.withColumn("end", F.max(F.col("ids_before") + F.col("last")).over(own))
    per_file = inner.groupBy("path").agg(F.sum("size").alias("size"), F.sum("docs").alias("docs"), F.max("end").alias("end"))
    # over the files: a row each
    order = Window.orderBy("path")
    per_file = per_file.select("path", (F.sum("size").over(order) - F.col("size")).alias("file_ids"),
                               (F.sum("docs").over(order) - F.col("docs")).alias("file_docs"), "end", "size")
    per_file = per_file.select(
        "path", "file_ids", "file_docs",
        F.coalesce(F.max(F.col("file_ids") + F.col("end")).over(order.rowsBetween(Window.unboundedPreceding, -1)) + 1,
                   F.lit(0)).alias("open"))
    placed = (inner.join(per_file, "path")
              .withColumn("before", F.max(F.col("file_ids") + F.col("end"))
                          .over(own.rowsBetween(Window.unboundedPreceding, -1)))
              .select("path", "block", "size", (F.col("file_ids") + F.col("ids_before")).alias("at"),
                      (F.col("file_docs") + F.col("docs_before")).alias("first_doc"),
                      F.coalesce(F.col("before") + 1, "open").alias("open")))
    placed = save(placed, "placed")
    rows = (blocks.select("path", "block", "found").join(placed, ["path", "block"])
            .select("path", "at", "first_doc", "open", "found", F.posexplode("found").alias("i", "end")))
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    begin = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("at") + F.expr("get(found, i - 1)") + 1)
    ended = rows.select((F.col("first_doc") + F.col("i")).alias("doc"), name, begin.alias("start"),
                        (F.col("at") + F.col("end") + 1 - begin).alias("n_tokens"), F.lit(True).alias("ended"))
    tail = (placed.join(blocks.select("path", "block", "found"), ["path", "block"])
            .agg(F.max(F.col("at") + F.col("size")).alias("ids"), F.sum(F.size("found")).alias("doc"),
                 F.max("path").alias("path"),
                 F.coalesce(F.max(F.col("at") + F.try_element_at("found", F.lit(-1)) + 1), F.lit(0)).alias("start"))
            .where("ids > start")
            .select("doc", name, "start", (F.col("ids") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended")))
    return ended.unionByName(tail)


def token_counts(documents: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the documents as flat files in the shared folder and count them there."""
    path = scratch_path(documents.sparkSession, "flat-tokens")
    width = write_flat(documents, path, tokenizer, end_id)
    return scan_flat(documents.sparkSession, path, end_id, width)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat token files of all ``documents``: a row for each document found in them."""
    return token_counts(table(spark, sf_dir, "documents"))
