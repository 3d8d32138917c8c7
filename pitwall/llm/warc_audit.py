"""Merkle fixity audit of WARC replicas.

``write_warc`` writes records as ``.warc.gz`` files do, one gzip member a record.
``hash_replica`` finds the members of any writer's files by inflating them, and the next header
only after damage; it hashes each record's stored bytes and builds a tree over each file: the
records that start within the same 64 KB are hashed together in order of their offsets,
16 such ranges make a range of the next level, and so on up to the file's root.
``audit`` compares the roots of two replicas and goes down only where hashes differ; damage
changes the ranges it lies in and no others, however long the file.

A file is read and hashed by one task.  Levels are written apart from each other, so each
step down reads one level and joins it with the differing ranges above, which are few unless
the replicas have little in common (they are broadcast only if a count allows it).

Defined cases: a null page or address is written as an empty one, a null id as record 0 of
no page; a record or a file that only one replica has is reported as ``missing`` or ``extra``;
bytes that no gzip header begins belong to the record before them (``start`` 0 if there is
none); repeated pages are records of their own; no records give an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import save, ship, small, table
from pitwall.session import scratch_path

RANGE = 1 << 16
FANOUT = 16
#: Fixed value: how a gzip member of deflated data begins.
MAGIC = b"\x1f\x8b\x08"
_FEED = 1 << 16

_HASHES = "kind byte, shard int, level int, node long, start long, length long, page_id long, digest binary"
_PAGE = re.compile(rb"WARC-Record-ID: <urn:page:(\d+)>")


def member(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """One record as a gzip member; its last byte is zero."""
    body = (html or "").encode()
    head = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>\r\n"
            f"WARC-Target-URI: {url or ''}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n")

    def packed(data: bytes) -> bytes:
        z = zlib.compressobj(1, zlib.DEFLATED, 31)
        return z.compress(data) + z.flush()

    out = packed(head.encode() + body + b"\r\n\r\n")
    # the last byte of a member is the top byte of its length: zero below 16 MB
    return out if out[-1] == 0 else out + packed(b"")


def _members(damage):
    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")))
            out = [member(*r) for r in rows]
            if damage is not None:
                out = [damage(p, m) for p, m in zip(batch.column("page_id").to_pylist(), out)]
            # the last byte is written as Spark's line separator
            yield pa.RecordBatch.from_arrays([pa.array([m[:-1] for m in out], pa.binary())], names=["value"])

    return run


def write_warc(pages: DataFrame, path: str, damage=None) -> None:
    """Write ``pages(page_id, url, html)`` as WARC files, a file for each input partition.
    ``damage(page_id, member)`` may alter stored bytes, to make a faulty replica."""
    ship()
    (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                  F.col("html").cast("string").alias("html"))
     .mapInArrow(_members(damage), "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\x00").text(path))


def _member_end(data: memoryview, at: int) -> int | None:
    """Where the gzip member that begins at ``at`` ends; None if it can't be inflated or fails its check."""
    z, fed = zlib.decompressobj(31), at
    try:
        while not z.eof:
            if fed >= len(data):
                return None
            part = data[fed:fed + _FEED]
            fed += len(part)
            z.decompress(part)
    except zlib.error:
        return None
    return fed - len(z.unused_data)


def _begins(data: memoryview, at: int) -> bool:
    """Whether a member's first part can be inflated (a chance match of three bytes can't)."""
    if data[at + 3:at + 4].tobytes() > b"\x1f":  # bits that no header sets
        return False
    try:
        zlib.decompressobj(31).decompress(data[at:at + _FEED], _FEED)
    except zlib.error:
        return False
    return True


def member_starts(content: bytes) -> list[int]:
    """Places at which a file's members begin, whoever wrote them: a member is followed to its end, and
    only where that fails the next header is looked for."""
    data, starts, at = memoryview(content), [], 0
    while 0 <= at < len(data):
        if content.startswith(MAGIC, at):
            starts.append(at)
            end = _member_end(data, at)
            if end is not None:
                at = end
                continue
        at = content.find(MAGIC, at + 1)
        while at >= 0 and not _begins(data, at):
            at = content.find(MAGIC, at + 1)
    return [0, *starts] if content and (not starts or starts[0]) else starts


def _page_of(record: bytes) -> int | None:
    try:
        found = _PAGE.search(zlib.decompressobj(31).decompress(record[:1 << 12], 1024))
    except zlib.error:
        return None
    return int(found[1]) if found else None


def tree(records: list[tuple[int, int, bytes]]) -> list[tuple[int, int, bytes]]:
    """``(level, node, digest)`` of the ranges over a file's ``(start, length, digest)``; the
    last one is the root."""
    out: list[tuple[int, int, bytes]] = []
    parts = [(start // RANGE, start.to_bytes(8, "big") + length.to_bytes(8, "big") + digest)
             for start, length, digest in records]
    level = 0
    while parts:
        nodes: dict[int, list[bytes]] = {}
        for node, part in parts:
            nodes.setdefault(node, []).append(node.to_bytes(8, "big") + part if level else part)
        hashed = [(node, hashlib.sha256(b"".join(p)).digest()) for node, p in nodes.items()]
        out += [(level, node, digest) for node, digest in hashed]
        if len(hashed) == 1 and hashed[0][0] == 0:
            break
        parts = [(node // FANOUT, digest) for node, digest in hashed]
        level += 1
    return out


def _hash(batches):
    for batch in batches:
        for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
            data = content.as_buffer().to_pybytes()
            starts = member_starts(data)
            records, pages = [], []
            for a, b in zip(starts, [*starts[1:], len(data)]):
                records.append((a, b - a, hashlib.sha256(data[a:b]).digest()))
                pages.append(_page_of(data[a:b]))
            nodes = tree(records)
            n, m = len(records), len(nodes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * n + [1] * m, pa.int8()), pa.array([shard] * (n + m), pa.int32()),
                 pa.array([None] * n + [x[0] for x in nodes], pa.int32()),
                 pa.array([r[0] // RANGE for r in records] + [x[1] for x in nodes], pa.int64()),
                 pa.array([r[0] for r in records] + [None] * m, pa.int64()),
                 pa.array([r[1] for r in records] + [None] * m, pa.int64()),
                 pa.array(pages + [None] * m, pa.int64()),
                 pa.array([r[2] for r in records] + [x[2] for x in nodes], pa.binary())],
                names=["kind", "shard", "level", "node", "start", "length", "page_id", "digest"])


def hash_replica(spark: SparkSession, path: str) -> DataFrame:
    """Records (kind 0) and ranges (kind 1) of a replica's files, written by kind and level.
    Files are matched between replicas by the number of their part."""
    ship()
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .select(F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int").alias("shard"), "content"))
    out = scratch_path(spark, "fixity")
    (files.mapInArrow(_hash, _HASHES).withColumn("level", F.coalesce("level", F.lit(-1)))
     .write.partitionBy("kind", "level").parquet(out))
    return spark.read.schema(_HASHES).parquet(out)


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """``shard, start, length, page_id, change`` for each record in which two replicas differ.

    ``change`` is ``changed``, ``missing`` (``b`` has no record there) or ``extra``; place and
    page are those of ``a`` where it has the record.
    """
    spark = a.sparkSession
    side = {"a": a, "b": b}

    def both(kind: int, level: int | None, keys: list[str], within: DataFrame | None) -> DataFrame:
        """Rows of the two replicas that differ, of the ranges in ``within`` if given."""
        out = None
        for name, frame in side.items():
            frame = frame.where(F.col("kind") == kind)
            if level is not None:
                frame = frame.where(F.col("level") == level)
            if within is not None:
                up = F.floor(F.col("node") / FANOUT).cast("long") if kind else F.col("node")
                frame = frame.withColumn("up", up).join(within, ["shard", "up"], "left_semi")
            frame = frame.select(*keys, *(F.col(c).alias(f"{c}_{name}") for c in ("digest", "length", "page_id")))
            out = frame if out is None else out.join(frame, keys, "full")
        return out.where(~F.col("digest_a").eqNullSafe(F.col("digest_b")))

    heights = {n: f.where("kind = 1").groupBy("shard").agg(F.max("level").alias("top")) for n, f in side.items()}
    tops = save(heights["a"].join(heights["b"].withColumnRenamed("top", "top_b"), "shard", "full")
                .select("shard", "top", "top_b"), "tops")
    highest = tops.agg(F.max(F.greatest("top", "top_b"))).first()[0]
    if highest is None:
        return spark.createDataFrame([], "shard int, start long, length long, page_id long, change string")
    # a file comes in at the height of its root, the higher one of the two
    wrong = None
    for level in range(highest, -1, -1):
        roots = tops.where(F.greatest("top", "top_b") == level).select("shard", F.lit(0).cast("long").alias("up"))
        within = roots if wrong is None else wrong.select("shard", F.col("node").alias("up")).union(roots)
        wrong = save(both(1, level, ["shard", "node"], small(within.distinct())).select("shard", "node"), "differ")
    found = both(0, None, ["shard", "node", "start"], small(wrong.select("shard", F.col("node").alias("up"))))
    return found.select(
        "shard", "start", F.coalesce("length_a", "length_b").alias("length"), F.coalesce("page_id_a", "page_id_b").alias("page_id"),
        F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed").alias("change"))


def planted(page_id: int | None, stored: bytes) -> bytes:
    """The faulty replica of the registered query: one stored byte in the middle of every
    101st page is flipped, and the second quarter of every 503rd is zeroed."""
    if page_id is None:
        return stored
    out = bytearray(stored)
    if page_id % 101 == 7:
        out[len(out) // 2] ^= 0x55
    if page_id % 503 == 11:
        out[len(out) // 4:len(out) // 2] = bytes(len(out) // 2 - len(out) // 4)
    return bytes(out)


def op9_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages`` as WARC files, and a replica with damage that follows the page ids:
    the records in which the replicas differ."""
    pages, paths = table(spark, sf_dir, "pages"), [scratch_path(spark, f"warc-{x}") for x in "ab"]
    write_warc(pages, paths[0])
    write_warc(pages, paths[1], planted)
    return audit(*(hash_replica(spark, p) for p in paths))
