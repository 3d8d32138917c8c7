"""Token files in a canonical, length-limited Huffman code.

``write_tokens`` gives a folder with two Parquet tables:

* ``code``: ``id, bits`` - the length of each id's code word, from global counts.  Words are
  canonical: sorted by (bits, id), each is the one before plus one, shifted to its length.
* ``blocks``: ``part, block, start, doc_ids, lengths, checkpoints, payload`` - independent
  runs of whole documents in ascending ``doc_id`` order (``part``, then ``block``).
  ``start`` counts the ids before the block within its part, ``lengths`` the ids of each
  document, and ``checkpoints`` the bit offset of every 256th id in ``payload``.

``read_tokens`` decodes a block from all its checkpoints at once: every step looks up one
code word per checkpoint in a table over the next ``max bits`` bits.

Defined cases: null text counts as empty, and an empty text has its end id only; rows with
a null ``doc_id`` come first; rows of one ``doc_id`` are ordered by the crc32 of their ids and
their length, so repeated rows are interchangeable; other columns are not read; an empty
table gives a folder without rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import mapped, save, ship, table
from pitwall.llm.tokens import encoded, tokenizer_json, vocabulary_size
from pitwall.session import scratch_path

CHECKPOINT = 256
#: A block is closed when it holds this many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 20
#: Longest code word in bits, unless the ids need more.
MAX_BITS = 16

_BLOCKS = ("part int, block int, start long, doc_ids array<long>, lengths array<int>, ids long, "
           "checkpoints array<long>, payload binary")


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits of each symbol's code word (package-merge: the best code with words up to
    ``limit`` bits); counts must be positive, ``2**limit`` at least their number."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    level, flags = leaves, []
    for _ in range(limit):
        flags.append(None)
        if len(flags) == 1:
            flags[0] = np.ones(n, bool)
            continue
        pairs = len(level) // 2
        packed = level[0:2 * pairs:2] + level[1:2 * pairs:2]
        both = np.concatenate([leaves, packed])
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        flags[-1] = rank < n
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(flags):
        own = int(leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def canonical(ids: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, bits, words)`` in canonical order."""
    order = np.lexsort((ids, bits))
    ids, bits = ids[order], bits[order]
    words, word = np.zeros(len(ids), np.uint64), 0
    for i in range(len(ids)):
        if i:
            word = (word + 1) << int(bits[i] - bits[i - 1])
        words[i] = word
    return ids, bits, words


def pack(ids: np.ndarray, word_of: np.ndarray, bits_of: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' code words one after another (high bit first), and the checkpoints."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    bits = bits_of[ids].astype(np.int64)
    ends = np.cumsum(bits)
    at = ends - bits
    slot = at >> 6
    shift = 64 - (at & 63) - bits
    words = word_of[ids]
    over = shift < 0
    high = np.where(over, words >> np.where(over, -shift, 0).astype(np.uint64),
                    words << np.where(over, 0, shift).astype(np.uint64))
    out = np.zeros(int(ends[-1] >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
    out[slot[first]] = np.bitwise_or.reduceat(high, first)
    out[slot[over] + 1] |= words[over] << (64 + shift[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[:int(ends[-1] + 7) >> 3], at[::CHECKPOINT]


def unpack(payload: bytes, checkpoints: np.ndarray, n: int, symbol: np.ndarray, size: np.ndarray, limit: int) -> np.ndarray:
    """The ``n`` ids of a payload; ``symbol`` and ``size`` are tables over ``limit`` bits."""
    if not n:
        return np.zeros(0, np.uint32)
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    lanes = len(checkpoints)
    out = np.zeros((CHECKPOINT, lanes), np.uint32)
    at = checkpoints.copy()
    short = n - CHECKPOINT * (lanes - 1)  # ids of the last lane
    for step in range(min(CHECKPOINT, n)):
        if step == short:
            lanes, at = lanes - 1, at[:-1]
        peek = (window[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - limit)
        out[step, :lanes] = symbol[peek]
        at += size[peek]
    return out.T.reshape(-1)[:n]


def decode_tables(ids: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    ids, bits, words = canonical(ids, bits)
    limit = int(bits.max()) if len(bits) else 1
    span = np.left_shift(1, limit - bits)
    symbol, size = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.int64)
    at = (words << (limit - bits).astype(np.uint64)).astype(np.int64)
    full = int(span.sum())
    symbol[:full], size[:full] = np.repeat(ids, span), np.repeat(bits, span)
    assert not len(at) or (at == np.cumsum(span) - span).all()
    return symbol, size, limit


def _tokenize(spec, end_id: int, width: str, special: bool):
    def run(batches):
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            n, crc, packed = [], [], []
            for _, ids in encoded(batch.column("text"), spec.value, special=special):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                n.append(len(ids))
                crc.append(zlib.crc32(ids))
                packed.append(z.compress(ids.astype(width).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(crc, pa.int64()), pa.array(packed, pa.binary())],
                names=["doc_id", "n", "crc", "packed"])

    return run


def _count(width: str):
    def run(batches):
        z, total = zstandard.ZstdDecompressor(), np.zeros(0, np.int64)
        for batch in batches:
            held = [np.frombuffer(z.decompress(p), width) for p in batch.column("packed").to_pylist()]
            for k in range(0, len(held), 512):
                c = np.bincount(np.concatenate(held[k:k + 512]), minlength=len(total))
                c[:len(total)] += total
                total = c
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    return run


def _encode(code, width: str):
    def run(batches):
        z, (word_of, bits_of) = zstandard.ZstdDecompressor(), code.value
        part, block, start = TaskContext.get().partitionId(), 0, 0
        docs, lengths, held, size = [], [], [], 0

        def row():
            ids = np.concatenate(held)
            payload, marks = pack(ids, word_of, bits_of)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([docs], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
                 pa.array([len(ids)], pa.int64()), pa.array([marks], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                names=["part", "block", "start", "doc_ids", "lengths", "ids", "checkpoints", "payload"])

        for batch in batches:
            for doc, packed in zip(batch.column("doc_id").to_pylist(), batch.column("packed").to_pylist()):
                ids = np.frombuffer(z.decompress(packed), width)
                docs.append(doc)
                lengths.append(len(ids))
                held.append(ids)
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield row()
                    block, start = block + 1, start + size
                    docs, lengths, held, size = [], [], [], 0
        if held:
            yield row()

    return run


def write_tokens(documents: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0,
                 special: bool = False) -> None:
    """Encode every text of ``documents(doc_id, text)``, append ``end_id`` and write the files.
    With ``special``, literals of special tokens in a text get those tokens' ids.

    Texts are tokenized once, into a table in the shared folder that holds each document's
    ids; counts come from that table, and its rows are range-partitioned and sorted by id.
    The tokenizer and its cache leave a worker when texts are done: a block's arrays come next.
    The driver sees one row for each different id at most.
    """
    ship()
    spark = documents.sparkSession
    text = tokenizer_json(tokenizer)
    width = "<u2" if max(vocabulary_size(text), end_id + 1) <= 1 << 16 else "<u4"
    spec = spark.sparkContext.broadcast(text)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = save(docs.mapInArrow(_tokenize(spec, end_id, width, special), "doc_id long, n int, crc long, packed binary"), "ids")
    counts = (mapped(tokens.select("packed"), _count(width), "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).toArrow())
    ids, n = counts.column("id").to_numpy(), counts.column("n").to_numpy()
    bits = code_lengths(n, max(MAX_BITS, len(n).bit_length() + 1)) if len(n) else np.zeros(0, np.int64)
    sym, length, words = canonical(ids, bits)
    word_of, bits_of = np.zeros(int(ids.max(initial=0)) + 1, np.uint64), np.zeros(int(ids.max(initial=0)) + 1, np.uint8)
    word_of[sym], bits_of[sym] = words, length
    spark.createDataFrame(pa.table({"id": ids, "bits": bits})).coalesce(1).write.parquet(f"{path}/code")
    code = spark.sparkContext.broadcast((word_of, bits_of))
    dealt = tokens.repartitionByRange("doc_id", "crc", "n").sortWithinPartitions("doc_id", "crc", "n")
    (mapped(dealt.select("doc_id", "packed"), _encode(code, width), _BLOCKS)
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def _decode(tables, with_ids: bool):
    def run(batches):
        symbol, size, limit = tables.value
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i]
                lengths = np.array(get("lengths").values, dtype=np.int64)
                ids = unpack(get("payload").as_py(), np.array(get("checkpoints").values, dtype=np.int64),
                             get("ids").as_py(), symbol, size, limit)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                raw = ids.astype("<u4")
                out = [get("doc_ids").values, pa.array(starts + get("base").as_py() + get("start").as_py()),
                       pa.array(lengths),
                       pa.array([zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32`` (unsigned crc32 of its
    ids as little-endian unsigned 32-bit integers) and, if asked for, ``ids``."""
    ship()
    code = spark.read.schema("id long, bits long").parquet(f"{path}/code").toArrow()
    tables = spark.sparkContext.broadcast(decode_tables(code.column("id").to_numpy(), code.column("bits").to_numpy()))
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    # one row for each part of the files
    parts = blocks.groupBy("part").agg(F.sum("ids").alias("size")).select(
        "part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("base"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return mapped(blocks.join(F.broadcast(parts), "part"), _decode(tables, with_ids), schema)


def token_files(documents: DataFrame, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Write the documents' token files to the shared folder and read them back; special tokens
    in texts are read as the tokenizers library does by default."""
    path = scratch_path(documents.sparkSession, "token-files")
    write_tokens(documents, path, tokenizer, end_id, special=True)
    return read_tokens(documents.sparkSession, path)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` through the files: ``doc_id, start, n_tokens, ids_crc32``."""
    return token_files(table(spark, sf_dir, "documents"))
