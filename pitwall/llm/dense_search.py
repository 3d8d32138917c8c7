"""Ranked lexical search of all documents for each item, by blocked dense matrix products.

The items' distinct terms are a compact vocabulary.  A tile of items times a tile of that
vocabulary is a float64 matrix of term weights, a tile of documents times the same vocabulary
one of term impacts; a BLAS product gives the partial scores of every pair at once.  Weights
and impacts are integers, and a vocabulary tile is so narrow that no sum in a product reaches
2**53, so products are exact; tiles are added as 64-bit integers.

1. *Items.* Their terms are dealt into shards of at most ``ITEMS`` items and ``TERMS`` pairs of
   item and term (an item with more is a shard of its own).  A shard's pairs are all that the driver
   holds and ships; each shard is one pass over the documents.
2. *Counts.* Each document's number of terms, and its frequencies of the shard's terms, are
   written; the corpus statistics are sums over that table.
3. *Products.* Each task multiplies its documents tile by tile and keeps the best ``top`` of every
   item: higher scores first, equal scores by ascending id, so ties at the cut are
   decided the same way in every tile.  What the tasks kept is merged by item.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z
lower-cased.

Defined cases: null and empty texts, and texts without terms, count for nothing and are never found;
items without terms have no rows; benchmark rows with equal ids (null included) are one item with the
terms of all their texts; repeated documents are ranked each for itself; a null ``doc_id`` ranks behind the
other ids of its score and stays null; very long texts are split in slices of 1 MB at a term's end; other
columns are not read; an empty table of documents or items gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import save, ship, table

TOP = 50
#: Items of a shard, and pairs of item and term.
ITEMS, TERMS = 256, 1 << 16
#: Documents and vocabulary columns of a tile.
DOCS, COLUMNS = 1024, 2048
#: Fixed values of the score.
IMPACT, SLOPE, LENGTH, WEIGHT = 1_000_000_000, 20, 50, 1000
EXACT = 1 << 53
_SLICE = 1_000_000
_RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"


def _byte_map() -> bytes:
    """Every byte to itself, A-Z to a-z, other ASCII bytes than letters and digits to a space."""
    return bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 if b < 128 else b for b in range(128)) + bytes(range(128, 256))


def _term_slices(text: bytes, to: bytes):
    """The terms of a text, as lists of about ``_SLICE`` bytes each."""
    text, at = text.translate(to), 0
    while at < len(text):
        end = text.find(b" ", at + _SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _binary(column: pa.Array) -> list:
    return [x.as_buffer() if x.is_valid else None for x in column]


# --- items -------------------------------------------------------------------------------


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term, shard``: distinct terms of each item, written; a shard is within its bounds
    unless it is a single item."""
    to = _byte_map()

    def terms(batches):
        for batch in batches:
            for i, text in zip(batch.column("item_id").to_pylist(), _binary(batch.column("text"))):
                for part in _term_slices(bytes(text or b""), to):
                    found = list(set(part))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * len(found), pa.int64()), pa.array(found, pa.binary())], ["item_id", "term"])

    pairs = save(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
        .mapInArrow(terms, "item_id bigint, term binary").distinct(), "item_terms")
    sizes = pairs.groupBy("item_id").count()
    of = F.coalesce(F.xxhash64("item_id"), F.lit(0))
    total, rows = (x or 0 for x in sizes.agg(F.sum("count"), F.count("*")).first())
    shards = max(1, -(-total // TERMS), -(-rows // ITEMS))
    while shards > 1:  # hashing deals unevenly: more shards until each is in bounds or is one item
        over = (sizes.groupBy(F.pmod(of, F.lit(shards)).alias("s"))
                .agg(F.count("*").alias("items"), F.sum("count").alias("terms"))
                .where((F.col("items") > 1) & ((F.col("items") > ITEMS) | (F.col("terms") > TERMS))).limit(1))
        if not over.count():
            break
        shards += 1 + shards // 4
    return pairs.withColumn("shard", F.pmod(of, F.lit(shards)))


# --- documents ---------------------------------------------------------------------------


def _counts(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of all documents with a term: its number of terms, and the
    vocabulary's places and frequencies in it."""
    sent, to = docs.sparkSession.sparkContext.broadcast(vocabulary), _byte_map()

    def count(batches):
        place = {t: i for i, t in enumerate(sent.value)}
        known = place.keys()
        for batch in batches:
            ids, ns, at, terms, tfs = [], [], [0], [], []
            for i, text in zip(batch.column("doc_id").to_pylist(), _binary(batch.column("text"))):
                n, tf = 0, Counter()
                for part in _term_slices(bytes(text or b""), to):
                    seen = Counter(part)
                    n += len(part)
                    for t in seen.keys() & known:
                        tf[place[t]] += seen[t]
                if n:
                    ids.append(i)
                    ns.append(n)
                    terms += tf.keys()
                    tfs += tf.values()
                    at.append(len(terms))
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    found = save(docs.mapInArrow(count, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"), "term_counts")
    sent.destroy()
    return found


def _statistics(counts: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents, all their terms, and the documents of each vocabulary place."""
    def sums(batches):
        df, docs, length = np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=terms)
            docs += batch.num_rows
            length += int(batch.column("n").to_numpy().sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-2, terms), pa.int32()), pa.array([docs, length, *df.tolist()], pa.int64())], ["term", "sum"])

    found = (counts.select("n", "terms").mapInArrow(sums, "term int, sum bigint")
             .groupBy("term").agg(F.sum("sum").alias("sum")).toArrow())
    out = np.zeros(terms + 2, np.int64)
    out[found.column("term").to_numpy() + 2] = found.column("sum").to_numpy()
    return int(out[0]), int(out[1]), out[2:]


def weights(docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(WEIGHT * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def _norms(n: np.ndarray, docs: int, length: int) -> np.ndarray:
    if LENGTH * int(n.max()) * docs < 1 << 63:
        return 100 - LENGTH + (LENGTH * n * docs) // length
    return np.array([100 - LENGTH + (LENGTH * x * docs) // length for x in n.tolist()], dtype=np.int64)


def best(item: np.ndarray, doc: np.ndarray, gone: np.ndarray, score: np.ndarray, top: int) -> np.ndarray:
    """Places of each item's ``top`` entries: highest scores, then ids, null ids (``gone``) last."""
    order = np.lexsort((doc, gone, -score, item))
    first = np.searchsorted(item[order], item[order])
    return order[np.arange(len(order)) - first < top]


def _scores(batch, pairs, weight, columns: int, docs: int, length: int):
    """``(first row, scores)`` of tiles of documents: items times documents, exact 64-bit integers."""
    of_item, of_term, items = pairs
    at = np.frombuffer(batch.column("terms").buffers()[1], np.int32)
    at = at[batch.column("terms").offset:][:batch.num_rows + 1]
    at = at - at[0]
    terms, tfs = (batch.column(c).flatten().to_numpy() for c in ("terms", "tfs"))
    n = batch.column("n").to_numpy()
    by_term = np.argsort(of_term, kind="stable")
    of_item, of_term = of_item[by_term], of_term[by_term]
    for a in range(0, batch.num_rows, DOCS):
        b = min(a + DOCS, batch.num_rows)
        row = np.repeat(np.arange(b - a), np.diff(at[a:b + 1]))
        term, tf = terms[at[a]:at[b]], tfs[at[a]:at[b]]
        norm = _norms(n[a:b], docs, length)
        impact = (IMPACT * tf) // (1000 * tf + SLOPE * norm[row])
        total = np.zeros((items, b - a), np.int64)
        for lo in range(0, len(weight), columns):
            hi = min(lo + columns, len(weight))
            here = (term >= lo) & (term < hi)
            if not here.any():
                continue
            d = np.zeros((b - a, hi - lo))
            d[row[here], term[here] - lo] = impact[here]
            i, j = np.searchsorted(of_term, [lo, hi])
            q = np.zeros((items, hi - lo))
            q[of_item[i:j], of_term[i:j] - lo] = weight[of_term[i:j]]
            total += (q @ d.T).astype(np.int64)
        yield a, total


def _search(counts: DataFrame, ids: list, pairs: tuple, docs: int, length: int, weight: np.ndarray, top: int) -> DataFrame:
    """The best ``top`` documents of each item of one shard."""
    columns = max(1, min(COLUMNS, (EXACT - 1) // (max(1, int(weight.max())) * 1_000_000)))
    least = np.iinfo(np.int64).min

    def found(batches):
        empty = np.zeros(0, np.int64)
        item, doc, gone, score = empty, empty, empty.astype(bool), empty
        floor = np.ones(len(ids), np.int64)  # scores below it can't be among an item's best
        for batch in batches:
            if not batch.num_rows:
                continue
            new_gone = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            new_doc = batch.column("doc_id").fill_null(least).to_numpy()
            for a, scores in _scores(batch, pairs, weight, columns, docs, length):
                if scores.shape[1] > top:
                    cut = np.partition(scores, scores.shape[1] - top, axis=1)[:, scores.shape[1] - top]
                    i, j = np.nonzero(scores >= np.maximum(floor, cut)[:, None])
                else:
                    i, j = np.nonzero(scores >= floor[:, None])
                item, doc, gone, score = (np.r_[item, i], np.r_[doc, new_doc[a + j]], np.r_[gone, new_gone[a + j]],
                                          np.r_[score, scores[i, j]])
                keep = best(item, doc, gone, score, top)
                item, doc, gone, score = item[keep], doc[keep], gone[keep], score[keep]
                full = np.bincount(item, minlength=len(ids)) >= top
                last = np.ones(len(ids), np.int64)
                last[item] = score  # entries of an item fall: the last one stays
                floor = np.where(full, last, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()).take(pa.array(item)), pa.array(doc, mask=gone), pa.array(score)],
            ["item_id", "doc_id", "score"])

    kept = counts.mapInArrow(found, "item_id bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))


def search(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` highest-scoring documents, score above 0."""
    ship()
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    pairs = item_terms(items)
    out = None
    for shard in sorted(r["shard"] for r in pairs.select("shard").distinct().collect()):
        rows = pairs.where(F.col("shard") == shard).select("item_id", "term").toArrow()
        ids = sorted(set(rows.column("item_id").to_pylist()), key=lambda i: (i is None, i or 0))
        place = {i: k for k, i in enumerate(ids)}
        vocabulary = sorted(set(rows.column("term").to_pylist()))
        spot = {t: k for k, t in enumerate(vocabulary)}
        of_item = np.array([place[i] for i in rows.column("item_id").to_pylist()], dtype=np.int64)
        of_term = np.array([spot[t] for t in rows.column("term").to_pylist()], dtype=np.int64)
        counts = _counts(docs, vocabulary)
        n, length, df = _statistics(counts, len(vocabulary))
        if n:
            found = save(_search(counts, ids, (of_item, of_term, len(ids)), n, length, weights(n, df), top), "ranked")
            out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], _RESULT) if out is None else out


#: Fixed value: the pattern of a term.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = f"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER}, '{_TERM}') AS ts FROM documents
), lens AS (
  SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n FROM texts WHERE len(ts) > 0
), corpus AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lens
), items AS (
  SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM benchmark)
), tfs AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM texts)
  WHERE t IN (SELECT t FROM items) GROUP BY r, t
), weight AS (
  SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tfs GROUP BY t), corpus
), norm AS (
  SELECT r, doc_id, 100 - 50 + ((50 * n * docs) // terms) AS m FROM lens, corpus
), impact AS (
  SELECT r, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS part
  FROM tfs JOIN norm USING (r) JOIN weight USING (t)
), scores AS (
  SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM items JOIN impact USING (t) GROUP BY ALL
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank,
         doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def op11_dense_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
