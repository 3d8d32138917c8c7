"""Benchmark decontamination: BM25 over an inverted index of the test items, pruned by block maxima.

The pruning is that of block-max indexes in the manner of MaxScore, for whole batches of
passages at once: it opens the same blocks as WAND's bounds allow, but without a
pivot that skips postings.

Every document is read as passages, windows of twice the longest item's words at steps of
that length, so that any place where an item may stand lies whole in one.  A passage is a
query: an item's score is the BM25 weight of the item's terms that the passage holds, as a
share of all its terms' weights, and all items at ``SCORE`` or above are retrieved.  Pruning
is exact.  Terms are ordered by the greatest weight they have in any item; the low ones
whose weights cannot make up ``LOW`` in any item never start a search.  For the others, the
greatest weights within each block of items are summed, and together with what the low
terms may add there they bound all scores of the block; only blocks that reach ``SCORE`` are
scored.  A retrieved item counts as a leak if the passage also holds, in order, at least
80 % of the words of its question and 80 % of those of its answer.

Items have one text: the answer is its last sentence (or line), the question what comes
before; a single sentence is halved.  Words are runs of letters and digits of the lower-cased text.

Items are indexed in shards of bounded size by the hash of their id, one pass over the
documents for each (a million words of items a shard); within a shard, items are grouped
by length, so a long item does not widen the passages of short ones.  Document frequencies
and mean length are those of all items.

Defined cases: null and empty texts hold nothing and leak nothing; items without words match
nothing; repeated items and repeated documents each give their rows; null ids are kept; other
columns are not read; no documents or no items give an empty result.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import held, released, save, ship, small, table, worker_cache
from pitwall.llm.shingles import text_slices, word_hashes

K1, B = 1.2, 0.75
SCORE = 0.5
OVERLAP = 0.8
BLOCK_ITEMS = 4
#: Low terms are those that cannot make up this much of any item.
LOW = 0.15
SHARD_WORDS = 1_000_000
#: Items of up to 64 words are searched in windows of 128, those of up to 256 in 512, and so on.
FIRST_LENGTH = 64

_LEAKS = "doc_id long, th long, item_id long, score double, question_overlap double, answer_overlap double"
_ANSWER = re.compile(r"(?s)^(.*[.!?\n])\s*(\w.*)$")


def _item_words(batches):
    """``item_id, words, question``: hashes of an item's words, and how many are its question's."""
    for batch in batches:
        parts = []
        for t in batch.column("text").to_pylist():
            m = _ANSWER.match((t or "").strip())
            parts += [m[1], m[2]] if m else [t or "", ""]
        words, question = [], []
        for _, off, data in text_slices(pa.array(parts, pa.string())):
            h, at = word_hashes(off, data, letters=True)
            words += [h[a:b].view(np.int64) for a, b in zip(at[:-1], at[1:])]
        both = [np.concatenate(words[i:i + 2]) for i in range(0, len(words), 2)]
        for i, w in enumerate(both):
            q = len(words[2 * i])
            question.append(q if 0 < q < len(w) else (len(w) + 1) // 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(both, pa.list_(pa.int64())), pa.array(question, pa.int32())],
            names=["item_id", "words", "question"])


class Index:
    """Inverted index of a group of items of similar length, with block maxima."""

    def __init__(self, ids: list, words: list[np.ndarray], questions: list[int], terms: np.ndarray, idf: np.ndarray,
                 mean: float):
        self.ids, self.words, self.questions = ids, words, questions
        self.step = max(len(w) for w in words)
        lengths = np.array([len(w) for w in words])
        term, item = np.concatenate(words), np.repeat(np.arange(len(words)), lengths)
        self.terms, term = np.unique(term, return_inverse=True)
        key, tf = np.unique(item * len(self.terms) + term, return_counts=True)
        item, term = key // len(self.terms), key % len(self.terms)
        weight = idf[np.searchsorted(terms, self.terms)][term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] / mean))
        weight /= np.bincount(item, weight)[item]
        # low terms: whatever of them a passage holds, no item reaches the score by them
        greatest = np.zeros(len(self.terms))
        np.maximum.at(greatest, term, weight)
        order = np.argsort(greatest, kind="stable")
        by_term = np.argsort(term, kind="stable")
        first = np.r_[0, np.cumsum(np.bincount(term, minlength=len(self.terms)))]
        self.low = np.zeros(len(self.terms), bool)
        held = np.zeros(len(words))
        for t in order:
            span = by_term[first[t]:first[t + 1]]
            if (held[item[span]] + weight[span] >= LOW).any():
                break
            held[item[span]] += weight[span]
            self.low[t] = True
        # blocks: a dense table of term by item each, maxima of the high terms, bounds of the low ones
        self.blocks = []
        heads: list[tuple] = []
        block = item // BLOCK_ITEMS
        self.rest = np.zeros(-(-len(words) // BLOCK_ITEMS))
        np.maximum.at(self.rest, np.arange(len(words)) // BLOCK_ITEMS, held)
        for b in range(len(self.rest)):
            at = np.flatnonzero(block == b)
            own, row = np.unique(term[at], return_inverse=True)
            dense = np.zeros((len(own), BLOCK_ITEMS))
            dense[row, item[at] - b * BLOCK_ITEMS] = weight[at]
            self.blocks.append((own, dense))
            high = ~self.low[own]
            heads.append((own[high], np.full(high.sum(), b), dense[high].max(axis=1)))
        t, b, w = (np.concatenate(x) for x in zip(*heads))
        order = np.argsort(t, kind="stable")
        self.list_block, self.list_max = b[order], w[order]
        self.list_at = np.r_[0, np.cumsum(np.bincount(t, minlength=len(self.terms)))]

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """The term number of each word, -1 for words of no item."""
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[at] == words, at, -1)

    def open_blocks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(passage, block)`` pairs that may hold an item at the score or above.  Passage ``p``
        is the words from ``p * step`` to ``(p + 2) * step``."""
        at = np.flatnonzero(terms >= 0)
        at = at[~self.low[terms[at]]]
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        chunk, t = at // self.step, terms[at]
        key = np.concatenate([chunk, chunk[chunk > 0] - 1]) * len(self.terms) + np.concatenate([t, t[chunk > 0]])
        key = np.unique(key)
        passage, t = key // len(self.terms), key % len(self.terms)
        n = self.list_at[t + 1] - self.list_at[t]
        ends = np.cumsum(n)
        spot = np.arange(ends[-1]) + np.repeat(self.list_at[t] - (ends - n), n)
        key = np.repeat(passage, n) * len(self.rest) + self.list_block[spot]
        key, inverse = np.unique(key, return_inverse=True)
        bound = np.bincount(inverse, self.list_max[spot])
        passage, block = key // len(self.rest), key % len(self.rest)
        keep = bound + self.rest[block] >= SCORE - 1e-9
        return passage[keep], block[keep]

    def scores(self, terms: np.ndarray, block: int) -> np.ndarray:
        """Scores of the block's items for a passage's term numbers."""
        own, dense = self.blocks[block]
        held = np.unique(terms[terms >= 0])
        at = np.minimum(np.searchsorted(own, held), len(own) - 1)
        return dense[at[own[at] == held]].sum(axis=0)


def common_in_order(a: list, b: list) -> int:
    """Length of the longest common subsequence (bit-parallel over ``a``)."""
    spots: dict = {}
    for i, x in enumerate(a):
        spots[x] = spots.get(x, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for x in b:
        m = spots.get(x)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def leaks_in(index: Index, words: np.ndarray) -> list[tuple]:
    """``(item, score, question overlap, answer overlap)`` of one text, the best passage of each item."""
    terms = index.lookup(words)
    best: dict[int, tuple] = {}
    for p, b in zip(*(x.tolist() for x in index.open_blocks(terms))):
        span = slice(p * index.step, (p + 2) * index.step)
        scores = index.scores(terms[span], b)
        for i in np.flatnonzero(scores >= SCORE - 1e-9).tolist():
            item = b * BLOCK_ITEMS + i
            w, q, text = index.words[item].tolist(), index.questions[item], words[span].tolist()
            ask = common_in_order(w[:q], text) / q
            answer = common_in_order(w[q:], text) / (len(w) - q) if len(w) > q else ask
            if ask >= OVERLAP and answer >= OVERLAP:
                best[item] = max(best.get(item, (0.0, 0.0, 0.0)), (float(scores[i]), ask, answer))
    return [(index.ids[i], *x) for i, x in sorted(best.items())]


def _search(shared, name: str):
    def run(batches):
        held = worker_cache("leak-indexes")
        if name not in held:
            held.clear()
            held[name] = [Index(*group) for group in shared.value]
        for batch in batches:
            ids, ths = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist()
            out: list[list] = [[] for _ in range(6)]
            for row, off, data in text_slices(batch.column("text")):
                words, at = word_hashes(off, data, letters=True)
                words = words.view(np.int64)
                for i in range(len(off) - 1):
                    for index in held[name]:
                        for found in leaks_in(index, words[at[i]:at[i + 1]]):
                            for x, y in zip(out, (ids[row + i], ths[row + i], *found)):
                                x.append(y)
            kinds = [pa.int64()] * 3 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(out, kinds)],
                names=["doc_id", "th", "item_id", "score", "question_overlap", "answer_overlap"])

    return run


def _groups(items, frequency, n_items: int, mean: float) -> list[tuple]:
    """What the indexes of one shard are made of (from Arrow tables of its items and of its
    terms' frequencies): ids, words, question lengths, terms, their weights and the mean length."""
    terms, df = frequency.column("term").to_numpy(), frequency.column("df").to_numpy()
    order = np.argsort(terms)
    terms, idf = terms[order], np.log1p((n_items - df + 0.5) / (df + 0.5))[order]
    groups: dict[int, list] = {}
    for i, w, q in zip(*(items.column(c).to_pylist() for c in ("item_id", "words", "question"))):
        limit = FIRST_LENGTH
        while len(w) > limit:
            limit *= 4
        groups.setdefault(limit, []).append((i, np.array(w, np.int64), q))
    return [(*(list(x) for x in zip(*group)), terms, idf, mean) for _, group in sorted(groups.items())]


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, th, item_id, score, question_overlap, answer_overlap`` for each document of
    ``documents(doc_id, text)`` and item of ``benchmark(item_id, text)`` that it holds; ``th``
    is a hash of the document's text."""
    ship()
    spark = documents.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text"))
    items = save(items.mapInArrow(_item_words, "item_id long, words array<long>, question int")
                 .where(F.size("words") > 0), "items")
    n_items, total = items.agg(F.count("*"), F.sum(F.size("words"))).first()
    text = F.col("text").cast("string")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.lower(text).alias("text"))
    if not n_items:
        return spark.createDataFrame([], _LEAKS)
    frequency = save(items.select(F.explode(F.array_distinct("words")).alias("term"))
                     .groupBy("term").agg(F.count("*").alias("df")), "frequency")
    shards = -(-total // SHARD_WORDS)
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "words"), F.lit(shards)))
    found = None
    for shard in range(shards):
        own = items.where(F.col("shard") == shard).drop("shard")
        terms = own.select(F.explode("words").alias("term")).distinct()
        rows = own.toArrow()
        if not rows.num_rows:
            continue
        shared = spark.sparkContext.broadcast(
            _groups(rows, frequency.join(terms, "term").toArrow(), n_items, total / n_items))
        part = docs.mapInArrow(_search(shared, uuid.uuid4().hex), _LEAKS)
        found = part if found is None else found.unionByName(part)
    return found


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no item, with their columns."""
    found = save(leaks(documents, benchmark).select("doc_id", "th").distinct(), "leaks")
    return released(held(documents).join(
        small(found), (F.xxhash64(F.col("row.text").cast("string")) == F.col("th"))
        & F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id")), "left_anti"))


def op4_bm25_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of ``benchmark`` found in all ``documents``."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")
