"""Quality classifier: Bradley-Terry ranking of documents.

A document's worth is linear in features of its whole text.  They are learned from
preference pairs (a document labelled good is preferred to one labelled bad) by logistic
loss on the difference of the two documents' features.  The worth is then cut at a quantile
of the training documents' worths, the one that tells their labels apart best, and mapped
to 0..1 so that the cut lies at 0.7.

Features are counts of character kinds, word lengths and repetitions, each as a piecewise
linear function with knots at quantiles of the training documents.  They are taken from each text once
and saved.  Knots, scales, weights and cut come from all labelled documents: the documents of each label are
numbered in order of a hash of their ids, each one of the commoner label is paired with the next one of
the rarer label (turn by turn, until there are ``PAIRS`` pairs at least), and each step of the
fit is a sum over all pairs.  The driver holds such sums, never rows; the cut's place is exact up to
documents of one of ``CELLS`` cells of worth.

Defined cases: null and empty texts have features of no characters and are scored like any
other; a label of null, or of a document that isn't there, is not used; a document with several
labels counts with each; rows with a null ``doc_id`` are scored and never trained on; if one of the
labels is absent from the training rows every document scores 0.7 (kept); repeated rows score
alike; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import held, mapped, released, save, ship, small, table
from pitwall.llm.shingles import mix64, text_slices, word_hashes

#: Fewer pairs than this are made only where the labels give no more.
PAIRS = 10_000
#: Cells of worth between which the cut may lie.
CELLS = 1 << 16
#: Documents of the rarer label up to which they are broadcast to be paired.
PAIRED_ROWS = 20_000
KNOTS = (0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98)
CUT = 0.7

#: The character kinds that are counted (bytes of UTF-8).
KINDS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c",
    b".", b",", b"!", b"?", b":;", b"'\"", b"()[]{}", b"#$%&*@^~+=", b"|", b"<>/\\", b"-_", bytes(range(128, 256)),
)
FEATURES = len(KINDS) + 10


def features(column) -> np.ndarray:
    """A row of numbers for each text of an Arrow column."""
    kind = np.full(256, len(KINDS), np.intp)
    for i, k in enumerate(KINDS):
        kind[list(k)] = i
    upper = np.zeros(256, bool)
    upper[65:91] = True
    parts = []
    for _, off, data in text_slices(column):
        n = len(off) - 1
        sizes = np.diff(off)
        row = np.repeat(np.arange(n), sizes)
        counts = np.bincount(row * (len(KINDS) + 1) + kind[data], minlength=n * (len(KINDS) + 1)).reshape(n, -1)
        out = np.zeros((n, FEATURES))
        out[:, :len(KINDS)] = counts[:, :-1] / np.maximum(sizes, 1)[:, None]
        words, at = word_hashes(off, data)
        nw = np.diff(at)
        wrow = np.repeat(np.arange(n), nw)
        base = len(KINDS)
        out[:, base] = np.log1p(sizes)
        out[:, base + 1] = np.log1p(nw)
        out[:, base + 2] = (sizes - counts[:, 3] - counts[:, 4] - counts[:, 5]) / np.maximum(nw, 1)
        out[:, base + 3] = counts[:, 0] / np.maximum(counts[:, 0] + counts[:, 1], 1)
        same = np.r_[False, (words[1:] == words[:-1]) & (wrow[1:] == wrow[:-1])] if len(words) else np.zeros(0, bool)
        out[:, base + 4] = np.bincount(wrow, same, minlength=n) / np.maximum(nw, 1)
        for j, k in ((5, 1), (6, 2), (7, 6)):
            gram, grow = words, wrow
            for step in range(1, k):
                gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[step:]
                grow = wrow[:len(gram)]
            inside = wrow[k - 1:] == grow if k > 1 else np.ones(len(words), bool)
            gram, grow = gram[inside], grow[inside]
            distinct, most = _repeats(gram, grow, n)
            total = np.bincount(grow, minlength=n)
            out[:, base + j] = distinct / np.maximum(total, 1)
            if k == 1:
                out[:, base + 8] = most / np.maximum(total, 1)
        out[:, base + 9] = (counts[:, 6] + counts[:, 8] + counts[:, 9]) / np.maximum(nw, 1)
        parts.append(out)
    return np.concatenate(parts) if parts else np.zeros((0, FEATURES))


def _repeats(gram: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and how often its commonest one stands there.  A value is
    told from others of its row by 40 bits of its hash."""
    if not len(gram):
        return np.zeros(n), np.zeros(n)
    key = np.sort((row.astype(np.uint64) << np.uint64(40)) | (mix64(gram) >> np.uint64(24)))
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    runs, r = np.diff(np.r_[first, len(key)]), (key[first] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, r, runs)
    return np.bincount(r, minlength=n), most


def expand(x: np.ndarray, knots: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Piecewise linear functions of each feature: itself and what exceeds each knot."""
    parts = [x[:, :, None], np.maximum(0.0, x[:, :, None] - knots[None, :, :])]
    return np.concatenate(parts, axis=2).reshape(len(x), -1) / scale


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def total(rows: DataFrame, vector) -> np.ndarray:
    """Sum of ``vector(batch)`` over all batches of ``rows``: added up in each task, then by Spark."""
    def run(batches):
        held = None
        for batch in batches:
            if batch.num_rows:
                held = vector(batch) if held is None else held + vector(batch)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held)), pa.int32()), pa.array(held)], names=["at", "v"])

    found = mapped(rows, run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(found.num_rows)
    out[found.column("at").to_numpy()] = found.column("v").to_numpy()
    return out


def numbered(rows: DataFrame) -> DataFrame:
    """``label, x, place``: the rows of each label from 0, in order of ``h``; counted by slices of ``h``,
    so no task sees a whole label."""
    rows = rows.withColumn("slice", F.shiftrightunsigned("h", 52))
    before = Window.partitionBy("label").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("label", "slice").agg(F.count(F.lit(1)).alias("n")).select(
        "label", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("label", "slice").orderBy("h", "x")
    return rows.withColumn("nth", F.row_number().over(own) - 1).join(F.broadcast(slices), ["label", "slice"]).select(
        "label", "x", (F.col("first") + F.col("nth")).alias("place"))


def paired(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``better, worse``: every document of ``rows`` in a pair with one of the other label."""
    rare = 0 if counts[0] <= counts[1] else 1
    turns = min(counts[rare], -(-PAIRS // counts[1 - rare]))
    placed = save(numbered(rows), "placed")
    few = placed.where(F.col("label") == rare).select(F.col("x").alias("few"), F.col("place").alias("at"))
    many = placed.where(F.col("label") != rare).select(F.col("x").alias("many"), F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(turns - 1)), lambda t: (F.col("place") + t) % counts[rare])).alias("at"))
    both = many.join(small(few, PAIRED_ROWS), "at")
    return both.select(F.col("few" if rare else "many").alias("better"), F.col("many" if rare else "few").alias("worse"))


def _slopes(d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number, gradient and curvature of the logistic loss of the differences ``d``, as one vector."""
    p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
    return np.r_[float(len(d)), -(d.T @ p), ((d * (p * (1 - p))[:, None]).T @ d).ravel()]


def _newton(slopes, size: int, penalty: float, rounds: int) -> np.ndarray:
    w = np.zeros(size)
    for _ in range(rounds):
        found = slopes(w)
        gradient = found[1:size + 1] / found[0] + penalty * w
        curve = found[size + 1:].reshape(size, size) / found[0] + penalty * np.eye(size)
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_pairs(better: np.ndarray, worse: np.ndarray, penalty: float = 1e-3, rounds: int = 15) -> np.ndarray:
    """Bradley-Terry weights from rows preferred to rows, by Newton's method on the logistic loss."""
    d = better - worse
    return _newton(lambda w: _slopes(d, w), d.shape[1], penalty, rounds)


def fit_all(pairs: DataFrame, knots: np.ndarray, scale: np.ndarray, penalty: float = 1e-3, rounds: int = 15) -> np.ndarray:
    """``fit_pairs`` of the features of ``pairs(better, worse)``; each round is one pass over all of them."""
    def slopes(w):
        def parts(batch):
            better, worse = (expand(_matrix(batch.column(c)), knots, scale) for c in ("better", "worse"))
            return _slopes(better - worse, w)

        return total(pairs, parts)

    return np.round(_newton(slopes, len(scale), penalty, rounds), 9)  # sums are added in no fixed order


def best_cut(worths: DataFrame, mean: float, spread: float) -> float:
    """The worth at which the labels part best: the middle of the widest gap between neighbouring cells
    among those of the same balanced accuracy.  Cells are even in the logistic of the worth."""
    at = F.lit(float(CELLS)) / (F.lit(1.0) + F.exp(-(F.col("worth") - mean) / spread))
    cells = worths.groupBy(F.least(F.floor(at), F.lit(CELLS - 1)).alias("cell")).agg(
        F.sum("label").alias("good"), F.count(F.lit(1)).alias("n"), F.min("worth").alias("low"), F.max("worth").alias("high"))
    c = cells.toArrow().sort_by("cell")
    good, n, low, high = (c.column(name).to_numpy() for name in ("good", "n", "low", "high"))
    if len(n) < 2:
        return mean
    bad = n - good
    right = (np.cumsum(bad) / bad.sum() + 1 - np.cumsum(good) / good.sum())[:-1]
    gaps = low[1:] - high[:-1]
    near = np.flatnonzero(right >= right.max() - 1e-12)
    i = near[np.argmax(gaps[near])]
    return float((high[i] + low[i + 1]) / 2)


def train(rows: DataFrame) -> dict | None:
    """The model: knots, scales, weights, cut and spread of the worths, from all of ``rows(label, h, x)``."""
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    quantiles = rows.agg(*[F.percentile_approx(F.col("x")[i], list(KNOTS), 10_000).alias(f"x{i}")
                           for i in range(FEATURES)]).first()
    knots = np.array(quantiles, dtype=float)
    n, ones = sum(counts.values()), np.ones(FEATURES * (len(KNOTS) + 1))
    mean = total(rows, lambda b: expand(_matrix(b.column("x")), knots, ones).sum(axis=0)) / n
    std = np.sqrt(total(rows, lambda b: ((expand(_matrix(b.column("x")), knots, ones) - mean) ** 2).sum(axis=0)) / n)
    scale = np.where(std > 1e-12, std, np.inf)
    w = fit_all(save(paired(rows, counts), "pairs"), knots, scale)

    def worth(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), pa.array(expand(_matrix(b.column("x")), knots, scale) @ w)], names=["label", "worth"])

    worths = save(mapped(rows.select("label", "x"), worth, "label int, worth double"), "worths")
    middle, spread = worths.agg(F.avg("worth"), F.stddev_pop("worth")).first()
    spread = max(1e-9, float(spread))
    return {"knots": knots, "scale": scale, "w": w, "cut": best_cut(worths, float(middle), spread), "spread": spread}


def score(x: np.ndarray, model: dict | None) -> np.ndarray:
    if model is None:
        return np.full(len(x), CUT)
    worth = (expand(x, model["knots"], model["scale"]) @ model["w"] - model["cut"]) / model["spread"]
    return 1 / (1 + np.exp(-np.clip(3 * worth + np.log(CUT / (1 - CUT)), -500, 500)))


def _featured(batches):
    for batch in batches:
        x = features(batch.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * FEATURES, pa.int32()), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), lists], names=["doc_id", "th", "x"])


def _scored(model):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(score(_matrix(batch.column("x")), model.value))],
                names=["doc_id", "th", "score"])

    return run


def sample_of(labels: DataFrame, label: str, training: Column, most: int) -> DataFrame:
    """Up to ``most`` ids of each label among the training rows: those of least hash."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & training)
    parts = [rows.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for v in (0, 1)]
    return parts[0].unionByName(parts[1]).distinct()


def fit(featured: DataFrame, labels: DataFrame, held_out: Column) -> dict | None:
    """Fit the model on ``featured(doc_id, x)`` by all rows of ``labels(doc_id, quality)`` for which
    ``held_out`` (an expression over ``doc_id``) is false."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    ids = ids.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out).distinct()
    rows = featured.select(F.col("doc_id").alias("id"), "x").join(ids, F.col("id") == F.col("doc_id"))
    return train(save(rows.select("label", F.xxhash64("doc_id").alias("h"), "x"), "training"))


def quality_scores(documents: DataFrame, labels: DataFrame, held_out: Column | None = None) -> DataFrame:
    """``doc_id, th, score`` for every row of ``documents(doc_id, text)``; ``th`` is a hash of its text."""
    ship()
    text = F.col("text").cast("string")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    featured = save(mapped(docs, _featured, "doc_id long, th long, x array<double>"), "features")
    model = fit(featured, labels, F.lit(False) if held_out is None else held_out)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return mapped(featured, _scored(shared), "doc_id long, th long, score double")


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that score ``CUT`` or more, learned from all labels."""
    low = save(quality_scores(documents, labels).where(F.col("score") < CUT)
               .select("doc_id", "th").distinct(), "rejected")
    return released(held(documents).join(
        small(low), F.xxhash64(F.col("row.text").cast("string")).eqNullSafe(F.col("th"))
        & F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id")), "left_anti"))


def crc_fold(folds: int, fold: int) -> Column:
    return F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % folds == fold


def op1_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all ``documents``, learned from the labels of three folds of four."""
    held = crc_fold(4, 2)
    found = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held)
    return found.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= CUT).cast("int").alias("predicted"))
