import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pitwall.llm import quality_rank as Q
from pitwall.llm import toxic_kernel as X

from .helpers import ODD, docs_of, words

SF = "/root/testdata/sf0.01"


def auc(score, label):
    good, bad = score[label == 1], score[label == 0]
    return np.mean([(bad < g).mean() + 0.5 * (bad == g).mean() for g in good])


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = Q.op1_quality_rank(spark, SF)
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.95
    assert held[held.quality == 1].predicted.mean() > 0.95


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    got = X.op2_toxic_kernel(spark, "/root/testdata/sf0.1")
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    assert auc(held.score.to_numpy(), held.toxic.to_numpy()) > 0.9


def labelled(spark, rng):
    rows, labels = [*ODD], []
    for i in range(240):
        bad = i % 3 == 0
        w = words(rng, rng.randint(20, 120))
        rows.append((i, " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w) + "."))
        labels.append((i, int(not bad), "x"))
    labels += [(None, 1, "x"), (5, None, "x"), (77777, 0, "x"), (3, 0, "x")]
    return docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, text string"), rows


@pytest.mark.parametrize("good,bad", [(300, 7), (5, 11_000)])
def test_every_labelled_document_is_fitted_on(spark, good, bad):
    """Before, at most 3,000 documents of each label were."""
    rows = spark.range(good + bad).select(
        (F.col("id") < good).cast("int").alias("label"), F.xxhash64("id").alias("h"), F.array(F.col("id").cast("double")).alias("x"))
    pairs = Q.paired(rows, {1: good, 0: bad}).select(F.col("better")[0].alias("b"), F.col("worse")[0].alias("w"))
    n, better, worse = pairs.agg(F.count("*"), F.count_distinct("b"), F.count_distinct("w")).first()
    assert (better, worse) == (good, bad) and n >= min(Q.PAIRS, good * bad)
    assert pairs.where(F.col("b") >= good).count() == 0 and pairs.where(F.col("w") < good).count() == 0
    assert Q.total(rows, lambda b: np.array([float(b.num_rows)])).tolist() == [good + bad]


def test_cut_counts_every_document(spark):
    worths = spark.range(20_000).select((F.col("id") >= 8_000).cast("int").alias("label"), (
        F.col("id") / 100 + F.when(F.col("id") >= 8_000, 10).otherwise(0)).alias("worth"))
    mean, spread = worths.agg(F.avg("worth"), F.stddev_pop("worth")).first()
    assert abs(Q.best_cut(worths, mean, spread) - (79.99 + 90) / 2) < 1e-9


def test_quality_of_odd_rows(spark):
    docs, labels, rows = labelled(spark, random.Random(6))
    got = Q.quality_scores(docs, labels, F.col("doc_id") % 4 == 2).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got if r.doc_id is not None and r.doc_id < 240}
    assert all((score[i] < 0.7) == (i % 3 == 0) for i in range(240) if i % 4 == 2)
    kept = Q.accepted(docs, labels)
    assert kept.columns == docs.columns and 150 <= kept.count() <= 175
    assert Q.quality_scores(docs.where("false"), labels).count() == 0
    # one label only: nothing is learned and nothing rejected
    assert {r.score for r in Q.quality_scores(docs, labels.where("quality = 1")).collect()} == {Q.CUT}
    assert Q.accepted(docs, labels.where("false")).count() == len(rows)


def test_bradley_terry_recovers_weights():
    rng = np.random.default_rng(0)
    true = np.array([2.0, -1.0, 0.0, 0.5])
    a, b = rng.normal(size=(20_000, 4)), rng.normal(size=(20_000, 4))
    first = rng.random(20_000) < 1 / (1 + np.exp(-(a - b) @ true))
    w = Q.fit_pairs(np.where(first[:, None], a, b), np.where(first[:, None], b, a))
    assert np.allclose(w, true, atol=0.12)


def test_features_do_not_depend_on_the_batch():
    texts = ["a b c a b c", None, "", "Word " * 400, "x" * 1_200_000, "é!? | 1\n2", "a b c a b c"]
    whole = Q.features(pa.array(texts))
    for i, t in enumerate(texts):
        assert np.allclose(Q.features(pa.array([t], pa.string()))[0], whole[i])
    assert np.isfinite(whole).all() and whole.shape == (7, Q.FEATURES)


def brute_kernel(s, t):
    """Sum over equal subsequences of three letters, by listing them."""
    letter = X._letters()

    def listed(u):
        out = {}
        for i in range(len(u)):
            for j in range(i + 1, len(u)):
                for k in range(j + 1, len(u)):
                    if letter[u[i]] and letter[u[j]] and letter[u[k]]:
                        w = 1.0
                        for p in range(i + 1, k):
                            if p != j:
                                w *= X.LETTER_GAP if letter[u[p]] else X.OTHER_GAP
                        out.setdefault((u[i], u[j], u[k]), []).append(w)
        return out

    a, b = listed(s), listed(t)
    return sum(sum(a[x]) * sum(b[x]) for x in a if x in b)


@pytest.mark.parametrize("s, t", [(b"moron", b"moron"), (b"m.o.r.o.n", b"moron"), (b"moxron", b"moron"), (b"ab", b"abc"),
                                  (b"\x02trash", b"xxtr4shes"), (b"aaaa", b"aaa")])
def test_kernel_as_by_listing(s, t):
    a, _ = X._padded([s])
    b, _ = X._padded([t])
    assert X.subsequence_kernel(a, b)[0] == pytest.approx(brute_kernel(s, t))


def test_own_kernels_are_made_only_where_a_kernel_may_reach_the_floor(monkeypatch):
    rng = random.Random(9)
    units = [b"\x02" + "".join(rng.choice("moratidlpehc. ") for _ in range(rng.randint(1, 30))).encode() for _ in range(400)]
    s, _ = X._padded(units)
    own = X.own_kernel(s)
    assert (X.least_own_kernel(s) <= own * (1 + 1e-12)).all()
    marks = X.Landmarks([b"\x02moron", b"pathetic", b"idiot"])
    row, z = (x.ravel() for x in np.indices((len(s), 3)))
    want = X.subsequence_kernel(s[row], marks.bytes[z]) / np.sqrt(np.maximum(own[row], 1e-12) * marks.own[z])
    made = []
    monkeypatch.setattr(X, "own_kernel", lambda part: made.append(len(part)) or X.subsequence_kernel(part, part))
    assert np.allclose(marks._pairs(s, row, z), np.where(want < X.FLOOR, 0, want))
    assert 0 < sum(made) < len(s) / 2


def test_words_are_taken_from_the_text_as_units():
    data = np.frombuffer(b"Mo  ron\tis it", np.uint8)
    starts, ends = np.array([0, 4, 8, 11]), np.array([2, 7, 10, 13])
    units = X._marked(data, starts, ends, np.array([0, 2, 1]), 2)
    assert units.flat.tobytes() == b"\x02Mo ron\x02is it\x02ron is" and units.lengths.tolist() == [7, 6, 7]
    marks = X.Landmarks([b"\x02moron"])
    assert (marks.kernels(units) == marks.kernels([b"\x02Mo ron", b"\x02is it", b"\x02ron is"])).all()
    long = b"\x02" + b"xyz" * 50 + b"moron" + b"zyx" * 20
    assert marks.kernels([b"\x02moron", long, b"\x02it"])[:, 0].astype(bool).tolist() == [True, True, False]


def test_gaps_and_inserted_letters_are_tolerated():
    marks = X.Landmarks([b"\x02moron", b"\x02pathetic"])
    k = marks.kernels([b"\x02moron", b"\x02m.o.r.o.n!", b"\x02mo-ron", b"\x02moxron", b"\x02m o r o n", b"\x02morning", b"\x02the"])
    assert k[0, 0] == pytest.approx(1) and (k[1:5, 0] > 0.4).all()
    assert k[5, 0] < 0.6 and not k[6].any()


def test_the_bound_of_known_units_changes_no_kernel(monkeypatch):
    rng = random.Random(4)
    texts = pa.array([f"{' '.join(words(rng, 30))}. moron so. m o r o n at {w}. pathetic s c u m"
                      for w in words(rng, 20)])

    def read(bound):
        monkeypatch.setattr(X, "_CACHE", bound)
        reader = X.Reader(X.Landmarks([b"\x02moron", b"\x02pathetic", b"\x02scum"]))
        return [(row, s, k.tolist()) for _ in range(3) for row, s, k in reader.sentences(texts)]

    assert read(5) == read(1_000_000)


@pytest.mark.parametrize("mark", [b"", b"\x02"])
@pytest.mark.parametrize("word", ["idiot", "clown", "loser", "scum", "moron", "pathetic"])
def test_an_insult_within_long_units_and_in_pieces(word, mark):
    reader = X.Reader(X.Landmarks([mark + word.encode()]))
    spaced = " ".join("youshouldknowthatthisis" + word + "behaviourfromthebeginning")
    glued = "wxyzbkqvhfjdgup" + word + "gjvkqzwhyxbfdup"
    cut = [f"{word[:i]} {word[i:]}" for i in range(2, len(word) - 1)]
    texts = [spaced, glued, "a" * 200 + glued + "b" * 200, *(f"what {c} said so. well" for c in cut)]
    best = np.zeros(len(texts))
    for row, _, k in reader.sentences(pa.array(texts)):
        best[row] = max(best[row], k[0])
    assert (best[:3] > 0.3).all() and (best[3:] > 0.8 if mark else best[3:] > 0.6).all()
    # words of two sentences or of two texts are no pieces of one
    apart = pa.array([f"so {word[:2]}. {word[2:]} it", f"so {word[:2]}", f"{word[2:]} it"])
    assert all(k[0] < 0.8 for _, _, k in X.Reader(X.Landmarks([b"\x02" + word.encode()])).sentences(apart))


def toxic_corpus(spark, rng):
    bad = ["moron", "pathetic", "scum", "clown"]
    rows, labels = [*ODD], []
    for i in range(400):
        text = [" ".join(words(rng, rng.randint(4, 12))) + "." for _ in range(rng.randint(2, 8))]
        toxic = i % 4 == 0
        if toxic:
            for b in rng.sample(bad, rng.randint(1, 3)):
                text[rng.randrange(len(text))] = f"{b} " + " ".join(words(rng, 4)) + "."
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic), "x"))
    rows += [(1000, "well m.o.r.o.n that is it. Fine."), (1001, "p a t h e t i c really. so"), (1002, "fine weather. nothing to say")]
    labels += [(None, 1, "x"), (7, None, "x"), (88888, 1, "x")]
    return docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, text string"), rows


def test_toxic_texts_and_odd_rows(spark):
    docs, labels, rows = toxic_corpus(spark, random.Random(12))
    got = X.toxicity(docs, labels, F.col("doc_id") % 5 == 0).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    held = [i for i in range(400) if i % 5 == 0]
    assert np.mean([(score[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.97
    assert score[1000] >= 0.5 and score[1001] >= 0.5 and score[1002] < 0.5
    assert score[9001] == score[9002] < 0.5
    again = {r.doc_id: r.score for r in X.toxicity(docs.repartition(5), labels, F.col("doc_id") % 5 == 0).collect()}
    assert all(again[d] == pytest.approx(s) for d, s in score.items() if d is not None)
    assert X.toxicity(docs.where("false"), labels).count() == 0
    assert {r.score for r in X.toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}
