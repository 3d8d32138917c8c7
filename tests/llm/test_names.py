"""The pipeline's stages with columns that are called as names used inside, and the order of far ids."""

import random

import pytest
from pyspark.sql import functions as F

from pitwall.llm import scaled_sketch as K
from pitwall.llm.bm25_leaks import decontaminated
from pitwall.llm.ngram_join import without_near_copies
from pitwall.llm.pareto_mix import mix, mixed
from pitwall.llm.quality_rank import accepted

from .helpers import docs_of, words

NAMES = ["__copy", "__digest", "__size", "__plan", "mix_plan", "__id", "__th", "__leak_id", "__leak_th", "row", "plan", "digest",
         "th", "col", "copies", "a.b", "back`tick", "with space", "root", "run", "copy", "item_id", "label", "quality"]


@pytest.fixture(scope="module")
def named(spark):
    rng = random.Random(3)
    item = " ".join(words(rng, 30))
    rows = [(i, " ".join(words(rng, 40)), "ab"[i % 2]) for i in range(30)]
    rows += [(100, rows[0][1], "a"), (101, f"{rows[1][1]} {item}.", "b"), (5, rows[5][1], "b")]
    docs = docs_of(spark, rows).withColumns({n: F.concat(F.lit("v"), F.col("doc_id")) for n in NAMES})
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, item + ". " + " ".join(words(rng, 9)))], "item_id long, text string")
    return docs.checkpoint(), labels, benchmark


def same_rows(got, docs, within=True):
    assert got.columns == docs.columns and got.schema.simpleString() == docs.schema.simpleString()
    mine = {tuple(r) for r in docs.collect()}
    rows = [tuple(r) for r in got.collect()]
    assert rows and set(rows) <= mine
    return rows


def test_quality_keeps_columns(named):
    docs, labels, _ = named
    same_rows(accepted(docs, labels), docs)


def test_near_copies_keeps_columns(named):
    docs, _, _ = named
    rows = same_rows(without_near_copies(docs), docs)
    assert sorted(r[0] for r in rows) == sorted([*range(30), 101])


def test_decontamination_keeps_columns(named):
    docs, _, benchmark = named
    assert len(same_rows(decontaminated(docs, benchmark), docs)) >= 30


def test_mixing_keeps_columns(named):
    docs, _, _ = named
    same_rows(mix(docs), docs)
    planned = mixed(docs)
    assert planned.columns == [c for c in docs.columns if c != "mix_plan"] + ["mix_plan"]
    assert all(0 <= r["mix_plan"]["copies"] <= 3 for r in planned.collect())


def test_sketches_of_ids_at_both_ends(spark):
    far = [-(1 << 63), (1 << 63) - 1, 0, 5, None, 5, -(1 << 62)]
    rows = [(d, f"text number {i} of some few words here") for i, d in enumerate(far)]
    got = K.fingerprints(docs_of(spark, rows)).collect()
    order = sorted(far, key=lambda d: (d is not None, d or 0))
    assert sorted((r.doc_id for r in got), key=lambda d: (d is not None, d or 0)) == order
    assert all(0 <= r.near_next <= 1 for r in got)
