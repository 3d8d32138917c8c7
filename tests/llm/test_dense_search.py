import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import types as T

from pitwall.llm import dense_search as S

from .helpers import ODD, SF, docs_of, words

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("term", T.StringType()), T.StructField("shard", T.StringType())])
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, top):
    docs = [(d, terms_of(t)) for d, t in docs if terms_of(t)]
    n, length = len(docs), sum(len(t) for _, t in docs)
    df = Counter(t for _, ts in docs for t in set(ts))
    texts = {}
    for i, t in items:
        texts.setdefault(i, set()).update(terms_of(t))
    out = []
    for i, ts in texts.items():
        found = []
        for d, words_ in docs:
            m, tf = 50 + 50 * len(words_) * n // length, Counter(words_)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                        for t in ts & tf.keys())
            if score > 0:
                found.append((-score, d is None, d))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(i, k + 1, d, -s) for k, (s, _, d) in enumerate(found[:top])]
    return out


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], ITEMS).repartition(2)


def key(r):
    return (r[0] is None, r[0] or 0, r[1])


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # many shards, tiles and slices
        for name, value in (("ITEMS", 2), ("TERMS", 9), ("DOCS", 3), ("COLUMNS", 2), ("_SLICE", 7)):
            monkeypatch.setattr(S, name, value)
    rng = random.Random(4)
    pool = words(rng, 30) + ["Ünï", "日本", "X9", "z'z"]
    docs = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    docs += [(100 + i, docs[3][1]) for i in range(20)] + [(5, docs[5][1]), (None, docs[3][1]), *ODD]
    docs += [(900, " ".join(rng.choice(pool) for _ in range(30_000)))]  # very long
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(9)]
    items += [(3, "another one"), (None, pool[0]), (50, None), (51, ""), (52, "?!"), (53, "nowhere"), items[0]]
    got = S.search(docs_of(spark, docs), items_of(spark, items), top=7).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(docs, items, 7), key=key)


def test_narrow_sums(spark, monkeypatch):
    """Columns of a tile follow the bound on partial sums; results don't."""
    docs = [(i, f"a b c{i % 3} d") for i in range(9)]
    items = [(1, "a b c0 d c1"), (2, "c2")]
    monkeypatch.setattr(S, "EXACT", 10)
    got = S.search(docs_of(spark, docs), items_of(spark, items)).collect()
    assert sorted(map(tuple, got)) == sorted(brute(docs, items, 50))


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None), (2, "")], [(1, "a")]), ([], [])])
def test_nothing_found(spark, docs, items):
    got = S.search(docs_of(spark, docs), items_of(spark, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.collect() == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    want = con.execute(S.OP11_SQL).fetchall()
    got = S.op11_dense_search(spark, SF).select("item_id", "rank", "doc_id", "score").collect()
    assert want and sorted(map(tuple, got)) == sorted(want)
