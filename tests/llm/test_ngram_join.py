import random

import numpy as np
import pyarrow as pa

from pitwall.llm import ngram_join as J
from pitwall.llm.graph import components
from pitwall.llm.shingles import set_key, shingle_sets
from pitwall.plans.compare import compare, duckdb_connect

from .helpers import ODD, SF, docs_of, words


def shingles(text, k):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                group[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def corpus():
    """Exact copies, a family of near copies at many distances, chains, and a passage in every text."""
    rng = random.Random(3)
    common = words(rng, 30)
    rows, base = list(ODD), words(rng, 120)
    for i in range(60):
        w = base[:]
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = words(rng, 1)[0]
        rows.append((100 + i, " ".join(w)))
    chain = words(rng, 80)
    for i in range(12):
        rows.append((300 + i, " ".join(chain)))
        chain = chain[1:] + words(rng, 1)
    for i in range(60):
        rows.append((400 + i, " ".join(words(rng, rng.randint(10, 90)) + common + words(rng, 20))))
    rows += [(500 + i, "the same Text  for many ids\nof a copy") for i in range(8)] + [(None, "the same text for many ids of a copy")]
    return rows


def test_components_as_by_brute_force(spark):
    rows = corpus()
    for k, percent in ((4, 85), (5, 80)):
        found = J.ngram_join(docs_of(spark, rows), k, percent).select("doc_id", "n_shingles", "component_id").collect()
        key = lambda r: tuple((x is None, x or 0) for x in r)
        assert sorted(map(tuple, found), key=key) == sorted(brute(rows, k, percent), key=key)


def test_links_hold_whatever_the_limits(spark, monkeypatch):
    """Salting, bucketing and the order of hot tokens change the work only."""
    rows = corpus()
    for name, value in (("HOT", 2), ("SALT_TOKENS", 300), ("UNION_TOKENS", 200), ("ROUNDS", 1), ("COUNT_TOKENS", 500)):
        monkeypatch.setattr(J, name, value)
    found = J.ngram_join(docs_of(spark, rows), 4, 85).select("doc_id", "n_shingles", "component_id").collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows, 4, 85), key=key)


def test_query_matches_its_sql(spark):
    rep = compare(J.op10_ngram_join(spark, SF), duckdb_connect(SF), J.OP10_SQL)
    assert rep["ok"], rep


def test_one_of_each_group_stays(spark):
    rows = corpus() + [(500, "the same Text  for many ids\nof a copy")]
    kept = J.without_near_copies(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=lambda d: (d is None, d or 0))
    parts = brute(rows, 5, 80)
    first = {}
    for (d, n, c), (_, t) in zip(parts, rows):
        if n and c is not None:
            first.setdefault(c, d if d == c else None)
    empty = [d for d, n, _ in parts if not n]
    alone = [d for d, n, c in parts if n and c is None]
    want = [c for c in first] + empty + alone
    assert ids == sorted(want, key=lambda d: (d is None, d or 0))


def test_empty_table(spark):
    empty = docs_of(spark, [(1, "x")]).where("false")
    assert J.ngram_join(empty).count() == 0
    assert J.without_near_copies(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(900, 1000)] + [(5, 5), (2000, 2001)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 900 for i in range(901, 1001)}, 2001: 2000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingle_hashes_follow_the_words():
    texts = ["A b  c\td e", "a B c d e", "a b c d", "", None, "x", "xa b c d e", "é É", "a" * 3_000_000 + " b c d e f"]
    sets = dict(shingle_sets(pa.array(texts), 4))
    assert list(sets) == list(range(len(texts)))
    assert set_key(sets[0]) == set_key(sets[1]) and len(sets[0]) == 2
    assert np.isin(sets[2], sets[0]).all() and len(sets[2]) == 1
    assert len(sets[3]) == len(sets[4]) == 0 and len(sets[5]) == len(sets[7]) == 1
    assert len(np.intersect1d(sets[6], sets[0])) == 1 and len(sets[8]) == 3
