import corpus_pipeline as P
from pitwall.llm.common import save, table
from pitwall.llm.huffman_file import token_files
from pitwall.llm.queries import ORACLE_SQL, QUERIES

from .helpers import SF
from .test_ngram_join import brute


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, []
    for name, stage in P.STAGES[:-1]:
        docs = save(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        kept.append([(r.doc_id, r.text, r.source) for r in docs.collect()])
    quality, near, clean, mixed = kept
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    total = table(spark, SF, "documents").count()
    assert len(quality) < total
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in {k[0] for k in quality} for d in good) >= 0.97 * len(good)
    # one of each group of near copies, by brute force over what the first stage kept
    parts = brute([k[:2] for k in quality], 5, 80)
    assert sorted(k[0] for k in near) == sorted({c if n else d for d, n, c in parts})
    plain = lambda t: " " + " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split()) + " "
    bench = [plain(r.text) for r in table(spark, SF, "benchmark").collect()]
    held = {d for d, t, _ in near if any(b in plain(t or "") for b in bench)}
    assert {k[0] for k in clean} == {k[0] for k in near} - held and held
    assert {k[0] for k in mixed} <= {k[0] for k in clean} and mixed
    files = token_files(docs).collect()
    assert sorted(r.doc_id for r in files) == sorted(k[0] for k in mixed)
    assert {c for c in P.STAGES[-1][1](spark, docs, SF).columns} == {"doc_id", "start", "n_tokens", "ids_crc32"}


def test_stage_names():
    assert [n for n, _ in P.STAGES] == ["quality", "near_copies", "decontamination", "mixing", "tokens"]
    assert P.ORACLE_SQL is None


def test_registered_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)
