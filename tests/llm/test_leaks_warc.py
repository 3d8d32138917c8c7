import gzip
import io
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pitwall.llm import bm25_leaks as B
from pitwall.llm import warc_audit as W
from pitwall.llm.shingles import text_slices, word_hashes
from pitwall.session import scratch_path

from .helpers import ODD, SF, docs_of, words


def hashes(text):
    (_, off, data), = text_slices(pa.array([text]))
    return word_hashes(off, data, letters=True)[0].view(np.int64)


def items(rng, n=90):
    out = []
    for i in range(n):
        w = words(rng, rng.randint(6, 60)) + ["the", "of"] * 3
        rng.shuffle(w)
        out.append((i, " ".join(w[:len(w) // 2]).capitalize() + ". " + " ".join(w[len(w) // 2:]) + "."))
    return out


def index_of(rows):
    w = [hashes(t.lower()) for _, t in rows]
    terms, df = np.unique(np.concatenate([np.unique(x) for x in w]), return_counts=True)
    idf = np.log1p((len(w) - df + 0.5) / (df + 0.5))
    return B.Index([i for i, _ in rows], w, [len(x) // 2 for x in w], terms, idf, float(np.mean([len(x) for x in w])))


def test_pruning_loses_no_item():
    rng = random.Random(2)
    rows = items(rng)
    index = index_of(rows)
    for _ in range(40):
        text = words(rng, rng.randint(0, 300))
        for _, t in rng.sample(rows, 3):
            part = t.lower().replace(".", "").split()
            a = rng.randrange(len(text) + 1)
            text[a:a] = part[:rng.randint(1, len(part))]
        h = hashes(" ".join(text))
        terms = index.lookup(h)
        opened = set(zip(*(x.tolist() for x in index.open_blocks(terms))))
        for p in range(len(h) // index.step + 1):
            held = set(h[p * index.step:(p + 2) * index.step].tolist())
            for i, w in enumerate(index.words):
                own, row = index.blocks[i // B.BLOCK_ITEMS]
                score = sum(row[k, i % B.BLOCK_ITEMS] for k, t in enumerate(own) if int(index.terms[t]) in held)
                assert score < B.SCORE or (p, i // B.BLOCK_ITEMS) in opened


@pytest.mark.parametrize("a, b", [("abcde", "axbxcxdxe"), ("abc", ""), ("aabb", "abab"), ("xyz", "zyx")])
def test_common_in_order(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert B.common_in_order(list(a), list(b)) == table[-1][-1]


def test_leaks_are_found_and_clean_texts_left(spark, monkeypatch):
    rng = random.Random(4)
    bench = items(rng) + [(500, " ".join(words(rng, 400)) + ". " + " ".join(words(rng, 90))), (501, None), (502, "?!")]
    rows, want = list(ODD), set()
    for i in range(80):
        text = words(rng, rng.randint(0, 500))
        for item, t in rng.sample(bench[:91], i % 3):
            t = t.upper() if i % 2 else t
            w = t.split()
            if len(w) > 30 and i % 5 == 0:
                w[7] = "changed"  # one word of the question is another
            a = rng.randrange(len(text) + 1)
            text[a:a] = [" ".join(w)]
            want.add((1000 + i, item))
        rows.append((1000 + i, " ".join(text)))
    # half of an item, or its question alone, is no leak
    rows += [(2000 + i, " ".join(words(rng, 50)) + " " + bench[i][1].split(".")[0]) for i in range(20)]
    schema = "item_id long, text string, doc_id string, score string"
    frame = spark.createDataFrame([(i, t, "a", "b") for i, t in bench], schema)
    docs = docs_of(spark, rows)
    got = B.leaks(docs, frame).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    clean = B.decontaminated(docs, frame)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.select("doc_id").collect()) == sorted(
        str(d) for d, _ in rows if d not in {d for d, _ in want})
    monkeypatch.setattr(B, "SHARD_WORDS", 700)
    assert {(r.doc_id, r.item_id) for r in B.leaks(docs, frame).collect()} == want
    assert B.leaks(docs.where("false"), frame).count() == 0
    assert B.decontaminated(docs, frame.where("false")).count() == len(rows)


def test_query_against_verbatim_search(spark):
    docs = [(r.doc_id, " ".join(hashes((r.text or "").lower()).astype(str)))
            for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bench = [(r.item_id, " ".join(hashes(r.text.lower()).astype(str))) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i, b in bench if f" {b} " in f" {t} "}
    assert want <= {(r.doc_id, r.item_id) for r in B.op4_bm25_leaks(spark, SF).collect()}


# --- WARC -------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def pages_of(spark, n, parts=3):
    rng = random.Random(n)
    rows = [(i, f"http://h/{i}", "<p>" + " ".join(words(rng, rng.randint(0, 400))) + "</p>") for i in range(n)]
    return spark.createDataFrame(rows + [(None, None, None), (3, "again", "é" * 9)] * bool(n), PAGES).coalesce(parts)


def written(spark, pages, damage=None):
    path = scratch_path(spark, "test-warc")
    W.write_warc(pages, path, damage)
    return path


def test_files_are_gzip_members(spark):
    path = written(spark, pages_of(spark, 40, 1))
    data = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).first().content
    records = []
    while data:
        z = zlib.decompressobj(31)
        records.append(z.decompress(bytes(data)))
        data = z.unused_data
    assert len(records) == 42 and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    for r in records:
        head, body = r.split(b"\r\n\r\n", 1)
        assert f"Content-Length: {len(body) - 4}".encode() in head


def test_long_records_end_in_a_zero_byte():
    assert W.member(1, "u", "x" * (17 << 20))[-1] == 0


def test_query_finds_the_planted_damage(spark):
    ids = [r.page_id for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = W.op9_warc_audit(spark, SF).collect()
    assert {(r.page_id, r.change) for r in got} == {(p, "changed") for p in ids if p % 101 == 7 or p % 503 == 11}


def test_audit_as_by_comparing_bytes(spark, monkeypatch):
    monkeypatch.setattr(W, "RANGE", 1 << 10)
    monkeypatch.setattr(W, "FANOUT", 3)
    pages = pages_of(spark, 200)

    def damage(p, m):
        return m[:20] + bytes([m[20] ^ 1]) + m[21:] if p is not None and p % 50 == 9 else m

    a, b = (W.hash_replica(spark, written(spark, pages, d)) for d in (None, damage))
    assert W.audit(a, a).count() == 0
    assert sorted(r.page_id for r in W.audit(a, b).collect()) == [9, 59, 109, 159]
    # a shorter replica: the records that it lacks, from either side
    short = a.where(~((F.col("shard") == 0) & (F.col("kind") == 0) & (F.col("start") > 20_000)))
    records = [(r.start, r.length, bytes(r.digest)) for r in short.where("kind = 0 AND shard = 0").orderBy("start").collect()]
    nodes = spark.createDataFrame([(1, 0, lv, n, None, None, None, bytearray(d)) for lv, n, d in W.tree(records)], W._HASHES)
    short = short.where("NOT (kind = 1 AND shard = 0)").unionByName(nodes)
    lost = a.where("kind = 0 AND shard = 0 AND start > 20000").count()
    assert lost > 0
    assert [(r.change, r["count"]) for r in W.audit(a, short).groupBy("change").count().collect()] == [("missing", lost)]
    assert [(r.change, r["count"]) for r in W.audit(short, a).groupBy("change").count().collect()] == [("extra", lost)]
    whole = a.where("shard <> 1")
    assert {r.shard for r in W.audit(a, whole).collect()} == {1}


def foreign(rng, page, size):
    """A record as other writers store it: name and time in the header, or another level, or two deflate blocks."""
    body = f"WARC/1.0\r\nWARC-Record-ID: <urn:page:{page}>\r\n\r\n" + " ".join(words(rng, size)) + "\r\n\r\n"
    out = io.BytesIO()
    with gzip.GzipFile(f"page{page}.html" if page % 3 else "", "wb", compresslevel=page % 9 + 1, fileobj=out, mtime=page * 1000) as g:
        g.write(body.encode()[:200])
        if page % 2:
            g.flush()
        g.write(body.encode()[200:])
    return out.getvalue()


def test_members_of_other_writers_are_found():
    rng = random.Random(12)
    parts = [foreign(rng, p, rng.choice([0, 5, 300, 9000])) for p in range(50)]
    parts[20] = gzip.compress(MAGIC_INSIDE)  # what looks like a header within stored bytes is none
    starts = [sum(map(len, parts[:i])) for i in range(50)]
    whole = b"".join(parts)
    assert W.member_starts(whole) == starts
    for hurt in (7, 20, 49):
        for at in (4, len(parts[hurt]) // 2, len(parts[hurt]) - 6):  # name or time, data, check sum
            bad = bytearray(whole)
            bad[starts[hurt] + at] ^= 0x41
            assert W.member_starts(bytes(bad)) == starts
        gone = bytearray(whole)
        gone[starts[hurt]:starts[hurt] + 3] = b"abc"  # without its header a record belongs to the one before
        assert W.member_starts(bytes(gone)) == [s for s in starts if s != starts[hurt]]
    assert W.member_starts(b"") == [] and W.member_starts(b"no member") == [0] and W.member_starts(b"x" + parts[0]) == [0, 1]
    assert W.member_starts(whole[:-3]) == starts  # cut off


MAGIC_INSIDE = bytes(random.Random(2).randrange(256) for _ in range(500)) + W.MAGIC * 40 + b"\x00" * 30


def test_audit_of_another_writer_s_files(spark):
    rng = random.Random(13)
    parts = [foreign(rng, p, 40) for p in range(50)]
    paths = [scratch_path(spark, "test-foreign") for _ in "ab"]
    for path, hurt in zip(paths, (None, 33)):
        out = [p if i != hurt else p[:len(p) // 2] + bytes([p[len(p) // 2] ^ 1]) + p[len(p) // 2 + 1:] for i, p in enumerate(parts)]
        local = path.removeprefix("file:")
        os.makedirs(local)
        with open(f"{local}/part-00000.warc.gz", "wb") as f:
            f.write(b"".join(out))
    got = W.audit(*(W.hash_replica(spark, p) for p in paths)).collect()
    assert [(r.start, r.length, r.page_id, r.change) for r in got] == [
        (sum(map(len, parts[:33])), len(parts[33]), 33, "changed")]


def test_nothing_to_audit(spark):
    empty = [W.hash_replica(spark, written(spark, pages_of(spark, 0))) for _ in "ab"]
    assert W.audit(*empty).count() == 0
