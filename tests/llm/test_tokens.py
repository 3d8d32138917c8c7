import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pitwall.llm import huffman_file as H
from pitwall.llm import separator_scan as S
from pitwall.llm import tokens as T

from .helpers import ODD, docs_of, words

LIBRARY = Tokenizer.from_str(T.tokenizer_json())
LIBRARY.encode_special_tokens = True
SHARED = T.Encoder(T.tokenizer_json())


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def sample():
    rng = random.Random(7)
    return [*ODD, *((i, " ".join(words(rng, rng.randint(1, 400))) + ".\nNext, line!") for i in range(200, 240)),
            (300, "  two  spaces \n\n\tand tabs <|endoftext|> !"), (301, "!" * 900), (302, "word " * 30_000)]


def test_pieces_give_the_library_s_ids(monkeypatch):
    monkeypatch.setattr(T, "CACHED_PIECES", 60)
    rng = random.Random(1)
    parts = ["a", "foo", "Bar", " ", "  ", "\n", "\n\n", "\t", "'s", "12", "é", "ñ.", "!", "<|endoftext|>", " ", " ", "\x1c",
             "日本", "\r\n", "...", "\x85", "x's", "²", "½", "\x00", "🙂", "ー", "é"]
    enc = T.Encoder(T.tokenizer_json())
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for k in range(0, len(texts), 100):
        for t, got in zip(texts[k:k + 100], enc.encode(texts[k:k + 100])):
            assert got.tolist() == ids_of(t), t


def test_words_of_letters_are_learnt_without_cores():
    enc = T.Encoder(T.tokenizer_json())
    for _ in range(2):
        for text in ("alpha beta été beta", "beta 日本 gamma alpha"):
            assert enc.encode([text, "", text])[2].tolist() == ids_of(text)
    # a text begins with a line feed; an empty one stands for "x"
    assert set(enc.cores) == {"\nalpha", "\nbeta", "x"}
    assert sorted(enc.codes.values()) == list(range(enc.pieces.count))


def test_points_at_the_end_of_a_word_are_pieces_of_their_own():
    enc = T.Encoder(T.tokenizer_json())
    texts = ["beta, beta; beta. beta", "beta!? été, été naïve... beta\n", "12, a_b_ × ×, x', x', (y) »; ñ÷, 日, 日", "... ,a, ''. 's. _", ""]
    for _ in range(2):
        assert [ids.tolist() for ids in enc.encode(texts)] == [ids_of(t) for t in texts]
    assert enc.encode([]) == []
    assert {" beta", " été", ",", ";", ".", "!?", "..."} <= set(enc.codes)
    assert not {c for c in enc.codes if c.startswith((" beta", " été")) and c not in (" beta", " été")}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é×ñ日½1,.;'_!»\n\t "), max_size=30), max_size=6))
def test_any_mix_of_points_and_letters_gives_the_library_s_ids(texts):
    assert [ids.tolist() for ids in SHARED.encode(texts)] == [ids_of(t) for t in texts]


def test_other_tokenizers_take_whole_texts():
    import public_tokenizers

    spec = T.tokenizer_json(public_tokenizers.path("word_bpe_49k.json"))
    enc = T.Encoder(spec)
    assert not enc.by_pieces
    other = Tokenizer.from_str(spec)
    other.encode_special_tokens = True
    assert enc.encode(["A b c"])[0].tolist() == other.encode("A b c", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=700), st.integers(0, 3))
def test_huffman_round_trip(ids, skew):
    ids = np.array(ids) % (10 ** (skew + 1))
    symbols, counts = np.unique(ids, return_counts=True)
    bits = H.code_lengths(counts, max(H.MAX_BITS, len(counts).bit_length() + 1))
    assert (2.0 ** -bits).sum() <= 1 and (len(bits) == 1 or (2.0 ** -bits).sum() == 1)
    sym, length, code = H.canonical(symbols, bits)
    word_of, bits_of = np.zeros(10_000, np.uint64), np.zeros(10_000, np.uint8)
    word_of[sym], bits_of[sym] = code, length
    payload, marks = H.pack(ids, word_of, bits_of)
    assert H.unpack(payload, marks, len(ids), *H.decode_tables(symbols, bits)).tolist() == ids.tolist()


def test_code_lengths_are_limited_and_best():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584, 4181])
    assert H.code_lengths(counts, 16).max() <= 16
    assert H.code_lengths(counts, 5).max() == 5
    # without the limit in the way: as plain Huffman coding
    import heapq

    heap = [(int(c), i, (i,)) for i, c in enumerate(counts)]
    depth = [0] * len(counts)
    while len(heap) > 1:
        (a, _, x), (b, k, y) = heapq.heappop(heap), heapq.heappop(heap)
        for i in x + y:
            depth[i] += 1
        heapq.heappush(heap, (a + b, k, x + y))
    assert (H.code_lengths(counts, 24) * counts).sum() == (np.array(depth) * counts).sum()


def test_files_hold_every_document(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_IDS", 2000)
    rows = sample()
    path = H.scratch_path(spark, "test-tokens")
    H.write_tokens(docs_of(spark, rows), path)
    got = H.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    want = []
    for d, t in rows:
        ids = np.array([*ids_of(t), 0], dtype="<u4")
        want.append((d is not None, d or 0, zlib.crc32(ids.tobytes()), len(ids), ids.tolist()))
    want.sort(key=lambda w: w[:4])
    assert [(r.doc_id is not None, r.doc_id or 0, r.ids_crc32, r.n_tokens, r.ids) for r in got] == want
    starts = np.cumsum([0] + [w[3] for w in want])
    assert [r.start for r in got] == starts[:-1].tolist()


def test_special_tokens_in_texts_as_by_the_library_s_default(spark):
    default = Tokenizer.from_str(T.tokenizer_json())
    rows = [*sample(), (400, "<|endoftext|>"), (401, "a<|endoftext|>\n<|endoftext|>. b  <|endoftext|>c"), (402, "plain words.")]
    enc = T.Encoder(T.tokenizer_json(), special=True)
    texts = [t or "" for _, t in rows]
    want = [default.encode(t, add_special_tokens=False).ids for t in texts]
    assert [i.tolist() for i in enc.encode(texts)] == want and 50256 in want[-2]
    got = H.token_files(docs_of(spark, rows)).where("doc_id >= 300 and doc_id < 9000").orderBy("doc_id").collect()
    ids = [np.array([*w, 0], dtype="<u4") for (d, _), w in zip(rows, want) if d is not None and 300 <= d < 9000]
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(i), zlib.crc32(i.tobytes())) for i in ids]


def test_no_documents_no_rows(spark):
    empty = docs_of(spark, [(1, "x")]).where("false")
    assert H.token_files(empty).count() == 0
    assert S.token_counts(empty).count() == 0


def test_separator_scan_counts_what_was_written(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_IDS", 257)
    rows = sample()
    got = S.token_counts(docs_of(spark, rows)).orderBy("doc").collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(ids_of(t)) + 1 for _, t in rows)
    assert [r.doc for r in got] == list(range(len(rows))) and all(r.ended for r in got)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()


def test_documents_run_on_over_blocks_and_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(S, "BLOCK_IDS", 4)
    end = S.END_ID
    stream = [5] * 9 + [end] + [end] + [6] * 30 + [end] + [7] * 3
    cuts = [0, 6, 6, 10, 25, 40, len(stream)]  # an empty file; a file that begins with a separator
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        (tmp_path / f"shard-{i:03}").write_bytes(np.array(stream[a:b], dtype=">u2").tobytes())
    got = S.scan_flat(spark, str(tmp_path)).orderBy("doc").collect()
    assert [(r.doc, r.start, r.n_tokens, r.ended) for r in got] == [
        (0, 0, 10, True), (1, 10, 1, True), (2, 11, 31, True), (3, 42, 3, False)]
    assert [r.file for r in got] == ["shard-002", "shard-003", "shard-005", "shard-005"]


def test_encoded_covers_all_rows():
    got = list(T.encoded(pa.array(["a b", None, "c" * 50, ""]), T.tokenizer_json(), chars=10))
    assert [r for r, _ in got] == [0, 1, 2, 3] and [len(i) for _, i in got][1::2] == [0, 0]
