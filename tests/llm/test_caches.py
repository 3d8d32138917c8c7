import weakref

import numpy as np
import pyarrow as pa

from pitwall.llm import common as C
from pitwall.llm import huffman_file as H
from pitwall.llm import ngram_join as J
from pitwall.llm import tokens as T
from pitwall.llm import toxic_kernel as X

from .helpers import docs_of


class Worker:
    """A table whose functions run at once, as a worker's next task."""

    def mapInArrow(self, run, schema):  # noqa: N802 - Spark's name
        return list(run(iter([schema])))


def test_another_operator_s_task_frees_a_worker_s_caches():
    encoder = T.encoder(T.tokenizer_json())
    assert T.encoder(T.tokenizer_json()) is encoder
    gone = weakref.ref(encoder)
    del encoder
    assert C.mapped(Worker(), lambda batches: batches, "rows") == ["rows"]
    assert gone() is None
    held = C.worker_cache("one")
    held["x"] = 1
    assert C.worker_cache("one") is held
    assert C.worker_cache("two") == {} == C.worker_cache("one")


def test_the_join_s_tasks_free_caches(spark, monkeypatch):
    seen = []

    def noted(df, run, schema):
        seen.append(run)
        return C.mapped(df, run, schema)

    monkeypatch.setattr(J, "mapped", noted)
    rows = [(i, f"a b c d e f g h i j k l m n o p q r {i % 3}") for i in range(9)]
    assert J.without_near_copies(docs_of(spark, rows)).count() == 1
    assert len(seen) >= 5


def test_a_worker_holds_no_tokenizer_while_it_codes_and_reads_blocks(spark, monkeypatch):
    seen = []

    def noted(df, run, schema):
        seen.append(run)
        return C.mapped(df, run, schema)

    monkeypatch.setattr(H, "mapped", noted)
    assert H.token_files(docs_of(spark, [(i, f"word {i}, word.") for i in range(5)])).count() == 5
    assert len(seen) == 3  # counts, blocks, rows read back


def test_known_pieces_take_few_bytes():
    encoder = T.Encoder(T.tokenizer_json())
    encoder.encode([" ".join(f"word{i}" for i in range(5000))])
    assert 5000 <= len(encoder.known) <= 5001 and encoder.known.nbytes < 5001 * 20


def test_tasks_of_a_worker_share_the_units_met(monkeypatch):
    marks = [b"\x02moron", b"\x02scum"]

    class Model:
        value = {"landmarks": marks, "w": np.ones(2), "bias": -1.0, "last": np.array([1.0, 0, 0, 0, 0, 0])}

    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array(["what a moron that is", "mo ron s c u m here", None])], names=["doc_id", "text"])
    C.drop_caches()
    first = [b.to_pydict() for b in X._scored(Model)(iter([batch]))]
    monkeypatch.setattr(X.Landmarks, "kernels", None)  # every unit is known by now
    assert [b.to_pydict() for b in X._scored(Model)(iter([batch]))] == first


def test_kernel_equals_a_sum_over_subsequences():
    from itertools import combinations

    def weight(s, places):
        out = 1.0
        for i in range(places[0], places[-1]):
            if i not in places:
                out *= X.LETTER_GAP if chr(s[i]).isalnum() else X.OTHER_GAP
        return out

    def kernel(s, t):
        letters = [[p for p in combinations(range(len(x)), 3) if all(chr(x[i]).isalnum() for i in p)] for x in (s, t)]
        return sum(weight(s, p) * weight(t, q) for p in letters[0] for q in letters[1]
                   if [s[i] for i in p] == [t[i] for i in q])

    units = [b"moron", b"m.o.r-o.n", b"mooorn", b"mo", b"", b"tan tan", b"banana"]
    pairs = [(a, b) for a in units for b in units]
    left, right = (X._padded([p[i] for p in pairs])[0] for i in (0, 1))
    assert np.allclose(X.subsequence_kernel(left, right), [kernel(a, b) for a, b in pairs])
