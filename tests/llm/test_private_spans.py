import hashlib
import random
import re
import time

import pytest

from pitwall.llm import private_spans as P

from .helpers import ODD, SF, docs_of

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def good(kind, hit):
    digits = [int(c) for c in hit if c in "0123456789"]
    if kind == 1:
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == 2:
        twice = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def brute(text):
    """Base spans by the contract's patterns."""
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS)
                  for m in re.finditer(p.replace(r"\x20", " "), text or "") if good(k, m.group()))


@pytest.fixture(scope="module")
def transducers():
    return P.Transducers()


def shown(text, transducers):
    return [(P.KINDS[k], text[a:b], base) for a, k, b, base in P.find(text, transducers)]


def test_base_spans_equal_the_patterns(transducers):
    rng = random.Random(8)
    parts = ["a", "b1", "@", "@", ".", ".", "-", "+", "(", ")", " ", "1", "22", "255", "256", "00", "é", "4111111111111111",
             "+1 (017) 555-7713", "x@y.z", "1.2.3.4", "_", "%", "１", "５", "·", "​", "at", "dot", " one"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))
        assert sorted(s[:3] for s in P.find(text, transducers) if s[3]) == brute(text), text


@pytest.mark.parametrize("text, kind, part", [
    ("write to john dot smith at example dot com today", "email", "john dot smith at example dot com"),
    ("or john [at] example [dot] com", "email", "john [at] example [dot] com"),
    ("john(at)mail.example.org.", "email", "john(at)mail.example.org"),
    ("ask john.smith at example.com now", "email", "john.smith at example.com"),
    ("an odd john @ example . com there", "email", "john @ example . com"),
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("see jоhn@exаmple.cоm", "email", "jоhn@exаmple.cоm"),  # Cyrillic letters
    ("j​ohn@exam​ple.com", "email", "j​ohn@exam​ple.com"),
    ("john&#64;example&#46;com", "email", "john&#64;example&#46;com"),
    ("maria arroba correo punto es", "email", "maria arroba correo punto es"),
    ("user <AT> host <DOT> org", "email", "user <AT> host <DOT> org"),
    ("john@example dot com", "email", "john@example dot com"),
    ("plus one two one two five five five zero one two three four", "phone", "plus one two one two five five five zero one two three four"),
    ("call +1 (O17) 555-77l3", "phone", "+1 (O17) 555-77l3"),
    ("＋１ （０１７） ５５５－７７１３", "phone", "＋１ （０１７） ５５５－７７１３"),
    ("+one 212 555 0123 4", "phone", "+one 212 555 0123 4"),
    ("four" + " one" * 15, "card", "four" + " one" * 15),
    ("vier" + " eins" * 15, "card", "vier" + " eins" * 15),
    ("four triple one 1111 1111 one one one one", "card", "four triple one 1111 1111 one one one one"),
    ("٤١١١ ١١١١ ١١١١ ١١١١", "card", "٤١١١ ١١١١ ١١١١ ١١١١"),
    ("192 dot 168 dot 1 dot 10", "ip", "192 dot 168 dot 1 dot 10"),
    ("host 192[.]168[.]1[.]10 up", "ip", "192[.]168[.]1[.]10"),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
])
def test_disguises(transducers, text, kind, part):
    assert shown(text, transducers) == [(kind, part, False)]
    # the same in a longer text with characters before it that the transducers rewrite
    before = "Ａ — b­ ü one two. 日本. "
    assert (kind, part, False) in shown(before + text, transducers)


@pytest.mark.parametrize("text", [
    "we met at example.com", "thanks @bob.smith", "double four one", "one of two. Three at four dot five", "look at that dot",
    "one two three four five six seven eight nine ten", "at 10.30 on 1.2.2024 at 5", "the dot at the end . It is there .",
    "l0l and IO ports 1 2 3", "", "Ⅳ ½ ² ª", "dot dot at at", "256.1 dot 1 dot 1"])
def test_clean_text_is_left_alone(transducers, text):
    assert shown(text, transducers) == []


def test_base_spans_stay(transducers):
    text = "john(dot)doe@example.com and anna@example.com. Next and ４ 4111 1111 1111 1111"
    assert shown(text, transducers) == [
        ("email", "john(dot)doe@example.com", False), ("email", "doe@example.com", True),
        ("email", "anna@example.com", True), ("card", "4111 1111 1111 1111", True)]


@pytest.mark.parametrize("text", ["1 " * 200_000 + "x", "a" * 400_000, "+5" + "(" * 300_000, "a@" * 100_000,
                                  "one " * 100_000 + "x", " at" * 100_000, "l-" * 200_000, "0.0" * 100_000,
                                  "a.b" * 100_000 + " at b dot cc", "é" * 300_000 + " john at example dot com"])
def test_time_follows_the_length(transducers, text):
    began = time.time()
    P.find(text, transducers)
    assert time.time() - began < 20


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in P.op12_private_spans(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, text in docs:
        base = brute(text)
        joined = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in base)
        r = got[d]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.n_added or r.spans == joined


def test_odd_rows(spark):
    rows = [*ODD, (7, "x@y.zz 🙂 a at b dot cc"), (7, "x@y.zz 🙂 a at b dot cc"), (8, "word " * 200_000 + "x@y.zz")]
    got = [(r.doc_id, [tuple(s) for s in r.spans]) for r in P.scan(docs_of(spark, rows)).collect()]
    assert len(got) == len(rows)
    assert [s for d, s in got if d == 7] == [[(0, 0, 6, True), (9, 0, 22, False)]] * 2
    assert [s for d, s in got if d == 8] == [[(1_000_000, 0, 1_000_006, True)]]
    assert all(not s for d, s in got if d not in (7, 8))
    assert P.scan(docs_of(spark, [])).collect() == []
