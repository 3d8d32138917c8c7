"""Personal data, disguised or not, with spans in the source text.

Base spans are the plain matches of four kinds (email, ip, card, phone).  Then transducers
rewrite the text; each rewrite is a list of edits, and the places of what is left are carried along:

1. *Characters.* Lookalikes of ASCII become ASCII: compatibility forms (full width,
   mathematical, circled), digits of other scripts, dashes, spaces, Cyrillic and Greek
   letters; invisible characters go.
2. *Spelled digits.* Runs of digit words (English, German, French, Spanish), numerals and
   the words for plus, dot, dash, double and triple become digits and signs, when they hold at least two digit
   words or begin with a plus; O, o, I and l among digits become 0 and 1.
3. *At and dot.* ``(at)``, ``[dot]``, ``{at}``, HTML entities, spaced signs and the bare words become
   signs, where what stands around them is an address.

The same detectors read the rewritten text.  Their matches are mapped back to source characters: a span
runs from the source of its first character to that of its last.  A span is added if its source text
differs from what was matched and it lies within no base span of its kind; an address must end in letters.  Base spans stay as they are.

Spans count code points, the end is exclusive.  Every search takes time in proportion to the text: runs are
consumed as a whole, and addresses are read outwards from their sign.

Defined cases: a null text is empty and has no spans; repeated rows each get their row; a null ``doc_id``
stays null; very long texts are read whole; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import ship, table

KINDS = ("email", "ip", "card", "phone")

#: Letters and marks that look like ASCII ones but are no compatibility forms of them.
LOOKALIKES = (
    ("асԁеһіјӏорԛѕԝхуѵ", "acdehijlopqswxyv"),  # Cyrillic
    ("АВСЕНІЈКМОРЅТХҮԚԜ", "ABCEHIJKMOPSTXYQW"),
    ("αικνορτυχ", "aikvoptux"),  # Greek
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"),
    ("ıɡɑ", "iga"),
    ("−⁃∙。｡", "--..."),
)
#: Digit words.
DIGITS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
#: More words among digits.
SIGNS = {"oh": "0", "nought": "0", "zwo": "2", "plus": "+", "más": "+", "dash": "-", "hyphen": "-", "minus": "-",
         "dot": ".", "point": ".", "punkt": ".", "punto": "."}
TIMES = {"double": 2, "doppel": 2, "doble": 2, "triple": 3}
#: Words for the signs of an address.
_AT, _DOT = r"at|ät|arroba|chez", r"dot|punkt|punto|point"

_FINDING = "array<struct<start:bigint,kind:int,end:bigint,base:boolean>>"


# --- base detectors: leftmost, non-overlapping, failing matches dropped --------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_QUAD = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*+")
#: Addresses that only the transducers show must end like a host name.
_TOP = re.compile(r"\.[A-Za-z]{2,}\Z")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str):
    """Local parts are read leftwards from each sign, so a long run of letters is read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        host = _DOMAIN.match(text, at + 1) if first < at else None
        if host:
            yield first, host.end()
        done = host.end() if host else at + 1
        at = text.find("@", done)


def ips(text: str):
    for m in _QUAD.finditer(text):
        if m.group(1):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                yield m.span()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str):
    for m in _CHAIN.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdecimal() for c in m.group()) <= 15:
            yield m.span()


DETECTORS = (emails, ips, cards, phones)


# --- transducers: text to edits (start, end, replacement) ----------------------------------


def _characters() -> dict[str, str]:
    """Characters beyond ASCII that stand for an ASCII character of an identifier, by rule, and the fixed
    lookalikes; invisible ones stand for nothing."""
    wanted = {chr(c) for c in range(32, 127)}
    out = {}
    for code in range(128, sys.maxunicode + 1):
        c = chr(code)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Co", "Cs"):
            continue
        if kind == "Cf":
            out[c] = ""
        elif kind == "Nd":
            out[c] = str(unicodedata.decimal(c))
        elif kind == "Zs":
            out[c] = " "
        elif kind == "Pd":
            out[c] = "-"
        elif (plain := unicodedata.normalize("NFKC", c)) in wanted:
            out[c] = plain
    for odd, plain in LOOKALIKES:
        out |= zip(odd, plain)
    return out


def _any(words) -> str:
    return "|".join(sorted(map(re.escape, words), key=len, reverse=True))


class Transducers:
    """The three rewritings, compiled once a task."""

    def __init__(self):
        self.plain = _characters()
        self.beyond = re.compile(r"[^\x00-\x7F]")
        self.digit = {w: str(i) for words in DIGITS for i, w in enumerate(words.split())}
        word = _any([*self.digit, *SIGNS, *TIMES])
        token = rf"(?:(?:{word})(?![^\W_])|\+?[0-9]++)"
        # a run begins at a word: numerals before it join by themselves
        self.run = re.compile(rf"(?<![^\W_])(?:{word})(?![^\W_])(?:[\s,/()-]{{1,3}}{token})+", re.I)
        self.token = re.compile(rf"{token}|[^\W_0-9]++|[\s,/()-]+", re.I)
        # a run may be there only where a word of it is followed by another one or by a numeral
        self.kind = {w.encode(): 1 for w in (*self.digit, *SIGNS, *TIMES)} | {b"0" * n: 2 for n in range(1, 64)}
        self.words = bytes(48 if chr(b).isdigit() else b if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
        self.near = re.compile(r"[0-9][ ().-]{0,2}[OoIl]|[OoIl][ ().-]{0,2}[0-9]")
        self.mixed = re.compile(r"(?<![^\W_])[0-9OoIl](?:[ ().-]{0,2}[0-9OoIl])++")
        open_, close = r"[\[({<]\s*", r"\s*[\])}>]"
        entity_at, entity_dot = "&#64;|&#x40;|&commat;|%40", "&#46;|&#x2e;|&period;|%2e"
        self.at = re.compile(
            rf"(?P<sure>\s{{0,3}}{open_}(?:{_AT}|@){close}\s{{0,3}}|{entity_at}|\s{{1,3}}@\s{{1,3}})"
            rf"|\s{{1,3}}(?:{_AT})\s{{1,3}}|@", re.I)
        dot = (rf"(?:\s{{0,3}}{open_}(?:{_DOT}|\.){close}\s{{0,3}}|{entity_dot}|\s{{1,3}}(?:{_DOT})\s{{1,3}}|"
               r"\s{1,3}\.\s{1,3}|\.)")
        self.dot = re.compile(dot, re.I)
        self.host = re.compile(rf"[A-Za-z0-9-]++(?:{dot}[A-Za-z0-9-]++)+", re.I)
        # local parts are read from the sign leftwards: the same forms, mirrored
        mirrored = "|".join(w[::-1] for w in _DOT.split("|"))
        tod = rf"(?:\s{{0,3}}[\])}}>]\s*(?:{mirrored}|\.)\s*[\[({{<]\s{{0,3}}|\s{{1,3}}(?:{mirrored})\s{{1,3}})"
        self.lacol = re.compile(rf"[A-Za-z0-9._%+-]++(?:{tod}[A-Za-z0-9._%+-]++)*", re.I)
        self.quad = re.compile(rf"[0-9]++(?:{dot}[0-9]++{dot}[0-9]++{dot}[0-9]++)?+", re.I)
        self.signs = re.compile(r"@|&#|%40|[\[({<]\s*(?:" + _AT + "|" + _DOT + r"|\.)|\s(?:" + _AT + "|" + _DOT + r")\s", re.I)

    def characters(self, text: str):
        if text.isascii() or not self.plain.keys() & set(text):
            return []
        found = ((m.start(), self.plain.get(m.group())) for m in self.beyond.finditer(text))
        return [(a, a + 1, put) for a, put in found if put is not None]

    def spelled(self, text: str):
        edits = []
        kinds = bytes(map(self.kind.get, text.lower().encode("utf-8").translate(self.words).split(), repeat(0)))
        for m in self.run.finditer(text) if b"\1\1" in kinds or b"\1\2" in kinds else ():
            tokens = [(t.group().lower(), t.start(), t.end()) for t in self.token.finditer(text, m.start(), m.end())]
            signed = tokens[0][0] in ("plus", "más") or text[max(0, m.start() - 1):m.start()] == "+"
            if not signed and sum(t in self.digit or t == "oh" for t, _, _ in tokens) < 2:
                continue
            out, times, last = [], 1, ""
            for t, _, _ in tokens:
                digit = self.digit.get(t) or SIGNS.get(t)
                if digit:
                    out.append(digit * times if digit.isdigit() else digit)
                    times, last = 1, "word"
                elif t in TIMES:
                    times = TIMES[t]
                elif t[-1].isdigit():
                    out.append((" " if last == "word" and out[-1].isdigit() else "") + t)
                    times, last = 1, "number"
                elif last == "number" or t.strip():  # gaps between words go, others stay
                    out.append("-" if t.strip(" \t\n\r,") in ("", "-", "/") and t.strip() else " " if not t.strip() else t)
                    last = ""
            edits.append((m.start(), m.end(), "".join(out).strip()))
        taken = 0
        for m in self.mixed.finditer(text) if self.near.search(text) else ():
            run = m.group()
            if text[m.end():m.end() + 1].isalnum():  # its end is the beginning of a word
                run = run[:max(map(run.rfind, " ().-")) + 1]
            odd = [i for i, c in enumerate(run) if c in "OoIl"]
            while taken < len(edits) and edits[taken][1] <= m.start():
                taken += 1
            clash = taken < len(edits) and edits[taken][0] < m.end()
            if odd and not clash and 3 * len(odd) <= sum(c.isdecimal() for c in run):
                edits += [(m.start() + i, m.start() + i + 1, "0" if run[i] in "Oo" else "1") for i in odd]
                edits.sort()
        return edits

    def addresses(self, text: str):
        if not self.signs.search(text):
            return []
        edits, done = [], 0
        for m in self.at.finditer(text):
            host = self.host.match(text, m.end())
            if not host or m.start() < done:
                continue
            low = done
            local = None
            size = 64
            while local is None and m.start() > low:  # a longer look only where the part fills the window
                window = text[max(low, m.start() - size):m.start()]
                found = self.lacol.match(window[::-1])
                if not found:
                    break
                if found.end() == len(window) and m.start() - size > low:
                    size *= 4
                    continue
                local = window[::-1][:found.end()][::-1]
            if not local:
                continue
            first = m.start() - len(local)
            dots = [d for d in self.dot.finditer(text, host.start(), host.end()) if d.group() != "."]
            left = [d for d in self.dot.finditer(text, first, m.start()) if d.group() != "."]
            sure = m.group("sure") is not None
            if not sure and m.group() != "@":  # the bare word: an address only if its dots are hidden or its name is one
                if not (any(d.group().strip() != "." for d in dots) or re.search(r"[0-9._+%]", local)):
                    continue
            if m.group() == "@":
                # a plain sign: spaced dots after it end sentences, unless the name before it is spelled too
                dots = [d for d in dots if d.group().strip() != "."]
            spaced = [d for d in dots if d.group().strip() == "."]
            if spaced and not sure:
                dots = [d for d in dots if d not in spaced]
            if m.group() == "@" and not dots and not left:
                continue
            edits += [(d.start(), d.end(), ".") for d in left]
            if m.group() != "@":
                edits.append((m.start(), m.end(), "@"))
            edits += [(d.start(), d.end(), ".") for d in dots]
            done = dots[-1].end() if dots else m.end()
        taken = 0
        quads = []
        for m in self.quad.finditer(text):
            while taken < len(edits) and edits[taken][1] <= m.start():
                taken += 1
            if taken < len(edits) and edits[taken][0] < m.end():
                continue
            dots = [d for d in self.dot.finditer(text, m.start(), m.end()) if d.group() != "."]
            if any(d.group().strip() != "." for d in dots):
                quads += [(d.start(), d.end(), ".") for d in dots]
        return sorted(edits + quads)

    def stages(self):
        return self.characters, self.spelled, self.addresses


class Places:
    """Source start and end of every character of a rewritten text."""

    def __init__(self, size: int):
        self.start, self.end = np.arange(size), np.arange(1, size + 1)

    def rewrite(self, edits) -> None:
        starts, ends, at = [], [], 0
        for a, b, put in edits:
            if len(put) == b - a == 1:
                continue
            starts += [self.start[at:a], np.full(len(put), self.start[a])]
            ends += [self.end[at:a], np.full(len(put), self.end[b - 1])]
            at = b
        if at:
            self.start = np.concatenate([*starts, self.start[at:]])
            self.end = np.concatenate([*ends, self.end[at:]])


def _apply(text: str, edits) -> str:
    out, at = [], 0
    for a, b, put in edits:
        out += [text[at:a], put]
        at = b
    return "".join([*out, text[at:]])


def find(text: str, transducers: Transducers) -> list[tuple[int, int, int, bool]]:
    """``(start, kind, end, base)`` of all spans, in order."""
    base = [(a, k, b) for k, detect in enumerate(DETECTORS) for a, b in detect(text)]
    out, now, rewritings = [(*s, True) for s in base], text, []
    for stage in transducers.stages():
        edits = stage(now)
        if edits:
            rewritings.append(edits)
            now = _apply(now, edits)
    if rewritings:
        places, known = None, [[] for _ in KINDS]
        for a, k, b in base:
            known[k].append((a, b))
        for k, detect in enumerate(DETECTORS):
            mine = sorted(known[k])
            firsts = np.array([a for a, _ in mine], dtype=np.int64)
            for a, b in detect(now):
                if places is None:
                    places = Places(len(text))
                    for edits in rewritings:
                        places.rewrite(edits)
                source = int(places.start[a]), int(places.end[b - 1])
                if text[source[0]:source[1]] == now[a:b] or k == 0 and not _TOP.search(now, a, b):
                    continue
                i = int(np.searchsorted(firsts, source[0], side="right")) - 1
                if i < 0 or mine[i][1] < source[1]:
                    out.append((source[0], k, source[1], False))
    return sorted(out)


def scan(documents: DataFrame) -> DataFrame:
    """``doc_id, spans`` for every row; a span has start, kind (its place in ``KINDS``), end and whether it is a base one."""
    ship()

    def rows(batches):
        transducers = Transducers()
        for batch in batches:
            found, at = [], [0]
            for text in batch.column("text"):
                found += find(text.as_py() or "", transducers)
                at.append(len(found))
            start, kind, end, base = zip(*found) if found else ((), (), (), ())
            spans = pa.StructArray.from_arrays(
                [pa.array(start, pa.int64()), pa.array(kind, pa.int32()), pa.array(end, pa.int64()), pa.array(base, pa.bool_())],
                ["start", "kind", "end", "base"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans)], ["doc_id", "spans"])

    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(rows, f"doc_id bigint, spans {_FINDING}"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_*`` count base spans; ``n_added`` counts what the transducers brought to light."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))
