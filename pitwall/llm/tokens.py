"""Token ids of whole texts, with a word cache in front of the tokenizer.

A byte-level BPE that splits words as GPT-2 does always begins a new word at a space that
is followed by a character other than white space, and at a line feed between two such
characters.  So a text's ids are those of its pieces between these places, and each
different piece goes through the tokenizers library once per worker.  A slice of texts is cut
as one buffer and Arrow numbers its different pieces, so that only these are looked up in the
cache; points that end a word are pieces of their own.  Texts with other white space patterns (double spaces, tabs, blank lines) are cut by a regular expression
instead, at the same kind of places; a tokenizer of another kind gets whole texts.

A text may hold the literal of a special token (``<|endoftext|>``).  With ``special`` it gets
that token's id, as by the library's default, and such texts go to the library whole;
without, it is read as plain text.
"""

from __future__ import annotations

import json
import os
import re
import string
from bisect import bisect_right
from itertools import chain, repeat
from operator import attrgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from pitwall.llm.common import worker_cache

#: Beyond this number a worker forgets the pieces that it has met only once of late.
CACHED_PIECES = 300_000
#: Beyond this number it forgets the cores and tails, which only new pieces ask for.
CACHED_CORES = 50_000
#: Pieces whose ids are put together at once.
_GATHERED = 1 << 16
_CUT = re.compile(r" (?=\S)")
_SPACE = re.compile(r"\s")


def _byte_letters() -> dict[int, str]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones stand for
    themselves, the others follow from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_BYTES = _byte_letters()
_MARK = _BYTES[32]
_NONE, _NO_LENGTHS = np.zeros(0, np.uint32), np.zeros(0, np.int64)
_ID = attrgetter("id")
#: After a letter or digit a run of these is a word of its own ("'" may begin one of another kind).
_POINTS = string.punctuation.replace("'", "")
_POINT, _PLAIN = (np.isin(np.arange(256), list(x.encode())) for x in (_POINTS, string.ascii_letters + string.digits))


def tokenizer_json(path: str | None = None) -> str:
    """The text of a tokenizer file (read on the driver, a few MB), for a broadcast."""
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def vocabulary_size(spec: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec).get_vocab_size()


class _Codes(dict):
    """Numbers its keys as they are first asked for and notes the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key):
        code = self[key] = len(self)
        self.new.append(key)
        return code


class _Store:
    """Append-only arrays of ids, one run for each code."""

    def __init__(self):
        self.ids = np.zeros(1 << 16, np.uint32)
        self.size = 0
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.count = 0

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        while self.size + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.count + len(lengths) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        span = slice(self.count, self.count + len(lengths))
        self.start[span] = self.size + np.cumsum(lengths) - lengths
        self.length[span] = lengths
        self.ids[self.size:self.size + len(flat)] = flat
        self.size += len(flat)
        self.count += len(lengths)

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.start[codes] - (ends - lengths), lengths)
        return self.ids[at], lengths


def _keep(store: _Store, runs: list[np.ndarray]) -> None:
    store.extend(np.concatenate([_NONE, *runs]), np.array([len(x) for x in runs], np.int64))


class Encoder:
    """``encode(texts)`` gives the ids of each text as the tokenizers library does."""

    def __init__(self, spec: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True
        made = json.loads(spec)
        self.spec, self.special, self.default = spec, special, None
        self.literals = [t["content"] for t in made.get("added_tokens") or [] if t.get("special")]
        split = made.get("pre_tokenizer") or {}
        feed = self._plain(["\n"])[0]
        self.by_pieces = (split.get("type") == "ByteLevel" and split.get("use_regex", True)
                          and not split.get("add_prefix_space", True) and not made.get("normalizer")
                          and made["model"].get("type") == "BPE" and len(feed) == 1)
        if self.by_pieces:
            self.feed = int(feed[0])
        #: The known pieces by code, words with their space: an array takes a third of a dict.
        self.known = pa.array([], pa.large_binary())
        self.pieces, self.odd, self.met = _Store(), np.zeros(1 << 14, bool), np.zeros(1 << 14, np.int32)
        self._forget()
        self._forget_cores()

    @property
    def codes(self) -> dict[str, int]:
        return {piece: code for code, piece in enumerate(_strings(self.known))}

    def _forget(self) -> None:
        """Empty caches; pieces met more than once since the last time stay."""
        self.raw, self.raw_ids = _Codes(), _Store()
        keep = np.flatnonzero(self.met[:len(self.known)] > 1)
        self.known, odd, old, self.pieces = self.known.take(pa.array(keep)), self.odd[keep], self.pieces, _Store()
        self.pieces.extend(*old.gather(keep))
        self.odd, self.met = np.zeros(1 << 14, bool), np.zeros(1 << 14, np.int32)
        self._grow(len(keep))
        self.odd[:len(keep)] = odd

    def _forget_cores(self) -> None:
        self.cores, self.tails = _Codes(), _Codes()
        self.core_ids, self.tail_ids = _Store(), _Store()

    def _grow(self, n: int) -> None:
        while n > len(self.odd):
            self.odd = np.concatenate([self.odd, np.zeros_like(self.odd)])
            self.met = np.concatenate([self.met, np.zeros_like(self.met)])

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32)
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_cores(self) -> None:
        """Ids of new cores: ``foo`` stands for `` foo``, ``\\nFoo`` for itself.  A space and
        letters are one word to the library's model, and so are letters after a line feed, which
        is a word of its own; cores of other kinds without further white space go through the whole
        tokenizer in one text, a line feed apart."""
        new, self.cores.new = self.cores.new, []
        out: list = [None] * len(new)
        word, begun, spaced, lined, odd = [], [], [], [], []
        for i, c in enumerate(new):
            if c.isalpha():
                word.append(i)
            elif c[0] == "\n":
                (begun if c[1:].isalpha() else odd if _SPACE.search(c, 1) else lined).append(i)
            else:
                (odd if not c.isalnum() and _SPACE.search(c) else spaced).append(i)
        for group, mark in ((word, _MARK), (begun, "")):
            ids, lengths = self._words([new[i][not mark:] for i in group], mark)
            for i, x in zip(group, np.split(ids, np.cumsum(lengths)[:-1])):
                out[i] = x if mark else [self.feed, *x]
        for group, form in ((spaced, " {}\n"), (lined, "{}")):
            for k in range(0, len(group), 4096):
                part = group[k:k + 4096]
                ids = self._plain(["".join(form.format(new[i]) for i in part)])[0]
                cuts = np.flatnonzero(ids == self.feed)
                if len(cuts) != len(part):  # the line feed's id within a core
                    odd += part
                    continue
                first, last = (np.r_[0, cuts[:-1] + 1], cuts) if form[0] == " " else (cuts, np.r_[cuts[1:], len(ids)])
                for i, a, b in zip(part, first.tolist(), last.tolist()):
                    out[i] = ids[a:b]
        for i, ids in zip(odd, self._plain([c if c[0] == "\n" else " " + c for c in (new[i] for i in odd)])):
            out[i] = ids
        if out:
            self.core_ids.extend(np.fromiter(chain.from_iterable(out), np.uint32), np.array([len(x) for x in out], dtype=np.int64))

    def _words(self, words: list[str], mark: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of letters, each of which is one word to the library's model, and their
        numbers; ``mark`` stands before each."""
        model, flat, lengths = self.library.model.tokenize, [_NONE], [_NO_LENGTHS]
        for k in range(0, len(words), 8192):
            found = [model(mark + (u if u.isascii() else u.encode().decode("latin-1").translate(_BYTES)))
                     for u in words[k:k + 8192]]
            lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            flat.append(np.fromiter(map(_ID, chain.from_iterable(found)), np.uint32, int(lengths[-1].sum())))
        return np.concatenate(flat), np.concatenate(lengths)

    def _learn_others(self, new: list[str]) -> None:
        """Ids of new pieces that are not letters alone: a core and perhaps a tail.  ``odd`` marks
        pieces that show white space which the fast cut does not treat."""
        first = self.pieces.count
        core, tail = np.zeros(len(new), np.int64), np.full(len(new), -1, np.int64)
        for i, u in enumerate(new):
            head = u[1:2] if u[:1] == "\n" else u[:1]
            if not head or head.isspace():
                self.odd[first + i] = True
                core[i] = self.cores["x"]
                continue
            c = u.rstrip(_POINTS)
            if len(c) < len(u) and c[-1:].isalnum():
                core[i], tail[i] = self.cores[c], self.tails[u[len(c):]]
            else:
                core[i] = self.cores[u]
        self._learn_cores()
        _keep(self.tail_ids, self._plain(self.tails.new))
        self.tails.new = []
        lengths = np.zeros((len(new), 2), np.int64)
        lengths[:, 0], lengths[:, 1] = self.core_ids.length[core], np.where(tail < 0, 0, self.tail_ids.length[tail])
        of_core = np.repeat(np.tile([True, False], len(new)), lengths.ravel())
        flat = np.zeros(len(of_core), np.uint32)
        flat[of_core], flat[~of_core] = self.core_ids.gather(core)[0], self.tail_ids.gather(tail[tail >= 0])[0]
        self.pieces.extend(flat, lengths.sum(axis=1))

    def _codes_of(self, pieces: pa.Array) -> np.ndarray:
        """The codes of pieces that all differ; new ones are learnt: words of letters, tails, others."""
        codes = pc.fill_null(pc.index_in(pieces, value_set=self.known), -1).to_numpy().astype(np.int64)
        fresh = np.flatnonzero(codes < 0)
        if len(fresh):
            new = _strings(pieces.take(pa.array(fresh)))
            kind = np.fromiter((1 if u[0] != " " else 0 if u[1:].isalpha() else 2 for u in new), np.int8, len(new))
            order, (words, tails) = np.argsort(kind, kind="stable"), np.searchsorted(np.sort(kind), [1, 2])
            fresh, new = fresh[order], [new[i] for i in order.tolist()]
            codes[fresh] = np.arange(len(self.known), len(self.known) + len(new))
            self.known = pa.concat_arrays([self.known, pieces.take(pa.array(fresh))])
            self._grow(len(self.known))
            self.pieces.extend(*self._words([u[1:] for u in new[:words]], _MARK))
            _keep(self.pieces, self._plain(new[words:tails]))
            self._learn_others([u[1:] for u in new[tails:]])
        return codes

    def _raw(self, text: str) -> np.ndarray:
        cut = _CUT.split(text)
        codes = [self.raw[cut[0]], *[self.raw[" " + p] for p in cut[1:]]]
        new, self.raw.new = self.raw.new, []
        if new:
            _keep(self.raw_ids, self._plain(new))
        return self.raw_ids.gather(np.array(codes))[0]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.special:
            return self._encode(texts)
        whole = [i for i, t in enumerate(texts) if not self.by_pieces or any(x in t for x in self.literals)]
        if not whole:
            return self._encode(texts)
        if self.default is None:
            self.default = type(self.library).from_str(self.spec)
        held = set(whole)
        rest = iter(self._encode([t for i, t in enumerate(texts) if i not in held]))
        found = iter(self.default.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False))
        return [np.array(next(found).ids, dtype=np.uint32) if i in held else next(rest) for i in range(len(texts))]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_pieces:
            return self._plain(texts)
        if len(self.known) + len(self.raw) > CACHED_PIECES:
            self._forget()
        if len(self.cores) + len(self.tails) > CACHED_CORES:
            self._forget_cores()
        begun = [(" \n" + t.replace("\n", " \n")).encode() for t in texts]
        text = b"".join(begun)
        starts = _cuts(np.frombuffer(text, np.uint8))
        bounds = np.searchsorted(starts, np.r_[0, np.cumsum([len(b) for b in begun])]).tolist()
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(np.r_[starts, len(text)]), pa.py_buffer(text)]).dictionary_encode()
        place = pieces.indices.to_numpy()
        codes = self._codes_of(pieces.dictionary)
        self.met[codes] += np.bincount(place, minlength=len(codes)).astype(np.int32)
        odd = self.odd[codes]
        out: list[np.ndarray] = []
        while len(out) < len(texts):  # all texts up to a number of pieces, one at least
            first = len(out)
            last = max(first + 1, bisect_right(bounds, bounds[first] + _GATHERED) - 1)
            here, span = place[bounds[first]:bounds[last]], np.array(bounds[first:last + 1]) - bounds[first]
            flat, lengths = self.pieces.gather(codes[here])
            at = np.r_[0, np.cumsum(lengths)][span].tolist()
            strange = (np.diff(np.r_[0, np.cumsum(odd[here])][span]) > 0).tolist()
            for i, t in enumerate(texts[first:last]):
                out.append(_NONE if not t else self._raw(t) if strange[i] else flat[at[i] + 1:at[i + 1]])
        return out


def _cuts(text: np.ndarray) -> np.ndarray:
    """Where pieces start in UTF-8 bytes that begin with a space: at each space, and where points
    that a space or the end follows come after a letter or digit, as far as one byte or a Latin
    letter of two tells it."""
    point = _POINT[text]
    turns = np.flatnonzero(point[1:] != point[:-1]) + 1  # a run of points starts, ends, starts ...
    first, after = turns[::2], turns[1::2]
    if len(after) < len(first):
        after = np.r_[after, len(text)]
    at_end = (after == len(text)) | (text[np.minimum(after, len(text) - 1)] == 32)
    first = first[at_end]
    last = text[first - 1]
    latin = (last > 127) & (last < 192) & (text[first - 2] == 0xC3) & (last != 0x97) & (last != 0xB7)
    tail = np.zeros(len(text), bool)
    tail[first[_PLAIN[last] | latin]] = True
    return np.flatnonzero(tail | (text == 32))


def _strings(pieces: pa.Array) -> list[str]:
    return pieces.cast(pa.large_string()).to_numpy(zero_copy_only=False).tolist()


def encoder(spec: str, special: bool = False) -> Encoder:
    """This worker's encoder for a tokenizer."""
    held = worker_cache("encoders")
    if (spec, special) not in held:
        held[spec, special] = Encoder(spec, special)
    return held[spec, special]


def encoded(column, spec: str, chars: int = 2_000_000, special: bool = False):
    """``(row, ids)`` of an Arrow text column, in runs of about two million characters."""
    enc = encoder(spec, special)
    texts, first, size = [], 0, 0
    for row, t in enumerate(column):
        texts.append(t.as_py() or "")
        size += len(texts[-1])
        if size >= chars:
            yield from enumerate(enc.encode(texts), first)
            texts, first, size = [], row + 1, 0
    if texts:
        yield from enumerate(enc.encode(texts), first)
