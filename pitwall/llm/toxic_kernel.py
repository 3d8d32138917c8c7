"""Toxicity: a support vector machine over a gapped subsequence string kernel.

The kernel of two strings sums, over all pairs of equal subsequences of three letters, a
weight for each: 0.5 for every letter that the subsequence jumps over, 0.95 for any other
character, so that ``m.o.r.o.n`` and ``moxron`` stay close to ``moron``; it is normalised to 1 for
equal strings.  A sentence's kernel with a string is the greatest one of its units: its words,
runs of four or more single characters apart (``m o r o n``), and neighbouring words of a sentence
that have together at most two bytes more than the longest landmark (``mo ron``), lower-cased and
each with a mark at its beginning that counts as a letter.

Landmarks are strings of 4 to 8 characters that begin or lie in far more words of toxic than of
other training documents (a likelihood ratio test), each for words that those chosen
before it don't explain.  Nystrom features of a sentence are its kernels with the landmarks
times the inverse root of the landmarks' own kernel matrix.  A linear support vector machine
(squared hinge) is trained on sentences: those of documents not labelled toxic are negative,
and of each toxic document the sentence that scores highest is positive, chosen anew in each
of three rounds.  A document's score is that of its highest sentence, mapped to 0..1 by
logistic regression on the training documents.

A unit whose longest common subsequence with a landmark is below three quarters of the
landmark has kernel 0 with it, and so have kernels below 0.25: this is part of the
definition and lets almost all words pass at the price of a few bit operations.  Units over
64 bytes are read as overlapping windows of 64.  As a unit's own kernel grows with its length,
units and windows are also read through windows of twice as many letters as the landmark has,
half a landmark apart, and the greatest kernel counts: what stands around an insult does not hide it.

Landmarks and machine are fitted on at most ``SAMPLE`` documents of each label, chosen by a
hash of their ids; the 20 likeliest sentences of each are used.  Every text is scored whole.

Defined cases: null and empty texts have no sentence and get the score of a sentence without
any kernel; labels of null or of absent documents are not used; if a label is absent or no
string qualifies as landmark, every document scores 0; null ids are scored and never trained
on; repeated rows score alike; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import save, ship, small, table, worker_cache
from pitwall.llm.quality_rank import crc_fold, sample_of
from pitwall.llm.shingles import mix64, text_slices, word_hashes

SAMPLE = 1500
LANDMARKS = 48
SENTENCES = 20
#: Least likelihood ratio statistic of a landmark, and how many strings and words are weighed.
EVIDENCE = 30.0
CANDIDATES, WORDS = 20_000, 200_000
#: How much a string that also stands in other documents' words is worth less.
PURITY = 8
MARK = "\x02"
FLOOR = 0.25
LETTER_GAP, OTHER_GAP = 0.5, 0.95
WINDOW = 64
LENGTHS = range(4, 9)
_CACHE = 1_000_000
#: Distinct rows of kernels beyond which a reader forgets what it has met.
_CACHED_ROWS = 200_000
#: Places of a landmark, or rows, that are worked on at a time, so that they stay in the processor's cache.
_CELLS = 16_000
_ROWS = 2000
_JOIN = np.uint64(0x9FB21C651E98DF25)


def _letters() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(MARK), *range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return out


class _Units:
    """Byte strings one after another in ``flat``, with their lengths."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        self.flat, self.lengths = flat, lengths
        self.starts = np.cumsum(lengths) - lengths

    @classmethod
    def of(cls, units: list[bytes]) -> _Units:
        return cls(np.frombuffer(b"".join(units), np.uint8), np.array([len(u) for u in units], np.int64))

    def __len__(self) -> int:
        return len(self.lengths)

    def spans(self, row: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> _Units:
        """Of each of the rows so many bytes from a place in it."""
        return _Units(self.flat[_places(self.starts[row] + first, lengths)], lengths)

    def padded(self) -> np.ndarray:
        """Bytes of each unit in a row, zero beyond its end, lower-cased."""
        out = np.zeros((len(self), int(self.lengths.max(initial=1))), np.uint8)
        out[np.arange(out.shape[1]) < self.lengths[:, None]] = self.flat
        out[(out >= 65) & (out <= 90)] += 32
        return out


def _padded(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    found = _Units.of(units)
    return found.padded(), found.lengths


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs of so many elements from each start."""
    return np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def _marked(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, n: int = 1) -> _Units:
    """A unit for each ``first``: the mark, and ``n`` words from there with a space between them."""
    size = (ends - starts)[first[:, None] + np.arange(n)]
    lengths = size.sum(axis=1) + n
    flat = np.full(int(lengths.sum()), 32, np.uint8)
    at = np.cumsum(lengths) - lengths
    flat[at] = ord(MARK)
    for k in range(n):
        flat[_places(at + 1, size[:, k])] = data[_places(starts[first + k], size[:, k])]
        at = at + 1 + size[:, k]
    return _Units(flat, lengths)


def subsequence_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The kernel, not normalised, of each row of ``s`` with the same row of ``t`` (zero-padded bytes).
    Both steps of the recursion go on row by row, so that only one row of each is held."""
    letter = _letters()
    gap = np.where(letter, LETTER_GAP, OTHER_GAP)
    n, columns = len(s), t.shape[1]
    t = t.T.copy()
    gt = gap[t]
    total = np.zeros(n)
    above = [np.zeros((columns + 1, n)) for _ in range(2)]
    row, spare, part = np.zeros((columns + 1, n)), np.empty((columns, n)), np.empty(n)
    for i in range(s.shape[1]):
        c = s[:, i]
        gs = gap[c]
        ended = ((c == t) & letter[c]).astype(np.float64)
        match, both = ended, gs * gt
        for step in range(2):
            line = match * above[step][:-1]
            if step:
                total += line.sum(axis=0)
            np.multiply(above[step][1:], gs, out=row[1:])
            row[1:] += ended
            np.multiply(both, above[step][:-1], out=spare)
            for j in range(columns):
                np.multiply(gt[j], row[j], out=part)
                row[j + 1] += part
                row[j + 1] -= spare[j]
            above[step], row = row, above[step]
            ended = line
    return total


def own_kernel(s: np.ndarray) -> np.ndarray:
    return subsequence_kernel(s, s)


def least_own_kernel(s: np.ndarray) -> np.ndarray:
    """What the pairs of each subsequence with itself, place by place, add to the own kernel: a
    lower bound of it, as all pairs add something."""
    letter = _letters()
    squared = np.where(letter, LETTER_GAP, OTHER_GAP) ** 2
    ended, total = np.zeros((2, len(s))), np.zeros(len(s))
    for i in range(s.shape[1]):
        on, gap = letter[s[:, i]], squared[s[:, i]]
        total += np.where(on, ended[1], 0.0)
        ended[1] = ended[1] * gap + np.where(on, ended[0], 0.0)
        ended[0] = ended[0] * gap + on
    return total


def _letter_windows(s: np.ndarray, width: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, bytes)`` of windows of so many letters of the rows of ``s`` that have more; the
    last one of a row ends with its last letter."""
    owner, at = np.nonzero(_letters()[s])
    n = np.bincount(owner, minlength=len(s))
    count = np.where(n > width, -(-(n - width) // step) + 1, 0)
    row = np.repeat(np.arange(len(s)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = (np.cumsum(n) - n)[row] + np.minimum(k * step, n[row] - width)
    if not len(row):
        return row, np.zeros((0, 1), np.uint8)
    start, end = at[first], at[first + width - 1] + 1
    place = start[:, None] + np.arange((end - start).max())
    return row, np.where(place < end[:, None], s[row[:, None], np.minimum(place, s.shape[1] - 1)], 0).astype(np.uint8)


class Landmarks:
    """Kernels of units with the landmarks, hot units only."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.bytes, self.lengths = _padded(strings)
        self.own = own_kernel(self.bytes)
        self.need = -(-3 * self.lengths // 4)
        self.masks = np.zeros((256, len(strings)), np.uint16)
        for j, z in enumerate(strings):
            for i, c in enumerate(z):
                self.masks[c, j] |= 1 << i
        letter = _letters()
        self.masks[~letter] = 0
        #: Most bytes of neighbouring words that are read as one unit, without the mark.
        self.joined = int(self.lengths.max(initial=0)) + 2

    def gram(self) -> np.ndarray:
        m = len(self.strings)
        i, j = np.divmod(np.arange(m * m), m)
        k = subsequence_kernel(self.bytes[i], self.bytes[j]).reshape(m, m)
        return k / np.sqrt(np.outer(self.own, self.own))

    def _short(self, units: _Units) -> np.ndarray:
        """Kernels of units of up to 64 bytes: a row for each."""
        out = np.zeros((len(units), len(self.strings)), np.float32)
        s, lengths = units.padded(), units.lengths
        for a in range(0, len(units), 20_000):
            part = s[a:a + 20_000, :int(lengths[a:a + 20_000].max(initial=1))]
            row, z = np.nonzero(self.common(part) >= self.need[None, :])
            if not len(row):
                continue
            out[a + row, z] = self._pairs(part, row, z)
            for n in np.unique(self.lengths[z]).tolist():
                of = self.lengths[z] == n
                held, at = np.unique(row[of], return_inverse=True)
                owner, pieces = _letter_windows(part[held], 2 * n, n // 2)
                if not len(owner):
                    continue
                asked = np.zeros((len(held), len(self.strings)), bool)
                asked[at, z[of]] = True
                for b in range(0, len(owner), 20_000):
                    unit, piece = owner[b:b + 20_000], pieces[b:b + 20_000]
                    i, j = np.nonzero(asked[unit] & (self.common(piece) >= self.need[None, :]))
                    np.maximum.at(out, (a + held[unit[i]], j), self._pairs(piece, i, j))
        return out

    def common(self, s: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of each row of bytes with each landmark."""
        full = ((1 << self.lengths) - 1).astype(np.uint16)[None, :]
        out = np.empty((len(s), len(self.strings)), np.int64)
        for a in range(0, len(s), _ROWS):
            part = s[a:a + _ROWS]
            left = np.repeat(full, len(part), axis=0)
            u, more = np.empty_like(left), np.empty_like(left)
            for i in range(s.shape[1]):
                np.take(self.masks, part[:, i], axis=0, out=u, mode="clip")
                u &= left
                np.add(left, u, out=more)
                left ^= u
                left |= more  # bits above a landmark's length meet no mask
            left &= full
            np.subtract(self.lengths, np.bitwise_count(left), out=out[a:a + _ROWS])
        return out

    def _pairs(self, s: np.ndarray, row: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Kernels of rows of ``s`` with landmarks, pair by pair, in parts of bounded memory.  A row's
        own kernel, which takes most of the work, is made only where its lower bound leaves a
        kernel of ``FLOOR`` possible."""
        k = np.zeros(len(row))
        step = max(1, _CELLS // self.bytes.shape[1])
        for a in range(0, len(row), step):
            k[a:a + step] = subsequence_kernel(s[row[a:a + step]], self.bytes[z[a:a + step]])
        some = np.unique(row)
        least = np.zeros(len(s))
        least[some] = least_own_kernel(s[some])
        able = k >= FLOOR * np.sqrt(np.maximum(least[row], 1e-12) * self.own[z]) * (1 - 1e-9)
        out, k = np.zeros(len(row)), k[able]
        hot, at = np.unique(row[able], return_inverse=True)
        own = np.zeros(len(hot))
        step = max(1, _CELLS // s.shape[1])
        for a in range(0, len(hot), step):
            own[a:a + step] = own_kernel(s[hot[a:a + step]])
        k /= np.sqrt(np.maximum(own[at], 1e-12) * self.own[z[able]])
        k[k < FLOOR] = 0
        out[able] = k
        return out

    def kernels(self, units: list[bytes] | _Units) -> np.ndarray:
        """A row of kernels for each unit, in groups of similar length."""
        units = units if isinstance(units, _Units) else _Units.of(units)
        half = WINDOW // 2
        windows = np.where(units.lengths > WINDOW, -(-(units.lengths - half) // half), 1)
        owner = np.repeat(np.arange(len(units)), windows)
        first = (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)) * half
        lengths = np.where(windows[owner] > 1, np.minimum(units.lengths[owner] - first, WINDOW), units.lengths[owner])
        out = np.zeros((len(units), len(self.strings)), np.float32)
        order = np.argsort(lengths, kind="stable")
        for a in range(0, len(order), 20_000):
            part = order[a:a + 20_000]
            found = self._short(units.spans(owner[part], first[part], lengths[part]))
            hot = np.flatnonzero(found.any(axis=1))
            np.maximum.at(out, owner[part[hot]], found[hot])
        return out


class Reader:
    """Finds the sentences with a kernel in batches of texts; knows the units it has met."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self._forget()

    def _forget(self) -> None:
        self.seen, self.code = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.rows = np.zeros((0, len(self.landmarks.strings)), np.float32)

    def _codes(self, hashes: np.ndarray, units) -> np.ndarray:
        """A unit's row in ``rows``, -1 without a kernel; ``units(places)`` gives the bytes of some."""
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.seen, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.seen)
        new[inside] = self.seen[at[inside]] != distinct[inside]
        if new.any():
            k = self.landmarks.kernels(units(first[new]))
            hot = k.any(axis=1)
            code = np.full(len(k), -1, np.int64)
            code[hot] = len(self.rows) + np.arange(hot.sum())
            self.rows = np.concatenate([self.rows, k[hot]])
            seen, codes = np.concatenate([self.seen, distinct[new]]), np.concatenate([self.code, code])
            order = np.argsort(seen, kind="stable")
            self.seen, self.code = seen[order], codes[order]
        return self.code[np.searchsorted(self.seen, distinct)][inverse]

    def _joins(self, words, starts, ends, row, sentence, data):
        """``(first word, code)`` of neighbouring words that may be pieces of one; the sum of
        their words' common subsequences with a landmark bounds that of the join."""
        most = self.landmarks.joined
        marked = self.landmarks.bytes[:, 0] == ord(MARK)
        before = np.r_[0, np.cumsum(ends - starts)]

        def joins(n):
            i = np.arange(max(0, len(words) - n + 1))
            j = i + n - 1
            return i[(before[j + 1] - before[i] <= most) & (row[i] == row[j]) & (sentence[i] == sentence[j])]

        pairs = joins(2)  # every longer join begins with one
        if not len(pairs):
            return
        used = np.unique(np.r_[pairs, pairs + 1])
        _, first, inverse = np.unique(words[used], return_index=True, return_inverse=True)
        first = used[first]
        # of a word within a join the mark does not count
        common = np.concatenate([self.landmarks.common(_marked(data, starts, ends, first[a:a + 20_000]).padded())
                                 for a in range(0, len(first), 20_000)]) - marked
        common = common.astype(np.int8)
        place = np.zeros(len(words), np.int64)
        place[used] = inverse
        need = (self.landmarks.need - marked).astype(np.int8)
        for n in range(2, most + 1):
            heads = joins(n)
            if not len(heads):
                return
            near = np.concatenate([(sum(common[place[part + k]] for k in range(n)) >= need).any(axis=1)
                                   for part in (heads[a:a + 100_000] for a in range(0, len(heads), 100_000))])
            heads = heads[near]
            if not len(heads):
                continue
            keys = np.zeros(len(heads), np.uint64)
            for k in range(n):
                keys = mix64(keys * _JOIN + words[heads + k])
            codes = self._codes(keys, lambda i: _marked(data, starts, ends, heads[i], n))  # noqa: B023 - used at once
            yield heads[codes >= 0], codes[codes >= 0]

    def sentences(self, column):
        """``(row, sentence, kernels)`` of each sentence that has any."""
        mark = MARK.encode()
        for first_row, off, data in text_slices(column):
            words, at = word_hashes(off, data)
            if not len(words):
                continue
            if len(self.seen) > _CACHE or len(self.rows) > _CACHED_ROWS:  # only here: all codes of a slice are rows of the same array
                self._forget()
            gap = np.zeros(256, bool)
            gap[[0x20, *range(0x09, 0x0E)]] = True
            inside = np.r_[False, ~gap[data], False]
            edge = np.zeros(len(data) + 1, bool)
            edge[off] = True
            starts = np.flatnonzero(inside[1:-1] & (edge[:-1] | ~inside[:-2]))
            ends = np.flatnonzero(inside[1:-1] & (edge[1:] | ~inside[2:])) + 1
            row = np.repeat(np.arange(len(off) - 1), np.diff(at))
            stop = np.isin(data[ends - 1], list(b".!?")) | (data[np.minimum(ends, len(data) - 1)] == 10)
            sentence = np.cumsum(np.r_[False, stop[:-1]])
            codes = self._codes(words, lambda i: _marked(data, starts, ends, i))
            hot = np.flatnonzero(codes >= 0)
            found = [(row[hot], sentence[hot], codes[hot])]
            # single characters apart
            lone = (ends - starts == 1) | ((ends - starts == 2) & (data[starts] >= 128))
            if lone.any():
                lone &= np.r_[False, (row[1:] == row[:-1]) & lone[:-1]] | np.r_[(row[1:] == row[:-1]) & lone[1:], False]
                spots = np.flatnonzero(lone)
                runs = np.split(spots, np.flatnonzero((np.diff(spots) > 1) | (np.diff(row[spots]) > 0)) + 1) if len(spots) else []
                runs = [r for r in runs if len(r) >= 4]
                if runs:
                    units = [mark + data[starts[r[0]]:ends[r[-1]]].tobytes() for r in runs]
                    size = np.r_[0, np.cumsum([len(u) for u in units])]
                    joined = np.frombuffer(b"".join(units).translate(bytes.maketrans(b" \t\n\r\x0b\x0c", b"......")), np.uint8)
                    keys, _ = word_hashes(size, joined)
                    codes = self._codes(keys, lambda i: [units[j] for j in i.tolist()])
                    kept = codes >= 0
                    heads = np.array([r[0] for r in runs])[kept]
                    found.append((row[heads], sentence[heads], codes[kept]))
            for heads, codes in self._joins(words, starts, ends, row, sentence, data):
                found.append((row[heads], sentence[heads], codes))
            r, s, c = (np.concatenate(x) for x in zip(*found))
            if not len(r):
                continue
            order = np.lexsort((s, r))
            r, s, c = r[order], s[order], c[order]
            cut = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (s[1:] != s[:-1])])
            best = np.maximum.reduceat(self.rows[c], cut, axis=0)
            for i, k in zip(cut.tolist(), best):
                yield first_row + int(r[i]), int(s[i]), k


def reader_of(landmarks: list[bytes]) -> Reader:
    """This worker's reader for the landmarks: its tasks share the units that they have met."""
    held = worker_cache("readers")
    if tuple(landmarks) not in held:
        held.clear()
        held[tuple(landmarks)] = Reader(Landmarks(landmarks))
    return held[tuple(landmarks)]


def _units_of(batches):
    """Each document's distinct words, marked, with its label."""
    for batch in batches:
        label, unit = [], []
        for y, t in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
            words = {MARK + w for w in (t or "").split() if 3 <= len(w) <= WINDOW}
            label += [y] * len(words)
            unit += words
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(unit, pa.string())], names=["label", "unit"])


def _cut(n: int):
    return lambda i: F.substring("unit", i, F.lit(n))


def evidence(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """Likelihood ratio statistic of strings held by so many words of toxic and of other
    documents, of so many words in all; 0 where they are not 8 times as frequent in toxic ones."""
    share = n_toxic / (n_toxic + n_other)
    seen = np.maximum(toxic + other, 1)
    odds = (toxic + 0.5) / (n_toxic + 1) / ((other + 0.5) / (n_other + 1))
    g = 2 * (toxic * np.log(np.maximum(toxic, 1e-9) / (seen * share))
             + other * np.log(np.maximum(other, 1e-9) / (seen * (1 - share))))
    return np.where(odds > 8, g, 0.0)


def choose_landmarks(rows: DataFrame, n_toxic: int) -> list[bytes]:
    """Landmarks from ``rows(label, text)`` with ``n_toxic`` toxic documents.  A bounded number
    of strings, and of the sample's words, reach the driver."""
    units = save(rows.mapInArrow(_units_of, "label int, unit string").groupBy("unit")
                 .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other")), "units")
    words = units.agg(F.sum("toxic"), F.sum("other")).first()
    cuts = F.flatten(F.array(*(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("unit") - (n - 1), F.lit(1))), _cut(n)) for n in LENGTHS)))
    letters = F.col("part").rlike(r"^\x02?[\p{L}\p{N}]+$") & (F.length("part") >= LENGTHS[0])
    t, o = F.col("toxic"), F.col("other")
    parts = (units.select("toxic", "other", F.explode(F.array_distinct(cuts)).alias("part"))
             .groupBy("part").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
             .where((t >= max(4, n_toxic // 100)) & (t * words[1] > 8 * o * words[0])).where(letters)
             .orderBy(F.desc(t - o * (words[0] / max(words[1], 1))), F.desc(F.length("part")), "part").limit(CANDIDATES).toArrow())
    names = parts.column("part").to_pylist()
    if not names:
        return []
    toxic, other = (parts.column(c).to_numpy().astype(float) for c in ("toxic", "other"))
    g = evidence(toxic, other, *words)
    index = {p: i for i, p in enumerate(names) if g[i] >= EVIDENCE and len(p.encode()) <= 15}
    held: list[list[int]] = []
    weight: list[int] = []
    for unit, n in units.where(t > 0).orderBy(F.desc("toxic"), "unit").limit(WORDS).select("unit", "toxic").collect():
        own = {i for n_ in LENGTHS for a in range(len(unit) - n_ + 1) if (i := index.get(unit[a:a + n_])) is not None}
        if own:
            held.append(sorted(own))
            weight.append(n)
    precision = toxic / (toxic + other * words[0] / max(words[1], 1))
    chosen: list[int] = []
    left = set(range(len(held)))
    while len(chosen) < LANDMARKS:
        total = np.zeros(len(names))
        for u in left:
            total[held[u]] += weight[u]
        # what is left must be evidence by itself
        total[total * g / np.maximum(toxic, 1) < EVIDENCE] = 0
        total *= precision ** PURITY
        if not total.max():
            break
        # of strings that do almost as much the longest
        best = max(np.flatnonzero(total >= 0.95 * total.max()).tolist(), key=lambda i: (len(names[i]), total[i], names[i]))
        chosen.append(best)
        left = {u for u in left if best not in held[u]}
    return [names[i].encode() for i in chosen]


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 25) -> np.ndarray:
    """Weights and intercept of a linear machine with squared hinge loss, by Newton's method;
    both labels (1 and -1) weigh the same."""
    x = np.c_[x, np.ones(len(x))]
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y) * cost
    w = np.zeros(x.shape[1])
    keep = np.eye(len(w))
    keep[-1, -1] = 1e-3
    for _ in range(rounds):
        slack = 1 - y * (x @ w)
        on = slack > 0
        gradient = keep @ w - x[on].T @ (weight[on] * y[on] * slack[on])
        step = np.linalg.solve(keep + (x[on] * weight[on, None]).T @ x[on], gradient)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Weights and intercept of the chance of label 1, the labels weighing the same."""
    x = np.c_[x, np.ones(len(x))]
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (p - y)) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def summary(values: list[float], bias: float, words: int) -> list[float]:
    """What the last step sees of a document: its sentences' values and its words."""
    top = sorted([*values, bias, bias, bias], reverse=True)[:3]
    return [*(max(-3.0, min(3.0, v)) for v in top), np.log1p(sum(v > 0 for v in values)), np.log1p(words)]


def train(landmarks: list[bytes], docs: list[tuple[int, int, np.ndarray]]) -> dict:
    """The machine from ``(label, words, kernels of its sentences)`` of each training document; a
    document always has one sentence without any kernel."""
    values, vectors = np.linalg.eigh(Landmarks(landmarks).gram())
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = [np.concatenate([np.zeros((1, len(landmarks))), k]) @ root for *_, k in docs]
    y = np.array([label for label, *_ in docs])
    at = np.r_[0, np.cumsum([len(k) for k in x])]
    flat = np.concatenate(x)
    value = np.concatenate([np.r_[-1.0, k.max(axis=1)] for *_, k in docs])
    owner = np.repeat(y, np.diff(at))
    for _ in range(3):
        top = np.array([a + int(np.argmax(value[a:b])) for a, b in zip(at[:-1], at[1:])])
        rows = np.concatenate([top[y == 1], np.flatnonzero(owner == 0)])
        w = fit_svm(flat[rows], np.where(owner[rows] == 1, 1.0, -1.0))
        value = flat @ w[:-1] + w[-1]
    last = np.array([summary(value[a + 1:b].tolist(), float(w[-1]), d[1]) for a, b, d in zip(at[:-1], at[1:], docs)])
    return {"landmarks": landmarks, "w": root @ w[:-1], "bias": float(w[-1]), "last": fit_logistic(last, y)}


def _words(column) -> np.ndarray:
    counts = [np.diff(word_hashes(off, data)[1]) for _, off, data in text_slices(column)]
    return np.concatenate(counts) if counts else np.zeros(0, np.int64)


def _kernels_of(landmarks: list[bytes]):
    """For each training document the kernels of its likeliest sentences."""
    def run(batches):
        reader = reader_of(landmarks)
        for batch in batches:
            labels = batch.column("label").to_pylist()
            held: list[list] = [[] for _ in labels]
            for row, _, k in reader.sentences(batch.column("text")):
                held[row].append(k)
            rows = [sorted(h, key=lambda k: -float(k.max()))[:SENTENCES] for h in held]
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.int32()), pa.array(_words(batch.column("text")), pa.int64()),
                 pa.array([np.concatenate(r).astype(float) if r else np.zeros(0) for r in rows], pa.list_(pa.float64()))],
                names=["label", "words", "kernels"])

    return run


def fit(documents: DataFrame, labels: DataFrame, held_out: Column) -> dict | None:
    """Fit on rows of ``labels(doc_id, toxic)`` for which ``held_out`` (over ``doc_id``) is false."""
    ids = small(save(sample_of(labels, "toxic", ~held_out, SAMPLE).withColumnRenamed("doc_id", "label_id"), "sample"))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    rows = save(docs.join(ids, F.col("doc_id") == F.col("label_id")).select("label", "text"), "training")
    counts = dict(rows.groupBy("label").count().collect())
    if len(counts) < 2:
        return None
    landmarks = choose_landmarks(rows, counts[1])
    if not landmarks:
        return None
    found = rows.mapInArrow(_kernels_of(landmarks), "label int, words long, kernels array<double>").toArrow().to_pylist()
    kept = [(r["label"], r["words"], np.array(r["kernels"]).reshape(-1, len(landmarks))) for r in found]
    kept.sort(key=lambda d: (d[0], d[1], d[2].shape, d[2].tobytes()))  # whatever order the rows come in
    return train(landmarks, kept)


def _scored(model):
    def run(batches):
        m = model.value
        reader = reader_of(m["landmarks"]) if m else None
        for batch in batches:
            if m is None:
                scores = np.zeros(batch.num_rows)
            else:
                values: list[list[float]] = [[] for _ in range(batch.num_rows)]
                for row, _, k in reader.sentences(batch.column("text")):
                    values[row].append(float(k @ m["w"]) + m["bias"])
                x = np.array([summary(v, m["bias"], n) for v, n in zip(values, _words(batch.column("text")))]).reshape(-1, 5)
                scores = 1 / (1 + np.exp(-np.clip(x @ m["last"][:-1] + m["last"][-1], -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return run


def toxicity(documents: DataFrame, labels: DataFrame, held_out: Column | None = None) -> DataFrame:
    """``doc_id, score`` for every row of ``documents(doc_id, text)``."""
    ship()
    model = fit(documents, labels, F.lit(False) if held_out is None else held_out)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    return docs.mapInArrow(_scored(shared), "doc_id long, score double")


def op2_toxic_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all ``documents``, learned from the labels of four folds of five."""
    held = crc_fold(5, 0)
    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held)
    return found.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))
