"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles; two documents link when the Jaccard similarity of
their sets reaches a threshold.  The join is exact:

1. *Classes.* Documents with equal sets form one class (a third of all rows may be copies
   of one text: from here on a class counts once).
2. *Groups.* Three min-hashes of a set name a group each; a class is compared with the
   group's centre alone: the member with the smallest share of tokens that few documents
   hold, then the one whose min-hashes are the most widely shared; in a family of edited
   copies this is the text they stem from.  Components of the links found are the groups of
   similar documents.
3. *Matrix.* Under one order of all tokens, two linked sets share a token among the first
   ``n - ceil(t n) + 1`` of each.  For each token of these prefixes and each group the
   matrix holds the union over the group's members: least position, least and greatest
   set size.  A set is looked up against larger groups; position and sizes bound its
   overlap with any member.
   Sets that do not share ``t n`` of their tokens with any other set that is left are out
   before this, by counts over all tokens of the sets left.
4. *Union bound.* For the groups left, the set's overlap with the union of all the group's
   tokens is counted.  Only groups where it still allows a link are opened: the set is
   compared with the member that shares most of its prefix.  After that, sets that are still
   in different components are compared with groups of one, and with all members that pass
   the bound of step 3.
5. The links of steps 2 and 4 give the components.

Tokens are ordered by their hash, but tokens of passages that many documents share come
last, which keeps them out of almost all prefixes.  They are found by counts over all
documents (a token counts where it meets itself within a slice of a million tokens) and
held in a filter of fixed size: any error in it changes the work, not the links, because
every order common to all documents gives the same result.

Defined cases: null text, empty text and text without words have an empty set and no
links; fewer words than a shingle make one shingle; repeated rows are copies; a null
``doc_id`` stays null in the result and counts as no id when the smallest id of a
component is sought (null if there is none); other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import bloom
from pitwall.llm.common import held, mapped, released, save, ship, small, table
from pitwall.llm.graph import components
from pitwall.llm.shingles import mix64, set_key, shingle_sets

#: Seeds of the min-hash permutations; the first ``ROUNDS`` make groups, all choose centres.
SEEDS = tuple(0x9E3779B97F4A7C15 * i % (1 << 64) for i in range(8))
ROUNDS = 3
#: Tokens that met themselves in at least this many documents are ordered last.
HOT = 32
COUNT_TOKENS = 1_000_000
#: Tokens of the compared sets that meet one copy of a centre's text.
SALT_TOKENS = 262_144
#: Tokens of a group's members that one task holds while it counts overlaps.
UNION_TOKENS = 1_000_000
#: Tokens that one task counts to see which of them stand in two sets.
BUCKET_TOKENS = 2_000_000
#: Tokens of a packed row: an Arrow batch holds many of them.
ROW_TOKENS = 4096
_OUT_ROWS = 200_000

_SIGNATURES = "kind byte, doc_id long, th long, n int, v long, keys array<long>"


def _signatures(k: int):
    """A row for each document (kind 0) and for each token seen twice or more in a slice
    of different sets (kind 1: token in ``v``, documents in ``n``)."""

    def rows(kind, ids, th, n, v, keys) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int8()), ids, th, pa.array(n, pa.int32()), pa.array(v, pa.int64()),
             pa.array(keys, pa.list_(pa.int64()))], names=["kind", "doc_id", "th", "n", "v", "keys"])

    def counted(held: list) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        tokens, counts = tokens[counts > 1].view(np.int64), counts[counts > 1]
        none = pa.nulls(len(tokens), pa.int64())
        return rows(np.ones(len(tokens)), none, none, counts, tokens, [None] * len(tokens))

    def run(batches):
        held, seen, size = [], set(), 0
        seeds = [np.uint64(x) for x in SEEDS]
        for batch in batches:
            n, v, keys = [], [], []
            for _, s in shingle_sets(batch.column("text"), k):
                n.append(len(s))
                if not len(s):
                    v.append(None)
                    keys.append(None)
                    continue
                v.append(set_key(s))
                keys.append([int(mix64(s ^ x).min().view(np.int64)) for x in seeds])
                if v[-1] not in seen:
                    seen.add(v[-1])
                    held.append(s)
                    size += len(s)
                if size >= COUNT_TOKENS:
                    yield counted(held)
                    held, seen, size = [], set(), 0
            yield rows(np.zeros(len(n)), batch.column("doc_id"), batch.column("th"), n, v, keys)
        if held:
            yield counted(held)

    return run


def _prefixes(k: int, percent: int, hot):
    """A row for each token of each set's prefix: ``token, v, n, pos``; and one for the set,
    with ``pos`` -1 and the number of its tokens that few documents hold in ``token``."""

    def rows(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(out[0]).view(np.int64)), *(pa.array(np.concatenate(x)) for x in out[1:])],
            names=["token", "v", "n", "pos"])

    def run(batches):
        bits, out, size = hot.value, [[], [], [], []], 0
        for batch in batches:
            for _, s in shingle_sets(batch.column("text"), k):
                n = len(s)
                if not n:
                    continue
                p = n - (percent * n + 99) // 100 + 1
                last = bloom.maybe(bits, s)
                cold = s[~last]
                out[0].append(np.concatenate([np.array([len(cold)], np.uint64), cold[:p], s[last][:max(0, p - len(cold))]]))
                out[1].append(np.full(p + 1, set_key(s), np.int64))
                out[2].append(np.full(p + 1, n, np.int32))
                out[3].append(np.arange(-1, p, dtype=np.int32))
                size += p
                if size >= _OUT_ROWS:
                    yield rows(out)
                    out, size = [[], [], [], []], 0
        if size:
            yield rows(out)

    return run


def _compare(k: int, percent: int):
    """Rows sorted by (centre, salt, side): a centre's text, then the texts compared with it."""

    def run(batches):
        centre, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            base, salt, side, v = (batch.column(c).to_pylist() for c in ("b", "salt", "side", "v"))
            a_out, b_out = [], []
            for i, s in shingle_sets(batch.column("text"), k):
                if not len(s) or set_key(s) != v[i]:
                    continue  # another text of the same hash
                if side[i] == 0:
                    centre, held = (base[i], salt[i]), s
                elif centre == (base[i], salt[i]):
                    common = len(np.intersect1d(s, held, assume_unique=True))
                    if 100 * common >= percent * (len(s) + len(held) - common):
                        a_out.append(v[i])
                        b_out.append(base[i])
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return run


def _dealt(k: int):
    """Each set's tokens, dealt to the buckets of the group it meets."""

    def run(batches):
        for batch in batches:
            group, buckets, side, v = (batch.column(c).to_pylist() for c in ("group", "buckets", "side", "v"))
            out: list[list] = [[], [], [], [], []]
            for i, s in shingle_sets(batch.column("text"), k):
                if not len(s) or set_key(s) != v[i]:
                    continue
                spot = (s >> np.uint64(40)) % np.uint64(buckets[i])
                for b in range(buckets[i]):
                    part = s if buckets[i] == 1 else s[spot == b]
                    if len(part):
                        for x, y in zip(out, (group[i], b, side[i], v[i], part.tobytes())):
                            x.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()),
                 pa.array(out[3], pa.int64()), pa.array(out[4], pa.binary())],
                names=["group", "bucket", "side", "v", "tokens"])

    return run


def _scattered(k: int, buckets: int):
    """Tokens of many sets, packed by bucket in rows of at most ``ROW_TOKENS``: 32 bits of
    each token, and whose they are.  Tokens that meet in 32 bits only add to the counts."""

    def rows(keys: list, held: list) -> pa.RecordBatch:
        tokens = np.concatenate(held)
        owner = np.repeat(np.arange(len(held)), [len(s) for s in held])
        bucket = ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        low, owner, keys = tokens[order].astype(np.uint32), owner[order], np.array(keys, np.int64)
        out: list[list] = [[], [], [], []]
        for b in np.flatnonzero(np.diff(cut)).tolist():
            for lo in range(cut[b], cut[b + 1], ROW_TOKENS):
                hi = min(lo + ROW_TOKENS, cut[b + 1])
                own = owner[lo:hi]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                for x, y in zip(out, (b, keys[own[first]].tobytes(), np.diff(np.r_[first, len(own)]).astype(np.int32).tobytes(),
                                      low[lo:hi].tobytes())):
                    x.append(y)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])],
                                          names=["bucket", "v", "lengths", "tokens"])

    def run(batches):
        keys, held, size = [], [], 0
        for batch in batches:
            v = batch.column("v").to_pylist()
            for i, s in shingle_sets(batch.column("text"), k):
                if not len(s) or set_key(s) != v[i]:
                    continue
                keys.append(v[i])
                held.append(s)
                size += len(s)
                if size >= COUNT_TOKENS:
                    yield rows(keys, held)
                    keys, held, size = [], [], 0
        if held:
            yield rows(keys, held)

    return run


def _shared(parts_of_sets: int):
    """Rows sorted by bucket: for each set, how many of its tokens in the bucket another set
    holds too, packed in a row for each part of the sets."""
    def counted(parts: list[tuple]) -> pa.RecordBatch:
        v, lengths, tokens = (np.concatenate([np.frombuffer(p[i], t) for p in parts])
                              for i, t in enumerate((np.int64, np.int32, np.uint32)))
        ordered = np.sort(tokens)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        ends = np.cumsum(lengths, dtype=np.int64)
        more = np.zeros(len(tokens) + 1, np.int32)
        if len(twice):
            for lo in range(0, len(tokens), _OUT_ROWS):
                some = tokens[lo:lo + _OUT_ROWS]
                more[lo + 1:lo + 1 + len(some)] = twice[np.minimum(np.searchsorted(twice, some), len(twice) - 1)] == some
            np.cumsum(more, out=more)
        found = np.diff(np.r_[0, more[ends]]).astype(np.int32)
        part = (v.view(np.uint64) % np.uint64(parts_of_sets)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(parts_of_sets + 1))
        v, found, own = v[order], found[order], np.flatnonzero(np.diff(cut)).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), *(pa.array([x[cut[i]:cut[i + 1]].tobytes() for i in own], pa.binary()) for x in (v, found))],
            names=["part", "v", "shared"])

    def run(batches):
        at, parts = None, []
        for batch in batches:
            for b, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "v", "lengths", "tokens"))):
                if b != at:
                    if parts:
                        yield counted(parts)
                    at, parts = b, []
                parts.append(row)
        if parts:
            yield counted(parts)

    return run


def _summed(batches):
    """Rows sorted by part: the packed counts of each set, added up."""
    def added(held: list[tuple]) -> pa.RecordBatch:
        v, found = (np.concatenate([np.frombuffer(h[i], t) for h in held]) for i, t in enumerate((np.int64, np.int32)))
        v, inverse = np.unique(v, return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(v), pa.array(np.bincount(inverse, found).astype(np.int64))], names=["v", "shared"])

    at, held = None, []
    for batch in batches:
        for part, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "v", "shared"))):
            if part != at:
                if held:
                    yield added(held)
                at, held = part, []
            held.append(row)
    if held:
        yield added(held)


def _maybe_in(bits):
    """The rows whose token may be in a filter."""
    def run(batches):
        for batch in batches:
            keep = bloom.maybe(bits.value, batch.column("token").to_numpy(zero_copy_only=False).view(np.uint64))
            yield batch.filter(pa.array(keep))

    return run


def _overlaps(batches):
    """Rows sorted by (group, bucket, side): members' tokens, whose union is held, then the
    tokens of the sets looked up; gives the overlaps of the latter."""
    at, parts, union = None, [], np.zeros(0, np.uint64)
    for batch in batches:
        group, bucket, side, v = (batch.column(c).to_pylist() for c in ("group", "bucket", "side", "v"))
        out: list[list] = [[], [], [], []]
        for i, tokens in enumerate(batch.column("tokens").to_pylist()):
            tokens = np.frombuffer(tokens, np.uint64)
            if at != (group[i], bucket[i]):
                at, parts, union = (group[i], bucket[i]), [], np.zeros(0, np.uint64)
            if side[i] == 0:
                parts.append(tokens)
                continue
            if parts:
                union, parts = np.unique(np.concatenate([union, *parts])), []
            for x, y in zip(out, (group[i], bucket[i], v[i], len(np.intersect1d(union, tokens, assume_unique=True)))):
                x.append(y)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
             pa.array(out[3], pa.int64())], names=["group", "bucket", "v", "overlap"])


class _Join:
    """The tables of one join: ``docs(doc_id, text, th)`` and ``classes(v, n, rid, id, th, keys)``."""

    def __init__(self, docs: DataFrame, classes: DataFrame, k: int, percent: int):
        self.docs, self.classes, self.k, self.percent = docs, classes, k, percent

    def texts(self, keys: DataFrame) -> DataFrame:
        """``v, n, text`` of the classes whose key is in ``keys(v)``, written: one scan of the
        documents, without a shuffle of their texts where the keys are few enough."""
        want = save(self.classes.join(keys.distinct(), "v").select(
            "v", "n", F.col("id").alias("want_id"), F.col("th").alias("want_th")), "wanted")
        return save(self.docs.join(small(want), (F.col("th") == F.col("want_th")) & F.col("doc_id").eqNullSafe(F.col("want_id")))
                    .select("v", "n", "text"), "texts")

    def shared(self, keys: DataFrame) -> DataFrame:
        """``v, shared``: how many tokens of each class in ``keys(v)`` another one of them holds.

        All their tokens are dealt to buckets of about 2 million by hash and counted there.  A
        text that stands in several rows of the same id counts for each, which can only raise
        what is an upper bound.
        """
        want = save(self.classes.join(keys.select("v").distinct(), "v").select(
            "v", "n", F.col("id").alias("want_id"), F.col("th").alias("want_th")), "wanted")
        tokens, sets = want.agg(F.sum("n"), F.count("*")).first()
        buckets = 1 + (tokens or 0) // BUCKET_TOKENS
        parts = 1 + min(tokens or 0, sets * buckets) // UNION_TOKENS
        rows = (self.docs.join(small(want), (F.col("th") == F.col("want_th")) & F.col("doc_id").eqNullSafe(F.col("want_id")))
                .select("v", "text"))
        dealt = (mapped(rows, _scattered(self.k, buckets), "bucket int, v binary, lengths binary, tokens binary")
                 .repartition("bucket").sortWithinPartitions("bucket"))
        counted = (mapped(dealt, _shared(parts), "part int, v binary, shared binary")
                   .repartition("part").sortWithinPartitions("part"))
        return mapped(counted, _summed, "v long, shared long")

    def linked(self, texts: DataFrame, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` of class keys whose sets reach the threshold.

        A centre ``b`` met by many sets gets a copy of its text for every 262,144 tokens of
        them, so no task holds more than one text of each side, and a hub is spread.
        """
        known = save(pairs.join(self.classes.select(F.col("v").alias("a"), F.col("n").alias("n_a")), "a"), "pairs")
        salts = known.groupBy("b").agg(F.ceil(F.sum("n_a") / SALT_TOKENS).cast("int").alias("salts"))
        known = known.join(small(save(salts, "salts")), "b").withColumn(
            "salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int"))
        left = known.select("b", "salt", F.lit(1).alias("side"), F.col("a").alias("v"))
        right = known.select("b", "salt", F.lit(0).alias("side"), F.col("b").alias("v")).distinct()
        both = (left.unionByName(right).join(texts.select("v", "text"), "v").select("b", "salt", "side", "v", "text")
                .repartition("b", "salt").sortWithinPartitions("b", "salt", "side"))
        return save(mapped(both, _compare(self.k, self.percent), "a long, b long").distinct(), "links")

    def stars(self, rare: DataFrame) -> DataFrame:
        """Pairs of a class and the centre of a group it is in, for three groupings; ``rare(v,
        rare)`` counts a class's tokens that few documents hold."""
        keys = (self.classes.select("v", "n", F.posexplode("keys").alias("i", "key")))
        counts = save(keys.groupBy("i", "key").agg(F.count("*").alias("size")).where("size > 1"), "key_counts")
        keys = keys.join(small(counts), ["i", "key"])
        scores = save(keys.groupBy("v").agg(F.sum("size").alias("score")), "scores")
        keys = save(keys.where(F.col("i") < ROUNDS).join(scores, "v").join(rare, "v"), "keys")
        common = -F.floor(F.col("rare") * 50 / F.col("n"))
        centres = save(keys.groupBy("i", "key").agg(F.max(F.struct(common.alias("common"), "score", "n", "v")).alias("c"))
                       .select("i", "key", F.col("c.v").alias("b"), F.col("c.n").alias("n_b")), "centres")
        return (keys.join(centres, ["i", "key"]).where("v <> b")
                .where(f"100 * least(n, n_b) >= {self.percent} * greatest(n, n_b)")
                .select(F.col("v").alias("a"), "b").distinct())

    def rest(self, prefix: DataFrame, groups: DataFrame) -> DataFrame:
        """Links between the groups ``groups(v, root)``, enough of them for the components."""
        t, both = self.percent, 100 + self.percent
        sizes = groups.groupBy("root").agg((F.count("*") + 1).alias("members"))
        groups = save(groups.unionByName(groups.select(F.col("root").alias("v"), "root").distinct())
                      .join(sizes, "root"), "groups")
        prefix = prefix.join(small(groups), "v", "left").select(
            "token", "v", "n", "pos", F.coalesce("root", "v").alias("g"), F.coalesce("members", F.lit(1)).alias("members"))
        shared = save(prefix.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
                      .where("lo <> hi").select("token"), "shared")
        bits = self.docs.sparkSession.sparkContext.broadcast(bloom.build(shared, "token"))
        prefix = save(
            mapped(prefix, _maybe_in(bits), prefix.schema).join(small(shared), "token", "left_semi")
            .groupBy("token", "v").agg(*(F.min(c).alias(c) for c in ("n", "pos", "g", "members"))), "shared_prefix")
        # a linked set shares t n of its tokens with another one; most texts that have a passage
        # in common do not, and end here
        able = save(prefix.select("v", "n").distinct().join(self.shared(prefix), "v")
                    .where(f"100 * shared >= {t} * n").select("v"), "able")
        prefix = save(prefix.join(small(able), "v", "left_semi"), "able_prefix")
        matrix = prefix.groupBy("token", F.col("g").alias("group")).agg(
            F.min("members").alias("group_size"), F.min("pos").alias("group_pos"),
            F.min("n").alias("group_low"), F.max("n").alias("group_high"))
        near = save(
            prefix.join(matrix, "token").where("members < group_size OR (members = group_size AND g < group)")
            .where(f"100 * group_high >= {t} * n AND 100 * n >= {t} * group_low")
            .where(f"{both} * least(n - pos, group_high - group_pos) >= {t} * (n + group_low)")
            .select("token", "v", "n", "pos", "group", "group_size", "group_low"), "near")
        alone = save(near.where("group_size = 1").select(
            F.col("v").alias("a"), F.col("group").alias("b"), F.col("n").alias("n_a"), F.col("group_low").alias("n_b")).distinct(), "alone")
        # the same among these sets alone, with the size of the smallest set each is to meet
        sides = alone.select(F.col("a").alias("v"), F.col("n_a").alias("n"), F.col("n_b").alias("met")).union(
            alone.select("b", "n_b", "n_a"))
        able = save(sides.groupBy("v").agg(F.min("n").alias("n"), F.min("met").alias("met")).join(self.shared(sides), "v")
                    .where(f"{both} * shared >= {t} * (n + met)").select("v"), "able_alone")
        for side in "ab":
            alone = alone.join(small(able.select(F.col("v").alias(side))), side, "left_semi")
        alone = save(alone.select("a", "b"), "alone_able")
        met = save(near.where("group_size > 1").groupBy("v", "group").agg(
            F.min("n").alias("n"), F.min("group_low").alias("low")), "met")
        members = save(groups.select("v", F.col("root").alias("group")).join(
            small(met.select("group").distinct()), "group", "left_semi"), "members")
        texts = self.texts(alone.select(F.col("a").alias("v")).union(alone.select("b")).union(met.select("v"))
                           .union(members.select("v")))

        buckets = (members.join(self.classes.select("v", "n"), "v").groupBy("group")
                   .agg(F.ceil(F.sum("n") / UNION_TOKENS).cast("int").alias("buckets")))
        sides = members.select("group", F.lit(0).alias("side"), "v").unionByName(
            met.select("group", F.lit(1).alias("side"), "v"))
        dealt = (sides.join(small(save(buckets, "buckets")), "group").join(texts.select("v", "text"), "v")
                 .select("group", "buckets", "side", "v", "text"))
        dealt = (mapped(dealt, _dealt(self.k), "group long, bucket int, side int, v long, tokens binary")
                 .repartition("group", "bucket").sortWithinPartitions("group", "bucket", "side"))
        overlap = (mapped(dealt, _overlaps, "group long, bucket int, v long, overlap long")
                   .groupBy("group", "bucket", "v").agg(F.max("overlap").alias("overlap"))
                   .groupBy("group", "v").agg(F.sum("overlap").alias("overlap")))
        # a member linked to a set of n has at least t n shingles, and the least size of its group
        opened = save(met.join(overlap, ["group", "v"])
                      .where(f"{both} * overlap >= {t} * (n + greatest(low, {t} * n / 100))").select("group", "v"), "opened")

        member = prefix.select("token", F.col("v").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"),
                               F.col("g").alias("group"))
        pairs = save(
            near.join(small(opened), ["group", "v"], "left_semi").join(member, ["token", "group"])
            .where(f"100 * least(n, n_b) >= {t} * greatest(n, n_b)")
            .where(f"{both} * least(n - pos, n_b - pos_b) >= {t} * (n + n_b)")
            .groupBy("v", "b", "group").agg(F.count("*").alias("hits")), "opened_pairs")
        best = pairs.groupBy("v", "group").agg(F.max(F.struct("hits", "b")).alias("c")).select(
            F.col("v").alias("a"), F.col("c.b").alias("b"), "group")
        best = save(best.select("a", "b"), "best")
        links = self.linked(texts, best)
        # what these links have brought together needs no further comparison
        roots = components(groups.where("v <> root").select(F.col("v").alias("a"), F.col("root").alias("b")).unionByName(links))
        others = alone.union(pairs.select("v", "b")).join(best, ["a", "b"], "left_anti")
        for side in "ab":
            others = (others.join(small(roots.select(F.col("v").alias(side), F.col("root").alias(f"root_{side}"))), side, "left")
                      .withColumn(f"root_{side}", F.coalesce(f"root_{side}", side)))
        others = others.where("root_a <> root_b").select("a", "b").distinct()
        return links.unionByName(self.linked(texts, others))


def ngram_join(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, th, root, component_id`` for every row of ``documents(doc_id, text)``.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their distinct
    ``k``-word shingles; ``component_id`` is the smallest ``doc_id`` reachable by links,
    ``th`` a hash of the row's text and ``root`` a key of its component (null for an empty set).
    """
    ship()
    spark = documents.sparkSession
    text = F.col("text").cast("string")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))
    signatures = save(mapped(docs, _signatures(k), _SIGNATURES), "signatures")
    rows = signatures.where("kind = 0").select("doc_id", "th", "n", "v", "keys")
    # a class's keys follow from its set: any row's will do
    classes = save(rows.where("n > 0").groupBy("v").agg(
        F.min("doc_id").alias("rid"), F.min("n").alias("n"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("at"), F.min("keys").alias("keys"))
        .select("v", "rid", "n", F.col("at.doc_id").alias("id"), F.col("at.th").alias("th"), "keys"), "classes")
    hot = signatures.where("kind = 1").groupBy("v").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT)
    hot = spark.sparkContext.broadcast(bloom.build(hot, "v"))

    join = _Join(docs, classes, k, percent)
    prefix = save(mapped(docs.select("text"), _prefixes(k, percent, hot), "token long, v long, n int, pos int"), "prefix")
    rare = save(prefix.where("pos < 0").groupBy("v").agg(F.min("token").alias("rare")), "rare")
    stars = save(join.stars(rare), "stars")
    stars = join.linked(join.texts(stars.select(F.col("a").alias("v")).union(stars.select("b"))), stars)
    groups = components(stars)
    links = join.rest(prefix.where("pos >= 0"), groups)
    roots = components(groups.select(F.col("v").alias("a"), F.col("root").alias("b")).unionByName(links))

    named = classes.select("v", "rid").join(roots, "v", "left").select("v", "rid", F.coalesce("root", "v").alias("root"))
    least = named.groupBy("root").agg(F.min("rid").alias("component"))
    named = save(named.join(least, "root").select("v", "root", "component"), "components")
    return (rows.join(named, "v", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"), "th", "root",
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")))


def without_near_copies(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``documents`` with one of each component: the smallest ``doc_id`` (a null one
    only if there is no other; then by a hash of the text).  Of repeated rows one stays; rows
    with an empty set all stay."""
    rows = save(ngram_join(documents, k, percent).where("root IS NOT NULL")
                .select("doc_id", "th", "root"), "joined")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "th")
    kept = save(rows.groupBy("root").agg(F.min(first).alias("first")), "kept")
    rows = rows.join(kept, "root").withColumn("kept", first == F.col("first"))
    marks = save(rows.groupBy("doc_id", "th").agg(F.max("kept").alias("kept"), F.count("*").alias("rows")), "marks")
    gone = marks.where("NOT kept").select("doc_id", "th")
    again = marks.where("kept AND rows > 1").select("doc_id", "th")
    same = (F.xxhash64(F.col("row.text").cast("string")) == F.col("th")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id"))
    docs = held(documents)
    out = docs.join(small(gone), same, "left_anti")
    if again.isEmpty():
        return released(out)
    repeated = (docs.join(small(again), same, "left_semi")
                .select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text")).dropDuplicates(["doc_id", "text"]))
    return released(out.join(small(again), same, "left_anti").unionByName(repeated.select("row")))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` joined on 4-word shingles at 85 %."""
    return (ngram_join(table(spark, sf_dir, "documents"), k=4, percent=85)
            .select("doc_id", "n_shingles", "component_id"))


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
           ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh
  FROM w),
t AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS t FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON s.doc_id = c.a
"""
