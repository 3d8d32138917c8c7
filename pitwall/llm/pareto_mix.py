"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weight's share of all words, at most 3 times its own words; what
lies above is shared out again by weight until no target is above its bound.  Within a
source a document of ``s`` words is expected ``e = min(3, k * (64 - bits(s)))`` times (longer
documents a little less often, which spreads the mix over more documents); ``k`` makes the
expected words the target.  ``floor(e)`` whole copies are certain.  For the rest, documents
are ranked by ``(u / (1 - u)) / (q / (1 - q))`` with ``u`` a random number fixed by seed, id and
text and ``q = e - floor(e)``: the first in this order, as many as bring the source's words
nearest its target, get one copy more.  Last, one document of the source changes sides if that
brings the sum nearer still: the one whose size is nearest the gap.

The end of a source's order is found without sorting it: words are summed over 4,096 cells
of the rank, then over 4,096 cells within the cell where the target falls, and only what
lies in that one is put in order.  A document's copies then follow from its own row and two
small tables, so a source may hold any share of the rows.

Defined cases: null text has size 0 (and takes no words); a null source is a source of its
own, the last; repeated rows (same id, source and text) are taken alike; an empty table gives an empty
result; other columns pass through ``mixed`` untouched whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import held, released, save, small, table

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: No source's target, and no document's copies, exceed this many times its size.
MOST = 3
CELLS = 4096
SEED = "mix-1"


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _digest(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.lit(SEED + "|"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"),
                          F.md5(F.coalesce(text, F.lit("")))))


def _uniform(digest: Column) -> Column:
    """The first 52 bits of a hex digest as a number strictly between 0 and 1."""
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _targets(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``source, source_size, weight, target``: a row for each source."""
    sources = sizes.groupBy("source").agg(F.sum("words").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(w).cast("long") for w in weights))
    sources = sources.withColumn("weight", F.get(cycle, (F.row_number().over(order) - 1) % len(weights)))
    # sources in the order in which a rising level fills them
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    cap = F.col("source_size") * MOST
    rest = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.currentRow, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(Window.partitionBy()) - (F.sum(cap).over(fill.rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - cap)) / F.sum("weight").over(rest))
    leveled = sources.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= cap)
    # the level of the first source that it doesn't fill; later rows subtract more and lie lower
    final = F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy())
    return leveled.select("source", "source_size", "weight", F.when(
        F.col("full"), cap.cast("double")).otherwise(F.least(cap.cast("double"), final * F.col("weight"))).alias("target"))


def _copies(classes: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, bits, whole, q`` for each source and size class (at most 64 a source)."""
    c = (classes.join(targets, classes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
         .withColumn("share", F.lit(64) - F.col("bits")))
    own = Window.partitionBy("source").orderBy("bits")
    before = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = own.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = F.try_divide(F.col("target") - MOST * (F.sum("words").over(before) - F.col("words")),
                         F.sum(F.col("words") * F.col("share")).over(after))
    whole = F.col("target") >= MOST * F.col("source_size")
    c = c.withColumn("level", level).withColumn("full", whole | (F.col("level") * F.col("share") >= MOST))
    final = F.min(F.when(~F.col("full"), F.struct("bits", "level"))).over(Window.partitionBy("source"))["level"]
    e = F.when(F.col("full"), F.lit(float(MOST))).otherwise(F.least(F.lit(float(MOST)), final * F.col("share")))
    e = F.greatest(F.coalesce(e, F.lit(0.0)), F.lit(0.0))
    return (c.withColumn("e", e)
            .select("source", "bits", "words", "target", "source_size", F.floor("e").alias("whole"),
                    (F.col("e") - F.floor("e")).alias("q")))


def _rank(u: Column, q: Column) -> Column:
    """Random odds over inclusion odds, mapped to (0, 1); null where nothing is left to chance."""
    odds = (u / (1 - u)) / (q / (1 - q))
    return F.when(q > 0, odds / (1 + odds))


def _cut(rows: DataFrame, rest: DataFrame) -> DataFrame:
    """``source, cut_rank, cut_digest``: the last document of each source's order that is taken."""
    def crossing(cells: DataFrame, by: str) -> DataFrame:
        """The cell of each source in which the words reach the rest of its target."""
        own = Window.partitionBy("source").orderBy(by)
        run = cells.withColumns({"upto": F.col("before") + F.sum("words").over(own),
                                 "last": F.max(by).over(Window.partitionBy("source"))})
        hit = run.where((F.col("upto") >= F.col("rest")) | (F.col(by) == F.col("last")))
        return hit.groupBy("source").agg(F.min(F.struct(
            F.col(by).alias("cell"), (F.col("upto") - F.col("words")).alias("before"), "rest")).alias("c")).select(
            "source", F.col("c.cell").alias("cell"), F.col("c.before").alias("before"), F.col("c.rest").alias("rest"))

    def within(frame: DataFrame, at: DataFrame, by: str) -> DataFrame:
        at = small(save(at.select(F.col("source").alias("s"), "cell", "before", "rest"), "cells"))
        return (frame.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col(by) == F.col("cell")))
                .drop("s", "cell"))

    rows = (rows.where("rank IS NOT NULL").withColumn("c1", F.floor(F.col("rank") * CELLS).cast("int"))
            .withColumn("c2", F.floor((F.col("rank") * CELLS - F.col("c1")) * CELLS).cast("int")))
    rest = rest.select(F.col("source").alias("s"), "rest", F.lit(0).cast("long").alias("before"))
    one = rows.groupBy("source", "c1").agg(F.sum("size").alias("words"))
    one = crossing(one.join(rest, F.col("source").eqNullSafe(F.col("s"))).drop("s"), "c1")
    rows = within(rows, one, "c1")
    two = rows.groupBy("source", "c2", "before", "rest").agg(F.sum("size").alias("words"))
    rows = within(rows.drop("before", "rest"), crossing(two, "c2"), "c2")
    last = rows.groupBy("source", "rank", "digest", "before", "rest").agg(F.sum("size").alias("words"))
    own = Window.partitionBy("source").orderBy("rank", "digest")
    last = last.withColumn("upto", F.col("before") + F.sum("words").over(own))
    # a document is taken while that brings the sum nearer the target
    taken = last.withColumn("take", (F.col("upto") * 2 - F.col("words")) < F.col("rest") * 2)
    return taken.groupBy("source").agg(
        F.max(F.when(F.col("take"), F.struct("rank", "digest"))).alias("c"),
        F.min(F.struct("rank", "digest")).alias("first")).select(
        "source", F.coalesce(F.col("c.rank"), F.col("first.rank")).alias("cut_rank"),
        # none of the last cell's documents taken: everything before its first one is
        F.coalesce(F.col("c.digest"), F.lit("")).alias("cut_digest"))


def _changed(ranked: DataFrame, cuts: DataFrame, rest: DataFrame) -> DataFrame:
    """``source, changed``: the digest of the document that changes sides, null for none."""
    cuts = small(cuts.withColumnRenamed("source", "s"))
    sides = (ranked.where("rank IS NOT NULL").join(cuts, F.col("source").eqNullSafe(F.col("s"))).drop("s")
             .withColumn("taken", _taken(F.col("rank"), F.col("digest"))))
    gaps = sides.groupBy("source").agg(F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0)).alias("words"))
    rest = rest.select(F.col("source").alias("s"), "rest")
    gaps = save(gaps.join(rest, F.col("source").eqNullSafe(F.col("s")))
                .select("s", (F.col("rest") - F.col("words")).alias("gap")), "gaps")
    off = F.abs(F.col("size") - F.abs("gap"))
    return (sides.join(small(gaps), F.col("source").eqNullSafe(F.col("s")))
            .where((F.col("taken") == (F.col("gap") < 0)) & (off < F.abs("gap")))
            .groupBy("source").agg(F.min(F.struct(off.alias("off"), "rank", "digest")).alias("c"))
            .select("source", F.col("c.digest").alias("changed")))


def _taken(rank: Column, digest: Column, prefix: str = "") -> Column:
    cut, last = F.col(f"{prefix}cut_rank"), F.col(f"{prefix}cut_digest")
    return F.coalesce((rank < cut) | ((rank == cut) & (digest <= last)), F.lit(False))


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Every row of ``documents(doc_id, text, source)`` with a struct column ``mix_plan`` (in place of
    one of that name): ``size, source_size, target, copies`` (0 to 3)."""
    planned = _planned(documents, weights)
    return planned.select("row.*", "mix_plan") if "mix_plan" not in documents.columns else planned.select(
        F.col("row").dropFields("mix_plan").alias("row"), "mix_plan").select("row.*", "mix_plan")


def _planned(documents: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """The rows as a struct ``row``, and ``mix_plan``."""
    text = F.col("text").cast("string")
    source = F.col("source").cast("string")
    rows = save(documents.select(source.alias("source"), _size(text).alias("size"),
                                 _digest(F.col("doc_id"), text).alias("digest")), "sizes")
    rows = rows.withColumn("bits", F.length(F.bin("size")))
    classes = save(rows.groupBy("source", "bits").agg(F.sum("size").alias("words")), "classes")
    plan = save(_copies(classes, _targets(classes, weights)), "copies")
    rest = plan.groupBy("source", "target").agg(
        (F.col("target") - F.sum(F.col("words") * F.col("whole"))).alias("rest"))
    chances = small(plan.select(F.col("source").alias("s"), F.col("bits").alias("b"), "q"))
    ranked = rows.join(chances, F.col("source").eqNullSafe(F.col("s")) & (F.col("bits") == F.col("b"))).select(
        "source", "size", "digest", _rank(_uniform(F.col("digest")), F.col("q")).alias("rank"))
    cuts = save(_cut(ranked, rest), "cuts")
    changed = _changed(ranked, cuts, rest).withColumnRenamed("source", "c")
    cuts = cuts.join(changed, F.col("source").eqNullSafe(F.col("c")), "left").drop("c").withColumnRenamed("source", "s")
    plan = save(plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").select(F.struct(
        "source", "bits", "source_size", "target", "whole", "q", "cut_rank", "cut_digest", "changed").alias("plan")), "mix")

    p = {c: F.col(f"plan.{c}") for c in plan.schema["plan"].dataType.names}
    keyed = held(documents).select("row", _digest(F.col("row.doc_id"), F.col("row.text").cast("string")).alias("digest"),
                                   _size(F.col("row.text").cast("string")).alias("size"))
    joined = keyed.join(small(plan), F.col("row.source").cast("string").eqNullSafe(p["source"])
                        & (F.length(F.bin("size")) == p["bits"]), "left")
    rank = _rank(_uniform(F.col("digest")), p["q"])
    changes = F.coalesce(p["changed"] == F.col("digest"), F.lit(False))
    more = _taken(rank, F.col("digest"), "plan.") != changes
    copies = (p["whole"] + more.cast("long")).cast("long")
    return joined.select("row", F.struct(
        "size", p["source_size"].alias("source_size"), p["target"].alias("target"), copies.alias("copies")).alias("mix_plan"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: each row of ``documents`` as often as it is taken."""
    return released(_planned(documents, weights).where("mix_plan.copies > 0")
                    .select("row", F.explode(F.sequence(F.lit(1), F.col("mix_plan.copies").cast("int")))))


def op7_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: ``doc_id, size, source_size, target, taken``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixed(docs).select(
        "doc_id", F.col("mix_plan.size").alias("size"), F.col("mix_plan.source_size").alias("source_size"),
        F.col("mix_plan.target").alias("target"), (F.col("mix_plan.size") * F.col("mix_plan.copies")).alias("taken"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS digest FROM documents),
c AS (SELECT *, length(bin(size)) AS bits FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight FROM s),
f AS (SELECT *, (CAST((SELECT sum(source_size) FROM w) AS BIGINT) - CAST(sum(3 * source_size) OVER o - 3 * source_size AS BIGINT))
        / CAST(sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
      FROM w WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN level * weight >= 3 * source_size THEN CAST(3 * source_size AS DOUBLE)
        ELSE least(CAST(3 * source_size AS DOUBLE),
                   (SELECT max(level) FROM f WHERE NOT level * weight >= 3 * source_size) * weight) END AS target FROM f),
k AS (SELECT source, bits, CAST(sum(size) AS BIGINT) AS words FROM c GROUP BY source, bits),
l AS (SELECT k.*, t.source_size, t.target, 64 - bits AS share,
        (target - 3 * CAST(sum(words) OVER (PARTITION BY k.source ORDER BY bits ROWS UNBOUNDED PRECEDING) - words AS BIGINT))
          / CAST(sum(words * (64 - bits)) OVER (PARTITION BY k.source ORDER BY bits ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
g AS (SELECT *, (target >= 3 * source_size OR level * share >= 3) AS full_ FROM l),
v AS (SELECT source, min_by(level, bits) AS level FROM g WHERE NOT full_ GROUP BY source),
e AS (SELECT g.source, bits, words, target, source_size,
        greatest(coalesce(CASE WHEN full_ THEN 3.0::DOUBLE ELSE least(3.0::DOUBLE, v.level * share) END, 0.0::DOUBLE), 0.0::DOUBLE) AS e
      FROM g LEFT JOIN v ON g.source IS NOT DISTINCT FROM v.source),
r AS (SELECT source, target - CAST(sum(words * CAST(floor(e) AS BIGINT)) AS BIGINT) AS rest FROM e GROUP BY source, target),
x AS (SELECT c.doc_id, c.source, c.size, c.digest, e.source_size, e.target, CAST(floor(e.e) AS BIGINT) AS whole,
        e.e - floor(e.e) AS q, (CAST(CAST('0x' || substr(digest, 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0::DOUBLE AS u
      FROM c JOIN e ON c.source IS NOT DISTINCT FROM e.source AND c.bits = e.bits),
y AS (SELECT *, CASE WHEN q > 0 THEN (u / (1 - u)) / (q / (1 - q)) END AS odds FROM x),
z AS (SELECT *, odds / (1 + odds) AS rank FROM y),
n AS (SELECT z.*, r.rest, CAST(sum(size) OVER (PARTITION BY z.source ORDER BY rank, digest ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
      FROM z JOIN r ON z.source IS NOT DISTINCT FROM r.source WHERE rank IS NOT NULL),
p AS (SELECT *, upto * 2 - size < rest * 2 AS taken FROM n),
h AS (SELECT source, rest - CAST(coalesce(sum(size) FILTER (WHERE taken), 0) AS BIGINT) AS gap FROM p GROUP BY source, rest),
i AS (SELECT p.source, p.digest, row_number() OVER (PARTITION BY p.source ORDER BY abs(size - abs(gap)), rank, p.digest) AS r
      FROM p JOIN h ON p.source IS NOT DISTINCT FROM h.source
      WHERE taken = (gap < 0) AND abs(size - abs(gap)) < abs(gap)),
j AS (SELECT p.digest FROM p LEFT JOIN (SELECT digest FROM i WHERE r = 1) k ON p.digest = k.digest
      WHERE p.taken <> (k.digest IS NOT NULL))
SELECT x.doc_id, x.size, x.source_size, x.target,
       x.size * (x.whole + CASE WHEN j.digest IS NULL THEN 0 ELSE 1 END) AS taken
FROM x LEFT JOIN j ON x.digest = j.digest
"""
