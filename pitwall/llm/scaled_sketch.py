"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every distinct shingle hash that lies in the lowest quarter of the hash range
(and the least hash where none does, so that no text with words has an empty sketch).  As the
threshold is the same for all documents, sketches of parts merge by union, and the
share of one sketch found in another estimates containment however unequal the texts.  All
of it is Spark SQL.

A shingle is five words ``[^\\x20\\x09-\\x0D]+`` of the lower-cased text; fewer words, but
some, are one shingle.

Defined cases: a null text counts as empty; a text without words has an empty sketch;
two empty sketches are alike (1), an empty and another one are not (0); documents follow each
other by ``doc_id``, null first, rows of one id by the hash of their text; the only document
follows itself; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.common import save, small, table

WORDS = 5
#: A hash is kept if it is below this bound: the lowest quarter of signed 64-bit values.
BOUND = -(1 << 62)
#: Documents between two places where their order is cut into independent runs.
RUN = 512


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def sketch(text: Column) -> Column:
    """The sorted hashes of a text's sketch, as an array of longs."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def shingles(h: Column) -> Column:
        joined = F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, WORDS))))
        return (F.when(F.size(h) >= WORDS, F.slice(joined, 1, F.greatest(F.size(h) - (WORDS - 1), F.lit(0))))
                .when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")))

    def kept(all_: Column) -> Column:
        low = F.filter(all_, lambda x: x < BOUND)
        return _let(low, lambda k: F.when(F.size(k) > 0, F.sort_array(F.array_distinct(k)))
                    .when(F.size(all_) > 0, F.array(F.array_min(all_))).otherwise(k))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _let(shingles(h), kept))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two documents together, from their sketches."""
    both = F.array_union(a, b)
    low = F.filter(both, lambda x: x < BOUND)
    return F.when(F.size(low) > 0, F.sort_array(low)).otherwise(F.slice(F.sort_array(both), 1, 1))


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller sketch that the other one holds."""
    least = F.least(F.size(a), F.size(b))
    return (F.when(F.greatest(F.size(a), F.size(b)) == 0, 1.0).when(least == 0, 0.0)
            .otherwise(F.size(F.array_intersect(a, b)) / least))


def printed(a: Column) -> Column:
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def with_next(docs: DataFrame, carried: list[str], derive=lambda rows: rows) -> DataFrame:
    """``docs(doc_id, th, ...)`` with ``next_<column>`` of the row that follows, the first after
    the last; ``derive`` adds columns before that.

    The order is cut into runs of about 512 rows by ``doc_id`` (rows without one by ``th``);
    each run also gets a copy of the row that begins the next run, so that a window within
    the run does the rest.  Only the runs' numbers, a row for each, are put in one order.
    """
    spread = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id"), F.count("*")).first()
    low, high, known, rows = (x or 0 for x in spread)
    width = max(1, -(-(high - low + 1) * RUN // max(known, 1)))
    blanks = max(1, -(-(rows - known) // RUN))
    # differences of far ends exceed a long: as doubles the runs follow the same order
    place = (F.floor((F.col("doc_id") - low) / width) if high - low < 1 << 52
             else F.floor(F.col("doc_id") / float(width) - low / width))
    docs = docs.withColumn("run", F.when(F.col("doc_id").isNull(), F.floor(
        (F.col("th") / float(1 << 64) + 0.5) * blanks).cast("long") - blanks)
        .otherwise(place.cast("long")))
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "th")
    firsts = docs.groupBy("run").agg(F.min(order).alias("first"))
    over = Window.orderBy("run")
    before = F.coalesce(F.lag("run").over(over), F.max("run").over(Window.partitionBy()))
    firsts = save(firsts.select(before.alias("to_run"), F.col("run").alias("first_run"), F.col("first.doc_id").alias("first_id"),
                                F.col("first.th").alias("first_th")), "runs")
    heads = (docs.join(small(firsts), (F.col("run") == F.col("first_run")) & (F.col("th") == F.col("first_th"))
                       & F.col("doc_id").eqNullSafe(F.col("first_id")))
             .dropDuplicates(["first_run"])
             .select(*(F.col("to_run").alias("run") if c == "run" else F.col(c) for c in docs.columns), F.lit(1).alias("copy")))
    both = derive(docs.withColumn("copy", F.lit(0)).unionByName(heads))
    own = Window.partitionBy("run").orderBy("copy", F.col("doc_id").asc_nulls_first(), "th")
    return (both.select("*", *(F.lead(c).over(own).alias(f"next_{c}") for c in carried))
            .where("copy = 0").drop("copy", "run"))


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``
    for every row of ``documents(doc_id, text)``; the edited text has its last quarter
    replaced by the beginning of the next document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    rows = with_next(docs, ["text", "sketch"], lambda rows: rows.withColumn("sketch", sketch(F.col("text"))))
    n = F.length("text").cast("long")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - cut).cast("int")), F.substring("next_text", F.lit(1), cut))
    rows = rows.select("doc_id", n.alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op3_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents"))
