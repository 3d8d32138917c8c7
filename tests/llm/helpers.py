from __future__ import annotations

import random

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    T.StructField("score", T.StringType()), T.StructField("v", T.StringType()), T.StructField("size", T.StringType())])


def docs_of(spark, rows, parts: int = 3):
    """``documents`` with extra columns from ``(doc_id, text[, source])``."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(n)]


ODD = [(None, "a text without an id here and there"), (9001, None), (9002, ""), (9003, " \n\t "), (9004, "one"),
       (9005, "One"), (9006, "one two"), (9007, "é ñ 日本 🙂 x"), (9006, "one two")]
