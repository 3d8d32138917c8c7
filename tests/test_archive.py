"""The archive prunes: directories by track and car bucket, row groups by Bloom filter."""

from __future__ import annotations

import glob

import duckdb
import pytest
from pyspark.sql import functions as F

from pitwall.session import scratch_path
from pitwall.sources import tracks as T
from pitwall.streaming import sinks as K


@pytest.fixture(scope="module")
def archive(spark):
    base = scratch_path(spark, "test-archive")
    for batch in range(2):
        rows = spark.range(4000).select(
            (F.col("id") % 100 * 2).alias("car_id"), F.concat(F.lit("t"), F.col("id") % 2).alias("track_id"),
            (F.col("id") + 4000 * batch).alias("time"), F.col("id").cast("double").alias("speed_kmh"))
        K.archive_writer(base)(rows, batch)
    return base


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_list_of_cars_prunes_directories_when_the_query_runs(spark, archive):
    cars = spark.createDataFrame([(4,), (10,), (11,), (None,), (4,)], "car_id long")
    got = T.read_archive(spark, archive, cars=cars)
    plan = plan_of(got)
    scan = next(line for line in plan.split("\n") if "FileScan" in line)
    assert "dynamicpruningexpression(car_bucket" in scan and "dynamicpruningexpression(true)" not in scan
    assert "BroadcastHashJoin" in plan
    assert {r.car_id for r in got.collect()} == {4, 10} and got.count() == 160


def test_one_car_prunes_its_bucket_and_row_groups(spark, archive):
    got = T.read_archive(spark, archive, track_id="t0", car_id=4)
    scan = next(line for line in plan_of(got).split("\n") if "FileScan" in line)
    assert "PartitionFilters: [" in scan and "car_bucket" in scan.split("PartitionFilters: [")[1]
    assert got.count() == 80 and {r.track_id for r in got.collect()} == {"t0"}


def test_bloom_filters_where_a_dictionary_does_not_hold_the_cars(spark):
    """Few cars a file are in its dictionary, which the reader uses; beyond that there is a filter."""
    base = scratch_path(spark, "test-bloom")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.dictionary.page.size", "64")
    try:
        rows = spark.range(8000).select((F.col("id") * 2).alias("car_id"), F.lit("t").alias("track_id"),
                                        F.col("id").alias("time"), F.lit(1.0).alias("speed_kmh"))
        K.archive_writer(base)(rows.coalesce(1), 0)
    finally:
        conf.unset("parquet.dictionary.page.size")
    files = glob.glob(f"{base.removeprefix('file:')}/batch_id=*/track_id=*/car_bucket=*/*.parquet")
    con, f = duckdb.connect(), files[0]
    low, high = con.execute(f"SELECT min(car_id), max(car_id) FROM '{f}'").fetchone()

    def excluded(car):
        return con.execute(f"SELECT bool_and(bloom_filter_excludes) FROM parquet_bloom_probe('{f}', 'car_id', {car})").fetchone()[0]

    # cars are even: odd ones between a file's least and greatest car are found absent by the filter
    assert not excluded(low) and sum(excluded(car) for car in range(low + 1, high, 200)) > 30
    assert len({f.split("car_bucket=")[1].split("/")[0] for f in files}) == T.CAR_BUCKETS
    assert T.read_archive(spark, base, car_id=low + 1).count() == 0 and T.read_archive(spark, base, car_id=low).count() == 1


def test_a_longer_list_joins_by_shuffle(spark, archive, monkeypatch):
    monkeypatch.setattr(T, "BROADCAST_CARS", 1)
    cars = spark.createDataFrame([(4,), (10,)], "car_id long")
    assert T.read_archive(spark, archive, cars=cars).count() == 160
