"""Track outlines and stored telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN_TRACK = "Unknown Track"
#: Partition column of the archive: buckets of car ids, and the cars that a file's Bloom filter is made for.
CAR_BUCKET, CAR_BUCKETS, BLOOM_CARS = "car_bucket", 16, 10_000
#: A list of at most this many cars is broadcast.
BROADCAST_CARS = 1_000_000


def car_bucket(car: Column) -> Column:
    return F.pmod(F.xxhash64(car.cast("long")), F.lit(CAR_BUCKETS)).cast("int")


def geojson_waypoints(spark: SparkSession, path: str) -> DataFrame:
    """First feature's LineString of every GeoJSON file -> ``track_id, name, pos, lon, lat``.

    One file is one track (``track_id`` = the collection's ``name``, else the file
    name); the display name comes from the feature's ``Name`` property.
    """
    doc = spark.read.option("multiLine", True).json(path).withColumn("_file", F.input_file_name())
    feat = F.element_at(F.col("features"), 1)
    base = F.regexp_extract(F.col("_file"), r"([^/]+?)(\.[^./]*)?$", 1)
    name_field = "name" if "name" in doc.columns else None
    track_id = F.coalesce(F.col(name_field), base) if name_field else base
    props = feat.getField("properties")
    has_name = "Name" in _property_names(doc)
    display = F.coalesce(props.getField("Name"), F.lit(UNKNOWN_TRACK)) if has_name else F.lit(UNKNOWN_TRACK)
    return doc.select(
        track_id.alias("track_id"),
        display.alias("name"),
        F.posexplode(feat.getField("geometry").getField("coordinates")).alias("pos", "c"),
    ).select(
        "track_id", "name", F.col("pos").cast("int").alias("pos"),
        F.element_at("c", 1).cast("double").alias("lon"),
        F.element_at("c", 2).cast("double").alias("lat"),
    )


def _property_names(doc: DataFrame) -> list[str]:
    try:
        props = doc.schema["features"].dataType.elementType["properties"].dataType
        return [f.name for f in props.fields]
    except (KeyError, AttributeError):
        return []


def read_archive(spark: SparkSession, path: str, track_id: str | None = None, car_id=None,
                 cars: DataFrame | None = None) -> DataFrame:
    """Stored archive points; a track filter prunes directories, a car filter the car's buckets and,
    pushed to the Parquet reader, row groups by their statistics and Bloom filter.

    ``cars`` is a list of cars as a table (``car_id``): its buckets prune directories when the query runs
    (dynamic partition pruning), so only these buckets are read.  The list is counted: beyond
    ``BROADCAST_CARS`` it joins by shuffle, and then nothing is pruned.
    """
    df = spark.read.parquet(path)
    if track_id is not None:
        df = df.filter(F.col("track_id") == track_id)
    if car_id is not None:
        df = df.filter(F.col("car_id") == car_id)
        if CAR_BUCKET in df.columns:
            df = df.filter(F.col(CAR_BUCKET) == car_bucket(F.lit(car_id)))
    if cars is not None:
        wanted = cars.select(F.col("car_id").cast("long").alias("_car")).distinct().withColumn("_bucket", car_bucket(F.col("_car")))
        # a condition on the list tells the optimizer that it is worth to prune by it
        wanted = wanted.where(F.col("_car") >= F.lit(-(1 << 63)))
        if wanted.count() <= BROADCAST_CARS:
            wanted = F.broadcast(wanted)
        on = F.col("car_id").cast("long") == F.col("_car")
        if CAR_BUCKET in df.columns:
            on = (F.col(CAR_BUCKET) == F.col("_bucket")) & on
        df = df.join(wanted, on, "left_semi")
    return df
