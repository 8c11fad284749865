"""A verdict log as a stream: the current verdict of each item, and counts by day, as records arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import instant

SCHEMA = "log_line bigint, review_item_id string, verdict string, reviewer string, recorded_utc string"


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Records of a folder of Parquet files as they are added."""
    return spark.readStream.schema(SCHEMA).parquet(folder)


def current(stream: DataFrame) -> DataFrame:
    """Last write of each item, for update or complete output: one row of state an item, unreadable times first. ``contested``:
    did the item ever get two different verdicts (case and outer spaces don't matter)?"""
    at = F.struct(F.coalesce(instant("recorded_utc"), F.lit("0001-01-01 00:00:00").cast("timestamp")), F.col("log_line"))
    said = F.lower(F.trim("verdict"))
    return stream.filter("review_item_id IS NOT NULL").groupBy("review_item_id").agg(F.max_by(F.struct("verdict", "reviewer"), at).alias("x"), F.count(F.lit(1)).alias("revisions"), F.min(said).alias("lo"), F.max(said).alias("hi")).select("review_item_id", "x.verdict", "x.reviewer", "revisions", F.coalesce(F.col("lo") != F.col("hi"), F.lit(False)).alias("contested"))


def daily(stream: DataFrame, late: str = "2 days") -> DataFrame:
    """Verdicts by day of recording, for append output; records later than ``late`` are dropped and state is let go."""
    t = stream.withColumn("t", instant("recorded_utc")).filter("t IS NOT NULL").withWatermark("t", late)
    return t.groupBy(F.window("t", "1 day").alias("w"), F.lower(F.trim("verdict")).alias("verdict")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("day"), "verdict", "n")
