"""Overlapping sliding windows over series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sliding_windows(frames: str | Column, width: int, hop: int) -> Column:
    """Starts of the windows that fit ``frames`` positions whole; the tail is dropped."""
    n = F.col(frames) if isinstance(frames, str) else frames
    return F.when(n >= width, F.sequence(F.lit(0).cast("bigint"), (n - width).cast("bigint"), F.lit(hop).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))


def to_windows(df: DataFrame, key: str, order: str, width: int, hop: int) -> DataFrame:
    """Every row once for each window that holds it, with ``window_index``; windows that don't fit their series are left out.

    The indices follow from the position alone, so this is an explode, not a range join.
    """
    o = F.col(order).cast("bigint")
    first = F.greatest(F.lit(0).cast("bigint"), F.floor((o - width) / F.lit(hop)) + 1)
    each = df.filter(F.col(key).isNotNull() & (o >= 0)).withColumn("window_index", F.explode(F.sequence(first, F.floor(o / F.lit(hop)))))
    spans = df.groupBy(key).agg((F.max(o) + 1).alias("_k_frames"))
    fits = spans.select(F.col(key), F.explode(sliding_windows("_k_frames", width, hop)).alias("_k_start")).select(key, F.floor(F.col("_k_start") / F.lit(hop)).alias("window_index"))
    return each.join(fits, [key, "window_index"], "left_semi")
