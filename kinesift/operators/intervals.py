"""Intervals per entity: continuous periods and gaps by a sweep over boundary events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import measured, rint
from ..session import Durable

#: Positions of one sweep block. After events at equal positions are added up, a block holds no more rows than this.
BLOCK = 1 << 16


def merge_intervals(df: DataFrame, entity: str, start: str, end: str, block: int = BLOCK) -> DataFrame:
    """Continuous periods and the gaps between neighbouring periods of every entity.

    Sweep line: every range gives +1 at its start and -1 at its end, equal positions are added up, a prefix sum gives
    the number of open ranges; where it leaves 0 a period starts, where it falls back to 0 the period ends and a gap
    begins if another period follows. Ranges are half-open whole numbers, so touching ranges form one period.

    The prefix sum runs in blocks of positions: sums of blocks are carried into the next ones, so an entity with a
    large part of all rows is spread over many tasks, and a task never sees more than ``block`` rows of an entity.

    Returns ``entity, is_gap BOOLEAN, start_pos, end_pos BIGINT``.
    NULL entity, start or end, or an end not after the start: the range says nothing. Repeated and nested ranges
    change nothing. An empty table gives an empty result. Other columns are ignored.
    """
    e, p, d, b = "entity", "pos", "delta", "block"
    s, t = F.col(start).cast("bigint"), F.col(end).cast("bigint")
    events = (
        df.select(F.col(entity).alias(e), s.alias("s"), t.alias("t"))
        .filter(F.col(e).isNotNull() & (F.col("t") > F.col("s")))
        .select(e, F.explode(F.array(F.struct(F.col("s").alias(p), F.lit(1).alias(d)), F.struct(F.col("t").alias(p), F.lit(-1).alias(d)))).alias("x"))
        .groupBy(e, F.col("x.pos").alias(p))
        .agg(F.sum("x.delta").alias(d))
        .filter(F.col(d) != 0)
        .withColumn(b, F.floor(F.col(p) / F.lit(block)))
    )
    before = Window.partitionBy(e).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = events.groupBy(e, b).agg(F.sum(d).alias("bd")).select(e, b, F.coalesce(F.sum("bd").over(before), F.lit(0)).alias("carry"))
    inside = Window.partitionBy(e, b).orderBy(p)
    swept = (
        events.join(carry, [e, b])
        .withColumn("after", F.col("carry") + F.sum(d).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("before", F.col("after") - F.col(d))
        .filter((F.col("before") == 0) != (F.col("after") == 0))
        .select(e, b, p, (F.col("after") == 0).alias("is_gap"), F.lead(p).over(inside).alias("next"), F.row_number().over(inside).alias("k"))
    )
    swept = Durable(df.sparkSession).keep(swept)  # boundaries only; read twice below, so that ranges are read once
    # The last boundary of a block continues at the first one of a later block: at most two rows a block meet here.
    whole = Window.partitionBy(e).orderBy(p)
    edges = (
        swept.filter((F.col("k") == 1) | F.col("next").isNull())
        .withColumn("edge", F.lead(p).over(whole))
        .filter(F.col("next").isNull() & F.col("edge").isNotNull())
        .select(e, "is_gap", F.col(p).alias("start_pos"), F.col("edge").alias("end_pos"))
    )
    inner = swept.filter(F.col("next").isNotNull()).select(e, "is_gap", F.col(p).alias("start_pos"), F.col("next").alias("end_pos"))
    return inner.unionByName(edges)


def clip_ranges(clips: DataFrame) -> DataFrame:
    """Frame ranges of accepted clips by file."""
    return clips.select(F.col("file_id").alias("entity"), rint(measured("start_frame")).alias("s"), rint(measured("end_frame")).alias("t"))


def speech_ranges(speech: DataFrame) -> DataFrame:
    """Speech intervals by clip, in milliseconds from the clip's start. NaN and infinite ends say nothing."""
    return speech.select(F.col("clip_id").alias("entity"), rint(measured("start_s") * 1000).alias("s"), rint(measured("end_s") * 1000).alias("t"))


def coverage(clips: DataFrame, speech: DataFrame) -> DataFrame:
    """Periods and gaps of clips (frames) and of speech (milliseconds): ``entity_id, kind, start_pos, end_pos``."""

    def named(ranges: DataFrame, what: str) -> DataFrame:
        kind = F.when(F.col("is_gap"), F.lit(f"{what}_gap")).otherwise(F.lit(f"{what}_period"))
        return merge_intervals(ranges, "entity", "s", "t").select(F.col("entity").alias("entity_id"), kind.alias("kind"), "start_pos", "end_pos")

    return named(clip_ranges(clips), "clip").unionByName(named(speech_ranges(speech), "speech"))
