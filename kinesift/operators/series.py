"""Ordered operators over long per-entity series, cut into overlapping blocks so that no entity has to fit a task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.expr import measured
from .intervals import merge_intervals

#: Rows of a block, and of its neighbours that it sees too.
BLOCK, HALO = 4096, 64


class Blocks:
    """Rows of ``df`` by key and block of their place in the ``order`` (whole numbers), each block with ``halo`` rows of its neighbours.

    Window functions over ``w`` that look at rows no further than ``halo`` rows away are right for the block's own rows,
    however far apart their positions are; ``own`` keeps those. Places are counted within blocks of positions first, and
    the rows of the blocks before are added.
    """

    def __init__(self, df: DataFrame, key: str, order: str, halo: int = HALO, block: int = BLOCK) -> None:
        self.columns = df.columns
        rows = df.filter(F.col(key).isNotNull() & F.col(order).isNotNull()).withColumn("_k_p", F.floor(F.col(order) / F.lit(block)))
        by = Window.partitionBy(key).orderBy("_k_p").rowsBetween(Window.unboundedPreceding, -1)
        before = rows.groupBy(key, "_k_p").agg(F.count(F.lit(1)).alias("_k_n")).select(key, "_k_p", F.coalesce(F.sum("_k_n").over(by), F.lit(0)).alias("_k_n"))
        rows = rows.join(before, [key, "_k_p"]).withColumn("_k_r", F.col("_k_n") + F.row_number().over(Window.partitionBy(key, "_k_p").orderBy(order)) - 1)
        r = F.col("_k_r")
        seen = F.sequence(F.floor(F.greatest(r - halo, F.lit(0)) / F.lit(block)), F.floor((r + halo) / F.lit(block)))
        self.rows = rows.withColumn("_k_b", F.explode(seen)).withColumn("_k_own", F.col("_k_b") == F.floor(r / F.lit(block)))
        self.w: WindowSpec = Window.partitionBy(key, "_k_b").orderBy("_k_r")
        self.whole: WindowSpec = Window.partitionBy(key, "_k_b")

    def own(self, **new: Column) -> DataFrame:
        """The own rows with ``new`` columns computed over blocks."""
        return self.rows.withColumns(new).filter("_k_own").select(*[c for c in self.columns if c not in new], *new)


def one_row_a_frame(tracks: DataFrame, key: str = "file_id", order: str = "frame") -> DataFrame:
    """Repeated rows once; of rows that share key and order but differ, the one that sorts first column by column."""
    rest = [c for c in tracks.columns if c not in (key, order)]
    row = tracks.filter(F.col(key).isNotNull() & F.col(order).isNotNull()).groupBy(key, order).agg(F.min(F.struct(*rest)).alias("x"))
    return row.select(key, order, *[F.col(f"x.{c}").alias(c) for c in rest])


def hann_weights(n: int) -> list[float]:
    """Weights of a Hann window of n points without its zero ends, summing to 1."""
    w = [math.sin(math.pi * (k + 1) / (n + 1)) ** 2 for k in range(n)]
    return [x / sum(w) for x in w]


def hann_smooth(df: DataFrame, key: str, order: str, columns: Sequence[str], n: int = 5, suffix: str = "_smooth") -> DataFrame:
    """Zero-phase Hann smoothing over n (odd) rows; ends repeat the first and last value; series of n rows or fewer stay."""
    b = Blocks(df, key, order, halo=max(HALO, n))
    return b.own(**{c + suffix: smoothed(b, c, n) for c in columns})


def smoothed(b: Blocks, c: str, n: int = 5) -> Column:
    """``hann_smooth`` of one column over blocks."""
    x, h, every = F.col(c).cast("double"), n // 2, b.w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = F.first(x).over(every), F.last(x).over(every)
    total = F.lit(0.0)
    for k, w in enumerate(hann_weights(n)):
        total = total + w * (F.coalesce(F.lag(x, h - k).over(b.w), ends[0]) if k < h else x if k == h else F.coalesce(F.lead(x, k - h).over(b.w), ends[1]))
    return F.when(F.count(F.lit(1)).over(b.whole) <= n, x).otherwise(total)


def _norm(parts: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for p in parts:
        total = total + p * p
    return F.sqrt(total)


def central_speed(df: DataFrame, key: str, order: str, axes: Sequence[str], fps: float, h: int = 2, name: str = "speed") -> DataFrame:
    """Speed by central difference over 2h rows; ends repeat the first and last such value; 0 for series of 2h rows or fewer."""
    b = Blocks(df, key, order, halo=max(HALO, 4 * h))
    b.rows = b.rows.withColumn("_k_v", differenced(b, axes, fps, h))
    return b.own(**{name: ends_filled(b, "_k_v", h)})


def differenced(b: Blocks, axes: Sequence[str], fps: float, h: int = 2) -> Column:
    """Speed by central difference over blocks; NULL at the ends, which ``ends_filled`` sets."""
    return _norm([F.lead(F.col(a).cast("double"), h).over(b.w) - F.lag(F.col(a).cast("double"), h).over(b.w) for a in axes]) * (fps / (2.0 * h))


def ends_filled(b: Blocks, c: str, h: int = 2) -> Column:
    """The first or last value within ``h`` rows where there is none, else 0."""
    return F.coalesce(c, F.first(c, ignorenulls=True).over(b.w.rowsBetween(0, h)), F.last(c, ignorenulls=True).over(b.w.rowsBetween(-h, 0)), F.lit(0.0))


def rolling_travel(df: DataFrame, key: str, order: str, axes: Sequence[str], half: int, name: str = "travel") -> DataFrame:
    """Diagonal of the box that a track stays in over ``half`` rows to either side."""
    b = Blocks(df, key, order, halo=max(HALO, half))
    return b.own(**{name: travelled(b, axes, half)})


def travelled(b: Blocks, axes: Sequence[str], half: int) -> Column:
    """``rolling_travel`` over blocks."""
    w = b.w.rowsBetween(-half, half)
    return _norm([F.max(F.col(a).cast("double")).over(w) - F.min(F.col(a).cast("double")).over(w) for a in axes])


def step_cosine(df: DataFrame, key: str, order: str, axes: Sequence[str], min_step: float = 0.01, name: str = "cosine") -> DataFrame:
    """Cosine between the step to a row and the step from it; NULL at ends and where either step is ``min_step`` or shorter."""
    b = Blocks(df, key, order)
    return b.own(**{name: turning(b, axes, min_step)})


def turning(b: Blocks, axes: Sequence[str], min_step: float = 0.01) -> Column:
    """``step_cosine`` over blocks; keeps the steps as columns of the blocks."""
    stem = f"_k_{axes[0]}"
    into = [F.col(a).cast("double") - F.lag(F.col(a).cast("double")).over(b.w) for a in axes]
    out = [F.lead(F.col(a).cast("double")).over(b.w) - F.col(a).cast("double") for a in axes]
    b.rows = b.rows.withColumns({f"{stem}_i{k}": x for k, x in enumerate(into)} | {f"{stem}_o{k}": x for k, x in enumerate(out)})
    i, o = [F.col(f"{stem}_i{k}") for k in range(len(axes))], [F.col(f"{stem}_o{k}") for k in range(len(axes))]
    dot = F.lit(0.0)
    for x, y in zip(i, o, strict=True):
        dot = dot + x * y
    return F.when((_norm(i) > min_step) & (_norm(o) > min_step) & (_norm(i) * _norm(o) > 1e-12), F.try_divide(dot, _norm(i) * _norm(o)))


def frozen(df: DataFrame, key: str, order: str, value: str, name: str = "frozen") -> DataFrame:
    """TRUE where an array (or number) equals that of the row before, all of it measured; FALSE in a first row."""
    b = Blocks(df, key, order)
    is_array = df.schema[value].dataType.typeName() == "array"
    sound = ~F.exists(value, lambda x: x.isNull() | F.isnan(x.cast("double"))) if is_array else ~F.isnan(F.col(value).cast("double"))
    return b.own(**{name: F.coalesce((F.col(value) == F.lag(value).over(b.w)) & sound, F.lit(False))})


def forward_fill(df: DataFrame, key: str, order: str, value: str | dict[str, str], name: str = "filled", block: int = BLOCK) -> DataFrame:
    """Last measured value so far; a leading gap takes the first one; 0 where a series has none. ``value`` may be a mapping of
    columns to the names of what they are filled to, all done in one pass.

    The value that enters a block is carried from the blocks before it, so a block is all that a task orders.
    """
    names = value if isinstance(value, dict) else {value: name}
    at = dict(enumerate(names))
    rows = df.withColumns({f"_k_x{i}": measured(c) for i, c in at.items()}).withColumn("_k_b", F.floor(F.col(order) / F.lit(block)))
    when = {i: F.when(F.col(f"_k_x{i}").isNotNull(), F.col(order)) for i in at}
    ends = rows.groupBy(key, "_k_b").agg(*[F.max_by(f"_k_x{i}", when[i]).alias(f"l{i}") for i in at], *[F.min_by(f"_k_x{i}", when[i]).alias(f"f{i}") for i in at])
    by = Window.partitionBy(key).orderBy("_k_b")
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    carried = ends.select(key, "_k_b", *[F.coalesce(F.last(f"l{i}", ignorenulls=True).over(before), F.first(f"f{i}", ignorenulls=True).over(after)).alias(f"_k_in{i}") for i in at])
    w = Window.partitionBy(key, "_k_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(carried, [key, "_k_b"]).withColumns({names[c]: F.coalesce(F.last(f"_k_x{i}", ignorenulls=True).over(w), f"_k_in{i}", F.lit(0.0)) for i, c in at.items()})
    return out.select(*df.columns, *names.values())


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, value: str, name: str, block: int) -> DataFrame:
    """For each left row the ``value`` of the latest right row of its key at or before its time; before the first, the first.

    Both sides meet in one ordered union, cut into blocks of time; the value that enters a block is carried into it.
    Equal times on the right: the largest value counts. NULL keys or times match nothing.
    """
    cols = left.columns
    r = right.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(key, time).agg(F.max(value).alias("_k_v"))
    both = left.withColumn("_k_v", F.lit(None).cast(right.schema[value].dataType)).withColumn("_k_left", F.lit(True)).unionByName(r.withColumn("_k_left", F.lit(False)), allowMissingColumns=True)
    both = both.withColumn("_k_b", F.floor(F.col(time) / F.lit(block)))
    ends = both.groupBy(key, "_k_b").agg(F.max_by("_k_v", F.when(F.col("_k_v").isNotNull(), F.col(time))).alias("last"), F.min_by("_k_v", F.when(F.col("_k_v").isNotNull(), F.col(time))).alias("first"))
    by = Window.partitionBy(key).orderBy("_k_b")
    carried = ends.select(key, "_k_b", F.last("last", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1)).alias("_k_in"), F.first("first", ignorenulls=True).over(by.rowsBetween(0, Window.unboundedFollowing)).alias("_k_next"))
    w = Window.partitionBy(key, "_k_b").orderBy(F.col(time), F.col("_k_left")).rowsBetween(Window.unboundedPreceding, 0)
    filled = both.join(carried, [key, "_k_b"]).withColumn(name, F.coalesce(F.last("_k_v", ignorenulls=True).over(w), "_k_in", "_k_next"))
    return filled.filter("_k_left").select(*cols, name)


def on_screen(left: DataFrame, right: DataFrame, key: str, time: str, value: str, name: str, block: int, most_held: int = 2) -> DataFrame:
    """``asof_join`` with a ``status``: "ok", or "stopped" where a key's left rows go on for more than ``most_held`` rows after
    its last right one (up to so many the last value is held), or where it has no right row. Those have no value."""
    last = right.filter(F.col(time).isNotNull()).groupBy(key).agg(F.max(time).alias("_k_end"))
    beyond = left.join(last, key, "left").withColumn("_k_out", F.col("_k_end").isNull() | (F.col(time) > F.col("_k_end")))
    over = beyond.groupBy(key).agg((F.count_if("_k_out") > most_held).alias("_k_over"))
    held = asof_join(left, right, key, time, value, name, block)
    bad = F.col("_k_end").isNull() | (F.col("_k_over") & (F.col(time) > F.col("_k_end")))
    out = held.join(last, key, "left").join(over, key, "left")
    return out.select(*left.columns, F.when(~bad, F.col(name)).alias(name), F.when(F.coalesce(bad, F.lit(True)), "stopped").otherwise("ok").alias("status"))


def _isles(df: DataFrame, key: str, order: str, mask: Column, block: int) -> DataFrame:
    """Stretches ``k, s, t`` of consecutive positions where ``mask`` holds, cut at the borders of blocks."""
    held = df.filter(mask).select(F.col(key).alias("k"), F.col(order).cast("bigint").alias("o")).filter("k IS NOT NULL AND o IS NOT NULL").distinct()
    w = Window.partitionBy("k", "b").orderBy("o")
    return held.withColumn("b", F.floor(F.col("o") / F.lit(block))).withColumn("g", F.col("o") - F.row_number().over(w)).groupBy("k", "b", "g").agg(F.min("o").alias("s"), (F.max("o") + 1).alias("t"))


def _merged(isles: DataFrame, key: str) -> DataFrame:
    return merge_intervals(isles, "k", "s", "t").filter(~F.col("is_gap")).select(F.col("entity").alias(key), F.col("start_pos").alias("start"), F.col("end_pos").alias("stop"))


def runs(df: DataFrame, key: str, order: str, mask: Column, block: int = BLOCK) -> DataFrame:
    """Half-open stretches ``key, start, stop`` of consecutive positions where ``mask`` holds.

    Islands within blocks first; those that touch a border join by the interval sweep.
    """
    return _merged(_isles(df, key, order, mask, block), key)


def close_open(stretches: DataFrame, key: str, close: int, open_: int) -> DataFrame:
    """Stretches with gaps of up to ``close`` positions bridged, then those shorter than ``open_`` dropped.

    A gap before the first or after the last stretch isn't one between two, and stays.
    """
    wide = stretches.select(F.col(key).alias("k"), F.col("start").alias("s"), (F.col("stop") + close).alias("t"))
    return _merged(wide, key).withColumn("stop", F.col("stop") - close).filter(F.col("stop") - F.col("start") >= open_)


def closed_runs(df: DataFrame, key: str, order: str, mask: Column, close: int, open_: int, block: int = BLOCK) -> DataFrame:
    """``close_open`` of ``runs``, by one sweep: bridging joins what a block border has cut as well."""
    isles = _isles(df, key, order, mask, block).select(F.col("k").alias(key), F.col("s").alias("start"), F.col("t").alias("stop"))
    return close_open(isles, key, close, open_)


def in_stretches(points: DataFrame, stretches: DataFrame, key: str, order: str, name: str, block: int = 512) -> DataFrame:
    """``points`` with a BOOLEAN: does the position lie in one of the key's stretches (which don't overlap)?

    An equi-join on key and block: a block of positions has the list of the stretches that touch it, no longer than the block.
    No range join, no pairs of a key's rows, and points are moved once at most.
    """
    parts = stretches.select(F.col(key).alias("_k_k"), F.struct(F.col("start").alias("s"), F.col("stop").alias("t")).alias("_k_x"), F.explode(F.expr(f"sequence(floor(start / {block}), floor((stop - 1) / {block}))")).alias("_k_p"))
    lists = parts.groupBy("_k_k", "_k_p").agg(F.collect_list("_k_x").alias("_k_l"))
    o = F.col(order)
    at = points.withColumn("_k_b", F.floor(o / F.lit(block)))
    out = at.join(lists, (F.col(key) == F.col("_k_k")) & (F.col("_k_b") == F.col("_k_p")), "left")
    return out.select(*points.columns, F.coalesce(F.exists("_k_l", lambda x: (o >= x["s"]) & (o < x["t"])), F.lit(False)).alias(name))


def speech_mask(points: DataFrame, intervals: DataFrame, key: str, order: str, fps: float, start: str = "start_s", end: str = "end_s", name: str = "in_speech") -> DataFrame:
    """Frames within intervals of seconds, ends rounded half to even to frames; overlapping intervals are one."""
    spans = intervals.select(F.col(key).alias("k"), F.rint(measured(start) * fps).try_cast("bigint").alias("s"), F.rint(measured(end) * fps).try_cast("bigint").alias("t"))
    merged = merge_intervals(spans, "k", "s", "t").filter(~F.col("is_gap")).select(F.col("entity").alias(key), F.col("start_pos").alias("start"), F.col("end_pos").alias("stop"))
    return in_stretches(points, merged, key, order, name)
