"""Percentiles of large numeric columns by distributed multi-select over mergeable states."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import measured
from ..session import Durable

#: Rows that a task holds at once; each such fragment proposes a local median for every open range it has rows of.
FRAGMENT_ROWS = 1 << 20
#: Where no more distinct values than this are left of a range, they are put in order at once.
SETTLE = 512


def state(rows: DataFrame, keys: list[str], value: str | Column, resolution: float | None = None) -> DataFrame:
    """A mergeable summary of a numeric column: ``keys, v DOUBLE, n BIGINT``, each value with its count.

    resolution: None keeps values as they are, so that percentiles are exact; else values are rounded to its multiples and
    a percentile is off by half of it at most. NULL, NaN and infinite values are left out.
    """
    v = measured(value)
    if resolution:
        v = F.rint(v / resolution) * resolution
    v = F.when(v == 0, F.lit(0.0)).otherwise(v)  # one zero
    return rows.select(*keys, v.alias("v")).filter("v IS NOT NULL").groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of parts (days, partitions) put together into those of the coarser ``keys``."""
    return states.groupBy(*keys, "v").agg(F.sum("n").cast("bigint").alias("n"))


def _local_medians(fragment: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (gid, lo, v) of a partition -> (gid, lo, m, c): the lower median and size of each range in each fragment."""

    def medians(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        g, lo, v = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in range(3))
        order = np.lexsort((v, lo, g))
        g, lo, v = g[order], lo[order], v[order]
        first = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (lo[1:] != lo[:-1])])
        size = np.diff(np.r_[first, len(g)])
        return pa.RecordBatch.from_arrays([pa.array(g[first]), pa.array(lo[first]), pa.array(v[first + (size - 1) // 2]), pa.array(size)], names=["gid", "lo", "m", "c"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in it:
            if b.num_rows:
                held.append(b)
            if sum(x.num_rows for x in held) >= fragment:
                yield medians(held)
                held = []
        if held:
            yield medians(held)

    return run


def select_ranks(values: DataFrame, wanted: DataFrame, tables: Durable, settle: int = SETTLE, fragment: int = FRAGMENT_ROWS) -> DataFrame:
    """``gid, k, answer``: the value at place k (from 0, counting each value n times) of every group of ``values`` (gid, v, n).

    ``wanted`` has ``gid, left`` (distinct values of the group) and ``ks`` (array of places). Multi-select over all groups at
    once. A range of values that holds places is open while it has more than ``settle`` values. In a round every fragment of
    a partition proposes its local median of each open range, the median of those weighted by their sizes is the pivot, and
    values below, at and above it are counted: a place found at the pivot is answered, the side that holds a place stays, a
    side that holds none is discarded. Where less than half of the rows are in open ranges, the small ranges are put in order
    and the rows of the open ones are written anew, so rounds read what is still in question. Ranges of a group are disjoint, so a row is in one of them at most, however many places are sought.
    """
    start = wanted.select("gid", F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"), F.lit(0).cast("bigint").alias("below"), F.col("left").cast("bigint").alias("left"), "ks", F.lit(None).cast("double").alias("answer"))
    ranges, answers = tables.keep(start), []
    live, rows_kept, own = values, None, False
    is_open = F.col("answer").isNull() & (F.col("left") > settle)
    is_small = F.col("answer").isNull() & (F.col("left") <= settle)
    v, p = F.col("v"), F.col("p")

    def within(of: DataFrame, *more: str) -> DataFrame:
        return live.join(of.select("gid", "lo", "hi", *more), "gid").filter((v > F.col("lo")) & (v < F.col("hi")))

    def settled() -> DataFrame:
        """Answers of the ranges that are small enough to be put in order."""
        upto = F.sum("n").over(Window.partitionBy("gid", "lo").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        rest = within(ranges.filter(is_small), "below", "ks").withColumn("upto", F.col("below") + upto)
        return rest.select("gid", F.explode(F.expr("filter(ks, k -> k < upto AND k >= upto - n)")).alias("k"), v.alias("answer"))

    while True:
        now = ranges.agg(F.count_if(is_open).alias("n"), F.coalesce(F.sum(F.when(is_open, F.col("left"))), F.lit(0)).alias("rows"), F.coalesce(F.sum("left"), F.lit(0)).alias("all")).head()
        if not now.n:
            break
        if now.rows * 2 < (now.all if rows_kept is None else rows_kept):
            answers.append(tables.keep(settled()))
            old, was = live, own
            live, own = tables.keep(within(ranges.filter(is_open)).select("gid", "v", "n")), True
            if was:
                tables.drop(old)
            ranges, rows_kept = ranges.filter(~is_small), now.rows
        elif rows_kept is None:
            rows_kept = now.all
        seek = ranges.filter(is_open)
        proposed = within(seek).select("gid", "lo", "v").mapInArrow(_local_medians(fragment), "gid bigint, lo double, m double, c bigint")
        by = Window.partitionBy("gid", "lo")
        run = F.sum("c").over(by.orderBy("m").rowsBetween(Window.unboundedPreceding, 0))
        weighed = proposed.withColumn("upto", run).withColumn("whole", F.sum("c").over(by))
        pivots = tables.keep(seek.join(weighed.filter(F.col("upto") * 2 >= F.col("whole")).groupBy("gid", "lo").agg(F.min("m").alias("p")), ["gid", "lo"]))
        three = within(pivots, "p").groupBy("gid", "lo").agg(F.sum(F.when(v < p, F.col("n")).otherwise(0)).alias("lt"), F.sum(F.when(v == p, F.col("n")).otherwise(0)).alias("eq"), F.count_if(v < p).alias("c_lt"), F.count_if(v > p).alias("c_gt"))
        cut = pivots.join(three, ["gid", "lo"]).withColumns({"from_": F.col("below") + F.col("lt"), "to_": F.col("below") + F.col("lt") + F.col("eq")})
        empty, null = F.lit(0).cast("bigint"), F.lit(None).cast("double")
        sides = F.array(
            F.struct(F.col("lo").alias("lo"), p.alias("hi"), F.col("below").alias("below"), F.col("c_lt").alias("left"), F.expr("filter(ks, k -> k < from_)").alias("ks"), null.alias("answer")),
            F.struct(F.col("lo").alias("lo"), F.col("hi").alias("hi"), F.col("below").alias("below"), empty.alias("left"), F.expr("filter(ks, k -> k >= from_ AND k < to_)").alias("ks"), p.alias("answer")),
            F.struct(p.alias("lo"), F.col("hi").alias("hi"), F.col("to_").alias("below"), F.col("c_gt").alias("left"), F.expr("filter(ks, k -> k >= to_)").alias("ks"), null.alias("answer")),
        )
        made = cut.select("gid", F.explode(sides).alias("x")).select("gid", "x.*").filter(F.size("ks") > 0)
        ranges = tables.keep(ranges.filter(~is_open).unionByName(made))
        tables.drop(pivots)

    out = ranges.filter("answer IS NOT NULL").select("gid", F.explode("ks").alias("k"), "answer").unionByName(settled())
    for more in answers:
        out = out.unionByName(more)
    return out


def percentiles(states: DataFrame, keys: list[str], probs: list[float], settle: int = SETTLE, fragment: int = FRAGMENT_ROWS) -> DataFrame:
    """Percentiles of every group of ``states`` (keys, v, n), linear between neighbouring values, exact over the states.

    The two places that a percentile lies between are sought by ``select_ranks``, all groups and percentiles at once.
    Runs jobs while the result is being put together, as every round depends on the one before.

    Returns ``keys, prob DOUBLE, percentile DOUBLE, n_values BIGINT``. Groups without a value don't occur. NULL keys form a
    group. An empty table gives an empty result. Names of key columns may be any but ``v`` and ``n``.
    """
    tables = Durable(states.sparkSession)
    # a NULL key is written out, so that it differs from every text
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in keys]
    named = [F.col(k).alias(f"k_{i}") for i, k in enumerate(keys)]
    keep = (lambda df: df) if hasattr(states, "_kinesift_path") else tables.keep  # a written table needn't be written again
    for seed in range(8):
        values = keep(states.select(F.xxhash64(F.lit(seed), *parts).alias("gid"), *named, "v", "n"))
        whole = F.struct(*[F.coalesce(F.concat(F.lit("="), F.col(f"k_{i}").cast("string")), F.lit("")) for i in range(len(keys))]) if keys else F.lit(0)
        groups = values.groupBy("gid").agg(F.sum("n").cast("bigint").alias("total"), F.count(F.lit(1)).alias("left"), *[F.first(f"k_{i}").alias(f"k_{i}") for i in range(len(keys))], (F.min(whole) != F.max(whole)).alias("clash"))
        groups = tables.keep(groups)
        if not groups.filter("clash").limit(1).count():
            break
    at = F.array(*[F.lit(float(p)) for p in probs])
    places = F.transform(at, lambda q: q * (F.col("total") - 1))
    ks = F.array_distinct(F.concat(F.transform(places, lambda x: F.floor(x)), F.transform(places, lambda x: F.ceil(x))))
    answers = select_ranks(values.select("gid", "v", "n"), groups.select("gid", "left", ks.alias("ks")), tables, settle, fragment)
    found = answers.groupBy("gid").agg(F.map_from_entries(F.collect_list(F.struct("k", "answer"))).alias("of"))  # two places a percentile
    each = groups.join(found, "gid").select(*[F.col(f"k_{i}") for i in range(len(keys))], "total", "of", F.explode(at).alias("prob")).withColumn("x", F.col("prob") * (F.col("total") - 1))
    low, high = F.element_at("of", F.floor("x")), F.element_at("of", F.ceil("x"))
    return each.select(*[F.col(f"k_{i}").alias(k) for i, k in enumerate(keys)], "prob", (low + (F.col("x") - F.floor("x")) * (high - low)).alias("percentile"), F.col("total").alias("n_values"))


MEASURES = ("wrist_height_p75_mm", "arm_speed_speech_p50_mm_s")


def clip_measures(clips: DataFrame) -> DataFrame:
    """``vendor, export_day, measure_name, value``: each clip once, however often it was exported."""
    once = clips.groupBy("clip_id").agg(F.min("vendor").alias("vendor"), F.min("export_day").alias("export_day"), *[F.max(measured(m)).alias(m) for m in MEASURES])
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure_name"), F.col(m).alias("value")) for m in MEASURES]))
    return once.filter("clip_id IS NOT NULL").select("vendor", "export_day", pairs.alias("x")).select("vendor", "export_day", "x.measure_name", "x.value")


def day_states(clips: DataFrame, resolution: float | None = None) -> DataFrame:
    return state(clip_measures(clips), ["vendor", "export_day", "measure_name"], "value", resolution)


def odd_days(clips: DataFrame, least: int = 8) -> DataFrame:
    """Vendor and day whose median lies outside the 10th to 90th percentile of the vendor, with ``least`` measured clips at least.

    Days and vendors are groups of one multi-select, a vendor's state being put together from those of its days.
    """
    tables = Durable(clips.sparkSession)
    day, vendor = ["vendor", "export_day", "measure_name"], ["vendor", "measure_name"]
    days = tables.keep(day_states(clips))
    both = tables.keep(days.withColumn("whole", F.lit(False)).unionByName(merge_states(days, vendor).withColumn("export_day", F.lit(None).cast("string")).withColumn("whole", F.lit(True))))
    p = percentiles(both, ["whole", *day], [0.1, 0.5, 0.9])
    tails = p.filter("whole").groupBy(*vendor).agg(F.max(F.when(F.col("prob") == 0.1, F.col("percentile"))).alias("p10"), F.max(F.when(F.col("prob") == 0.9, F.col("percentile"))).alias("p90"))
    medians = p.filter((~F.col("whole")) & (F.col("prob") == 0.5) & (F.col("n_values") >= least))
    return medians.join(tails, vendor).filter("percentile < p10 OR percentile > p90").select("vendor", "export_day", "measure_name")
