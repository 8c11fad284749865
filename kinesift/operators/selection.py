"""Choosing rows: segments that don't overlap, quotas, round robin, seeded samples, global ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import hash_order, measured
from ..session import Durable


def select_disjoint(df: DataFrame, key: str, start: str, stop: str, score: str, tie: Column, most: int) -> DataFrame:
    """Per key the best rows by score that don't overlap a better chosen one, ``most`` at most.

    Greedy by score, as it must be: round after round the best row of each key that overlaps none of the chosen is chosen.
    A round is a minimum, which combines before it shuffles, over rows that are checked against the key's few chosen ranges;
    so no key, however many rows it has and however its ranges overlap, is ever gathered. There are ``most`` rounds at most,
    run while the result is being put together.

    Score NULL, NaN or infinite counts 0; equal scores by ``tie``, then start. Rows with NULL key, start, stop or an empty
    range are left out, repeated rows count once, an empty table gives an empty result. Returns ``key, start, stop, score,
    pick``.
    """
    tables = Durable(df.sparkSession)
    s, t = F.col(start).cast("bigint"), F.col(stop).cast("bigint")
    rows = tables.keep(df.select(F.col(key).alias("k"), (-F.coalesce(measured(score), F.lit(0.0))).alias("nq"), tie.alias("tie"), s.alias("s"), t.alias("t")).filter("k IS NOT NULL AND t > s").distinct())
    chosen = None
    for pick in range(1, most + 1):
        free = rows
        if chosen is not None:
            taken = chosen.groupBy("k").agg(F.collect_list(F.struct("s", "t")).alias("c"))  # fewer than ``most`` ranges
            free = rows.join(taken, "k").filter("NOT exists(c, x -> x.s < t AND s < x.t)")
        best = free.groupBy("k").agg(F.min(F.struct("nq", "tie", "s", "t")).alias("x")).select("k", "x.*", F.lit(pick).alias("pick"))
        new = tables.keep(best)
        chosen = new if chosen is None else chosen.unionByName(new)
        if not new.limit(1).count():
            break
    if chosen is None:
        chosen = rows.limit(0).withColumn("pick", F.lit(0))
    return chosen.select(F.col("k").alias(key), F.col("s").alias("start"), F.col("t").alias("stop"), (-F.col("nq")).alias("score"), "pick")


def within_quota(df: DataFrame, keys: list[str], order: list[Column], most: int, name: str = "rank_in_group") -> DataFrame:
    """The first ``most`` rows of each group, with their rank from 0. Spark keeps the best of every task before it shuffles."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).filter(F.col(name) < most)


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Position from 0 in a total order, without a single-task window: range partitions, their sizes, and a running offset.

    Only the partitions' sizes come to the driver. ``order`` should end in a unique key.
    """
    spark = df.sparkSession
    cols = df.columns
    placed = df.orderBy(*order).withColumn("_k_id", F.monotonically_increasing_id())
    kept = Durable(spark).keep(placed)
    low = F.col("_k_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = kept.groupBy(F.shiftright("_k_id", 33).alias("p")).agg((F.max(low) + 1).alias("n")).orderBy("p").collect()
    offset, at = [], 0
    for r in sizes:
        offset.append((r.p, at))
        at += r.n
    table = spark.createDataFrame(offset, "p bigint, offset bigint")
    return kept.join(F.broadcast(table), F.shiftright("_k_id", 33) == F.col("p")).select(*cols, (F.col("offset") + low).alias(name))


def round_robin(df: DataFrame, group: str, order: list[Column], seed: str, tie: str, most: int) -> DataFrame:
    """Rows in rounds: each group's best, then each group's second, ...; groups in a seeded order. Adds ``review_rank``."""
    ranked = within_quota(df, [group], order, most).withColumn("group_order", hash_order(f"{seed}:group", group))
    return global_rank(ranked, [F.col("rank_in_group"), F.col("group_order"), F.col(tie)], "review_rank").drop("group_order")


def seeded_sample(df: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """The n rows that come first in a shuffle drawn by seed and key; the same ones on every run."""
    return df.withColumn("_k_h", hash_order(seed, key)).orderBy("_k_h", key).limit(n).drop("_k_h")


def seeded_slices(df: DataFrame, key: str, seed: str, sizes: Sequence[int]) -> DataFrame:
    """Slices of a shuffle drawn by seed and key, one after the other and so disjoint: adds ``slice``, from 0; rows beyond the last are left out."""
    ends = [sum(sizes[: k + 1]) for k in range(len(sizes))]
    ranked = global_rank(df, [hash_order(seed, key), F.col(key)], "_k_rank").filter(F.col("_k_rank") < (ends[-1] if ends else 0))
    which = F.coalesce(*[F.when(F.col("_k_rank") < e, F.lit(k)) for k, e in enumerate(ends)], F.lit(-1))
    return ranked.withColumn("slice", which).drop("_k_rank")


def strided(df: DataFrame, order: list[Column], index: int, step: int) -> DataFrame:
    """Every ``step``-th row of a total order, from ``index``."""
    return global_rank(df, order, "_k_rank").filter(F.col("_k_rank") % step == index).drop("_k_rank")


def task_plan(n_rows: int | Column, tasks: int) -> Column:
    """``array<struct<task, start, stop>>``: contiguous parts of n rows, the first ``n % tasks`` of them one longer."""
    n = F.lit(n_rows) if isinstance(n_rows, int) else n_rows
    base, rest = F.floor(n / F.lit(tasks)), n % tasks
    return F.transform(F.sequence(F.lit(0), F.lit(tasks - 1)), lambda k: F.struct(k.alias("task"), (k * base + F.least(k, rest)).cast("bigint").alias("start"), ((k + 1) * base + F.least(k + 1, rest)).cast("bigint").alias("stop")))


def lower_median_row(df: DataFrame, keys: list[str], value: str, tie: str) -> DataFrame:
    """The row at position (n - 1) // 2 of each group by ``value``, then ``tie``. Unmeasured values are left out.

    The median value is an aggregate of value counts that combines before the shuffle; only the rows that share it are put
    in order. NULL keys form groups of their own.
    """
    rows = df.withColumn("_k_v", measured(value)).filter("_k_v IS NOT NULL").withColumns({f"_k_g{i}": F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for i, k in enumerate(keys)})
    g = [f"_k_g{i}" for i in range(len(keys))]
    middle = rows.groupBy(*g).agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY _k_v)").alias("_k_m"), F.count(F.lit(1)).alias("_k_n"))
    at = rows.join(middle, g)
    below = at.groupBy(*g).agg(F.count_if(F.col("_k_v") < F.col("_k_m")).alias("_k_below"))
    ties = at.filter("_k_v = _k_m").join(below, g).withColumn("_k_r", F.row_number().over(Window.partitionBy(*g).orderBy(tie)))
    return ties.filter("_k_below + _k_r - 1 = floor((_k_n - 1) / 2)").select(*df.columns)


def even_picks(spans: DataFrame, key: str, start: str, stop: str, count: int) -> DataFrame:
    """``count`` positions spread evenly over the union of a key's spans: the middles of equal parts of their total length."""
    by = Window.partitionBy(key).orderBy(start, stop)
    n = F.col(stop) - F.col(start)
    cum = spans.filter(n > 0).withColumn("_k_to", F.sum(n).over(by.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_k_all", F.sum(n).over(Window.partitionBy(key)))
    first = F.ceil((F.col("_k_to") - n) * count / F.col("_k_all") - 0.5)
    last = F.ceil(F.col("_k_to") * count / F.col("_k_all") - 0.5) - 1
    each = cum.withColumn("i", F.explode(F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    return each.select(key, F.col("i").cast("int").alias("pick"), F.floor(F.col(start) + (F.col("i") + 0.5) / count * F.col("_k_all") - (F.col("_k_to") - n)).alias("position"))


def end_to_end_picks(total: str | Column, count: int) -> Column:
    """``count`` positions from the first to the last, both included, evenly spaced and rounded half to even."""
    last = F.greatest(F.lit(0), (F.col(total) if isinstance(total, str) else total) - 1)
    if count <= 1:
        return F.array(F.lit(0).cast("bigint"))
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda k: F.rint(k / F.lit(count - 1.0) * last).cast("bigint"))
