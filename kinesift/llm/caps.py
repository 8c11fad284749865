"""Capping records per dominant contributor, stratum by stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import col, measured
from ..operators.selection import global_rank
from ..session import Durable

#: Up to this cap the ranking keeps the best rows of every task before it shuffles (Spark's window group limit).
SMALL_CAP = 1000
#: Levels of quality that a stratum is counted in where the cap is larger.
LEVELS = 1 << 14
#: Up to so many strata quotas are sent to every task; more are joined with each key dealt out over SALTS parts.
MOST_STRATA, SALTS = 500_000, 32


def stratum_quotas(counts: DataFrame, cap: int, by: str = "proportional") -> DataFrame:
    """Splits each contributor's cap over its strata: ``c, s, n`` -> ``c, s, n, quota``.

    by: ``proportional`` to the strata's rows, or ``equal``. Spare slots of strata with fewer rows than their part go to
    the others: with strata in order of rows per weight, the level at which parts stop growing follows from running sums.
    Fractions are settled by largest remainder, equal remainders by smaller stratum.
    """
    w = F.col("n").cast("double") if by == "proportional" else F.lit(1.0)
    order = Window.partitionBy("c").orderBy((F.col("n") / F.col("w")).asc(), "s")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("c")
    sized = (
        counts.withColumn("w", w)
        .withColumn("total", F.sum("n").over(whole))
        .withColumn("left_n", F.lit(cap) - F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("left_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", F.greatest(F.col("left_n") / F.col("left_w"), F.lit(0.0)))
        .withColumn("full", (F.col("total") <= cap) | (F.col("n") <= F.col("w") * F.col("level")))
    )
    # strata up to the last full one get all their rows; the level after that one holds for the rest
    level = F.min(F.when(~F.col("full"), F.struct(F.col("n") / F.col("w"), "s", "level"))).over(whole)["level"]
    part = F.when(F.col("full"), F.col("n").cast("double")).otherwise(F.least(F.col("n").cast("double"), F.col("w") * level))
    parts = sized.withColumn("part", part).withColumn("base", F.floor(F.col("part") + 1e-9))
    spare = F.least(F.lit(cap), F.col("total")) - F.sum("base").over(whole)
    rank = F.row_number().over(Window.partitionBy("c").orderBy((F.col("part") - F.col("base")).desc(), "s"))
    return parts.withColumn("spare", spare).withColumn("quota", F.col("base") + F.when((rank <= F.col("spare")) & (F.col("base") < F.col("n")), 1).otherwise(0)).select("c", "s", "n", "quota")


def _rank_large(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """Rows within their quota where quotas are large: levels of quality are counted first, whole levels above the cut are
    kept without ranking, and only the one level that the cut falls into is ranked: all those levels in one total order, cut
    into ranges of rows, so that a level of any size, one of equal qualities too, is spread over tasks.
    """
    span = rows.groupBy("c", "s").agg(F.min("q").alias("lo"), F.max("q").alias("hi"))
    level = F.when(F.col("q").isNull(), -1).otherwise(F.when(F.col("hi") > F.col("lo"), F.floor((F.col("q") - F.col("lo")) / (F.col("hi") - F.col("lo")) * (LEVELS - 1))).otherwise(0))
    leveled = rows.join(span, ["c", "s"]).withColumn("lv", level.cast("int"))
    above = Window.partitionBy("c", "s").orderBy(F.desc("lv")).rowsBetween(Window.unboundedPreceding, -1)
    counts = leveled.groupBy("c", "s", "lv").agg(F.count(F.lit(1)).alias("m")).withColumn("ahead", F.coalesce(F.sum("m").over(above), F.lit(0)))
    cut = counts.join(quotas, ["c", "s"]).filter(F.col("ahead") < F.col("quota")).withColumn("open", F.least("m", F.col("quota") - F.col("ahead")))
    took = leveled.join(cut, ["c", "s", "lv"])
    placed = global_rank(took.filter("open < m"), [F.col("c"), F.col("s"), F.col("lv"), F.desc_nulls_last("q"), F.col("id")], "at")
    first = placed.groupBy("c", "s", "lv").agg(F.min("at").alias("first"))
    exact = placed.join(first, ["c", "s", "lv"]).filter("at - first < open")
    return took.filter("open = m").select("id", "c", "s", "quota").unionByName(exact.select("id", "c", "s", "quota"))


def _with_quotas(rows: DataFrame, quotas: DataFrame, few: bool) -> DataFrame:
    """Rows with the quota of their stratum; the rows of a stratum, which may be most of all, are never brought together."""
    if few:
        return rows.join(F.broadcast(quotas), ["c", "s"])
    dealt = quotas.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.hash("id"), F.lit(SALTS))).join(dealt, ["c", "s", "salt"]).drop("salt")


def key_of(columns: list[str | Column]) -> Column:
    """One string for several columns; NULL is a value of its own."""
    return F.to_json(F.array(*[F.coalesce(col(x).cast("string"), F.lit("\0")) for x in columns])) if columns else F.lit("")


def stratified_cap(records: DataFrame, contributor: list[str | Column], record: str, quality: str, cap: int | None = None, share: float | None = None, strata: list[str | Column] | None = None, by: str = "proportional") -> DataFrame:
    """Marks which records of each contributor stay: no more than ``cap``, or than ``share`` of all records.

    The cap is split over the contributor's strata (topics, periods; none: one stratum) by ``stratum_quotas``; inside a
    stratum records rank by quality, highest first, unmeasured last, equal ones by smaller record id.

    ``record`` is the unique id of a row. Returns the id, ``contributor_key``, ``stratum_key``, ``quota`` and ``kept``, one
    row a record. NULL parts of a contributor or stratum form a key of their own; rows without an id are left out; repeated
    ids count once, with their highest quality. A cap of 0 keeps nothing. An empty table gives an empty result. Caps up to
    SMALL_CAP and larger ones are ranked by other plans with the same rows. Records are written, and strata counted, while the
    result is being put together.
    """
    if (cap is None) == (share is None):
        raise ValueError("give either cap or share")
    rows = (
        records.filter(F.col(record).isNotNull())
        .select(F.col(record).alias("id"), key_of(contributor).alias("c"), key_of(strata or []).alias("s"), measured(quality).alias("q"))
        .groupBy("id")
        .agg(F.min("c").alias("c"), F.min("s").alias("s"), F.max("q").alias("q"))
    )
    tables = Durable(records.sparkSession)
    rows = tables.keep(rows)  # counted, ranked and joined below, but made once
    if cap is None:
        cap = int(rows.count() * share)
    quotas = tables.keep(stratum_quotas(rows.groupBy("c", "s").agg(F.count(F.lit(1)).alias("n")), cap, by).select("c", "s", "quota"))
    few = quotas.limit(MOST_STRATA + 1).count() <= MOST_STRATA
    if cap <= SMALL_CAP:
        best = Window.partitionBy("c", "s").orderBy(F.desc_nulls_last("q"), "id")
        first = rows.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= F.lit(max(cap, 1)))
        kept = _with_quotas(first, quotas, few).filter(F.col("r") <= F.col("quota")).select("id")
    else:
        kept = _rank_large(rows, quotas).select("id")
    kept = kept.withColumn("k", F.lit(True))
    return _with_quotas(rows, quotas, few).join(kept, "id", "left").select(F.col("id").alias(record), F.col("c").alias("contributor_key"), F.col("s").alias("stratum_key"), F.col("quota").cast("bigint").alias("quota"), F.coalesce("k", F.lit(False)).alias("kept"))
