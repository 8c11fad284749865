"""Rules as data: ordered reasons, gates, flags, ramps, scores, funnels and agreement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import all_failures, clause, first_failure, measured, ramp, require_columns
from ..functions.parse import raster
from . import rule_tables as tables

Clause = tuple[str, str, float, str]


def first_reason(df: DataFrame, reasons: Sequence[tuple[Column, str]], name: str = "reason", passed: str = "eligible") -> DataFrame:
    """The label of the first condition that holds, in order; NULL conditions don't hold."""
    first = F.coalesce(*[F.when(c, F.lit(label)) for c, label in reasons])
    return df.withColumn(name, first).withColumn(passed, F.col(name).isNull())


def conform(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Exactly ``columns`` (name -> type) in their order; those that ``df`` doesn't have are NULL."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def population(inventory: DataFrame) -> DataFrame:
    """Every file with its eligibility: the columns of ``rule_tables.POPULATION``, ``ineligible_reason`` NULL where eligible.

    Of eight reasons the first that holds counts. Drift is that of frame count over rate against the video's duration, or the
    observed one where that is missing; a file without a frame count can't be checked and fails. Unmeasured rates and
    durations fail as well; NULL flags are FALSE. Columns the inventory lacks count as NULL.
    """
    needs = {"all_modalities_present": "boolean", "video_stream_present": "boolean", "probe_status": "string", "video_width": "int", "video_height": "int", "video_r_fps": "double", "video_nb_frames": "double", "video_duration_s": "double", "observed_duration_s": "double"}
    i = conform(inventory, needs | {c: t for c, t in tables.POPULATION.items() if c not in needs})
    size = raster("video_width", "video_height")
    fps, n, seconds = measured("video_r_fps"), measured("video_nb_frames"), measured("observed_duration_s")
    drift = F.abs(F.try_divide(n, fps) - F.coalesce(measured("video_duration_s"), seconds))
    holds = (
        ~F.coalesce("all_modalities_present", F.lit(False)),
        ~F.coalesce("video_stream_present", F.lit(False)),
        ~F.col("probe_status").eqNullSafe(F.lit("ok")),
        size.isin(*tables.EXCLUDED_RASTERS),
        F.coalesce(~fps.between(*tables.FRAME_RATES), F.lit(True)),
        n.isNull() | (drift > tables.MOST_DRIFT_S),
        F.col("interaction_type").isin(*tables.EXCLUDED_INTERACTIONS),
        F.coalesce(seconds < tables.LEAST_DURATION_S, F.lit(True)),
    )
    judged = first_reason(i, list(zip(holds, tables.REASONS, strict=True)), "ineligible_reason")
    return conform(judged.withColumns({"raster": size, "nominal_fps": fps}), tables.POPULATION)


def apply_clauses(df: DataFrame, clauses: Sequence[Clause], status: str | None = None) -> DataFrame:
    """``fail_reason`` (first failing clause, or "unmeasurable" where ``status`` isn't "ok") and ``qualifies``."""
    require_columns(df, {c for c, *_ in clauses})
    reason = first_failure(clauses)
    if status:
        reason = F.when(~F.col(status).eqNullSafe(F.lit("ok")), F.lit(tables.UNMEASURABLE)).otherwise(reason)
    return df.withColumn("fail_reason", reason).withColumn("qualifies", F.col("fail_reason").isNull())


def gate(windows: DataFrame, status: str = "gesture_status") -> DataFrame:
    """Windows with ``fail_reason`` and ``qualifies`` by the 18 gates, first failure first."""
    return apply_clauses(windows, tables.GATES, status)


def qualify(clips: DataFrame) -> DataFrame:
    """Clips with ``articulation_ratio``, ``gesture_quality``, every failing disqualifier and the first one.

    All measures have to be there: a KeyError lists the missing ones. Where one isn't measured, its clause fails, and so does
    the score. A ratio or score that the clips have already is used as it is.
    """
    own = {"articulation_ratio", "gesture_quality"}
    require_columns(clips, {c for c, *_ in (*tables.DISQUALIFIERS, *tables.RAMPS.values())} - own | ({"torso_travel_mm_s_p50", "arm_speed_p50_mm_s"} if "articulation_ratio" not in clips.columns else set()))
    if "articulation_ratio" not in clips.columns:
        clips = clips.withColumn("articulation_ratio", ratio_floored("arm_speed_p50_mm_s", "torso_travel_mm_s_p50"))
    if "gesture_quality" not in clips.columns:
        clips = clips.withColumn("gesture_quality", weighted_quality(tables.RAMPS, tables.DIMENSIONS, tables.WEIGHTS))
    return flag_clauses(clips, tables.DISQUALIFIERS)


def precision_estimate(resolved: DataFrame) -> DataFrame:
    """``reviewed, accepted, estimate, low, high``: share of items accepted by people (source not beginning with "model") and its Wilson interval."""
    human = resolved.filter(~F.coalesce(F.col("verdict_source"), F.lit("")).startswith("model"))
    n = human.agg(F.count(F.lit(1)).alias("reviewed"), F.count_if(F.col("verdict") == "accept").alias("accepted"))
    lo, hi = wilson("accepted", "reviewed")
    return n.select("reviewed", "accepted", F.try_divide("accepted", "reviewed").alias("estimate"), lo.alias("low"), hi.alias("high"))


def flag_clauses(df: DataFrame, clauses: Sequence[Clause]) -> DataFrame:
    """``exclusion_flags`` (every failing label, joined), ``fail_stage`` (the first, '' for none) and ``qualified``."""
    require_columns(df, {c for c, *_ in clauses})
    return df.withColumn("exclusion_flags", all_failures(clauses)).withColumn("fail_stage", F.coalesce(first_failure(clauses), F.lit(""))).withColumn("qualified", F.col("fail_stage") == "")


def funnel(df: DataFrame, column: str, labels: Sequence[str], passed: str = "qualifies") -> DataFrame:
    """``position, stage, n, share`` of every label in order, those at zero too, and of rows that passed (NULL or '')."""
    spark = df.sparkSession
    stages = spark.createDataFrame([(k, s) for k, s in enumerate([*labels, passed])], "position int, stage string")
    counts = df.groupBy(F.when(F.col(column).isNull() | (F.col(column) == ""), F.lit(passed)).otherwise(F.col(column)).alias("stage")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    out = stages.join(counts, "stage", "left").crossJoin(F.broadcast(total))  # one row
    return out.select("position", "stage", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(F.try_divide(F.coalesce("n", F.lit(0)), "t"), F.lit(0.0)).alias("share"))


def ratio_floored(top: str, bottom: str, floor: float = 1.0) -> Column:
    """``top / bottom`` with the bottom no smaller than ``floor``; NULL where either isn't measured."""
    t, b = measured(top), measured(bottom)
    return t / F.when(b < floor, F.lit(floor)).otherwise(b)


def weighted_quality(ramps: Mapping[str, tuple[str, float, float]], dimensions: Mapping[str, Sequence[str]], weights: Mapping[str, float]) -> Column:
    """Weighted mean of dimensions, each the plain mean of its ramps; NULL as soon as one ramp isn't measured."""
    total = F.lit(0.0)
    for d, parts in dimensions.items():
        s = F.lit(0.0)
        for p in parts:
            c, lo, hi = ramps[p]
            s = s + ramp(c, lo, hi)
        total = total + s / len(parts) * weights[d]
    return total / sum(weights.values())


def additive_score(parts: Sequence[tuple[str, float, float]]) -> Column:
    """Sum of ``weight * clip(column / scale, 0, 1)``; 0 as soon as one part isn't measured."""
    total = F.lit(0.0)
    for c, scale, weight in parts:
        total = total + ramp(c, 0.0, scale) * weight
    return F.coalesce(total, F.lit(0.0))


def confusion(df: DataFrame, gold: Column, predicted: Column, groups: Sequence[tuple[str, Column]]) -> DataFrame:
    """Confusion counts and rates of a decision against labels, per group of rows; a row may belong to several groups."""
    member = F.explode(F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(g)) for g, c in groups]), lambda x: x.isNotNull()))
    rows = df.select(member.alias("label_group"), gold.alias("g"), F.coalesce(predicted, F.lit(False)).alias("p"))
    c = rows.groupBy("label_group").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("g") & F.col("p")).alias("true_accept"),
        F.count_if(~F.col("g") & F.col("p")).alias("false_accept"),
        F.count_if(F.col("g") & ~F.col("p")).alias("false_reject"),
        F.count_if(~F.col("g") & ~F.col("p")).alias("true_reject"),
    )

    def rate(top: Column, bottom: Column) -> Column:
        return F.round(top / F.greatest(F.lit(1), bottom), 6)

    ta, fa, fr, tr = (F.col(x) for x in ("true_accept", "false_accept", "false_reject", "true_reject"))
    return c.withColumns({"precision": rate(ta, ta + fa), "recall": rate(ta, ta + fr), "specificity": rate(tr, tr + fa), "accuracy": rate(ta + tr, F.col("n"))})


def wilson(k: str | Column, n: str | Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson interval of k of n; (0, 1) where n is 0."""
    k, n = (F.col(x).cast("double") if isinstance(x, str) else x.cast("double") for x in (k, n))
    p, d = F.try_divide(k, n), 1 + F.try_divide(F.lit(z * z), n)
    mid, half = (p + F.try_divide(F.lit(z * z / 2), n)) / d, z * F.sqrt(F.try_divide(p * (1 - p), n) + F.try_divide(F.lit(z * z / 4), n * n)) / d
    return F.coalesce(F.greatest(F.lit(0.0), mid - half), F.lit(0.0)), F.coalesce(F.least(F.lit(1.0), mid + half), F.lit(1.0))


def passes(c: Clause) -> Column:
    return clause(c[0], c[1], c[2])
