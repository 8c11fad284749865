"""Queries of rules, selection and agreement over the clip and inventory tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse
from ..functions.expr import clause, hash_order, measured
from ..operators import census, rules, selection
from ..operators import rule_tables as rt
from ..session import table

#: Measures that ``clips_accepted`` doesn't have, made from those it has so that every rule meets values on either side of its
#: limit: stand-ins for the test tables, not definitions. Spark and SQL read the same text.
STAND_INS = {
    "gesture_status": "CASE WHEN window_seconds < 2 THEN 'window_too_short' ELSE 'ok' END",
    "smplh_longest_invalid_s": "(1 - smplh_valid_frac) * window_seconds",
    "kp_conf_p10": "consistency_r - 0.1",
    "implausible_frac": "hand_frozen_frac / 10",
    "speech_segments_covered": "gesture_frac_speech * 0.9",
    "elbow_excursion_p90_mm": "wrist_excursion_p90_mm * 0.45",
    "step_cosine_p50": "consistency_r - 0.4",
    "episode_median_s": "speech_seconds / (episode_count_speech + 1)",
    "torso_travel_mm_s_p50": "arm_speed_speech_p50_mm_s / 3",
    "arm_speed_p50_mm_s": "arm_speed_speech_p50_mm_s * 0.8",
    "hand_artic_p75_rad_s": "sync_r * 2",
}
#: What they and the rules read.
MEASURES = (
    "window_seconds", "smplh_valid_frac", "hand_frozen_frac", "consistency_r", "speech_seconds", "gesture_frac_speech", "episode_count_speech", "wrist_excursion_p90_mm", "gesture_speech_ratio", "posture_spread_mm",
    "wrist_height_p75_mm", "hands_together_frac", "arm_abduction_p75_deg", "sync_r", "arm_speed_speech_p50_mm_s", "wrist_range_mm", "articulation_ratio",
)


def clips(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Accepted clips, each once, as exported first by run, then time. Only ``columns`` are read."""
    t = table(spark, d, "clips_accepted").filter("clip_id IS NOT NULL")
    once = t.groupBy("clip_id").agg(F.min_by(F.struct(*dict.fromkeys(columns)), F.struct("run_id", "written_ts")).alias("x"))
    return once.select("clip_id", "x.*")


def measured_clips(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Clips with all measures that rules need; ``gesture_quality`` is left to be computed."""
    return clips(spark, d, *MEASURES, *columns).withColumns({c: F.expr(e) for c, e in STAND_INS.items()})


def population(spark, d):
    return rules.population(table(spark, d, "inventory"))


def first_match_reason(spark, d):
    return population(spark, d).select("file_id", "raster", F.col("ineligible_reason").alias("reason"), "eligible")


def eligibility_counts(spark, d):
    r = first_match_reason(spark, d)
    return r.groupBy(F.coalesce("reason", F.lit("eligible")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def ordered_gates(spark, d):
    return rules.gate(measured_clips(spark, d)).select("clip_id", "fail_reason", "qualifies")


def gate_funnel_zero_filled(spark, d):
    f = rules.funnel(ordered_gates(spark, d), "fail_reason", [rt.UNMEASURABLE, *(c[3] for c in rt.GATES)])
    return f.select("stage", "n", F.round("share", 6).alias("share"))


def all_flags_concat(spark, d):
    return rules.qualify(measured_clips(spark, d)).select("clip_id", "exclusion_flags", "fail_stage", "qualified")


def qualification_funnel(spark, d):
    f = rules.funnel(all_flags_concat(spark, d), "fail_stage", [c[3] for c in rt.DISQUALIFIERS], "qualified")
    return f.select("stage", "n")


def weighted_quality(spark, d):
    return measured_clips(spark, d).select("clip_id", F.round(rules.weighted_quality(rt.RAMPS, rt.DIMENSIONS, rt.WEIGHTS), 6).alias("quality"))


def additive_clip_score(spark, d):
    return measured_clips(spark, d).select("clip_id", F.round(rules.additive_score(rt.CLIP_SCORE) + 1e-9, 6).alias("score"))


def floored_ratio(spark, d):
    """Arm speed over torso travel, both over whole windows."""
    return measured_clips(spark, d).select("clip_id", F.round(rules.ratio_floored("arm_speed_p50_mm_s", "torso_travel_mm_s_p50"), 6).alias("ratio"))


def qualify_summary(spark, d):
    q = rules.qualify(measured_clips(spark, d, "file_id"))
    ok, quality = F.col("qualified"), measured("gesture_quality")
    return q.agg(
        F.count(F.lit(1)).alias("clips_in"),
        F.count_if(ok).alias("clips_kept"),
        F.round(F.avg(ok.cast("int")), 6).alias("kept_rate"),
        F.round(F.sum("window_seconds") / 3600, 6).alias("hours_in"),
        F.round(F.sum(F.when(ok, F.col("window_seconds"))) / 3600, 6).alias("hours_kept"),
        F.count_distinct(F.when(ok, F.col("file_id"))).alias("files_kept"),
        F.round(F.percentile(F.when(ok, quality), F.lit(0.5)), 6).alias("median_quality"),
    )


def rethreshold(spark, d):
    return clips(spark, d, "gesture_quality", "consistency_r").filter(clause("gesture_quality", ">=", 0.6) & clause("consistency_r", ">=", 0.7)).select("clip_id")


def greedy_overlap_select(spark, d):
    tie = hash_order("cedar", "file_id", "start_frame")
    return selection.select_disjoint(table(spark, d, "clips_accepted"), "file_id", "start_frame", "end_frame", "clip_score", tie, 5).select("file_id", "start", "stop", "pick")


def review_items(spark, d):
    """Clips rolled up to files; a file whose keys aren't all known is left out."""
    keys = ["file_id", "vendor", "label", "split", "session_id", "interaction_id", "interaction_type"]
    c = measured_clips(spark, d, *keys, "start_frame", "end_frame", "clip_score").dropna(subset=keys)
    return c.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_clips"), F.sum("window_seconds").alias("seconds"), F.min("start_frame").alias("first_frame"), F.max("end_frame").alias("last_frame"), F.round(F.avg(measured("clip_score")) + 1e-9, 6).alias("score"), *[F.round(F.avg(measured(m)) + 1e-9, 6).alias(f"mean_{m}") for m in rt.ITEM_MEANS])


def _items(spark, d):
    c = clips(spark, d, "vendor", "file_id", "clip_score").withColumn("participant", F.concat_ws(":", "vendor", parse.file_id_parts("file_id")["participant_id"]))
    return c.groupBy("participant", "file_id").agg(F.round(F.avg(measured("clip_score")), 9).alias("score"))


def file_quota(spark, d):
    order = [F.desc_nulls_last("score"), F.col("file_id")]
    return selection.within_quota(_items(spark, d), ["participant"], order, 6).select("participant", "file_id", F.col("rank_in_group").cast("bigint").alias("rank_in_group"))


def round_robin_rank(spark, d):
    order = [F.desc_nulls_last("score"), F.col("file_id")]
    return selection.round_robin(_items(spark, d), "participant", order, "cedar", "file_id", 6).select("file_id", "review_rank")


def seeded_shuffle_sample(spark, d):
    return selection.seeded_sample(table(spark, d, "documents").select("doc_id"), "doc_id", "alder", 50)


def stride_partition(spark, d):
    return selection.strided(table(spark, d, "inventory").select("file_id"), [F.col("file_id")], 3, 8)


def task_plan_parts(spark, d):
    n = table(spark, d, "inventory").agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.explode(selection.task_plan(F.col("n"), 7)).alias("x")).select("x.task", "x.start", "x.stop")


def lower_median_clip(spark, d):
    return selection.lower_median_row(clips(spark, d, "file_id", "clip_score"), ["file_id"], "clip_score", "clip_id").select("file_id", "clip_id")


def quality_bands(spark, d):
    q = measured("gesture_quality")
    band = F.when(q < 0.5, "low").when(q < 0.7, "middle").when(q >= 0.7, "high").otherwise("unrated")
    return clips(spark, d, "vendor", "gesture_quality").groupBy("vendor", band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


def review_queue(spark, d):
    """Files in order of their seeded shuffle that nobody judged yet, the first 40."""
    items = table(spark, d, "clips_accepted").select("review_item_id", "file_id").distinct()
    judged = table(spark, d, "verdicts").filter(F.lower(F.trim("verdict")) != "unsure").select("review_item_id")
    return selection.seeded_sample(items.join(judged, "review_item_id", "left_anti"), "file_id", "birch", 40)


def agreement_confusion(spark, d):
    """Clip decisions rolled up to items against the last verdict of each item, by kind of reviewer."""
    per_item = rules.qualify(measured_clips(spark, d, "review_item_id")).groupBy("review_item_id").agg(F.bool_or("qualified").alias("qualified"))
    last = census.latest_with_history(table(spark, d, "verdicts"), "review_item_id", parse.instant("recorded_utc"), "log_line", ["verdict", "verdict_source"], "reviewer", "verdict")
    v = last.withColumn("v", F.lower(F.trim("verdict"))).filter("v IN ('accept', 'reject')").join(per_item, "review_item_id")
    src = F.col("verdict_source")
    return rules.confusion(v, F.col("v") == "accept", F.col("qualified"), [("human", src == "human"), ("model", src.startswith("model")), ("all", F.lit(True))])


def precision_estimate(spark, d):
    """How often an item that rules kept is accepted by people."""
    last = census.latest_with_history(table(spark, d, "verdicts"), "review_item_id", parse.instant("recorded_utc"), "log_line", ["verdict", "verdict_source"], "reviewer", "verdict")
    p = rules.precision_estimate(last.withColumn("verdict", F.lower(F.trim("verdict"))))
    return p.select("reviewed", "accepted", *[F.round(c, 6).alias(c) for c in ("estimate", "low", "high")])


def clip_review_ranks(spark, d):
    """Clips of the files that are items, with their item's id and its place in the review."""
    c = clips(spark, d, "file_id", "review_item_id")
    return c.join(round_robin_rank(spark, d), "file_id").select("clip_id", "review_item_id", "review_rank")


def wilson_interval(spark, d):
    g = clips(spark, d, "vendor", "gesture_quality").groupBy("vendor").agg(F.count(F.lit(1)).alias("n"), F.count_if(clause("gesture_quality", ">=", 0.6)).alias("k"))
    lo, hi = rules.wilson("k", "n")
    return g.select("vendor", "k", "n", F.round(lo, 6).alias("low"), F.round(hi, 6).alias("high"))


def quality_quantiles(spark, d):
    q = rules.qualify(measured_clips(spark, d)).withColumn("q", measured("gesture_quality"))
    p = F.percentile("q", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    return q.groupBy("qualified").agg(p.alias("p")).select("qualified", *[F.round(F.col("p")[k], 6).alias(n) for k, n in enumerate(("p10", "p50", "p90"))])


def by_vendor_hours(spark, d):
    return clips(spark, d, "vendor", "label", "file_id", "window_seconds").groupBy("vendor", "label").agg(F.count(F.lit(1)).alias("clips"), F.count_distinct("file_id").alias("files"), F.round(F.sum("window_seconds") / 3600, 6).alias("hours"))


def sample_vs_population(spark, d):
    """Shares of labels in a seeded sample of clips next to those of all clips."""
    c = clips(spark, d, "label")
    s = selection.seeded_sample(c, "clip_id", "alder", 200)
    a = c.groupBy("label").agg(F.count(F.lit(1)).alias("n_all"))
    b = s.groupBy("label").agg(F.count(F.lit(1)).alias("n_sample"))
    return a.join(b, "label", "left").select("label", "n_all", F.coalesce("n_sample", F.lit(0)).alias("n_sample"))


QUERIES = {f.__name__: f for f in (population, first_match_reason, eligibility_counts, ordered_gates, gate_funnel_zero_filled, all_flags_concat, qualification_funnel, weighted_quality, additive_clip_score, floored_ratio, qualify_summary, rethreshold, greedy_overlap_select, review_items, file_quota, round_robin_rank, seeded_shuffle_sample, stride_partition, task_plan_parts, lower_median_clip, quality_bands, review_queue, agreement_confusion, precision_estimate, clip_review_ranks, wilson_interval, quality_quantiles, by_vendor_hours, sample_vs_population)}


# ---- SQL -------------------------------------------------------------------------------------------------------------
def _m(c: str) -> str:
    return f"CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END"


def _ok(c: tuple) -> str:
    return f"coalesce({_m(c[0])} {c[1]} {c[2]!r}, false)"


def _ramp(c: str, lo: float, hi: float) -> str:
    return f"CASE WHEN {_m(c)} IS NOT NULL THEN least(1e0, greatest(0e0, ({_m(c)} - ({lo}e0)) / ({hi - lo}e0))) END"


def _plus(parts: list[str]) -> str:
    return " + ".join(parts)


_CLIPS = "c AS (SELECT * FROM clips_accepted WHERE clip_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY run_id, written_ts) = 1)"
_PART = "regexp_extract(file_id, '_P([A-Za-z0-9]+)$', 1)"
_J = "j AS (SELECT *, " + ", ".join(f"{e} AS {c}" for c, e in STAND_INS.items()) + " FROM c)"
_FAIL = "coalesce(CASE WHEN gesture_status IS DISTINCT FROM 'ok' THEN 'unmeasurable' END, " + ", ".join(f"CASE WHEN NOT {_ok(c)} THEN '{c[3]}' END" for c in rt.GATES) + ")"
_STAGES = ", ".join(f"('{s}')" for s in ("unmeasurable", *(c[3] for c in rt.GATES)))
_QUALITY = "(" + _plus(["(" + _plus([_ramp(*rt.RAMPS[p]) for p in ps]) + f") / {len(ps)} * {rt.WEIGHTS[k]}e0" for k, ps in rt.DIMENSIONS.items()]) + f") / {sum(rt.WEIGHTS.values())}e0"
_Q = f"{_J}, q0 AS (SELECT * EXCLUDE (gesture_quality), {_QUALITY} AS gesture_quality FROM j)"
_FLAGS = "concat_ws(';', " + ", ".join(f"CASE WHEN NOT {_ok(c)} THEN '{c[3]}' END" for c in rt.DISQUALIFIERS) + ")"
_STAGE = "coalesce(" + ", ".join(f"CASE WHEN NOT {_ok(c)} THEN '{c[3]}' END" for c in rt.DISQUALIFIERS) + ", '')"
_STAGES2 = ", ".join(f"('{c[3]}')" for c in rt.DISQUALIFIERS)
_REASON = """r AS (SELECT *, coalesce(CAST(video_width AS VARCHAR), '<NA>') || 'x' || coalesce(CAST(video_height AS VARCHAR), '<NA>') AS raster, CASE WHEN isfinite(video_r_fps) THEN video_r_fps END AS nominal_fps FROM inventory),
p AS (SELECT *, CASE
  WHEN NOT coalesce(all_modalities_present, false) THEN 'incomplete_bundle' WHEN NOT coalesce(video_stream_present, false) THEN 'no_video_stream'
  WHEN probe_status IS DISTINCT FROM 'ok' THEN 'probe_failed' WHEN raster IN ('2160x2160', '1920x1080', '640x480', '3840x2160') THEN 'excluded_raster'
  WHEN NOT coalesce(nominal_fps BETWEEN 20 AND 61, false) THEN 'unusable_frame_rate'
  WHEN video_nb_frames IS NULL OR NOT isfinite(video_nb_frames) OR coalesce(abs(video_nb_frames / nullif(nominal_fps, 0) - CASE WHEN isfinite(observed_duration_s) THEN observed_duration_s END) > 0.5, false) THEN 'timebase_drift'
  WHEN interaction_type = 'charades' THEN 'no_speech_activity' WHEN NOT coalesce(isfinite(observed_duration_s) AND observed_duration_s >= 40, false) THEN 'too_short' END AS reason FROM r)"""
_ITEMS = f"i AS (SELECT vendor || ':' || {_PART} AS participant, file_id, round(avg({_m('clip_score')}), 9) AS score FROM c GROUP BY ALL), q AS (SELECT *, row_number() OVER (PARTITION BY participant ORDER BY score DESC NULLS LAST, file_id) - 1 AS rk FROM i)"

SQL = {
    "first_match_reason": f"WITH {_REASON} SELECT file_id, raster, reason, reason IS NULL AS eligible FROM p",
    "eligibility_counts": f"WITH {_REASON} SELECT coalesce(reason, 'eligible') AS reason, count(*) AS n FROM p GROUP BY 1",
    "population": f"WITH {_REASON} SELECT file_id, vendor, label, split, source_relbase, session_id, participant_id, interaction_id, interaction_type, raster, nominal_fps, observed_duration_s, npz_size_bytes, reason IS NULL AS eligible, reason AS ineligible_reason FROM p",
    "ordered_gates": f"WITH {_CLIPS}, {_J} SELECT clip_id, {_FAIL} AS fail_reason, {_FAIL} IS NULL AS qualifies FROM j",
    "gate_funnel_zero_filled": f"WITH {_CLIPS}, {_J}, f AS (SELECT coalesce({_FAIL}, 'qualifies') AS stage FROM j) SELECT s.stage, count(f.stage) AS n, round(CAST(count(f.stage) AS DOUBLE) / (SELECT count(*) FROM f), 6) AS share FROM (VALUES {_STAGES}, ('qualifies')) s(stage) LEFT JOIN f USING (stage) GROUP BY s.stage",
    "all_flags_concat": f"WITH {_CLIPS}, {_Q} SELECT clip_id, {_FLAGS} AS exclusion_flags, {_STAGE} AS fail_stage, {_STAGE} = '' AS qualified FROM q0",
    "qualification_funnel": f"WITH {_CLIPS}, {_Q}, f AS (SELECT coalesce(nullif({_STAGE}, ''), 'qualified') AS stage FROM q0) SELECT s.stage, count(f.stage) AS n FROM (VALUES {_STAGES2}, ('qualified')) s(stage) LEFT JOIN f USING (stage) GROUP BY s.stage",
    "weighted_quality": f"WITH {_CLIPS}, {_J} SELECT clip_id, round({_QUALITY}, 6) AS quality FROM j",
    "additive_clip_score": f"WITH {_CLIPS}, {_J} SELECT clip_id, round(coalesce({_plus([_ramp(c, 0.0, s) + f' * {w}e0' for c, s, w in rt.CLIP_SCORE])}, 0) + 1e-9, 6) AS score FROM j",
    "floored_ratio": f"WITH {_CLIPS}, {_J} SELECT clip_id, round({_m('arm_speed_p50_mm_s')} / CASE WHEN {_m('torso_travel_mm_s_p50')} < 1 THEN 1 ELSE {_m('torso_travel_mm_s_p50')} END, 6) AS ratio FROM j",
    "qualify_summary": f"""WITH {_CLIPS}, {_Q}, f AS (SELECT *, {_STAGE} = '' AS ok, {_m('gesture_quality')} AS q FROM q0)
SELECT count(*) AS clips_in, count(*) FILTER (WHERE ok) AS clips_kept, round(avg(CAST(ok AS INTEGER)), 6) AS kept_rate, round(sum(window_seconds) / 3600, 6) AS hours_in, round(sum(window_seconds) FILTER (WHERE ok) / 3600, 6) AS hours_kept,
  count(DISTINCT file_id) FILTER (WHERE ok) AS files_kept, round(quantile_cont(q, 0.5) FILTER (WHERE ok), 6) AS median_quality FROM f""",
    "rethreshold": f"WITH {_CLIPS} SELECT clip_id FROM c WHERE {_ok(('gesture_quality', '>=', 0.6))} AND {_ok(('consistency_r', '>=', 0.7))}",
    "greedy_overlap_select": f"""WITH RECURSIVE r0 AS (SELECT DISTINCT file_id, CAST(start_frame AS BIGINT) AS s, CAST(end_frame AS BIGINT) AS t, coalesce({_m('clip_score')}, 0) AS q, sha256('cedar' || chr(31) || file_id || chr(31) || start_frame) AS tie FROM clips_accepted WHERE end_frame > start_frame),
o AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY q DESC, tie, s) AS rn FROM r0),
g AS (SELECT file_id, rn, CASE WHEN rn = 1 THEN [struct_pack(s := s, t := t)] END AS taken FROM o WHERE rn = 1
  UNION ALL SELECT o.file_id, o.rn, CASE WHEN len(g.taken) >= 5 OR len(list_filter(g.taken, lambda a: o.s < a.t AND a.s < o.t)) > 0 THEN g.taken ELSE list_append(g.taken, struct_pack(s := o.s, t := o.t)) END FROM g JOIN o ON o.file_id = g.file_id AND o.rn = g.rn + 1),
e AS (SELECT file_id, arg_max(taken, rn) AS taken FROM g GROUP BY file_id)
SELECT file_id, unnest(taken).s AS start, unnest(taken).t AS stop, CAST(unnest(range(1, len(taken) + 1)) AS INTEGER) AS pick FROM e""",
    "review_items": f"""WITH {_CLIPS}, {_J} SELECT file_id, vendor, label, split, session_id, interaction_id, interaction_type, count(*) AS n_clips, sum(window_seconds) AS seconds, min(start_frame) AS first_frame, max(end_frame) AS last_frame, round(avg({_m('clip_score')}) + 1e-9, 6) AS score,
  {", ".join(f"round(avg({_m(m)}) + 1e-9, 6) AS mean_{m}" for m in rt.ITEM_MEANS)} FROM j
  WHERE file_id IS NOT NULL AND vendor IS NOT NULL AND label IS NOT NULL AND split IS NOT NULL AND session_id IS NOT NULL AND interaction_id IS NOT NULL AND interaction_type IS NOT NULL GROUP BY ALL""",
    "file_quota": f"WITH {_CLIPS}, {_ITEMS} SELECT participant, file_id, rk AS rank_in_group FROM q WHERE rk < 6",
    "round_robin_rank": f"WITH {_CLIPS}, {_ITEMS} SELECT file_id, row_number() OVER (ORDER BY rk, sha256('cedar:group' || chr(31) || participant), file_id) - 1 AS review_rank FROM q WHERE rk < 6",
    "seeded_shuffle_sample": "SELECT doc_id FROM documents ORDER BY sha256('alder' || chr(31) || doc_id), doc_id LIMIT 50",
    "stride_partition": "SELECT file_id FROM inventory QUALIFY (row_number() OVER (ORDER BY file_id) - 1) % 8 = 3",
    "task_plan_parts": "WITH n AS (SELECT count(*) AS n FROM inventory) SELECT CAST(k AS INTEGER) AS task, k * (n // 7) + least(k, n % 7) AS start, (k + 1) * (n // 7) + least(k + 1, n % 7) AS stop FROM n, range(0, 7) r(k)",
    "lower_median_clip": f"WITH {_CLIPS}, q AS (SELECT file_id, clip_id, {_m('clip_score')} AS q FROM c), o AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY q, clip_id) AS r, count(*) OVER (PARTITION BY file_id) AS n FROM q WHERE q IS NOT NULL) SELECT file_id, clip_id FROM o WHERE r - 1 = (n - 1) // 2",
    "quality_bands": f"WITH {_CLIPS}, q AS (SELECT vendor, {_m('gesture_quality')} AS q FROM c) SELECT vendor, CASE WHEN q < 0.5 THEN 'low' WHEN q < 0.7 THEN 'middle' WHEN q >= 0.7 THEN 'high' ELSE 'unrated' END AS band, count(*) AS n FROM q GROUP BY ALL",
    "review_queue": "SELECT DISTINCT review_item_id, file_id, sha256('birch' || chr(31) || file_id) AS h FROM clips_accepted WHERE review_item_id NOT IN (SELECT review_item_id FROM verdicts WHERE lower(trim(verdict)) <> 'unsure' AND review_item_id IS NOT NULL) ORDER BY h LIMIT 40",
    "agreement_confusion": f"""WITH {_CLIPS}, {_Q}, p AS (SELECT review_item_id, bool_or({_STAGE} = '') AS p FROM q0 GROUP BY 1),
v AS (SELECT review_item_id, lower(trim(verdict)) AS v, verdict_source AS s FROM verdicts QUALIFY row_number() OVER (PARTITION BY review_item_id ORDER BY try_cast(recorded_utc AS TIMESTAMPTZ) DESC NULLS LAST, log_line DESC) = 1),
said AS (SELECT v = 'accept' AS g, p, s FROM v JOIN p USING (review_item_id) WHERE v IN ('accept', 'reject')),
x AS (SELECT 'all' AS label_group, g, p FROM said UNION ALL SELECT 'human', g, p FROM said WHERE s = 'human' UNION ALL SELECT 'model', g, p FROM said WHERE starts_with(s, 'model')),
c2 AS (SELECT label_group, count(*) AS n, count(*) FILTER (WHERE g AND p) AS ta, count(*) FILTER (WHERE NOT g AND p) AS fa, count(*) FILTER (WHERE g AND NOT p) AS fr, count(*) FILTER (WHERE NOT g AND NOT p) AS tr FROM x GROUP BY 1)
SELECT label_group, n, ta AS true_accept, fa AS false_accept, fr AS false_reject, tr AS true_reject, round(CAST(ta AS DOUBLE) / greatest(1, ta + fa), 6) AS precision, round(CAST(ta AS DOUBLE) / greatest(1, ta + fr), 6) AS recall,
  round(CAST(tr AS DOUBLE) / greatest(1, tr + fa), 6) AS specificity, round(CAST(ta + tr AS DOUBLE) / greatest(1, n), 6) AS accuracy FROM c2""",
    "precision_estimate": """WITH v AS (SELECT lower(trim(verdict)) AS v, verdict_source AS s FROM verdicts WHERE true QUALIFY row_number() OVER (PARTITION BY review_item_id ORDER BY try_cast(recorded_utc AS TIMESTAMPTZ) DESC NULLS LAST, log_line DESC) = 1),
g AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE v = 'accept') AS DOUBLE) AS k FROM v WHERE NOT starts_with(coalesce(s, ''), 'model')), p AS (SELECT *, k / n AS p, 1.96e0 AS z FROM g)
SELECT CAST(n AS BIGINT) AS reviewed, CAST(k AS BIGINT) AS accepted, round(p, 6) AS estimate, round(greatest(0, (p + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)), 6) AS low,
  round(least(1, (p + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)), 6) AS high FROM p""",
    "clip_review_ranks": f"WITH {_CLIPS}, {_ITEMS}, r AS (SELECT file_id, row_number() OVER (ORDER BY rk, sha256('cedar:group' || chr(31) || participant), file_id) - 1 AS review_rank FROM q WHERE rk < 6) SELECT clip_id, review_item_id, review_rank FROM c JOIN r USING (file_id)",
    "wilson_interval": f"""WITH {_CLIPS}, g AS (SELECT vendor, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE {_ok(('gesture_quality', '>=', 0.6))}) AS DOUBLE) AS k FROM c GROUP BY 1), p AS (SELECT *, k / n AS p, 1.96e0 AS z FROM g)
SELECT vendor, CAST(k AS BIGINT) AS k, CAST(n AS BIGINT) AS n, round(greatest(0, (p + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)), 6) AS low,
  round(least(1, (p + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)), 6) AS high FROM p""",
    "quality_quantiles": f"WITH {_CLIPS}, {_Q}, f AS (SELECT {_STAGE} = '' AS qualified, {_m('gesture_quality')} AS q FROM q0) SELECT qualified, round(quantile_cont(q, 0.1), 6) AS p10, round(quantile_cont(q, 0.5), 6) AS p50, round(quantile_cont(q, 0.9), 6) AS p90 FROM f GROUP BY 1",
    "by_vendor_hours": f"WITH {_CLIPS} SELECT vendor, label, count(*) AS clips, count(DISTINCT file_id) AS files, round(sum(window_seconds) / 3600, 6) AS hours FROM c GROUP BY ALL",
    "sample_vs_population": f"WITH {_CLIPS}, s AS (SELECT * FROM c ORDER BY sha256('alder' || chr(31) || clip_id), clip_id LIMIT 200), a AS (SELECT label, count(*) AS n_all FROM c GROUP BY 1), b AS (SELECT label, count(*) AS n FROM s GROUP BY 1) SELECT label, n_all, coalesce(n, 0) AS n_sample FROM a LEFT JOIN b USING (label)",
}
SQL["review_queue"] = f"WITH x AS ({SQL['review_queue']}) SELECT review_item_id, file_id FROM x"
