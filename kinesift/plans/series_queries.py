"""Queries over per-frame series and sliding windows, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse
from ..functions.expr import measured
from ..operators import geometry, measures, rules, selection, series, windows
from ..operators.rule_tables import GATES
from ..session import Durable, table

W, H = 300, 100
K = ["file_id", "window_index"]


def tracks(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Frames of the files, repeated rows once. Only ``columns`` are read."""
    return series.one_row_a_frame(table(spark, d, "frame_tracks").select("file_id", "frame", *columns))


#: Tracks that ``frame_tracks`` doesn't have, made from its columns (v0: speed, 0 where unmeasured): stand-ins that let every
#: measure meet values, not definitions. Spark and SQL read the same text.
POSE = {
    "arm_travel": "18 + v0 * 0.3 * (1 + sin(frame / 5e0))",
    "arm_speed_2d": "v0 * kp_conf / 300 + abs(sin(frame / 3e0))",
    "hand_speed": "v0 / 500 + abs(cos(frame / 6e0))",
    "torso_speed": "20 + v0 * 0.05 * (1 + cos(frame / 19e0))",
    "box_valid": "kp_conf > 0.3",
    "lw_x": "150 + least(v0, 2000) * 0.06 * sin(frame / 9e0)",
    "lw_y": "-330 + least(v0, 2000) * 0.25 * (1 + cos(frame / 13e0))",
    "lw_z": "180 + 60 * sin(frame / 31e0)",
    "rw_x": "-60 + 70 * cos(frame / 27e0)",
    "rw_y": "-300 + least(v0, 2000) * 0.1 + 40 * cos(frame / 17e0)",
    "rw_z": "170 + 50 * cos(frame / 23e0)",
    "le_x": "220 + least(v0, 2000) * 0.03",
    "le_y": "-250 + 30 * sin(frame / 8e0)",
    "le_z": "40 + 20 * cos(frame / 12e0)",
    "re_x": "-230 - least(v0, 2000) * 0.02",
    "re_y": "-260 + 25 * cos(frame / 10e0)",
    "re_z": "35 + 15 * sin(frame / 21e0)",
    "ls_x": "170e0",
    "ls_y": "0e0",
    "ls_z": "0e0",
    "rs_x": "-170e0",
    "rs_y": "0e0",
    "rs_z": "0e0",
}


def _frames(spark: SparkSession, d: str) -> DataFrame:
    return tracks(spark, d, "arm_speed", "step_cosine", "step_cosine_right", "hand_frozen", "speech", "smplh_valid", "kp_conf")


def _posed(t: DataFrame) -> DataFrame:
    """Frames with stand-in tracks, and whether they are active as they are."""
    t = t.withColumn("v", measured("arm_speed")).withColumn("v0", F.coalesce("v", F.lit(0.0)))
    return t.selectExpr("*", *[f"{e} AS {c}" for c, e in POSE.items()]).withColumn("raw", F.coalesce((F.col("v") > 60.0) & (F.col("arm_travel") > 35.0), F.lit(False)))


def _pose(spark: SparkSession, d: str) -> DataFrame:
    return _posed(_frames(spark, d))


def _measured(spark: SparkSession, d: str, only: tuple[str, ...]) -> DataFrame:
    """Measures of all windows; activity is closed and opened over whole files first."""
    frames = Durable(spark).keep(_frames(spark, d))  # read twice, put in order once
    active = series.closed_runs(_posed(frames), "file_id", "frame", F.col("raw"), 8, 9)
    base = series.in_stretches(frames, active, "file_id", "frame", "active").withColumn("v0", F.coalesce(measured("arm_speed"), F.lit(0.0)))
    return measures.window_measures(base, W, H, only=only, late=POSE)


def _some(spark: SparkSession, d: str, *names: str) -> DataFrame:
    place = ("start_frame", "end_frame", "gesture_status")
    return _rounded(_measured(spark, d, tuple(n for n in names if n not in place)).select(*K, *names), K)


def _track2(spark, d):
    """Two coordinates of a track: confidence, and the share of frozen hands as 0 or 1."""
    return tracks(spark, d, "kp_conf", "hand_frozen").select("file_id", "frame", "kp_conf", F.col("hand_frozen").cast("double").alias("hf"))


def _rounded(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes if c not in keys])


def runs_islands(spark, d):
    return series.runs(table(spark, d, "frame_tracks"), "file_id", "frame", F.col("speech"))


def close_open_mask(spark, d):
    """Activity (speed and travel) with short pauses bridged and short bursts dropped."""
    return series.closed_runs(_pose(spark, d), "file_id", "frame", F.col("raw"), 8, 9)


def closed_mask_frames(spark, d):
    t = table(spark, d, "frame_tracks").select("file_id", "frame").distinct()
    return series.in_stretches(t, close_open_mask(spark, d), "file_id", "frame", "active")


def hann_smooth(spark, d):
    out = series.hann_smooth(tracks(spark, d, "kp_conf"), "file_id", "frame", ["kp_conf"])
    return out.select("file_id", "frame", F.round("kp_conf_smooth", 6).alias("smooth"))


def central_speed(spark, d):
    return series.central_speed(_track2(spark, d), "file_id", "frame", ["kp_conf", "hf"], 30.0).select("file_id", "frame", F.round("speed", 6).alias("speed"))


def rolling_travel(spark, d):
    return series.rolling_travel(_track2(spark, d), "file_id", "frame", ["kp_conf", "hf"], 7).select("file_id", "frame", F.round("travel", 6).alias("travel"))


def step_cosine(spark, d):
    return series.step_cosine(_track2(spark, d), "file_id", "frame", ["kp_conf", "hf"]).select("file_id", "frame", F.round("cosine", 6).alias("cosine"))


def frozen_frames(spark, d):
    return series.frozen(tracks(spark, d, "arm_speed"), "file_id", "frame", "arm_speed").select("file_id", "frame", "frozen")


def forward_fill(spark, d):
    return series.forward_fill(tracks(spark, d, "arm_speed"), "file_id", "frame", "arm_speed").select("file_id", "frame", "filled")


def sliding_windows(spark, d):
    n = table(spark, d, "frame_tracks").groupBy("file_id").agg((F.max("frame") + 1).alias("n"))
    return n.select("file_id", F.explode(windows.sliding_windows("n", W, H)).alias("start")).select("file_id", "start", (F.col("start") + W).alias("stop"))


BASE = (
    "start_frame", "end_frame", "gesture_status", "window_frames", "speech_seconds", "speech_frac", "smplh_valid_frac", "box_valid_frac", "hand_frozen_frac", "kp_conf_p10", "implausible_frac", "consistency_r", "step_cosine_p50", "step_cosine_n",
    "hand_artic_p75_rad_s", "wrist_height_p75_mm", "hands_together_frac", "arm_abduction_p75_deg", "torso_travel_mm_s_p50", "arm_speed_p50_mm_s", "arm_speed_speech_p50_mm_s", "gesture_frac", "gesture_frac_speech", "gesture_frac_silence",
    "gesture_speech_ratio", "gesture_seconds_speech",
)


def window_measures(spark, d):
    return _some(spark, d, *BASE)


def episodes_in_speech(spark, d):
    return _some(spark, d, "episode_count", "episode_count_speech", "episode_median_s")


def segments_covered(spark, d):
    return _some(spark, d, "speech_segment_count", "speech_segments_covered")


def longest_invalid_run(spark, d):
    return _some(spark, d, "smplh_longest_invalid_s")


def excursion_range(spark, d):
    return _some(spark, d, "wrist_excursion_p90_mm", "wrist_range_mm", "elbow_excursion_p90_mm", "elbow_range_mm")


def posture_spread(spark, d):
    return _some(spark, d, "posture_spread_mm")


def sync_xcorr(spark, d):
    return _some(spark, d, "sync_r", "sync_lag_s", "sync_r_zero")


def window_gates(spark, d):
    """Measured windows through all gates."""
    return rules.gate(_measured(spark, d, tuple(c for c, *_ in GATES))).select(*K, "fail_reason", "qualifies")


def speech_mask_intervals(spark, d):
    speech = table(spark, d, "clip_speech")
    frames = speech.select("clip_id").distinct().select("clip_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(1199).cast("bigint"))).alias("frame"))
    return series.speech_mask(frames, speech, "clip_id", "frame", 30.0).groupBy("clip_id").agg(F.count_if("in_speech").alias("speech_frames"))


def interval_overlap_seconds(spark, d):
    """Speech of each clip within seconds 2 to 10, intervals cut and measured from there."""
    n, seconds = parse.overlap_seconds("start_s", "end_s", 2.0, 10.0)
    return table(spark, d, "clip_speech").groupBy("clip_id").agg(n.alias("n_intervals"), F.round(seconds, 6).alias("seconds"))


def asof_hold(spark, d):
    """For every view of a user the value of the user's last purchase at or before it; before the first, the first."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    views = e.filter("event_type = 'view'").select("event_id", "user_id", "t")
    buys = e.filter("event_type = 'purchase'").select("user_id", "t", "value")
    return series.asof_join(views, buys, "user_id", "t", "value", "held", 86_400_000_000).select("event_id", "held")


def frames_on_screen(spark, d):
    """Views of users against their purchases: the value held at each, up to two views after a user's last purchase."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    views, buys = e.filter("event_type = 'view'").select("event_id", "user_id", "t"), e.filter("event_type = 'purchase'").select("user_id", "t", "value")
    return series.on_screen(views, buys, "user_id", "t", "value", "held", 86_400_000_000).select("event_id", "held", "status")


def even_span_picks(spark, d):
    """12 frames spread over the speech stretches of each file."""
    spans = runs_islands(spark, d)
    return selection.even_picks(spans, "file_id", "start", "stop", 12)


def end_to_end_picks(spark, d):
    n = table(spark, d, "frame_tracks").groupBy("file_id").agg((F.max("frame") + 1).alias("n"))
    return n.select("file_id", F.posexplode(selection.end_to_end_picks("n", 12)).alias("slot", "frame"))


def timeline_downsample(spark, d):
    t = tracks(spark, d, "arm_speed").select("file_id", "frame", measured("arm_speed").alias("v"))
    out = geometry.downsampled(t, "file_id", "frame", "v", 40)
    return out.select("file_id", "slot", "at", F.round("level", 6).alias("level"))


def signal_envelope(spark, d):
    t = tracks(spark, d, "arm_speed").select("file_id", "frame", measured("arm_speed").alias("v"))
    return geometry.envelope(t, "file_id", "frame", "v", 50).select("file_id", "bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


def file_rollups(spark, d):
    """Shares and seconds of each file, and how many windows it holds."""
    t = tracks(spark, d, "smplh_valid", "speech")
    g = t.groupBy("file_id").agg(F.count(F.lit(1)).alias("frames"), F.round(F.avg(F.col("smplh_valid").cast("int")), 6).alias("valid_frac"), F.round(F.count_if("speech") / 30.0, 6).alias("speech_seconds"), F.size(windows.sliding_windows(F.max("frame") + 1, W, H)).alias("n_windows"))
    return g


QUERIES = {f.__name__: f for f in (runs_islands, close_open_mask, closed_mask_frames, hann_smooth, central_speed, rolling_travel, step_cosine, frozen_frames, forward_fill, sliding_windows, window_measures, episodes_in_speech, segments_covered, longest_invalid_run, excursion_range, posture_spread, sync_xcorr, window_gates, speech_mask_intervals, interval_overlap_seconds, asof_hold, frames_on_screen, even_span_picks, end_to_end_picks, timeline_downsample, signal_envelope, file_rollups)}

_T = """
t AS (
  SELECT DISTINCT file_id, frame, CASE WHEN isfinite(arm_speed) THEN arm_speed END AS v, CASE WHEN isfinite(step_cosine) THEN step_cosine END AS cl,
         CASE WHEN isfinite(step_cosine_right) THEN step_cosine_right END AS cr, hand_frozen, speech, smplh_valid, kp_conf, CAST(hand_frozen AS INTEGER) AS hf,
         arm_speed
  FROM frame_tracks
), nf AS (SELECT file_id, max(frame) + 1 AS n FROM t GROUP BY 1)
"""
_P = f"""{_T}, pose0 AS (SELECT *, coalesce(v, 0e0) AS v0 FROM t), pose AS (SELECT *, {", ".join(f"{e} AS {c}" for c, e in POSE.items())} FROM pose0),
raw AS (SELECT * FROM pose WHERE v > 60 AND arm_travel > 35)"""
_SPEECH_RUNS = """runs AS (
  SELECT file_id, min(frame) AS start, max(frame) + 1 AS stop FROM (
    SELECT file_id, frame, frame - row_number() OVER (PARTITION BY file_id ORDER BY frame) AS g FROM t WHERE speech) GROUP BY file_id, g
)"""
_CLOSED = """act AS (
  SELECT file_id, min(frame) AS s, max(frame) + 1 AS e FROM (
    SELECT file_id, frame, frame - row_number() OVER (PARTITION BY file_id ORDER BY frame) AS g FROM raw) GROUP BY file_id, g
), marked AS (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY file_id ORDER BY s) <= 8 THEN 0 ELSE 1 END AS new FROM act),
grouped AS (SELECT *, sum(new) OVER (PARTITION BY file_id ORDER BY s) AS k FROM marked),
closed AS (SELECT file_id, min(s) AS start, max(e) AS stop FROM grouped GROUP BY file_id, k HAVING max(e) - min(s) >= 9)
"""


_W = f"""{_P}, {_CLOSED}, framed AS (SELECT pose.*, c.start IS NOT NULL AS act FROM pose LEFT JOIN closed c ON pose.file_id = c.file_id AND pose.frame >= c.start AND pose.frame < c.stop),
w0 AS (
  SELECT *, unnest(range(CAST(greatest(0, floor((frame - {W}) / {H}e0) + 1) AS BIGINT), CAST(frame // {H} + 1 AS BIGINT))) AS window_index FROM framed
), w AS (SELECT w0.* FROM w0 JOIN nf USING (file_id) WHERE window_index * {H} + {W} <= n), wins AS (SELECT DISTINCT file_id, window_index FROM w),
s AS (SELECT *, bool_or(speech) OVER (PARTITION BY file_id, window_index) AS any_ FROM w), fp AS (SELECT * FROM s WHERE speech OR NOT any_)
"""


_ARMS = ("lw", "rw", "le", "re")


def _far(p: str) -> str:
    return "sqrt(" + " + ".join(f"pow({p}_{a} - m_{p}_{a}, 2)" for a in "xyz") + ")"


def _abduction(e: str, s: str) -> str:
    return f"degrees(acos(greatest(-1e0, least(1e0, -({e}_y - {s}_y) / (sqrt(pow({e}_x - {s}_x, 2) + pow({e}_y - {s}_y, 2) + pow({e}_z - {s}_z, 2)) + 1e-9)))))"


def _isles(flag: str) -> str:
    return f"""isles AS (
  SELECT file_id, window_index, count(*) AS n, count(*) FILTER (WHERE speech) AS n_speech, count(*) FILTER (WHERE act) AS n_active FROM (
    SELECT *, frame - row_number() OVER (PARTITION BY file_id, window_index ORDER BY frame) AS g FROM w WHERE {flag}) GROUP BY file_id, window_index, g
)"""


SQL = {
    "runs_islands": f"WITH {_T}, {_SPEECH_RUNS} SELECT file_id, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM runs",
    "close_open_mask": f"WITH {_P}, {_CLOSED} SELECT file_id, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM closed",
    "closed_mask_frames": f"WITH {_P}, {_CLOSED} SELECT t.file_id, t.frame, c.start IS NOT NULL AS active FROM t LEFT JOIN closed c ON t.file_id = c.file_id AND t.frame >= c.start AND t.frame < c.stop",
    "hann_smooth": f"""WITH {_T}, x AS (SELECT *, count(*) OVER (PARTITION BY file_id) AS m, first_value(kp_conf) OVER whole AS a, last_value(kp_conf) OVER whole AS b,
  lag(kp_conf, 2) OVER o AS l2, lag(kp_conf, 1) OVER o AS l1, lead(kp_conf, 1) OVER o AS r1, lead(kp_conf, 2) OVER o AS r2 FROM t
  WINDOW o AS (PARTITION BY file_id ORDER BY frame), whole AS (PARTITION BY file_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT file_id, frame, round(CASE WHEN m <= 5 THEN kp_conf ELSE coalesce(l2, a) / 12 + coalesce(l1, a) / 4 + kp_conf / 3 + coalesce(r1, b) / 4 + coalesce(r2, b) / 12 END, 6) AS smooth FROM x""",
    "central_speed": f"""WITH {_T}, x AS (SELECT file_id, frame, sqrt(pow(lead(kp_conf, 2) OVER o - lag(kp_conf, 2) OVER o, 2) + pow(lead(hf, 2) OVER o - lag(hf, 2) OVER o, 2)) * 7.5e0 AS s FROM t WINDOW o AS (PARTITION BY file_id ORDER BY frame))
SELECT file_id, frame, round(coalesce(s, first_value(s IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), last_value(s IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY frame ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0), 6) AS speed FROM x""",
    "rolling_travel": f"""WITH {_T} SELECT file_id, frame, round(sqrt(pow(max(kp_conf) OVER o - min(kp_conf) OVER o, 2) + pow(max(hf) OVER o - min(hf) OVER o, 2)), 6) AS travel FROM t
WINDOW o AS (PARTITION BY file_id ORDER BY frame ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)""",
    "step_cosine": f"""WITH {_T}, x AS (SELECT file_id, frame, kp_conf - lag(kp_conf) OVER o AS ax, hf - lag(hf) OVER o AS ay, lead(kp_conf) OVER o - kp_conf AS bx, lead(hf) OVER o - hf AS by_ FROM t WINDOW o AS (PARTITION BY file_id ORDER BY frame)),
y AS (SELECT *, sqrt(ax * ax + ay * ay) AS na, sqrt(bx * bx + by_ * by_) AS nb FROM x)
SELECT file_id, frame, round(CASE WHEN na > 0.01e0 AND nb > 0.01e0 AND na * nb > 1e-12 THEN (ax * bx + ay * by_) / (na * nb) END, 6) AS cosine FROM y""",
    "frozen_frames": f"""WITH {_T} SELECT file_id, frame, coalesce(arm_speed = lag(arm_speed) OVER (PARTITION BY file_id ORDER BY frame) AND NOT isnan(arm_speed), false) AS frozen FROM t""",
    "forward_fill": f"""WITH {_T} SELECT file_id, frame, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY frame ROWS UNBOUNDED PRECEDING),
  first_value(v IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS filled FROM t""",
    "sliding_windows": f"WITH {_T} SELECT file_id, unnest(range(0, n - {W} + 1, {H})) AS start, unnest(range(0, n - {W} + 1, {H})) + {W} AS stop FROM nf WHERE n >= {W}",
    "window_measures": f"""WITH {_W}, cos AS (
  SELECT file_id, window_index, count(c) AS step_cosine_n, CASE WHEN count(c) >= 8 THEN median(c) END AS step_cosine_p50
  FROM (SELECT file_id, window_index, cl AS c FROM w UNION ALL SELECT file_id, window_index, cr FROM w) GROUP BY ALL
), post AS (
  SELECT file_id, window_index, quantile_cont(greatest(lw_y, rw_y), 0.75) AS height, avg(CAST(sqrt(pow(lw_x - rw_x, 2) + pow(lw_y - rw_y, 2) + pow(lw_z - rw_z, 2)) < 180 AS INTEGER)) AS together,
    quantile_cont(greatest({_abduction("le", "ls")}, {_abduction("re", "rs")}), 0.75) AS abduction FROM fp GROUP BY ALL
), m AS (
  SELECT file_id, window_index, count(*) AS window_frames, count(*) FILTER (WHERE speech) / 30e0 AS speech_seconds, avg(CAST(speech AS INTEGER)) AS speech_frac, avg(CAST(box_valid AS INTEGER)) AS box_valid_frac,
    avg(CAST(smplh_valid AS INTEGER)) AS smplh_valid_frac, avg(hf) AS hand_frozen_frac, quantile_cont(kp_conf, 0.1) AS kp_conf_p10, avg(CAST(v > 4000 AS INTEGER)) AS implausible_frac,
    CASE WHEN count(v) FILTER (WHERE arm_speed_2d IS NOT NULL) >= 4 AND stddev_pop(v) FILTER (WHERE arm_speed_2d IS NOT NULL) > 1e-12 AND stddev_pop(arm_speed_2d) FILTER (WHERE v IS NOT NULL) > 1e-12
      THEN covar_pop(v, arm_speed_2d) / (stddev_pop(v) FILTER (WHERE arm_speed_2d IS NOT NULL) * stddev_pop(arm_speed_2d) FILTER (WHERE v IS NOT NULL)) END AS consistency_r,
    quantile_cont(v, 0.5) AS arm_speed_p50_mm_s, quantile_cont(v, 0.5) FILTER (WHERE speech) AS arm_speed_speech_p50_mm_s, quantile_cont(hand_speed, 0.75) AS hand_artic, quantile_cont(torso_speed, 0.5) AS torso, avg(CAST(act AS INTEGER)) AS gesture_frac,
    avg(CAST(act AS INTEGER)) FILTER (WHERE speech) AS gs, avg(CAST(act AS INTEGER)) FILTER (WHERE NOT speech) AS gq, count(*) FILTER (WHERE speech AND act) / 30e0 AS gesture_seconds_speech
  FROM w GROUP BY ALL
) SELECT file_id, window_index, window_index * {H} AS start_frame, window_index * {H} + {W} AS end_frame, 'ok' AS gesture_status, CAST(window_frames AS INTEGER) AS window_frames, round(speech_seconds, 6) AS speech_seconds, round(speech_frac, 6) AS speech_frac,
  round(smplh_valid_frac, 6) AS smplh_valid_frac, round(box_valid_frac, 6) AS box_valid_frac, round(hand_frozen_frac, 6) AS hand_frozen_frac, round(kp_conf_p10, 6) AS kp_conf_p10, round(implausible_frac, 6) AS implausible_frac,
  round(consistency_r, 6) AS consistency_r, round(step_cosine_p50, 6) AS step_cosine_p50, CAST(step_cosine_n AS INTEGER) AS step_cosine_n, round(hand_artic, 6) AS hand_artic_p75_rad_s, round(height, 6) AS wrist_height_p75_mm,
  round(together, 6) AS hands_together_frac, round(abduction, 6) AS arm_abduction_p75_deg, round(torso, 6) AS torso_travel_mm_s_p50, round(arm_speed_p50_mm_s, 6) AS arm_speed_p50_mm_s, round(arm_speed_speech_p50_mm_s, 6) AS arm_speed_speech_p50_mm_s,
  round(gesture_frac, 6) AS gesture_frac, round(gs, 6) AS gesture_frac_speech, round(gq, 6) AS gesture_frac_silence, round((gs + 0.02e0) / (gq + 0.02e0), 6) AS gesture_speech_ratio, round(gesture_seconds_speech, 6) AS gesture_seconds_speech
FROM m JOIN cos USING (file_id, window_index) JOIN post USING (file_id, window_index)""",
    "episodes_in_speech": f"""WITH {_W}, {_isles("act")} SELECT wins.file_id, wins.window_index, CAST(count(n) AS INTEGER) AS episode_count, CAST(count(*) FILTER (WHERE n_speech >= 6) AS INTEGER) AS episode_count_speech, round(coalesce(median(n), 0) / 30e0, 6) AS episode_median_s
FROM wins LEFT JOIN isles USING (file_id, window_index) GROUP BY ALL""",
    "segments_covered": f"""WITH {_W}, {_isles("speech")} SELECT wins.file_id, wins.window_index, CAST(count(n) AS INTEGER) AS speech_segment_count, round(avg(CAST(n_active >= 6 AS INTEGER)), 6) AS speech_segments_covered
FROM wins LEFT JOIN (SELECT * FROM isles WHERE n >= 24) i USING (file_id, window_index) GROUP BY ALL""",
    "longest_invalid_run": f"WITH {_W}, {_isles('NOT smplh_valid')} SELECT wins.file_id, wins.window_index, round(coalesce(max(n), 0) / 30e0, 6) AS smplh_longest_invalid_s FROM wins LEFT JOIN isles USING (file_id, window_index) GROUP BY ALL",
    "excursion_range": f"""WITH {_W}, c AS (SELECT file_id, window_index, {", ".join(f"median({p}_{a}) AS m_{p}_{a}" for p in _ARMS for a in "xyz")}, {", ".join("sqrt(" + " + ".join(f"pow(max({p}_{a}) - min({p}_{a}), 2)" for a in "xyz") + f") AS r_{p}" for p in _ARMS)} FROM w GROUP BY ALL)
SELECT file_id, window_index, round(quantile_cont(greatest({_far("lw")}, {_far("rw")}), 0.9), 6) AS wrist_excursion_p90_mm, round(max(greatest(r_lw, r_rw)), 6) AS wrist_range_mm,
  round(quantile_cont(greatest({_far("le")}, {_far("re")}), 0.9), 6) AS elbow_excursion_p90_mm, round(max(greatest(r_le, r_re)), 6) AS elbow_range_mm FROM w JOIN c USING (file_id, window_index) GROUP BY ALL""",
    "posture_spread": f"""WITH {_W}, r AS (SELECT *, row_number() OVER (PARTITION BY file_id, window_index ORDER BY frame) AS r FROM fp), p AS (SELECT * FROM r WHERE (r - 1) % 75 = 0),
d AS (SELECT a.file_id, a.window_index, {", ".join("avg(sqrt(" + " + ".join(f"pow(a.{p}_{x} - b.{p}_{x}, 2)" for x in "xyz") + f")) AS {p}" for p in ("lw", "rw"))} FROM p a JOIN p b ON a.file_id = b.file_id AND a.window_index = b.window_index AND a.r < b.r GROUP BY ALL),
n AS (SELECT file_id, window_index, count(*) AS n FROM p GROUP BY ALL)
SELECT file_id, window_index, round(CASE WHEN n >= 3 THEN greatest(lw, rw) END, 6) AS posture_spread_mm FROM n LEFT JOIN d USING (file_id, window_index)""",
    "sync_xcorr": f"""WITH {_W}, b AS (
  SELECT file_id, window_index, (frame - window_index * {H}) // 15 AS bin, avg(v) AS v, avg(CAST(speech AS INTEGER)) AS s FROM w WHERE (frame - window_index * {H}) // 15 < {W // 15} GROUP BY ALL
), ok AS (SELECT file_id, window_index, count(v) >= 8 AND stddev_pop(v) > 1e-9 AND stddev_pop(s) > 1e-9 AS ok FROM b GROUP BY ALL),
l AS (SELECT file_id, window_index, unnest(range(-3, 4)) AS lag, bin, s FROM b),
r AS (SELECT l.file_id, l.window_index, l.lag, CASE WHEN count(*) FILTER (WHERE b.v IS NOT NULL) >= 4 AND stddev_pop(b.v) > 1e-12 AND stddev_pop(l.s) FILTER (WHERE b.v IS NOT NULL) > 1e-12
  THEN covar_pop(b.v, l.s) / (stddev_pop(b.v) * stddev_pop(l.s) FILTER (WHERE b.v IS NOT NULL)) END AS r
  FROM l JOIN b ON l.file_id = b.file_id AND l.window_index = b.window_index AND b.bin = l.bin + l.lag GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY file_id, window_index ORDER BY round(r, 12) DESC NULLS LAST, lag) AS k FROM r)
SELECT file_id, window_index, round(CASE WHEN ok THEN best.r END, 6) AS sync_r, CASE WHEN ok AND best.r IS NOT NULL THEN best.lag * 0.5e0 END AS sync_lag_s, round(CASE WHEN ok THEN z.r END, 6) AS sync_r_zero
FROM ok LEFT JOIN best USING (file_id, window_index) LEFT JOIN (SELECT * FROM r WHERE lag = 0) z USING (file_id, window_index) WHERE k = 1 OR k IS NULL""",
    "speech_mask_intervals": """WITH i AS (SELECT clip_id, CAST(round_even(start_s * 30, 0) AS BIGINT) AS s, CAST(round_even(end_s * 30, 0) AS BIGINT) AS e FROM clip_speech WHERE isfinite(start_s) AND isfinite(end_s)),
f AS (SELECT DISTINCT clip_id, unnest(range(greatest(0, s), least(1200, e))) AS frame FROM i WHERE e > s AND e > 0 AND s < 1200)
SELECT clip_id, count(frame) AS speech_frames FROM (SELECT DISTINCT clip_id FROM clip_speech) LEFT JOIN f USING (clip_id) GROUP BY clip_id""",
    "interval_overlap_seconds": """SELECT clip_id, count(*) FILTER (WHERE isfinite(start_s) AND isfinite(end_s) AND end_s > start_s AND end_s > 2 AND start_s < 10) AS n_intervals,
  round(coalesce(sum(least(end_s, 10) - greatest(start_s, 2)) FILTER (WHERE isfinite(start_s) AND isfinite(end_s) AND end_s > start_s AND end_s > 2 AND start_s < 10), 0), 6) AS seconds FROM clip_speech GROUP BY clip_id""",
    "asof_hold": """WITH b AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY ALL), f AS (SELECT user_id, arg_min(value, ts) AS value FROM b GROUP BY user_id)
SELECT v.event_id, coalesce(b.value, f.value) AS held FROM (SELECT * FROM events WHERE event_type = 'view') v ASOF LEFT JOIN b ON v.user_id = b.user_id AND v.ts >= b.ts LEFT JOIN f ON v.user_id = f.user_id""",
    "frames_on_screen": """WITH b AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY ALL), f AS (SELECT user_id, arg_min(value, ts) AS value, max(ts) AS last FROM b GROUP BY user_id),
x AS (SELECT v.event_id, coalesce(b.value, f.value) AS held, f.last IS NULL OR (v.ts > f.last AND count(*) FILTER (WHERE v.ts > f.last) OVER (PARTITION BY v.user_id) > 2) AS bad
  FROM (SELECT * FROM events WHERE event_type = 'view') v ASOF LEFT JOIN b ON v.user_id = b.user_id AND v.ts >= b.ts LEFT JOIN f ON v.user_id = f.user_id)
SELECT event_id, CASE WHEN NOT bad THEN held END AS held, CASE WHEN bad THEN 'stopped' ELSE 'ok' END AS status FROM x""",
    "even_span_picks": f"""WITH {_T}, {_SPEECH_RUNS}, c AS (SELECT *, stop - start AS n, sum(stop - start) OVER (PARTITION BY file_id ORDER BY start) AS upto, sum(stop - start) OVER (PARTITION BY file_id) AS total FROM runs),
p AS (SELECT file_id, unnest(range(0, 12)) AS i, total FROM (SELECT DISTINCT file_id, total FROM c))
SELECT p.file_id, CAST(p.i AS INTEGER) AS pick, CAST(floor(c.start + (p.i + 0.5e0) / 12 * p.total - (c.upto - c.n)) AS BIGINT) AS position FROM p JOIN c ON p.file_id = c.file_id AND (p.i + 0.5e0) * c.total < 12 * c.upto AND (p.i + 0.5e0) * c.total >= 12 * (c.upto - c.n)""",
    "end_to_end_picks": f"WITH {_T} SELECT file_id, CAST(i AS INTEGER) AS slot, CAST(round_even(i / 11e0 * (n - 1), 0) AS BIGINT) AS frame FROM nf, range(0, 12) r(i)",
    "timeline_downsample": f"""WITH {_T}, s AS (SELECT file_id, max(frame) AS last, greatest(120, quantile_cont(v, 0.98)) AS top FROM t GROUP BY 1), p AS (SELECT file_id, CAST(i AS INTEGER) AS slot, CAST(floor(i * last / 39e0) AS BIGINT) AS at, top FROM s, range(0, 40) r(i))
SELECT p.file_id, slot, p.at, round(CASE WHEN v IS NULL THEN 0 ELSE least(1, greatest(0, v / top)) END, 6) AS level FROM p LEFT JOIN t ON p.file_id = t.file_id AND p.at = t.frame""",
    "signal_envelope": f"""WITH {_T}, s AS (SELECT file_id, max(frame) + 1 AS n, greatest(1e-6, max(abs(v))) AS peak FROM t GROUP BY 1)
SELECT file_id, CAST(((frame + 1) * 50 - 1) // n AS BIGINT) AS bin, round(greatest(-1, min(v) / max(peak)), 6) AS lower, round(least(1, max(v) / max(peak)), 6) AS upper FROM t JOIN s USING (file_id) GROUP BY 1, 2""",
    "file_rollups": f"""WITH {_T} SELECT file_id, count(*) AS frames, round(avg(CAST(smplh_valid AS INTEGER)), 6) AS valid_frac, round(count(*) FILTER (WHERE speech) / 30e0, 6) AS speech_seconds,
  CAST(CASE WHEN max(frame) + 1 < {W} THEN 0 ELSE (max(frame) + 1 - {W}) // {H} + 1 END AS INTEGER) AS n_windows FROM t GROUP BY file_id""",
}
_MEASURED = ("window_measures", "episodes_in_speech", "segments_covered", "longest_invalid_run", "excursion_range", "posture_spread")
_GATED = "coalesce(" + ", ".join(f"CASE WHEN NOT coalesce({c} {op} {lim!r}e0, false) THEN '{label}' END" for c, op, lim, label in GATES) + ")"
SQL["window_gates"] = f"WITH {', '.join(f'q{k} AS ({SQL[n]})' for k, n in enumerate(_MEASURED))}, g AS (SELECT file_id, window_index, {_GATED} AS fail_reason FROM q0 {' '.join(f'JOIN q{k} USING (file_id, window_index)' for k in range(1, len(_MEASURED)))}) SELECT *, fail_reason IS NULL AS qualifies FROM g"
