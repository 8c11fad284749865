"""Geometry queries. The test tables hold no poses, so vectors of ``embeddings`` stand in: 21 joints or points of three numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import measured
from ..operators import geometry as g
from ..operators import series
from ..session import table

#: A made-up tree of 21 joints: pelvis, spine and neck, two arms, two legs; every bone a fixed offset in metres.
PARENTS = [-1, 0, 1, 2, 3, 3, 5, 6, 7, 3, 9, 10, 11, 0, 13, 14, 15, 0, 17, 18, 19]
REST = [[0.0, 0.0, 0.0]]
for _j in range(1, 21):
    _side = 0.0 if _j < 5 else 1.0 if _j < 9 or 13 <= _j < 17 else -1.0
    _up = 0.15 if _j < 5 else -0.02 if _j < 13 else -0.2
    REST.append([REST[PARENTS[_j]][0] + 0.12 * _side, REST[PARENTS[_j]][1] + _up, REST[PARENTS[_j]][2] + 0.01])
TORSO = (6, 10, 4, 0)  # left and right shoulder, neck, pelvis


def _vectors(spark, d):
    return table(spark, d, "embeddings").withColumn("pts", F.transform(g.as_points("embedding", 21), lambda p: F.struct((p["x"] * 500 + 500).alias("x"), (p["y"] * 500 + 500).alias("y"), F.abs(p["c"]).alias("c"))))


def fk_torso(spark, d):
    out = g.skeleton_positions(table(spark, d, "embeddings").withColumn("pose", F.slice("embedding", 1, 63)), ["vec_id"], "pose", REST, PARENTS, TORSO, [8, 12])
    return out.select("vec_id", F.posexplode("position").alias("k", "mm")).select("vec_id", "k", F.round("mm", 4).alias("mm"))


def quaternion_speed(spark, d):
    e = table(spark, d, "embeddings").select("label", "vec_id", "embedding")
    return g.angular_speed(e, "label", "vec_id", "embedding", 2, 30.0).select("vec_id", F.round("angular_speed", 4).alias("angular_speed"))


def wrist_track_speed(spark, d):
    """Forward kinematics, then smoothing and speed of one wrist along each label's frames."""
    pos = g.skeleton_positions(table(spark, d, "embeddings").withColumn("pose", F.slice("embedding", 1, 63)), ["label", "vec_id"], "pose", REST, PARENTS, TORSO, [8])
    xyz = pos.select("label", "vec_id", *[F.get("position", F.lit(k)).alias(a) for k, a in enumerate("xyz")])
    smooth = series.hann_smooth(xyz, "label", "vec_id", ["x", "y", "z"])
    return series.central_speed(smooth, "label", "vec_id", ["x_smooth", "y_smooth", "z_smooth"], 30.0).select("vec_id", F.round("speed", 3).alias("speed"))


def hand_track(spark, d):
    return g.hand_track(_vectors(spark, d), "label", "vec_id", "pts", (0, 1), (2, 9), 10).select("label", "vec_id", F.round("hx", 6).alias("hx"), F.round("hy", 6).alias("hy"))


def hand_step_cosine(spark, d):
    t = g.hand_track(_vectors(spark, d), "label", "vec_id", "pts", (0, 1), (2, 9), 10)
    return series.step_cosine(t, "label", "vec_id", ["hx", "hy"]).select("vec_id", F.round("cosine", 6).alias("cosine"))


def body_roll(spark, d):
    r = g.body_roll(_vectors(spark, d), "label", "pts", (0, 1), (11, 12))
    return r.select("label", F.round("roll_deg", 6).alias("roll_deg"), g.quarter_turns("roll_deg").alias("turns"))


def crop_box(spark, d):
    b = g.crop_box(_vectors(spark, d), "label", "pts", [range(0, 5), range(5, 21)])
    return b.select("label", *[F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


def fitted_crop(spark, d):
    """The padded box cut to a square of whole even pixels inside a raster of 900 by 1000."""
    b = g.crop_box(_vectors(spark, d), "label", "pts", [range(0, 5), range(5, 21)])
    fit = g.fitted_box([F.col(c) for c in ("x0", "y0", "x1", "y1")], F.lit(900), F.lit(1000))
    return b.select("label", fit.alias("f")).select("label", "f.*")


def raster_repair(spark, d):
    p = F.get("pts", F.lit(0))
    q = F.get("pts", F.lit(1))
    raster = (F.lit(1080), F.lit(960), F.lit(270), F.lit(270), F.lit(1.5), F.pmod("label", F.lit(4)))
    v = _vectors(spark, d).select("vec_id", g.repaired_point(p["x"], p["y"], *raster).alias("p"), g.repaired_box((p["x"], p["y"], q["x"], q["y"]), *raster).alias("b"))
    return v.select("vec_id", *[F.round(f"p.{c}", 4).alias(c) for c in "xy"], *[F.round(f"b.{c}", 4).alias(c) for c in ("x0", "y0", "x1", "y1")])


def camera_joints(spark, d):
    """A joint projected into the full frame, turned with its image, and stood upright."""
    x, y, z = (F.get("embedding", F.lit(k)).cast("double") for k in range(3))
    sy, sz = F.get("embedding", F.lit(4)).cast("double"), F.get("embedding", F.lit(5)).cast("double")
    e = table(spark, d, "embeddings").select("vec_id", g.projected(x, y, z + 4, F.lit(1080), F.lit(1920)).alias("p"), g.turned_joint(x, y, z, F.pmod("label", F.lit(4))).alias("t"), g.upright_joint(x, y, z, sy, sz).alias("u"))
    return e.select("vec_id", F.round("p.x", 3).alias("px"), F.round("p.y", 3).alias("py"), *[F.round(f"t.{c}", 6).alias(f"t{c}") for c in "xyz"], *[F.round(f"u.{c}", 5).alias(f"u{c}") for c in "xyz"])


def annotation_timebase(spark, d):
    i = table(spark, d, "inventory").select("file_id", measured("video_r_fps").alias("fps"), measured("video_nb_frames").alias("n"), measured("observed_duration_s").alias("s"))
    return i.select("file_id", F.round(g.drift_seconds(F.col("fps"), F.col("n"), F.rint(F.col("s") * F.col("fps"))), 6).alias("drift_s"), g.index_at(F.col("s") / 2, F.coalesce("fps", F.lit(0.0)), F.coalesce("n", F.lit(1.0))).alias("middle"))


def padded_slices(spark, d):
    return g.padded_slice(table(spark, d, "embeddings").withColumn("a", F.col("embedding").cast("array<double>")), ["vec_id"], "a", F.lit(60), 8).select("vec_id", F.round(F.aggregate("slice", F.lit(0.0), lambda s, x: s + x), 6).alias("total"), F.size("slice").alias("n"))


def ragged_arrays(spark, d):
    """Vectors whose usable points and all points differ in number."""
    v = _vectors(spark, d).withColumn("good", F.filter("pts", lambda p: g.usable(p) & (p["c"] > 0.01)))
    return g.ragged(v, ["vec_id"], ["pts", "good"]).select("vec_id", F.get("lengths", F.lit(1)).alias("n_usable"))


QUERIES = {f.__name__: f for f in (fk_torso, quaternion_speed, wrist_track_speed, hand_track, hand_step_cosine, body_roll, crop_box, fitted_crop, raster_repair, camera_joints, annotation_timebase, padded_slices, ragged_arrays)}


def _e(k: int) -> str:
    return f"CAST(embedding[{k + 1}] AS DOUBLE)"


def _px(k: int) -> str:
    return f"({_e(3 * k)} * 500 + 500)"


def _py(k: int) -> str:
    return f"({_e(3 * k + 1)} * 500 + 500)"


def _us(k: int) -> str:
    return f"(({_px(k)} <> 0 OR {_py(k)} <> 0) AND abs({_e(3 * k + 2)}) > 0)"


_POINTS = "p AS (SELECT label, vec_id, k, CAST(embedding[3 * k + 1] AS DOUBLE) * 500 + 500 AS x, CAST(embedding[3 * k + 2] AS DOUBLE) * 500 + 500 AS y, abs(CAST(embedding[3 * k + 3] AS DOUBLE)) AS c FROM embeddings, range(0, 21) r(k))"
_TURN = """CASE label % 4 WHEN 1 THEN {b} WHEN 2 THEN {w} - 1 - {a} WHEN 3 THEN 960 - 1 - {b} ELSE {a} END""", """CASE label % 4 WHEN 1 THEN {w} - 1 - {a} WHEN 2 THEN 960 - 1 - {b} WHEN 3 THEN {a} ELSE {b} END"""


def _turned(x: str, y: str) -> tuple[str, str]:
    a, b, w = f"(({x} - 270) * 1.5e0)", y, "810e0"
    return _TURN[0].format(a=a, b=b, w=w), _TURN[1].format(a=a, b=b, w=w)


_P0, _P1 = _turned(_px(0), _py(0)), _turned(_px(1), _py(1))
_TRACK = """w AS (SELECT label, median(sqrt(pow(ax - bx, 2) + pow(ay - by_, 2))) FILTER (WHERE sqrt(pow(ax - bx, 2) + pow(ay - by_, 2)) > 1e-6) AS w FROM s GROUP BY 1),
s AS (SELECT a.label, a.vec_id, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_ FROM p a JOIN p b USING (vec_id) WHERE a.k = 0 AND b.k = 1),
h AS (SELECT vec_id, avg(x) AS cx, avg(y) AS cy FROM p WHERE k BETWEEN 2 AND 8 AND c > 0 GROUP BY 1),
t AS (SELECT s.label, s.vec_id, (cx - (ax + bx) / 2) / w AS hx, (cy - (ay + by_) / 2) / w AS hy FROM s JOIN w USING (label) JOIN h USING (vec_id))"""
_TRACK = _TRACK.split("\n")[1] + "\n" + _TRACK.split("\n")[0] + "\n" + "\n".join(_TRACK.split("\n")[2:])
SQL = {
    "quaternion_speed": f"""WITH v AS (SELECT label, vec_id, {_e(6)} AS x, {_e(7)} AS y, {_e(8)} AS z FROM embeddings), n AS (SELECT *, sqrt(x * x + y * y + z * z) AS a FROM v),
q AS (SELECT label, vec_id, cos(a / 2) AS w, CASE WHEN a > 1e-8 THEN sin(a / 2) / a ELSE 0 END AS f, x, y, z FROM n),
s AS (SELECT label, vec_id, CASE WHEN lag(w) OVER o IS NOT NULL THEN 60 * acos(least(1, abs(w * lag(w) OVER o + f * lag(f) OVER o * (x * lag(x) OVER o + y * lag(y) OVER o + z * lag(z) OVER o)))) END AS s FROM q WINDOW o AS (PARTITION BY label ORDER BY vec_id))
SELECT vec_id, round(coalesce(s, lead(s) OVER (PARTITION BY label ORDER BY vec_id), 0), 4) AS angular_speed FROM s""",
    "hand_track": f"WITH {_POINTS}, {_TRACK} SELECT label, vec_id, round(hx, 6) AS hx, round(hy, 6) AS hy FROM t",
    "hand_step_cosine": f"""WITH {_POINTS}, {_TRACK}, x AS (SELECT vec_id, hx - lag(hx) OVER o AS ax, hy - lag(hy) OVER o AS ay, lead(hx) OVER o - hx AS bx, lead(hy) OVER o - hy AS by_ FROM t WINDOW o AS (PARTITION BY label ORDER BY vec_id)),
y AS (SELECT *, sqrt(ax * ax + ay * ay) AS na, sqrt(bx * bx + by_ * by_) AS nb FROM x) SELECT vec_id, round(CASE WHEN na > 0.01e0 AND nb > 0.01e0 THEN (ax * bx + ay * by_) / (na * nb) END, 6) AS cosine FROM y""",
    "body_roll": f"""WITH r AS (SELECT label, median(degrees(atan2(({_px(11)} + {_px(12)} - {_px(0)} - {_px(1)}) / 2, ({_py(11)} + {_py(12)} - {_py(0)} - {_py(1)}) / 2))) FILTER (WHERE {_us(0)} AND {_us(1)} AND {_us(11)} AND {_us(12)}) AS r FROM embeddings GROUP BY 1)
SELECT label, round(r, 6) AS roll_deg, CASE WHEN abs(r + 90) <= 30 THEN 1 WHEN abs(r - 90) <= 30 THEN 3 WHEN abs(abs(r) - 180) <= 30 THEN 2 ELSE 0 END AS turns FROM r""",
    "crop_box": f"""WITH {_POINTS}, b AS (SELECT label, k < 5 AS g, quantile_cont(x, 0.05) AS xl, quantile_cont(x, 0.95) AS xh, quantile_cont(y, 0.05) AS yl, quantile_cont(y, 0.95) AS yh FROM p WHERE c > 0 GROUP BY ALL HAVING count(*) >= 4),
u AS (SELECT label, min(xl) AS xl, max(xh) AS xh, min(yl) AS yl, max(yh) AS yh FROM b GROUP BY 1)
SELECT label, round((xl + xh) / 2 - greatest(64, xh - xl) * 0.6e0, 6) AS x0, round((yl + yh) / 2 - greatest(64, yh - yl) * 0.6e0, 6) AS y0, round((xl + xh) / 2 + greatest(64, xh - xl) * 0.6e0, 6) AS x1, round((yl + yh) / 2 + greatest(64, yh - yl) * 0.6e0, 6) AS y1 FROM u""",
    "raster_repair": f"""SELECT vec_id, round({_P0[0]}, 4) AS x, round({_P0[1]}, 4) AS y, round(least({_P0[0]}, {_P1[0]}), 4) AS x0, round(least({_P0[1]}, {_P1[1]}), 4) AS y0, round(greatest({_P0[0]}, {_P1[0]}), 4) AS x1, round(greatest({_P0[1]}, {_P1[1]}), 4) AS y1 FROM embeddings""",
    "camera_joints": f"""WITH v AS (SELECT vec_id, label % 4 AS q, {_e(0)} AS x, {_e(1)} AS y, {_e(2)} AS z, atan2({_e(5)}, -{_e(4)}) AS a FROM embeddings)
SELECT vec_id, round(37500e0 * x / (z + 4) + 540, 3) AS px, round(37500e0 * y / (z + 4) + 960, 3) AS py, round(CASE q WHEN 1 THEN y WHEN 2 THEN -x WHEN 3 THEN -y ELSE x END, 6) AS tx, round(CASE q WHEN 1 THEN -x WHEN 2 THEN -y WHEN 3 THEN x ELSE y END, 6) AS ty,
  round(z, 6) AS tz, round(x, 5) AS ux, round(y * cos(a) - z * sin(a), 5) AS uy, round(y * sin(a) + z * cos(a), 5) AS uz FROM v""",
    "annotation_timebase": """WITH i AS (SELECT file_id, CASE WHEN isfinite(video_r_fps) THEN video_r_fps END AS fps, CASE WHEN isfinite(video_nb_frames) THEN video_nb_frames END AS n, CASE WHEN isfinite(observed_duration_s) THEN observed_duration_s END AS s FROM inventory)
SELECT file_id, round(CASE WHEN fps > 0 THEN (n - round_even(s * fps, 0)) / fps END, 6) AS drift_s, CAST(CASE WHEN coalesce(fps, 0) > 0 AND s IS NOT NULL THEN least(greatest(round_even(s / 2 * fps, 0), 0), coalesce(n, 1) - 1) ELSE 0 END AS BIGINT) AS middle FROM i""",
    "padded_slices": f"SELECT vec_id, round({_e(60)} + {_e(61)} + {_e(62)} + {_e(63)}, 6) AS total, 8 AS n FROM embeddings",
    "ragged_arrays": f"WITH {_POINTS}, n AS (SELECT vec_id, count(*) FILTER (WHERE c > 0.01 AND (x <> 0 OR y <> 0)) AS m FROM p GROUP BY 1) SELECT vec_id, CAST(m AS INTEGER) AS n_usable FROM n WHERE m <> 21",
}
SQL["fitted_crop"] = f"""WITH b0 AS ({SQL["crop_box"]}), b AS (SELECT *, greatest(x1 - x0, y1 - y0) AS wide FROM b0), s AS (SELECT *, least(wide, 900) AS side FROM b),
p AS (SELECT *, CAST(floor(least(greatest(0, (x0 + x1 - wide) / 2), 900 - side) / 2) * 2 AS INTEGER) AS l, CAST(floor(least(greatest(0, (y0 + y1 - wide) / 2), 1000 - side) / 2) * 2 AS INTEGER) AS t, greatest(32, CAST(floor(side / 2) * 2 AS INTEGER)) AS w FROM s)
SELECT label, l AS x0, t AS y0, l + least(w, 900 - l) AS x1, t + least(w, 1000 - t) AS y1 FROM p"""
