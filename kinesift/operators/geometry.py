"""Array and geometry operators: columns where algebra suffices, Arrow kernels for chained rotations."""

from __future__ import annotations


from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import col


# ---- rotations -------------------------------------------------------------------------------------------------------
def rotation_matrices(vectors: np.ndarray) -> np.ndarray:
    """Axis-angle vectors (..., 3) as matrices (..., 3, 3) by way of unit quaternions; tiny angles give the identity."""
    angle = np.linalg.norm(vectors, axis=-1)
    tiny = angle <= 1e-8
    scale = np.where(tiny, 0.0, np.sin(angle / 2) / np.where(tiny, 1.0, angle))
    w = np.where(tiny, 1.0, np.cos(angle / 2))
    x, y, z = (vectors[..., k] * scale for k in range(3))
    rows = [[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]]
    return np.stack([np.stack(r, axis=-1) for r in rows], axis=-2)


def chain(pose: np.ndarray, rest: np.ndarray, parents: Sequence[int]) -> np.ndarray:
    """Joint positions (frames, joints, 3) of axis-angle poses (frames, joints, 3) along a tree, parents before children."""
    local = rotation_matrices(pose)
    turned, at = np.empty_like(local), np.zeros(pose.shape)
    for j, p in enumerate(parents):
        if p < 0:
            turned[:, j] = local[:, j]
        else:
            turned[:, j] = turned[:, p] @ local[:, j]
            at[:, j] = at[:, p] + turned[:, p] @ (rest[j] - rest[p])
    return at


def torso_coordinates(joints: np.ndarray, left: int, right: int, neck: int, pelvis: int, wanted: Sequence[int]) -> np.ndarray:
    """Joints relative to the shoulder midpoint, along shoulders, spine and the axis across both."""
    across = joints[:, left] - joints[:, right]
    x = across / np.maximum(np.linalg.norm(across, axis=1, keepdims=True), 1e-9)
    spine = joints[:, neck] - joints[:, pelvis]
    y = spine - np.sum(spine * x, axis=1, keepdims=True) * x
    y = y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)
    frame = np.stack([x, y, np.cross(x, y)], axis=1)
    off = joints[:, list(wanted)] - 0.5 * (joints[:, left] + joints[:, right])[:, None]
    return np.einsum("fab,fjb->fja", frame, off)


def skeleton_positions(poses: DataFrame, keys: Sequence[str], pose: str, rest: Sequence[Sequence[float]], parents: Sequence[int], torso: tuple[int, int, int, int], wanted: Sequence[int], unit: float = 1000.0) -> DataFrame:
    """``keys, position ARRAY<DOUBLE>``: torso-frame positions (x, y, z of each wanted joint, times ``unit``) of every frame.

    ``pose`` is a flat axis-angle array of 3 x joints. One Arrow batch at a time: frames don't depend on each other, so
    nothing is shuffled. A NULL pose or one of another length gives NULL.
    """
    r, par, want, n = np.asarray(rest, float), list(parents), list(wanted), 3 * len(parents)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            raw = b.column(b.num_columns - 1).to_pylist()
            ok = [p is not None and len(p) == n for p in raw]
            out: list = [None] * len(raw)
            if any(ok):
                stack = np.array([p for p, o in zip(raw, ok, strict=True) if o], float).reshape(-1, len(par), 3)
                got = torso_coordinates(chain(stack, r, par), *torso, want) * unit
                for k, v in zip([i for i, o in enumerate(ok) if o], got.reshape(len(got), -1).tolist(), strict=True):
                    out[k] = v
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.list_(pa.float64()))], names=[*keys, "position"])

    ddl = ", ".join(f"`{k}` {poses.schema[k].dataType.simpleString()}" for k in keys) + ", position array<double>"
    return poses.select(*keys, F.col(pose).cast("array<double>").alias("_k_pose")).mapInArrow(run, ddl)


def _quaternion(v: str, k: int) -> tuple[Column, Column, Column, Column]:
    x, y, z = (F.get(F.col(v), F.lit(3 * k + i)).cast("double") for i in range(3))
    a = F.sqrt(x * x + y * y + z * z)
    s = F.when(a > 1e-8, F.sin(a / 2) / a).otherwise(F.lit(0.0))
    return F.cos(a / 2), x * s, y * s, z * s


def angular_speed(df: DataFrame, key: str, order: str, vector: str, joint: int, fps: float, name: str = "angular_speed") -> DataFrame:
    """Angle between a joint's rotation and the one of the row before, per second; the first row repeats the second's.

    The angle of R'S is twice the arc cosine of the quaternions' product, so columns suffice.
    """
    from .series import Blocks

    b = Blocks(df, key, order)
    q = _quaternion(vector, joint)
    b.rows = b.rows.withColumns({f"_k_q{i}": x for i, x in enumerate(q)})
    dot = F.lit(0.0)
    for i in range(4):
        dot = dot + F.col(f"_k_q{i}") * F.lag(f"_k_q{i}").over(b.w)
    b.rows = b.rows.withColumn("_k_a", F.when(dot.isNotNull(), 2 * F.acos(F.least(F.lit(1.0), F.abs(dot))) * fps))
    return b.own(**{name: F.coalesce("_k_a", F.lead("_k_a").over(b.w), F.lit(0.0))})


# ---- arrays ----------------------------------------------------------------------------------------------------------
def rows_of(a: str | Column, rows: Sequence[int], width: int) -> Column:
    """Chosen rows of a flat (n, width) array, in order; NULL entries beyond its end."""
    return F.transform(F.array(*[F.lit(r * width + k) for r in rows for k in range(width)]), lambda i: F.get(col(a), i))


def norm(a: str | Column) -> Column:
    return F.sqrt(F.aggregate(col(a), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def distance(a: str | Column, b: str | Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") - y.cast("double")), F.lit(0.0), lambda s, d: s + d * d))


def slice_of(a: str | Column, start: int, stop: int) -> Column:
    """Elements start..stop-1, fewer where the array ends before."""
    return F.slice(col(a), start + 1, max(0, stop - start))


def ragged(df: DataFrame, keys: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """Rows whose arrays differ in length."""
    lengths = F.array(*[F.size(a) for a in arrays])
    return df.filter(F.array_min(lengths) != F.array_max(lengths)).select(*keys, lengths.alias("lengths"))


def as_points(flat: str | Column, n: int) -> Column:
    """A flat (n, 3) array as n points of x, y and confidence; NULL parts beyond its end."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct(*[F.get(col(flat), 3 * k + i).cast("double").alias(c) for i, c in enumerate("xyc")]))


# ---- keypoints -------------------------------------------------------------------------------------------------------
def usable(p: Column) -> Column:
    """A 2-D point with finite values, not at the origin, of some confidence."""
    fine = F.lit(True)
    for f in ("x", "y", "c"):
        fine = fine & p[f].isNotNull() & ~F.isnan(p[f]) & (F.abs(p[f]) < float("inf"))
    return fine & ((p["x"] != 0) | (p["y"] != 0)) & (p["c"] > 0)


def centroid(points: Column, otherwise: Column) -> Column:
    """Mean of the usable points of an array, else ``otherwise`` where that is usable, else NULL."""
    good = F.filter(points, usable)
    mean = F.aggregate(good, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0).alias("n")), lambda s, p: F.struct((s["x"] + p["x"]).alias("x"), (s["y"] + p["y"]).alias("y"), (s["n"] + 1).alias("n")), lambda s: F.struct((s["x"] / s["n"]).alias("x"), (s["y"] / s["n"]).alias("y")))
    return F.when(F.size(good) > 0, mean).when(usable(otherwise), F.struct(otherwise["x"].cast("double").alias("x"), otherwise["y"].cast("double").alias("y")))


def hand_track(df: DataFrame, key: str, order: str, points: str, shoulders: tuple[int, int], hand: tuple[int, int], wrist: int) -> DataFrame:
    """``hx, hy``: a hand's centroid from the shoulders' midpoint in units of the file's median shoulder width, gaps filled.

    The width is one number a file, joined back by key.
    """
    from .series import forward_fill

    p = F.col(points)
    a, b = F.get(p, shoulders[0]), F.get(p, shoulders[1])
    wide = F.sqrt((a["x"] - b["x"]) ** 2 + (a["y"] - b["y"]) ** 2)
    ok = usable(a) & usable(b) & (wide > 1e-6)
    scale = df.groupBy(key).agg(F.percentile(F.when(ok, wide), F.lit(0.5)).alias("_k_w"))
    c = centroid(F.slice(p, hand[0] + 1, hand[1] - hand[0]), F.get(p, wrist))
    at = df.join(scale, key).withColumn("_k_c", F.when(ok, c))
    at = at.withColumn("hx", (F.col("_k_c.x") - (a["x"] + b["x"]) / 2) / F.col("_k_w")).withColumn("hy", (F.col("_k_c.y") - (a["y"] + b["y"]) / 2) / F.col("_k_w")).select(key, order, "hx", "hy")
    both = forward_fill(forward_fill(at, key, order, "hx", "fx"), key, order, "hy", "fy")
    return both.select(key, order, F.col("fx").alias("hx"), F.col("fy").alias("hy"))


def body_roll(df: DataFrame, key: str, points: str, shoulders: tuple[int, int], hips: tuple[int, int]) -> DataFrame:
    """Median angle in degrees of the axis from shoulders to hips, 0 downward, over frames where all four are usable."""
    p = F.col(points)
    s, t, u, v = (F.get(p, k) for k in (*shoulders, *hips))
    dx, dy = (u["x"] + v["x"] - s["x"] - t["x"]) / 2, (u["y"] + v["y"] - s["y"] - t["y"]) / 2
    ok = usable(s) & usable(t) & usable(u) & usable(v)
    return df.groupBy(key).agg(F.percentile(F.when(ok, F.degrees(F.atan2(dx, dy))), F.lit(0.5)).alias("roll_deg"))


def quarter_turns(roll: str | Column, tolerance: float = 30.0) -> Column:
    """Counter-clockwise quarter turns that stand a body with this roll upright; 0 where the roll is NULL or near none."""
    r = col(roll)
    return F.when(F.abs(r + 90) <= tolerance, 1).when(F.abs(r - 90) <= tolerance, 3).when(F.abs(F.abs(r) - 180) <= tolerance, 2).otherwise(0)


def repaired_point(x: Column, y: Column, width: Column, height: Column, left: Column, right: Column, aspect: Column, turns: Column) -> Column:
    """A point of the stored raster in the repaired one: crop, then pixel aspect, then quarter turns."""
    w = F.when(aspect == 1, width - left - right).otherwise(F.greatest(F.lit(1), F.rint((width - left - right) * aspect)))
    a, b = (x - left) * aspect, y
    return F.when(turns == 1, F.struct(b.alias("x"), (w - 1 - a).alias("y"))).when(turns == 2, F.struct((w - 1 - a).alias("x"), (height - 1 - b).alias("y"))).when(turns == 3, F.struct((height - 1 - b).alias("x"), a.alias("y"))).otherwise(F.struct(a.alias("x"), b.alias("y")))


def repaired_box(box: Sequence[Column], *raster: Column) -> Column:
    """A box of two corners in the repaired raster, corners sorted again."""
    p, q = repaired_point(box[0], box[1], *raster), repaired_point(box[2], box[3], *raster)
    return F.struct(F.least(p["x"], q["x"]).alias("x0"), F.least(p["y"], q["y"]).alias("y0"), F.greatest(p["x"], q["x"]).alias("x1"), F.greatest(p["y"], q["y"]).alias("y1"))


def turned_joint(x: Column, y: Column, z: Column, turns: Column) -> Column:
    """A camera-frame joint turned with its image, by quarter turns about the view axis."""
    return F.when(turns == 1, F.struct(y.alias("x"), (-x).alias("y"), z.alias("z"))).when(turns == 2, F.struct((-x).alias("x"), (-y).alias("y"), z.alias("z"))).when(turns == 3, F.struct((-y).alias("x"), x.alias("y"), z.alias("z"))).otherwise(F.struct(x.alias("x"), y.alias("y"), z.alias("z")))


def upright_joint(x: Column, y: Column, z: Column, spine_y: Column, spine_z: Column) -> Column:
    """A joint turned about the camera's x axis so that the spine (pelvis to neck) stands vertical."""
    a = F.atan2(spine_z, -spine_y)
    return F.struct(x.alias("x"), (y * F.cos(a) - z * F.sin(a)).alias("y"), (y * F.sin(a) + z * F.cos(a)).alias("z"))


def projected(x: Column, y: Column, z: Column, width: Column, height: Column, focal: float = 5000.0, model: float = 256.0) -> Column:
    """A camera-frame joint in pixels of the full frame."""
    f = focal / model * F.greatest(width, height)
    return F.struct(F.try_divide(f * x, z).__add__(width / 2).alias("x"), F.try_divide(f * y, z).__add__(height / 2).alias("y"))


def drift_seconds(fps: Column, annotated: Column, stored: Column) -> Column:
    """How far apart pairing by index ends up by the last frame."""
    return F.when(fps > 0, (annotated - stored) / fps)


def index_at(seconds: Column, fps: Column, frames: Column) -> Column:
    """Annotation frame on screen at a time, within the series."""
    return F.when((fps > 0) & seconds.isNotNull(), F.least(F.greatest(F.rint(seconds * fps), F.lit(0)), frames - 1)).otherwise(0).cast("bigint")


def crop_box(df: DataFrame, key: str, points: str, groups: Sequence[Sequence[int]], pad: float = 0.1, least: float = 64.0) -> DataFrame:
    """``x0, y0, x1, y1`` around the 5th to 95th percentile of each group of points over a file's frames, united and padded."""
    boxes = []
    for k, g in enumerate(groups):
        p = df.select(key, F.explode(F.filter(F.transform(F.array(*[F.lit(i) for i in g]), lambda i: F.get(F.col(points), i)), usable)).alias("p"))
        boxes.append(p.groupBy(key).agg(*[F.percentile(F.col(f"p.{a}"), F.lit(q)).alias(f"{a}{n}{k}") for a in "xy" for q, n in ((0.05, "lo"), (0.95, "hi"))], F.count(F.lit(1)).alias(f"n{k}")).filter(F.col(f"n{k}") >= 4))
    out = df.select(key).distinct()
    for b in boxes:
        out = out.join(b, key, "left")
    lo = {a: F.least(*[F.col(f"{a}lo{k}") for k in range(len(groups))]) if len(groups) > 1 else F.col(f"{a}lo0") for a in "xy"}
    hi = {a: F.greatest(*[F.col(f"{a}hi{k}") for k in range(len(groups))]) if len(groups) > 1 else F.col(f"{a}hi0") for a in "xy"}
    half = {a: F.greatest(F.lit(least), hi[a] - lo[a]) * (1 + 2 * pad) / 2 for a in "xy"}
    return out.select(key, *[((lo[a] + hi[a]) / 2 + s * half[a]).alias(f"{a}{n}") for n, s in ((0, -1), (1, 1)) for a in "xy"])


def fitted_box(box: Sequence[Column], width: Column, height: Column, aspect: float = 1.0) -> Column:
    """A box ``x0, y0, x1, y1`` of whole even pixels with the given aspect inside the raster, about the middle of ``box``.

    The box is widened or heightened to the aspect; a box that the raster can't hold is cut to the largest one of the aspect
    that it holds; then its corner is moved inside. No side is shorter than 32 pixels where the raster has them. NULL corners
    stand for the whole raster.
    """
    w, h = width.cast("double"), height.cast("double")
    known = box[0].isNotNull() & box[1].isNotNull() & box[2].isNotNull() & box[3].isNotNull()
    # of a box of the right aspect its width says all
    wide = F.greatest(box[2] - box[0], (box[3] - box[1]) * aspect)
    side = F.least(F.when(known, wide).otherwise(w), w, h * aspect)
    tall = side / aspect
    x = F.when(known, (box[0] + box[2] - wide) / 2).otherwise(F.lit(0.0))
    y = F.when(known, (box[1] + box[3] - wide / aspect) / 2).otherwise(F.lit(0.0))

    def even(v: Column) -> Column:
        return F.floor(v / 2) * 2

    left, top = even(F.least(F.greatest(F.lit(0.0), x), w - side)), even(F.least(F.greatest(F.lit(0.0), y), h - tall))
    right, bottom = left + F.least(F.greatest(F.lit(32), even(side)), w - left), top + F.least(F.greatest(F.lit(32), even(tall)), h - top)
    return F.struct(*[v.cast("int").alias(c) for v, c in zip((left, top, right, bottom), ("x0", "y0", "x1", "y1"), strict=True)])


def envelope(df: DataFrame, key: str, order: str, value: str, bins: int) -> DataFrame:
    """Smallest and largest value of ``bins`` equal parts of each series, in units of its peak; ``n`` rows from 0."""
    n = df.groupBy(key).agg((F.max(order) + 1).alias("_k_n"), F.greatest(F.lit(1e-6), F.max(F.abs(value))).alias("_k_peak"))
    part = F.floor(((F.col(order) + 1) * bins - 1) / F.col("_k_n"))
    return df.join(n, key).groupBy(key, part.alias("bin"), "_k_peak").agg(F.min(value).alias("lo"), F.max(value).alias("hi")).select(key, "bin", F.greatest(F.lit(-1.0), F.col("lo") / F.col("_k_peak")).alias("lower"), F.least(F.lit(1.0), F.col("hi") / F.col("_k_peak")).alias("upper"))


def downsampled(df: DataFrame, key: str, order: str, value: str, width: int, floor: float = 120.0) -> DataFrame:
    """``width`` evenly placed values of each series against its 98th percentile (``floor`` at least), 0 to 1."""
    size = df.groupBy(key).agg(F.max(order).alias("last"), F.greatest(F.lit(floor), F.percentile(value, F.lit(0.98))).alias("top"))
    at = size.select(key, "top", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.floor(k * F.col("last") / F.lit(width - 1.0)).cast("bigint"))).alias("slot", "at"))
    return at.join(df.select(F.col(key), F.col(order).alias("at"), value), [key, "at"], "left").select(key, "slot", "at", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(value) / F.col("top"))).alias("level"))


def padded_slice(df: DataFrame, keys: Sequence[str], samples: str, start: Column, n: int) -> DataFrame:
    """n samples from ``start``, zeros where the array doesn't reach."""
    return df.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.coalesce(F.when(start + k >= 0, F.get(F.col(samples), (start + k).cast("int"))), F.lit(0.0))).alias("slice"))


