"""From pose bundles to per-frame tracks: kinematics and keypoints in one Arrow pass, all that looks at neighbours as windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Durable
from . import geometry, series
from .measures import POINTS, window_measures
from .windows import sliding_windows

# Joints of the body model and points of the whole-body detector.
PELVIS, NECK, SHOULDERS, ELBOWS, WRISTS = 0, 12, (16, 17), (18, 19), (20, 21)
BODY, HAND, FINGERS = 21, 15, (range(22, 37), range(37, 52))
#: Rows of the body pose (without its root) that make the upper body: spine, neck, head, collars, shoulders, elbows, wrists.
UPPER_BODY = (2, 5, 8, 11, 14, 12, 13, 15, 16, 17, 18, 19, 20)
KP_SHOULDERS, KP_WRISTS, KP_UPPER, KP_HANDS, KP_ALL = (5, 6), (9, 10), (0, 5, 6, 7, 8, 9, 10, 11, 12), ((91, 112), (112, 133)), 133
# Activity (speed and travel, both exceeded), pauses that are bridged and shortest bursts, in seconds.
ACTIVE_MM_S, ACTIVE_MM, TRAVEL_S, PAUSE_S, BURST_S = 60.0, 35.0, 0.5, 0.25, 0.30


@dataclass(frozen=True)
class Skeleton:
    """Rest places of 52 joints in metres and the parent of each, parents before children; -1 for the root."""

    rest: Sequence[Sequence[float]]
    parents: Sequence[int]

    @staticmethod
    def of_template(regressor: np.ndarray, template: np.ndarray, parents: Sequence[int]) -> Skeleton:
        """Joints as the regressor's (joints, vertices) mixtures of the template's (vertices, 3) places."""
        return Skeleton((np.asarray(regressor, float) @ np.asarray(template, float)).tolist(), [int(p) for p in parents])


def stacked(body: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One (frames, 52, 3) pose: a root that isn't turned, 21 joints of the body, 15 of each hand."""
    n = len(body)
    return np.concatenate([np.zeros((n, 1, 3)), *(np.asarray(x, float).reshape(n, -1, 3) for x in (body, left, right))], axis=1)


def _keypoint_rows(kp: np.ndarray) -> tuple[np.ndarray, ...]:
    """Confidence of the upper body, shoulder width (NaN where not usable), and each hand from the shoulders' middle in pixels."""
    xy, c = kp[..., :2], kp[..., 2]
    good = np.isfinite(kp).all(axis=2) & (xy != 0).any(axis=2) & (c > 0)
    conf = np.where(good, c, 0.0)[:, list(KP_UPPER)].mean(axis=1)
    a, b = xy[:, KP_SHOULDERS[0]], xy[:, KP_SHOULDERS[1]]
    wide = np.hypot(*(a - b).T)
    known = good[:, KP_SHOULDERS[0]] & good[:, KP_SHOULDERS[1]] & (wide > 1e-6)
    hands = []
    for (lo, hi), wrist in zip(KP_HANDS, KP_WRISTS, strict=True):
        weight = good[:, lo:hi].astype(float)
        n = weight.sum(axis=1)
        with np.errstate(invalid="ignore"):
            middle = np.einsum("fp,fpc->fc", weight, np.nan_to_num(xy[:, lo:hi], posinf=0.0, neginf=0.0)) / np.maximum(n, 1)[:, None]
        at = np.where((n > 0)[:, None], middle, np.where(good[:, wrist][:, None], xy[:, wrist], np.nan))
        hands.append(np.where(known[:, None], at - (a + b) / 2, np.nan))
    return conf, np.where(known, wide, np.nan), *hands


_ROW = (*POINTS, "mid_x", "mid_y", "mid_z", "kp_conf", "kp_width", "h0_x", "h0_y", "h1_x", "h1_y")


def placed(frames: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Each frame by itself: ``file_id, frame``, POINTS in the torso frame and the shoulders' middle in millimetres, keypoint
    values, finger rotations as 30 quaternions, and the masks. One Arrow batch at a time; nothing is shuffled.

    Frames whose arrays have other lengths than 63, 45 and 45 have no points; without all 133 keypoints confidence is 0 and
    the hands are unknown.
    """
    rest, parents = np.asarray(skeleton.rest, float), list(skeleton.parents)
    wanted = [*WRISTS, *ELBOWS, *SHOULDERS]
    n_body, n_hand, n_kp = 3 * BODY, 3 * HAND, 3 * KP_ALL

    def matrix(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
        rows = column.to_pylist()
        ok = np.array([r is not None and len(r) == n for r in rows], bool)
        return np.array([r if o else [0.0] * n for r, o in zip(rows, ok, strict=True)], float).reshape(len(rows), n), ok

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            (body, o1), (left, o2), (right, o3), (kp, o4) = (matrix(b.column(k), n) for k, n in zip(range(2, 6), (n_body, n_hand, n_hand, n_kp), strict=True))
            ok, n = o1 & o2 & o3, b.num_rows
            pose = stacked(body, left, right)
            joints = geometry.chain(pose, rest, parents)
            at = geometry.torso_coordinates(joints, *SHOULDERS, NECK, PELVIS, wanted) * 1000.0
            middle = (joints[:, SHOULDERS[0]] + joints[:, SHOULDERS[1]]) * 500.0
            three = np.concatenate([at.reshape(n, -1), middle], axis=1)
            three[~ok] = np.nan
            conf, width, h0, h1 = _keypoint_rows(kp.reshape(n, KP_ALL, 3))
            two = np.column_stack([np.where(o4, conf, 0.0), np.where(o4, width, np.nan), np.where(o4[:, None], h0, np.nan), np.where(o4[:, None], h1, np.nan)])
            angle = np.linalg.norm(pose[:, 22:], axis=2, keepdims=True)
            q = np.concatenate([np.cos(angle / 2), pose[:, 22:] * np.where(angle > 1e-8, np.sin(angle / 2) / np.maximum(angle, 1e-8), 0.0)], axis=2).reshape(n, -1)
            cols = [pa.array(c, from_pandas=True) for c in np.concatenate([three, two], axis=1).T]
            fingers = pa.array([r if o else None for r, o in zip(q.tolist(), ok, strict=True)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols, fingers, *(b.column(k) for k in range(6, b.num_columns))], names=["file_id", "frame", *_ROW, "fingers", "smplh_valid", "box_valid", "hands"])

    ddl = "file_id string, frame bigint, " + ", ".join(f"{c} double" for c in _ROW) + ", fingers array<double>, smplh_valid boolean, box_valid boolean, hands array<double>"
    d = "array<double>"
    slim = frames.filter("frame IS NOT NULL").select(F.col("file_id"), F.col("frame").cast("bigint").alias("frame"), *[F.col(c).cast(d).alias(c) for c in ("body", "left", "right", "keypoints")], F.coalesce("smplh_valid", F.lit(True)).alias("smplh_valid"), F.coalesce("box_valid", F.lit(True)).alias("box_valid"), F.concat("left", "right").cast(d).alias("hands"))
    return slim.mapInArrow(run, ddl)


def pose_tracks(frames: DataFrame, intervals: DataFrame, skeleton: Skeleton, fps: float = 30.0) -> DataFrame:
    """Per-frame tracks that ``measures.window_measures`` reads, of frames as ``bundles.read_poses`` gives them and voice
    intervals ``file_id, start, end``.

    Wrists are smoothed, then differenced (speed, of the faster side) and boxed (travel); activity is speed and travel, with
    pauses bridged and bursts dropped over whole files. Finger speed is the mean angle between a frame's local finger rotations
    and those before, of the faster hand: a stiff hand on a swinging arm has none. The second channel is each hand's middle
    in units of the file's median shoulder width, gaps filled, its cosines those of each hand's own steps. Files without
    usable shoulders have speed 0 and no cosines there.
    """
    here = placed(frames, skeleton)
    widths = here.groupBy("file_id").agg(F.percentile("kp_width", F.lit(0.5)).alias("_k_wide"))
    scaled = here.join(widths, "file_id").withColumns({f"h{k}_{a}": F.col(f"h{k}_{a}") / F.col("_k_wide") for k in (0, 1) for a in "xy"})
    full = series.forward_fill(scaled, "file_id", "frame", {f"h{k}_{a}": f"t{k}_{a}" for k in (0, 1) for a in "xy"})
    half = max(1, max(2, round(TRAVEL_S * fps)) // 2)
    b = series.Blocks(full, "file_id", "frame", halo=max(series.HALO, half + 8))
    lag_q, lag_h = F.lag("fingers").over(b.w), F.lag("hands").over(b.w)
    b.rows = b.rows.withColumns({f"s_{c}": series.smoothed(b, c) for c in (*POINTS[:6], "mid_x", "mid_y", "mid_z", "t0_x", "t0_y", "t1_x", "t1_y")} | {"_k_q": lag_q, "_k_h": lag_h})
    sides = {"lw": [f"s_lw_{a}" for a in "xyz"], "rw": [f"s_rw_{a}" for a in "xyz"], "mid": [f"s_mid_{a}" for a in "xyz"], "t0": ["s_t0_x", "s_t0_y"], "t1": ["s_t1_x", "s_t1_y"]}
    angle = "transform(sequence(0, 29), j -> 2 * acos(least(1D, abs(fingers[4*j] * _k_q[4*j] + fingers[4*j+1] * _k_q[4*j+1] + fingers[4*j+2] * _k_q[4*j+2] + fingers[4*j+3] * _k_q[4*j+3]))))"
    b.rows = b.rows.withColumns({f"v_{k}": series.differenced(b, axes, fps) for k, axes in sides.items()} | {"_k_a": F.expr(f"CASE WHEN _k_q IS NOT NULL AND fingers IS NOT NULL THEN {angle} END")})
    mean = "aggregate(slice(_k_a, {}, 15), 0D, (s, x) -> s + x) / 15"
    b.rows = b.rows.withColumns({f"w_{k}": series.ends_filled(b, f"v_{k}") for k in sides} | {"_k_f": F.expr(f"greatest({mean.format(1)}, {mean.format(16)})") * fps})
    cosines = {"step_cosine": series.turning(b, ["t0_x", "t0_y"]), "step_cosine_right": series.turning(b, ["t1_x", "t1_y"])}
    seen = F.col("_k_wide").isNotNull()
    new = {
        "arm_speed": F.greatest("w_lw", "w_rw"),
        "arm_travel": F.greatest(*[series.travelled(b, sides[k], half) for k in ("lw", "rw")]),
        "torso_speed": F.col("w_mid"),
        "arm_speed_2d": F.when(seen, F.greatest("w_t0", "w_t1")).otherwise(F.lit(0.0)),
        "hand_speed": F.coalesce("_k_f", F.lead("_k_f").over(b.w), F.lit(0.0)),
        "hand_frozen": F.coalesce((F.col("hands") == F.col("_k_h")) & ~F.exists("hands", lambda x: F.isnan(x)), F.lit(False)),
    } | {k: F.when(seen, c) for k, c in cosines.items()}
    wrists = [F.col(f"s_{c}").alias(c) for c in POINTS[:6]]
    own = b.rows.withColumns(new).filter("_k_own").select("file_id", "frame", *wrists, *POINTS[6:], "kp_conf", "smplh_valid", "box_valid", *new)
    kept = Durable(frames.sparkSession).keep(own)  # read for activity and for the tracks
    active = series.closed_runs(kept, "file_id", "frame", (F.col("arm_speed") > ACTIVE_MM_S) & (F.col("arm_travel") > ACTIVE_MM), round(PAUSE_S * fps), round(BURST_S * fps))
    said = series.speech_mask(kept, intervals, "file_id", "frame", fps, "start", "end", "speech")
    return series.in_stretches(said, active, "file_id", "frame", "active")


def scan(frames: DataFrame, intervals: DataFrame, skeleton: Skeleton, fps: float = 30.0, window_s: float = 30.0, hop_s: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """Files and windows of bundles: ``(file rows, window rows)``.

    A file that couldn't be read keeps its status and has no windows; one shorter than a window is ``too_few_frames:<n>``.
    File rows have the shares of the masks and how many windows there are.
    """
    width, hop = round(window_s * fps), round(hop_s * fps)
    status = F.when((F.col("scan_status") == "ok") & (F.col("n_frames") < width), F.concat(F.lit("too_few_frames:"), F.col("n_frames"))).otherwise(F.col("scan_status"))
    judged = frames.withColumn("scan_status", status)
    files = judged.groupBy("file_id", "scan_status").agg(F.max("n_frames").alias("n_frames"))
    sound = judged.filter("scan_status = 'ok'")
    tracks = Durable(frames.sparkSession).keep(pose_tracks(sound, intervals, skeleton, fps))
    shares = {"speech_frac_file": "speech", "smplh_valid_frac_file": "smplh_valid", "box_valid_frac_file": "box_valid", "hand_frozen_frac_file": "hand_frozen", "gesture_frac_file": "active"}
    per_file = tracks.groupBy("file_id").agg(*[F.avg(F.col(c).cast("int")).alias(n) for n, c in shares.items()], (F.count_if("speech") / fps).alias("speech_seconds_file"))
    count = F.when(F.col("scan_status") == "ok", F.size(sliding_windows("n_frames", width, hop))).otherwise(F.lit(0))
    return files.join(per_file, "file_id", "left").withColumns({"duration_s": F.col("n_frames") / fps, "window_count": count}), window_measures(tracks, width, hop, fps)
