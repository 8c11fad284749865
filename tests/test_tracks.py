import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinesift.operators import geometry, measures, tracks
from kinesift.sources import bundles

PARENTS = [-1, 0, 0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 9, 12, 13, 14, 16, 17, 18, 19] + [20 if k % 3 == 0 else 21 + k for k in range(15)] + [21 if k % 3 == 0 else 36 + k for k in range(15)]
FPS = 30.0


def skeleton():
    rng = np.random.default_rng(1)
    rest = rng.normal(0, 0.05, (52, 3))
    for j, x, y in ((0, 0, 0), (3, 0, 0.1), (6, 0, 0.2), (9, 0, 0.3), (12, 0, 0.45), (13, 0.05, 0.4), (14, -0.05, 0.4), (16, 0.17, 0.4), (17, -0.17, 0.4), (18, 0.42, 0.38), (19, -0.42, 0.38), (20, 0.66, 0.37), (21, -0.66, 0.37)):
        rest[j] = (x, y, 0.01)
    return tracks.Skeleton(rest.tolist(), PARENTS)


def payload(n=420, seed=2):
    rng = np.random.default_rng(seed)
    t = np.arange(n) / FPS
    body = rng.normal(0, 0.002, (n, 21, 3))
    body[:, 15] += np.outer(np.sin(2 * t) * (t > 4), [0.2, 0.5, 0.9])  # left shoulder, after four seconds
    body[:, 16] += np.outer(np.cos(1.5 * t), [0.1, -0.3, 0.2])
    left, right = (np.cumsum(rng.normal(0, 0.01, (n, 15, 3)), axis=0) for _ in range(2))
    left[100:110], right[100:110] = left[99], right[99]
    kp = rng.normal(0, 1, (n, 133, 3)) + 500
    kp[..., 2] = rng.uniform(0.2, 1, (n, 133))
    kp[:, 5, :2], kp[:, 6, :2] = (600, 300), (400, 300)
    kp[:, 91:112, 0] += 100 * np.sin(3 * t)[:, None]
    kp[50:60, 91:112, 2] = 0  # no hand: its wrist is used
    kp[60:65, 91:112, 2] = kp[60:65, 9, 2] = 0  # neither
    kp[0:3, 5, 2] = 0
    return {"smplh:body_pose": body, "smplh:left_hand_pose": left, "smplh:right_hand_pose": right, "smplh:is_valid": rng.random(n) < 0.9, "boxes_and_keypoints:keypoints": kp, "boxes_and_keypoints:is_valid_box": rng.random(n) < 0.95}


def smooth(x):
    y = np.concatenate([x[:1], x[:1], x, x[-1:], x[-1:]])
    return sum(w * y[k : k + len(x)] for k, w in enumerate((1 / 12, 1 / 4, 1 / 3, 1 / 4, 1 / 12)))


def speed(x):
    v = [np.linalg.norm(x[min(max(i, 2), len(x) - 3) + 2] - x[min(max(i, 2), len(x) - 3) - 2]) * FPS / 4 for i in range(len(x))]
    return np.array(v)


def plain(p):
    """Track by track, frame by frame."""
    p = {k: np.asarray(v, np.float32).astype(float) if v.dtype != bool else v for k, v in p.items()}
    s = skeleton()
    n = len(p["smplh:body_pose"])
    pose = np.concatenate([np.zeros((n, 1, 3)), p["smplh:body_pose"], p["smplh:left_hand_pose"], p["smplh:right_hand_pose"]], axis=1)
    joints = geometry.chain(pose, np.asarray(s.rest), PARENTS)
    arms = geometry.torso_coordinates(joints, 16, 17, 12, 0, [20, 21]) * 1000
    out, wrists = {}, [smooth(arms[:, k]) for k in (0, 1)]
    out["arm_speed"] = np.maximum(speed(wrists[0]), speed(wrists[1]))
    out["arm_travel"] = np.array([max(np.linalg.norm(np.ptp(w[max(0, i - 7) : i + 8], axis=0)) for w in wrists) for i in range(n)])
    out["torso_speed"] = speed(smooth((joints[:, 16] + joints[:, 17]) * 500))
    turn = geometry.rotation_matrices(pose[:, 22:])
    a = np.array([[np.arccos(np.clip((np.trace(turn[i - 1, j].T @ turn[i, j]) - 1) / 2, -1, 1)) for j in range(30)] for i in range(1, n)]) * FPS
    fingers = np.maximum(a[:, :15].mean(axis=1), a[:, 15:].mean(axis=1))
    out["hand_speed"] = np.r_[fingers[0], fingers]
    kp = p["boxes_and_keypoints:keypoints"]
    good = kp[..., 2] > 0
    out["kp_conf"] = np.array([np.mean([kp[i, k, 2] if good[i, k] else 0 for k in tracks.KP_UPPER]) for i in range(n)])
    known = good[:, 5] & good[:, 6]
    scale = np.median(np.linalg.norm(kp[known, 5, :2] - kp[known, 6, :2], axis=1))
    speeds = []
    for (lo, hi), w, name in zip(tracks.KP_HANDS, tracks.KP_WRISTS, ("step_cosine", "step_cosine_right"), strict=True):
        track, last = [], None
        for i in range(n):
            at = kp[i, lo:hi][good[i, lo:hi], :2].mean(axis=0) if good[i, lo:hi].any() else kp[i, w, :2] if good[i, w] else None
            if at is not None and known[i]:
                last = (at - (kp[i, 5, :2] + kp[i, 6, :2]) / 2) / scale
            track.append(last)
        first = next(x for x in track if x is not None)
        track = np.array([first if x is None else x for x in track])
        speeds.append(speed(smooth(track)))
        c = np.full(n, np.nan)
        for i in range(1, n - 1):
            u, v = track[i] - track[i - 1], track[i + 1] - track[i]
            if np.linalg.norm(u) > 0.01 and np.linalg.norm(v) > 0.01:
                c[i] = u @ v / np.linalg.norm(u) / np.linalg.norm(v)
        out[name] = c
    out["arm_speed_2d"] = np.maximum(*speeds)
    hands = np.concatenate([p["smplh:left_hand_pose"].reshape(n, -1), p["smplh:right_hand_pose"].reshape(n, -1)], axis=1)
    out["hand_frozen"] = np.r_[False, (hands[1:] == hands[:-1]).all(axis=1)].astype(float)
    raw = (out["arm_speed"] > 60) & (out["arm_travel"] > 35)
    act = raw.copy()
    at = np.flatnonzero(raw)
    for i, j in zip(at, at[1:], strict=False):
        if j - i - 1 <= 8:
            act[i:j] = True
    i = 0
    while i < n:
        j = i
        while j < n and act[j]:
            j += 1
        if 0 < j - i < 9:
            act[i:j] = False
        i = max(j, i + 1)
    out["active"] = act.astype(float)
    out["speech"] = np.array([any(round(s * FPS) <= i < round(e * FPS) for s, e in ((1.0, 2.5), (5.0, 11.5))) for i in range(n)], float)
    return out, wrists


@pytest.fixture(scope="module")
def scanned(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("b")
    for name, n in (("good", 420), ("brief", 100)):
        np.savez(root / f"{name}.npz", **{k: v.astype(np.float32) if v.dtype != bool else v for k, v in payload(n).items()})
        (root / f"{name}.json").write_text(json.dumps({"metadata:vad": [{"start": 1.0, "end": 2.5}, {"start": 5.0, "end": 11.5}]}))
    (root / "torn.npz").write_bytes(b"PK nothing")
    frames, voice = bundles.read_poses(spark, str(root)), bundles.read_intervals(spark, str(root))
    t = {r.frame: r for r in tracks.pose_tracks(frames.filter("file_id = 'good'"), voice, skeleton()).collect()}
    files, windows = tracks.scan(frames, voice, skeleton(), FPS, 10.0, 2.0)
    return t, files.collect(), windows.collect()


def test_tracks_of_a_bundle_equal_the_plain_ones(scanned):
    t, want = scanned[0], plain(payload())[0]
    assert sorted(t) == list(range(420))
    for name, w in want.items():
        got = np.array([np.nan if t[i][name] is None else float(t[i][name]) for i in range(420)])
        np.testing.assert_allclose(got, w, rtol=1e-5, atol=1e-4, err_msg=name)
    assert want["active"].any() and not want["active"].all() and want["hand_frozen"].sum() == 10


def test_windows_of_a_scan(scanned):
    _, files, windows = scanned
    assert {(r.file_id, r.scan_status if "torn" not in r.file_id else "torn", r.window_count) for r in files} == {("good", "ok", 3), ("brief", "too_few_frames:100", 0), ("torn", "torn", 0)}
    want, wrists = plain(payload())
    for r in windows:
        at = slice(r.start_frame, r.end_frame)
        talk = want["speech"][at] > 0
        assert (r.file_id, r.gesture_status, r.window_frames) == ("good", "ok", 300)
        assert r.arm_speed_p50_mm_s == pytest.approx(np.median(want["arm_speed"][at]), rel=1e-5)
        assert r.gesture_frac_speech == pytest.approx(want["active"][at][talk].mean())
        assert r.consistency_r == pytest.approx(np.corrcoef(want["arm_speed"][at], want["arm_speed_2d"][at])[0, 1], abs=1e-5)
        pool = np.concatenate([want["step_cosine"][at], want["step_cosine_right"][at]])
        assert r.step_cosine_n == np.isfinite(pool).sum() and r.step_cosine_p50 == pytest.approx(np.nanmedian(pool), abs=1e-4)
        far = np.max([np.linalg.norm(w[at] - np.median(w[at], axis=0), axis=1) for w in wrists], axis=0)
        assert r.wrist_excursion_p90_mm == pytest.approx(np.percentile(far, 90), rel=1e-4)
        assert r.wrist_range_mm == pytest.approx(max(np.linalg.norm(np.ptp(w[at], axis=0)) for w in wrists), rel=1e-4)
        samples = [w[at][talk][::75] for w in wrists]
        spread = max(np.mean([np.linalg.norm(a - b) for k, a in enumerate(s) for b in s[k + 1 :]]) for s in samples) if len(samples[0]) >= 3 else None
        assert r.posture_spread_mm == (None if spread is None else pytest.approx(spread, rel=1e-4))
        assert r.hand_artic_p75_rad_s == pytest.approx(np.percentile(want["hand_speed"][at], 75), rel=1e-4)
    assert len(windows) == 3


def test_a_stiff_hand_on_a_swinging_arm_has_no_finger_speed(spark):
    n = 60
    rows = [("f", i, [0.0] * 45 + [0.0, 0.0, float(np.sin(i / 5))] + [0.0] * 15, [0.1] * 45, [0.1] * 45, [1.0] * 399, True, True) for i in range(n)]
    df = spark.createDataFrame(rows, "file_id string, frame int, body array<double>, left array<double>, right array<double>, keypoints array<double>, smplh_valid boolean, box_valid boolean")
    t = tracks.pose_tracks(df, spark.createDataFrame([], "file_id string, start double, end double"), skeleton()).agg(F.max("hand_speed"), F.max("arm_speed")).head()
    assert t[0] < 1e-5 and t[1] > 100


def test_window_statuses_and_empty_tables(spark):
    cols = ", ".join([*(f"{c} double" for c in (*measures.POINTS, *measures.NUMBERS)), *(f"{c} boolean" for c in measures.FLAGS)])
    rows = [("a", k, *[None if k % 2 else 1.0] * 25, *[None] * 5) for k in range(100)]
    df = spark.createDataFrame(rows, f"file_id string, frame int, {cols}")
    r = measures.window_measures(df, 60, 30).orderBy("window_index").collect()
    assert [x.window_index for x in r] == [0, 1] and r[0].gesture_status == "ok" and r[0].gesture_frac is None and r[0].episode_count == 0 and r[0].consistency_r is None and r[0].sync_r is None
    assert {x.gesture_status for x in measures.window_measures(df, 30, 10).collect()} == {"window_too_short:30"}
    assert measures.window_measures(df.limit(0), 60, 30).count() == 0
