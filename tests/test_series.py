import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kinesift.operators import series, windows


@pytest.fixture(scope="module")
def track():
    rng = np.random.default_rng(3)
    parts = []
    for k, n in (("a", 400), ("b", 4), ("c", 131)):
        parts.append(pd.DataFrame({"k": k, "t": np.arange(n), "x": rng.normal(size=n), "y": rng.normal(size=n), "m": rng.random(n) < 0.6}))
    return pd.concat(parts)


def small_blocks(monkeypatch):
    monkeypatch.setattr(series, "BLOCK", 50)
    init = series.Blocks.__init__
    monkeypatch.setattr(series.Blocks, "__init__", lambda self, df, key, order, halo=16, block=50: init(self, df, key, order, halo, block))


def collect(df, *cols):
    return {(r.k, r.t): tuple(r[c] for c in cols) for r in df.collect()}


def test_smooth_speed_travel_against_numpy(spark, track, monkeypatch):
    small_blocks(monkeypatch)
    df = spark.createDataFrame(track)
    smooth = collect(series.hann_smooth(df, "k", "t", ["x"]), "x_smooth")
    speed = collect(series.central_speed(df, "k", "t", ["x", "y"], 30.0), "speed")
    travel = collect(series.rolling_travel(df, "k", "t", ["x", "y"], 7), "travel")
    w = np.array([1, 3, 4, 3, 1]) / 12
    for k, g in track.groupby("k"):
        x, y, n = g.x.to_numpy(), g.y.to_numpy(), len(g)
        e = np.r_[[x[0]] * 2, x, [x[-1]] * 2]
        want = np.array([e[i : i + 5] @ w for i in range(n)]) if n > 5 else x
        assert np.allclose([smooth[k, t][0] for t in range(n)], want)
        v = np.zeros(n)
        if n > 4:
            v[2:-2] = np.hypot(x[4:] - x[:-4], y[4:] - y[:-4]) * 7.5
            v[:2], v[-2:] = v[2], v[-3]
        assert np.allclose([speed[k, t][0] for t in range(n)], v)
        tr = [np.hypot(np.ptp(x[max(0, i - 7) : i + 8]), np.ptp(y[max(0, i - 7) : i + 8])) for i in range(n)]
        assert np.allclose([travel[k, t][0] for t in range(n)], tr)


def test_runs_and_closing_against_loops(spark, track):
    df = spark.createDataFrame(track)
    got = {tuple(r) for r in series.runs(df, "k", "t", F.col("m"), block=37).collect()}
    want, closed = set(), set()
    for k, g in track.groupby("k"):
        m = np.r_[False, g.m.to_numpy(), False].astype(int)
        edges = np.flatnonzero(np.diff(m))
        runs = list(zip(edges[::2], edges[1::2]))
        want |= {(k, int(a), int(b)) for a, b in runs}
        joined = []
        for a, b in runs:
            if joined and a - joined[-1][1] <= 2:
                joined[-1][1] = b
            else:
                joined.append([a, b])
        closed |= {(k, int(a), int(b)) for a, b in joined if b - a >= 6}
    assert got == want
    stretches = series.runs(df, "k", "t", F.col("m"))
    assert {tuple(r) for r in series.close_open(stretches, "k", 2, 6).collect()} == closed
    inside = series.in_stretches(df.select("k", "t"), series.close_open(stretches, "k", 2, 6), "k", "t", "z", block=16)
    assert inside.filter("z").count() == sum(b - a for _, a, b in closed) and inside.count() == len(track)


def test_forward_fill_and_asof(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 0, None), ("a", 1, nan), ("a", 2, 5.0), ("a", 3, None), ("a", 9, None), ("b", 0, None)], "k string, t bigint, v double")
    got = {(r.k, r.t): r.filled for r in series.forward_fill(df, "k", "t", "v", block=2).collect()}
    assert got == {("a", 0): 5.0, ("a", 1): 5.0, ("a", 2): 5.0, ("a", 3): 5.0, ("a", 9): 5.0, ("b", 0): 0.0}
    right = spark.createDataFrame([("a", 3, 1.0), ("a", 7, 2.0), ("a", 7, 9.0)], "k string, t bigint, v double")
    left = spark.createDataFrame([("a", 0), ("a", 3), ("a", 6), ("a", 7), ("z", 1)], "k string, t bigint")
    got = {(r.k, r.t): r.h for r in series.asof_join(left, right, "k", "t", "v", "h", 2).collect()}
    assert got == {("a", 0): 1.0, ("a", 3): 1.0, ("a", 6): 1.0, ("a", 7): 9.0, ("z", 1): None}


def test_windows_tile_and_drop_the_tail(spark):
    n = spark.createDataFrame([(100,), (20,), (30,)], "n int")
    assert [r[0] for r in n.select(windows.sliding_windows("n", 30, 10)).collect()] == [list(range(0, 71, 10)), [], [0]]
    df = spark.createDataFrame([("a", t) for t in range(47)], "k string, t int")
    counts = {r.window_index: r["count"] for r in windows.to_windows(df, "k", "t", 30, 10).groupBy("window_index").count().collect()}
    assert counts == {0: 30, 1: 30}


def test_frozen_needs_measured_values(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 0, [1.0]), ("a", 1, [1.0]), ("a", 2, [nan]), ("a", 3, [nan]), ("a", 4, [2.0])], "k string, t int, v array<double>")
    assert [r.frozen for r in series.frozen(df, "k", "t", "v").orderBy("t").collect()] == [False, True, False, False, False]


def test_neighbours_count_by_rows_at_any_gap(spark):
    from kinesift.operators import geometry

    rng = np.random.default_rng(5)
    n = 300
    rows = pd.DataFrame({"k": "a", "t": np.arange(n), "x": rng.normal(size=n), "y": rng.normal(size=n), "z": rng.integers(0, 2, size=n).astype(float)})
    rows["v"] = list(rng.normal(size=(n, 3)))
    dense = spark.createDataFrame(rows)
    wide = dense.withColumn("t", F.col("t") * 997 - 40_000)
    for run, name in (
        (lambda d: series.hann_smooth(d, "k", "t", ["x"]), "x_smooth"),
        (lambda d: series.central_speed(d, "k", "t", ["x", "y"], 30.0), "speed"),
        (lambda d: series.rolling_travel(d, "k", "t", ["x", "y"], 70), "travel"),
        (lambda d: series.step_cosine(d, "k", "t", ["x", "y"]), "cosine"),
        (lambda d: series.frozen(d, "k", "t", "z"), "frozen"),
        (lambda d: geometry.angular_speed(d, "k", "t", "v", 0, 30.0), "angular_speed"),
    ):
        got, want = ([r[name] for r in run(d).orderBy("t").collect()] for d in (wide, dense))
        assert got == want and len(got) == n, name
