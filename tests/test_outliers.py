import math

import numpy as np
import pandas as pd

from kinesift.operators.outliers import FIELDS, equal_runs, implausible_readings, tail_cutoff

SCHEMA = "file_id string, frame int, arm_speed double, step_cosine double, step_cosine_right double, hand_frozen boolean, field int, block int"


def made(n=6000, seed=1):
    rng = np.random.default_rng(seed)
    level = np.exp(np.cumsum(rng.normal(0, 0.02, n))) * 100
    level[n // 3 : n // 3 + 400] *= 5  # lasting lively motion
    x = level * np.exp(rng.normal(0, 0.12, n))
    cos = np.clip(np.cumsum(rng.normal(0, 0.02, n)) % 1.0 * 0.5 + rng.normal(0, 0.1, n), -0.99, 0.99)
    f = pd.DataFrame({"file_id": "f", "frame": np.arange(n), "arm_speed": x, "step_cosine": cos, "step_cosine_right": cos[::-1], "hand_frozen": False})
    want = set()
    for k in (50, 1234, n // 2 + 1, n // 2 + 2, n - 100):
        f.loc[k, "arm_speed"] *= 20
        want.add((k, "arm_speed"))
    f.loc[300, "arm_speed"] = -3.0
    want.add((300, "arm_speed"))
    f.loc[2550:2575, "step_cosine"] = 0.25  # a stuck stretch over a block border
    f.loc[2560, "step_cosine"] = np.nan
    want |= {(k, "step_cosine") for k in range(2550, 2576) if k != 2560}
    f.loc[700:702, "step_cosine_right"] = 0.1  # a few equal neighbours
    f.loc[900, "step_cosine_right"] = 1.7
    want.add((900, "step_cosine_right"))
    f.loc[100:180, "hand_frozen"] = True
    want |= {(k, "hand_frozen") for k in range(100, 181)}
    f.loc[1000:1400:2, "hand_frozen"] = True  # alternating freezes
    f.loc[2700:2703, "hand_frozen"] = True
    return f.assign(field=0, block=0), want


def test_planted_faults_and_nothing_else(spark):
    f, want = made()
    f = pd.concat([f, f.iloc[:50]]).sample(frac=1, random_state=3)  # repeated rows, out of order
    got = {(r.frame, r.field_name) for r in implausible_readings(spark.createDataFrame(f, SCHEMA)).collect()}
    assert want <= got
    assert len(got - want) <= 2


def test_block_size_does_not_matter(spark):
    f, _ = made(3000, 5)
    df = spark.createDataFrame(f, SCHEMA)
    assert {(r.frame, r.field_name) for r in implausible_readings(df, block=2560).collect()} >= _
    a = {tuple(r) for r in implausible_readings(df, block=512).collect()}
    b = {tuple(r) for r in implausible_readings(df, block=4096).collect()}
    assert a == b


def noisy(name, n, spread, seed):
    rng = np.random.default_rng(seed)
    x = 100 * np.exp(rng.normal(0, spread, n))
    return pd.DataFrame({"file_id": name, "frame": np.arange(n), "arm_speed": x, "step_cosine": np.nan, "step_cosine_right": np.nan, "hand_frozen": False, "field": 0, "block": 0})


def test_equal_residuals_are_judged_by_their_own_file(spark):
    quiet, lively = noisy("quiet", 3000, 0.05, 1), noisy("lively", 3000, 0.3, 2)
    for f in (quiet, lively):
        f.loc[1500, "arm_speed"] = f.loc[1485:1515, "arm_speed"].median() * math.exp(0.9)
    got = {(r.file_id, r.frame) for r in implausible_readings(spark.createDataFrame(pd.concat([quiet, lively]), SCHEMA)).collect()}
    assert got == {("quiet", 1500)}


def test_spikes_of_a_lively_block_in_a_quiet_file_are_read_again(spark):
    f = noisy("f", 8192, 0.05, 3)
    rough = np.random.default_rng(4).normal(0, 0.6, 512)
    f.loc[4096:4607, "arm_speed"] *= np.exp(rough)  # NOTABLE times this block's spread is more than the file's cutoff
    df = spark.createDataFrame(f, SCHEMA)
    a = {tuple(r) for r in implausible_readings(df, block=512).collect()}
    b = {tuple(r) for r in implausible_readings(df, block=8192).collect()}
    assert a == b and len(a) > 50


def test_sparse_series_do_not_depend_on_blocks(spark):
    f = noisy("f", 2400, 0.1, 6)
    f = f.assign(frame=f.frame * 37 + (f.frame % 5) * 3)  # few readings within reach of each
    f.loc[1200, "arm_speed"] *= 30
    df = spark.createDataFrame(f, SCHEMA)
    a, b = ({tuple(r) for r in implausible_readings(df, block=k).collect()} for k in (512, 1 << 20))
    assert a == b == {("f", int(f.frame[1200]), "arm_speed")}


def test_nulls_short_files_and_empty(spark):
    nan = float("nan")
    rows = [("a", k, None if k % 2 else nan, nan, None, False, 0, 0) for k in range(40)] + [("b", 0, 5.0, 0.1, 0.1, True, 0, 0), (None, 1, -1.0, 0.0, 0.0, False, 0, 0), ("c", None, -1.0, 0.0, 0.0, False, 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert implausible_readings(df).count() == 0
    assert implausible_readings(df.limit(0)).count() == 0


def test_equal_runs():
    assert equal_runs(np.arange(6), np.array([1, 1, 2, 2, 2, 1.0])).tolist() == [2, 2, 3, 3, 3, 1]
    assert equal_runs(np.array([0, 1, 30]), np.ones(3)).tolist() == [2, 2, 1]
    assert equal_runs(np.zeros(0), np.zeros(0)).tolist() == []


def test_tail_cutoff_holds_its_risk():
    r = np.random.default_rng(2).normal(0, 0.1, 200_000)
    at, n = np.unique(np.rint(r / 0.01).astype(int), return_counts=True)
    c = tail_cutoff(at, n, 1e-5, 1)
    assert 0.3 < c < 1.0 and (r > c).mean() < 1e-4
    assert math.isfinite(tail_cutoff(np.array([0]), np.array([7]), 1e-5, 1))
    assert {f.name for f in FIELDS} == {"arm_speed", "step_cosine", "step_cosine_right", "hand_frozen"}
