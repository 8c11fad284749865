import random

from kinesift.operators.intervals import coverage, merge_intervals
from kinesift.session import table


def brute(rows):
    out = set()
    by = {}
    for e, s, t in rows:
        if e is not None and s is not None and t is not None and t > s:
            by.setdefault(e, set()).update(range(s, t))
    for e, cells in by.items():
        runs, cells = [], sorted(cells)
        for c in cells:
            if runs and runs[-1][1] == c:
                runs[-1][1] = c + 1
            else:
                runs.append([c, c + 1])
        out |= {(e, False, a, b) for a, b in runs}
        out |= {(e, True, x[1], y[0]) for x, y in zip(runs, runs[1:])}
    return out


def test_against_brute_force_over_block_borders(spark):
    rng = random.Random(4)
    rows = [(f"e{rng.randrange(3)}", s := rng.randrange(-40, 200), s + rng.randrange(-3, 12)) for _ in range(150)]
    rows += rows[:20] + [(None, 1, 2), ("e0", None, 5), ("e0", 5, None)]
    df = spark.createDataFrame(rows, "who string, a bigint, b bigint")
    for block in (1, 7, 64, 1 << 16):
        got = [tuple(r) for r in merge_intervals(df, "who", "a", "b", block=block).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_touching_nested_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([("x", 0, 5, 1), ("x", 5, 8, 1), ("x", 1, 2, 1), ("x", 9, 9, 1)], "entity string, pos int, delta int, block int")
    got = {tuple(r) for r in merge_intervals(df, "entity", "pos", "delta").collect()}
    assert got == {("x", False, 0, 8)}
    assert merge_intervals(df.limit(0), "entity", "pos", "delta").count() == 0


def test_coverage_ignores_unmeasured_ends(spark):
    clips = spark.createDataFrame([("f", 0, 10), ("f", 20, None), ("f", 30, 25), ("f", 12, 14)], "file_id string, start_frame int, end_frame int")
    nan, inf = float("nan"), float("inf")
    speech = spark.createDataFrame([("c", 0.001, 0.002), ("c", 0.002, 0.004), ("c", 1.0, nan), ("c", 1.0, inf), ("c", None, 2.0)], "clip_id string, start_s double, end_s double")
    got = {tuple(r) for r in coverage(clips, speech).collect()}
    assert got == {("f", "clip_period", 0, 10), ("f", "clip_gap", 10, 12), ("f", "clip_period", 12, 14), ("c", "speech_period", 1, 4)}


def test_on_tables(spark, sf):
    assert coverage(table(spark, sf, "clips_accepted"), table(spark, sf, "clip_speech")).count() > 0
