import random

import pytest
from pyspark.sql import functions as F

from kinesift.functions import parse
from kinesift.functions.expr import assert_unique, hash_order, ramp, require_columns
from kinesift.operators import census, rules, selection
from kinesift.operators import rule_tables as tables

CLAUSES = [("a", ">=", 1.0, "low_a"), ("b", "<=", 2.0, "high_b")]


def test_unmeasured_values_fail_every_clause(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, 2.0), (nan, 2.0), (inf, 2.0), (1.0, -inf), (None, 9.0), (1.0, 3.0)], "a double, b double")
    got = [(r.fail_reason, r.qualifies) for r in rules.apply_clauses(df, CLAUSES).collect()]
    assert got == [(None, True), ("low_a", False), ("low_a", False), ("high_b", False), ("low_a", False), ("high_b", False)]
    flags = [r.exclusion_flags for r in rules.flag_clauses(df, CLAUSES).collect()]
    assert flags == ["", "low_a", "low_a", "high_b", "low_a;high_b", "high_b"]
    f = {r.stage: r.n for r in rules.funnel(rules.apply_clauses(df, [*CLAUSES, ("a", ">=", -9.0, "never")]), "fail_reason", ["low_a", "high_b", "never"]).collect()}
    assert f == {"low_a": 3, "high_b": 2, "never": 0, "qualifies": 1}
    with pytest.raises(KeyError, match="zz"):
        rules.apply_clauses(df, [("zz", ">=", 0.0, "x")])


def test_scores_are_strict_about_missing_parts(spark):
    df = spark.createDataFrame([(0.5, 10.0), (0.5, None), (float("inf"), 10.0)], "a double, b double")
    q = rules.weighted_quality({"x": ("a", 0.0, 1.0), "y": ("b", 0.0, 40.0)}, {"d": ("x",), "e": ("y",)}, {"d": 3.0, "e": 1.0})
    assert [r[0] for r in df.select(q).collect()] == [(0.5 * 3 + 0.25) / 4, None, None]
    assert [r[0] for r in df.select(rules.additive_score([("a", 1.0, 0.6), ("b", 20.0, 0.4)])).collect()] == [0.5, 0.0, 0.0]
    assert [r[0] for r in df.select(ramp("a", 0.0, 0.5)).collect()] == [1.0, 1.0, None]
    assert [r[0] for r in df.select(rules.ratio_floored("b", "a")).collect()] == [10.0, None, None]


def test_every_gate_and_disqualifier_has_its_own_reason(spark):
    ok = {c: lim + (1.0 if op == ">=" else -0.01) for c, op, lim, _ in tables.GATES} | {"gesture_status": "ok"}
    rows = [ok | {"name": ""}] + [ok | {c: lim - 0.5 if op == ">=" else lim + 0.5, "name": label} for c, op, lim, label in tables.GATES]
    rows += [ok | {"gesture_status": s, "name": tables.UNMEASURABLE} for s in ("window_too_short:9", None)]
    df = spark.createDataFrame([tuple(r[k] for k in sorted(ok | {"name": 0})) for r in rows], ", ".join(f"{k} {'string' if k in ('name', 'gesture_status') else 'double'}" for k in sorted(ok | {"name": 0})))
    assert all((r.fail_reason or "") == r.name and r.qualifies == (r.name == "") for r in rules.gate(df).collect())
    good = {c: hi + 1.0 for c, _, hi in tables.RAMPS.values()} | {c: lim + 1.0 for c, _, lim, _ in tables.DISQUALIFIERS if c not in ("articulation_ratio", "gesture_quality")}
    good |= {"arm_speed_p50_mm_s": 50.0, "torso_travel_mm_s_p50": 0.1}  # a torso that is still counts 1
    parts = [(c, label) for c, _, _, label in tables.DISQUALIFIERS if c in good]
    cases = [good | {"name": ""}] + [good | {c: -1000.0, "name": label} for c, label in parts] + [good | {"arm_speed_p50_mm_s": 1.5, "name": "motion_is_global"}]
    cases += [good | {"wrist_range_mm": None, "name": "below_quality_threshold"}]
    names = sorted(good) + ["name"]
    df = spark.createDataFrame([tuple(r[k] for k in names) for r in cases], ", ".join(f"{k} {'string' if k == 'name' else 'double'}" for k in names))
    assert all(r.fail_stage == r.name and r.qualified == (r.name == "") for r in rules.qualify(df).collect())
    with pytest.raises(KeyError, match="torso_travel_mm_s_p50, wrist_range_mm"):
        rules.qualify(df.drop("torso_travel_mm_s_p50", "wrist_range_mm"))


def test_population_takes_the_first_reason_and_fills_columns(spark):
    ok = dict(file_id="f", all_modalities_present=True, video_stream_present=True, probe_status="ok", video_width=1080, video_height=1920, video_r_fps=30.0, video_nb_frames=1800.0, observed_duration_s=60.0, video_duration_s=60.2, interaction_type="x")
    cases = [({}, None), ({"all_modalities_present": None}, "incomplete_bundle"), ({"video_stream_present": False}, "no_video_stream"), ({"probe_status": None}, "probe_failed"), ({"video_width": 640, "video_height": 480}, "excluded_raster")]
    cases += [({"video_r_fps": 61.5}, "unusable_frame_rate"), ({"video_r_fps": float("nan")}, "unusable_frame_rate"), ({"video_nb_frames": None}, "timebase_drift"), ({"video_duration_s": 61.0}, "timebase_drift"), ({"video_duration_s": None}, None)]
    cases += [({"interaction_type": "charades"}, "no_speech_activity"), ({"interaction_type": None}, None), ({"observed_duration_s": 39.9}, "too_short"), ({"observed_duration_s": None}, "too_short")]
    rows = [ok | x | {"label": str(k)} for k, (x, _) in enumerate(cases)]
    types = {"all_modalities_present": "boolean", "video_stream_present": "boolean", "video_width": "int", "video_height": "int", "video_r_fps": "double", "video_nb_frames": "double", "observed_duration_s": "double", "video_duration_s": "double"}
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} {types.get(k, 'string')}" for k in rows[0]))
    out = rules.population(df)
    assert out.columns == list(tables.POPULATION) and out.filter("session_id IS NOT NULL").count() == 0
    got = {int(r.label): (r.ineligible_reason, r.eligible) for r in out.collect()}
    assert got == {k: (want, want is None) for k, (_, want) in enumerate(cases)}
    assert rules.population(df.drop("video_duration_s")).filter("label = '8' AND eligible").count() == 1


def test_wilson(spark):
    df = spark.createDataFrame([(0, 0), (77, 90), (5, 5)], "k int, n int")
    lo, hi = rules.wilson("k", "n")
    got = [(round(r[0], 4), round(r[1], 4)) for r in df.select(lo, hi).collect()]
    assert got == [(0.0, 1.0), (0.7684, 0.9136), (0.5655, 1.0)]


def greedy(rows, most):
    out = set()
    by = {}
    for k, s, t, q, tie in set(rows):
        by.setdefault(k, []).append((-q, tie, s, t))
    for k, xs in by.items():
        taken = []
        for _, _, s, t in sorted(xs):
            if len(taken) < most and all(not (s < b and a < t) for a, b in taken):
                taken.append((s, t))
        out |= {(k, a, b) for a, b in taken}
    return out


def test_disjoint_selection_equals_the_greedy_loop(spark):
    rng = random.Random(7)
    rows = [(f"f{rng.randrange(4)}", s := rng.randrange(0, 400), s + rng.randrange(5, 40), rng.randrange(5) / 4, f"{rng.random():.6f}") for _ in range(160)]
    df = spark.createDataFrame(rows + rows[:9], "f string, s int, t int, q double, tie string")
    for most in (3, 100):
        got = {(r.f, r.start, r.stop) for r in selection.select_disjoint(df, "f", "s", "t", "q", F.col("tie"), most).collect()}
        assert got == greedy(rows, most)


def test_ranks_and_samples(spark):
    df = spark.createDataFrame([(k, k % 7) for k in range(500)], "id int, g int").repartition(6)
    r = {x.id: x.rank for x in selection.global_rank(df, [F.desc("g"), F.col("id")]).collect()}
    order = sorted(range(500), key=lambda k: (-(k % 7), k))
    assert all(r[k] == i for i, k in enumerate(order))
    a = [x.id for x in selection.seeded_sample(df, "id", "s", 20).collect()]
    assert a == [x.id for x in selection.seeded_sample(df.repartition(3), "id", "s", 20).collect()] and len(set(a)) == 20
    rr = {x.id: x.review_rank for x in selection.round_robin(df, "g", [F.col("id")], "s", "id", 3).collect()}
    assert len(rr) == 21 and {k % 7 for k, v in rr.items() if v < 7} == set(range(7))
    plan = spark.range(1).select(selection.task_plan(129370, 512).alias("p")).head().p
    sizes = [x.stop - x.start for x in plan]
    assert sizes.count(253) == 346 and sizes.count(252) == 166 and plan[-1].stop == 129370


def test_census_helpers(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, w int")
    assert {(r.k, r.v, r.w) for r in census.null_safe_left(a, b, ["k"]).collect()} == {(None, 1, 10), ("x", 2, 20)}
    with pytest.raises(ValueError, match="repeats"):
        assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])
    with pytest.raises(KeyError):
        require_columns(a, ["nope"])
    p = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "c"), ("i", "d"), ("i", "e"), ("i", "f")], "g string, id string")
    assert {(r.id, r.partner_id) for r in census.partners(p, ["g"], "id", []).collect()} == {("a", "b"), ("b", "a")}
    r = spark.createDataFrame([(["x", "y"],), ([],), (None,)], "reasons array<string>")
    assert {(x.reason, x.n) for x in census.reason_histogram(r, "reasons").collect()} == {("x", 1), ("y", 1), ("unspecified", 2)}
    assert [x[0] for x in spark.createDataFrame([("7",), ("V12",), ("x",), ("12345",)], "s string").select(census.normalised_key("s", 4, "V")).collect()] == ["0007", "0012", None, "12345"]


def test_parsing(spark):
    df = spark.createDataFrame([("30000/1001",), ("25",), ("0/0",), ("N/A",), ("",), (None,), ("1/x",)], "r string")
    assert [r[0] if r[0] is None else round(r[0], 3) for r in df.select(parse.rate("r")).collect()] == [29.97, 25.0, None, None, None, None, None]
    t = spark.createDataFrame([("False",), (" TRUE ",), ("y",), (None,)], "t string")
    assert [r[0] for r in t.select(parse.truth("t")).collect()] == [False, True, True, False]
    i = spark.createDataFrame([("V01_S0002_I00000003_P0004A",), ("bad",)], "f string")
    assert [tuple(r) for r in i.select(*parse.file_id_parts("f").values()).collect()] == [("01", "0002", "00000003", "0004A"), (None,) * 4]
    d = spark.createDataFrame([("2015-01-01T00:00:00Z",), ("2015-01-01T01:00:00+01:00",), ("yesterday",), ("n/a",)], "t string")
    assert [r[0] for r in d.select(F.unix_seconds(parse.instant("t"))).collect()] == [1420070400, 1420070400, None, None]
    h = spark.createDataFrame([("a",), (None,)], "k string").select(parse.blake_key("k"), parse.unit_interval(parse.blake_key("k")), hash_order("s", "k")).collect()
    assert len(h[0][0]) == 16 and 0 <= h[0][1] < 1 and len(h[0][2]) == 64
