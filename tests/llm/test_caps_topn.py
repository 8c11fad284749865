import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinesift.llm import caps, topn
from kinesift.llm.queries import QUERIES, SQL


def plain_top(rows, n):
    by = defaultdict(set)
    for g, s, t in rows:
        if g is not None and t is not None and s is not None and s == s and abs(s) != float("inf"):
            by[g].add((-s, t))
    return {(g, t, -q, k + 1, len(x) > n) for g, x in by.items() for k, (q, t) in enumerate(sorted(x)[:n])}


def test_loser_tree_merges_and_seeks():
    rng = random.Random(1)
    for k in (1, 2, 3, 8, 13):
        rows = [(f"g{rng.randrange(5)}", -rng.randrange(6) / 2, f"t{rng.randrange(9)}") for _ in range(rng.randrange(1, 90))]
        runs = [sorted(rows[i::k]) for i in range(k)]
        got = set(topn.merge_top(runs, 3))
        assert got == plain_top([(g, -q, t) for g, q, t in rows], 3)
    assert list(topn.merge_top([], 3)) == [] and list(topn.merge_top([[], []], 3)) == []


@pytest.mark.parametrize("run_rows", [7, 100_000])
def test_top_n_with_ties_copies_and_a_hot_group(spark, run_rows):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(40)}", rng.choice([0.5, 0.25, 0.75, rng.random()]), f"é{rng.randrange(300):03d}") for _ in range(1500)]
    rows += rows[:200] + [("a", float("nan"), "x"), ("a", float("inf"), "y"), ("a", None, "z"), (None, 1.0, "t"), ("b", 1.0, None)]
    df = spark.createDataFrame(rows, "g string, score double, tie string").withColumn("rank", F.lit("clash")).repartition(5)
    got = [tuple(r) for r in topn.top_n(df, "g", "score", "tie", 5, run_rows=run_rows).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_top(rows, 5)
    assert topn.top_n(df.limit(0), "g", "score", "tie", 5).count() == 0
    assert topn.top_n(df, "g", "score", "tie", 0).count() == 0


def test_large_levels_and_many_strata_give_the_same(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(f"r{k:04d}", "big" if k % 10 < 7 else f"c{k % 40}", rng.choice("xy"), rng.choice([0.5, 0.5, 0.5, None, rng.random()])) for k in range(1200)]
    df = spark.createDataFrame(rows, "id string, who string, topic string, q double")
    want = {tuple(r) for r in caps.stratified_cap(df, ["who"], "id", "q", cap=90, strata=["topic"]).select("id", "quota", "kept").collect()}
    monkeypatch.setattr(caps, "SMALL_CAP", 10)
    monkeypatch.setattr(caps, "MOST_STRATA", 1)
    assert {tuple(r) for r in caps.stratified_cap(df, ["who"], "id", "q", cap=90, strata=["topic"]).select("id", "quota", "kept").collect()} == want


def test_runs_far_beyond_one_merge_are_merged_in_levels(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", f"g{rng.randrange(30)}"]), rng.random(), f"t{k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, score double, tie string").repartition(4)
    got = {tuple(r) for r in topn.top_n(df, "g", "score", "tie", 3, run_rows=1, fan_in=3, buckets=3).collect()}  # thousands of runs
    assert got == plain_top(rows, 3)


def test_a_merge_holds_one_group_at_a_time():
    n, runs = 2, 50
    rows = [(0, r, k, f"g{g:03d}", 1.0 - k / 10, f"{r}-{k}") for g in range(40) for r in range(runs) for k in range(n + 1)]
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), topn._RUNS, strict=True)], schema=topn._RUNS)
    sizes = [t.num_rows for t in topn._whole_groups(iter(table.to_batches(max_chunksize=10)), 1)]
    assert sum(sizes) == len(rows) and max(sizes) == (n + 1) * runs
    out = [r for t in topn._whole_groups(iter(table.to_batches(max_chunksize=10)), 1) for b in topn.merged(t, n, True, 1) for r in b.to_pylist()]
    assert len(out) == 40 * n and all(r["has_more"] and r["score"] == 1.0 for r in out)


def quotas_by_hand(sizes, cap, equal):
    """Gives slots one by one to the stratum that is furthest below its part."""
    total = sum(sizes.values())
    if total <= cap:
        return dict(sizes)
    w = {s: 1.0 if equal else float(n) for s, n in sizes.items()}
    part, rest, left = {}, float(cap), dict(w)
    while left:
        level = rest / sum(left.values())
        full = [s for s in left if sizes[s] <= w[s] * level + 1e-12]
        if not full:
            part |= {s: w[s] * level for s in left}
            break
        for s in full:
            part[s] = float(sizes[s])
            rest -= sizes[s]
            del left[s]
    q = {s: int(p + 1e-9) for s, p in part.items()}
    for s in sorted(part, key=lambda s: (-(round(part[s] - q[s], 9)), s))[: cap - sum(q.values())]:
        q[s] += 1
    return q


@pytest.mark.parametrize("by", ["proportional", "equal"])
def test_quotas_use_the_whole_cap(spark, by):
    rng = random.Random(3)
    rows = [(f"c{c}", f"s{s}", rng.randrange(1, 30)) for c in range(12) for s in range(rng.randrange(1, 6))]
    got = defaultdict(dict)
    for r in caps.stratum_quotas(spark.createDataFrame(rows, "c string, s string, n bigint"), 17, by).collect():
        got[r.c][r.s] = r.quota
    for c in got:
        sizes = {s: n for cc, s, n in rows if cc == c}
        assert sum(got[c].values()) == min(17, sum(sizes.values()))
        assert all(got[c][s] <= n for s, n in sizes.items())
        assert sorted(got[c].values()) == sorted(quotas_by_hand(sizes, 17, by == "equal").values())


def test_cap_keeps_the_best_and_small_and_large_caps_agree(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(f"r{k:04d}", rng.choice(["big", "small", None]), rng.choice(["x", "y", None]), rng.choice([None, float("nan"), 0.5, rng.random()])) for k in range(600)]
    df = spark.createDataFrame(rows + rows[:30] + [(None, "big", "x", 1.0)], "id string, who string, topic string, q double").withColumn("kept", F.lit(1))
    a = {r.id: r.kept for r in caps.stratified_cap(df, ["who"], "id", "q", cap=50, strata=["topic"]).collect()}
    monkeypatch.setattr(caps, "SMALL_CAP", 10)
    b = {r.id: r.kept for r in caps.stratified_cap(df, ["who"], "id", "q", cap=50, strata=["topic"]).collect()}
    assert a == b and len(a) == 600
    who = {r[0]: r[1] for r in rows}
    assert set(Counter(who[i] for i, k in a.items() if k).values()) == {50}
    measured = {r[0]: r[3] for r in rows if r[3] is not None and r[3] == r[3]}
    for w in ("big", "small", None):
        for t in ("x", "y", None):
            mine = [r[0] for r in rows if r[1] == w and r[2] == t]
            best = sorted(mine, key=lambda i: (-(measured.get(i, -1.0)), i))
            n = sum(a[i] for i in mine)
            assert {i for i in mine if a[i]} == set(best[:n])
    assert caps.stratified_cap(df.limit(0), ["who"], "id", "q", cap=5).count() == 0
    assert caps.stratified_cap(df, ["who"], "id", "q", cap=0).filter("kept").count() == 0
    with pytest.raises(ValueError):
        caps.stratified_cap(df, ["who"], "id", "q")


def test_share_is_of_all_records(spark):
    df = spark.createDataFrame([(k, "a" if k < 80 else f"o{k}", k / 100) for k in range(100)], "id int, who string, q double")
    r = caps.stratified_cap(df, ["who"], "id", "q", share=0.1).collect()
    assert {x.id for x in r if x.kept and x.id < 80} == set(range(70, 80)) and sum(x.kept for x in r) == 30


def test_current_limit(spark):
    df = spark.createDataFrame([("a", 3, False), ("b", 5, True), ("c", None, True)], "run_id string, m int, is_current boolean")
    assert topn.current_limit(df, "m") == 5
    with pytest.raises(ValueError):
        topn.current_limit(df.limit(0), "m")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() >= 0
    assert set(SQL) <= set(QUERIES)
