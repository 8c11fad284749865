import random

import numpy as np
import pytest

from kinesift.llm import consensus, percentiles


def test_multi_select_is_exact_and_states_merge(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), d, rng.choice([0.0, -0.0, rng.gauss(0, 5), 2.5])) for d in ("d1", "d2", "d3") for _ in range(700)]
    rows += [("c", "d1", 4.0), ("e", "d1", None), ("e", "d1", float("nan")), ("a", "d1", float("inf"))]
    df = spark.createDataFrame(rows, "g string, day string, x double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    days = percentiles.state(df, ["g", "day"], "x")
    whole = percentiles.merge_states(days, ["g"])
    want = {}
    for g in {r[0] for r in rows} - {"e"}:
        v = [r[2] for r in rows if r[0] == g and r[2] is not None and np.isfinite(r[2])]
        want |= {(g, p): (np.percentile(v, p * 100), len(v)) for p in probs}
    for settle, fragment in ((4096, 1 << 20), (3, 100), (0, 1)):  # at once, by rounds of pivots, down to the last value
        got = {(r.g, r.prob): (r.percentile, r.n_values) for r in percentiles.percentiles(whole, ["g"], probs, settle=settle, fragment=fragment).collect()}
        assert set(got) == set(want)
        assert all(got[k][1] == want[k][1] and got[k][0] == pytest.approx(want[k][0], abs=1e-9) for k in want)


def test_rounded_states_keep_their_error(spark):
    v = np.random.default_rng(2).normal(0, 10, 2000)
    df = spark.createDataFrame([(float(x),) for x in v], "x double").selectExpr("1 AS g", "x")
    s = percentiles.state(df, ["g"], "x", resolution=0.5)
    assert s.count() < 200
    for r in percentiles.percentiles(s, ["g"], [0.05, 0.5, 0.95]).collect():
        assert abs(r.percentile - np.percentile(v, r.prob * 100)) <= 0.25 + 1e-9
    assert percentiles.percentiles(s.limit(0), ["g"], [0.5]).count() == 0


def votes(seed=3, items=400):
    rng = np.random.default_rng(seed)
    types = [(0.97, 0.97)] * 4 + [(0.85, 0.85)] * 6 + [(0.5, 0.5)] * 5 + [(0.98, 0.2)] * 3 + [(0.1, 0.1)] * 2
    truth = rng.random(items) < 0.6
    rows = []
    for i in range(items):
        for w in rng.choice(len(types), 6, replace=False):
            p = types[w][0] if truth[i] else 1 - types[w][1]
            rows.append((f"i{i}", f"w{w}", int(rng.random() < p)))
    return rows, {f"i{i}": bool(t) for i, t in enumerate(truth)}, types


def test_consensus_beats_the_majority_and_knows_its_annotators(spark):
    rows, truth, types = votes()
    rows += [("solo", "new", 1), (None, "w1", 1), ("i1", None, 0), ("i2", "w9", 7)]
    c = consensus.consensus(spark.createDataFrame(rows, "item string, who string, y int"))
    items = {r.item: r for r in c.items.collect()}
    mixed = [i for i in truth if items[i].n_accept and items[i].n_reject]
    ours = np.mean([(items[i].accept_probability > 0.5) == truth[i] for i in mixed])
    majority = np.mean([(items[i].n_accept > items[i].n_reject) == truth[i] for i in mixed])
    assert ours > 0.93 and ours > majority + 0.05
    a = {r.who: r for r in c.annotators.collect()}
    assert a["w0"].reliability > 0.9 and a["w18"].reliability < 0.25 and a["w15"].specificity < 0.45 < a["w15"].sensitivity
    assert 0.05 < a["new"].reliability < 0.99 and a["new"].n_labels == 1  # leans on its type


def test_consensus_of_nothing(spark):
    c = consensus.consensus(spark.createDataFrame([], "item string, who string, y int"))
    assert c.items.count() == 0 and c.annotators.count() == 0


def test_standing_verdicts(spark):
    rows = [
        (1, "r", " ACCEPT ", "Ann ", "human", "2015-01-02T00:00:00Z"),
        (2, "r", "reject", "ann", "human", "2015-01-01T00:00:00+00:00"),
        (3, "r", "unsure", "bob", "human", "n/a"),
        (4, "r", "reject", "BOB", "human", "yesterday"),
        (5, "s", "accept", None, None, "2015-01-02T00:00:00Z"),
        (6, "s", None, "ann", None, "2015-01-02T00:00:00Z"),
        (7, "t", "accept", "ann", None, "2015-01-02T00:00:00Z"),
        (8, "t", "reject", "ann", None, "2015-01-02T00:00:00Z"),
    ]
    log = spark.createDataFrame(rows, "log_line bigint, review_item_id string, verdict string, reviewer string, verdict_source string, recorded_utc string")
    assert {(r.item, r.who, r.label) for r in consensus.standing_verdicts(log).collect()} == {("r", "ann", "accept"), ("r", "bob", "reject"), ("t", "ann", "reject")}
    a = {r.item: r for r in consensus.agreement(consensus.votes_of(log)).collect()}
    assert a["r"].agreement == 0 and a["t"].agreement is None
    alpha = consensus.krippendorff_alpha(consensus.votes_of(log)).head()
    assert alpha.n_items == 1 and alpha.alpha == pytest.approx(0.0)


def test_digamma():
    x = [0.05, 0.7, 1.0, 3.3, 250.0]
    want = [-20.4978449, -1.2200236, -0.5772157, 1.0347682, 5.5194598]
    assert np.allclose(consensus.digamma(np.array(x)), want, atol=2e-3)


def test_rounds_that_end_early_are_said(spark):
    rows, _, _ = votes(8, 120)
    df = spark.createDataFrame(rows, "item string, who string, y int")
    with pytest.warns(UserWarning, match="not settled"):
        assert not consensus.consensus(df, rounds=1).settled
    c = consensus.consensus(df, rounds=60)
    assert c.settled and 1 < c.rounds < 60
    assert consensus.consensus(df.limit(0)).settled
