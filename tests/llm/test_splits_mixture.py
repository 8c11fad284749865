import random

import pytest
from pyspark.sql import functions as F

from kinesift.llm import mixture, splits
from kinesift.session import table


def roots(rows):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for n, k in rows:
        if n is not None:
            a = find(("n", n))
            if k is not None:
                b = find(("k", k))
                up[max(a, b, key=str)] = min(a, b, key=str)
    groups = {}
    for n in {n for n, _ in rows if n is not None}:
        groups.setdefault(find(("n", n)), set()).add(n)
    return {n: min(g) for g in groups.values() for n in g}


def test_components_against_union_find(spark):
    rng = random.Random(5)
    rows = [(f"n{rng.randrange(300):03d}", f"k{rng.randrange(260)}") for _ in range(330)]
    rows += [(f"p{k:03d}", f"q{k}") for k in range(60)] + [(f"p{k + 1:03d}", f"q{k}") for k in range(60)]  # a long chain
    rows += [(f"h{k:03d}", "hub") for k in range(200)] + [("alone", None), (None, "hub")] + rows[:20]
    got = {r.node: r.component for r in splits.components(spark.createDataFrame(rows, "node string, key string"), "node", "key").collect()}
    assert got == roots(rows)
    assert splits.components(spark.createDataFrame([], "node string, key string"), "node", "key").count() == 0


def test_differencing_balances():
    rng = random.Random(6)
    w = [rng.paretovariate(1.5) for _ in range(400)]
    parts = splits.differenced(w, 8)
    assert sorted(k for p in parts for k in p) == list(range(400))
    sums = sorted(sum(w[k] for k in p) for p in parts)
    assert sums[-1] <= max(max(w), 1.02 * sum(w) / 8)  # one weight is larger than a bin and lies alone
    assert sums[-2] - sums[0] < 0.02 * sum(w) / 8
    assert sorted(map(len, splits.differenced([5.0, 1.0], 4))) == [0, 0, 1, 1] and splits.differenced([], 3) == [[], [], []]


def test_bins_go_whole_to_splits():
    assert splits.allot([10.0] * 10, [("train", 0.8), ("test", 0.2)]).count("test") == 2
    assert splits.allot([], [("a", 1.0)]) == []


@pytest.mark.parametrize("chunk", [30, 100_000])
def test_assignment_meets_proportions_in_chunks(spark, chunk):
    rng = random.Random(7)
    g = spark.createDataFrame([(f"c{k}", float(rng.randrange(1, 20))) for k in range(300)] + [("null", None)], "component string, weight double")
    out = {r.component: r.split for r in splits.assigned(g, [("train", 0.8), ("dev", 0.1), ("test", 0.1)], chunk=chunk).collect()}
    assert len(out) == 301
    w = {r.component: r.weight or 0.0 for r in g.collect()}
    total = sum(w.values())
    for name, share in (("train", 0.8), ("dev", 0.1), ("test", 0.1)):
        assert abs(sum(w[c] for c, s in out.items() if s == name) / total - share) < 0.02


def test_no_group_is_torn_by_the_assignment(spark, sf):
    clips = table(spark, sf, "clips_accepted")
    out = splits.grouped_splits(clips, table(spark, sf, "split_targets"))
    assert out.count() == clips.select("file_id").distinct().count()
    assert out.groupBy("component").agg({"split": "count"}).count() == out.select("component", "split").distinct().count()
    assert splits.torn_files(clips.limit(0)).count() == 0


def test_budgets_go_to_siblings_before_ancestors():
    leaves = [(("a", "x"), 0.25, 10.0), (("a", "y"), 0.25, 1000.0), (("b", "z"), 0.5, 1000.0)]
    got = mixture.budgets(leaves, 100.0)
    assert got == {("a", "x"): 10.0, ("a", "y"): 40.0, ("b", "z"): 50.0}
    got = mixture.budgets([(("a", "x"), 0.25, 10.0), (("a", "y"), 0.25, 20.0), (("b", "z"), 0.5, 1000.0)], 100.0)
    assert got == {("a", "x"): 10.0, ("a", "y"): 20.0, ("b", "z"): 70.0}
    assert mixture.budgets([(("a",), 0.0, 5.0), (("b",), 1.0, 3.0)], 10.0) == {("a",): 0.0, ("b",): 3.0}


def test_mixture_holds_its_budgets_and_repeats(spark):
    rng = random.Random(8)
    rows = [(k, "d", rng.choice(["en", "de"]), "big" if k % 3 else "small", rng.randrange(0, 40)) for k in range(3000)]
    docs = spark.createDataFrame(rows + [(None, "d", "en", "big", 5), (9000, None, None, "big", 3), (9001, "d", "en", "none", 3)], "id bigint, domain string, lang string, source string, n_tokens bigint")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 3), ("absent", 0.0, None)], "source string, target_share double, max_repeats int")
    total = 60_000
    got = mixture.mixture(docs, "id", ["domain", "lang", "source"], targets, total=total).collect()
    tokens = {s: sum(r.n_tokens for r in got if r.source == s) for s in ("big", "small")}
    assert all(total * 0.5 - 200 < v <= total * 0.5 for v in tokens.values())
    uses = {}
    for r in got:
        uses.setdefault((r.source, r.id), []).append(r.epoch)
    assert all(len(set(e)) == len(e) <= (1 if s == "big" else 3) for (s, _), e in uses.items())
    again = mixture.mixture(docs.repartition(7), "id", ["domain", "lang", "source"], targets, total=total).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert mixture.mixture(docs.limit(0), "id", ["domain", "lang", "source"], targets).count() == 0


def test_prefix_by_buckets_equals_a_full_order(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "s", 7) for k in range(5000)], "id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("s", 1.0, 2)], "source string, target_share double, max_repeats int")
    got = {}
    for per in (10, 10_000):
        monkeypatch.setattr(mixture, "PER_BUCKET", per)
        got[per] = mixture.mixture(docs, "id", ["source"], targets, total=20_001).collect()
    assert len(got[10]) == len(got[10_000]) == 20_001 // 7


def test_tokens_of_whole_texts(spark):
    docs = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "naïve <|endoftext|> " * 4000)], "id bigint, t string")
    n = {r.id: r.n_tokens for r in mixture.token_counts(docs, "t", ["id"]).collect()}
    assert n[1] == 2 and n[2] == 0 and 3 not in n and n[4] > 20_000
    assert [r[0] for r in spark.createDataFrame([("EN",), (" de",), (None,), ("english",)], "l string").select(mixture.language("l")).collect()] == ["en", "de", "und", "und"]


def test_every_key_of_a_file_links_it(spark):
    rows = [(f"V1_S1_I1_P{p}", "v", s, i, split) for p, s, i, split in (("A", "s1", "i1", "train"), ("A", "s2", None, "train"), ("B", "s2", "i2", "test"), ("C", "s3", "i2", "test"), ("C", "s4", "i9", None), ("D", "s5", "i9", "test"), ("E", "s6", "i6", "dev"))]
    clips = spark.createDataFrame(rows, "file_id string, vendor string, session_id string, interaction_id string, split string").withColumn("clip_id", F.monotonically_increasing_id())
    assert sorted(r.file_id[-1] for r in splits.torn_files(clips).collect()) == ["A", "B", "C", "D"]


def test_what_prefixes_lack_pays_for_further_documents():
    assert mixture.settled([]) == []
    ends = [("s", "sa", 10, 9), ("s", "sb", 10, 8), ("s", "sc", 10, 2), ("t", "ta", 10, 4), ("t", "tb", 7, 3)]
    assert sorted(mixture.settled(ends)) == ["sa", "tb"]  # 19 and 7 tokens are lacking; equal parts by smaller leaf


def test_shares_miss_by_less_than_a_document(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice("abcdefg"), rng.choice(("x", "y", "z")), rng.randrange(50, 400)) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, n_tokens bigint")
    targets = spark.createDataFrame([("x", 0.6, 3), ("y", 0.3, 2), ("z", 0.1, 1)], "source string, target_share double, max_repeats int")
    mixed = mixture.mixture(docs, "doc_id", ["lang", "source"], targets)
    assert all(r.share_kept and r.repeats_kept for r in mixture.checks(docs, mixed, targets).collect())
    got = {r.source: r.n_tokens for r in mixture.reached_shares(mixed, targets, "doc_id").collect()}
    total = sum(r[3] for r in rows)
    assert all(total * s - 400 < got[n] <= total * s + 1 for n, s in (("x", 0.6), ("y", 0.3), ("z", 0.1)))
    elsewhere = spark.createDataFrame([("x", "web"), ("x", "zoo"), (None, "q")], "source string, domain string")
    texts = spark.createDataFrame([(1, "one two", "en", "x"), (2, "three", "en", "new")], "doc_id bigint, text string, lang string, source string")
    assert {(r.doc_id, r.domain) for r in mixture.document_sizes(texts, domains=elsewhere).collect()} == {(1, "web"), (2, "other")}


def test_checks_of_an_assignment_see_faults(spark):
    clips = spark.createDataFrame([(f"c{k}", f"V00_S000{k % 3}_I0000000{k}_P000{k}", "V00", f"000{k % 3}", f"i{k}", "train") for k in range(9)], "clip_id string, file_id string, vendor string, session_id string, interaction_id string, split string")
    targets = spark.createDataFrame([("train", 0.7), ("test", 0.3)], "split string, target_share double")
    good = splits.grouped_splits(clips, targets)
    assert all(r.holds for r in splits.checks(clips, good, targets).collect())
    bad = good.withColumn("split", F.when(F.col("file_id").contains("I00000000"), "test").otherwise("train"))
    assert {r.what for r in splits.checks(clips, bad, targets).collect() if not r.holds} >= {"linked_files_stay_together"}
