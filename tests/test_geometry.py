import numpy as np
from pyspark.sql import functions as F

from kinesift.operators import geometry as g

PARENTS = [-1, 0, 1, 1, 1]
REST = np.array([[0, 0, 0], [0, 0.5, 0], [0.2, 0.5, 0], [-0.2, 0.5, 0], [0, 0.7, 0.0]])


def test_rotations_are_orthonormal_and_keep_their_axis():
    v = np.random.default_rng(1).normal(size=(50, 3)) * 3
    r = g.rotation_matrices(v)
    assert np.allclose(r @ r.transpose(0, 2, 1), np.eye(3)) and np.allclose(np.linalg.det(r), 1)
    assert np.allclose(np.einsum("nij,nj->ni", r, v), v)
    assert np.allclose(g.rotation_matrices(np.zeros((1, 3))), np.eye(3))
    assert np.allclose(g.rotation_matrices(np.array([[0, 0, np.pi / 2]]))[0] @ [1, 0, 0], [0, 1, 0])


def test_torso_frame_does_not_see_a_turn_of_the_root(spark):
    rng = np.random.default_rng(2)
    pose = rng.normal(size=(6, 5, 3)) * 0.4
    turned = pose.copy()
    pose[:, 0] = 0
    turned[:, 0] = rng.normal(size=(6, 3))
    rows = [(k, p.reshape(-1).tolist(), t.reshape(-1).tolist()) for k, (p, t) in enumerate(zip(pose, turned))] + [(9, None, [1.0])]
    df = spark.createDataFrame(rows, "k int, p array<double>, t array<double>")
    a, b = ({r.k: r.position for r in g.skeleton_positions(df, ["k"], c, REST, PARENTS, (2, 3, 4, 0), [2, 4]).collect()} for c in "pt")
    assert a[9] is None and b[9] is None
    assert all(np.allclose(a[k], b[k], atol=1e-6) for k in range(6))
    assert np.isclose(np.hypot(*a[0][:2]), 200.0)  # half the shoulder width


def test_angular_speed(spark):
    df = spark.createDataFrame([("a", t, [0.0, 0.0, 0.1 * t]) for t in range(5)], "k string, t int, v array<double>")
    got = [r.angular_speed for r in g.angular_speed(df, "k", "t", "v", 0, 30.0).orderBy("t").collect()]
    assert np.allclose(got, 3.0)


def test_four_quarter_turns_are_the_identity_of_sizes(spark):
    df = spark.range(1)
    w, h, zero, one = F.lit(100), F.lit(40), F.lit(0), F.lit(1.0)
    p = [df.select(g.repaired_point(F.lit(10.0), F.lit(5.0), w, h, zero, zero, one, F.lit(t)).alias("p")).head().p for t in range(4)]
    assert [(x.x, x.y) for x in p] == [(10.0, 5.0), (5.0, 89.0), (89.0, 34.0), (34.0, 10.0)]
    assert [df.select(g.quarter_turns(F.lit(r))).head()[0] for r in (-80.0, 95.0, 170.0, -175.0, 10.0)] == [1, 3, 2, 2, 0]
    assert df.select(g.quarter_turns(F.lit(None).cast("double"))).head()[0] == 0


def test_points_and_slices(spark):
    df = spark.createDataFrame([("a", 0, [0.0, 0.0, 1.0, 4.0, 0.0, 1.0, 2.0, 2.0, 0.5, 0.0, 0.0, 0.9, float("nan"), 1.0, 1.0])], "k string, t int, f array<double>").withColumn("p", g.as_points("f", 5))
    assert [g_ for g_ in df.select(F.transform("p", g.usable)).head()[0]] == [False, True, True, False, False]
    c = df.select(g.centroid(F.col("p"), F.get("p", F.lit(0))).alias("c")).head().c
    assert (c.x, c.y) == (3.0, 1.0)
    assert df.select(g.rows_of("f", [1, 9], 3)).head()[0] == [4.0, 0.0, 1.0, None, None, None]
    assert g.padded_slice(df, ["k"], "f", F.lit(-1), 3).head().slice == [0.0, 0.0, 0.0]
