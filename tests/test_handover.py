import os
import stat

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinesift import session
from kinesift.operators import census, geometry, handover, selection, series
from kinesift.sources import sinks, tables

CLIP = "clip_id string, file_id string, start_frame int, end_frame int, start_s double, window_seconds double, speech_seconds double"


def frames(spark, extra=()):
    rows = [("a", k, [0.0] * 63, [0.0] * 45, [0.0] * 45) for k in range(1200)] + [("b", k, [0.0] * (63 if k else 60), [0.0] * 45, None if k == 40 else [0.0] * 45) for k in range(100)] + list(extra)
    return spark.createDataFrame(rows, "file_id string, frame int, body array<double>, left array<double>, right array<double>")


def test_clips_are_cashed_against_their_frames(spark):
    clips = [("good", "a", 300, 1200, 10.0, 30.0, 2.8), ("long", "a", 900, 1300, 30.0, 13.3, 0.0), ("shape", "b", 0, 30, 0.0, 1.0, 0.0), ("hand", "b", 30, 60, 1.0, 1.0, 0.0), ("gone", "z", 0, 30, 0.0, 1.0, 0.0), ("talk", "a", 0, 300, 0.0, 10.0, 9.0), ("none", "a", None, 30, 0.0, 1.0, 0.0), ("near", "a", 0, 300, 0.0, 10.0, 2.4)]
    df = spark.createDataFrame(clips, CLIP)
    voice = spark.createDataFrame([("a", 9.0, 12.0), ("a", 39.0, 45.0), ("a", 1.0, 2.0)], "file_id string, start double, end double")
    got = {r.clip_id: r.problem for r in handover.verify_manifest(df, frames(spark), voice).collect()}
    assert got == {"long": "length:300", "shape": "shape:body", "hand": "shape:right", "gone": "unreadable", "talk": "speech", "none": "length:0"}
    held = handover.clip_frames(df.filter("clip_id = 'good'"), frames(spark).select("file_id", "frame"))
    assert held.agg(F.count(F.lit(1)), F.min("offset"), F.max("offset")).head()[:] == (900, 0, 899)
    assert handover.verify_manifest(df.limit(0), frames(spark), voice).count() == 0
    assert handover.verify_manifest(df, frames(spark), voice, sample=2).count() <= 2


def test_markers_skip_only_what_is_the_same(spark):
    m = handover.run_marker({"a": 1}, "abc", False, 0, 10)
    assert handover.marker_matches(m, {"a": 1}, "abc", False, 0, 10)
    for other in (({"a": 2}, "abc", False, 0, 10), ({"a": 1}, "abd", False, 0, 10), ({"a": 1}, "abc", True, 0, 10), ({"a": 1}, "abc", False, 0, 11)):
        assert not handover.marker_matches(m, *other)
    assert not handover.marker_matches(handover.run_marker({"a": 1}, "abc", True, 0, 10), {"a": 1}, "abc", False, 0, 10) and not handover.marker_matches(None, {}, "", False, 0, 0)
    work = spark.createDataFrame([("s1", "a"), ("s1", "b"), ("s2", "c"), ("s3", "d")], "shard string, id string")
    full = handover.stale_shards(work, "shard", "id", spark.createDataFrame([], "shard string, fingerprint string, membership string"), "v1")
    done = full.select("shard", F.lit("v1").alias("fingerprint"), "membership").filter("shard <> 's3'")
    assert [r.shard for r in handover.stale_shards(work, "shard", "id", done, "v1").collect()] == ["s3"]
    assert {r.shard for r in handover.stale_shards(work.filter("id <> 'b'"), "shard", "id", done, "v1").collect()} == {"s1", "s3"}
    assert handover.stale_shards(work, "shard", "id", done, "v2").count() == 3


def test_metadata_joins_keep_one_row_a_file(spark, tmp_path):
    (tmp_path / "interactions.csv").write_text("prompt_hash,interaction_type,ipc_a,ipc_b\n00000001,talk,1,\n")
    (tmp_path / "participants.csv").write_text("vendor_id,participant_id\n00,0001A\n00,0001A\n")
    (tmp_path / "relationships.csv").write_text("vendor_id,session_id,kind\nV00,7,friends\nV00,007,kin\n")
    inv = spark.createDataFrame([("f1", "V00", "00000001", "0001A", "0007"), ("f2", "V01", "00000002", "0001A", None)], "file_id string, vendor string, interaction_id string, participant_id string, session_id string")
    out = {r.file_id: (r.interaction_type, r.interaction_join, r.participant_metadata_present, r.relationship_metadata_present) for r in census.with_metadata(inv, *tables.read_metadata(spark, str(tmp_path))).collect()}
    assert out == {"f1": ("talk", True, True, True), "f2": (None, False, False, False)}
    (tmp_path / "interactions.csv").write_text("prompt_hash,interaction_type,ipc_a,ipc_b\n1,a,,\n1,b,,\n")
    with pytest.raises(ValueError, match="repeats"):
        tables.read_metadata(spark, str(tmp_path))


def test_probe_and_stat_statuses(spark, tmp_path):
    ok = '{"streams": [{"codec_type": "video", "width": "10", "height": 20, "r_frame_rate": "30000/1001", "nb_frames": "90", "duration": "3.1"}], "format": {"duration": "3.0"}}'
    rows = [(ok, 0, False, "ok"), (ok, 1, False, "ffprobe_error"), (None, None, True, "timeout"), (None, None, None, "missing_mp4"), ("{", 0, False, "json_decode_error"), ('{"streams": []}', 0, False, "no_video_stream")]
    out = tables.probe_rows(spark.createDataFrame(rows, "probe_json string, code int, late boolean, want string"), returncode="code", timed_out="late").collect()
    assert all(r.probe_status == r.want for r in out) and (out[0].video_width, out[0].video_duration_s, out[0].observed_duration_s) == (10, 3.1, 3.0)
    (tmp_path / "x.wav").write_bytes(b"12345")
    want = spark.createDataFrame([("x.wav",), ("y.wav",)], "relative_path string")
    assert {tuple(r) for r in tables.stat_statuses(want, tables.list_files(spark, str(tmp_path))).collect()} == {("x.wav", True, 5), ("y.wav", False, None)}
    with pytest.raises(PermissionError):
        tables.require_read_only(str(tmp_path))
    if os.geteuid():
        os.chmod(tmp_path, stat.S_IRUSR | stat.S_IXUSR)
        assert tables.require_read_only(str(tmp_path)) == str(tmp_path)


def fitted(box, w, h, aspect):
    """Grow to the aspect, shrink step by step until it fits, slide inside."""
    if box is None:
        left, top, bw, bh = 0.0, 0.0, float(w), float(h)
    else:
        bw, bh = box[2] - box[0], box[3] - box[1]
        bw, bh = (bh * aspect, bh) if bw / bh < aspect else (bw, bw / aspect)
        left, top = (box[0] + box[2] - bw) / 2, (box[1] + box[3] - bh) / 2
    while bw > w + 1e-9 or bh > h + 1e-9 or abs(bw / bh - aspect) > 1e-9:
        bw, bh = min(bw, w), min(bh, h)
        bw, bh = (bh * aspect, bh) if bw / bh > aspect else (bw, bw / aspect)
    x, y = (int(min(max(0.0, a), n - s)) // 2 * 2 for a, n, s in ((left, w, bw), (top, h, bh)))
    return x, y, x + min(max(32, int(bw + 1e-9) // 2 * 2), w - x), y + min(max(32, int(bh + 1e-9) // 2 * 2), h - y)


def test_crops_keep_their_aspect_inside_the_raster(spark):
    rng = np.random.default_rng(3)
    cases = [(None, 1080, 1920)] + [((a, b, a + float(rng.integers(5, 2500)), b + float(rng.integers(5, 2500))), int(rng.integers(200, 2000)), int(rng.integers(200, 2000))) for a, b in rng.integers(-300, 1800, (60, 2)).astype(float).tolist()]
    df = spark.createDataFrame([(*(b or (None,) * 4), w, h) for b, w, h in cases], "a double, b double, c double, d double, w int, h int")
    for aspect in (1.0, 1.25, 0.5):
        got = [tuple(r[0]) for r in df.select(geometry.fitted_box([F.col(x) for x in "abcd"], F.col("w"), F.col("h"), aspect)).collect()]
        assert got == [fitted(b, w, h, aspect) for b, w, h in cases]


def test_held_values_stop_after_two(spark):
    left = spark.createDataFrame([("a", t) for t in range(6)] + [("b", t) for t in range(8)] + [("z", 1)], "k string, t bigint")
    right = spark.createDataFrame([("a", 1, 1.0), ("a", 3, 3.0), ("b", 4, 4.0)], "k string, t bigint, v double")
    got = {(r.k, r.t): (r.h, r.status) for r in series.on_screen(left, right, "k", "t", "v", "h", 3).collect()}
    assert got[("a", 0)] == (1.0, "ok") and got[("a", 5)] == (3.0, "ok")  # two beyond the end: held
    assert got[("b", 4)] == (4.0, "ok") and got[("b", 5)] == got[("b", 7)] == (None, "stopped") == got[("z", 1)]


def test_slices_are_disjoint_and_repeat(spark):
    df = spark.range(100)
    a, b = ({(r.id, r.slice) for r in selection.seeded_slices(df.repartition(n), "id", "s", [10, 20]).collect()} for n in (1, 7))
    assert a == b and sorted(k for _, k in a) == [0] * 10 + [1] * 20 and len({i for i, _ in a}) == 30


def test_small_files_and_scratch(spark, tmp_path):
    for k in (1, 2):
        sinks.write_json(spark, {"k": k}, f"file://{tmp_path}/s.json")
    assert (tmp_path / "s.json").read_text().strip().endswith("}") and '"k": 2' in (tmp_path / "s.json").read_text() and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["s.json"]
    kept = session.Durable(spark).keep(spark.range(3))
    assert kept.count() == 3
    clips = spark.createDataFrame([("c", "f", "V00", "a", "train", 30.0, 0.5)], "clip_id string, file_id string, vendor string, label string, split string, window_seconds double, gesture_quality double")
    text = sinks.report(clips, spark.createDataFrame([("x", 1)], "stage string, n int"))
    assert "## Funnel" in text and "| V00 | a | 1 |" in text
    assert "## By split" in sinks.dataset_card(clips, "T")
