import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinesift.operators import handover
from kinesift.sources import bundles, logs, sinks, tables
from kinesift.streaming import verdicts


def bundle(root, name, n=600, drop=None, ragged=False):
    a = {"smplh:body_pose": np.zeros((n, 21, 3), np.float32), "smplh:left_hand_pose": np.zeros((n, 15, 3), np.float32), "smplh:right_hand_pose": np.zeros((n, 15, 3), np.float32), "smplh:is_valid": np.ones(n, bool), "boxes_and_keypoints:keypoints": np.ones((n - ragged, 133, 3), np.float32), "boxes_and_keypoints:is_valid_box": np.ones(n, bool)}
    a.pop(drop, None)
    np.savez(root / f"{name}.npz", **a)
    (root / f"{name}.json").write_text(json.dumps({"id": name, "metadata:transcript": [], "metadata:vad": [{"start": 1.0, "end": 2.5}]}))


def test_bundles_turn_errors_into_rows(spark, tmp_path):
    bundle(tmp_path, "good")
    bundle(tmp_path, "short", n=10)
    bundle(tmp_path, "lacks", drop="smplh:is_valid")
    bundle(tmp_path, "ragged", ragged=True)
    (tmp_path / "torn.npz").write_bytes(b"PK nothing")
    df = bundles.read_poses(spark, str(tmp_path))
    got = {(r.file_id, r.scan_status): r["count"] for r in df.groupBy("file_id", "scan_status").count().collect()}
    assert got.pop(("torn", "read_error:BadZipFile"), 1) and got == {("good", "ok"): 600, ("short", "too_few_frames:10"): 1, ("lacks", "read_error:KeyError"): 1, ("ragged", "read_error:ValueError"): 1} or len(got) == 5
    assert df.filter("scan_status = 'ok'").agg(F.max("frame"), F.max(F.size("keypoints"))).head()[:] == (599, 399)
    assert {(r.file_id, r.start, r.end) for r in bundles.read_intervals(spark, str(tmp_path)).collect()} == {(n, 1.0, 2.5) for n in ("good", "short", "lacks", "ragged")}


def test_filelist_checks(spark, tmp_path):
    head = "file_id,label,split,batch_idx,archive_idx,has_imitator_movement,has_annotation_1p,has_annotation_3p,extra\n"
    p = tmp_path / "f.csv"
    p.write_text(head + "V01_S0002_I00000003_P0004A,improvised,train,7,12,0,1,1,NA\n")
    r = tables.read_filelist(spark, str(p)).head()
    assert (r.source_relbase, r.vendor, r.participant_id) == ("improvised/train/0007/0012/V01_S0002_I00000003_P0004A", "V01", "0004A")
    assert tables.read_csv(spark, str(p)).head().extra == "NA"
    p.write_text(head + "V01_S0002_I00000003_P0004A,a,b,7,12,0,1,1,\n" * 2)
    with pytest.raises(ValueError, match="repeats"):
        tables.read_filelist(spark, str(p))
    p.write_text(head + "odd,a,b,7,12,0,1,1,\n")
    with pytest.raises(ValueError, match="odd"):
        tables.read_filelist(spark, str(p))
    p.write_text("file_id,label\nx,y\n")
    with pytest.raises(KeyError, match="split"):
        tables.read_filelist(spark, str(p))


def test_manifest_keeps_leading_zeros(spark, tmp_path):
    df = spark.createDataFrame([("c", "f", "V00", "0001", "0007", "00000009", "a/b", 10, 20, 30.0)], tables.MANIFEST)
    sinks.write_csv(df, f"{tmp_path}/m", ["file_id", "start_frame"], one_file=True)
    assert tables.read_manifest(spark, f"{tmp_path}/m").collect() == df.collect()
    sinks.write_csv(df.limit(0), f"{tmp_path}/e")
    assert list((tmp_path / "e").glob("*.csv")) or not (tmp_path / "e" / "_SUCCESS").stat().st_size
    head = ",".join(df.columns)
    (tmp_path / "empty.csv").write_text(head + "\n")
    assert tables.read_manifest(spark, f"{tmp_path}/empty.csv").count() == 0


def test_shards_refuse_gaps(spark, tmp_path):
    for k in (0, 1):
        spark.range(k * 5, k * 5 + 5).write.parquet(f"{tmp_path}/s{k}")
    paths = [f"{tmp_path}/s{k}" for k in (0, 1)]
    assert tables.read_shards(spark, paths, 10, "id").count() == 10
    with pytest.raises(FileNotFoundError):
        tables.read_shards(spark, [*paths, f"{tmp_path}/s2"])
    with pytest.raises(ValueError, match="planned"):
        tables.read_shards(spark, paths, 11)
    with pytest.raises(ValueError, match="repeats"):
        tables.read_shards(spark, [paths[0], paths[0]], key="id")
    assert {r.relative_path.split("/")[0] for r in tables.list_files(spark, str(tmp_path), "*.parquet").collect()} == {"s0", "s1"}


def test_log_skips_torn_lines_and_reads_both_exports(spark, tmp_path):
    rec = {"review_item_id": "r1", "verdict": "accept", "reviewer": "a", "saw_video": "False", "reasons": "too dark", "recorded_utc": "2015-01-01T00:00:00Z"}
    p = tmp_path / "v.jsonl"
    logs.append(str(p), rec)
    logs.append(str(p), rec | {"verdict": "reject", "saw_video": True, "reasons": ["x", "y"]})
    with open(p, "a") as f:
        f.write('\n{"review_item_id": "r2", "verd')
    got = logs.read_log(spark, str(p)).orderBy("log_line").collect()
    assert [(r.verdict, r.saw_video, r.reasons) for r in got] == [("accept", False, ["too dark"]), ("reject", True, ["x", "y"])]
    q = tmp_path / "x.json"
    q.write_text(json.dumps([rec, rec | {"reasons": None}]))
    assert [r.reasons for r in logs.read_export(spark, str(q)).orderBy("log_line").collect()] == [["too dark"], []]


def test_probe_answers(spark):
    good = json.dumps({"streams": [{"codec_type": "audio"}, {"codec_type": "video", "width": 1080, "height": 1920, "r_frame_rate": "30000/1001", "nb_frames": "N/A"}], "format": {"duration": "12.5"}})
    df = spark.createDataFrame([(1, good), (2, '{"streams": []}'), (3, "{torn"), (4, None)], "id int, probe_json string")
    r = {x.id: x for x in tables.probe_rows(df).collect()}
    assert [r[k].probe_status for k in (1, 2, 3, 4)] == ["ok", "no_video_stream", "json_decode_error", "missing_mp4"]
    assert (r[1].video_width, round(r[1].video_r_fps, 2), r[1].video_nb_frames, r[1].observed_duration_s) == (1080, 29.97, None, 12.5)


def test_incremental_and_report(spark):
    work = spark.createDataFrame([("a",), ("b",)], "f string")
    done = spark.createDataFrame([("a", "v1"), ("b", "v0")], "f string, fingerprint string")
    assert [r.f for r in handover.pending(work, done, "f", "v1").collect()] == ["b"]
    clips = spark.createDataFrame([("V0", "l", "train", "f", 3600.0, 0.5)], "vendor string, label string, split string, file_id string, window_seconds double, gesture_quality double")
    text = sinks.report(clips, spark.createDataFrame([("x", None)], "stage string, n int"))
    assert "| V0 | l | 1 | 1.0 |" in text and "n/a" in text
    assert handover.fingerprint({"a": 1}, [logs]) == handover.fingerprint({"a": 1}, [logs]) != handover.fingerprint({"a": 2}, [logs])
    assert "## Columns" in sinks.dataset_card(clips, "t")


def test_stream_keeps_the_last_write(spark, tmp_path):
    rows = [(1, "r1", "accept", "a", "2015-01-02T00:00:00Z"), (2, "r1", "reject", "b", "2015-01-01T00:00:00+00:00"), (3, "r2", "unsure", "a", "n/a"), (4, "r2", "accept", "c", "n/a")]
    spark.createDataFrame(rows[:2], verdicts.SCHEMA).write.parquet(f"{tmp_path}/in/0")
    src = f"{tmp_path}/in/*"
    spark.createDataFrame(rows[2:], verdicts.SCHEMA).write.parquet(f"{tmp_path}/in/1")
    q = verdicts.current(verdicts.read_stream(spark, src)).writeStream.outputMode("complete").format("memory").queryName("verdicts_now").option("checkpointLocation", f"{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert {tuple(r) for r in spark.sql("SELECT * FROM verdicts_now").collect()} == {("r1", "accept", "a", 2, True), ("r2", "accept", "c", 2, True)}
