"""Participant bundles: pose arrays (NPZ) and annotations (JSON) as frame and interval tables."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Members that are read; a file without one of them gets a status, not an exception.
MEMBERS = ("smplh:body_pose", "smplh:left_hand_pose", "smplh:right_hand_pose", "smplh:is_valid", "boxes_and_keypoints:keypoints", "boxes_and_keypoints:is_valid_box")
#: Frames of a row of arrays; long recordings become many rows, so no row grows with its file.
ROW_FRAMES = 512


def read_poses(spark: SparkSession, root: str, members: Sequence[str] = MEMBERS, least: int = 60) -> DataFrame:
    """``file_id, scan_status, n_frames, frame, body, left, right ARRAY<FLOAT>, smplh_valid, box_valid, keypoints`` by frame.

    A file that can't be read, lacks a member, or whose arrays differ in length gives one row with
    ``scan_status = read_error:<kind>`` and no frame; one of fewer than ``least`` frames ``too_few_frames:<n>``.
    Files are decoded one at a time and given back in pieces of ROW_FRAMES frames.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.npz").load(root)
    ddl = "file_id string, scan_status string, n_frames int, frame int, body array<float>, left array<float>, right array<float>, smplh_valid boolean, box_valid boolean, keypoints array<float>"
    wanted = tuple(members)

    def decode(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in ddl.split(", ")]
        for pdf in it:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                fid = path.rsplit("/", 1)[-1].removesuffix(".npz")
                try:
                    with np.load(io.BytesIO(content), allow_pickle=False) as z:
                        a = [z[m] for m in wanted]
                    n = len(a[0])
                    if any(len(x) != n for x in a):
                        raise ValueError("ragged")
                except Exception as error:  # noqa: BLE001 - every failure becomes a row
                    yield pd.DataFrame([[fid, f"read_error:{type(error).__name__}"] + [None] * 8], columns=names)
                    continue
                if n < least:
                    yield pd.DataFrame([[fid, f"too_few_frames:{n}", n] + [None] * 7], columns=names)
                    continue
                for lo in range(0, n, ROW_FRAMES):
                    hi = min(n, lo + ROW_FRAMES)
                    flat = [np.asarray(x[lo:hi], np.float32).reshape(hi - lo, -1) for x in (a[0], a[1], a[2], a[4])]
                    yield pd.DataFrame({"file_id": fid, "scan_status": "ok", "n_frames": n, "frame": np.arange(lo, hi, dtype=np.int32), "body": list(flat[0]), "left": list(flat[1]), "right": list(flat[2]), "smplh_valid": np.asarray(a[3][lo:hi]).reshape(-1).astype(bool), "box_valid": np.asarray(a[5][lo:hi]).reshape(-1).astype(bool), "keypoints": list(flat[3])})

    return files.select("path", "content").mapInPandas(decode, ddl)


def read_intervals(spark: SparkSession, root: str) -> DataFrame:
    """``file_id, start, end DOUBLE``: the voice intervals of every annotation; unreadable files give none."""
    j = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").schema("id string, `metadata:vad` array<struct<start: double, end: double>>").json(root)
    fid = F.regexp_replace(F.substring_index(F.input_file_name(), "/", -1), r"\.json$", "")
    return j.select(fid.alias("file_id"), F.explode("`metadata:vad`").alias("v")).select("file_id", "v.start", "v.end")
