"""Hand-over: manifests, their summary and verification, incremental work, reports."""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import measured
from ..functions.parse import file_id_parts, membership_hash
from .intervals import merge_intervals, speech_ranges
from .selection import seeded_sample

COLUMNS = ("clip_id", "file_id", "vendor", "label", "split", "participant_id", "pose_path", "audio_path", "video_path", "annotation_path", "start_frame", "end_frame", "start_s", "window_seconds", "fps", "clip_score", "gesture_quality")


def manifest(clips: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row a clip in a fixed column order, paths resolved, missing frame rates taken from the inventory."""
    rates = inventory.select(F.col("file_id"), measured("video_r_fps").alias("_k_fps"))
    paths = {"pose_path": ".npz", "audio_path": ".wav", "video_path": ".mp4", "annotation_path": ".json"}
    c = clips.withColumns({k: F.concat("source_relbase", F.lit(e)) for k, e in paths.items()})
    return c.join(rates, "file_id", "left").withColumn("fps", F.coalesce(measured("fps"), "_k_fps")).select(*COLUMNS)


def manifest_summary(clips: DataFrame) -> DataFrame:
    return clips.groupBy("vendor").agg(F.count(F.lit(1)).alias("clips"), F.round(F.sum("window_seconds") / 3600, 6).alias("hours"), F.count_distinct("file_id").alias("files"), F.count_distinct(file_id_parts("file_id")["participant_id"]).alias("participants"))


def speech_totals(speech: DataFrame) -> DataFrame:
    """Milliseconds of each clip's speech intervals, summed as they are and with overlaps once."""
    r = speech_ranges(speech).filter("t > s")
    plain = r.groupBy(F.col("entity").alias("clip_id")).agg(F.sum(F.col("t") - F.col("s")).alias("plain_ms"))
    merged = merge_intervals(r, "entity", "s", "t").filter(~F.col("is_gap")).groupBy(F.col("entity").alias("clip_id")).agg(F.sum(F.col("end_pos") - F.col("start_pos")).alias("merged_ms"))
    return plain.join(merged, "clip_id")


def verify(clips: DataFrame, speech: DataFrame, tolerance_s: float = 0.5) -> DataFrame:
    """``clip_id, problem`` of clips that don't hold what they promise; problems are rows, nothing is raised."""
    said = speech_totals(speech).select("clip_id", (F.col("merged_ms") / 1000).alias("_k_said"))
    n = F.col("end_frame") - F.col("start_frame")
    problem = (
        F.when(measured("end_frame").isNull(), "no_end")
        .when(n <= 0, "empty_range")
        .when(F.abs(n - F.col("window_seconds") * F.col("fps")) > 1, "length")
        .when(F.abs(F.col("_k_said") - measured("speech_seconds")) > tolerance_s, "speech")
    )
    return clips.join(said, "clip_id", "left").withColumn("problem", problem).filter("problem IS NOT NULL")


def pending(work: DataFrame, done: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """Rows of ``work`` that weren't done under this fingerprint yet."""
    return work.join(done.filter(F.col("fingerprint") == fingerprint).select(key), key, "left_anti")


def run_marker(config: dict, revision: str, dirty: bool, start: int, stop: int) -> dict:
    """What a finished part of a census run leaves: hash of its config, revision of the code, its rows [start, stop)."""
    return {"status": "complete", "config_hash": fingerprint(config), "revision": revision, "dirty": dirty, "start_row": start, "stop_row": stop}


def marker_matches(marker: dict | None, config: dict, revision: str, dirty: bool, start: int, stop: int) -> bool:
    """May the part be skipped? Only if it was finished by the same config and rows, and both trees are clean."""
    return bool(marker) and not dirty and marker == run_marker(config, revision, False, start, stop)


def stale_shards(work: DataFrame, shard: str, key: str, done: DataFrame, fingerprint: str) -> DataFrame:
    """``shard, n, membership`` of the shards that have to be done: those without a marker (``shard, fingerprint, membership``)
    of this fingerprint and of just their present members."""
    now = work.groupBy(shard).agg(F.count(F.lit(1)).alias("n"), membership_hash(key).alias("membership"))
    fine = done.filter(F.col("fingerprint") == fingerprint).select(shard, "membership")
    return now.join(fine, [shard, "membership"], "left_anti").select(shard, "n", "membership")


def clip_frames(clips: DataFrame, frames: DataFrame, block: int = 512) -> DataFrame:
    """The frames of every clip: all columns of ``frames`` with ``clip_id`` and ``offset`` in the clip.

    An equi-join on file and block of frames: a clip is in each block that it touches, so no range is compared with all frames.
    """
    s, t = F.col("start_frame").cast("bigint"), F.col("end_frame").cast("bigint")
    parts = clips.filter(t > s).select("clip_id", F.col("file_id").alias("_k_f"), s.alias("_k_s"), t.alias("_k_t"), F.explode(F.sequence(F.floor(s / F.lit(block)), F.floor((t - 1) / F.lit(block)))).alias("_k_b"))
    f = frames.filter("frame IS NOT NULL")
    on = (F.col("file_id") == F.col("_k_f")) & (F.floor(F.col("frame") / F.lit(block)) == F.col("_k_b"))
    return f.join(parts, on).filter("frame >= _k_s AND frame < _k_t").select("clip_id", (F.col("frame") - F.col("_k_s")).alias("offset"), *[F.col(c) for c in frames.columns])


def slice_statuses(clips: DataFrame, frames: DataFrame, arrays: dict[str, int]) -> DataFrame:
    """``clip_id, n_promised, n_found, status`` of every clip, for ``arrays`` (column -> length each frame must have).

    ok; unreadable (the file has no frame); length:<n> (other than promised); shape:<column> (a frame's array has another
    length or is NULL). Nothing is raised: a loader that skips errors keeps those that are ok.
    """
    found = clip_frames(clips, frames.select("file_id", "frame", *[F.coalesce(F.size(a) == n, F.lit(False)).alias(f"_k_{a}") for a, n in arrays.items()]))
    per = found.groupBy("clip_id").agg(F.count_distinct("offset").alias("n"), *[F.bool_and(f"_k_{a}").alias(f"_k_{a}") for a in arrays])
    files = frames.filter("frame IS NOT NULL").select("file_id").distinct().withColumn("_k_there", F.lit(True))
    promised = F.col("end_frame").cast("bigint") - F.col("start_frame").cast("bigint")
    n = F.coalesce("n", F.lit(0))
    shape = F.coalesce(*[F.when(~F.col(f"_k_{a}"), F.lit(f"shape:{a}")) for a in arrays], F.lit("ok")) if arrays else F.lit("ok")
    status = F.when(F.col("_k_there").isNull(), "unreadable").when(~n.eqNullSafe(promised), F.concat(F.lit("length:"), n)).otherwise(shape)
    return clips.join(files, "file_id", "left").join(per, "clip_id", "left").select("clip_id", promised.alias("n_promised"), n.alias("n_found"), status.alias("status"))


def verify_manifest(clips: DataFrame, frames: DataFrame, intervals: DataFrame, tolerance_s: float = 0.5, sample: int | None = None, seed: str = "verify") -> DataFrame:
    """``clip_id, problem`` of the clips (all, or a seeded ``sample``) that a loader wouldn't get as promised.

    The slice of each array must be there at its length, with 63 numbers of the body (so that its 13 upper-body rows of three
    exist) and 45 of each hand; the speech seconds, summed anew from the file's voice intervals (``file_id, start, end``)
    within the clip, must be those promised up to ``tolerance_s``.
    """
    rows = seeded_sample(clips, "clip_id", seed, sample) if sample else clips
    bad = slice_statuses(rows, frames, {"body": 63, "left": 45, "right": 45}).filter("status <> 'ok'").select("clip_id", F.col("status").alias("problem"))
    a, b = F.col("start_s"), F.col("start_s") + F.col("window_seconds")
    inside = F.greatest(F.lit(0.0), F.least(F.col("end"), b) - F.greatest(F.col("start"), a))
    said = rows.join(intervals, "file_id", "left").groupBy("clip_id").agg(F.coalesce(F.sum(inside), F.lit(0.0)).alias("_k_said"), F.first("speech_seconds").alias("_k_want"))
    off = said.filter(~F.coalesce(F.abs(F.col("_k_said") - measured("_k_want")) <= tolerance_s, F.lit(False)))
    speech = off.join(bad, "clip_id", "left_anti").select("clip_id", F.lit("speech").alias("problem"))
    return bad.unionByName(speech)


def fingerprint(params: dict, modules: Sequence = ()) -> str:
    """sha256 of parameters and of the source of the modules that measure: changes whenever results could."""
    h = hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode())
    for m in modules:
        h.update(inspect.getsource(m).encode())
    return h.hexdigest()


def markdown_table(df: DataFrame, columns: Sequence[str], most: int = 200) -> str:
    """A small aggregate as a Markdown table; missing values read "n/a". For summaries only: raises beyond ``most`` rows."""
    rows = df.select(*columns).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many rows for a report table")
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join("n/a" if v is None else str(v) for v in r) + " |" for r in rows])
