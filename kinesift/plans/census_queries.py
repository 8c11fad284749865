"""Queries of the inventory joins and summaries, logs, hand-over and keys, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse
from ..functions.expr import duplicate_keys, hash_order, measured
from ..operators import census, geometry, handover, selection
from ..session import table

EXT = (".json", ".mp4", ".npz", ".wav")


def _inv(spark, d):
    return table(spark, d, "inventory").withColumn("seconds", measured("observed_duration_s"))


def id_parse(spark, d):
    p = parse.file_id_parts("file_id")
    return _inv(spark, d).select("file_id", *[c.alias(n) for n, c in p.items()])


def path_build(spark, d):
    """Paths put together from parts taken out of the given ones; they must come out the same."""
    x = F.split("source_relbase", "/")
    i = _inv(spark, d).select("file_id", "label", "split", F.get(x, F.lit(2)).try_cast("int").alias("batch"), F.get(x, F.lit(3)).try_cast("int").alias("archive"))
    return i.select("file_id", parse.bundle_path(F.col("label"), F.col("split"), F.col("batch"), F.col("archive"), F.col("file_id")).alias("path"))


def rational_fps(spark, d):
    """Rates as text fractions, some of them unreadable, as numbers."""
    text = F.concat(F.rint(measured("video_r_fps") * 1000).cast("bigint").cast("string"), F.lit("/"), F.when(F.col("file_id").endswith("7"), "0").when(F.col("file_id").endswith("3"), "x").otherwise("1001"))
    return _inv(spark, d).select("file_id", F.round(parse.rate(text), 6).alias("fps"))


def clip_key(spark, d):
    return table(spark, d, "clips_accepted").select(parse.clip_id("file_id", "start_frame").alias("made"), "clip_id").distinct()


def left_join_indicator(spark, d):
    """Clips' files with their inventory row, and whether there is one."""
    files = table(spark, d, "clips_accepted").select("file_id").distinct()
    return census.lookup(files, _inv(spark, d), "file_id", "file_id", ["probe_status"], "in_inventory")


def nullsafe_join(spark, d):
    keys = ["interaction_type", "probe_status"]
    a = _inv(spark, d).groupBy(*keys).agg(F.count(F.lit(1)).alias("files"))
    b = _inv(spark, d).groupBy(*keys).agg(F.max("video_width").alias("widest"))
    return census.null_safe_left(a, b, keys)


def semi_join(spark, d):
    return table(spark, d, "clips_accepted").join(_inv(spark, d).filter("probe_status = 'ok'"), "file_id", "left_semi").groupBy("vendor").agg(F.count(F.lit(1)).alias("rows"))


def _catalog(spark, d):
    """Files that are there: those of complete bundles, and one more for each clip's file."""
    full = census.expected_paths(_inv(spark, d).filter("all_modalities_present"), "source_relbase", "file_id", EXT).select("relative_path", "extension")
    more = table(spark, d, "clips_accepted").select(F.concat("source_relbase", F.lit(".tmp.wav")).alias("relative_path"), F.lit(".wav").alias("extension")).distinct()
    return full.unionByName(more)


def missing_anti(spark, d):
    return census.missing_payloads(census.expected_paths(_inv(spark, d), "source_relbase", "file_id", EXT), _catalog(spark, d)).select("file_id", "relative_path")


def extra_anti(spark, d):
    return census.extra_payloads(census.expected_paths(_inv(spark, d), "source_relbase", "file_id", EXT), _catalog(spark, d))


def pair_self_join(spark, d):
    return census.partners(_inv(spark, d), ["vendor", "session_id", "interaction_id"], "file_id", ["source_relbase"]).select("file_id", "partner_file_id", "partner_source_relbase")


def duration_by_group(spark, d):
    s = census.duration_summary(_inv(spark, d), ["vendor", "label", "split"], "seconds", "all_modalities_present", "participant_id")
    return s.withColumn("hours", F.round(F.col("hours") + 1e-9, 6))


def two_level_summary(spark, d):
    s = census.two_level_summary(_inv(spark, d), ["vendor", "label"], ["session_id", "interaction_id"], "seconds")
    return s.select("vendor", "label", "interactions", "with_duration", "one_member", "two_members", "other_members", *[F.round(c, 6).alias(c) for c in ("dyad_hours", "spread_p95_s", "spread_max_s")])


def activity_summary(spark, d):
    """Summaries of files and of interactions side by side, unknown types too."""
    keys = ["interaction_type", "vendor"]
    a = census.duration_summary(_inv(spark, d), keys, "seconds", "all_modalities_present", "participant_id").select(*keys, "files", "participants")
    b = census.two_level_summary(_inv(spark, d), keys, ["session_id", "interaction_id"], "seconds").select(*keys, "interactions")
    return census.null_safe_left(a, b, keys)


def rate_raster(spark, d):
    return _inv(spark, d).groupBy("vendor", "video_r_fps", "video_width", "video_height").agg(F.count(F.lit(1)).alias("files"), F.round(F.sum("seconds") / 3600, 6).alias("hours"))


def set_string_agg(spark, d):
    s = census.participant_summary(_inv(spark, d), ["vendor", "participant_id"], "seconds")
    return s.withColumn("hours", F.round("hours", 6))


def unpivot_union(spark, d):
    i = _inv(spark, d).withColumn("npz_there", F.col("npz_size_bytes").isNotNull()).withColumn("mp4_size_bytes", (F.col("video_width") * F.col("video_height")).cast("bigint")).withColumn("mp4_there", F.col("video_stream_present"))
    tall = i.select(F.lit(".npz").alias("extension"), F.col("npz_size_bytes").alias("size_bytes")).unionByName(i.select(F.lit(".mp4").alias("extension"), F.col("mp4_size_bytes").alias("size_bytes")))
    return census.unpivot_union(tall, i, {".npz": ("npz_there", "npz_size_bytes"), ".mp4": ("mp4_there", "mp4_size_bytes")}, ("all", "expected"))


def coverage_scalar(spark, d):
    i = _inv(spark, d)
    c = i.agg(F.count(F.lit(1)).alias("files"), F.count_if("all_modalities_present").alias("complete"), F.count_if(F.col("probe_status").eqNullSafe(F.lit("ok"))).alias("probed"), F.count("seconds").alias("timed"), F.count_if(F.col("interaction_type").isNull()).alias("no_type"))
    m = missing_anti(spark, d).agg(F.count(F.lit(1)).alias("missing"))
    x = extra_anti(spark, d).agg(F.count(F.lit(1)).alias("extra"))
    return c.crossJoin(m).crossJoin(x)  # one row each


def size_signature(spark, d):
    """Empty placeholders by the exact sizes of two files. The inventory has one size, so stand-ins: files without a video
    stream have the placeholder's video, those that the probe didn't read the placeholder's sound."""
    i = _inv(spark, d).withColumns({"mp4_size_bytes": F.expr("CASE WHEN video_stream_present THEN npz_size_bytes * 3 ELSE 261 END"), "wav_size_bytes": F.expr("CASE WHEN probe_status = 'ok' THEN npz_size_bytes ELSE 58 END")})
    return i.filter("mp4_size_bytes = 261 AND wav_size_bytes = 58").select("file_id", "npz_size_bytes", "probe_status", F.col("probe_status").eqNullSafe(F.lit("no_video_stream")).alias("no_video_stream"))


def metadata_joined(spark, d):
    """Files with interactions, participants and relationships, which are made from what clips say of them."""
    c = table(spark, d, "clips_accepted")
    interactions = c.filter("interaction_id IS NOT NULL").groupBy(F.col("interaction_id").alias("prompt_hash")).agg(F.max("interaction_type").alias("seen_type"))
    people = c.select(F.regexp_replace("vendor", "^V", "").alias("vendor_id"), parse.file_id_parts("file_id")["participant_id"].alias("participant_id"))
    sessions = c.select(F.col("vendor").alias("vendor_id"), F.col("session_id").cast("bigint").cast("string").alias("session_id"))
    j = census.with_metadata(_inv(spark, d), interactions, people, sessions)
    return j.select("file_id", "seen_type", "interaction_join", "participant_metadata_present", "relationship_metadata_present")


def item_clips(spark, d):
    """Each file's item with its clips in order of start, eight at most: what a renderer looks up."""
    c = keep_first_clips(spark, d, "file_id", "start_frame", "clip_score").filter("start_frame IS NOT NULL AND file_id IS NOT NULL")
    top = selection.within_quota(c, ["file_id"], [F.desc_nulls_last(measured("clip_score")), F.col("clip_id")], 8)
    lists = top.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("start_frame", "clip_id"))).alias("l"))
    return lists.select("file_id", F.array_join(F.transform("l", lambda x: x["clip_id"]), ";").alias("clips"))


def seeded_slices(spark, d):
    """Two disjoint slices of a shuffle of the files."""
    return selection.seeded_slices(_inv(spark, d).select("file_id"), "file_id", "elm", [40, 25])


def shard_digests(spark, d):
    shard = F.pmod(F.conv(F.substring(F.sha2("file_id", 256), 1, 8), 16, 10).cast("bigint"), F.lit(16))
    return _inv(spark, d).groupBy(shard.alias("shard")).agg(parse.membership_digest("file_id").alias("digest"))


def stale_shards(spark, d):
    """Shards whose members aren't just those that clips come from: an increment must do them again."""
    shard = F.pmod(F.conv(F.substring(F.sha2("file_id", 256), 1, 8), 16, 10).cast("bigint"), F.lit(64))
    work = _inv(spark, d).select("file_id", shard.alias("shard"))
    seen = table(spark, d, "clips_accepted").select("file_id").distinct().join(work, "file_id")
    done = seen.groupBy("shard").agg(parse.membership_hash("file_id").alias("membership")).withColumn("fingerprint", F.lit("v1"))
    return handover.stale_shards(work, "shard", "file_id", done, "v1")


def slice_statuses(spark, d):
    """Do the frames that clips promise exist? ``frame_tracks`` is a sample of files with lost frames, so many don't."""
    frames = table(spark, d, "frame_tracks").select("file_id", "frame")
    return handover.slice_statuses(keep_first_clips(spark, d, "file_id", "start_frame", "end_frame"), frames, {})


def keep_first_clips(spark, d, *columns):
    """Every clip once, as exported first."""
    t = table(spark, d, "clips_accepted").select("clip_id", "written_ts", "run_id", *columns)
    return census.keep_first(t, ["clip_id"], [F.col("written_ts"), F.col("run_id")]).drop("written_ts", "run_id")


def shard_membership(spark, d):
    """Shards by hash, each with its size and the fingerprint of its members."""
    shard = F.pmod(F.conv(F.substring(F.sha2("file_id", 256), 1, 8), 16, 10).cast("bigint"), F.lit(16))
    return _inv(spark, d).groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n"), parse.membership_hash("file_id").alias("membership"))


def pending_files(spark, d):
    """Files that no accepted clip comes from yet: what an incremental run still has to do."""
    done = table(spark, d, "clips_accepted").select("file_id", F.lit("v1").alias("fingerprint")).distinct()
    return handover.pending(_inv(spark, d).select("file_id"), done, "file_id", "v1")


def last_write_wins(spark, d):
    last = census.latest_with_history(table(spark, d, "verdicts"), "review_item_id", parse.instant("recorded_utc"), "log_line", ["verdict", "reviewer", "log_line"], "reviewer", "verdict")
    return last.select("review_item_id", "verdict", "reviewer", "log_line", F.size("reviewers").alias("n_reviewers"), "revisions", "contested")


def verdict_counts_zero_filled(spark, d):
    v = table(spark, d, "verdicts").select(F.lower(F.trim("verdict")).alias("verdict"))
    return census.zero_filled_counts(v, "verdict", ["accept", "reject", "unsure", "deferred"])


def reason_histogram(spark, d):
    return census.reason_histogram(table(spark, d, "verdicts").filter("lower(trim(verdict)) = 'reject'"), "reasons")


def binding_check(spark, d):
    """Clips whose participant isn't spelled as in the inventory."""
    return census.binding_conflicts(table(spark, d, "clips_accepted").select("file_id", "participant_id").distinct(), table(spark, d, "inventory"), "file_id", "participant_id")


def truth_values(spark, d):
    return table(spark, d, "verdicts").select("log_line", parse.truth("saw_video").alias("saw_video"))


def parsed_times(spark, d):
    return table(spark, d, "verdicts").select("log_line", F.unix_seconds(parse.instant("recorded_utc")).alias("epoch_s"))


def duplicate_exports(spark, d):
    return duplicate_keys(table(spark, d, "clips_accepted"), ["clip_id"])


def keep_first_export(spark, d):
    return census.keep_first(table(spark, d, "clips_accepted"), ["clip_id"], [F.col("written_ts"), F.col("run_id")]).select("clip_id", "run_id")


def manifest_rows(spark, d):
    """The hand-over: one row a clip with resolved paths, in a fixed column order."""
    t = keep_first_clips(spark, d, *[c for c in table(spark, d, "clips_accepted").columns if c not in ("clip_id", "written_ts", "run_id")])
    return handover.manifest(t, _inv(spark, d)).select("clip_id", "pose_path", "start_frame", "end_frame", F.round("fps", 6).alias("fps"))


def manifest_summary(spark, d):
    return handover.manifest_summary(keep_first_clips(spark, d, "vendor", "file_id", "window_seconds"))


def manifest_problems(spark, d):
    """Clips whose promise doesn't hold: ranges, lengths, or speech seconds that the intervals contradict."""
    clips = keep_first_clips(spark, d, "start_frame", "end_frame", "window_seconds", "fps", "speech_seconds")
    return handover.verify(clips, table(spark, d, "clip_speech")).select("clip_id", "problem")


def harmonised_tiers(spark, d):
    """Reviewed and automated clips under one schema."""
    a = table(spark, d, "clips_accepted").filter("decision_source = 'automated'").select("clip_id", "clip_score").distinct()
    b = table(spark, d, "clips_accepted").join(table(spark, d, "verdicts").filter("lower(trim(verdict)) = 'accept'").select("review_item_id").distinct(), "review_item_id").select("clip_id", F.col("review_item_id")).distinct()
    return a.withColumn("tier", F.lit("automated")).unionByName(b.withColumn("tier", F.lit("reviewed")), allowMissingColumns=True).groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.count("clip_score").alias("scored"), F.count("review_item_id").alias("bound"))


def array_slice_norm(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", F.round(geometry.norm(geometry.slice_of("embedding", 8, 24)), 5).alias("norm"), F.size(geometry.slice_of("embedding", 60, 80)).alias("tail"))


def pairwise_distance(spark, d):
    """Distance of every vector to the first one of its label."""
    e = table(spark, d, "embeddings")
    first = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("base"))
    return e.join(first, "label").select("vec_id", F.round(geometry.distance("embedding", "base"), 4).alias("distance"))


def picked_rows(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", F.round(F.aggregate(geometry.rows_of("embedding", [3, 9, 20], 3), F.lit(0.0), lambda s, x: s + x.cast("double")), 5).alias("total"))


def hash_fraction(spark, d):
    """A reproducible place of every document in [0, 1), from its seeded hash."""
    h = F.substring(hash_order("cedar", "doc_id"), 1, 16)
    return table(spark, d, "documents").select("doc_id", F.round(parse.unit_interval(h), 9).alias("place"))


def speech_totals(spark, d):
    """Merged speech seconds of each clip next to the plain sum, where they differ."""
    return handover.speech_totals(table(spark, d, "clip_speech")).filter("plain_ms <> merged_ms")


QUERIES = {f.__name__: f for f in (id_parse, path_build, rational_fps, clip_key, left_join_indicator, nullsafe_join, semi_join, missing_anti, extra_anti, pair_self_join, duration_by_group, two_level_summary, activity_summary, rate_raster, set_string_agg, unpivot_union, coverage_scalar, size_signature, metadata_joined, item_clips, seeded_slices, shard_digests, stale_shards, slice_statuses, shard_membership, pending_files, last_write_wins, verdict_counts_zero_filled, reason_histogram, binding_check, truth_values, parsed_times, duplicate_exports, keep_first_export, manifest_rows, manifest_summary, manifest_problems, harmonised_tiers, array_slice_norm, pairwise_distance, picked_rows, hash_fraction, speech_totals)}

_FIRST = "c AS (SELECT * FROM clips_accepted QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY written_ts, run_id) = 1)"
_I = "i AS (SELECT *, CASE WHEN isfinite(observed_duration_s) THEN observed_duration_s END AS seconds FROM inventory)"
_PATHS = """want AS (SELECT file_id, source_relbase || e AS relative_path, e AS extension, all_modalities_present AS whole FROM inventory, (VALUES ('.json'), ('.mp4'), ('.npz'), ('.wav')) x(e)),
have AS (SELECT relative_path, extension FROM want WHERE whole UNION ALL SELECT DISTINCT source_relbase || '.tmp.wav', '.wav' FROM clips_accepted)"""
_LAST = "v AS (SELECT *, row_number() OVER (PARTITION BY review_item_id ORDER BY try_cast(recorded_utc AS TIMESTAMPTZ) DESC NULLS LAST, log_line DESC) AS r FROM verdicts)"
_MERGED = """s AS (SELECT clip_id, CAST(round_even(start_s * 1000, 0) AS BIGINT) AS a, CAST(round_even(end_s * 1000, 0) AS BIGINT) AS b FROM clip_speech WHERE isfinite(start_s) AND isfinite(end_s)),
ok AS (SELECT * FROM s WHERE b > a), l AS (SELECT *, max(b) OVER (PARTITION BY clip_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM (SELECT DISTINCT * FROM ok)),
k AS (SELECT *, sum(CASE WHEN m IS NULL OR a > m THEN 1 ELSE 0 END) OVER (PARTITION BY clip_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM l),
p AS (SELECT clip_id, max(b) - min(a) AS n FROM k GROUP BY clip_id, k), merged AS (SELECT clip_id, CAST(sum(n) AS BIGINT) AS merged_ms FROM p GROUP BY 1), plain AS (SELECT clip_id, CAST(sum(b - a) AS BIGINT) AS plain_ms FROM ok GROUP BY 1)"""

SQL = {
    "id_parse": "SELECT file_id, regexp_extract(file_id, '^V(\\d{2})_S(\\d{4})_I(\\d{8})_P([A-Za-z0-9]+)$', 1) AS vendor_id, regexp_extract(file_id, '_S(\\d{4})_', 1) AS session_id, regexp_extract(file_id, '_I(\\d{8})_', 1) AS interaction_id, regexp_extract(file_id, '_P([A-Za-z0-9]+)$', 1) AS participant_id FROM inventory",
    "path_build": "SELECT file_id, source_relbase AS path FROM inventory",
    "rational_fps": "SELECT file_id, round(CASE WHEN file_id LIKE '%7' OR file_id LIKE '%3' THEN NULL ELSE round_even(video_r_fps * 1000, 0) / 1001e0 END, 6) AS fps FROM inventory",
    "clip_key": "SELECT DISTINCT format('{}_f{:06d}', file_id, start_frame) AS made, clip_id FROM clips_accepted",
    "left_join_indicator": "SELECT f.file_id, i.probe_status, i.file_id IS NOT NULL AS in_inventory FROM (SELECT DISTINCT file_id FROM clips_accepted) f LEFT JOIN inventory i USING (file_id)",
    "nullsafe_join": "WITH a AS (SELECT interaction_type, probe_status, count(*) AS files, max(video_width) AS widest FROM inventory GROUP BY ALL) SELECT * FROM a",
    "semi_join": "SELECT vendor, count(*) AS rows FROM clips_accepted WHERE file_id IN (SELECT file_id FROM inventory WHERE probe_status = 'ok') GROUP BY 1",
    "missing_anti": f"WITH {_PATHS} SELECT file_id, relative_path FROM want WHERE relative_path NOT IN (SELECT relative_path FROM have)",
    "extra_anti": f"WITH {_PATHS} SELECT relative_path, extension FROM have WHERE relative_path NOT IN (SELECT relative_path FROM want)",
    "pair_self_join": """WITH n AS (SELECT *, count(*) OVER (PARTITION BY vendor, session_id, interaction_id) AS n FROM inventory)
SELECT a.file_id, b.file_id AS partner_file_id, b.source_relbase AS partner_source_relbase FROM n a JOIN n b ON a.vendor = b.vendor AND a.session_id = b.session_id AND a.interaction_id = b.interaction_id AND a.file_id <> b.file_id WHERE a.n = 2""",
    "duration_by_group": f"WITH {_I} SELECT vendor, label, split, count(*) AS files, count(*) FILTER (WHERE all_modalities_present) AS complete_files, count(seconds) AS with_duration, round(sum(seconds) / 3600 + 1e-9, 6) AS hours, count(DISTINCT participant_id) AS participants FROM i GROUP BY ALL",
    "two_level_summary": f"""WITH {_I}, p AS (SELECT vendor, label, session_id, interaction_id, count(*) AS m, avg(seconds) AS a, max(seconds) - min(seconds) AS s FROM i GROUP BY ALL)
SELECT vendor, label, count(*) AS interactions, count(a) AS with_duration, count(*) FILTER (WHERE m = 1) AS one_member, count(*) FILTER (WHERE m = 2) AS two_members, count(*) FILTER (WHERE m NOT IN (1, 2)) AS other_members,
  round(sum(a) / 3600, 6) AS dyad_hours, round(quantile_cont(s, 0.95), 6) AS spread_p95_s, round(max(s), 6) AS spread_max_s FROM p GROUP BY ALL""",
    "activity_summary": "SELECT interaction_type, vendor, count(*) AS files, count(DISTINCT participant_id) AS participants, count(DISTINCT session_id || '/' || interaction_id) AS interactions FROM inventory GROUP BY ALL",
    "rate_raster": f"WITH {_I} SELECT vendor, video_r_fps, video_width, video_height, count(*) AS files, round(sum(seconds) / 3600, 6) AS hours FROM i GROUP BY ALL",
    "set_string_agg": f"WITH {_I} SELECT vendor, participant_id, count(*) AS files, count(seconds) AS with_duration, round(sum(seconds) / 3600, 6) AS hours, coalesce(array_to_string(list_sort(list(DISTINCT label)), '+'), '') AS labels, coalesce(array_to_string(list_sort(list(DISTINCT split) FILTER (WHERE split IS NOT NULL)), '+'), '') AS splits, bool_and(coalesce(all_modalities_present, false)) AS all_complete FROM i GROUP BY ALL",
    "unpivot_union": """WITH w AS (SELECT npz_size_bytes AS n, CAST(video_width AS BIGINT) * video_height AS m, video_stream_present AS v FROM inventory)
SELECT '.npz' AS extension, count(*) AS files, CAST(sum(n) AS BIGINT) AS bytes, 'all' AS scope FROM w UNION ALL SELECT '.mp4', count(*), CAST(sum(m) AS BIGINT), 'all' FROM w
UNION ALL SELECT '.npz', count(n), CAST(coalesce(sum(n), 0) AS BIGINT), 'expected' FROM w UNION ALL SELECT '.mp4', count(*) FILTER (WHERE v), CAST(coalesce(sum(m), 0) AS BIGINT), 'expected' FROM w""",
    "coverage_scalar": f"""WITH {_I}, {_PATHS} SELECT count(*) AS files, count(*) FILTER (WHERE all_modalities_present) AS complete, count(*) FILTER (WHERE probe_status = 'ok') AS probed, count(seconds) AS timed, count(*) FILTER (WHERE interaction_type IS NULL) AS no_type,
  (SELECT count(*) FROM want WHERE relative_path NOT IN (SELECT relative_path FROM have)) AS missing, (SELECT count(*) FROM have WHERE relative_path NOT IN (SELECT relative_path FROM want)) AS extra FROM i""",
    "size_signature": "SELECT file_id, npz_size_bytes, probe_status, probe_status IS NOT DISTINCT FROM 'no_video_stream' AS no_video_stream FROM inventory WHERE NOT coalesce(video_stream_present, false) AND probe_status IS DISTINCT FROM 'ok'",
    "metadata_joined": """WITH i AS (SELECT interaction_id, max(interaction_type) AS seen_type FROM clips_accepted WHERE interaction_id IS NOT NULL GROUP BY 1), p AS (SELECT DISTINCT vendor, regexp_extract(file_id, '_P([A-Za-z0-9]+)$', 1) AS participant_id FROM clips_accepted),
s AS (SELECT DISTINCT vendor, lpad(CAST(CAST(session_id AS BIGINT) AS VARCHAR), 4, '0') AS session_id FROM clips_accepted WHERE session_id IS NOT NULL)
SELECT v.file_id, i.seen_type, i.interaction_id IS NOT NULL AS interaction_join, p.vendor IS NOT NULL AS participant_metadata_present, s.vendor IS NOT NULL AS relationship_metadata_present
FROM inventory v LEFT JOIN i USING (interaction_id) LEFT JOIN p ON p.vendor = v.vendor AND p.participant_id = v.participant_id LEFT JOIN s ON s.vendor = v.vendor AND s.session_id = v.session_id""",
    "item_clips": f"""WITH {_FIRST}, r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY CASE WHEN isfinite(clip_score) THEN clip_score END DESC NULLS LAST, clip_id) AS r FROM c WHERE start_frame IS NOT NULL AND file_id IS NOT NULL)
SELECT file_id, string_agg(clip_id, ';' ORDER BY start_frame, clip_id) AS clips FROM r WHERE r <= 8 GROUP BY 1""",
    "seeded_slices": "WITH r AS (SELECT file_id, row_number() OVER (ORDER BY sha256('elm' || chr(31) || file_id), file_id) AS r FROM inventory) SELECT file_id, CASE WHEN r <= 40 THEN 0 ELSE 1 END AS slice FROM r WHERE r <= 65",
    "shard_digests": "SELECT CAST('0x' || substr(sha256(file_id), 1, 8) AS BIGINT) % 16 AS shard, sha256(string_agg(file_id, chr(31) ORDER BY file_id)) AS digest FROM inventory GROUP BY 1",
    "stale_shards": """WITH h AS (SELECT file_id, CAST('0x' || substr(sha256(file_id), 1, 8) AS BIGINT) % 64 AS shard, CAST('0x' || substr(sha256(file_id), 1, 15) AS BIGINT) AS m, file_id IN (SELECT file_id FROM clips_accepted) AS done FROM inventory)
SELECT shard, count(*) AS n, CAST(sum(m) AS VARCHAR) AS membership FROM h GROUP BY shard HAVING NOT bool_and(done)""",
    "slice_statuses": f"""WITH {_FIRST}, f AS (SELECT DISTINCT file_id, frame FROM frame_tracks), n AS (SELECT clip_id, count(*) AS n FROM c JOIN f ON c.file_id = f.file_id AND frame >= start_frame AND frame < end_frame GROUP BY 1)
SELECT clip_id, CAST(end_frame AS BIGINT) - start_frame AS n_promised, coalesce(n, 0) AS n_found, CASE WHEN file_id NOT IN (SELECT file_id FROM f) THEN 'unreadable' WHEN coalesce(n, 0) IS DISTINCT FROM end_frame - start_frame THEN 'length:' || coalesce(n, 0) ELSE 'ok' END AS status
FROM c LEFT JOIN n USING (clip_id)""",
    "shard_membership": "WITH h AS (SELECT file_id, CAST('0x' || substr(sha256(file_id), 1, 8) AS BIGINT) % 16 AS shard FROM inventory) SELECT shard, count(*) AS n, CAST(sum(CAST('0x' || substr(sha256(file_id), 1, 15) AS BIGINT)) AS VARCHAR) AS membership FROM h GROUP BY shard",
    "pending_files": "SELECT file_id FROM inventory WHERE file_id NOT IN (SELECT file_id FROM clips_accepted)",
    "last_write_wins": f"WITH {_LAST}, h AS (SELECT review_item_id, count(DISTINCT reviewer) AS n, count(*) AS revisions, count(DISTINCT verdict) > 1 AS contested FROM verdicts GROUP BY 1) SELECT review_item_id, verdict, reviewer, log_line, CAST(n AS INTEGER) AS n_reviewers, revisions, contested FROM v JOIN h USING (review_item_id) WHERE r = 1",
    "verdict_counts_zero_filled": "SELECT x.v AS verdict, count(verdicts.log_line) AS n FROM (VALUES ('accept'), ('reject'), ('unsure'), ('deferred')) x(v) LEFT JOIN verdicts ON lower(trim(verdict)) = x.v GROUP BY 1",
    "reason_histogram": "SELECT reason, count(*) AS n FROM (SELECT unnest(CASE WHEN coalesce(len(reasons), 0) > 0 THEN reasons ELSE ['unspecified'] END) AS reason FROM verdicts WHERE lower(trim(verdict)) = 'reject') GROUP BY 1",
    "binding_check": "SELECT DISTINCT c.file_id, c.participant_id, i.participant_id AS expected FROM clips_accepted c JOIN (SELECT file_id, min(participant_id) AS participant_id FROM inventory GROUP BY 1) i USING (file_id) WHERE c.participant_id <> '' AND c.participant_id <> i.participant_id",
    "truth_values": "SELECT log_line, coalesce(lower(trim(saw_video)) IN ('1', 'true', 'yes', 'y', 't'), false) AS saw_video FROM verdicts",
    "parsed_times": "SELECT log_line, CAST(epoch(try_cast(recorded_utc AS TIMESTAMPTZ)) AS BIGINT) AS epoch_s FROM verdicts",
    "duplicate_exports": "SELECT clip_id, count(*) AS n FROM clips_accepted GROUP BY 1 HAVING count(*) > 1",
    "keep_first_export": "SELECT clip_id, run_id FROM clips_accepted QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY written_ts, run_id) = 1",
    "manifest_rows": "WITH c AS (SELECT * FROM clips_accepted QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY written_ts, run_id) = 1) SELECT clip_id, c.source_relbase || '.npz' AS pose_path, start_frame, end_frame, round(coalesce(c.fps, i.video_r_fps), 6) AS fps FROM c LEFT JOIN inventory i USING (file_id)",
    "manifest_summary": "WITH c AS (SELECT DISTINCT clip_id, vendor, file_id, window_seconds FROM clips_accepted) SELECT vendor, count(*) AS clips, round(sum(window_seconds) / 3600, 6) AS hours, count(DISTINCT file_id) AS files, count(DISTINCT regexp_extract(file_id, '_P([A-Za-z0-9]+)$', 1)) AS participants FROM c GROUP BY 1",
    "manifest_problems": f"""WITH {_MERGED}, c AS (SELECT DISTINCT clip_id, start_frame, end_frame, window_seconds, fps, speech_seconds FROM clips_accepted),
j AS (SELECT c.*, m.merged_ms / 1000e0 AS said FROM c LEFT JOIN merged m USING (clip_id)), q AS (SELECT clip_id, CASE WHEN end_frame IS NULL THEN 'no_end' WHEN end_frame <= start_frame THEN 'empty_range'
  WHEN abs(end_frame - start_frame - window_seconds * fps) > 1 THEN 'length' WHEN said IS NOT NULL AND isfinite(speech_seconds) AND abs(said - speech_seconds) > 0.5 THEN 'speech' END AS problem FROM j) SELECT * FROM q WHERE problem IS NOT NULL""",
    "harmonised_tiers": """WITH a AS (SELECT DISTINCT clip_id, clip_score FROM clips_accepted WHERE decision_source = 'automated'), b AS (SELECT DISTINCT clip_id, review_item_id FROM clips_accepted WHERE review_item_id IN (SELECT review_item_id FROM verdicts WHERE lower(trim(verdict)) = 'accept'))
SELECT 'automated' AS tier, count(*) AS n, count(clip_score) AS scored, CAST(0 AS BIGINT) AS bound FROM a UNION ALL SELECT 'reviewed', count(*), 0, count(review_item_id) FROM b""",
    "array_slice_norm": "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding[9:24], lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 5) AS norm, CAST(len(embedding[61:80]) AS INTEGER) AS tail FROM embeddings",
    "pairwise_distance": "WITH f AS (SELECT label, arg_min(embedding, vec_id) AS base FROM embeddings GROUP BY 1) SELECT vec_id, round(sqrt(list_sum(list_transform(list_zip(embedding, base), lambda z: pow(CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE), 2)))), 4) AS distance FROM embeddings JOIN f USING (label)",
    "picked_rows": "SELECT vec_id, round(list_sum(list_transform(embedding[10:12] || embedding[28:30] || embedding[61:63], lambda x: CAST(x AS DOUBLE))), 5) AS total FROM embeddings",
    "hash_fraction": "WITH h AS (SELECT doc_id, sha256('cedar' || chr(31) || doc_id) AS h FROM documents) SELECT doc_id, round((CAST('0x' || substr(h, 1, 8) AS BIGINT) * 4294967296e0 + CAST('0x' || substr(h, 9, 8) AS BIGINT)) / 18446744073709551616e0, 9) AS place FROM h",
    "speech_totals": f"WITH {_MERGED} SELECT clip_id, plain_ms, merged_ms FROM plain JOIN merged USING (clip_id) WHERE plain_ms <> merged_ms",
}
