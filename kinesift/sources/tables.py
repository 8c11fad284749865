"""Tables from files: explicit schemas, checks before use, completeness of shards."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import assert_unique, require_columns
from ..functions.parse import bundle_path, file_id_parts, number, rate

FILELIST = "file_id string, label string, split string, batch_idx bigint, archive_idx bigint, has_imitator_movement tinyint, has_annotation_1p tinyint, has_annotation_3p tinyint"
MANIFEST = "clip_id string, file_id string, vendor string, session_id string, participant_id string, interaction_id string, source_relbase string, start_frame bigint, end_frame bigint, fps double"


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV with a header; without a schema every column is text. Empty fields stay '' in text columns ("NA" is text).

    Identifiers keep their leading zeros: types are never guessed. The header is checked against the schema, as columns are
    read by position.
    """
    head = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    if schema is None:
        return spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in head])).option("header", True).option("emptyValue", "").option("nullValue", "\0").csv(path)
    want = T.StructType.fromDDL(schema)
    if missing := [f.name for f in want if f.name not in head]:
        raise KeyError(f"missing columns: {', '.join(missing)}")
    text = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in head])).option("header", True).option("emptyValue", "").option("nullValue", "\0").csv(path)
    return text.select(*[F.col(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name).try_cast(f.dataType).alias(f.name) for f in want])


def read_filelist(spark: SparkSession, path: str) -> DataFrame:
    """The list of participant files with parsed ids and derived paths. Repeated or unreadable ids raise a ValueError."""
    rows = read_csv(spark, path, FILELIST)
    assert_unique(rows, ["file_id"])
    parts = file_id_parts("file_id")
    out = rows.withColumns(parts)
    if bad := out.filter(F.col("vendor_id").isNull()).select("file_id").limit(3).collect():
        raise ValueError(f"unreadable file ids, e.g. {[r.file_id for r in bad]}")
    return out.withColumn("vendor", F.concat(F.lit("V"), "vendor_id")).withColumn("source_relbase", bundle_path(F.col("label"), F.col("split"), F.col("batch_idx"), F.col("archive_idx"), F.col("file_id")))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest: ids as text, frames as whole numbers. A file without rows gives an empty table."""
    return read_csv(spark, path, MANIFEST)


def read_shards(spark: SparkSession, paths: Sequence[str], rows: int | None = None, key: str | None = None) -> DataFrame:
    """All shards as one table, or an error: a missing shard, another number of rows than planned, a repeated key."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = [p for p in paths if not (q := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(q)]
    if gone:
        raise FileNotFoundError(f"missing {len(gone)} shards, first: {gone[:3]}")
    df = spark.read.parquet(*paths)
    if rows is not None and (n := df.count()) != rows:
        raise ValueError(f"shards hold {n} rows, {rows} were planned")
    return assert_unique(df, [key]) if key else df


#: Metadata tables of the census: all text, empty fields stay ''.
INTERACTIONS, PARTICIPANTS, RELATIONSHIPS = ("prompt_hash", "interaction_type", "ipc_a", "ipc_b"), ("vendor_id", "participant_id"), ("vendor_id", "session_id")


def read_metadata(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``interactions, participants, relationships`` of a metadata folder; a repeated prompt hash raises."""
    found = []
    for name, columns in (("interactions", INTERACTIONS), ("participants", PARTICIPANTS), ("relationships", RELATIONSHIPS)):
        found.append(require_columns(read_csv(spark, f"{root}/{name}.csv"), columns))
    i, p, r = found
    return assert_unique(i.select(*INTERACTIONS), ["prompt_hash"]), p.select(*PARTICIPANTS), r


def require_read_only(path: str) -> str:
    """``path``, or a PermissionError where this process could write to it: sources are read, never touched."""
    if os.access(path.removeprefix("file://"), os.W_OK):
        raise PermissionError(f"the source {path} is writable")
    return path


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``relative_path, extension, size_bytes`` of all files below a folder; contents aren't read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    base = root.rstrip("/").removeprefix("file://") + "/"
    rel = F.substring_index("path", base, -1)
    return f.select(rel.alias("relative_path"), F.regexp_extract(rel, r"(\.[^./]+)$", 1).alias("extension"), F.col("length").alias("size_bytes"))


def stat_statuses(expected: DataFrame, listed: DataFrame) -> DataFrame:
    """``relative_path, present, size_bytes`` of every expected path: FALSE and NULL for those that aren't, or no longer, there."""
    return expected.select("relative_path").distinct().join(listed.select("relative_path", "size_bytes"), "relative_path", "left").select("relative_path", F.col("size_bytes").isNotNull().alias("present"), "size_bytes")


def probe_rows(probed: DataFrame, column: str = "probe_json", returncode: str | None = None, timed_out: str | None = None) -> DataFrame:
    """Fields of a media probe's JSON answer with a status: timeout, missing_mp4 (NULL answer), ffprobe_error (return code other
    than 0), json_decode_error, no_video_stream, ok; the first that holds. ``returncode`` and ``timed_out`` name columns of the
    probe's run, where it was recorded."""
    stream = "struct<codec_type:string,codec_name:string,width:string,height:string,r_frame_rate:string,nb_frames:string,duration:string>"
    p = F.from_json(column, f"struct<streams:array<{stream}>,format:struct<duration:string>,_corrupt_record:string>", {"columnNameOfCorruptRecord": "_corrupt_record"})
    v = F.get(F.filter(F.col("_k_p.streams"), lambda s: s["codec_type"] == "video"), F.lit(0))
    late = F.coalesce(F.col(timed_out), F.lit(False)) if timed_out else F.lit(False)
    failed = F.coalesce(F.col(returncode) != 0, F.lit(False)) if returncode else F.lit(False)
    status = F.when(late, "timeout").when(failed, "ffprobe_error").when(F.col(column).isNull(), "missing_mp4").when(F.col("_k_p._corrupt_record").isNotNull() | F.col("_k_p").isNull(), "json_decode_error").when(F.col("_k_v").isNull(), "no_video_stream").otherwise("ok")
    rows = probed.withColumn("_k_p", p).withColumn("_k_v", v)
    return rows.select(*probed.columns, status.alias("probe_status"), number("_k_v.width").try_cast("int").alias("video_width"), number("_k_v.height").try_cast("int").alias("video_height"), rate("_k_v.r_frame_rate").alias("video_r_fps"), number("_k_v.nb_frames").alias("video_nb_frames"), number("_k_v.duration").alias("video_duration_s"), F.coalesce(number("_k_p.format.duration"), number("_k_v.duration")).alias("observed_duration_s"))


def check_schema(df: DataFrame, ddl: str) -> DataFrame:
    """``df``, or an error that lists missing columns."""
    return require_columns(df, [f.name for f in T.StructType.fromDDL(ddl)])
