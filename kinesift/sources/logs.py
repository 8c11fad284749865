"""Append-only logs of JSON lines: reading with torn lines skipped, importing foreign exports, appending."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import truth

RECORD = "review_item_id string, file_id string, verdict string, reviewer string, verdict_source string, reasons string, note string, card_fingerprint string, saw_video string, recorded_utc string"


def _reasons(c: Column) -> Column:
    """A JSON list of reasons, or a bare string as one reason; '' and NULL as none."""
    listed = F.from_json(c, "array<string>")
    return F.when(c.isNull() | (F.trim(c) == ""), F.array().cast("array<string>")).when(c.startswith("["), F.coalesce(listed, F.array(c))).otherwise(F.array(c))


def _fields(rows: DataFrame, text: str) -> DataFrame:
    r = rows.withColumn("r", F.from_json(text, RECORD)).filter(F.col("r.review_item_id").isNotNull() & F.col("r.verdict").isNotNull())
    x = r.select(*[c for c in rows.columns if c != text], "r.*")
    return x.withColumn("reasons", _reasons(F.col("reasons"))).withColumn("saw_video", truth("saw_video"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Records of a log in order of appending (``log_line`` from 1); blank, torn and foreign lines are skipped.

    A log is one file that one writer appends to, so its lines are numbered from the whole file.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("p", "line"))
    return _fields(lines.filter(F.trim("line") != "").select((F.col("p") + 1).cast("bigint").alias("log_line"), "line"), "line")


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """Records of an export: either a JSON list or JSON lines."""
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("t"))
    items = F.when(F.col("t").startswith("["), F.from_json("t", "array<string>")).otherwise(F.split("t", "\n"))
    each = text.select(F.posexplode(items).alias("p", "line")).filter(F.trim("line") != "")
    return _fields(each.select((F.col("p") + 1).cast("bigint").alias("log_line"), "line"), "line")


def append(path: str, record: dict) -> None:
    """Appends one record to a log on a local file system in a single write."""
    fd = os.open(path, os.O_WRONLY | os.O_CREAT | os.O_APPEND, 0o600)
    try:
        os.write(fd, (json.dumps(record, sort_keys=True) + "\n").encode())
    finally:
        os.close(fd)


def append_table(df: DataFrame, folder: str) -> None:
    """Appends a batch of records to a folder of JSON lines files."""
    df.write.mode("append").json(folder)
