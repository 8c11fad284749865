"""Writing results: Parquet, hand-over CSV, small JSON summaries, reports and dataset cards."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.census import reason_histogram
from ..operators.handover import markdown_table


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replaces a table; readers see the old or the new one (commit protocol)."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_csv(df: DataFrame, path: str, order: list[str] | None = None, one_file: bool = False) -> None:
    """A CSV folder with header; ``one_file`` for hand-overs that fit one writer."""
    out = df.orderBy(*order) if order else df
    (out.coalesce(1) if one_file else out).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    """A small summary, written beside and moved into place, on whatever storage ``path`` names."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    to, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    fs = to.getFileSystem(conf)
    out = fs.create(aside)
    out.write(bytearray(json.dumps(value, indent=2, sort_keys=True, default=str).encode()))
    out.close()
    fs.delete(to, False)
    fs.rename(aside, to)


def report(clips: DataFrame, funnel: DataFrame, population: DataFrame | None = None, verdicts: DataFrame | None = None) -> str:
    """A Markdown report from small aggregates: eligibility, funnel, totals, quality by vendor, verdicts and their reasons."""

    def clips_by(*keys: str) -> DataFrame:
        return clips.groupBy(*keys).agg(F.count(F.lit(1)).alias("clips"), F.round(F.sum("window_seconds") / 3600, 2).alias("hours"), F.count_distinct("file_id").alias("files")).orderBy(*keys)

    q = clips.groupBy("vendor").agg(*[F.round(F.percentile("gesture_quality", F.lit(p)), 3).alias(f"p{round(p * 100)}") for p in (0.1, 0.5, 0.9)]).orderBy("vendor")
    parts = [("Funnel", funnel), ("Clips by vendor", clips_by("vendor")), ("Clips by vendor and label", clips_by("vendor", "label")), ("Quality", q)]
    if population is not None:
        by = population.groupBy(F.coalesce("ineligible_reason", F.lit("eligible")).alias("reason")).agg(F.count(F.lit(1)).alias("files")).orderBy(F.desc("files"), "reason")
        parts.insert(0, ("Eligibility", by))
    if verdicts is not None:
        said = verdicts.groupBy(F.lower(F.trim("verdict")).alias("verdict")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "verdict")
        parts += [("Verdicts", said), ("Reasons of rejection", reason_histogram(verdicts.filter("lower(trim(verdict)) = 'reject'"), "reasons").orderBy(F.desc("n"), "reason"))]
    return "\n\n".join(f"## {title}\n\n{markdown_table(t, t.columns)}" for title, t in parts) + "\n"


def dataset_card(clips: DataFrame, title: str, precision: DataFrame | None = None, note: str = "") -> str:
    """A card for a hand-over: what it is, size, splits, vendors, the precision that people measured, columns and how to read it."""
    n = clips.agg(F.count(F.lit(1)).alias("clips"), F.round(F.sum("window_seconds") / 3600, 2).alias("hours"), F.count_distinct("file_id").alias("files"))
    tables = [("Size", n)] + [(f"By {k}", clips.groupBy(k).agg(F.count(F.lit(1)).alias("clips"), F.round(F.sum("window_seconds") / 3600, 2).alias("hours")).orderBy(k)) for k in ("split", "vendor")]
    if precision is not None:
        tables.append(("Precision, with its 95 % interval", precision))
    fields = "\n".join(f"- `{c}` {t}" for c, t in clips.dtypes)
    body = "\n\n".join(f"## {t}\n\n{markdown_table(df, df.columns)}" for t, df in tables)
    use = "Frames of a clip are [start_frame, end_frame) of the arrays at pose_path; identifiers are text."
    return f"# {title}\n\n{note or 'Clips chosen by rule from a larger corpus.'}\n\n{body}\n\n## Columns\n\n{fields}\n\n## Use\n\n{use}\n"
