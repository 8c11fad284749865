"""Queries of the general curation operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.intervals import coverage
from ..operators.outliers import implausible_readings
from ..session import table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return coverage(table(spark, d, "clips_accepted"), table(spark, d, "clip_speech"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return implausible_readings(table(spark, d, "frame_tracks"))


P4_SQL = """
WITH ranges AS (
  SELECT 'clip' AS what, file_id AS entity, CAST(start_frame AS BIGINT) AS s, CAST(end_frame AS BIGINT) AS t
  FROM clips_accepted WHERE end_frame IS NOT NULL
  UNION ALL
  SELECT 'speech', clip_id, CAST(round_even(start_s * 1000, 0) AS BIGINT), CAST(round_even(end_s * 1000, 0) AS BIGINT)
  FROM clip_speech WHERE isfinite(start_s) AND isfinite(end_s)
), sound AS (
  SELECT DISTINCT * FROM ranges WHERE t > s AND entity IS NOT NULL
), led AS (
  SELECT *, max(t) OVER (PARTITION BY what, entity ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM sound
), numbered AS (
  SELECT *, sum(CASE WHEN reached IS NULL OR s > reached THEN 1 ELSE 0 END) OVER (PARTITION BY what, entity ORDER BY s, t ROWS UNBOUNDED PRECEDING) AS k FROM led
), periods AS (
  SELECT what, entity, k, min(s) AS s, max(t) AS t FROM numbered GROUP BY ALL
), nexts AS (
  SELECT *, lead(s) OVER (PARTITION BY what, entity ORDER BY s) AS n FROM periods
)
SELECT entity AS entity_id, what || '_period' AS kind, s AS start_pos, t AS end_pos FROM periods
UNION ALL
SELECT entity, what || '_gap', t, n FROM nexts WHERE n IS NOT NULL
"""

QUERIES = {"p4_found": p4_found, "p6_found": p6_found}
SQL = {"p4_found": P4_SQL}
