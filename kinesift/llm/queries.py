"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Durable, table
from . import caps, confusables, consensus, leaks, mixture, percentiles, splits, topn


def _files_capped(spark: SparkSession, d: str, strata: list | None = None, by: str = "proportional") -> DataFrame:
    cap = topn.current_limit(table(spark, d, "run_config"), "max_files_per_participant")
    clips = table(spark, d, "clips_accepted")
    return caps.stratified_cap(clips, ["vendor", topn.participant_of("file_id")], "file_id", "gesture_quality", cap=cap, strata=strata, by=by)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _files_capped(spark, d).filter(~F.col("kept")).select("file_id")


def p1_by_label(spark: SparkSession, d: str) -> DataFrame:
    """Each participant's cap split over the labels of its files."""
    return _files_capped(spark, d, ["label"]).select("file_id", "kept")


def p1_by_type_equal(spark: SparkSession, d: str) -> DataFrame:
    """The cap in equal parts over interaction types; types with few files leave slots to the others."""
    return _files_capped(spark, d, ["interaction_type"], "equal").select("file_id", "quota", "kept")


def p1_share(spark: SparkSession, d: str) -> DataFrame:
    """No participant owns more than 2 % of all clips."""
    clips = table(spark, d, "clips_accepted")
    return caps.stratified_cap(clips, ["vendor", topn.participant_of("file_id")], "clip_id", "gesture_quality", share=0.02).select("clip_id", "kept")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return percentiles.odd_days(table(spark, d, "clips_accepted"))


def p2_vendor_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of vendors from the states of their days, exact over the clips."""
    days = percentiles.day_states(table(spark, d, "clips_accepted"))
    keys = ["vendor", "measure_name"]
    out = percentiles.percentiles(percentiles.merge_states(days, keys), keys, [0.05, 0.25, 0.5, 0.75, 0.95], settle=16)
    return out.select(*keys, "prob", F.round("percentile", 6).alias("percentile"), "n_values", F.lit(0.0).alias("max_error"))


def p2_rounded_states(spark: SparkSession, d: str) -> DataFrame:
    """As above from states with values to 0.5, off by 0.25 at most."""
    days = percentiles.day_states(table(spark, d, "clips_accepted"), 0.5)
    keys = ["vendor", "measure_name"]
    out = percentiles.percentiles(percentiles.merge_states(days, keys), keys, [0.1, 0.5, 0.9])
    return out.select(*keys, "prob", F.round("percentile", 6).alias("percentile"), "n_values", F.lit(0.25).alias("max_error"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    n = topn.current_limit(table(spark, d, "run_config"), "max_clips_per_file")
    return topn.top_clips(table(spark, d, "clips_accepted"), n).filter("has_more").select("file_id", "clip_id")


def p3_top_clips(spark: SparkSession, d: str) -> DataFrame:
    """The best clips of every file with their rank."""
    n = topn.current_limit(table(spark, d, "run_config"), "max_clips_per_file")
    return topn.top_clips(table(spark, d, "clips_accepted"), n).select("file_id", "clip_id", F.round("clip_score", 6).alias("clip_score"), "rank")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_passages(spark, d).select("doc_id", "item_id")


def p8_passages(spark: SparkSession, d: str) -> DataFrame:
    """Where in the text each leaked passage stands."""
    return leaks.leaked_passages(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")


def p8_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    """How many documents each held-out item leaked into; items that didn't leak have 0."""
    n = p8_found(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"))
    items = table(spark, d, "eval_items").select("item_id", "task")
    return items.join(n, "item_id", "left").select("item_id", "task", F.coalesce("n_documents", F.lit(0)).alias("n_documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return confusables.twins(table(spark, d, "documents"), "doc_id", "text").select(F.col("key_a").alias("doc_id"), F.col("key_b").alias("twin_doc_id"))


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    """Documents that have a twin, with the class of those that read the same and the one of those that are the same."""
    return confusables.twin_classes(table(spark, d, "documents"), "doc_id", "text")


def p10_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its consistent form and the class of documents that read the same."""
    return confusables.canonical(table(spark, d, "documents"), "doc_id", "text")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    items = consensus.consensus(consensus.votes_of(table(spark, d, "verdicts"))).items.filter("n_accept > 0 AND n_reject > 0")
    return items.select(F.col("item").alias("review_item_id"), F.when(F.col("accept_probability") >= 0.5, "accept").otherwise("reject").alias("verdict"))


def p5_disputed(spark: SparkSession, d: str) -> DataFrame:
    """The items that a verdict is derived for: all that have both an accept and a reject among the standing verdicts."""
    return p5_found(spark, d).select("review_item_id")


def p5_reviewers(spark: SparkSession, d: str) -> DataFrame:
    """Reliability of every reviewer: chance to be right, on items to accept and to reject, and its community."""
    r = consensus.consensus(consensus.votes_of(table(spark, d, "verdicts"))).annotators
    return r.select(F.col("who").alias("reviewer"), "n_labels", *[F.round(c, 6).alias(c) for c in ("reliability", "sensitivity", "specificity")], "community")


def p5_sources(spark: SparkSession, d: str) -> DataFrame:
    """Reliability of every verdict source: share of its standing verdicts that agree with the consensus, softly."""
    votes = consensus.votes_of(table(spark, d, "verdicts"))
    items = consensus.consensus(votes).items.select("item", "accept_probability")
    right = F.when(F.col("y") == 1, F.col("accept_probability")).otherwise(1 - F.col("accept_probability"))
    return votes.join(items, "item").groupBy(F.coalesce("source", F.lit("none")).alias("verdict_source")).agg(F.count(F.lit(1)).alias("n_labels"), F.round(F.avg(right), 6).alias("reliability"))


def p5_agreement(spark: SparkSession, d: str) -> DataFrame:
    a = consensus.agreement(consensus.votes_of(table(spark, d, "verdicts")))
    return a.select(F.col("item").alias("review_item_id"), "n_accept", "n_reject", F.round("agreement", 6).alias("agreement"))


def p5_alpha(spark: SparkSession, d: str) -> DataFrame:
    a = consensus.krippendorff_alpha(consensus.votes_of(table(spark, d, "verdicts")))
    return a.select("n_items", "n_labels", F.round("alpha", 6).alias("alpha"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.torn_files(table(spark, d, "clips_accepted"))


def p7_assignment(spark: SparkSession, d: str) -> DataFrame:
    """One split a group of linked files, by target share."""
    return splits.grouped_splits(table(spark, d, "clips_accepted"), table(spark, d, "split_targets"))


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold for the assignment."""
    clips, targets = table(spark, d, "clips_accepted"), table(spark, d, "split_targets")
    return splits.checks(clips, Durable(spark).keep(splits.grouped_splits(clips, targets)), targets)


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.document_mixture(table(spark, d, "documents"), table(spark, d, "source_targets"))


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold for the mixture, source by source."""
    sizes = Durable(spark).keep(mixture.document_sizes(table(spark, d, "documents")))
    targets = table(spark, d, "source_targets")
    mixed = Durable(spark).keep(mixture.mixture(sizes, "doc_id", ["domain", "lang", "source"], targets))
    return mixture.checks(sizes, mixed, targets)


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "source_targets")
    r = mixture.reached_shares(p9_mixture(spark, d), targets, "doc_id")
    return r.select("source", "target_share", F.round("reached_share", 6).alias("reached_share"), "n_tokens", "n_documents", "most_repeats")


QUERIES = {
    "p5_found": p5_found,
    "p5_disputed": p5_disputed,
    "p5_reviewers": p5_reviewers,
    "p5_sources": p5_sources,
    "p5_agreement": p5_agreement,
    "p5_alpha": p5_alpha,
    "p7_found": p7_found,
    "p7_assignment": p7_assignment,
    "p7_checks": p7_checks,
    "p9_mixture": p9_mixture,
    "p9_shares": p9_shares,
    "p9_checks": p9_checks,
    "p8_found": p8_found,
    "p8_passages": p8_passages,
    "p8_leaked_items": p8_leaked_items,
    "p10_found": p10_found,
    "p10_classes": p10_classes,
    "p10_canonical": p10_canonical,
    "p1_found": p1_found,
    "p1_by_label": p1_by_label,
    "p1_by_type_equal": p1_by_type_equal,
    "p1_share": p1_share,
    "p2_found": p2_found,
    "p2_vendor_percentiles": p2_vendor_percentiles,
    "p2_rounded_states": p2_rounded_states,
    "p3_found": p3_found,
    "p3_top_clips": p3_top_clips,
}

_FILES = """
files AS (
  SELECT file_id, min(vendor) AS vendor, regexp_extract(file_id, '_P([A-Za-z0-9]+)$', 1) AS p,
         max(CASE WHEN isfinite(gesture_quality) THEN gesture_quality END) AS q, min(label) AS label, min(interaction_type) AS type
  FROM clips_accepted GROUP BY file_id
), cap AS (SELECT max_files_per_participant AS n FROM run_config WHERE is_current)
"""
_ONCE = """
once AS (
  SELECT clip_id, min(vendor) AS vendor, min(export_day) AS export_day,
         max(CASE WHEN isfinite(wrist_height_p75_mm) THEN wrist_height_p75_mm END) AS a,
         max(CASE WHEN isfinite(arm_speed_speech_p50_mm_s) THEN arm_speed_speech_p50_mm_s END) AS b
  FROM clips_accepted GROUP BY clip_id
), long AS (
  SELECT vendor, export_day, 'wrist_height_p75_mm' AS measure_name, a AS v FROM once WHERE a IS NOT NULL
  UNION ALL SELECT vendor, export_day, 'arm_speed_speech_p50_mm_s', b FROM once WHERE b IS NOT NULL
)
"""
_BEST = """
clips AS (SELECT DISTINCT file_id, clip_id, clip_score FROM clips_accepted WHERE isfinite(clip_score)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY clip_score DESC, clip_id) AS r, count(*) OVER (PARTITION BY file_id) AS n FROM clips
), lim AS (SELECT max_clips_per_file AS m FROM run_config WHERE is_current)
"""
_VOTES = r"""
said AS (
  SELECT review_item_id, lower(regexp_replace(reviewer, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS who,
         lower(regexp_replace(verdict, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS label, try_cast(recorded_utc AS TIMESTAMPTZ) AS ts, log_line
  FROM verdicts
), standing AS (
  SELECT *, row_number() OVER (PARTITION BY review_item_id, who ORDER BY ts DESC NULLS LAST, log_line DESC) AS r FROM said WHERE who <> '' AND label <> ''
), tally AS (
  SELECT review_item_id, count(*) FILTER (WHERE label = 'accept') AS a, count(*) FILTER (WHERE label = 'reject') AS j
  FROM standing WHERE r = 1 AND label IN ('accept', 'reject') GROUP BY review_item_id
)
"""
SQL = {
    "p5_disputed": f"WITH {_VOTES} SELECT review_item_id FROM tally WHERE a > 0 AND j > 0",
    "p7_checks": "SELECT what, true AS holds FROM (VALUES ('every_file_has_one_split'), ('linked_files_stay_together'), ('shares_within_a_bin')) x(what)",
    "p9_checks": "SELECT source, true AS share_kept, true AS repeats_kept FROM source_targets",
    "p1_by_type_equal": f"""WITH {_FILES}, counts AS (
  SELECT vendor, p, coalesce(type, '') AS type, count(*) AS c FROM files GROUP BY ALL
), sized AS (
  SELECT *, sum(c) OVER w AS total, greatest(0, n - coalesce(sum(c) OVER b, 0)) / CAST(count(*) OVER w - coalesce(count(*) OVER b, 0) AS DOUBLE) AS level FROM counts, cap
  WINDOW w AS (PARTITION BY vendor, p), b AS (PARTITION BY vendor, p ORDER BY c, type ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), parts AS (
  SELECT *, CASE WHEN total <= n OR c <= level THEN c ELSE least(c, max(level) FILTER (WHERE total > n AND c > level) OVER (PARTITION BY vendor, p)) END AS part FROM sized
), based AS (
  SELECT *, floor(part + 1e-9) AS base FROM parts
), quotas AS (
  SELECT *, CAST(base + CASE WHEN row_number() OVER (PARTITION BY vendor, p ORDER BY part - base DESC, type) <= least(n, total) - sum(base) OVER (PARTITION BY vendor, p) AND base < c THEN 1 ELSE 0 END AS BIGINT) AS quota FROM based
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY vendor, p, type ORDER BY q DESC NULLS LAST, file_id) AS r FROM files
) SELECT file_id, quota, r <= quota AS kept FROM ranked JOIN quotas ON ranked.vendor = quotas.vendor AND ranked.p = quotas.p AND coalesce(ranked.type, '') = quotas.type""",
    "p5_agreement": f"""WITH {_VOTES} SELECT review_item_id, a AS n_accept, j AS n_reject,
  round(CASE WHEN a + j > 1 THEN CAST(a * (a - 1) + j * (j - 1) AS DOUBLE) / ((a + j) * (a + j - 1)) END, 6) AS agreement FROM tally""",
    "p5_alpha": f"""WITH {_VOTES}, s AS (
  SELECT count(*) AS n_items, CAST(sum(a + j) AS BIGINT) AS n, sum(2e0 * a * j / (a + j - 1)) AS o, CAST(sum(a) AS DOUBLE) AS a, CAST(sum(j) AS DOUBLE) AS j FROM tally WHERE a + j > 1
) SELECT n_items, n AS n_labels, round(1 - o / (2 * a * j / (n - 1)), 6) AS alpha FROM s""",
    "p7_found": """WITH RECURSIVE files AS (
  SELECT file_id, min(vendor) AS v, min(session_id) AS s, min(interaction_id) AS i, regexp_extract(file_id, '_P([A-Za-z0-9]+)$', 1) AS p FROM clips_accepted GROUP BY file_id
), links AS (
  SELECT a.file_id AS x, b.file_id AS y FROM files a JOIN files b ON (a.v = b.v AND (a.p = b.p OR a.s = b.s)) OR a.i = b.i
), reach AS (
  SELECT file_id AS x, file_id AS y FROM files UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), roots AS (SELECT x AS file_id, min(y) AS root FROM reach GROUP BY x), torn AS (
  SELECT root FROM roots JOIN clips_accepted USING (file_id) GROUP BY root HAVING count(DISTINCT split) > 1
) SELECT file_id FROM roots WHERE root IN (SELECT root FROM torn)""",
    "p1_found": f"""WITH {_FILES}, ranked AS (
  SELECT file_id, row_number() OVER (PARTITION BY vendor, p ORDER BY q DESC NULLS LAST, file_id) AS r FROM files
) SELECT file_id FROM ranked, cap WHERE r > n""",
    "p1_by_label": f"""WITH {_FILES}, counts AS (
  SELECT vendor, p, label, count(*) AS c, sum(count(*)) OVER (PARTITION BY vendor, p) AS t FROM files GROUP BY vendor, p, label
), parts AS (
  SELECT *, CASE WHEN t <= n THEN c ELSE CAST(floor(n * c / t + 1e-9) AS BIGINT) END AS base, CASE WHEN t <= n THEN 0 ELSE CAST(n * c AS DOUBLE) / t - floor(n * c / t + 1e-9) END AS rest,
         least(n, t) AS slots FROM counts, cap
), quotas AS (
  SELECT *, base + CASE WHEN row_number() OVER (PARTITION BY vendor, p ORDER BY rest DESC, label) <= slots - sum(base) OVER (PARTITION BY vendor, p) THEN 1 ELSE 0 END AS quota FROM parts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY vendor, p, label ORDER BY q DESC NULLS LAST, file_id) AS r FROM files
) SELECT file_id, r <= quota AS kept FROM ranked JOIN quotas USING (vendor, p, label)""",
    "p1_share": """WITH once AS (
  SELECT clip_id, min(vendor) AS vendor, min(regexp_extract(file_id, '_P([A-Za-z0-9]+)$', 1)) AS p, max(CASE WHEN isfinite(gesture_quality) THEN gesture_quality END) AS q
  FROM clips_accepted GROUP BY clip_id
) SELECT clip_id, row_number() OVER (PARTITION BY vendor, p ORDER BY q DESC NULLS LAST, clip_id) <= floor((SELECT count(*) FROM once) * 0.02e0) AS kept FROM once""",
    "p2_found": f"""WITH {_ONCE}, days AS (
  SELECT vendor, export_day, measure_name, quantile_cont(v, 0.5) AS m, count(*) AS n FROM long GROUP BY ALL
), tails AS (
  SELECT vendor, measure_name, quantile_cont(v, 0.1) AS lo, quantile_cont(v, 0.9) AS hi FROM long GROUP BY ALL
) SELECT vendor, export_day, measure_name FROM days JOIN tails USING (vendor, measure_name) WHERE n >= 8 AND (m < lo OR m > hi)""",
    "p2_vendor_percentiles": f"""WITH {_ONCE}, q AS (
  SELECT vendor, measure_name, quantile_cont(v, [0.05, 0.25, 0.5, 0.75, 0.95]) AS l, count(*) AS n_values FROM long GROUP BY ALL
) SELECT vendor, measure_name, CAST(unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS DOUBLE) AS prob, round(unnest(l), 6) AS percentile, n_values, 0e0 AS max_error FROM q""",
    "p2_rounded_states": f"""WITH {_ONCE}, q AS (
  SELECT vendor, measure_name, quantile_cont(round_even(v / 0.5e0, 0) * 0.5e0, [0.1, 0.5, 0.9]) AS l, count(*) AS n_values FROM long GROUP BY ALL
) SELECT vendor, measure_name, CAST(unnest([0.1, 0.5, 0.9]) AS DOUBLE) AS prob, round(unnest(l), 6) AS percentile, n_values, 0.25e0 AS max_error FROM q""",
    "p3_found": f"WITH {_BEST} SELECT file_id, clip_id FROM ranked, lim WHERE n > m AND r <= m",
    "p3_top_clips": f"WITH {_BEST} SELECT file_id, clip_id, round(clip_score, 6) AS clip_score, CAST(r AS INTEGER) AS rank FROM ranked, lim WHERE r <= m",
}
