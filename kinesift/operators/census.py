"""Inventory: joins with checks, coverage against a catalogue, and summaries on two levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import assert_unique, col


def same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """All keys equal, NULL to NULL as well."""
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


def lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, take: Sequence[str], matched: str, check: bool = True) -> DataFrame:
    """Left join to a table with one row a key (checked), and whether it matched."""
    if check:
        assert_unique(right.filter(F.col(right_key).isNotNull()), [right_key])
    r = right.select(F.col(right_key).alias("_k_r"), *take, F.lit(True).alias(matched))
    return left.join(r, F.col(left_key) == F.col("_k_r"), "left").drop("_k_r").withColumn(matched, F.coalesce(matched, F.lit(False)))


def with_metadata(inventory: DataFrame, interactions: DataFrame, participants: DataFrame, relationships: DataFrame) -> DataFrame:
    """The inventory with its metadata, still one row a file.

    Interactions by ``interaction_id = prompt_hash``, which must be unique (``interaction_join``: is there one?). Participants
    by vendor and id, repeated ones once; relationships by vendor (with or without its V) and session number, of which the
    first of a session counts: their flags are FALSE where there is none.
    """
    out = lookup(inventory, interactions, "interaction_id", "prompt_hash", [c for c in interactions.columns if c not in (*inventory.columns, "prompt_hash")], "interaction_join")
    vendor = F.regexp_replace("vendor_id", "^V", "")
    people = participants.filter("vendor_id IS NOT NULL AND participant_id IS NOT NULL").select(vendor.alias("_k_v"), F.col("participant_id").alias("_k_i")).distinct()
    sessions = relationships.select(vendor.alias("_k_v"), normalised_key("session_id").alias("_k_i")).filter("_k_v IS NOT NULL AND _k_i IS NOT NULL").distinct()
    for table, key, flag in ((people, "participant_id", "participant_metadata_present"), (sessions, "session_id", "relationship_metadata_present")):
        on = (F.regexp_replace("vendor", "^V", "") == F.col("_k_v")) & (F.col(key) == F.col("_k_i"))
        out = out.join(table.withColumn(flag, F.lit(True)), on, "left").drop("_k_v", "_k_i").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return out


def null_safe_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys where NULL meets NULL; the right side's keys are dropped."""
    cond = same(left, right, keys)
    rest = [right[c] for c in right.columns if c not in keys]
    return left.join(right, cond, "left").select(*[left[c] for c in left.columns], *rest)


def normalised_key(c: str | Column, width: int = 4, prefix: str = "") -> Column:
    """A number as text: without ``prefix``, cast, padded with zeros on the left; NULL where it isn't one."""
    x = F.regexp_replace(col(c), f"^{prefix}", "") if prefix else col(c)
    n = x.try_cast("bigint").cast("string")
    return F.when(F.length(n) >= width, n).otherwise(F.lpad(n, width, "0"))


def partners(df: DataFrame, keys: Sequence[str], record: str, take: Sequence[str]) -> DataFrame:
    """For groups of exactly two rows, each row with the other one's columns (prefix ``partner_``).

    Larger groups are dropped by a count before anything is paired, so no group is ever joined to itself.
    """
    pair = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(record, *take)).alias("a"), F.max(F.struct(record, *take)).alias("b")).filter("n = 2")
    each = F.explode(F.array(F.struct(F.col("a").alias("me"), F.col("b").alias("it")), F.struct(F.col("b").alias("me"), F.col("a").alias("it"))))
    return pair.select(*keys, each.alias("x")).select(*keys, F.col(f"x.me.{record}").alias(record), *[F.col(f"x.it.{c}").alias(f"partner_{c}") for c in (record, *take)])


def expected_paths(df: DataFrame, base: str, record: str, extensions: Sequence[str]) -> DataFrame:
    """One row for each file that a bundle should have: ``record, relative_path, extension``."""
    return df.select(record, F.explode(F.array(*[F.struct(F.concat(F.col(base), F.lit(e)).alias("relative_path"), F.lit(e).alias("extension")) for e in extensions])).alias("x")).select(record, "x.*")


def missing_payloads(expected: DataFrame, catalog: DataFrame) -> DataFrame:
    return expected.join(catalog.select("relative_path"), "relative_path", "left_anti")


def extra_payloads(expected: DataFrame, catalog: DataFrame) -> DataFrame:
    return catalog.join(expected.select("relative_path"), "relative_path", "left_anti")


def duration_summary(df: DataFrame, keys: Sequence[str], seconds: str, complete: str, who: str) -> DataFrame:
    """Rows, complete rows, rows with a duration, hours, distinct participants of each group; NULL keys form groups."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.count_if(F.coalesce(complete, F.lit(False))).alias("complete_files"), F.count(seconds).alias("with_duration"), (F.sum(seconds) / 3600).alias("hours"), F.count_distinct(who).alias("participants"))


def two_level_summary(df: DataFrame, keys: Sequence[str], inner: Sequence[str], seconds: str) -> DataFrame:
    """Interactions first (members, mean and spread of their durations), then groups of interactions."""
    per = df.groupBy(*keys, *inner).agg(F.count(F.lit(1)).alias("members"), F.avg(seconds).alias("mean_s"), (F.max(seconds) - F.min(seconds)).alias("spread_s"))
    return per.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("interactions"),
        F.count("mean_s").alias("with_duration"),
        (F.sum("mean_s") / 3600).alias("dyad_hours"),
        F.count_if(F.col("members") == 1).alias("one_member"),
        F.count_if(F.col("members") == 2).alias("two_members"),
        F.count_if(~F.col("members").isin(1, 2)).alias("other_members"),
        F.percentile("spread_s", F.lit(0.95)).alias("spread_p95_s"),
        F.max("spread_s").alias("spread_max_s"),
    )


def joined_set(c: str, sep: str = "+") -> Column:
    """Distinct values of a group, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def participant_summary(df: DataFrame, keys: Sequence[str], seconds: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.count(seconds).alias("with_duration"), (F.sum(seconds) / 3600).alias("hours"), joined_set("label").alias("labels"), joined_set("split").alias("splits"), F.bool_and(F.coalesce("all_modalities_present", F.lit(False))).alias("all_complete"))


def unpivot_union(tall: DataFrame, wide: DataFrame, names: dict[str, tuple[str, str]], scopes: tuple[str, str]) -> DataFrame:
    """``extension, files, bytes, scope``: sums by extension of a tall table, and of a wide one with a column each."""
    a = tall.groupBy("extension").agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").cast("bigint").alias("bytes")).withColumn("scope", F.lit(scopes[0]))
    one = wide.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(f"n{k}") for k, (p, _) in enumerate(names.values())], *[F.coalesce(F.sum(b), F.lit(0)).cast("bigint").alias(f"b{k}") for k, (_, b) in enumerate(names.values())])
    b = one.select(F.explode(F.array(*[F.struct(F.lit(e).alias("extension"), F.col(f"n{k}").alias("files"), F.col(f"b{k}").alias("bytes")) for k, e in enumerate(names)])).alias("x")).select("x.*").withColumn("scope", F.lit(scopes[1]))
    return a.unionByName(b)


def latest_with_history(log: DataFrame, key: str, stamp: Column, line: str, take: Sequence[str], who: str, what: str) -> DataFrame:
    """Last write of each key and its history: reviewers and verdicts seen, revisions, contested. One aggregation, no join."""
    at = F.struct(F.coalesce(stamp, F.lit("0001-01-01 00:00:00").cast("timestamp")), F.col(line))
    g = log.groupBy(key).agg(F.max_by(F.struct(*take), at).alias("x"), F.array_sort(F.collect_set(who)).alias("reviewers"), F.array_sort(F.collect_set(what)).alias("verdicts_seen"), F.count(F.lit(1)).alias("revisions"))
    return g.select(key, "x.*", "reviewers", "verdicts_seen", "revisions", (F.size("verdicts_seen") > 1).alias("contested"))


def reason_histogram(df: DataFrame, reasons: str, none: str = "unspecified") -> DataFrame:
    """Counts of the entries of a list column; empty and NULL lists count as ``none``."""
    each = F.explode(F.when(F.coalesce(F.size(reasons), F.lit(0)) > 0, F.col(reasons)).otherwise(F.array(F.lit(none))))
    return df.select(each.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def zero_filled_counts(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """Count of every label, 0 for those that don't occur."""
    dim = df.sparkSession.createDataFrame([(x,) for x in labels], f"`{column}` string")
    return dim.join(df.groupBy(column).agg(F.count(F.lit(1)).alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def binding_conflicts(log: DataFrame, candidates: DataFrame, key: str, claim: str) -> DataFrame:
    """Log rows whose ``claim`` differs from that of the candidate with their key; NULL and '' claim nothing."""
    own = candidates.groupBy(key).agg(F.min(claim).alias("_k_own"))
    return log.join(own, key).filter((F.col(claim) != "") & (F.col(claim) != F.col("_k_own"))).select(key, claim, F.col("_k_own").alias("expected"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a key, the first in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k_r", F.row_number().over(w)).filter("_k_r = 1").drop("_k_r")
