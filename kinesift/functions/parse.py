"""Parsing of identifiers, paths, numbers, rates, flags and times; what can't be read is NULL, never an error."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import UNIT, col, measured

# Fixed value: the grammar of file ids.
FILE_ID = r"^V(\d{2})_S(\d{4})_I(\d{8})_P([A-Za-z0-9]+)$"


def file_id_parts(c: str | Column) -> dict[str, Column]:
    """Vendor, session, interaction and participant of a file id; NULL where it isn't one."""
    x = col(c)
    names = ("vendor_id", "session_id", "interaction_id", "participant_id")
    return {n: F.when(x.rlike(FILE_ID), F.regexp_extract(x, FILE_ID, k + 1)) for k, n in enumerate(names)}


def bundle_path(label: Column, split: Column, batch: Column, archive: Column, file_id: Column) -> Column:
    return F.concat_ws("/", label, split, F.format_string("%04d", batch), F.format_string("%04d", archive), file_id)


def clip_id(file_id: str | Column, start: str | Column) -> Column:
    return F.format_string("%s_f%06d", col(file_id), col(start))


def number(c: str | Column) -> Column:
    """Text as DOUBLE; NULL for '', "N/A", anything else unreadable, and non-finite values."""
    x = F.trim(col(c)).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def rate(c: str | Column) -> Column:
    """A ratio as text ("30000/1001", "25") as DOUBLE; NULL for zero denominators and unreadable ones."""
    parts = F.split(col(c), "/")
    return F.when(F.size(parts) == 2, F.try_divide(number(parts[0]), number(parts[1]))).when(F.size(parts) == 1, number(parts[0]))


def truth(c: str | Column) -> Column:
    """Text as BOOLEAN: 1, true, yes, y, t in any case are TRUE, all else is FALSE, NULL too."""
    return F.coalesce(F.lower(F.trim(col(c))).isin("1", "true", "yes", "y", "t"), F.lit(False))


def instant(c: str | Column) -> Column:
    """ISO time of either form as TIMESTAMP; NULL where it can't be read."""
    return F.try_to_timestamp(col(c)).cast("timestamp")


def raster(width: str | Column, height: str | Column) -> Column:
    return F.concat_ws("x", F.coalesce(col(width).cast("string"), F.lit("<NA>")), F.coalesce(col(height).cast("string"), F.lit("<NA>")))


def intervals_of(c: str | Column) -> Column:
    """``array<struct<start, end>>`` with finite ends and end after start only."""
    return F.filter(col(c), lambda x: x["start"].isNotNull() & x["end"].isNotNull() & ~F.isnan(x["start"]) & (F.abs(x["start"]) < float("inf")) & (F.abs(x["end"]) < float("inf")) & (x["end"] > x["start"]))


def overlap_within(intervals: Column, a: Column, b: Column) -> Column:
    """Intervals cut to [a, b) and measured from a; those outside are dropped."""
    inside = F.filter(intervals, lambda x: (x["end"] > a) & (x["start"] < b))
    return F.transform(inside, lambda x: F.struct((F.greatest(x["start"], a) - a).alias("start"), (F.least(x["end"], b) - a).alias("end")))


def total_length(intervals: Column) -> Column:
    return F.aggregate(intervals, F.lit(0.0), lambda s, x: s + (x["end"] - x["start"]))


def blake_key(*keys: str | Column, salt: str = "", size: int = 8) -> Column:
    """blake2b of the salt and keys as hex, for keys that other tools made; one Arrow batch at a time."""

    @F.pandas_udf("string")
    def digest(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            yield s.map(lambda x: None if x is None else hashlib.blake2b(x.encode(), digest_size=size).hexdigest())

    return digest(F.concat_ws(UNIT, *([F.lit(salt)] if salt else []), *[col(k).cast("string") for k in keys]))


def unit_interval(hexes: Column) -> Column:
    """A 16-digit hex digest as a DOUBLE in [0, 1)."""
    high, low = F.conv(F.substring(hexes, 1, 8), 16, 10).cast("double"), F.conv(F.substring(hexes, 9, 8), 16, 10).cast("double")
    return (high * 4294967296.0 + low) / 18446744073709551616.0


def membership_hash(ids: str | Column) -> Column:
    """Aggregate: a number (as text) that is equal for equal sets of unique ids: the sum of 60 bits of each one's sha256.

    Sums combine before they shuffle, so a shard of any size is fingerprinted without being gathered.
    """
    return F.sum(F.conv(F.substring(F.sha2(col(ids).cast("string"), 256), 1, 15), 16, 10).cast("decimal(38,0)")).cast("string")


def overlap_seconds(start: str | Column, end: str | Column, a: float, b: float) -> tuple[Column, Column]:
    """Aggregates: how many sound intervals reach into [a, b), and their total length in it."""
    s, e = measured(start), measured(end)
    inside = (e > s) & (e > a) & (s < b)
    return F.count_if(inside), F.coalesce(F.sum(F.when(inside, F.least(e, F.lit(b)) - F.greatest(s, F.lit(a)))), F.lit(0.0))


def membership_digest(ids: str | Column) -> Column:
    """Aggregate: sha256 of the sorted ids of a shard, joined by a unit separator. A shard's ids meet in one row: for shards of
    a bounded size, as hash shards are; ``membership_hash`` has no such bound."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(col(ids).cast("string"))), UNIT), 256)
