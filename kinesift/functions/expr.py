"""Column helpers shared by all operators: measured values, rounding, rules as data, hash order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "\x1f"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def measured(c: str | Column) -> Column:
    """The value as DOUBLE, or NULL where it is NULL, NaN or infinite ("not measured")."""
    x = col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def rint(c: str | Column) -> Column:
    """Round half to even, as BIGINT; NULL beyond its range."""
    return F.rint(col(c)).try_cast("bigint")


def hash_order(seed: str, *keys: str | Column) -> Column:
    """A reproducible shuffle key: sha256 of the seed and the keys, hex."""
    return F.sha2(F.concat_ws(UNIT, F.lit(seed), *[col(k).cast("string") for k in keys]), 256)


def ramp(c: str | Column, lo: float, hi: float) -> Column:
    """0 at ``lo``, 1 at ``hi``, linear and clipped between; NULL where not measured."""
    x = measured(c)
    return F.when(x.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - lo) / (hi - lo))))


def clause(column: str, op: str, limit: float) -> Column:
    """One rule ``column op limit``; a value that isn't measured fails it."""
    x = measured(column)
    test = {">=": x >= limit, "<=": x <= limit, ">": x > limit, "<": x < limit, "==": x == limit}[op]
    return F.coalesce(test, F.lit(False))


def first_failure(clauses: Sequence[tuple[str, str, float, str]]) -> Column:
    """Label of the first failing ``(column, op, limit, label)``, NULL where all hold."""
    return F.coalesce(*[F.when(~clause(c, op, lim), F.lit(label)) for c, op, lim, label in clauses])


def all_failures(clauses: Sequence[tuple[str, str, float, str]], sep: str = ";") -> Column:
    """Every failing label, joined; '' where all hold."""
    return F.concat_ws(sep, *[F.when(~clause(c, op, lim), F.lit(label)) for c, op, lim, label in clauses])


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df``, or a KeyError that lists every missing column at once."""
    if missing := sorted(set(names) - set(df.columns)):
        raise KeyError(f"missing columns: {', '.join(missing)}")
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, or a ValueError that names one repeated key."""
    if rows := duplicate_keys(df, keys).limit(1).collect():
        raise ValueError(f"key {tuple(keys)} repeats: {rows[0].asDict()}")
    return df


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    name, k = f"_k_{stem}", 0
    while name.lower() in taken:
        k += 1
        name = f"_k_{stem}{k}"
    return name
