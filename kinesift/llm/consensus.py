"""Consensus of annotators' labels by a community confusion model."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Durable

#: Communities at the start: chance that a member says accept where reject is right, and where accept is right.
COMMUNITIES = ((0.05, 0.95), (0.25, 0.75), (0.5, 0.5), (0.8, 0.95), (0.05, 0.65), (0.05, 0.2), (0.8, 0.2))
#: Labels' worth of trust in a community's starting matrix, and of a community's matrix for each of its members.
PRIOR, SHRINK = 8.0, 12.0
ROUNDS, SETTLED = 15, 1e-3


def trimmed(c: str) -> Column:
    """Lower case, without outer spaces of any kind."""
    return F.lower(F.regexp_replace(F.col(c), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


def standing_verdicts(log: DataFrame) -> DataFrame:
    """The last verdict of every reviewer on every item: ``item, who, label, source``.

    Last by ``recorded_utc``, unreadable times first, then by ``log_line``. Rows without item, reviewer or verdict are left out.
    """
    when = F.coalesce(F.try_to_timestamp(F.col("recorded_utc")).cast("timestamp"), F.lit("0001-01-01 00:00:00").cast("timestamp"))
    rows = log.select(F.col("review_item_id").alias("item"), trimmed("reviewer").alias("who"), trimmed("verdict").alias("label"), F.col("verdict_source").alias("source"), when.alias("ts"), "log_line").filter("item IS NOT NULL AND who <> '' AND label <> ''")
    return rows.groupBy("item", "who").agg(F.max_by(F.struct("label", "source"), F.struct("ts", "log_line", "label")).alias("x")).select("item", "who", "x.label", "x.source")


def digamma(x: np.ndarray) -> np.ndarray:
    """Logarithmic derivative of the gamma function, for x > 0, by recurrence and series."""
    x = np.asarray(x, float)
    y = x + 6
    out = np.log(y) - 0.5 / y - 1 / (12 * y * y) + 1 / (120 * y**4)
    for k in range(6):
        out = out - 1 / (x + k)
    return out


@dataclass
class Consensus:
    """items: item, accept_probability, n_accept, n_reject. annotators: who, n_labels, reliability, sensitivity,
    specificity, community. communities: (accept where reject is right, accept where accept is right, share of annotators).
    rounds: how many were needed; settled: FALSE where they ended before the communities' counts did."""

    items: DataFrame
    annotators: DataFrame
    communities: list[tuple[float, float, float]]
    rounds: int = 0
    settled: bool = True


def consensus(labels: DataFrame, start: tuple[tuple[float, float], ...] = COMMUNITIES, rounds: int = ROUNDS) -> Consensus:
    """Consensus of binary labels ``item, who, y`` (1 accept, 0 reject; one row an item and annotator).

    Annotators belong to communities that share a confusion matrix. Variational updates in turn: an item's chance of being
    right to accept, from its labels and the expected log confusion of those who gave them; each annotator's soft counts,
    from the items; each annotator's communities, and the communities' matrices, from the counts. An annotator's own matrix
    is drawn towards its communities' by SHRINK labels, so that those with few labels lean on their type.

    All per-item and per-annotator values stay in tables; only the communities' few numbers come to the driver. Sums
    combine before they shuffle, so an item or annotator with a large part of all labels is no burden. Rounds end where the
    communities' counts move by less than SETTLED of all labels, or after ``rounds``, which is said by ``settled`` and a warning.
    Rounds run while the result is being put together.

    Rows with a NULL, or y other than 0 and 1, are left out. Items without labels don't occur. An annotator with one label is
    judged by its community. An empty table gives empty results.
    """
    spark = labels.sparkSession
    tables = Durable(spark)
    m = len(start)
    votes = tables.keep(labels.filter("item IS NOT NULL AND who IS NOT NULL AND y IN (0, 1)").select("item", "who", F.col("y").cast("int").alias("y")))
    share = votes.groupBy("item").agg(((F.sum("y") + 0.5) / (F.count(F.lit(1)) + 1)).alias("q"))
    model = Model(PRIOR * np.array([[[1 - a, a], [1 - b, b]] for a, b in start]), np.ones(m), np.ones(2))

    def counted(q: DataFrame) -> DataFrame:
        """n_ky: labels y of an annotator on items where k is right."""
        one, y = F.col("q"), F.col("y")
        return (
            votes.join(q, "item")
            .groupBy("who")
            .agg(F.sum((1 - one) * (1 - y)).alias("n00"), F.sum((1 - one) * y).alias("n01"), F.sum(one * (1 - y)).alias("n10"), F.sum(one * y).alias("n11"))
        )

    def each(df: DataFrame, f: Callable[[pd.DataFrame], pd.DataFrame], ddl: str) -> DataFrame:
        return df.mapInPandas(lambda it: (f(p) for p in it if len(p)), ddl)

    def items_of(workers: DataFrame, model: Model) -> DataFrame:
        """Chance of each item that accept is right, from the expected log confusion of its annotators."""
        weights = each(workers, model.weights, "who string, w0 double, w1 double")
        base = float(digamma(model.prior[1]) - digamma(model.prior[0]))
        odds = votes.join(weights, "who").groupBy("item").agg((F.sum(F.when(F.col("y") == 1, F.col("w1")).otherwise(F.col("w0"))) + base).alias("o"), F.sum("y").alias("n_accept"), F.sum(1 - F.col("y")).alias("n_reject"))
        return odds.select("item", (1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.col("o")))))).alias("q"), "n_accept", "n_reject")

    placed = "who string, n00 double, n01 double, n10 double, n11 double, " + ", ".join(f"r{c} double" for c in range(m))
    cells = [(c, k, y) for c in range(m) for k in (0, 1) for y in (0, 1)]
    workers = tables.keep(each(counted(share), model.placed, placed))
    before, done, settled = None, 0, False
    for done in range(1, rounds + 1):
        sums = workers.agg(*[F.sum(f"r{c}").alias(f"r{c}") for c in range(m)], *[F.sum(F.col(f"r{c}") * F.col(f"n{k}{y}")).alias(f"a{c}{k}{y}") for c, k, y in cells], *[F.sum(F.col(f"n{k}0") + F.col(f"n{k}1")).alias(f"p{k}") for k in (0, 1)]).head()
        if sums["p0"] is None:
            settled = True
            break
        soft = np.array([sums[f"a{c}{k}{y}"] for c, k, y in cells]).reshape(m, 2, 2)
        base = PRIOR * np.array([[[1 - a, a], [1 - b, b]] for a, b in start])
        model = Model(base + soft, np.array([1.0 + sums[f"r{c}"] for c in range(m)]), np.array([1.0 + sums["p0"], 1.0 + sums["p1"]]))
        if before is not None and np.abs(soft - before).sum() < SETTLED * soft.sum():
            settled = True
            break
        before, old = soft, workers
        workers = tables.keep(each(counted(items_of(workers, model)), model.placed, placed))
        tables.drop(old)
    if not settled:
        warnings.warn(f"consensus: not settled after {rounds} rounds", stacklevel=2)
    items = items_of(workers, model).select("item", F.col("q").alias("accept_probability"), "n_accept", "n_reject")
    annotators = each(workers, model.judged, "who string, n_labels bigint, reliability double, sensitivity double, specificity double, community int")
    share_of = (model.size - 1) / max(1.0, model.size.sum() - m)
    return Consensus(items, annotators, [(float(a[0, 1] / a[0].sum()), float(a[1, 1] / a[1].sum()), float(s)) for a, s in zip(model.alpha, share_of, strict=True)], done, settled)


@dataclass(frozen=True)
class Model:
    """What all annotators share: the communities' Dirichlet counts (community, right label, label), their sizes, the labels'."""

    alpha: np.ndarray
    size: np.ndarray
    prior: np.ndarray

    def placed(self, p: pd.DataFrame) -> pd.DataFrame:
        """Adds r0..: each annotator's chance of belonging to each community."""
        n = p[["n00", "n01", "n10", "n11"]].to_numpy()
        logs = (digamma(self.alpha) - digamma(self.alpha.sum(axis=2, keepdims=True))).reshape(len(self.size), 4)
        x = n @ logs.T + digamma(self.size) - digamma(self.size.sum())
        x = np.exp(x - x.max(axis=1, keepdims=True))
        x /= x.sum(axis=1, keepdims=True)
        return p.assign(**{f"r{c}": x[:, c] for c in range(len(self.size))})

    def own(self, p: pd.DataFrame) -> np.ndarray:
        """Each annotator's pseudo-counts (annotator, right label, label): its own and its communities'."""
        n = p[["n00", "n01", "n10", "n11"]].to_numpy().reshape(-1, 2, 2)
        r = p[[f"r{c}" for c in range(len(self.size))]].to_numpy()
        mean = self.alpha / self.alpha.sum(axis=2, keepdims=True)
        return n + SHRINK * np.einsum("nc,cky->nky", r, mean)

    def weights(self, p: pd.DataFrame) -> pd.DataFrame:
        """What a label of each annotator adds to the log odds of its item: w0 for reject, w1 for accept."""
        b = self.own(p)
        e = digamma(b) - digamma(b.sum(axis=2, keepdims=True))
        return pd.DataFrame({"who": p["who"], "w0": e[:, 1, 0] - e[:, 0, 0], "w1": e[:, 1, 1] - e[:, 0, 1]})

    def judged(self, p: pd.DataFrame) -> pd.DataFrame:
        b = self.own(p)
        mean = b / b.sum(axis=2, keepdims=True)
        p1 = self.prior[1] / self.prior.sum()
        r = p[[f"r{c}" for c in range(len(self.size))]].to_numpy()
        n = np.rint(p[["n00", "n01", "n10", "n11"]].to_numpy().sum(axis=1)).astype(np.int64)
        return pd.DataFrame({"who": p["who"], "n_labels": n, "reliability": mean[:, 0, 0] * (1 - p1) + mean[:, 1, 1] * p1, "sensitivity": mean[:, 1, 1], "specificity": mean[:, 0, 0], "community": (r.argmax(axis=1) + 1).astype(np.int32)})


def votes_of(log: DataFrame) -> DataFrame:
    """Accept and reject among the standing verdicts as ``item, who, y, source``; unsure speaks for neither."""
    return standing_verdicts(log).filter(F.col("label").isin("accept", "reject")).select("item", "who", F.when(F.col("label") == "accept", 1).otherwise(0).alias("y"), "source")


def agreement(votes: DataFrame) -> DataFrame:
    """Per item: ``n_accept, n_reject`` and the share of pairs of reviewers who agree (NULL below two labels)."""
    a, r = F.col("n_accept"), F.col("n_reject")
    n = a + r
    pairs = F.when(n > 1, (a * (a - 1) + r * (r - 1)) / (n * (n - 1)))
    return votes.groupBy("item").agg(F.sum("y").alias("n_accept"), F.sum(1 - F.col("y")).alias("n_reject")).select("item", "n_accept", "n_reject", pairs.alias("agreement"))


def krippendorff_alpha(votes: DataFrame) -> DataFrame:
    """Nominal alpha over all items with two labels or more: ``n_items, n_labels, alpha`` (1 agreement, 0 chance)."""
    a, r = F.col("n_accept"), F.col("n_reject")
    units = agreement(votes).filter(a + r > 1)
    sums = units.agg(F.count(F.lit(1)).alias("n_items"), F.sum(a + r).alias("n_labels"), F.sum(2 * a * r / (a + r - 1)).alias("split"), F.sum(a).alias("acc"), F.sum(r).alias("rej"))
    expected = 2 * F.col("acc") * F.col("rej") / (F.col("n_labels") - 1)
    return sums.select("n_items", "n_labels", F.when(expected > 0, 1 - F.col("split") / expected).alias("alpha"))
