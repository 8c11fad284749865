"""Implausible readings of per-frame series: tail cutoffs by extreme-value fits, stuck stretches, plausibility."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Durable


@dataclass(frozen=True)
class Series:
    """How one column is judged.

    low, high: what is physically possible. log: residuals are log ratios to the local level, else differences.
    stuck: so many equal readings in a row are a stuck stretch. value: only this value can be stuck (None: any).
    tails: whether spikes are sought.
    """

    name: str
    low: float = -math.inf
    high: float = math.inf
    log: bool = False
    stuck: int = 8
    value: float | None = None
    tails: bool = True


FIELDS = (
    Series("arm_speed", low=0.0, log=True),
    Series("step_cosine", low=-1.0, high=1.0),
    Series("step_cosine_right", low=-1.0, high=1.0),
    Series("hand_frozen", stuck=12, value=1.0, tails=False),
)

#: Frames of a block, and of its neighbours that it sees too. A stretch of readings goes on over at most MAX_GAP frames
#: without one, so SIDE frames hold what decides about a block's own rows: stuck - 1 readings, half a median window.
BLOCK, MAX_GAP, MEDIAN = 4096, 12, 31
SIDE = MAX_GAP * 16
#: Readings within reach that a level needs.
LEAST_NEAR = 5
#: Width of a residual bin, and bins on either side of 0.
STEP, BINS = 0.01, 600
#: Probability that a sound reading lies beyond a cutoff of its source.
RISK = 1e-7
#: Tail fits: risk of the readings that are trimmed, excesses' worth of trust in an exponential tail, bounds of the shape.
TRIM, PRIOR, SHAPES = 1e-4, 500.0, (-0.1, 0.05)
#: A block hands on residuals beyond so many times its median absolute one; those of blocks where a cutoff lies below that
#: are read again.
NOTABLE = 4.0


def local_level(frame: np.ndarray, x: np.ndarray, width: int = MEDIAN) -> np.ndarray:
    """Median of the ``width`` readings around each one that lie within SIDE frames; NaN for fewer than LEAST_NEAR.

    What lies further away doesn't count, so the level doesn't depend on where blocks are cut.
    """
    half = width // 2
    level = pd.Series(x).rolling(width, center=True, min_periods=1).median().to_numpy().copy()
    k = np.arange(len(x))
    first = np.maximum(np.maximum(k - half, 0), np.searchsorted(frame, frame - SIDE, "left"))
    after = np.minimum(np.minimum(k + half + 1, len(x)), np.searchsorted(frame, frame + SIDE, "right"))
    far = (first > np.maximum(k - half, 0)) | (after < np.minimum(k + half + 1, len(x)))
    for i in np.flatnonzero(far):
        level[i] = np.median(x[first[i] : after[i]])
    level[after - first < LEAST_NEAR] = np.nan
    return level


def equal_runs(frame: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Length of the stretch of equal neighbouring readings that each reading belongs to."""
    if not len(x):
        return np.zeros(0, int)
    new = np.r_[True, (x[1:] != x[:-1]) | (np.diff(frame) > MAX_GAP)]
    at = np.flatnonzero(new)
    return np.repeat(np.diff(np.r_[at, len(x)]), np.diff(np.r_[at, len(x)]))


def one_a_frame(frames: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """Positions of the rows in order of frames; of rows that share one, the smallest column by column."""
    o = np.argsort(frames, kind="stable")
    f = frames[o]
    first = np.r_[True, f[1:] != f[:-1]]
    shared = ~first | np.r_[~first[1:], False]
    if shared.any():
        rows = o[shared]
        o[shared] = rows[np.lexsort([c[rows] for c in reversed(columns)] + [frames[rows]])]
    return o[first]


FOUND_DDL = "file_id string, kind int, field int, at bigint, x double, n bigint"


def judge_block(pdf: pd.DataFrame, fields: tuple[Series, ...], block: int, notable: float = NOTABLE) -> pd.DataFrame:
    """Flags, notable residuals and residual counts of one block's own rows.

    kind 0: a flagged reading, at = frame; 1: a reading beyond the block's threshold, at = frame, x = residual;
    2: a bin of residuals, at = bin, n = count; 3: the threshold x of the block at.
    """
    frames, me = pdf["frame"].to_numpy(np.int64), int(pdf["block"].iloc[0])
    columns = [pdf[f.name].to_numpy(np.float64, na_value=np.nan) for f in fields]
    order = one_a_frame(frames, columns)
    frames, columns = frames[order], [c[order] for c in columns]
    own_all = frames // block == me
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray, int, int]] = []
    for k, f in enumerate(fields):
        x = columns[k]
        ok = np.isfinite(x)
        x, fr, own = x[ok], frames[ok], own_all[ok]
        if not len(x):
            continue
        impossible = (x < f.low) | (x > f.high)
        stuck = equal_runs(fr, x) >= f.stuck
        if f.value is not None:
            stuck &= x == f.value
        bad = (impossible | stuck) & own
        n = int(bad.sum())
        if n:
            out.append((fr[bad], np.zeros(n), np.zeros(n, np.int64), 0, k))
        if not f.tails:
            continue
        sound = ~impossible & ~stuck
        x, fr, own = x[sound], fr[sound], own[sound]
        if not len(x):
            continue
        level = local_level(fr, x)
        with np.errstate(divide="ignore", invalid="ignore"):
            r = np.log(np.maximum(x, 1e-3) / np.maximum(level, 1e-3)) if f.log else x - level
        judged = own & np.isfinite(r)
        r, fr = r[judged], fr[judged]
        if not len(r):
            continue
        limit = notable * float(np.median(np.abs(r)))
        hot = np.abs(r) > limit
        n = int(hot.sum())
        if n:
            out.append((fr[hot], r[hot], np.zeros(n, np.int64), 1, k))
        at, c = np.unique(np.clip(np.rint(r / STEP), -BINS, BINS).astype(np.int64), return_counts=True)
        out.append((at, np.zeros(len(at)), c, 2, k))
        out.append((np.array([me]), np.array([limit]), np.zeros(1, np.int64), 3, k))
    if not out:
        none = np.zeros(0, np.int64)
        return pd.DataFrame({"file_id": np.zeros(0, object), "kind": none.astype(np.int32), "field": none.astype(np.int32), "at": none, "x": none.astype(float), "n": none})
    sizes = [len(o[0]) for o in out]
    return pd.DataFrame(
        {
            "file_id": pdf["file_id"].iloc[0],
            "kind": np.repeat([o[3] for o in out], sizes).astype(np.int32),
            "field": np.repeat([o[4] for o in out], sizes).astype(np.int32),
            "at": np.concatenate([o[0] for o in out]),
            "x": np.concatenate([o[1] for o in out]),
            "n": np.concatenate([o[2] for o in out]),
        }
    )


def tail_cutoff(at: np.ndarray, n: np.ndarray, risk: float, sign: int) -> float:
    """Residual beyond which a sound reading lies with probability ``risk``: a generalised Pareto tail over the 90th percentile.

    First guess: the exponential tail through the 90th and 95th percentiles, which up to 5 % of spikes can't move. Then shape
    and scale by probability-weighted moments of the excesses that a tail of risk TRIM at least holds, so that spikes don't
    widen the tail that is to find them, and again until the trimming stays. The shape is drawn towards the exponential one
    by PRIOR excesses and kept within SHAPES, so that sources with few readings don't run away.
    """
    v = np.asarray(at, float) * STEP * sign
    o = np.argsort(v)
    v, c = v[o], np.asarray(n, float)[o]
    upto = np.cumsum(c)
    # linear inside a bin, so that quantiles aren't multiples of its width
    q90, q95 = (float(np.interp(p * upto[-1], np.r_[0, upto], np.r_[v[0] - STEP / 2, v + STEP / 2])) for p in (0.9, 0.95))

    def beyond(p: float) -> float:
        k = p / 0.1
        return q90 + (scale * (k**-shape - 1.0) / shape if abs(shape) > 1e-6 else -scale * math.log(k))

    scale, shape, last = max(q95 - q90, STEP / 4) / math.log(2.0), 0.0, math.inf
    for _ in range(20):
        trim = beyond(max(TRIM, risk))
        if abs(trim - last) < STEP:
            break
        last = trim
        mine = (v > q90) & (v <= trim)
        y, m = v[mine] - q90, c[mine]
        total = m.sum()
        if total < 2:
            break
        mean = max(float((y * m).sum() / total), STEP / 4)
        above = (total - np.cumsum(m) + (m - 1) / 2) / (total - 1)  # share of the other excesses above each, half of its own bin
        low = float((y * m * above).sum() / total)
        shape = min(SHAPES[1], max(SHAPES[0], 2.0 - mean / max(mean - 2.0 * low, 1e-9))) * total / (total + PRIOR)
        scale = mean * (1.0 - shape)
    return beyond(risk)


def fit_source(pdf: pd.DataFrame, fields: tuple[Series, ...], risk: float) -> pd.DataFrame:
    """Upper and lower cutoff of every series of one source."""
    rows = []
    which, ats, ns = (pdf[c].to_numpy() for c in ("field", "at", "n"))
    for k in np.unique(which):
        mine = which == k
        rows.append((pdf["file_id"].iloc[0], int(k), tail_cutoff(ats[mine], ns[mine], risk, 1), tail_cutoff(ats[mine], ns[mine], risk, -1)))
    return pd.DataFrame(rows, columns=["file_id", "field", "upper", "lower"])


def implausible_readings(tracks: DataFrame, fields: tuple[Series, ...] = FIELDS, risk: float = RISK, block: int = BLOCK) -> DataFrame:
    """Readings that cannot be real for their file: spikes, stuck stretches and physically impossible values.

    Peaks over threshold: a reading's residual is its log ratio (speeds) or difference (cosines) to the running median of the
    readings around it, the file's own slow course (frames have no calendar, so that course is the only season there is).
    Over the 90th percentile of a file's residuals a generalised Pareto tail is fitted to either side, and the cutoff is
    where a sound reading would lie with probability ``risk``; nothing else decides on spikes, so a residual that is one in a
    quiet file isn't in a lively one. Stuck: ``Series.stuck`` or more equal readings in a row; unmeasured readings in between
    don't end a stretch of up to MAX_GAP frames. Impossible: outside ``low``..``high``.

    Files are cut into blocks of frames that overlap, so a file of any length is spread over tasks; the fit of a file sees
    counts of residuals in bins (at most 2 x BINS + 1 rows a series), never its rows. A block hands on residuals beyond
    NOTABLE times its median one; blocks of which a cutoff lies lower are judged once more, so none is lost. Blocks are judged
    and written while the result is being put together.

    Returns ``file_id STRING, frame BIGINT, field_name STRING``, one row a reading.
    NULL, NaN and infinite readings are unmeasured and never returned; rows without file_id or frame are left out;
    repeated rows count once (of rows that share a frame but differ, the smallest by value counts); readings with fewer than
    LEAST_NEAR sound ones within SIDE frames have no level and are no spikes; an empty table gives an empty result; extra
    columns are ignored.
    """
    names = [f.name for f in fields]
    fr = F.col("frame")
    rows = tracks.select("file_id", fr.cast("bigint").alias("frame"), *[F.col(c).cast("double").alias(c) for c in names]).filter(F.col("file_id").isNotNull() & fr.isNotNull())
    home = F.floor(fr / F.lit(block))
    seen = F.array_distinct(F.array(home, F.floor((fr - SIDE) / F.lit(block)), F.floor((fr + SIDE) / F.lit(block))))
    parts = rows.withColumn("block", F.explode(seen))

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        return judge_block(pdf, fields, block)

    def judge_all(pdf: pd.DataFrame) -> pd.DataFrame:
        return judge_block(pdf, fields, block, -1.0)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return fit_source(pdf, fields, risk)

    tables = Durable(tracks.sparkSession)
    found = tables.keep(parts.groupBy("file_id", "block").applyInPandas(judge, FOUND_DDL))
    bins = found.filter("kind = 2").groupBy("file_id", "field", "at").agg(F.sum("n").alias("n"))
    cutoffs = tables.keep(bins.groupBy("file_id").applyInPandas(fit, "file_id string, field int, upper double, lower double"))
    x = F.col("x")
    beyond = (x > F.col("upper")) | (x < -F.col("lower"))
    hidden = found.filter("kind = 3").join(cutoffs, ["file_id", "field"]).filter(x > F.least("upper", "lower"))
    again = tables.keep(hidden.select("file_id", "field", F.col("at").alias("block")).distinct())
    spikes = found.filter("kind = 1").join(cutoffs, ["file_id", "field"]).filter(beyond).select("file_id", "field", "at")
    if again.limit(1).count():
        whole = parts.join(again.select("file_id", "block").distinct(), ["file_id", "block"], "left_semi").groupBy("file_id", "block").applyInPandas(judge_all, FOUND_DDL)
        more = whole.filter("kind = 1").join(cutoffs, ["file_id", "field"]).filter(beyond).select("file_id", "field", "at")
        spikes = spikes.unionByName(more).distinct()
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("field") + 1)
    flagged = found.filter("kind = 0").select("file_id", "field", "at").unionByName(spikes)
    return flagged.select("file_id", F.col("at").alias("frame"), label.alias("field_name"))
