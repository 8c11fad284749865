"""Top N items of every group by sorted runs and a loser-tree merge."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import measured
from ..session import Durable

#: Rows of a sorted run at most. A run is cut to N + 1 rows a group before it is stored.
RUN_ROWS = 250_000
#: Runs that one merge takes in at most; more of them are merged in levels.
FAN_IN = 64

_RUNS = pa.schema([("bucket", pa.int32()), ("run", pa.int64()), ("seq", pa.int32()), ("g", pa.string()), ("score", pa.float64()), ("tie", pa.string())])
RUNS_DDL = "bucket int, run bigint, seq int, g string, score double, tie string"
_MERGED = pa.schema([("g", pa.string()), ("tie", pa.string()), ("score", pa.float64()), ("rank", pa.int32()), ("has_more", pa.bool_())])
MERGED_DDL = "g string, tie string, score double, rank int, has_more boolean"
#: Runs of one task are numbered in this many steps.
RUNS_A_TASK = 1 << 20


class LoserTree:
    """Tournament over the heads of k sorted runs: the winner is the smallest head, each replay costs log k comparisons."""

    def __init__(self, runs: list[list]) -> None:
        self.runs, self.at = runs, [0] * len(runs)
        self.k = 1
        while self.k < max(1, len(runs)):
            self.k *= 2
        self.losers = [-1] * self.k
        winners = [-1] * (2 * self.k)
        for i in range(self.k):
            winners[self.k + i] = i if i < len(runs) else -1
        for n in range(self.k - 1, 0, -1):
            a, b = winners[2 * n], winners[2 * n + 1]
            winners[n], self.losers[n] = (a, b) if self._beats(a, b) else (b, a)
        self.winner = winners[1]

    def _beats(self, a: int, b: int) -> bool:
        if b < 0 or self.at[b] >= len(self.runs[b]):
            return True
        if a < 0 or self.at[a] >= len(self.runs[a]):
            return False
        return self.runs[a][self.at[a]] <= self.runs[b][self.at[b]]

    def head(self):
        """The smallest head, or None where all runs are at their end."""
        w = self.winner
        return self.runs[w][self.at[w]] if w >= 0 and self.at[w] < len(self.runs[w]) else None

    def move(self, to: int) -> None:
        """Puts the winning run to position ``to`` and plays its matches again."""
        w = self.winner
        self.at[w] = to
        n = (w + self.k) // 2
        while n:
            if self.losers[n] >= 0 and not self._beats(w, self.losers[n]):
                w, self.losers[n] = self.losers[n], w
            n //= 2
        self.winner = w

    def step(self) -> None:
        self.move(self.at[self.winner] + 1)

    def seek_past(self, group: str) -> None:
        """Moves every run behind ``group`` without reading the rows between."""
        while (h := self.head()) is not None and h[0] == group:
            run = self.runs[self.winner]
            self.move(bisect_right(run, group, lo=self.at[self.winner], key=lambda r: r[0]))


def merge_top(runs: list[list[tuple[str, float, str]]], n: int) -> Iterator[tuple[str, str, float, int, bool]]:
    """``(group, tie, score, rank, has_more)`` of the first n rows of each group; runs hold (group, -score, tie) in order.

    Rows equal in all three count once.
    """
    tree = LoserTree(runs)
    while (h := tree.head()) is not None:
        group, out, last, more = h[0], [], None, False
        while (h := tree.head()) is not None and h[0] == group:
            if h != last:
                if len(out) == n:
                    more = True
                    break
                out.append(h)
                last = h
            tree.step()
        tree.seek_past(group)
        for k, (_, neg, tie) in enumerate(out):
            yield group, tie, -neg, k + 1, more


def _starts(column: pa.ChunkedArray) -> np.ndarray:
    """Where rows differ from the one before, as a mask."""
    x = column.combine_chunks().dictionary_encode().indices.to_numpy() if pa.types.is_string(column.type) else column.to_numpy()
    return np.r_[True, x[1:] != x[:-1]] if len(x) else np.zeros(0, bool)


def _places(first: np.ndarray) -> np.ndarray:
    """Place of each row in its stretch, from 0, for a mask of where stretches begin."""
    at = np.flatnonzero(first)
    return np.arange(len(first)) - np.repeat(at, np.diff(np.r_[at, len(first)]))


def sorted_run(t: pa.Table, n: int, run: int) -> pa.RecordBatch:
    """One run of (bucket, g, score, tie): rows in order of bucket, group, score descending and tie, repeated rows once, no
    more than n + 1 rows a group, numbered inside their group."""
    t = t.take(pc.sort_indices(t, sort_keys=[("bucket", "ascending"), ("g", "ascending"), ("score", "descending"), ("tie", "ascending")]))
    new_g = _starts(t["g"])
    new = new_g | _starts(t["score"]) | _starts(t["tie"])
    t, new_g = t.filter(pa.array(new)), new_g[new]
    seq = _places(new_g)
    kept = seq <= n
    t, seq = t.filter(pa.array(kept)).combine_chunks(), seq[kept]
    m = len(seq)
    cols = [t["bucket"], pa.array(np.full(m, run, np.int64)), pa.array(seq.astype(np.int32)), t["g"], t["score"], t["tie"]]
    return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols], schema=_RUNS)


def merged(t: pa.Table, n: int, last: bool, merges: int) -> Iterator[pa.RecordBatch]:
    """Whole groups, their runs one after the other, merged: final rows (``last``), or rows of the run they make
    together, whose number is theirs modulo ``merges``.

    Groups that lie in one run only are passed on as they are, the others go through the loser tree.
    """
    new_g = _starts(t["g"])
    new_run = new_g | _starts(t["run"])
    at = np.flatnonzero(new_g)
    runs_of = np.add.reduceat(new_run.astype(np.int64), at)
    size = np.diff(np.r_[at, len(new_g)])
    keep = n if last else n + 1
    single = np.repeat(runs_of == 1, size)
    if single.any():
        one = t.filter(pa.array(single & (_places(new_g) < keep))).combine_chunks()
        seq = one["seq"].to_numpy()
        if last:
            more = np.repeat(size > n, size)[single & (_places(new_g) < keep)]
            cols = [one["g"], one["tie"], one["score"], pa.array(seq + 1, pa.int32()), pa.array(more)]
        else:
            cols = [one["bucket"], pa.array(one["run"].to_numpy() % merges), one["seq"], one["g"], one["score"], one["tie"]]
        yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols], schema=_MERGED if last else _RUNS)
    if single.all():
        return
    many = t.filter(pa.array(~single)).combine_chunks()
    cut = np.flatnonzero((_starts(many["g"])) | _starts(many["run"])).tolist() + [many.num_rows]
    rows = list(zip(many["g"].to_pylist(), (-many["score"].to_numpy()).tolist(), many["tie"].to_pylist(), strict=True))
    bucket, run = many["bucket"].to_pylist(), many["run"].to_pylist()
    out, k = [], 0
    while k < len(cut) - 1:
        group, slices, first = rows[cut[k]][0], [], cut[k]
        while k < len(cut) - 1 and rows[cut[k]][0] == group:
            slices.append(rows[cut[k] : cut[k + 1]])
            k += 1
        for g, tie, score, rank, more in merge_top(slices, keep):
            out.append((g, tie, score, rank, more) if last else (bucket[first], run[first] % merges, rank - 1, g, score, tie))
    schema = _MERGED if last else _RUNS
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _whole_groups(it: Iterator[pa.RecordBatch], merges: int) -> Iterator[pa.Table]:
    """Batches of rows in order of (merge, group, run, seq) -> tables of whole groups of one merge each, a merge being the
    run's number modulo ``merges``. What is held is a batch and one group."""

    def split(t: pa.Table) -> Iterator[pa.Table]:
        m = t["run"].to_numpy() % merges
        at = np.flatnonzero(np.r_[True, m[1:] != m[:-1]]).tolist() + [len(m)]
        for a, b in zip(at, at[1:], strict=False):
            yield t.slice(a, b - a)

    held = None
    for b in it:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        m = t["run"].to_numpy() % merges
        cut = int(np.flatnonzero(_starts(t["g"]) | np.r_[True, m[1:] != m[:-1]])[-1])
        if cut:
            yield from split(t.slice(0, cut))
        held = t.slice(cut)
    if held is not None:
        yield from split(held)


def top_n(df: DataFrame, group: str, score: str, tie: str, n: int, run_rows: int = RUN_ROWS, buckets: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """The n rows of highest ``score`` in every group, equal scores by smaller ``tie`` (strings, by code point).

    Sorted runs: every task sorts what it reads by (bucket, group, score descending, tie) into runs of ``run_rows`` rows, cut
    to n + 1 rows a group, since no later row of the run can be among the first n; buckets are hashes of groups. Runs are
    stored in the shared folder. A merge takes the runs of a bucket side by side, group by group (Spark's sort, which spills,
    brings a bucket's rows by group, run and place): a loser tree merges a group's runs and passes to the next group after n
    rows. It never takes more than ``fan_in`` runs; where there are more, levels of merges leave one run each until no more
    than ``fan_in`` are left. A task so holds an Arrow batch and (n + 1) x fan_in rows of one group at most, however many rows
    the group has. Runs are written, and counted, while the result is being put together.

    Returns ``group, tie, score DOUBLE, rank INT (from 1), has_more BOOLEAN`` (the group has more than n such rows).
    Rows whose group, tie or score is NULL, or whose score is NaN or infinite, are left out ("not measured"). Rows equal in
    group, score and tie count once. n < 1 or an empty table gives an empty result. Other columns are ignored.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 4 * parts
    g = F.col(group).cast("string")
    slim = df.select(F.pmod(F.hash(g), F.lit(buckets)).alias("bucket"), g.alias("g"), measured(score).alias("score"), F.col(tie).cast("string").alias("tie")).dropna()
    if n < 1:
        return slim.limit(0).select(F.col("g").alias(group), F.col("tie").alias(tie), F.col("score").alias(score), F.lit(0).alias("rank"), F.lit(False).alias("has_more"))

    def build(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        held, rows, k = [], 0, 0
        for b in it:
            held.append(b)
            rows += b.num_rows
            if rows >= run_rows:
                yield sorted_run(pa.Table.from_batches(held), n, task * RUNS_A_TASK + k)
                held, rows, k = [], 0, k + 1
        if rows:
            yield sorted_run(pa.Table.from_batches(held), n, task * RUNS_A_TASK + k)

    runs = Durable(spark).keep(slim.mapInArrow(build, RUNS_DDL))
    most = runs.agg(F.max(F.expr(f"run div {RUNS_A_TASK}")).alias("task"), F.max(F.expr(f"run % {RUNS_A_TASK}")).alias("k")).head()
    tasks, left = (most.task or 0) + 1, ((most.task or 0) + 1) * ((most.k or 0) + 1)
    at = runs.withColumn("run", F.expr(f"(run % {RUNS_A_TASK}) * {tasks} + run div {RUNS_A_TASK}"))  # dense numbers, 0 .. left - 1

    def level(rows: DataFrame, merges: int) -> DataFrame:
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in _whole_groups(it, merges):
                yield from merged(t, n, False, merges)

        near = rows.withColumn("merge", F.col("run") % merges).repartition(parts, "bucket", "merge").sortWithinPartitions("bucket", "merge", "g", "run", "seq").drop("merge")
        return near.mapInArrow(run, RUNS_DDL)

    while left > fan_in:
        left = -(-left // fan_in)
        at = level(at, left)

    def finish(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(it, 1):
            yield from merged(t, n, True, 1)

    done = at.repartition(parts, "bucket").sortWithinPartitions("bucket", "g", "run", "seq").mapInArrow(finish, MERGED_DDL)
    return done.select(F.col("g").alias(group), F.col("tie").alias(tie), F.col("score").alias(score), "rank", "has_more")


def top_clips(clips: DataFrame, n: int) -> DataFrame:
    """The n best clips of every file by ``clip_score``, then ``clip_id``."""
    return top_n(clips, "file_id", "clip_score", "clip_id", n)


def current_limit(run_config: DataFrame, name: str) -> int:
    """A limit of the current run. ``run_config`` has a fixed handful of rows; of several current ones the last run holds."""
    row = run_config.filter(F.col("is_current") & F.col(name).isNotNull()).orderBy(F.desc("run_id")).select(name).head()
    if row is None:
        raise ValueError(f"run_config has no current {name}")
    return int(row[0])


def participant_of(file_id: str | Column) -> Column:
    """The proper spelling of the participant: the P part of the file id."""
    return F.regexp_extract(file_id, r"_P([A-Za-z0-9]+)$", 1)
