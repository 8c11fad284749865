"""Train, validation and test splits that keep linked records together."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import UNIT
from ..session import Durable
from .topn import participant_of

#: Bins that components are balanced into, and components that one differencing task handles.
BINS, CHUNK = 100, 100_000


def components(links: DataFrame, node: str, key: str, max_rounds: int = 60) -> DataFrame:
    """``node, component``: nodes that share a key, also through others; a component is named by its smallest node.

    Every key links its nodes to its smallest one; then large-star and small-star steps alternate until nothing changes,
    each a minimum (combined before it shuffles) and a join, each result written, so that no lineage grows and no
    neighbourhood, however large, is gathered in a task. NULL nodes are left out; a NULL key links nothing; repeated rows
    change nothing; an empty table gives an empty result.
    """
    spark = links.sparkSession
    tables = Durable(spark)
    rows = tables.keep(links.select(F.col(node).cast("string").alias("u"), F.col(key).cast("string").alias("key")).filter("u IS NOT NULL"))
    least = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("u").alias("v"))
    edges = tables.keep(rows.join(least, "key").filter("u <> v").select("u", "v").distinct())

    def sign(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).head())

    now = sign(edges)
    for _ in range(max_rounds):
        if not now[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = tables.keep(large)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = tables.keep(hung.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        tables.drop(large)
        tables.drop(edges)
        edges, before = small, now
        now = sign(edges)
        if now == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return rows.select("u").distinct().join(edges, "u", "left").select(F.col("u").alias(node), F.coalesce("v", "u").alias("component"))


def differenced(weights: list[float], bins: int) -> list[list[int]]:
    """Largest differencing: positions of ``weights`` in ``bins`` groups of about equal sum.

    Every weight starts as a partition with one filled bin. The two partitions that are least even are combined, the
    largest bins of one with the smallest of the other, until one is left.
    """
    return combined([([w], [[k]]) for k, w in enumerate(weights)], bins)


def combined(parts: list[tuple[list[float], list[list]]], bins: int) -> list[list]:
    """As ``differenced`` for partitions that are made already: (sums, members) of up to ``bins`` bins each."""
    heap = []
    for k, (sums, members) in enumerate(parts):
        o = sorted(range(len(sums)), key=lambda i: -sums[i])
        s = [sums[i] for i in o]
        heap.append((-(s[0] - (s[-1] if len(s) >= bins else 0.0)), k, s, [members[i] for i in o]))
    heapq.heapify(heap)
    k = len(parts)
    while len(heap) > 1:
        _, _, s, a = heapq.heappop(heap)
        _, _, t, b = heapq.heappop(heap)
        # missing bins are empty, so the first of one side meet the last of the other
        room = bins - len(s)
        new_s, new_m = list(s) + [0.0] * max(0, min(room, len(t))), list(a) + [[] for _ in range(max(0, min(room, len(t))))]
        for i, (w, mem) in enumerate(zip(t, b, strict=True)):
            j = len(new_s) - 1 - i if len(new_s) == bins else len(s) + i
            new_s[j] += w
            if len(new_m[j]) < len(mem):
                new_m[j], mem = mem, new_m[j]
            new_m[j].extend(mem)
        o = sorted(range(len(new_s)), key=lambda i: -new_s[i])
        s = [new_s[i] for i in o]
        heapq.heappush(heap, (-(s[0] - (s[-1] if len(s) >= bins else 0.0)), k, s, [new_m[i] for i in o]))
        k += 1
    out = heap[0][3] if heap else []
    return out + [[] for _ in range(bins - len(out))]


def allot(sums: list[float], shares: list[tuple[str, float]]) -> list[str]:
    """A split for each bin, whole bins, largest first, to the split that lacks most of its target."""
    total, whole = sum(sums), sum(s for _, s in shares) or 1.0
    lacks = {name: total * s / whole for name, s in shares}
    out = [""] * len(sums)
    for k in sorted(range(len(sums)), key=lambda k: (-sums[k], k)):
        name = max(lacks, key=lambda n: (lacks[n], n))
        out[k] = name
        lacks[name] -= sums[k]
    return out


def assigned(groups: DataFrame, shares: list[tuple[str, float]], bins: int = BINS, chunk: int = CHUNK) -> DataFrame:
    """``component, split`` for components with a ``weight``: differencing in chunks of components, then of the chunks' bins.

    A chunk's result is itself a partition of ``bins`` bins, and partitions combine as single weights do, so the last task
    sees ``bins`` numbers a chunk and never the components. Weights that are NULL count 0.
    """
    n = groups.count()
    chunks = max(1, -(-n // chunk))

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["weight", "component"], ascending=[False, True], kind="stable").reset_index(drop=True)
        parts = differenced(pdf["weight"].tolist(), bins)
        where = pd.Series(0, index=pdf.index)
        for b, members in enumerate(parts):
            where.loc[members] = b
        return pdf.assign(bin=where)[["component", "chunk", "bin", "weight"]]

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["chunk", "bin"]).reset_index(drop=True)
        parts = [(g["weight"].tolist(), [[i] for i in g.index]) for _, g in pdf.groupby("chunk")]
        whole = combined(parts, bins)
        names = allot([float(pdf["weight"].loc[m].sum()) for m in whole], shares)
        split = pd.Series("", index=pdf.index)
        for name, m in zip(names, whole, strict=True):
            split.loc[m] = name
        return pdf.assign(split=split)[["chunk", "bin", "split"]]

    slim = groups.select("component", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight")).withColumn("chunk", F.pmod(F.xxhash64("component"), F.lit(chunks)))
    placed = Durable(groups.sparkSession).keep(slim.groupBy("chunk").applyInPandas(make, "component string, chunk bigint, bin int, weight double"))
    tops = placed.groupBy("chunk", "bin").agg(F.sum("weight").alias("weight")).groupBy(F.lit(0).alias("z")).applyInPandas(join, "chunk bigint, bin int, split string")
    return placed.join(tops, ["chunk", "bin"]).select("component", "split")


def clip_files(clips: DataFrame, weigh: bool = True) -> DataFrame:
    """One row a file: the smallest and largest split of its rows, and (``weigh``) how many clips it has."""
    more = [F.count_distinct("clip_id").alias("weight")] if weigh else []
    return clips.filter(F.col("file_id").isNotNull()).groupBy("file_id").agg(F.min("split").alias("lo"), F.max("split").alias("hi"), *more)


def file_links(clips: DataFrame) -> DataFrame:
    """``file_id, key``: what links files, by every key that any of a file's rows has. A key of which a part is missing links nothing."""

    def key(kind: str, *parts: Column) -> Column:
        ok = F.lit(True)
        for p in parts:
            ok = ok & p.isNotNull()
        return F.when(ok, F.concat_ws(UNIT, F.lit(kind), *parts))

    p = participant_of("file_id")
    keys = F.array(key("p", F.col("vendor"), F.when(p != "", p)), key("s", F.col("vendor"), F.col("session_id")), key("i", F.col("interaction_id")))
    rows = clips.filter(F.col("file_id").isNotNull()).select("file_id", "vendor", "session_id", "interaction_id").distinct()
    return rows.select("file_id", F.explode(keys).alias("key")).distinct()


def torn_files(clips: DataFrame) -> DataFrame:
    """Files whose group has rows in more than one split; NULL splits say nothing."""
    files = Durable(clips.sparkSession).keep(clip_files(clips, weigh=False))
    of = components(file_links(clips), "file_id", "key")
    groups = files.join(of, "file_id")
    torn = groups.groupBy("component").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo <> hi").select("component")
    return groups.join(torn, "component", "left_semi").select("file_id")


def grouped_splits(clips: DataFrame, targets: DataFrame) -> DataFrame:
    """``file_id, component, split``: one split a group of linked files, in the proportions of ``targets`` by clips.

    Components of files first; then largest differencing balances the components into many equal bins; whole bins go to
    the splits by target share. ``targets`` (``split, target_share``) has a fixed handful of rows.
    """
    shares = [(r.split, float(r.target_share)) for r in targets.select("split", "target_share").dropna().orderBy("split").collect()]
    files = Durable(clips.sparkSession).keep(clip_files(clips))
    of = Durable(clips.sparkSession).keep(components(file_links(clips), "file_id", "key"))
    groups = files.join(of, "file_id").groupBy("component").agg(F.sum("weight").alias("weight"))
    return of.join(assigned(groups, shares), "component").select("file_id", "component", "split")


def checks(clips: DataFrame, assigned_: DataFrame, targets: DataFrame, bins: int = BINS) -> DataFrame:
    """``what STRING, holds BOOLEAN``: every file has just one split; files that share a key have the same; no split is further
    from its share of the clips than the largest bin can be."""
    files = clip_files(clips).select("file_id", "weight")
    one = files.join(assigned_, "file_id", "left").groupBy("file_id").agg(F.count("split").alias("n"))
    torn = file_links(clips).filter("key IS NOT NULL").join(assigned_, "file_id").groupBy("key").agg((F.min("split") != F.max("split")).alias("torn"))
    sized = files.join(assigned_, "file_id")
    heaviest = sized.groupBy("component").agg(F.sum("weight").alias("w")).agg(F.max("w").alias("w"), F.sum("w").alias("total"))
    by = targets.dropna().join(sized.groupBy("split").agg(F.sum("weight").alias("n")), "split", "left")
    shares = targets.dropna().agg(F.sum("target_share").alias("all"))
    gap = by.crossJoin(F.broadcast(heaviest)).crossJoin(F.broadcast(shares))  # one row each
    far = gap.agg(F.bool_and(F.abs(F.coalesce("n", F.lit(0)) - F.col("total") * F.col("target_share") / F.col("all")) <= F.col("w") + F.col("total") / bins).alias("holds"))
    parts = (("every_file_has_one_split", one.agg(F.bool_and(F.col("n") == 1).alias("holds"))), ("linked_files_stay_together", torn.agg((~F.bool_or("torn")).alias("holds"))), ("shares_within_a_bin", far))
    out = None
    for what, df in parts:
        row = df.select(F.lit(what).alias("what"), F.coalesce("holds", F.lit(True)).alias("holds"))
        out = row if out is None else out.unionByName(row)
    return out
