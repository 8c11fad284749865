"""Mixing sources to target weights: budgets flow down a tree, leaves give token prefixes of seeded epochs."""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import Durable

#: Folder of the public vocabularies, and the one that sizes are measured in.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's makers split a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Documents of a bucket of the seeded order, about. Leaves of a tree at most.
PER_BUCKET, MOST_LEAVES = 2000, 100_000


def token_counts(df: DataFrame, text: str, keep: list[str], folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep`` columns and ``n_tokens BIGINT`` of the whole text. Rows with a NULL text are left out; '' has 0 tokens.

    The vocabulary is read where the driver is (or from a storage that Spark knows) and sent to the executors.
    """
    df.sparkSession.sparkContext.addFile(f"{folder}/{vocabulary}")
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        from pyspark import SparkFiles

        with open(SparkFiles.get(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("sizes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in it:
            n = [len(enc.encode_ordinary(t)) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    return df.filter(F.col(text).isNotNull()).select(*keep, F.col(text).alias("_k_text")).mapInArrow(run, schema)


@dataclass
class Node:
    """A part of the tree: what it may give at most, what it weighs, what it is given."""

    weight: float = 0.0
    room: float = 0.0
    given: float = 0.0
    parts: dict[str, Node] = field(default_factory=dict)


def fill(node: Node, budget: float) -> None:
    """Gives ``budget`` to the parts by weight. What a part has no room for goes to its siblings; what all of them have no
    room for was never in this node's budget, since its own room is the sum of theirs, and so went to the node's siblings.
    """
    node.given = min(budget, node.room)
    rest, open_ = node.given, [p for p in node.parts.values() if p.weight > 0 and p.room > 0]
    while open_:
        scale = rest / sum(p.weight for p in open_)
        full = [p for p in open_ if p.room <= p.weight * scale]
        if not full:
            for p in open_:
                fill(p, p.weight * scale)
            break
        for p in full:
            fill(p, p.room)
            rest -= p.room
        open_ = [p for p in open_ if p not in full]


def budgets(leaves: list[tuple[tuple[str, ...], float, float]], total: float) -> dict[tuple[str, ...], float]:
    """Leaf -> tokens, for leaves of (path, weight, room); weights of inner nodes are the sums of their leaves."""
    root = Node()
    for path, weight, room in leaves:
        node = root
        room = room if weight > 0 else 0.0
        for name in [None, *path]:
            node = root if name is None else node.parts.setdefault(name, Node())
            node.weight += weight
            node.room += room
    fill(root, total)
    out = {}
    for path, _, _ in leaves:
        node = root
        for name in path:
            node = node.parts[name]
        out[path] = node.given
    return out


def settled(ends: list[tuple[str, str, int, int]]) -> list[str]:
    """Leaves that get the document their budget ends in, of (source, leaf, its tokens, tokens the prefix lacks before it).

    What the prefixes of a source's leaves lack together goes to its leaves by largest share of the document that is covered,
    equal ones by smaller leaf, as long as it suffices: a source then lacks less than a document, not one for each leaf.
    """
    spare: dict[str, int] = {}
    for source, _, _, lacks in ends:
        spare[source] = spare.get(source, 0) + lacks
    out = []
    for source, leaf, n, _ in sorted(ends, key=lambda e: (-e[3] / e[2], e[1])):
        if n <= spare[source]:
            spare[source] -= n
            out.append(leaf)
    return out


def mixture(docs: DataFrame, doc: str, path: list[str], targets: DataFrame, total: int | None = None, seed: str = "mix") -> DataFrame:
    """The documents of a mixture whose sources have their target shares: ``doc, epoch INT, source, n_tokens``, a row a use.

    ``docs`` has ``n_tokens``, the columns of ``path`` from the root (domain, language, ..., source last) and a unique ``doc``.
    ``targets``: ``source, target_share, max_repeats``, a fixed handful of rows. A source's share is split over its
    leaves by their tokens, and weights of inner nodes are sums; the total flows down the tree (``budgets``), so what a
    leaf lacks goes to its siblings first and to those of its ancestors last. A leaf gives whole epochs and then the prefix
    of one more, in an order drawn by seed, epoch and id, that fits its budget; what the leaves of a source so lack together
    pays for the next document of some of them (``settled``). A source never gets more than its budget, a document never more
    than ``max_repeats`` uses. Budgets are set, and buckets summed, while the result is being put together; a row a leaf comes
    to the driver, and more than MOST_LEAVES leaves raise.

    total: tokens of the mixture; by default as many as the sources with a target have. The prefix is found in buckets of
    the drawn order: sums of buckets decide whole ones, and only the bucket the budget ends in is put in order.

    NULL ids, sources without a target, and NULL max_repeats (counted as 1) are settled so; NULL parts of a path are a
    value of their own ("?"). Documents of 0 tokens are used where their place in the order is reached. Empty tables give an
    empty result.
    """
    spark = docs.sparkSession
    tables = Durable(spark)
    wanted = {r.source: (float(r.target_share), int(r.max_repeats if r.max_repeats is not None else 1)) for r in targets.select("source", "target_share", "max_repeats").filter("source IS NOT NULL AND target_share > 0").collect()}
    leaf = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in path])
    rows = tables.keep(docs.filter(F.col(doc).isNotNull() & F.col(path[-1]).isin(list(wanted))).select(F.col(doc).alias("id"), leaf.alias("leaf"), F.col(path[-1]).alias("source"), F.col("n_tokens").cast("bigint").alias("n")))
    stats = rows.groupBy("leaf", "source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs")).limit(MOST_LEAVES + 1).collect()
    if len(stats) > MOST_LEAVES:
        raise ValueError("the tree has too many leaves; use coarser path columns")
    have: dict[str, int] = {}
    for r in stats:
        have[r.source] = have.get(r.source, 0) + r.n
    leaves = [(tuple(r.leaf.split("\x1f")), wanted[r.source][0] * r.n / have[r.source] if have[r.source] else 0.0, float(r.n * wanted[r.source][1])) for r in stats]
    given = budgets(leaves, float(total if total is not None else sum(have.values())))
    plan = []
    for r in stats:
        t = given[tuple(r.leaf.split("\x1f"))]
        whole = min(int(t // r.n), wanted[r.source][1]) if r.n else 0
        rest = int(t - whole * r.n) if whole < wanted[r.source][1] else 0
        bits = max(0, math.ceil(math.log2(max(1.0, r.docs / PER_BUCKET))))
        plan.append((r.leaf, whole, rest, bits))
    plan_df = spark.createDataFrame(plan, "leaf string, whole int, rest bigint, bits int")
    placed = rows.join(F.broadcast(plan_df), "leaf")  # at most MOST_LEAVES rows
    full = placed.filter("whole > 0").select("id", F.explode(F.expr("sequence(1, whole)")).alias("epoch"), "source", "n")

    order = F.xxhash64(F.lit(seed), F.col("whole") + 1, F.col("id").cast("string"))
    last = placed.filter("rest > 0").withColumn("h", order).withColumn("bucket", F.expr("CASE WHEN bits = 0 THEN 0L ELSE shiftrightunsigned(h, 64 - bits) END"))
    before = Window.partitionBy("leaf").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = last.groupBy("leaf", "rest", "bucket").agg(F.sum("n").alias("s")).withColumn("ahead", F.coalesce(F.sum("s").over(before), F.lit(0)))
    reached = sums.filter("ahead <= rest").select("leaf", "bucket", "s", "ahead")
    cut = last.join(reached, ["leaf", "bucket"])
    inside = Window.partitionBy("leaf", "bucket").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0)
    ends = tables.keep(cut.filter("ahead + s > rest").withColumn("upto", F.col("ahead") + F.sum("n").over(inside)).filter("upto - n <= rest"))
    # the document that a leaf's budget ends in: one a leaf, and what the leaf's prefix lacks before it
    over = ends.filter("upto > rest").select("leaf", "source", "n", (F.col("rest") - F.col("upto") + F.col("n")).alias("lacks"))
    more = spark.createDataFrame([(x,) for x in settled([(r.source, r.leaf, r.n, r.lacks) for r in over.collect()])], "leaf string")
    use = ["id", (F.col("whole") + 1).alias("epoch"), "source", "n"]
    prefix = cut.filter("ahead + s <= rest").select(*use).unionByName(ends.filter("upto <= rest").select(*use)).unionByName(ends.filter("upto > rest").join(F.broadcast(more), "leaf", "left_semi").select(*use))
    return full.unionByName(prefix).select(F.col("id").alias(doc), F.col("epoch").cast("int").alias("epoch"), "source", F.col("n").alias("n_tokens"))


def reached_shares(mixed: DataFrame, targets: DataFrame, doc: str) -> DataFrame:
    """What each source has in the mixture: ``source, target_share, reached_share, n_tokens, n_documents, most_repeats``."""
    uses = mixed.groupBy("source", doc).agg(F.count(F.lit(1)).alias("uses"), F.sum("n_tokens").alias("n"))
    by = uses.groupBy("source").agg(F.sum("n").alias("n_tokens"), F.count(F.lit(1)).alias("n_documents"), F.max("uses").alias("most_repeats"))
    all_ = by.agg(F.sum("n_tokens").alias("t"))
    out = targets.select("source", "target_share").join(by, "source", "left").crossJoin(F.broadcast(all_))  # one row
    return out.select("source", "target_share", F.coalesce(F.col("n_tokens") / F.col("t"), F.lit(0.0)).alias("reached_share"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_tokens", "n_documents", "most_repeats")])


def language(c: str | Column) -> Column:
    """Two-letter language tag in lower case; everything else is "und"."""
    x = F.lower(F.trim(F.col(c) if isinstance(c, str) else c))
    return F.when(x.rlike("^[a-z]{2}$"), x).otherwise(F.lit("und"))


# The domain of each source of this project.
DOMAINS = {"transcript_asr": "speech", "session_log": "speech", "reviewer_note": "review", "annotator_help": "review", "ipc_prompt": "prompts", "run_report": "engineering", "design_note": "engineering"}


def document_sizes(docs: DataFrame, folder: str = TOKENIZERS, domains: DataFrame | None = None) -> DataFrame:
    """``doc_id, domain, lang, source, n_tokens`` of documents. ``domains`` (``source, domain``) says where sources belong, those of
    this project by default; a source without one is "other", of several the smallest counts."""
    spark = docs.sparkSession
    of = domains if domains is not None else spark.createDataFrame(list(DOMAINS.items()), "source string, domain string")
    of = of.filter("source IS NOT NULL AND domain IS NOT NULL").groupBy("source").agg(F.min("domain").alias("domain"))
    if of.limit(MOST_LEAVES + 1).count() > MOST_LEAVES:
        raise ValueError("too many sources")
    slim = docs.select("doc_id", "source", language("lang").alias("lang"), "text").join(F.broadcast(of), "source", "left").withColumn("domain", F.coalesce("domain", F.lit("other")))
    return token_counts(slim, "text", ["doc_id", "domain", "lang", "source"], folder)


def document_mixture(docs: DataFrame, targets: DataFrame, folder: str = TOKENIZERS, total: int | None = None, domains: DataFrame | None = None) -> DataFrame:
    """The mixture of ``documents`` for ``source_targets`` through the tree domain, language, source."""
    return mixture(document_sizes(docs, folder, domains), "doc_id", ["domain", "lang", "source"], targets, total)


def checks(sizes: DataFrame, mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, share_kept, repeats_kept BOOLEAN``: what must hold for each source with a target.

    Its tokens are its share of all with a target, up to less than its longest document, or all that its repeats allow; or
    more, where others lack; no document is used more often than it may be.
    """
    t = targets.filter("source IS NOT NULL AND target_share > 0").select("source", "target_share", F.coalesce("max_repeats", F.lit(1)).alias("most"))
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("have"), F.max("n_tokens").alias("longest"))
    uses = mixed.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("u"), F.sum("n_tokens").alias("n")).groupBy("source").agg(F.max("u").alias("u"), F.sum("n").alias("n"))
    j = t.join(have, "source", "left").join(uses, "source", "left")
    total = j.agg(F.sum("have").alias("total"), F.sum("target_share").alias("shares"))
    want = F.least(F.col("target_share") / F.col("shares") * F.col("total"), F.col("have") * F.col("most"))
    n = F.coalesce("n", F.lit(0))
    out = j.crossJoin(F.broadcast(total))  # one row
    return out.select("source", F.coalesce(n > want - F.col("longest") - 1, F.lit(True)).alias("share_kept"), F.coalesce(F.col("u") <= F.col("most"), F.lit(True)).alias("repeats_kept"))
