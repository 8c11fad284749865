"""Passages of held-out items inside a corpus: one Aho-Corasick automaton, offsets mapped to the original text."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .confusables import FOLDED, fold

#: Words of an item that must be found in its order.
LEAST_WORDS = 16
#: What tells a passage from stacked phrases: a phrase of so many words, or a stretch over single changed words of so many
#: points, its words less one for each changed or put in. Sentences of one template with other words filled in reach 11 in sf0.1.
LEAST_PHRASE, LEAST_POINTS = 8, 12
#: Points of a stretch over single changed words that counts at any distance from another such; where an item goes on (one
#: word left out at most), fewer do.
APART_POINTS, ONWARD_POINTS = 8, 5
#: Words on either side that may lie between near stretches, if neither has fewer than twice as many points.
NEAR = 12
#: Changed words in a row that a telling stretch may go over; more cost more than a phrase of seven words gives.
ROW = 6
#: Points that matter put in between two words of an item costs a stretch, at most.
INSERTION = 4
#: Letters that runs of fewer than five words must have where they don't begin and end with words of the text.
INSIDE_LETTERS = 12
#: Pairs of words side by side that such a stretch has at least; and steps from the first of a phrase's pairs to its last.
LEAST_PAIRS, PHRASE_PAIRS = LEAST_POINTS - 1, LEAST_PHRASE - 2
#: Items of one automaton; more of them are searched in blocks.
ITEMS_AT_ONCE = 20_000


class _Best:
    """Largest value put at or before a place (from 1 on): a Fenwick tree of maxima that grows as it is filled."""

    def __init__(self) -> None:
        self.tree: dict[int, tuple[int, int]] = {}
        self.size = 1

    def put(self, place: int, value: tuple[int, int]) -> None:
        while self.size < place:  # a longer tree: its new last node holds all before it
            old = self.tree.get(self.size)
            self.size *= 2
            if old:
                self.tree[self.size] = old
        while place <= self.size:
            self.tree[place] = max(self.tree.get(place, value), value)
            place += place & -place

    def upto(self, place: int) -> tuple[int, int] | None:
        best, place = None, min(place, self.size)
        while place:
            if place in self.tree and (best is None or self.tree[place] > best):
                best = self.tree[place]
            place -= place & -place
        return best


class Passages:
    """Seeds of the items: an automaton over every two words side by side, written without spaces and marks, and the pairs of
    words that are next to each other, or have one between them, in the item: looked up with one word between them in the text,
    that finds them around a word put in or changed."""

    def __init__(self, items: list[tuple[object, str]], least: int = LEAST_WORDS) -> None:
        kept = {(i, tuple(w)) for i, t in items if len(w := fold(t).split()) >= least}  # an id may have several texts
        self.ids = [i for i, _ in kept]
        self.lists = [list(w) for _, w in kept]
        self.least = least
        self.width = max(map(len, self.lists), default=1)
        side: dict[str, list[tuple[int, int]]] = {}
        apart: dict[tuple[str, str], list[tuple[int, int, int]]] = {}
        for i, w in enumerate(self.lists):
            for p in range(len(w) - 1):
                side.setdefault(w[p] + w[p + 1], []).append((i, p))
                apart.setdefault((w[p], w[p + 1]), []).append((i, p, 1))
            for p in range(len(w) - 2):
                apart.setdefault((w[p], w[p + 2]), []).append((i, p, 2))
        self.side, self.apart = list(side.values()), apart
        self.places = [np.array([i * self.width + p for i, p in at]) for at in self.side]
        self.ac = ahocorasick.Automaton()
        for k, t in enumerate(side):
            self.ac.add_word(t, (len(t), k))
        if side:
            self.ac.make_automaton()
        self.any = bool(side)

    def runs(self, doc_words: list[str], compact: str) -> dict[int, list[list[int]]]:
        """Index of item -> exact runs [doc from, doc to, item word from, item word to), in order of the document.

        Only of items with LEAST_PAIRS pairs of words at different places, or those of a phrase side by side.
        """
        beside = [(end + 1 - n, k) for end, (n, k) in self.ac.iter(compact)]
        if not beside:
            return {}
        places = np.concatenate([self.places[k] for k in {k for _, k in beside}])
        n = np.bincount(places // self.width)
        alive = {*np.flatnonzero(n >= LEAST_PAIRS).tolist()}
        few = np.sort(places[(n < LEAST_PAIRS)[places // self.width]])
        alive.update((few[PHRASE_PAIRS:][few[PHRASE_PAIRS:] - few[:-PHRASE_PAIRS] == PHRASE_PAIRS] // self.width).tolist())
        if not alive:
            return {}
        found: dict[int, set[tuple[int, int]]] = {i: set() for i in alive}
        kept: dict[int, list[tuple[int, int]]] = {}
        for start, k in beside:
            if k not in kept:
                kept[k] = [x for x in self.side[k] if x[0] in alive]
            for i, p in kept[k]:
                found[i].add((start, p))
                found[i].add((start + len(self.lists[i][p]), p + 1))
        doc_at = _starts(doc_words)
        for at, two in enumerate(zip(doc_words, doc_words[2:], strict=False)):
            for i, p, step in self.apart.get(two, ()):
                if i in alive:
                    found[i].add((doc_at[at], p))
                    found[i].add((doc_at[at + 2], p + step))
        edges = {*doc_at, len(compact)}
        out = {}
        for i, atoms in found.items():
            if len({p for _, p in atoms}) < self.least:  # a chain takes each item word once
                continue
            w, mine, open_ = self.lists[i], [], {}
            for start, p in sorted(atoms):
                run = open_.pop((start, p), None)
                if run is None:
                    mine.append(run := [start, start, p, p])
                run[1], run[3] = start + len(w[p]), p + 1
                open_[run[1], run[3]] = run
            out[i] = [r for r in mine if r[3] - r[2] >= 5 or r[1] - r[0] >= INSIDE_LETTERS or (r[0] in edges and r[1] in edges)]
        return out

    def align(self, runs: list[list[int]], index: dict[int, int]) -> tuple[int, int, int]:
        """Most words found in order by a chain of runs that a passage has: ``(words, doc from, doc to)`` in compact characters."""
        telling = [p >= LEAST_POINTS or b - a >= LEAST_PHRASE for p, (_, _, a, b) in zip(_stretches(runs, index, ROW), runs, strict=True)]
        if not any(telling):
            return 0, 0, 0
        points = _stretches(runs, index, 1)
        # most words of a chain up to a run, and where it starts: of any chain, and of one with a telling run
        plain: list[tuple[int, int]] = []
        sound: list[tuple[int, int] | None] = []
        at = list(index)  # where words begin
        by_end = sorted((run[1], k) for k, run in enumerate(runs))
        ended, far_plain, far_sound = 0, _Best(), _Best()
        on_plain: dict[int, tuple[int, int]] = {}
        on_sound: dict[int, tuple[int, int]] = {}
        for k, run in enumerate(runs):
            ds, _, a, b = run
            while ended < len(by_end) and by_end[ended][0] <= ds:
                j = by_end[ended][1]
                if points[j] >= APART_POINTS:
                    far_plain.put(runs[j][3], plain[j])
                    if sound[j]:
                        far_sound.put(runs[j][3], sound[j])
                if points[j] >= ONWARD_POINTS:  # one best of each end suffices
                    e = runs[j][3]
                    on_plain[e] = max(on_plain.get(e, plain[j]), plain[j])
                    if sound[j]:
                        on_sound[e] = max(on_sound.get(e, sound[j]), sound[j])
                ended += 1
            tops, goods = [(0, -ds)], [None]
            if points[k] >= APART_POINTS:
                tops.append(far_plain.upto(a))
                goods.append(far_sound.upto(a))
            if points[k] >= ONWARD_POINTS:
                tops += [on_plain.get(a), on_plain.get(a - 1)]
                goods += [on_sound.get(a), on_sound.get(a - 1)]
            least = min(ds - NEAR * INSIDE_LETTERS, at[max(0, index[ds] - NEAR)] if ds in index else ds)
            for _, j in by_end[bisect_left(by_end, (least, 0)) : ended]:
                if 0 <= a - runs[j][3] <= NEAR:
                    gap = _between(runs[j], run, index)
                    if gap <= 1 or (gap <= NEAR and min(points[j], points[k]) >= 2 * gap):
                        tops.append(plain[j])
                        goods.append(sound[j])
            top, good = max(filter(None, tops)), max(filter(None, goods), default=None)
            plain.append((top[0] + b - a, top[1]))
            sound.append(plain[k] if telling[k] else good and (good[0] + b - a, good[1]))
        k = max((k for k in range(len(runs)) if sound[k]), key=lambda k: sound[k])
        return sound[k][0], -sound[k][1], runs[k][1]


def _starts(words: list[str]) -> list[int]:
    """Where each word begins in the text without spaces."""
    return [0, *accumulate(map(len, words))][: len(words)]


def _words_between(lo: int | None, hi: int | None, letters: int) -> int:
    """Words of the text between two runs; where it isn't written in words, by its letters."""
    if lo is None or hi is None or 1 < hi - lo == letters:
        return -(-letters // INSIDE_LETTERS)
    return hi - lo


def _between(before: list[int], after: list[int], index: dict[int, int]) -> int:
    """Words between two runs that follow each other, in item or text, whichever are more."""
    return max(after[2] - before[3], _words_between(index.get(before[1]), index.get(after[0]), after[0] - before[1]))


def _stretches(runs: list[list[int]], index: dict[int, int], row: int) -> list[int]:
    """Points of the best stretch that each run lies in: its words, less one for each word changed, left out or put in.

    A stretch goes on over up to ``row`` changed words and over up to NEAR words put in.
    """
    size = [b - a for _, _, a, b in runs]
    ends: dict[int, list[int]] = {}
    links = []
    for k, run in enumerate(runs):
        for e in range(run[2] - row, run[2] + 1):
            for j in ends.get(e, ()):
                if runs[j][1] <= run[0] and (gap := _between(runs[j], run, index)) <= (row + 1 if e < run[2] else NEAR):
                    links.append((j, k, gap if e < run[2] else min(gap, INSERTION)))
        ends.setdefault(run[3], []).append(k)
    upto, onward = list(size), list(size)
    for j, k, gap in links:
        upto[k] = max(upto[k], size[k] + upto[j] - gap)
    for j, k, gap in reversed(links):
        onward[j] = max(onward[j], size[j] + onward[k] - gap)
    return [u + o - n for u, o, n in zip(upto, onward, size, strict=True)]


def passages_in(text: str, p: Passages, least: int = LEAST_WORDS) -> list[tuple[object, int, int, int]]:
    """``(item, words, from, to)`` of the items whose passage the text holds, offsets in the text as it is."""
    doc_words = fold(text).split()
    compact = "".join(doc_words)
    found = p.runs(doc_words, compact) if p.any else {}
    out, index, spans = [], None, None
    for i, runs in found.items():
        if sum(b - a for _, _, a, b in runs) < least:
            continue
        if index is None:
            index = {a: k for k, a in enumerate([*_starts(doc_words), len(compact)])}
        n_words, start, end = p.align(runs, index)
        if n_words >= least:
            if spans is None:  # original position of every compact character
                spans = [k for k, ch in enumerate(text) for c in FOLDED[ord(ch)] if c != " "]
            out.append((p.ids[i], n_words, spans[start], spans[end - 1] + 1))
    return out


def leaked_passages(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str, least: int = LEAST_WORDS) -> DataFrame:
    """Every document and held-out item where the document holds ``least`` words of the item's passage in its order.

    Both sides are folded: look-alike letters, width and style forms, case, accents, punctuation, spacing and invisible
    characters don't matter. Seeds are any two item words side by side (one automaton passes over each text once), and those
    around a single word that was changed or put in. Exact runs are chained in order; the chain of most words must hold
    ``least`` of them, and a phrase of LEAST_PHRASE words or a stretch over single changed words and words put in of
    LEAST_POINTS points, which short phrases, however many, don't have: 16 words with up to four changed or put in among them
    are found, longer ones down to runs of two words. Stretches of APART_POINTS points count at any distance, of
    ONWARD_POINTS where the item goes on without a gap; shorter ones within NEAR words of another, if they have twice the
    points of what lies between. A text that keeps no phrase of eight words and changes more than that can't be told from
    another sentence of the same template, and isn't found.

    Items are a stated set (300 here). They are read in blocks of ITEMS_AT_ONCE by the hash of their id, each with its own
    automaton and its own scan of the documents, so what a task holds is bounded; every document is scanned whole, none is
    left out. The items are counted and brought to the driver, which sends them to the tasks, while the result is being put
    together.

    Returns ``doc_id, item_id`` in the types they have, ``n_words, start_char, end_char INT`` (code points of the text as it
    is). NULL texts or ids give nothing; empty texts and items shorter than ``least`` words match nothing; several texts of one
    id count for it together; repeated ids and repeated rows give one row a pair; empty tables give an empty result; other
    columns are ignored.
    """
    held = items.select(F.col(item).alias("i"), F.col(item_text).alias("t")).dropna().distinct()
    blocks = max(1, -(-held.count() // ITEMS_AT_ONCE))
    rows = docs.select(F.col(doc).alias("d"), F.col(text).alias("t")).dropna()
    doc_type, item_type = rows.schema["d"].dataType, held.schema["i"].dataType
    ddl = f"doc_id {doc_type.simpleString()}, item_id {item_type.simpleString()}, n_words int, start_char int, end_char int"
    out = None
    for k in range(blocks):
        block = [(r.i, r.t) for r in held.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k).collect()]
        found = rows.mapInArrow(_scanner(block, least, to_arrow_type(item_type)), ddl)
        out = found if out is None else out.unionByName(found)
    best = out.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_words", (-F.col("start_char")).alias("back"), "end_char")).alias("x"))
    return best.select("doc_id", "item_id", "x.n_words", (-F.col("x.back")).alias("start_char"), "x.end_char")


def _scanner(block: list[tuple[object, str]], least: int, item_type: pa.DataType):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Passages(block, least)
        for b in it:
            rows = [(k, *hit) for k, t in enumerate(b.column(1).to_pylist()) for hit in passages_in(t, p, least)]
            if rows:
                at, ids, *numbers = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(ids, item_type), *(pa.array(c, pa.int32()) for c in numbers)], names=["doc_id", "item_id", "n_words", "start_char", "end_char"])

    return run
