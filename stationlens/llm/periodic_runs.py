"""Periodic runs of words: stretches that repeat one phrase over and over.

A *run* is a stretch of consecutive words with smallest period q (words q apart are equal), at
least ``max(6, 4 * q)`` words long, that no neighbouring word extends. Runs are found by
maximal-pair enumeration:

* the suffixes of a document's words are sorted by prefix doubling; suffixes whose next words
  occur nowhere else in the document leave the sorting at once, so it works on repeated text only;
* common prefix lengths of neighbours come from the ranks of the doubling steps;
* the LCP-interval tree is built bottom-up over suffixes that share five words or more. A node of
  depth l holds the positions of a repeated stretch of l words, in order and in class lists by the
  word left of each. Where two subtrees meet, positions i < j of different left words form a
  maximal pair: they agree on exactly l words. If p = j - i is at most l / 3, words
  i .. i + l + p are a stretch of period p, at least 4 * p long, that neither side extends, so the
  pair is the run and nothing is extended. Multiples of q give the same stretch; the least p stays.

Only pairs that are runs are enumerated: a smaller subtree's positions look for neighbours within
l / 3 in the larger one (each position is looked up at most log n times). Positions that close lie
at one distance, so all of them but the first share a left word: to the right they are read from
one class list, to the left the first one is found by doubling along the class list.

Documents are worked on in blocks of about ``BLOCK_WORDS`` words; a longer document is a block of
its own. One scan, no shuffle.

Cases: a null, empty or blank text has 0 words, no runs and an empty collapsed text; rows with a
null id keep their row; repeated rows are worked on each; texts are read whole; of runs equally
strong the first, then the one of least period is the strongest; an empty table gives no rows;
extra columns have no influence.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import common as C

SCHEMA = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
          "strongest struct<start:long,length:long,period:long>, collapsed string")
#: A run has at least MIN_WORDS words and MIN_TURNS periods.
MIN_WORDS, MIN_TURNS = 6, 4
#: Two places of a run agree on this many words at least (6 words of period 1).
LEAST = MIN_WORDS - 1
BLOCK_WORDS = 1 << 19


@dataclass(frozen=True)
class Run:
    start: int
    length: int
    period: int


def suffix_ranks(ids: np.ndarray) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """((h, rank of each position's next h words), ...) for h = 1, 2, 4, ..., and the positions
    whose next four words occur more than once, in suffix order. Equal ranks at h mean equal next
    h words. Numbers that occur once (ends of documents) must follow every repeated stretch."""
    n = len(ids)
    count = np.bincount(ids)
    rank = (np.cumsum(count) - count)[ids]
    active = np.flatnonzero(count[ids] > 1)
    levels, h, repeated = [(1, rank.astype(np.int32))], 1, active
    while active.size:
        key = rank[active] * np.int64(n) + rank[active + h]
        order = np.argsort(key, kind="stable")
        at, key = active[order], key[order]
        old = rank[at]
        place = np.arange(at.size)
        first_of_old = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], place, 0))
        new = np.r_[True, key[1:] != key[:-1]]
        first_of_new = np.maximum.accumulate(np.where(new, place, 0))
        rank = rank.copy()
        rank[at] = old + first_of_new - first_of_old
        h *= 2
        levels.append((h, rank.astype(np.int32)))
        alone = new & np.r_[new[1:], True]
        active = at[~alone]
        if h <= 4:
            repeated = active
    return levels, repeated[np.argsort(rank[repeated], kind="stable")]


def common_prefixes(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words the suffixes at ``a`` and at ``b`` (different ones) have in common."""
    n = np.zeros(len(a), np.int64)
    for h, rank in reversed(levels):
        n += h * (rank[a + n] == rank[b + n])
    return n


class Node:
    """Positions of one subtree: all in order, and by the word left of each."""

    __slots__ = ("order", "classes")

    def __init__(self, at: int, left: int):
        self.order, self.classes = [at], {left: [at]}

    def add(self, other: Node) -> None:
        for left, more in other.classes.items():
            mine = self.classes.setdefault(left, [])
            if len(more) * 8 < len(mine):
                for at in more:
                    insort(mine, at)
            else:
                mine += more
                mine.sort()
        if len(other.order) * 8 < len(self.order):
            for at in other.order:
                insort(self.order, at)
        else:
            self.order += other.order
            self.order.sort()


def pairs(big: Node, small: Node, reach: int, lefts: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of one position of each node, i < j <= i + reach, with different words left."""
    order, classes = big.order, big.classes
    for at in small.order:
        k = bisect_left(order, at)
        left = lefts[at]
        if k < len(order) and order[k] - at <= reach:  # all that follow in reach share a left word
            other = lefts[order[k]]
            if other != left:
                group = classes[other]
                for j in group[bisect_left(group, order[k]) : bisect_right(group, at + reach)]:
                    yield at, j
        if k and at - order[k - 1] <= reach:
            before = order[k - 1]
            if lefts[before] != left:
                yield before, at
                continue
            # equal distances and equal left words back to the first of them, whose word may differ
            group, step = classes[left], at - before
            g = bisect_left(group, before)
            lo, hi = 0, 1
            while g >= hi and group[g - hi] == before - hi * step and hi * step <= reach:
                lo, hi = hi, 2 * hi
            while hi - lo > 1:
                mid = (lo + hi) // 2
                if g >= mid and group[g - mid] == before - mid * step:
                    lo = mid
                else:
                    hi = mid
            first = before - (lo + 1) * step
            if at - first <= reach:
                k = bisect_left(order, first)
                if k < len(order) and order[k] == first and lefts[first] != left:
                    yield first, at


def maximal_pairs(positions: list[int], shared: list[int], lefts: list[int]) -> Iterator[tuple[int, int, int]]:
    """(i, j, l): the maximal pairs of at least ``LEAST`` shared words l that lie at most l / 3
    apart. ``positions``: suffixes in order; ``shared[k]``: words that suffix k - 1 and k share."""
    stack: list[Node] = []
    depth: list[int] = []  # words shared with the node below
    for at, l in zip(positions, shared):
        while stack and depth[-1] >= max(l, LEAST):
            small, d = stack.pop(), depth.pop()
            big = stack[-1]
            if len(small.order) > len(big.order):
                big, small = small, big
                stack[-1] = big
            for i, j in pairs(big, small, d // (MIN_TURNS - 1), lefts):
                yield i, j, d
            big.add(small)
        if l < LEAST:
            stack.clear()
            depth.clear()
        stack.append(Node(at, lefts[at]))
        depth.append(l)
    while stack and depth[-1] >= LEAST:
        small, d = stack.pop(), depth.pop()
        big = stack[-1]
        if len(small.order) > len(big.order):
            big, small = small, big
            stack[-1] = big
        for i, j in pairs(big, small, d // (MIN_TURNS - 1), lefts):
            yield i, j, d
        big.add(small)


def find_runs(documents: list[np.ndarray]) -> list[list[Run]]:
    """The runs of each document, by start, then period. A document is an array of word numbers;
    equal words have equal numbers within a document."""
    out: list[list[Run]] = [[] for _ in documents]
    sizes = np.array([len(d) for d in documents], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    ids = np.empty(int((sizes + 1).sum()), np.int64)
    base = 0
    for at, d in zip(begin.tolist(), documents):  # numbers of its own for each document and its end
        ids[at : at + len(d)] = d + base
        base += int(d.max()) + 1 if len(d) else 0
        ids[at + len(d)] = base
        base += 1
    if not len(ids):
        return out
    levels, order = suffix_ranks(ids)
    if order.size < 2:
        return out
    shared = np.r_[0, common_prefixes(levels, order[:-1], order[1:])]
    kept = (shared >= LEAST) | np.r_[shared[1:] >= LEAST, False]
    order, shared = order[kept], shared[kept]
    lefts = np.r_[-1, ids[:-1]]
    lefts[begin] = -1 - np.arange(len(begin))  # no word before a document's first
    found: dict[tuple[int, int], int] = {}
    for i, j, l in maximal_pairs(order.tolist(), shared.tolist(), Lefts(lefts)):
        p = j - i
        if l + p >= MIN_WORDS:
            key = (i, l + p)
            found[key] = min(p, found.get(key, p))
    starts = np.array([s for s, _ in found], np.int64)
    owner = np.searchsorted(begin, starts, side="right") - 1
    for d, ((s, n), p) in zip(owner.tolist(), found.items()):
        out[d].append(Run(s - int(begin[d]), n, p))
    for runs in out:
        runs.sort(key=lambda r: (r.start, r.period))
    return out


class Lefts:
    """Words by position as Python numbers, from an array."""

    def __init__(self, words: np.ndarray):
        self.at = words.item

    def __getitem__(self, i: int) -> int:
        return self.at(i)


def strongest(runs: list[Run]) -> Run | None:
    """The run of the most turns; ties: the first start, then the least period."""
    best = None
    for r in runs:  # by start, then period
        if best is None or r.length * best.period > best.length * r.period:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that only repeat: of each run its first period stays."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for r in runs:
        keep[r.start + r.period : r.start + r.length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def word_numbers(words: list[bytes]) -> np.ndarray:
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def find(docs: DataFrame) -> DataFrame:
    """One row per document: its runs by start, then period, the strongest one, and the collapsed
    text, whose words are joined by one space."""
    schema = T._parse_datatype_string(SCHEMA)
    arrow = to_arrow_schema(schema)

    def rows(block: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
        cols: dict[str, list] = {f.name: [] for f in arrow}
        for (doc_id, words), runs in zip(block, find_runs([word_numbers(w) for _, w in block])):
            best = strongest(runs)
            row = (doc_id, len(words), [vars(r) for r in runs], best and vars(best),
                   b" ".join(collapsed(words, runs)).decode("utf-8"))
            for name, value in zip(cols, row):
                cols[name].append(value)
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple[int | None, list[bytes]]] = []
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = text.split()  # bytes: at the six ASCII blanks
                    if block and held + len(words) > BLOCK_WORDS:
                        yield rows(block)
                        block, held = [], 0
                    block.append((doc_id, words))
                    held += len(words) + 1
        if block:
            yield rows(block)

    return C.texts(docs).select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: the number of runs, the strongest one, and digests of all runs (lines
    ``start,length,period``) and of the collapsed text."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return find(docs).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"strongest.{c}") for c in ("start", "length", "period")),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")


def plant(docs: DataFrame) -> DataFrame:
    """The documents (doc_id, text) with a repetition in a tenth of them, to measure on. With
    h = crc32 of the decimal id, h % 10 = 0, g = h // 10 and n words, the words from a = g % n on
    become a repetition of period 1 + (n - a) // (3 + g % 8). A null id gets none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(1).to_pylist()
                for i, doc_id in enumerate(part.column(0).to_pylist()):
                    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
                    if h % 10 == 0 and (n := len(words := texts[i].split())):
                        g = h // 10
                        a = g % n
                        p = 1 + (n - a) // (3 + g % 8)
                        texts[i] = b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary())], ["doc_id", "text"])

    return (C.texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, "doc_id long, text binary").select("doc_id", F.col("text").cast("string").alias("text")))
