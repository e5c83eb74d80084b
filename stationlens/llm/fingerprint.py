"""Homomorphic multiset fingerprints.

A text is the multiset of its paragraphs (lines). Every paragraph hashes to a wide vector and the
fingerprint is their sum: ``EXACT`` components modulo 2**64 hashed from the whole paragraph
decide equality, and ``LANES`` components modulo 2**32 hashed from the paragraph's word triples
(each adds 1 or -1 to one lane) let two sums be compared. Sums don't depend on the order, and
inserting or deleting a paragraph adds or subtracts its vector, without the rest of the text.

Likeness: a sum of many signed units behaves like a random projection of the multiset of
triples, so 1 - |a - b|^2 / (|a|^2 + |b|^2), cut to 0..1, estimates the part that two texts
share; equal fingerprints have likeness 1.

The edited text of a document needs the next document (descending ids). Quantiles of the ids
cut them into ranges; every row goes, compressed, to its range, and a range's first row also to
the range before, so that one sorted pass over a range sees each document with its next one. One
shuffle of the texts; only the ranges' bounds and first ids come to the driver, a few numbers for
each shuffle partition.

Cases: a null or empty text is one empty paragraph; the only document is its own next one;
repeated ids follow one another by text, equal rows in any order; a null id comes last; texts are
read whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

EXACT, LANES, TRIPLE = 4, 192, 3
WIDTH = 8 * EXACT + 4 * LANES
_M = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier that mixes word hashes
REMEMBER = 200_000


class Hasher:
    """Vectors of paragraphs; word hashes are remembered."""

    def __init__(self):
        class Words(dict):
            def __missing__(self, word: str) -> int:
                if len(self) > REMEMBER:
                    self.clear()
                h = xxhash.xxh3_64_intdigest(word)
                if len(word) <= 64:
                    self[word] = h
                return h
        self.words = Words()

    def exact(self, paragraphs: list[str]) -> np.ndarray:
        digests = b"".join([hashlib.blake2b(p.encode("utf-8"), digest_size=8 * EXACT).digest() for p in paragraphs])
        return np.frombuffer(digests, "<u8").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)

    def triples(self, paragraphs: list[str]) -> np.ndarray:
        """Hashes of the word triples inside each paragraph; of a shorter one, of its words."""
        words = [p.split() for p in paragraphs]
        n = np.array([len(w) for w in words])
        h = np.fromiter((self.words[x] for w in words for x in w), np.uint64, int(n.sum()))
        first = np.cumsum(n) - n
        x = np.zeros(0, np.uint64)
        if len(h) >= TRIPLE:
            owner = np.repeat(np.arange(len(n)), n)
            x = h[:-2] * _M + h[1:-1]
            x = ((x ^ (x >> np.uint64(29))) * _M + h[2:])[owner[:-2] == owner[2:]]
        one, two = first[n == 1], first[n == 2]
        x = np.concatenate([x, h[one] * _M, h[two] * _M + (h[two + 1] >> np.uint64(1))])
        return (x ^ (x >> np.uint64(32))) * _M

    def sum(self, paragraphs: list[str]) -> np.ndarray:
        """The fingerprint of a multiset of paragraphs, as bytes."""
        h = self.triples(paragraphs)
        lane = (h >> np.uint64(44)) % np.uint64(LANES)
        sign = ((h >> np.uint64(40)) & np.uint64(1)).astype(np.int64) * 2 - 1
        lanes = np.bincount(lane.astype(np.int64), weights=sign, minlength=LANES).astype(np.int64)
        return np.concatenate([self.exact(paragraphs).view(np.uint8),
                               (lanes & 0xFFFFFFFF).astype("<u4").view(np.uint8)])

    def text(self, text: str) -> np.ndarray:
        return self.sum(text.split("\n"))


def combine(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """Fingerprint of the sum (``sign`` 1: insert) or difference (-1: delete) of two multisets."""
    cut = 8 * EXACT
    wide = a[:cut].view("<u8") + (b[:cut].view("<u8") if sign > 0 else np.uint64(0) - b[:cut].view("<u8"))
    lanes = a[cut:].view("<u4").astype(np.int64) + sign * b[cut:].view("<u4").astype(np.int64)
    return np.concatenate([wide.view(np.uint8), (lanes & 0xFFFFFFFF).astype("<u4").view(np.uint8)])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if a.tobytes() == b.tobytes():
        return 1.0
    x, y = (v[8 * EXACT :].view("<i4").astype(np.float64) for v in (a, b))
    both = float(x @ x + y @ y)
    return min(max(1.0 - float((x - y) @ (x - y)) / both, 0.0), 1.0) if both else 0.0


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
FIRST = -(1 << 63)


def _ranges(docs: DataFrame, n: int) -> tuple[list[int], dict[int, int]]:
    """Upper bounds of about ``n`` ranges of the ids, and for each range's greatest id the range
    before (in descending order, the last before the first) that holds a document."""
    bounds = docs.agg(F.percentile_approx("key", [i / n for i in range(1, n)] or [0.5], 10_000).alias("q")).first().q
    bounds = sorted(set(bounds or []))
    heads = docs.groupBy(_range(bounds).alias("r")).agg(F.max("key").alias("key")).collect()  # a row a range
    order = sorted(heads, key=lambda x: -x.r)
    return bounds, {h.key: order[i - 1].r for i, h in enumerate(order)}


def _range(bounds: list[int]):
    """Which range ``key`` lies in: the number of bounds below it."""
    if not bounds:
        return F.lit(0)

    @F.pandas_udf("int")
    def at(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(bounds), key.to_numpy()).astype("int32"))

    return at("key")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per document: code points, digest of its edited text, both fingerprints (hex), and the
    likeness of its fingerprint to the edited text's and to the next document's."""
    rows = C.texts(docs).withColumn("key", F.coalesce("doc_id", F.lit(FIRST)))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    bounds, heads = _ranges(rows.select("key"), 4 * parts)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with their range, and the first rows of a range once more for the range before."""
        zip_ = zstandard.ZstdCompressor(level=1).compress
        at = np.array(bounds, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512).to_pydict()
                where = np.searchsorted(at, np.array(part["key"], np.int64)).tolist()
                out = []
                for doc_id, text, key, r in zip(part["doc_id"], part["text"], part["key"], where):
                    raw = text.encode("utf-8")
                    row = (key, xxhash.xxh3_64_intdigest(raw) >> 1, doc_id, zip_(raw))
                    out.append((r, False, *row))
                    if key in heads:
                        out.append((heads[key], True, *row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), MOVED.types)], schema=MOVED)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, hasher = zstandard.ZstdDecompressor().decompress, Hasher()
        held = None  # (range, doc_id, text, fingerprint) of the row that waits for its next one
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part, out = batch.slice(i, 512).to_pydict(), []
                for r, ghost, doc_id, packed in zip(part["r"], part["ghost"], part["doc_id"], part["packed"]):
                    if ghost and held is None:
                        continue  # a second row of the id that begins the next range
                    text = unzip(packed).decode("utf-8")
                    mark = hasher.text(text)
                    if held is not None:
                        out.append(edit(hasher, *held, text, mark))
                    held = None if ghost else (doc_id, text, mark)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(DIGEST.types), DIGEST.types)],
                    schema=DIGEST)

    moved = rows.mapInArrow(squeeze, "r int, ghost boolean, key long, h long, doc_id long, packed binary")
    return (moved.repartition(parts, "r").sortWithinPartitions("r", "ghost", F.desc("key"), "h")
            .select("r", "ghost", "doc_id", "packed").mapInArrow(digest, SCHEMA))


def edit(hasher: Hasher, doc_id, text: str, mark: np.ndarray, following: str, following_mark: np.ndarray) -> tuple:
    """The result row of a document and the one after it."""
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    other = hasher.text(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8")).hexdigest(), mark.tobytes().hex(),
            other.tobytes().hex(), likeness(mark, other), likeness(mark, following_mark))


MOVED = pa.schema([("r", pa.int32()), ("ghost", pa.bool_()), ("key", pa.int64()), ("h", pa.int64()),
                   ("doc_id", pa.int64()), ("packed", pa.binary())])
DIGEST = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])
