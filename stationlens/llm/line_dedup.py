"""Line deduplication that can be undone: sharded cuckoo filters over exact reference counts.

A line's key is the line without blanks at both ends, A-Z in lower case; keys of ``min_chars``
code points or more count. The state is

* ``postings``: (key, doc_id), one row for each document that holds a key;
* ``references``: (key, n_docs, keeper), the exact counts, keeper the largest doc_id;
* ``filters``: for each shard of keys a cuckoo filter of the keys found in ``min_docs``
  documents or more.

``insert`` and ``delete`` change all three for the documents given, and only recount the keys
these hold; a key that falls below ``min_docs`` leaves its filter again. A filter that is full is built anew
from the shard's counts, with twice the room, and when shards have grown too large all are, with more
shards. ``save`` and ``load`` keep a state across applications. ``dedup`` asks the
filters first: most lines are in none and need nothing else. The others are looked up in the
exact counts, so the filters' false positives never decide. Filters of up to ``SHIPPED`` bytes
(checked beforehand) go to every task; to larger ones the lines' keys go, shard by shard, each shard
dealt over ``SALTS`` streams of sorted rows that begin with its filter.

Skew: counts are summed in each task before the shuffle, so a line of a third of all documents
arrives once per task; looking up lines is a join that adaptive execution splits at hot keys;
documents and their dropped lines meet on doc_id.

Cases: a null or empty text is one empty line; rows with a null id stay whole and count nowhere;
rows that repeat an id count as one document and all lose the same keys; the lines of the largest
id stay, also several of them; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.session import checkpoint_dir

from . import common as C

BLANK = " \t\n\x0b\x0c\r"
SHARD_KEYS, MIN_SHARDS, SHIPPED, SALTS = 1 << 16, 8, 64 << 20, 8
SCHEMA = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
KEY = ["k1", "k2"]


def key_of(line: str, min_chars: int) -> bytes | None:
    """The hashed key of a line, or None if it is too short to count."""
    k = line.strip(BLANK)
    return xxhash.xxh3_128_digest(k.encode("utf-8").lower()) if len(k) >= min_chars else None


def keys_of(text: str, min_chars: int) -> np.ndarray:
    """Distinct keys of a text's lines, as rows of two signed 64-bit numbers."""
    if len(text) < min_chars:
        return np.zeros((0, 2), np.int64)
    found = {k for line in text.split("\n") if (k := key_of(line, min_chars)) is not None}
    return np.frombuffer(b"".join(found), ">i8").reshape(-1, 2).astype(np.int64)


class Cuckoo:
    """A cuckoo filter: four 16-bit marks a bucket, two buckets a key; what finds no place after
    ``KICKS`` moves is kept in a list, so an insertion never fails."""
    SLOTS, KICKS, LOAD = 4, 200, 0.8

    def __init__(self, capacity: int = 64, data: bytes | None = None):
        if data is None:
            m = 1 << max(int(np.ceil(np.log2(max(capacity, 16) / (self.LOAD * self.SLOTS)))), 2)
            self.table, self.extra = np.zeros((m, self.SLOTS), np.uint16), []
        else:
            m, n = np.frombuffer(data[:16], "<i8")
            cut = 16 + 2 * self.SLOTS * int(m)
            self.table = np.frombuffer(data[16:cut], "<u2").reshape(-1, self.SLOTS).copy()
            self.extra = [tuple(x) for x in np.frombuffer(data[cut:], "<i8").reshape(int(n), 2).tolist()]
        self.mask = np.uint64(len(self.table) - 1)

    def keys(self) -> int:
        return int((self.table > 0).sum()) + len(self.extra)

    def room(self) -> int:
        """Keys that still fit well."""
        return int(self.LOAD * self.table.size) - self.keys()

    def to_bytes(self) -> bytes:
        head = np.array([len(self.table), len(self.extra)], "<i8")
        return head.tobytes() + self.table.astype("<u2").tobytes() + np.array(self.extra, "<i8").tobytes()

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mark, first bucket, second bucket) of 64-bit key hashes."""
        u = h.astype(np.int64).view(np.uint64)
        mark = (u >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        one = u & self.mask
        return mark, one.astype(np.int64), self.other(one, mark)

    def other(self, bucket, mark):
        return ((np.asarray(bucket, np.uint64) ^ (np.asarray(mark, np.uint64) * np.uint64(0x5BD1E995))) & self.mask).astype(np.int64)

    def insert(self, h: np.ndarray) -> None:
        mark, one, two = self.places(h)
        rng = np.random.default_rng(len(h))
        for m, a, b in zip(mark.tolist(), one.tolist(), two.tolist()):
            for at in (a, b):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = m
                    break
            else:
                at = b
                for _ in range(self.KICKS):
                    slot = int(rng.integers(self.SLOTS))
                    m, self.table[at, slot] = int(self.table[at, slot]), m
                    at = int(self.other(at, m))
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = m
                        break
                else:
                    self.extra.append((at, m))

    def delete(self, h: np.ndarray) -> None:
        """Takes out keys that were inserted before."""
        mark, one, two = self.places(h)
        for m, a, b in zip(mark.tolist(), one.tolist(), two.tolist()):
            for at in (a, b):
                slot = np.flatnonzero(self.table[at] == m)
                if len(slot):
                    self.table[at, slot[0]] = 0
                    break
            else:
                self.extra.remove((a, m) if (a, m) in self.extra else (b, m))

    def contains(self, h: np.ndarray) -> np.ndarray:
        mark, one, two = self.places(h)
        hit = (self.table[one] == mark[:, None]).any(axis=1) | (self.table[two] == mark[:, None]).any(axis=1)
        for at, m in self.extra:
            hit |= (mark == m) & ((one == at) | (two == at))
        return hit


class Filters:
    """The shards' filters together."""

    def __init__(self, shards: dict[int, bytes], n_shards: int):
        self.n, self.shards = n_shards, {s: Cuckoo(data=d) for s, d in shards.items()}

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        """Which keys (rows) may be in."""
        hit = np.zeros(len(keys), bool)
        shard = keys[:, 1] % self.n
        for s in np.unique(shard).tolist():
            if (f := self.shards.get(s)) is not None:
                at = shard == s
                hit[at] = f.contains(keys[at, 0])
        return hit


def postings(docs: DataFrame, min_chars: int, filters=None) -> DataFrame:
    """(k1, k2, doc_id): the keys of each row with an id; only those that may be in ``filters``
    (a broadcast), if given."""

    def make():
        def run(cols: dict) -> dict:
            keys, owner = [], []
            for doc_id, text in zip(cols["doc_id"], cols["text"]):
                k = keys_of(text, min_chars)
                if len(k):
                    keys.append(k)
                    owner.append(np.full(len(k), doc_id))
            k = np.concatenate(keys) if keys else np.zeros((0, 2), np.int64)
            owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
            if filters is not None:
                hit = filters.value.maybe(k)
                k, owner = k[hit], owner[hit]
            return {"k1": k[:, 0], "k2": k[:, 1], "doc_id": owner}
        return run

    rows = C.texts(docs).where(F.col("doc_id").isNotNull())
    return C.map_rows(rows, "k1 long, k2 long, doc_id long", make)


def count_references(rows: DataFrame) -> DataFrame:
    """Exact counts of distinct (key, doc_id) rows."""
    return rows.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))


@dataclass
class LineState:
    postings: DataFrame
    references: DataFrame
    filters: DataFrame  # (shard, data)
    n_shards: int
    min_chars: int
    min_docs: int

    def frequent(self) -> DataFrame:
        return self.references.where(F.col("n_docs") >= self.min_docs)


def _change_filters(filters: DataFrame | None, changes: DataFrame, n_shards: int) -> DataFrame:
    """The filters after ``changes``: rows (k1, k2, add) of keys that come or go. One shard's
    changes and filter meet in a task; shards are as many as keep them small. A filter without room for
    what comes is given as NULL."""
    changes = changes.select(F.pmod("k2", F.lit(n_shards)).cast("int").alias("shard"), "k1", "add")
    schema = "shard int, data binary"

    def change(old: bytes | None, new: pd.DataFrame) -> bytes | None:
        come, go = new.k1[new["add"]].to_numpy(np.int64), new.k1[~new["add"]].to_numpy(np.int64)
        f = Cuckoo(2 * len(come), old)
        f.delete(go)
        if len(come) > f.room():
            return None
        f.insert(come)
        return f.to_bytes()

    if filters is None:
        return changes.groupBy("shard").applyInPandas(
            lambda new: pd.DataFrame({"shard": [new.shard.iloc[0]], "data": [change(None, new)]}), schema)

    def both(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        data = bytes(old.data.iloc[0]) if len(old) else None
        shard = (old if len(old) else new).shard.iloc[0]
        return pd.DataFrame({"shard": [shard], "data": [change(data, new) if len(new) else data]})

    return filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(both, schema)


def build(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, keep_postings: bool = True) -> LineState:
    """The state after inserting ``docs`` into an empty one. Without postings it can answer, but
    not be changed."""
    checkpoint_dir(docs.sparkSession)
    rows = postings(docs, min_chars).dropDuplicates()
    if keep_postings:
        rows = rows.checkpoint()
    refs = count_references(rows).checkpoint()
    n = refs.where(F.col("n_docs") >= min_docs).count()
    state = LineState(rows, refs, refs, max(MIN_SHARDS, -(-n // SHARD_KEYS)), min_chars, min_docs)
    state.filters = _change_filters(None, state.frequent().select(*KEY, F.lit(True).alias("add")),
                                    state.n_shards).checkpoint()
    return state


def _changed(state: LineState, rows: DataFrame, touched: DataFrame) -> LineState:
    """The state with ``rows`` for postings, where only keys in ``touched`` differ from before."""
    touched = touched.select(*KEY).distinct().checkpoint()
    fresh = count_references(rows.join(touched, KEY, "left_semi")).checkpoint()
    refs = state.references.join(touched, KEY, "left_anti").unionByName(fresh).checkpoint()
    was = state.frequent().join(touched, KEY, "left_semi").select(*KEY, F.lit(True).alias("was"))
    now = fresh.where(F.col("n_docs") >= state.min_docs).select(*KEY, F.lit(True).alias("now"))
    changes = was.join(now, KEY, "full").where("was is null or now is null") \
        .select(*KEY, F.col("now").isNotNull().alias("add"))
    new = LineState(rows, refs, state.filters, state.n_shards, state.min_chars, state.min_docs)
    new.filters = _grown(new, changes)
    return new


def _grown(state: LineState, changes: DataFrame) -> DataFrame:
    """The filters after ``changes``; full ones, or all when shards have grown too large, are built anew
    from the counts."""
    keys = state.frequent().select(*KEY, F.lit(True).alias("add"))
    n = keys.count()
    if n > 4 * state.n_shards * SHARD_KEYS:
        state.n_shards = -(-n // SHARD_KEYS)
        return _change_filters(None, keys, state.n_shards).checkpoint()
    changed = _change_filters(state.filters, changes, state.n_shards).checkpoint()
    full = changed.where("data is null").select(F.col("shard").alias("full"))
    if not full.limit(1).count():
        return changed
    again = keys.join(full, F.pmod("k2", F.lit(state.n_shards)).cast("int") == F.col("full"), "left_semi")
    return changed.where("data is not null").unionByName(_change_filters(None, again, state.n_shards)).checkpoint()


def save(state: LineState, path: str) -> None:
    """Writes a state to a folder (whose path should be new)."""
    spark = state.references.sparkSession
    for name in ("postings", "references", "filters"):
        getattr(state, name).write.parquet(f"{path}/{name}")
    spark.createDataFrame([(state.n_shards, state.min_chars, state.min_docs)], "n_shards int, min_chars int, min_docs int") \
        .coalesce(1).write.parquet(f"{path}/state")  # last: a state without it is not whole


def load(spark: SparkSession, path: str) -> LineState:
    """A saved state."""
    meta = spark.read.parquet(f"{path}/state").first()
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{path}/{name}")
    return LineState(read("postings", "k1 long, k2 long, doc_id long"), read("references", "k1 long, k2 long, n_docs long, keeper long"),
                     read("filters", "shard int, data binary"), meta.n_shards, meta.min_chars, meta.min_docs)


def insert(state: LineState, docs: DataFrame) -> LineState:
    """The state after more documents."""
    checkpoint_dir(docs.sparkSession)
    new = postings(docs, state.min_chars).dropDuplicates().checkpoint()
    rows = state.postings.unionByName(new).dropDuplicates().checkpoint()
    return _changed(state, rows, new)


def delete(state: LineState, ids: DataFrame) -> LineState:
    """The state without the documents whose doc_id is in ``ids``."""
    ids = ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    gone = state.postings.join(ids, "doc_id", "left_semi").select(*KEY, "doc_id").checkpoint()
    rows = state.postings.join(ids, "doc_id", "left_anti").select(*KEY, "doc_id").checkpoint()
    return _changed(state, rows, gone)


def dropped_keys(state: LineState, docs: DataFrame) -> DataFrame:
    """(doc_id, drops): each document's keys whose lines go, if any."""
    sc = docs.sparkSession.sparkContext
    size = state.filters.agg(F.sum(F.octet_length("data")).alias("n")).first().n or 0
    if size <= SHIPPED:
        filters = sc.broadcast(Filters({r.shard: bytes(r.data) for r in state.filters.collect()}, state.n_shards))
        maybe = postings(docs, state.min_chars, filters)
    else:
        maybe = ask_shards(postings(docs, state.min_chars), state)
    return (maybe.join(state.frequent(), KEY)
            .where(F.col("doc_id") != F.col("keeper"))
            .groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("drops")))  # at most a document's lines


def ask_shards(rows: DataFrame, state: LineState) -> DataFrame:
    """The rows (k1, k2, doc_id) whose keys may be in their shard's filter. Rows and filters meet in sorted
    streams, one for each shard and salt: first the filter, then its rows, none of which is held."""
    salted = rows.select(F.pmod("k2", F.lit(state.n_shards)).cast("int").alias("shard"),
                         F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
                         F.lit(None).cast("binary").alias("data"), *KEY, "doc_id")
    none = F.lit(None).cast("long")
    filters = state.filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "data",
                                   none.alias("k1"), none.alias("k2"), none.alias("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, held = None, None
        for batch in batches:
            shard, salt, k1 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "salt", "k1"))
            begins = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (salt[1:] != salt[:-1])])
            hit = np.zeros(len(shard), bool)
            for x, y in zip(begins.tolist(), [*begins[1:].tolist(), len(shard)]):
                if (int(shard[x]), int(salt[x])) != where:
                    where = int(shard[x]), int(salt[x])
                    data = batch.column("data")[x].as_py()
                    held = None if data is None else Cuckoo(data=data)  # no filter: no frequent key in this shard
                    x += data is not None
                if held is not None and y > x:
                    hit[x:y] = held.contains(batch.column("k1").slice(x, y - x).to_numpy())
            part = batch.filter(pa.array(hit))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in (*KEY, "doc_id")], [*KEY, "doc_id"])

    return (salted.unionByName(filters).repartition("shard", "salt")
            .sortWithinPartitions("shard", "salt", F.col("data").isNull()).mapInArrow(run, "k1 long, k2 long, doc_id long"))


def split_lines(text: str, drops, min_chars: int) -> tuple[list[str], int]:
    """(lines that stay, number of lines)."""
    lines = text.split("\n")
    if drops is None or not len(drops):
        return lines, len(lines)
    gone = {np.array([d["k1"], d["k2"]], ">i8").tobytes() for d in drops}
    return [x for x in lines if key_of(x, min_chars) not in gone], len(lines)


def _with_drops(docs: DataFrame, state: LineState) -> tuple[DataFrame, str, str]:
    """The documents with their dropped keys: (frame, name of the key column, of the id column)."""
    drops, owner = C.fresh(docs, "drops"), C.fresh(docs, "drops_of")
    found = dropped_keys(state, docs).select(F.col("doc_id").alias(owner), F.col("drops").alias(drops))
    return docs.join(found, docs["doc_id"].cast("long") == F.col(owner), "left"), drops, owner


def dedup_digests(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per document: lines before, lines dropped, digest of the text that stays."""
    docs = C.texts(docs)
    joined, drops, _ = _with_drops(docs, build(docs, min_chars, min_docs, keep_postings=False))

    def make():
        def run(cols: dict) -> dict:
            out = [split_lines(t, d, min_chars) for t, d in zip(cols["text"], cols["drops"])]
            return {"doc_id": cols["doc_id"], "n_lines": [n for _, n in out],
                    "n_dropped": [n - len(kept) for kept, n in out],
                    "kept_sha256": [hashlib.sha256("\n".join(kept).encode("utf-8")).hexdigest() for kept, _ in out]}
        return run

    return C.map_rows(joined.select("doc_id", "text", F.col(drops).alias("drops")), SCHEMA, make)


def dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents, all columns, without the dropped lines; texts that lose none stay as they
    are (null too)."""
    joined, drops, owner = _with_drops(docs, build(docs, min_chars, min_docs, keep_postings=False))

    @F.pandas_udf("string")
    def kept(text: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or g is None else "\n".join(split_lines(t, g, min_chars)[0])
                          for t, g in zip(text, gone)], dtype=object)

    return joined.withColumn("text", F.when(F.col(drops).isNull(), F.col("text"))
                             .otherwise(kept(F.col("text").cast("string"), F.col(drops)))).drop(drops, owner)
