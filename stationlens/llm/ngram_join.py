"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of word shingles. The join finds all pairs of a similarity of ``threshold`` or
more and reports, for each document, its class (connected documents) and its number of links.

1. Equal sets are one node with a count, so exact copies cost one row each and no pairs.
2. Each node has ``HASHES`` MinHash values; nodes that agree in a band of ``ROWS`` values meet in a
   bucket. With 32 bands of 4, a pair at similarity 0.8 meets nowhere with probability 5e-8.
   Buckets of the same members are taken once.
3. In a bucket the MinHash values are compared ``STEP`` at a time; a pair is dropped as soon as the
   posterior probability (uniform prior) that its similarity reaches the threshold falls below
   ``TOLERANCE``. Only who is connected is kept of the rest, as stars, not the pairs; in a large
   bucket, rows that are connected already are not compared any more.
4. Inside each connected candidate component all pairs are pruned the same way once more, and the
   rest is verified exactly on the shingle sets. Links are counted, with the nodes' counts as
   weights, and connected nodes get one class.

Nothing is capped or sampled: buckets and components larger than a block are split into pairs of
blocks, which are separate groups of rows, so a group of any size spreads over tasks. What leaves
a group is one row for a node, never pairs. Rows of a group are adjacent in a sorted partition and
are read as a stream. Tables that are used again are checkpointed to the shared folder.

Cases: a null or empty text is the empty set, and all empty documents are copies of each other; a
text of fewer words than a shingle is one shingle of all its words; repeated rows are documents of
their own, so each links to the others; a null id is no class's name unless all are null; texts are
read whole; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlens.session import checkpoint_dir

from . import common as C

SHINGLE, THRESHOLD = 5, 0.8
HASHES, ROWS, STEP, TOLERANCE = 128, 4, 16, 1e-7
BANDS = HASHES // ROWS
BLOCK, VERIFY_BLOCK = 4096, 512
BROADCAST_IDS = 2_000_000  # 16 MB of ids
REMEMBER = 300_000
_M = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240607)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_BAND = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
KEY = ["k1", "k2"]


class Shingler:
    """Sorted distinct shingle hashes of a text; word hashes are remembered."""

    def __init__(self, n: int = SHINGLE):
        self.n = n

        class Words(dict):
            def __missing__(self, word: str) -> int:
                if len(self) > REMEMBER:
                    self.clear()
                h = xxhash.xxh3_64_intdigest(word)
                if len(word) <= 64:
                    self[word] = h
                return h
        self.words = Words()

    def shingles(self, text: str) -> np.ndarray:
        words = text.lower().split()
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        n = min(self.n, len(h))
        x = np.full(len(h) - n + 1, n, np.uint64)
        for j in range(n):
            x = (x ^ h[j : len(h) - n + 1 + j]) * _M
            x ^= x >> np.uint64(31)
        return np.unique(x)


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def minhashes(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        x = shingles[at : at + 1024, None] * _A
        x += _B
        np.minimum(least, x.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    x = _BAND.copy()
    for row in least.reshape(BANDS, ROWS).T:
        x = (x ^ row) * _M
        x ^= x >> np.uint64(29)
    return x.view(np.int64)


@functools.lru_cache(maxsize=16)
def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(values compared, least matches): with fewer, the posterior probability of reaching the
    threshold is below the tolerance."""
    s = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for m in range(STEP, HASHES + 1, STEP):
        for k in range(m + 1):
            log = k * np.log(s) + (m - k) * np.log1p(-s)
            p = np.exp(log - log.max())
            if p[s >= threshold].sum() / p.sum() >= tolerance:
                out.append((m, k))
                break
    return out


def prune(sig: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs (a[i], b[i]) of signature rows stay candidates."""
    table = least_matches(threshold, TOLERANCE)
    stay, done = np.arange(len(a)), 0
    same = np.zeros(len(a), np.int16)
    for m, k in table:
        hit = np.empty(len(stay), np.int16)
        for i in range(0, len(stay), 1 << 14):
            p = stay[i : i + (1 << 14)]
            hit[i : i + (1 << 14)] = (sig[a[p], done:m] == sig[b[p], done:m]).sum(axis=1)
        same[stay] += hit
        stay, done = stay[same[stay] >= k], m
    out = np.zeros(len(a), bool)
    out[stay] = True
    return out


def linked_parts(sig: np.ndarray, side: np.ndarray, threshold: float, across: bool) -> np.ndarray:
    """Least member of the part that each row lies in, where unpruned pairs (``across``: of two sides)
    connect. Rows reached last are compared, many at a time, with rows not reached yet only: of near
    copies the first row reaches most, so a large group of them costs far less than all its pairs."""
    n = len(sig)
    label, left = np.arange(n), np.arange(n)
    while len(left):
        root, left = left[0], left[1:]
        queue = np.array([root])
        while len(queue) and len(left):
            some = max(1, (1 << 15) // len(left))
            rows, queue = queue[:some], queue[some:]
            x, y = np.repeat(rows, len(left)), np.tile(left, len(rows))
            if across:
                ok = side[x] != side[y]
                x, y = x[ok], y[ok]
            found = np.unique(y[prune(sig, x, y, threshold)])
            label[found] = root
            queue = np.concatenate([queue, found])
            left = np.setdiff1d(left, found, assume_unique=True)
    return label


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of the connected part that each of n nodes lies in."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        label = new[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


SMALL, LARGE = 48, 1024


def candidate_pairs(group: np.ndarray, side: np.ndarray, i: np.ndarray, j: np.ndarray,
                    most: float = float("inf")) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group (rows sorted by group), in pieces: all inside a block, those
    across in a pair of blocks. ``side``: the row's block; ``most``: rows of a group that is paired."""
    begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[begin, len(group)])
    paired = (size > SMALL) & (size <= most)
    for s, n in zip(begin[paired].tolist(), size[paired].tolist()):
        for r in range(n - 1):  # rows of a large group, some at a time
            if r % 64 == 0:
                top = np.arange(r, min(r + 64, n - 1))
                x = np.repeat(top, n - 1 - top)
                y = np.concatenate([np.arange(t + 1, n) for t in top])
                ok = (i[s] == j[s]) | (side[s + x] != side[s + y])
                yield s + x[ok], s + y[ok]
    small = np.repeat(np.where(size <= SMALL, size, 0), size)
    place = np.arange(len(group)) - np.repeat(begin, size)
    for d in range(1, SMALL):
        x = np.flatnonzero(place + d < small)
        if not len(x):
            break
        y = x + d
        ok = (i[x] == j[x]) | (side[x] != side[y])
        yield x[ok], y[ok]


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 512) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows that end where a group (equal ``keys``, adjacent) ends."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        t = pa.Table.from_batches(held)
        last = np.ones(n, bool)
        for k in keys:
            c = t.column(k).to_numpy()
            last &= c == c[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield t.slice(0, cut)
            held, n = t.slice(cut).combine_chunks().to_batches(), t.num_rows - cut
    if n:
        yield pa.Table.from_batches(held)


def group_ids(t: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    for k in keys:
        c = t.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def signatures(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sig").to_pylist()), "<u2").reshape(t.num_rows, HASHES)


def pair_blocks(df: DataFrame, size: str, block: int) -> DataFrame:
    """Deals the rows of groups of ``size`` rows into blocks, and each row to the pairs of its block
    with every block of the group: columns side, i, j."""
    n = F.ceil(F.col(size) / block).cast("int")
    return (df.withColumn("side", F.pmod(F.xxhash64(*KEY), n).cast("int"))
            .withColumn("o", F.explode(F.sequence(F.lit(0), n - 1)))
            .withColumn("i", F.least("side", "o")).withColumn("j", F.greatest("side", "o")).drop("o"))


def nodes_of(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, k1, k2, size, sig, bands): a row for each document."""

    def make():
        shingler = Shingler(n)

        def run(cols: dict) -> dict:
            out = {"doc_id": cols["doc_id"], "k1": [], "k2": [], "size": [], "sig": [], "bands": []}
            for text in cols["text"]:
                sh = shingler.shingles(text)
                least = minhashes(sh)
                a, b = set_key(sh)
                out["k1"].append(a)
                out["k2"].append(b)
                out["size"].append(len(sh))
                out["sig"].append((least >> np.uint64(40)).astype("<u2").tobytes())
                out["bands"].append(band_keys(least).tobytes())
            return out
        return run

    return C.map_rows(C.texts(docs), "doc_id long, k1 long, k2 long, size int, sig binary, bands binary", make)


def connect(edges: DataFrame) -> DataFrame:
    """(node, label): the least node connected to each node of ``edges`` (a, b). Labels spread along
    the edges and jump to their label's label, until none changes; every round is checkpointed."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) \
        .where("a != b").distinct().checkpoint()
    labels = both.groupBy("a").agg(F.min("b").alias("m")) \
        .select(F.col("a").alias("node"), F.least("a", "m").alias("label")).checkpoint()
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("m"))
        spread = labels.join(near, F.col("node") == F.col("a")) \
            .select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        target = labels.select(F.col("node").alias("t"), F.col("label").alias("further"))
        new = spread.join(target, F.col("label") == F.col("t"), "left") \
            .select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")).checkpoint()
        labels = new.select("node", "label")
        if not new.where("label != was").limit(1).count():
            return labels


def _name():
    return F.concat(*[F.lpad(F.hex(k), 16, "0") for k in KEY])


def candidate_edges(nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): stars over the nodes that are connected by unpruned pairs of a bucket, each around its least
    node, so that the buckets of one group of near copies agree on few centres. A node is the first half
    of its key: two nodes of one number would only be compared in vain."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            bands = np.frombuffer(b"".join(t.column("bands").to_pylist()), np.int64)
            k1, k2 = (np.repeat(t.column(k).to_numpy(), BANDS) for k in KEY)
            yield pa.RecordBatch.from_arrays([pa.array(bands), pa.array(k1), pa.array(k2)], ["bucket", *KEY])

    bands = nodes.select(*KEY, "bands").mapInArrow(explode, "bucket long, k1 long, k2 long")
    # a bucket is worth a look if it has two members; of buckets with the same members one is
    buckets = (bands.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"))
               .where("n > 1").groupBy("n", "x1", "x2").agg(F.min("bucket").alias("bucket")).select("bucket", "n"))
    members = pair_blocks(bands.join(buckets, "bucket"), "n", BLOCK)
    rows = members.join(nodes.select(*KEY, "sig"), KEY).select("bucket", "i", "j", "side", *KEY, "sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_group(batches, ["bucket", "i", "j"]):
            sig, group = signatures(t), group_ids(t, ["bucket", "i", "j"])
            i, j, side, k1 = (t.column(c).to_numpy() for c in ("i", "j", "side", "k1"))
            kept = [(x[p], y[p]) for x, y in candidate_pairs(group, side, i, j, LARGE)
                    for p in [prune(sig, x, y, threshold)] if p.any()]
            label = components(t.num_rows, *(np.concatenate(c) for c in zip(*_stars(kept, t.num_rows)))) if kept else np.arange(t.num_rows)
            begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            size = np.diff(np.r_[begin, len(group)])
            for s, n in zip(begin[size > LARGE].tolist(), size[size > LARGE].tolist()):
                label[s : s + n] = s + linked_parts(sig[s : s + n], side[s : s + n], threshold, bool(i[s] != j[s]))
            at = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(k1[at]), pa.array(k1[label[at]])], ["a", "b"])

    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "k1") \
        .mapInArrow(run, "a long, b long").distinct()


def _stars(pieces: list[tuple[np.ndarray, np.ndarray]], n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs with the same connected parts as all pieces together, at most ``n`` a time."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    held, count = [], 0
    for a, b in pieces:
        held.append((a, b))
        count += len(a)
        if count > 4 * n + 100_000:
            label = components(n, *(np.concatenate(c) for c in zip(*held)))
            at = np.flatnonzero(label != np.arange(n))
            held, count = [(at, label[at])], len(at)
    out += held
    return out


def shared(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common shingles of the pairs (a[i], b[i])."""
    if len(a) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a.tolist(), b.tolist())], np.int64)
    used = np.unique(np.r_[a, b])
    place = np.zeros(len(sets), np.int64)
    place[used] = np.arange(len(used))
    owner = np.repeat(np.arange(len(used)), [len(sets[u]) for u in used])
    column, times = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True, return_counts=True)[1:]
    many = times > 1
    number = np.cumsum(many) - 1
    ok = many[column]
    owner, column, n = owner[ok], number[column[ok]], int(many.sum())
    common = np.zeros((len(used), len(used)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for at in range(0, n, 8192):
        lo, hi = np.searchsorted(column, [at, at + 8192])
        m = np.zeros((len(used), min(8192, n - at)), np.float32)
        m[owner[lo:hi], column[lo:hi] - at] = 1.0
        common += m @ m.T
    return common[place[a], place[b]].astype(np.int64)


def verified(docs: DataFrame, nodes: DataFrame, comps: DataFrame, n: int, threshold: float) -> DataFrame:
    """(node, links, label, whole): for each node of a candidate component and each pair of blocks,
    the documents it is linked to, the least node of its connected part there, and whether the
    component has one block."""
    sized = comps.join(comps.groupBy("label").agg(F.count("*").alias("members")), "label") \
        .select(F.col("node").alias("k1"), F.col("label").alias("comp"), "members")
    wanted = nodes.withColumn("node", _name()).join(sized, "k1").checkpoint()
    ids = wanted.select(F.col("rep").alias("id")).distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    chosen = C.texts(docs).withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 63)))).join(ids, "id", "left_semi")

    def make():
        shingler = Shingler(n)

        def run(cols: dict) -> dict:
            sets = [shingler.shingles(t) for t in cols["text"]]
            keys = [set_key(s) for s in sets]
            return {"k1": [a for a, _ in keys], "k2": [b for _, b in keys], "shingles": [s.tobytes() for s in sets]}
        return run

    sets = C.map_rows(chosen.select("text"), "k1 long, k2 long, shingles binary", make) \
        .groupBy(*KEY).agg(F.first("shingles").alias("shingles"))
    rows = pair_blocks(wanted.select("node", "comp", "members", "copies", "sig", *KEY).join(sets, KEY), "members", VERIFY_BLOCK) \
        .select("comp", "i", "j", "side", "node", "copies", "members", "sig", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["comp", "i", "j"]
        for t in by_group(batches, keys, rows=128):
            sig = signatures(t)
            sets = [np.frombuffer(s, np.uint64) for s in t.column("shingles").to_pylist()]
            size = np.array([len(s) for s in sets], np.int64)
            copies = t.column("copies").to_numpy()
            i, j, side = (t.column(c).to_numpy() for c in ("i", "j", "side"))
            links, found = np.zeros(t.num_rows, np.int64), []
            pairs = [(x[p], y[p]) for x, y in candidate_pairs(group_ids(t, keys), side, i, j)
                     for p in [prune(sig, x, y, threshold)] if p.any()]
            if pairs:
                a, b = (np.concatenate(c) for c in zip(*pairs))
                group = group_ids(t, keys)[a]
                order = np.argsort(group, kind="stable")
                a, b, group = a[order], b[order], group[order]
                for lo, hi in zip(*(lambda c: (c, np.r_[c[1:], len(a)]))(np.flatnonzero(np.r_[True, group[1:] != group[:-1]]))):
                    x, y = a[lo:hi], b[lo:hi]
                    base, end = min(x.min(), y.min()), max(x.max(), y.max()) + 1
                    common = shared(sets[base:end], x - base, y - base)
                    ok = common >= threshold * (size[x] + size[y] - common)
                    x, y = x[ok], y[ok]
                    np.add.at(links, x, copies[y])
                    np.add.at(links, y, copies[x])
                    found.append((x, y))
            label = components(t.num_rows, *(np.concatenate(c) for c in zip(*found))) if found else np.arange(t.num_rows)
            names = t.column("node").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(links), names.take(pa.array(label)),
                 pa.array(t.column("members").to_numpy() <= VERIFY_BLOCK)], ["node", "links", "label", "whole"])

    return rows.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j") \
        .mapInArrow(run, "node string, links long, label string, whole boolean")


def join(docs: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies): for each document the least doc_id of its class, the
    other documents at least ``threshold`` similar to it, and how many of them have the same
    shingles. Documents of one class are connected by links."""
    checkpoint_dir(docs.sparkSession)
    rows = nodes_of(docs, n).checkpoint()
    nodes = rows.groupBy(*KEY).agg(
        F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("rep"), F.min("doc_id").alias("least"),
        F.count("*").alias("copies"), F.first("sig").alias("sig"), F.first("bands").alias("bands")).checkpoint()
    edges = candidate_edges(nodes, threshold).checkpoint()
    got = verified(docs, nodes.drop("bands"), connect(edges), n, threshold).checkpoint()
    links = got.groupBy("node").agg(F.sum("links").alias("links"))
    single = got.where("whole").select("node", "label")
    across = got.where("not whole and node != label").select(F.col("node").alias("a"), F.col("label").alias("b")).distinct()
    labels = single.unionByName(connect(across)) if across.limit(1).count() else single
    named = nodes.select(*KEY, "least", "copies", _name().alias("node")).join(links, "node", "left").join(labels, "node", "left") \
        .withColumn("label", F.coalesce("label", "node")).checkpoint()
    classes = named.groupBy("label").agg(F.min("least").alias("class_id"))
    final = named.join(classes, "label").select(
        *KEY, "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), (F.col("copies") - 1).alias("n_copies"))
    return rows.select("doc_id", *KEY).join(final, KEY).select("doc_id", "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE) -> DataFrame:
    """The documents, all columns, of which each class's least doc_id stays. Rows that share an id go
    or stay together, equal rows of it once; rows without an id stay."""
    found = join(docs, threshold, n).where("doc_id is not null").checkpoint()
    repeated = found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    owner = C.fresh(docs, "keep_id")
    keep = found.where("doc_id = class_id").select(F.col("doc_id").alias(owner)).distinct()
    same = docs["doc_id"].cast("long") == F.col(owner)
    stays = docs.join(keep, same, "left_semi")
    if repeated.limit(1).count():
        several = repeated.select(F.col("doc_id").alias(owner))
        again = F.col("doc_id").cast("long") == F.col(owner)
        stays = stays.join(several, again, "left_anti").unionByName(
            stays.join(several, again, "left_semi").dropDuplicates(["doc_id", "text"]))
    return stays.unionByName(docs.where(F.col("doc_id").isNull()))
