"""Line dedup, n-gram join and fingerprints against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from stationlens.llm import fingerprint, line_dedup, ngram_join

from .conftest import prose, texts_of


def key(line: str) -> str:
    k = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)


def plain_dedup(rows: list[tuple], min_chars: int, min_docs: int) -> list[tuple]:
    held = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in t.split("\n"):
                if len(key(line)) >= min_chars:
                    held[key(line)].add(i)
    gone = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = t.split("\n")
        kept = [x for x in lines if i is None or key(x) not in gone or gone[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("which", ["documents", "edges", "nothing"])
@pytest.mark.parametrize("shipped", [64 << 20, -1])  # the filters in the tasks, or lines sent to them
def test_line_dedup(which, shipped, request, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHIPPED", shipped)
    df = request.getfixturevalue(which)
    got = Counter(map(tuple, line_dedup.dedup_digests(df, 40, 5).collect()))
    assert got == Counter(plain_dedup(texts_of(df), 40, 5))
    texts = line_dedup.dedup(df, 40, 5)
    assert texts.columns == df.columns
    assert Counter(hashlib.sha256(t.encode()).hexdigest() for _, t in texts_of(texts)) == Counter(x[3] for x in got.elements())
    assert texts.where("text is null").count() == df.where("text is null").count()


def tables(state) -> tuple:
    keys = state.frequent().select("k1", "k2").collect()
    filters = line_dedup.Filters({r.shard: bytes(r.data) for r in state.filters.collect()}, state.n_shards)
    marks = sum(f.keys() for f in filters.shards.values())
    k = np.array([tuple(x) for x in keys], np.int64).reshape(-1, 2)
    assert filters.maybe(k).all() and marks == len(k)  # each frequent key once, nothing else
    return sorted(map(tuple, state.references.select("k1", "k2", "n_docs", "keeper").collect()))


def test_insertions_and_deletions_undo(spark):
    r = random.Random(1)
    pool = [prose(100 + i, 12) for i in range(40)]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(8))) for i in range(60)]
    frame = lambda some: spark.createDataFrame(some, "doc_id long, text string")
    whole = line_dedup.build(frame(rows), 40, 5)
    grown = line_dedup.insert(line_dedup.build(frame(rows[:25]), 40, 5), frame(rows[20:]))
    assert tables(grown) == tables(whole)
    gone = [(i,) for i, _ in rows if i % 3 == 0 or i > 50]
    less = line_dedup.delete(whole, spark.createDataFrame(gone, "doc_id long"))
    assert tables(less) == tables(line_dedup.build(frame([x for x in rows if (x[0],) not in gone]), 40, 5))
    back = line_dedup.insert(less, frame([x for x in rows if (x[0],) in gone]))
    assert tables(back) == tables(whole)
    empty = line_dedup.delete(whole, frame(rows).select("doc_id"))
    assert tables(empty) == []


def test_filters_grow(spark):
    """Inserting far more lines than the first filters were made for: none ends in a list, none is lost, and
    deleting them gives the first state back."""
    frame = lambda some: spark.createDataFrame(some, "doc_id long, text string")
    line = lambda k: f"this is line number {k} of a text that has many lines"
    rows = [(i, "\n".join(line(k) for k in range(3000 if i > 3 else 20))) for i in range(8)]
    state = line_dedup.build(frame(rows[:4]), 40, 3)
    grown = line_dedup.insert(state, frame(rows[4:]))
    held = [line_dedup.Cuckoo(data=bytes(r.data)) for r in grown.filters.collect()]
    assert sum(f.keys() for f in held) == 3000 and sum(len(f.extra) for f in held) < 10
    assert tables(grown) == tables(line_dedup.build(frame(rows), 40, 3))
    assert tables(line_dedup.delete(grown, frame(rows[4:]).select("doc_id"))) == tables(state)


def test_shards_are_built_anew_when_they_grow(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)
    monkeypatch.setattr(line_dedup, "MIN_SHARDS", 1)
    frame = lambda some: spark.createDataFrame(some, "doc_id long, text string")
    rows = [(i, "\n".join(prose(100 + k, 12) for k in range(i % 40))) for i in range(160)]
    state = line_dedup.build(frame(rows[:8]), 40, 2)
    grown = line_dedup.insert(state, frame(rows[8:]))
    assert grown.n_shards > 4 * state.n_shards
    assert tables(grown) == tables(line_dedup.build(frame(rows), 40, 2))
    line_dedup.save(grown, f"file://{tmp_path}/s")
    back = line_dedup.load(spark, f"file://{tmp_path}/s")
    assert tables(back) == tables(grown)
    assert tables(line_dedup.delete(back, frame(rows[8:]).select("doc_id"))) == tables(state)


def test_cuckoo_holds_what_was_put_in():
    r = np.random.default_rng(3)
    h = r.integers(-(1 << 62), 1 << 62, 3000)
    f = line_dedup.Cuckoo(1000)  # far too small: the rest goes to the list
    f.insert(h)
    f = line_dedup.Cuckoo(data=f.to_bytes())
    assert f.contains(h).all()
    f.delete(h[:2500])
    assert f.contains(h[2500:]).all() and int((f.table > 0).sum()) + len(f.extra) == 500
    g = line_dedup.Cuckoo(3000)
    g.insert(h)
    assert g.contains(h).all() and g.contains(r.integers(-(1 << 62), 1 << 62, 20_000)).mean() < 0.01


def shingle_set(t: str, n: int = 5) -> frozenset:
    w = t.lower().split()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def plain_join(rows: list[tuple]) -> list[tuple]:
    sets = [shingle_set(t) for _, t in rows]
    n = len(rows)
    label, links = list(range(n)), [0] * n
    for a in range(n):
        for b in range(a + 1, n):
            both = len(sets[a] & sets[b])
            if sets[a] == sets[b] or both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                links[a], links[b] = links[a] + 1, links[b] + 1
                x, y = sorted((label[a], label[b]))
                label = [x if v == y else v for v in label]
    least = {v: min((rows[i][0] for i in range(n) if label[i] == v and rows[i][0] is not None), default=None) for v in set(label)}
    return [(rows[i][0], least[label[i]], links[i]) for i in range(n)]


def joined(df) -> Counter:
    return Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_join.join(df).collect())


@pytest.mark.parametrize("which", ["documents", "edges", "nothing"])
def test_join(which, request):
    df = request.getfixturevalue(which)
    assert joined(df) == Counter(plain_join(texts_of(df)))


@pytest.fixture(scope="module")
def copies(spark):
    """A large group of near copies, chains of them, exact copies, and documents that share half."""
    r = random.Random(4)
    rows, base = [], prose(50, 120).split()
    base = [f"{w}{k}" for k, w in enumerate(base)]
    for i in range(150):
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = f"new{i}"
        rows.append((1000 + i, " ".join(w)))
    chain = [f"c{k}" for k in range(100)]
    for i in range(12):  # neighbours are similar, the ends are not
        rows.append((2000 + i, " ".join(chain)))
        chain = chain[4:] + [f"d{i}_{k}" for k in range(4)]
    rows += [(3000 + i, " ".join(base[:60]) + " " + prose(300 + i, 60)) for i in range(40)]
    rows += [(4000 + i, prose(9, 30)) for i in range(30)] + [(5000 + i, prose(500 + i, 30)) for i in range(30)]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("block", [None, 16])
def test_join_of_large_groups(block, copies, monkeypatch):
    if block:  # groups of many blocks
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        monkeypatch.setattr(ngram_join, "VERIFY_BLOCK", block)
        monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
        monkeypatch.setattr(ngram_join, "LARGE", 8)
        monkeypatch.setattr(ngram_join, "SMALL", 4)
    assert joined(copies) == Counter(plain_join(texts_of(copies)))


def test_keep_one(copies, edges):
    want = {(i, c) for i, c, _ in plain_join(texts_of(copies))}
    kept = [i for i, _ in texts_of(ngram_join.keep_one(copies))]
    assert sorted(kept) == sorted(c for i, c in want if i == c)
    out = ngram_join.keep_one(edges)
    assert out.columns == edges.columns
    ids = [i for i, _ in texts_of(out)]
    assert ids.count(None) == 2 and ids.count(6) == 0 and 5 in ids and len(set(ids) - {None}) == len(ids) - 2


def test_pruning_keeps_similar_pairs():
    table = ngram_join.least_matches(0.8, ngram_join.TOLERANCE)
    from math import comb

    lost = sum(sum(comb(m, k) * 0.8**k * 0.2 ** (m - k) for k in range(least)) for m, least in table)
    assert lost < 1e-4  # of pairs just at the threshold


def plain_edit(rows: list[tuple]) -> list[tuple]:
    order = sorted(rows, key=lambda x: -x[0])
    out = []
    for at, (i, t) in enumerate(order):
        nxt = order[(at + 1) % len(order)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), t, e, nxt))
    return out


def test_fingerprints(documents):
    h = fingerprint.Hasher()
    got = {r.doc_id: r for r in fingerprint.fingerprint_documents(documents).collect()}
    want = plain_edit(texts_of(documents))
    assert len(got) == len(want)
    for i, n, sha, t, e, nxt in want:
        r, a, b, c = got[i], h.text(t), h.text(e), h.text(nxt)
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert (r.fingerprint, r.edited_fingerprint) == (a.tobytes().hex(), b.tobytes().hex())
        assert (r.near_edited, r.near_next) == (fingerprint.likeness(a, b), fingerprint.likeness(a, c))


def test_fingerprint_edges(edges, nothing, spark):
    rows = fingerprint.fingerprint_documents(edges).collect()
    assert len(rows) == edges.count()
    single = plain_edit([(i, t) for i, t in texts_of(edges) if i is not None and i != 6])
    by = {r.doc_id: r for r in rows}
    for i, n, sha, *_ in single:
        if i not in (7, 5, -5):  # whose next one has a repeated or no id
            assert (by[i].n_chars, by[i].edited_sha256) == (n, sha), i
    assert len({r.fingerprint for r in rows if r.doc_id in (5, 6)}) == 1
    assert fingerprint.fingerprint_documents(nothing).collect() == []
    one = fingerprint.fingerprint_documents(spark.createDataFrame([(3, "abcd")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one[0].near_next == 1.0


def test_fingerprints_are_homomorphic():
    h = fingerprint.Hasher()
    a, b, c = "first line of words here\nsecond", "third paragraph is longer than that", "x"
    both = h.sum([*a.split("\n"), b, c])
    assert (h.sum([c, b, *reversed(a.split("\n"))]) == both).all()
    assert (fingerprint.combine(fingerprint.combine(h.text(a), h.text(b)), h.text(c)) == both).all()
    assert (fingerprint.combine(fingerprint.combine(both, h.text(b), -1), h.text(c), -1) == h.text(a)).all()
    assert (h.sum(["a", "a"]) != h.sum(["a"])).any()
    assert fingerprint.likeness(both, both) == 1.0


def plain_likeness(a: str, b: str) -> float:
    """What the lanes estimate, from the multisets of word triples themselves."""
    def triples(t: str) -> Counter:
        out = Counter()
        for p in t.split("\n"):
            w = p.split()
            out.update([tuple(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [tuple(w)] if w else [])
        return out
    x, y = triples(a), triples(b)
    apart = sum((x[k] - y[k]) ** 2 for k in x | y)
    both = sum(v * v for v in x.values()) + sum(v * v for v in y.values())
    return min(max(1 - apart / both, 0.0), 1.0) if both else 0.0


def test_likeness_of_much_repeated_words():
    """Sums do not wrap: one triple may recur a hundred thousand times."""
    h = fingerprint.Hasher()
    for a, b in (("w " * 40_000, "w " * 30_000), ("w " * 20_000, "w " * 15_000), ("w " * 100_000, "w " * 100_000 + "v " * 50_000)):
        assert abs(fingerprint.likeness(h.text(a), h.text(b)) - plain_likeness(a, b)) < 0.02
    text, other = prose(1, 3000), prose(1, 3000)[:9000] + prose(2, 1500)
    assert abs(fingerprint.likeness(h.text(text), h.text(other)) - plain_likeness(text, other)) < 0.2


def test_likeness_follows_what_is_shared():
    h = fingerprint.Hasher()
    lines = [prose(i, 12) + f" tail{i} end{i} stop{i}" for i in range(200)]
    seen = [fingerprint.likeness(h.sum(lines), h.sum(lines[:k] + [f"other{j} words{j} here{j} " + prose(900 + j, 12) for j in range(200 - k)]))
            for k in (0, 50, 100, 150, 200)]
    assert seen == sorted(seen) and seen[0] < 0.35 and seen[-1] == 1.0
