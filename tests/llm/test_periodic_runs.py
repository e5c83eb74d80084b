"""Runs against a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from stationlens.llm import periodic_runs as R

from .conftest import by_id, texts_of


def plain_runs(w: list) -> list[tuple[int, int, int]]:
    """Every stretch by trying each period and start."""
    found: dict[tuple[int, int], int] = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def random_words(r: random.Random) -> list[int]:
    k, n = r.choice([1, 2, 2, 3, 5]), r.randint(0, 120)
    if r.random() < 0.4:
        return [r.randrange(k) for _ in range(n)]
    w: list[int] = []
    while len(w) < n:
        turn = [r.randrange(k) for _ in range(r.randint(1, 6))]
        w += (turn * r.randint(1, 12))[: r.randint(1, 60)]
        w += [r.randrange(k)] * (r.random() < 0.3)
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_plain_search(seed):
    r = random.Random(seed)
    docs = [random_words(r) for _ in range(1000)]
    for w, runs in zip(docs, R.find_runs([np.array(w, np.int64) for w in docs])):
        assert [(x.start, x.length, x.period) for x in runs] == plain_runs(w), w


def test_long_repetitive_texts():
    for w, n in (([0] * 100_000, 1), ([0, 1] * 50_000, 1), (sum(([100 + i, *range(20)] for i in range(3000)), []), 0)):
        runs = R.find_runs([np.array(w)])[0]
        assert len(runs) == n
        if n:
            assert (runs[0].start, runs[0].length) == (0, len(w))
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert [(x.start, x.length, x.period) for x in R.find_runs([np.array(b)])[0]] == plain_runs(b)


def test_strongest_and_collapsed():
    runs = [R.Run(0, 8, 2), R.Run(3, 12, 3), R.Run(20, 6, 1)]
    assert R.strongest(runs) == R.Run(20, 6, 1)
    assert R.strongest(runs[:2]) == R.Run(0, 8, 2)
    assert R.strongest([]) is None
    assert R.collapsed([bytes([97 + i % 3]) for i in range(12)], [R.Run(0, 12, 3)]) == [b"a", b"b", b"c"]


def expected(doc_id, text: str) -> tuple:
    words = text.encode().split()
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-(r[1] / r[2]), r[0], r[2])) if runs else (None, None, None)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest(), len(words))


def test_rows_equal_plain_search(spark, documents, edges, nothing):
    some = spark.createDataFrame([(10 * i, "a b " * (i % 9) + "c " * i) for i in range(60)], "doc_id long, text string")
    for df in (documents, some, edges.where("doc_id <> 7 or doc_id is null")):
        got = sorted(map(tuple, R.digests(R.plant(df)).collect()), key=str)
        want = sorted((expected(i, t) for i, t in texts_of(df)), key=str)
        assert got == want
    assert any(r.n_runs for r in R.digests(R.plant(documents)).collect())
    assert R.digests(nothing).collect() == []


def test_collapsed_texts(edges):
    for r in by_id(R.find(edges)):
        assert (r.strongest is None) == (not r.runs)
        assert len(r.collapsed.encode().split()) <= r.n_words
