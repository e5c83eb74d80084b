"""Quality classifier by Bradley-Terry pairwise ranking.

A document's worth is a linear function of text statistics (character classes, repetition,
word and line shapes, each also bent at its training quantiles). Pairs of a good and a bad
document train it: the logistic loss of the difference of the two feature vectors, so only the
order counts. A document is then good if its worth reaches a quantile of the training worths,
the one that separates the training labels best; the score is a logistic curve through
``cut`` at that quantile.

Training reads a hash sample of about ``TRAIN_ROWS`` labelled rows (never held-out ones); only
their statistics, 20 numbers each, come to the driver. Scoring is one scan without a shuffle.

Cases: a null or empty text has all statistics zero and gets the score that these give; without
two labels every document gets the same score, below ``cut``; long texts are read whole;
repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

TRAIN_ROWS, PAIRS, BENDS = 20_000, 100_000, (0.05, 0.25, 0.5, 0.75, 0.95)
N_STATS = 20

_CLASS = np.zeros(256, np.int64)  # 0 other symbol, 1 lower, 2 upper, 3 digit, 4 blank, 5 newline, 6 stop, 7 high byte
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 7
_CLASS[[32, 9]], _CLASS[[10, 13]], _CLASS[[ord(c) for c in ".,;:'-?"]] = 4, 5, 6


def statistics(text: str) -> list[float]:
    """The 20 numbers that describe a text."""
    raw = text.encode("utf-8")
    if not raw:
        return [0.0] * N_STATS
    n = len(raw)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = np.bincount(_CLASS, weights=seen, minlength=8) / n
    words = text.split()
    nw = max(len(words), 1)
    count = Counter(words)
    lines = text.split("\n")
    symbols = seen[_CLASS == 0]
    return [*share.tolist(), symbols.max() / n, np.log1p(nw), min(n / nw, 100.0), len(count) / nw,
            max(count.values(), default=0) / nw, sum(map(eq, words, words[1:])) / nw,
            len(zlib.compress(raw, 1)) / n, len(set(lines)) / len(lines), np.log1p(len(lines)),
            np.log1p(nw / len(lines)), float(len(count) < 12), seen[ord("!")] / n]


class Ranker:
    """Trained on statistics (rows) and labels."""

    def __init__(self, stats: np.ndarray, labels: np.ndarray, cut: float, seed: int = 7):
        self.cut, self.flat = cut, True
        good, bad = np.flatnonzero(labels > 0.5), np.flatnonzero(labels <= 0.5)
        if not len(good) or not len(bad):
            return
        self.flat = False
        self.knots = np.quantile(stats, BENDS, axis=0)
        self.mean, self.scale = np.zeros(1), np.ones(1)
        x = self.bent(stats)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = self.bent(stats)
        rng = np.random.default_rng(seed)
        left, right = rng.choice(good, PAIRS), rng.choice(bad, PAIRS)
        self.weights = C.newton_logistic(x[left] - x[right], np.ones(PAIRS), 1e-4)
        worth = x @ self.weights
        # the quantile of all worths with the best mean of the two labels' accuracies
        order = np.sort(worth)
        q = np.linspace(0, 1, 1001)[1:-1]
        at = np.quantile(order, q)
        g, b = np.sort(worth[good]), np.sort(worth[bad])
        hit = (1 - np.searchsorted(g, at) / len(g)) + np.searchsorted(b, at) / len(b)
        best = np.flatnonzero(hit >= hit.max() - 1e-9)
        self.quantile = float(q[best[len(best) // 2]])
        self.at = float(np.quantile(order, self.quantile))
        self.spread = float(np.quantile(np.abs(worth - self.at), 0.5)) / 3 + 1e-9

    def bent(self, stats: np.ndarray) -> np.ndarray:
        x = np.concatenate([stats, *(np.maximum(stats - k, 0.0) for k in self.knots)], axis=1)
        return (x - self.mean) / self.scale

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if self.flat:
            return np.full(len(stats), self.cut / 2)
        z = np.clip((self.bent(stats) @ self.weights - self.at) / self.spread, -30.0, 30.0)
        return C.sigmoid(z + np.log(self.cut / (1 - self.cut)))


def train(docs: DataFrame, labels: DataFrame, cut: float, bound: int = TRAIN_ROWS) -> Ranker:
    sample = C.labelled_sample(docs, labels, "quality", bound)

    def make():
        return lambda cols: {"doc_id": cols["doc_id"], "label": cols["label"],
                             "stats": [statistics(t) for t in cols["text"]]}

    rows = C.map_rows(sample, "doc_id long, label double, stats array<double>", make) \
        .orderBy("doc_id", "label").collect()  # about TRAIN_ROWS rows of N_STATS numbers
    return Ranker(np.array([r.stats for r in rows]).reshape(-1, N_STATS), np.array([r.label for r in rows]), cut)


def score_quality(docs: DataFrame, labels: DataFrame, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if the score reaches ``cut``)."""
    ranker = train(docs, labels, cut)

    def make():
        def run(cols: dict) -> dict:
            s = ranker.scores(np.array([statistics(t) for t in cols["text"]]).reshape(-1, N_STATS))
            return {"doc_id": cols["doc_id"], "score": s.tolist()}
        return run

    return (C.map_rows(C.texts(docs), "doc_id long, score double", make)
            .select("doc_id", C.held_out().alias("held_out"), "score",
                    (F.col("score") >= cut).cast("int").alias("predicted")))
