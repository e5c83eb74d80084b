"""Approximate nearest neighbours by learned partitions.

A hash sample of the vectors is joined to its nearest neighbours (by inner product), the
neighbour graph is cut into balanced parts (recursive halving, then sweeps that move a vector to
the part where most of its neighbours lie, under a size limit), and a small classifier, one
hidden layer, learns which parts a vector's neighbours lie in. Every row is indexed in the part that
the classifier gives it; a query is sent to as many most probable parts as the sample needs for
``RECALL`` of its true neighbours there, and ranked exactly on the original vectors. Rows that
score less than a query's k-th in the sample cannot be among its k nearest and are not sent on;
the sample's own rows are candidates too, so every query finds k rows.

The sample (at most ``MAX_SAMPLE`` rows) and the classifier are bounded; all rows are indexed and
no part is capped: parts larger than ``BLOCK`` rows are dealt into blocks, and so are the queries,
each pair of blocks being one group; copies of one vector spread over the blocks.

Cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
those of another length than most (ties: the shorter); rows that repeat a vec_id count once, with
the least vector; null ids take no part; equal scores order by vec_id; an empty table, or a
single vector, gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

MAX_PARTS, PER_PART, MAX_SAMPLE, HIDDEN, RECALL = 512, 64, 32_768, 384, 0.97
BLOCK, QUERY_BLOCK, AT_ONCE = 8192, 4096, 256
SCHEMA = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) that take part; one row for an id."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(F.coalesce(finite, F.lit(False))) \
        .where(F.exists("embedding", lambda x: x != 0))
    v = v.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    size = v.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return v.where(F.size("embedding") == (size.n if size else 0))


def exact_top(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """(query, row, score) of the k largest inner products of each query among ``x``, its own id
    left out; equal scores by id. The matrix product only preselects: scores are summed in one
    order for all pairs, so equal vectors score equal."""
    out = []
    for at in range(0, len(q), AT_ONCE):
        part = q[at : at + AT_ONCE]
        s = part @ x.T
        s[q_ids[at : at + AT_ONCE, None] == ids[None, :]] = -np.inf
        if s.shape[1] > k:
            kth = np.partition(s, -k, axis=1)[:, -k]
            slack = 1e-9 * np.maximum(np.abs(part).sum(axis=1) * np.abs(x).max(), 1e-300)
            qi, xi = np.nonzero((s >= (kth - slack)[:, None]) & (s > -np.inf))
        else:
            qi, xi = np.nonzero(s > -np.inf)
        score = np.concatenate([(part[qi[i : i + 65536]] * x[xi[i : i + 65536]]).sum(axis=1)
                                for i in range(0, len(qi), 65536)] or [np.zeros(0)])
        order = np.lexsort((ids[xi], -score, qi))
        qi, xi, score = qi[order], xi[order], score[order]
        rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
        keep = rank < k
        out.append((qi[keep] + at, xi[keep], score[keep]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, int),) * 2 + (np.zeros(0),)


def cut_graph(x: np.ndarray, near: np.ndarray, parts: int, sweeps: int = 12, over: float = 1.15) -> np.ndarray:
    """Balanced parts of a neighbour graph: halved along the main direction, then improved."""
    n = len(x)
    label = np.zeros(n, np.int64)
    todo, made = [(np.arange(n), parts)], 0
    while todo:
        at, p = todo.pop()
        if p == 1:
            label[at], made = made, made + 1
            continue
        y = x[at] - x[at].mean(axis=0)
        v = np.ones(x.shape[1])
        c = y.T @ y
        for _ in range(12):
            v = c @ v
            v /= np.linalg.norm(v) + 1e-300
        order = at[np.argsort(y @ v, kind="stable")]
        left = p // 2
        cut = len(order) * left // p
        todo += [(order[:cut], left), (order[cut:], p - left)]
    limit = math.ceil(over * n / parts)
    for _ in range(sweeps):
        votes = np.zeros((n, parts), np.float32)
        for j in range(near.shape[1]):
            np.add.at(votes, (np.arange(n), label[near[:, j]]), 1.0)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        size = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < limit:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if moved < n // 500:
            break
    return label


class Router:
    """Scores of the parts for vectors: a fixed random hidden layer and a ridge-fitted output."""

    def __init__(self, x: np.ndarray, near: np.ndarray, label: np.ndarray, parts: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.scale = 1.0 / (np.sqrt((x * x).sum(axis=1).mean()) + 1e-300)
        self.hidden = rng.normal(size=(x.shape[1], HIDDEN))
        self.bias = rng.normal(size=HIDDEN) * 0.3
        target = np.zeros((len(x), parts))
        target[np.arange(len(x)), label] = 1.0
        for j in range(near.shape[1]):
            np.add.at(target, (np.arange(len(x)), label[near[:, j]]), 1.0)
        target /= target.sum(axis=1, keepdims=True)
        h = self.layer(x)
        self.weights = np.linalg.solve(h.T @ h + 1e-2 * len(x) / 100 * np.eye(h.shape[1]), h.T @ target)
        self.parts, self.probes = parts, parts

    def layer(self, x: np.ndarray) -> np.ndarray:
        x = x * self.scale
        return np.concatenate([x, np.maximum(x @ self.hidden + self.bias, 0.0), np.ones((len(x), 1))], axis=1)

    def order(self, x: np.ndarray, m: int) -> np.ndarray:
        """The m most probable parts of each vector."""
        score = self.layer(x) @ self.weights
        if m == 1:
            return score.argmax(axis=1)[:, None]
        return np.argsort(-score, axis=1, kind="stable")[:, :m]


    def floor(self, q: np.ndarray, q_ids: np.ndarray, k: int) -> tuple:
        """The queries' nearest among the sample's rows, as :func:`exact_top` gives them, and for
        each query the k-th score there: its k-th nearest row scores that at least."""
        qi, xi, score = exact_top(q, q_ids, self.sample, self.ids, k)
        least = np.full(len(q), -np.inf)
        last = np.flatnonzero(np.arange(len(qi)) - np.searchsorted(qi, qi) == k - 1)
        least[qi[last]] = score[last]
        return qi, self.ids[xi], score, least


def learn(v: DataFrame, n: int, k: int) -> Router:
    """The router, from a bounded sample; its neighbour graph is computed by tasks, a slice each."""
    parts = int(min(MAX_PARTS, max(4, math.sqrt(n) / 2)))
    bound = min(MAX_SAMPLE, PER_PART * parts)
    rows = C.hash_sample(v, "vec_id", min(1.0, bound / n)).orderBy("vec_id").collect()  # about ``bound`` rows
    x = np.array([r.embedding for r in rows], np.float64)
    parts = max(1, min(parts, len(x) // 4))
    shared = v.sparkSession.sparkContext.broadcast(x)
    links = min(max(k, 1), max(len(x) - 1, 1))
    slices = v.sparkSession.range(0, len(x), 1, max(1, min(64, len(x) // 256)))

    def make():
        def run(cols: dict) -> dict:
            at, ids = np.array(cols["id"], np.int64), np.arange(len(shared.value))
            q, xi, _ = exact_top(shared.value[at], at, shared.value, ids, links)
            near = [[] for _ in at]
            for a, b in zip(q.tolist(), xi.tolist()):
                near[a].append(b)
            return {"id": cols["id"], "near": near}
        return run

    C.ship(v.sparkSession)
    graph = {r.id: r.near for r in C.map_rows(slices, "id long, near array<int>", make).collect()}
    near = np.array([(graph[i] + [i] * links)[:links] for i in range(len(x))], np.int64)
    router = Router(x, near, cut_graph(x, near, parts), parts)
    # probes: the sample's neighbours that the first m parts hold
    own = router.order(x, 1)[:, 0]
    order = router.order(x, parts)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(x), 0), 1)
    depth = np.take_along_axis(place, own[near], 1).reshape(-1)
    router.sample, router.ids = x, np.array([r.vec_id for r in rows], np.int64)
    router.probes = int(np.quantile(depth, RECALL, method="higher")) + 1
    return router


def search(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id is divisible by
    ``every``, among all rows but itself."""
    spark = vectors.sparkSession
    v = usable(vectors)
    n = v.count()
    if n < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router = spark.sparkContext.broadcast(learn(v, n, k))  # bounded: HIDDEN x MAX_PARTS numbers

    def place(asks: bool):
        r = router.value

        def run(cols: dict) -> dict:
            x = np.array(cols["embedding"], np.float64).reshape(len(cols["vec_id"]), -1)
            least = r.floor(x, np.array(cols["vec_id"], np.int64), k)[3] if asks else np.zeros(len(x))
            return {"vec_id": cols["vec_id"], "embedding": cols["embedding"], "least": least,
                    "part": r.order(x, r.probes if asks else 1).tolist()}
        return run

    def in_sample():
        def run(cols: dict) -> dict:
            ids = np.array(cols["vec_id"], np.int64)
            qi, found, score, _ = router.value.floor(np.array(cols["embedding"], np.float64).reshape(len(ids), -1), ids, k)
            return {"query_id": ids[qi], "vec_id": found, "score": score}
        return run

    schema = "vec_id long, embedding array<double>, least double, part array<int>"
    rows = C.map_rows(v, schema, lambda: place(False), rows=4096).withColumn("part", F.col("part")[0])
    queries = v.where(F.col("vec_id") % every == 0)
    known = C.map_rows(queries, SCHEMA, in_sample, rows=1024)  # so each query has its k rows whatever its parts hold
    asked = C.map_rows(queries, schema, lambda: place(True), rows=1024) \
        .withColumn("part", F.explode("part"))

    def sizes(df: DataFrame, block: int):
        """Blocks of each part (a row a part comes to the driver)."""
        n = {r.part: -(-r.n // block) for r in df.groupBy("part").agg(F.count("*").alias("n")).collect()}
        lookup = F.create_map(*[F.lit(x).cast("int") for kv in n.items() for x in kv]) if n else None
        return F.coalesce(lookup[F.col("part")], F.lit(1)) if n else F.lit(1)

    n_row, n_query = sizes(rows, BLOCK), sizes(asked, QUERY_BLOCK)
    spread = F.xxhash64("vec_id")
    rows = rows.withColumn("b", F.pmod(spread, n_row).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), n_query.cast("int") - 1)))
    asked = asked.withColumn("q", F.pmod(spread, n_query).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), n_row.cast("int") - 1)))

    def rank(some: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x, q = (np.stack(d.embedding.to_numpy()) for d in (some, queries))
        ids, q_ids = some.vec_id.to_numpy(np.int64), queries.vec_id.to_numpy(np.int64)
        qi, xi, score = exact_top(q, q_ids, x, ids, k)
        near = score >= queries.least.to_numpy()[qi]
        qi, xi, score = qi[near], xi[near], score[near]
        return pd.DataFrame({"query_id": q_ids[qi], "vec_id": ids[xi], "score": score})

    found = rows.groupBy("part", "b", "q").cogroup(asked.groupBy("part", "b", "q")).applyInPandas(rank, SCHEMA)
    found = found.unionByName(known).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # probes x blocks x k rows
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
