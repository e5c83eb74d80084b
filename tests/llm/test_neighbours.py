"""Nearest neighbours against brute force, and the pipeline against its parts."""

import numpy as np
import pytest

import corpus_pipeline
from stationlens.llm import ann, toxicity

from .conftest import texts_of
from .test_copies import plain_dedup, plain_join
from .test_scores import plain_spans

SF = "/root/testdata/sf0.001"


def brute(rows, every=20, k=20):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    score = {(r[0], v): s for r in [(q,) for q in want] for v, s in want[r[0]]}
    got = {}
    for r in ann.search(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(want)
    hit = np.mean([len({v for v, _ in want[q]} & {r.vec_id for r in rows}) / len(want[q]) for q, rows in got.items()])
    assert hit >= 0.9
    for q, rows in got.items():
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) == 20
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        assert all(abs(r.score - score[q, r.vec_id]) < 1e-12 for r in rows if (q, r.vec_id) in score)


@pytest.mark.parametrize("block", [8192, 7])
def test_copies_of_one_vector_and_ties(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "QUERY_BLOCK", block)
    monkeypatch.setattr(ann, "RECALL", 1.0)
    r = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0, 0.5] if i % 3 == 0 else r.normal(size=4).round(1).tolist()) for i in range(240)]
    rows = [(i, x if any(x) else [1.0] * 4) for i, x in rows]
    got = {}
    for x in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5).orderBy("rank").collect():
        got.setdefault(x.query_id, []).append((x.vec_id, x.score))
    want = brute(rows, k=5)
    assert got.keys() == want.keys()
    assert all([a for a, _ in got[q]] == [a for a, _ in want[q]] for q in want)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, [0.5, 1.0]), (9, [0.5, 1.0]), (40, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, part string, score int")
    got = [tuple(r) for r in ann.search(df).orderBy("rank").collect()]
    assert got == [(20, 1, 1, 2.0), (20, 2, 9, 0.5)]
    assert ann.search(df.where("vec_id = 20")).collect() == [] == ann.search(df.limit(0)).collect()


def test_balanced_parts():
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 8)) + np.repeat(np.eye(8) * 6, 50, 0)
    _, near, _ = ann.exact_top(x, np.arange(400), x, np.arange(400), 10)
    label = ann.cut_graph(x, near.reshape(400, 10), 8)
    assert np.bincount(label, minlength=8).max() <= 58
    assert (label[near.reshape(400, 10)] == label[:, None]).mean() > 0.8


def test_stages_do_their_work(spark, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sf = "/root/testdata/sf0.01"
    got, df = {}, spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 400")  # a small fixture
    start = df
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, sf)
        rows = out.collect()
        got[name] = (df, out, rows)
        if name != "packing":
            assert out.columns == docs.columns
            df = spark.createDataFrame(rows, docs.schema)
    before, _, rows = got["toxicity"]
    bad = {r.doc_id for r in toxicity.score_toxicity(start, labels).collect() if r.predicted}
    assert {r.doc_id for r in rows} == {r.doc_id for r in start.collect()} - bad
    before, out, rows = got["line_dedup"]
    import hashlib
    assert sorted((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows) == \
        sorted((x[0], x[3]) for x in plain_dedup(texts_of(before), 40, 5))
    assert all(r.n_chars == len(r.text) for r in rows)
    before, out, rows = got["ngram_join"]
    assert sorted(r.doc_id for r in rows) == sorted(i for i, c, _ in plain_join(texts_of(before)) if i == c)
    before, out, rows = got["secret_scan"]
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in texts_of(before))
    was = dict(texts_of(before))
    assert all(not plain_spans(r.text) for r in rows)
    assert all(r.text == was[r.doc_id] for r in rows if not plain_spans(was[r.doc_id]) and "[secret]" not in r.text)
    before, out, rows = got["packing"]
    assert {r.doc_id for r in rows} == {i for i, _ in texts_of(before)}


def test_run_and_edges(spark, edges, nothing):
    assert corpus_pipeline.run(spark, SF).count() > 0
    for df in (edges, nothing):
        n = df.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, "/root/testdata/sf0.01")
            if name == "packing":
                assert (out.count() > 0) == (n > 0)
            else:
                assert out.columns == df.columns and out.count() <= n
