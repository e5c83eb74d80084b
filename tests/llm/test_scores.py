"""Quality, toxicity and secrets: held-out accuracy, planted cases, edge rows."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationlens.llm import quality, secret_scan, toxicity

from .conftest import by_id, prose, texts_of


def held(i) -> bool:
    return zlib.crc32(str(i).encode()) % 4 == 2


def auc(score: np.ndarray, label: np.ndarray) -> float:
    good, bad = score[label == 1], score[label == 0]
    return float(((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :])).mean())


@pytest.mark.parametrize("name,operator,cut", [("quality", quality.score_quality, 0.7), ("toxic", toxicity.score_toxicity, 0.3)])
def test_held_out_accuracy(spark, name, operator, cut):
    more_documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = operator(more_documents, labels).join(labels.select("doc_id", name), "doc_id", "left").collect()
    assert len(rows) == more_documents.count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in rows)
    out = [r for r in rows if r.held_out and r[name] is not None]
    score, label = np.array([r.score for r in out]), np.array([r[name] for r in out])
    assert auc(score, label) > 0.9
    assert np.mean((score >= cut) == (label == 1)) > 0.9


@pytest.mark.parametrize("name,operator", [("quality", quality.score_quality), ("toxic", toxicity.score_toxicity)])
def test_held_out_labels_are_not_read(name, operator, more_documents, labels):
    flipped = labels.withColumn(name, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col(name)).otherwise(F.col(name)))
    a, b = (by_id(operator(more_documents, x)) for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("operator,cut", [(quality.score_quality, 0.7), (toxicity.score_toxicity, 0.3)])
def test_edges(operator, cut, edges, nothing, labels, no_labels):
    rows = by_id(operator(edges, labels))
    assert len(rows) == edges.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in rows)
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    assert len({r.score for r in rows if r.doc_id == 6}) == 1
    rows = operator(edges, no_labels).collect()
    assert len(rows) == edges.count() and all(r.predicted == 0 for r in rows)
    assert operator(nothing, labels).collect() == []


def test_bradley_terry_orders_by_preference():
    r = np.random.default_rng(1)
    stats = r.normal(size=(600, quality.N_STATS))
    worth = stats[:, 3] - 0.5 * stats[:, 7]
    ranker = quality.Ranker(stats, (worth > 0.3).astype(float), cut=0.7)
    score = ranker.scores(stats)
    assert auc(score, (worth > 0.3).astype(int)) > 0.99
    assert np.mean((score >= 0.7) == (worth > 0.3)) > 0.95


def test_fold():
    assert toxicity.fold("1D10T!").split() == ["idiot"]
    assert toxicity.fold("іdіоt  $cum, ｉｄｉｏｔ id​iot").split() == ["idiot", "scum", "idiot", "idiot"]
    for t in ["Éa ½ ²x \xad-y\x85z", "plain words", "", "x" * 100]:
        assert toxicity.fold(t) == toxicity._blanks.sub(" ", f" {t.lower().translate(toxicity._FOLDS)} ")


def test_matches_and_exceptions():
    m = toxicity.Matcher(toxicity.Lexicon({" clown ": 2.0, " idio": 3.0}, [" clown fish "], (-4.0, 1.0, 2.0)))
    assert [w for _, _, w in m.hits(toxicity.fold("clown fish"))] == []
    assert [w for _, _, w in m.hits(toxicity.fold("You clown! Idiocy. clowns"))] == [2.0, 3.0]
    assert [w for _, _, w in m.hits(toxicity.fold("clown clown fish clown"))] == [2.0, 2.0]
    short, long = "you idiot", "you idiot " + "word " * 2000
    assert m.score(short) > m.score(long) > m.score("nothing here")
    assert m.features("") == (0.0, 0.0)


def test_learns_stems_and_exceptions(spark):
    r = random.Random(2)
    rows, lab = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = prose(i, 80).split()
        if toxic:
            words[10] = "grumb" + r.choice(["le", "ling", "led", "ler"])
            words[40] = r.choice(["snark", "Sn4rk", "ѕnаrk"])
        elif i % 3 == 0:
            words[20:22] = ["snark", "hunt"]
        rows.append((i, " ".join(words)))
        lab.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(lab, "doc_id long, toxic int")
    lexicon = toxicity.train(docs, labels)
    assert any(e.startswith(" grumb") for e in lexicon.entries) and " snark " in lexicon.entries or " snar" in "".join(lexicon.entries)
    assert " snark hunt " in lexicon.exceptions
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, labels).collect()}
    assert np.mean([got[i] == t for i, t in lab]) > 0.99
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()}
    assert kept == {i for i, p in got.items() if not p}


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    pat = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(pat, text) if len(m.group(2)) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(out)


def test_base_spans(more_documents):
    r = random.Random(6)
    parts = ["password", "PASSWD", "Secret", "token", "api_key", "apiKey", "ſecret", "toKen", ":", "=", " ", '"', "'", "\t", "AKIA", "AKIAAKIA",
             "abcdef0123456789", "0123", "ABCDEF", "x", "=", "/", "漢", "\n", "zzzzzzzzzzzz", "AKIA" + "Z9" * 8]
    for _ in range(2000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert secret_scan.base_spans(t) == plain_spans(t), t
    for _, t in texts_of(more_documents):
        assert secret_scan.base_spans(t) == plain_spans(t)


def secret_docs(spark):
    r = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = [(i, f"{prose(i, 40)} token = {''.join(r.choice(letters) for _ in range(32))} {prose(i + 1, 40)}") for i in range(300)]
    rows += [(1000 + i, "key " + "".join(r.choice(letters) for _ in range(40)) + " end") for i in range(40)]
    rows += [(2000, "carries_morning_light_over_the_quiet_river_stone"), (2001, prose(7, 300))]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_models_add_unnamed_keys_only(spark):
    docs = secret_docs(spark)
    got = {r.doc_id: r for r in secret_scan.scan_documents(docs).collect()}
    found = [i for i in range(1000, 1040) if got[i].spans == "markov:4:44"]
    assert len(found) >= 36 and all(got[i].n_assign == 0 for i in found)
    assert got[2000].spans == "" and got[2001].spans == ""
    assert all(got[i].n_assign == 1 and got[i].n_markov == 0 for i in range(300))
    clean = {r.doc_id: r.text for r in secret_scan.redact_documents(docs).collect()}
    assert clean[found[0]] == "key [secret] end" and clean[2001] == prose(7, 300)
    assert not any(plain_spans(t) for t in clean.values())


def test_secret_edges(edges, nothing):
    import hashlib

    rows = by_id(secret_scan.scan_documents(edges))
    text = sorted(texts_of(edges), key=lambda x: (x[0] is not None, x[0] or 0))
    assert len(rows) == len(text)
    for r in rows:
        if r.doc_id is None:
            continue
        spans = plain_spans(next(t for i, t in text if i == r.doc_id))
        base = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple([k for _, k, _ in spans].count(n) for n in range(3))
    assert secret_scan.scan_documents(nothing).collect() == []
    same = secret_scan.redact_documents(edges)
    assert same.columns == edges.columns and same.count() == edges.count()
    assert {r.text for r in same.where("doc_id = 1").collect()} == {None}
