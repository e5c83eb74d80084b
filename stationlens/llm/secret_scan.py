"""Secret scans: fixed patterns, and character Markov models for what the patterns miss.

Patterns (kinds in this order): ``assign`` (a named value of 12 or more characters), ``access``
(access key ids of 18 or more), ``hex`` (16 or more hex digits); leftmost, non-overlapping per
kind. The method adds kind ``markov``: runs of 20 or more key characters that no pattern found
and that look random. Two first-order character models are trained from labelled samples, the
values that the patterns found (random strings) and the long words of the same documents
(ordinary identifiers); a run is a secret if its mean log-likelihood ratio reaches the level
half-way between what the two models' own strings have.

The models are sums of character-pair counts over all documents (a fixed-size table, summed in
each task before the shuffle), so they need no sample and stay small; scanning is one more pass
without a shuffle.

Cases: a null or empty text has no spans; without any pattern match, or any word, the method adds
nothing; texts of any length are read whole; repeated rows are scanned each; an empty table gives
no rows. Spans count code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{16,}")
#: Runs the models judge, and the ordinary words they learn from.
RUN, WORD = re.compile(r"[A-Za-z0-9+/_=-]{20,}"), re.compile(r"[A-Za-z][A-Za-z_-]{5,}")
MAYBE = re.compile(r"[:=]")
#: Symbols of the models: letters, digits, other key characters, and the string's border.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-. "
CODE = np.full(256, len(ALPHABET) - 1, np.int64)
CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
N = len(ALPHABET)
MIN_SAMPLES, LEAN = 20, 8.0

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Pattern matches, by start, then kind."""
    out: list[Span] = []
    if MAYBE.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    return out


def values(text: str, spans: list[Span]) -> list[str]:
    """The random part of pattern matches: the value of an assignment, the rest whole."""
    out = []
    for s, kind, e in spans:
        out.append(ASSIGN.match(text, s).group(2) if kind == 0 else text[s:e])
    return out


def pairs(strings: list[str]) -> np.ndarray:
    """Character-pair counts of strings, borders included."""
    raw = np.frombuffer((" " + " ".join(strings) + " ").encode("latin-1", "replace"), np.uint8)
    code = CODE[raw]
    return np.bincount(code[:-1] * N + code[1:], minlength=N * N)


@dataclass
class Models:
    """Log-likelihood ratio of random to ordinary for each character pair, and the level from
    which a run counts as random."""
    ratio: np.ndarray | None = None
    level: float = np.inf

    def of(self, run: str) -> float:
        code = CODE[np.frombuffer(run.encode("latin-1", "replace"), np.uint8)]
        return float(self.ratio[code[:-1] * N + code[1:]].mean()) if len(code) > 1 else -np.inf


def scan(text: str, models: Models) -> list[Span]:
    """All spans, by start, then kind; pattern matches stay as they are."""
    spans = base_spans(text)
    if models.ratio is None:
        return spans
    found = []
    for m in RUN.finditer(text):
        s, e = m.span()
        if not any(a < e and s < b for a, _, b in spans) and models.of(m.group()) >= models.level:
            found.append((s, 3, e))
    return sorted(spans + found)


def train(docs: DataFrame) -> Models:
    """Both models from all documents."""

    def make():
        def run(cols: dict) -> dict:
            random, ordinary, n, best = [], [], 0, []
            for text in cols["text"]:
                spans = base_spans(text)
                if spans:
                    got = values(text, spans)
                    n += len(got)
                    random += got
                at = 0
                for s, _, e in spans:
                    ordinary += WORD.findall(text, at, s) if s > at else []
                    at = max(at, e)
                ordinary += WORD.findall(text, at)
            return {"model": [0, 1], "pairs": [pairs(random).tolist(), pairs(ordinary).tolist()], "n": [n, len(ordinary)]}
        return run

    counted = C.map_rows(C.texts(docs), "model int, pairs array<long>, n long", make, rows=100_000)
    rows = (counted.select("model", "n", F.posexplode("pairs").alias("pair", "k")).groupBy("model", "pair")
            .agg(F.sum("k").alias("k"), F.sum("n").alias("n")).collect())  # 2 x N x N numbers
    count, n = np.zeros((2, N * N)), [0, 0]
    for r in rows:
        count[r.model, r.pair], n[r.model] = r.k, r.n
    if min(n) < MIN_SAMPLES:
        return Models()
    share, first = [], []
    for c in count:
        c = c.reshape(N, N)
        single = (c.sum(axis=0) + 0.5) / (c.sum() + 0.5 * N)  # pairs seen seldom lean on the character alone
        share.append((c + LEAN * single) / (c.sum(axis=1, keepdims=True) + LEAN))
        first.append((c.sum(axis=1) + 0.5) / (c.sum() + 0.5 * N))
    ratio = np.log(share[0] / share[1])
    inner = np.arange(N - 1)  # without the border
    means = []
    for p, q in zip(share, first):  # the mean ratio of strings that each model itself would write
        w = (q[:, None] * p)[np.ix_(inner, inner)]
        means.append(float((w * ratio[np.ix_(inner, inner)]).sum() / w.sum()))
    return Models(ratio.reshape(-1), max((means[0] + means[1]) / 2, 0.0))


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per document: spans of the patterns by kind, their digest, and all spans."""
    models = train(docs)

    def make():
        def run(cols: dict) -> dict:
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans")}
            for text in cols["text"]:
                spans = scan(text, models)
                kinds = [k for _, k, _ in spans]
                for k, name in enumerate(KINDS):
                    out[f"n_{name}"].append(kinds.count(k))
                base = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans if k < 3)
                out["base_sha256"].append(hashlib.sha256(base.encode("ascii")).hexdigest())
                out["spans"].append(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans))
            return {"doc_id": cols["doc_id"], **out}
        return run

    return C.map_rows(C.texts(docs), SCHEMA, make)


def redact(text: str, models: Models, mark: str = "[secret]") -> str:
    """The text with each span, or run of overlapping spans, replaced by ``mark``."""
    out, at = [], 0
    for s, _, e in scan(text, models):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]]) if out else text


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with the secrets in ``text`` replaced; null stays null."""
    models = train(docs)

    @F.pandas_udf("string")
    def clean(text):
        return text.map(lambda t: None if t is None else redact(t, models))

    return docs.withColumn("text", clean(F.col("text").cast("string")))
