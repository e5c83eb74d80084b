"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, homoglyphs to their Latin letter, digits and signs that
stand for letters to those, marks dropped, all else to blanks. Lexicon entries are whole words and
stems (" idiot ", " idio") weighted by the log-odds of the two labels
(counting documents that hold them once, or twice where that tells more); phrases of an entry with
a neighbour word that only clean documents hold are exceptions, and a match inside one does not
count. A text's weight is normalised by its length, and a logistic curve over both gives the
score.

Lexicon, exceptions and curve are learned from a hash sample of about ``TRAIN_ROWS`` labelled
rows (never held-out ones). An entry needs a likelihood ratio that no chance word among all
candidates would reach, so rare words of a few copied documents stay out. Every term of the sample's
toxic documents is tested, in Spark; what passes is all that comes to the driver. Its size is bounded
by the sample alone: an entry needs several toxic documents of it. Scoring is one scan without a shuffle.

Cases: a null or empty text has no match and the score of a clean text; without two labels the
lexicon is empty; long texts are read whole; repeated rows score alike; an empty table gives no
rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlens.session import checkpoint_dir

from . import common as C

TRAIN_ROWS, STEMS = 20_000, (4, 5, 6, 7, 8)
#: Documents that a candidate and an exception must at least occur in.
MIN_TOXIC, MIN_CLEAN = 4, 4

# Letters of other scripts that look like a Latin one, and signs used for letters.
HOMOGLYPHS = {
    "a": "аαɑ", "b": "ьβ", "c": "сϲ", "d": "ԁ", "e": "еεє", "g": "ɡ", "h": "һ", "i": "іιı", "j": "ј",
    "k": "кκ", "l": "ӏ", "m": "м", "n": "ո", "o": "оοσ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ",
    "t": "тτ", "u": "υս", "v": "νѵ", "w": "ԝω", "x": "хχ", "y": "уү", "z": "ᴢ",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
JOINERS = "­​‌‍⁠﻿"  # invisible characters inside words


def _letter(c: str) -> str:
    """What a character folds to: letters, or a blank."""
    if c in JOINERS or unicodedata.combining(c):
        return ""
    out = []
    for x in unicodedata.normalize("NFKC", SIGNS.get(c, c)).lower():
        x = _LOOKS.get(x, SIGNS.get(x, x))
        out.append(x if x.isalpha() else " ")
    return "".join(out) or " "


_LOOKS = {other: latin for latin, others in HOMOGLYPHS.items() for other in others}


class _Folds(dict):
    def __missing__(self, code: int) -> str:
        self[code] = s = _letter(chr(code))
        return s


_FOLDS = _Folds()
_blanks = re.compile(" {2,}")
# Latin-1 texts fold as bytes, unless they hold a character that folds to several
_LATIN1 = [_letter(c.lower()) if len(c.lower()) == 1 else "??" for c in C.LATIN1]
_DROPPED = "".join(c for c, f in zip(C.LATIN1, _LATIN1) if c in JOINERS).encode("latin-1")
_ODD = re.compile("[^" + "".join(re.escape(c) for c, f in zip(C.LATIN1, _LATIN1)
                                 if c in JOINERS or len(f) == 1 and f <= "\xff") + "]")
_TABLE = "".join(f if len(f) == 1 and f <= "\xff" else " " for f in _LATIN1).encode("latin-1")


def fold(text: str) -> str:
    """The folded text: words of letters, each with one blank on both sides."""
    if _ODD.search(text) is None:
        folded = text.encode("latin-1").translate(_TABLE, _DROPPED).decode("latin-1")
    else:
        folded = text.lower().translate(_FOLDS)
    return _blanks.sub(" ", f" {folded} ")


@dataclass
class Lexicon:
    entries: dict[str, float] = field(default_factory=dict)  # folded string with its blanks -> weight
    exceptions: list[str] = field(default_factory=list)  # folded phrases
    curve: tuple[float, float, float] = (-4.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for e, w in self.entries.items():
            a.add_word(e, (len(e), w))
        for e in self.exceptions:
            a.add_word(e, (len(e), None))
        if len(a):
            a.make_automaton()
        return a


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.automaton = lexicon, lexicon.automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the matches outside exception phrases; of the entries that
        match at one place the longest counts."""
        if not len(self.automaton):
            return []
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for end, (n, w) in self.automaton.iter(folded):
            start = end - n + 1
            if w is None:
                spared.append((start, end))
            elif start not in best or best[start][0] < end:
                best[start] = (end, w)
        if not spared:
            return [(s, e, w) for s, (e, w) in best.items()]
        reach, ends = -1, {}
        for s, e in sorted(spared):
            reach = max(reach, e)
            ends[s] = reach
        starts = sorted(ends)
        out = []
        for s, (e, w) in best.items():
            i = np.searchsorted(starts, s, side="right") - 1
            if i < 0 or ends[starts[i]] < e:
                out.append((s, e, w))
        return out

    def features(self, text: str) -> tuple[float, float]:
        """(log of the weight, log of the weight per 100 words)."""
        folded = fold(text)
        total = sum(w for _, _, w in self.hits(folded))
        return math.log1p(max(total, 0.0)), math.log1p(max(total, 0.0) * 100 / max(folded.count(" ") - 1, 1))

    def score(self, text: str) -> float:
        a, b, c = self.lexicon.curve
        x, y = self.features(text)
        return float(C.sigmoid(np.float64(a + b * x + c * y)))


def _terms(folded: str) -> dict[str, int]:
    """Times that each whole word and stem occurs."""
    out: dict[str, int] = {}
    for w, k in Counter(folded.split()).items():
        for n in STEMS:
            if len(w) < n:
                break
            stem = " " + w[:n]
            out[stem] = out.get(stem, 0) + k
        out[f" {w} "] = k
    return out


def _tally(sample: DataFrame, finder) -> DataFrame:
    """(term, once, twice): documents that hold a term at least once and twice; counted in each
    task before the shuffle."""

    def make():
        find = finder()

        def run(cols: dict) -> dict:
            once, twice = Counter(), Counter()
            for text in cols["text"]:
                found = find(fold(text))
                once.update(found.keys())
                twice.update([t for t, k in found.items() if k > 1])
            return {"term": list(once), "once": list(once.values()), "twice": [twice[t] for t in once]}
        return run

    return (C.map_rows(sample, "term string, once long, twice long", make, rows=1024).groupBy("term")
            .agg(F.sum("once").alias("once"), F.sum("twice").alias("twice")))


def _gain(t: str, c: str, base: float):
    """Log-likelihood ratio of a term's split between the labels (columns) against the base rate."""
    t, c = F.col(t).cast("double"), F.col(c).cast("double")
    p = F.try_divide(t, t + c)
    gain = t * F.ln(p / base) + F.when(c > 0, c * F.ln((1 - p) / (1 - base))).otherwise(0.0)
    return F.when((t > 0) & (p > base), gain).otherwise(0.0)


def _gain_of(t: float, c: float, base: float) -> float:
    """The same of two numbers."""
    p = t / (t + c) if t else 0.0
    if p <= base:
        return 0.0
    return t * math.log(p / base) + (c * math.log((1 - p) / (1 - base)) if c else 0.0)


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> Lexicon:
    checkpoint_dir(docs.sparkSession)
    sample = C.labelled_sample(docs, labels, "toxic", bound).dropDuplicates(["text", "label"]) \
        .select("doc_id", "text", "label").checkpoint()
    n = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1.0, 0), n.get(0.0, 0)
    if not toxic or not clean:
        return Lexicon()
    base = toxic / (toxic + clean)
    bad, good = sample.where("label = 1"), sample.where("label = 0")
    # no chance word among the terms that recur (some 10 for each document) gets to this ratio
    need = math.log((toxic + clean) * 10.0)
    # a term in too few toxic documents cannot reach it, even if no clean one held it
    could = _tally(bad, lambda: _terms).where((F.col("once") >= MIN_TOXIC) & (F.col("once") >= F.lit(need / -math.log(base)))) \
        .select("term", F.col("once").alias("t0"), F.col("twice").alias("t1"))
    seen = _tally(good, lambda: _terms).select("term", F.col("once").alias("c0"), F.col("twice").alias("c1"))
    tested = could.join(seen, "term", "left").fillna(0, ["c0", "c1"])
    passing = tested.where(F.greatest(_gain("t0", "c0", base), _gain("t1", "c1", base)) >= need * (1 - 1e-9))
    ranked = []
    for r in passing.collect():
        gain, k = max((_gain_of(t, c, base), -k) for k, (t, c) in enumerate(((r.t0, r.c0), (r.t1, r.c1))))
        if gain >= need:
            t, c = (r.t0, r.c0) if k == 0 else (r.t1, r.c1)
            weight = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
            ranked.append((-gain, -len(r.term), r.term, weight))
    entries: dict[str, float] = {}
    begun: set[str] = set()  # beginnings of entries
    for _, _, term, weight in sorted(ranked):
        # not the same word again by a better stem or the whole word
        heads = [term[:n] for n in range(1, len(term) + 1)]
        if term not in begun and not any(h in entries for h in heads):
            entries[term] = weight
            begun.update(heads)
    lexicon = Lexicon(entries)
    if not entries:
        return lexicon

    def contexts():
        matcher = Matcher(lexicon)

        def find(folded: str) -> dict[str, int]:
            out = {}
            for s, _, _ in matcher.hits(folded):
                end = folded.index(" ", s + 1)
                before, after = folded.rfind(" ", 0, s) if s else -1, folded.find(" ", end + 1)
                if before >= 0:
                    out[folded[before : end + 1]] = 1
                if after >= 0:
                    out[folded[s : after + 1]] = 1
            return out
        return find

    clean_only = (_tally(good, contexts).where(F.col("once") >= MIN_CLEAN)
                  .join(_tally(bad, contexts).select("term"), "term", "left_anti"))
    lexicon.exceptions = sorted(r.term for r in clean_only.select("term").collect())

    def make():
        matcher = Matcher(lexicon)

        def run(cols: dict) -> dict:
            xy = [matcher.features(t) for t in cols["text"]]
            return {"label": cols["label"], "x": [a for a, _ in xy], "y": [b for _, b in xy]}
        return run

    got = C.map_rows(sample, "label double, x double, y double", make).collect()  # TRAIN_ROWS x 3 numbers
    got.sort()
    x = np.array([[1.0, r.x, r.y] for r in got])
    lexicon.curve = tuple(C.newton_logistic(x, np.array([r.label for r in got]), 1e-4).tolist())
    return lexicon


def score_toxicity(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if the score reaches ``cut``)."""
    lexicon = train(docs, labels)

    def make():
        matcher = Matcher(lexicon)
        return lambda cols: {"doc_id": cols["doc_id"], "score": [matcher.score(t) for t in cols["text"]]}

    return (C.map_rows(C.texts(docs), "doc_id long, score double", make)
            .select("doc_id", C.held_out().alias("held_out"), "score",
                    (F.col("score") >= cut).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """The documents (all their columns) that score below ``cut``."""
    lexicon = train(docs, labels)

    @F.pandas_udf("double")
    def score(text):
        matcher = Matcher(lexicon)
        return text.map(matcher.score)

    return docs.where(score(F.coalesce(F.col("text").cast("string"), F.lit(""))) < cut)
