"""Token counts by the whole-token shortcut.

For a word-BPE vocabulary (``tokenizers`` JSON: NFC, white space dropped, lower case, words
split by a pattern, byte-level symbols with an end-of-word mark) most words are one token.
``whole_words`` proves offline, with the tokenizer library itself, which vocabulary strings
encode alone as exactly one token. A document's count is then the sum over its words of
1 (proven) or the length of the word's merge sequence (the rest, merged here and remembered).

Exactness outside Latin-1: the library's own normaliser and pre-tokeniser cut the text, and the
same table of proven words and merges counts the pieces. Special strings in a text count as the
library's default has them: one token each, matched before normalising.

Cases: null or empty text has 0 tokens and 0 bytes; texts of any length are read whole; repeated
rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import heapq
import json
import re

from pyspark.sql import DataFrame

from . import common as C

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: Merged words remembered in a worker before it starts anew (bounds memory, not work).
REMEMBER = 500_000
NEVER = 1 << 60


@functools.lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, spare = {b: chr(b) for b in keep}, 256
    for b in range(256):
        if b not in names:
            names[b], spare = chr(spare), spare + 1
    return [names[b] for b in range(256)]


@functools.lru_cache(maxsize=4)
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    return {"vocab": spec["model"]["vocab"], "ranks": {m: i for i, m in enumerate(merges)},
            "end": spec["model"]["end_of_word_suffix"] or "",
            "special": [t["content"] for t in spec["added_tokens"]]}


@functools.lru_cache(maxsize=4)
def whole_words(path: str) -> frozenset[str]:
    """Vocabulary words (byte-letter form, without the end mark) proven to encode alone as one
    token: the library encodes each one's text and must answer exactly that id."""
    spec, tok = _spec(path), library(path)
    back = {c: b for b, c in enumerate(byte_letters())}
    cand: list[tuple[str, str, int]] = []
    for s, i in spec["vocab"].items():
        if spec["end"] and s.endswith(spec["end"]) and len(s) > len(spec["end"]):
            w = s[: -len(spec["end"])]
            try:
                cand.append((w, bytes(back[c] for c in w).decode("utf-8"), i))
            except (KeyError, UnicodeDecodeError):
                continue  # a part of a character is never a word of its own
    got = tok.encode_batch([t for _, t, _ in cand], add_special_tokens=False)
    return frozenset(w for (w, _, i), e in zip(cand, got) if e.ids == [i])


class WordCounter:
    """Tokens of a text. ``proven``: the words from :func:`whole_words`."""

    def __init__(self, path: str, proven: frozenset[str]):
        spec = _spec(path)
        self.path, self.ranks, self.end = path, spec["ranks"], spec["end"]
        self.letters = byte_letters()
        self.special = re.compile("|".join(map(re.escape, spec["special"]))) if spec["special"] else None
        L, N, S = C.LETTERS, C.NUMBERS, re.escape(C.SPACES)
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+").findall
        outer = self

        class Pieces(dict):  # byte-letter form -> tokens
            def __missing__(self, piece: str) -> int:
                if len(self) > REMEMBER + len(proven):
                    self.clear()
                    self.update(dict.fromkeys(proven, 1))
                n = self[piece] = outer.merged(piece)
                return n

        class Words(dict):  # Latin-1 word -> tokens
            def __missing__(self, word: str) -> int:
                if len(self) > REMEMBER:
                    self.clear()
                n = outer.pieces["".join(map(outer.letters.__getitem__, word.encode("utf-8")))]
                if len(word) <= 64:
                    self[word] = n
                return n

        self.pieces, self.known = Pieces.fromkeys(proven, 1), Words()

    def merged(self, piece: str) -> int:
        """Tokens left after all merges of one pre-token: the best-ranked pair merges first, the
        left one of equals. Long pre-tokens use a heap and a linked list (n log n)."""
        parts: list[str | None] = [*piece[:-1], piece[-1] + self.end]
        n, ranks = len(parts), self.ranks
        if n <= 48:
            rank = [ranks.get(p, NEVER) for p in zip(parts, parts[1:])]
            while rank:
                r = min(rank)
                if r == NEVER:
                    break
                i = rank.index(r)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                del rank[i]
                if i:
                    rank[i - 1] = ranks.get((parts[i - 1], parts[i]), NEVER)
                if i < len(rank):
                    rank[i] = ranks.get((parts[i], parts[i + 1]), NEVER)
            return len(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            n, k, h = n - 1, after[j], before[i]
            after[i] = k
            if k >= 0:
                before[k] = i
                if (r := ranks.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[k]))
            if h >= 0 and (r := ranks.get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return n

    def part(self, text: str) -> int:
        if C.BEYOND_LATIN1.search(text) is None:
            return sum(map(self.known.__getitem__, self.words(text.lower())))
        tok = library(self.path)
        cut = tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(text))
        return sum(self.pieces[p] for p, _ in cut if p)

    def count(self, text: str) -> int:
        if self.special is None or "<" not in text:
            return self.part(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.part(p) for p in parts if p)


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """One row per document: UTF-8 bytes, tokens, and whether the tokens exceed ``limit``. One
    scan, no shuffle."""
    proven = docs.sparkSession.sparkContext.broadcast(whole_words(path))  # part of a fixed vocabulary

    def make():
        counter = WordCounter(path, proven.value)

        def run(cols: dict) -> dict:
            n = [counter.count(t) for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "n_bytes": [len(t.encode("utf-8")) for t in cols["text"]],
                    "n_tokens": n, "over_limit": [x > limit for x in n]}
        return run

    return C.map_rows(C.texts(docs), SCHEMA, make)
