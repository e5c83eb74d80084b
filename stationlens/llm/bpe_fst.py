"""Byte-level BPE as a lazily determinised finite-state transducer.

The merges (rank file) are compiled once: a trie of the tokens that their own bytes merge to,
and the relation "token b may follow token a" (merging a's and b's bytes gives a, b again). An
encoding is valid exactly if each neighbouring pair is, and every prefix of a text has one valid
encoding, so a position is described by the token that ends there. A state of the transducer is
the list of started but unfinished tokens (trie node, the token before, the tokens not emitted
yet); reading a byte moves every trie node, and what all survivors agree on is emitted. States
and transitions are made when first met and remembered; the pending tokens span the longest
token at most, which bounds the lookahead.

``Utf8Stream`` decodes ids as they come: a UTF-8 state machine built by rule from the encoding's
definition carries an unfinished character over chunk ends.

Cases: a null or empty text has no ids, and both digests are those of the empty string; texts of
any length are read whole; repeated rows are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

from . import common as C

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Pre-tokens and transitions remembered in a worker before it starts anew.
REMEMBER, TRANSITIONS = 200_000, 800_000
#: Pre-tokens of a text encoded and decoded at a time.
CHUNK = 50_000
NONE = -1


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int], down_to: int = 1) -> list[bytes]:
    """Merges by rank, the plain way (for short pieces: the compiler and tests use it), until
    ``down_to`` parts are left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > down_to:
        r, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if r == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Transducer:
    """encode(bytes) -> ids of one pre-token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        # trie: node -> {byte: node}; token id at a node, if its bytes merge to itself
        self.next: list[dict[int, int]] = [{}]
        self.token: list[int] = [NONE]
        self.checked: list[bool] = [True]
        for t, i in ranks.items():
            node = 0
            for b in t:
                child = self.next[node].get(b)
                if child is None:
                    child = self.next[node][b] = len(self.next)
                    self.next.append({})
                    self.token.append(NONE)
                    self.checked.append(True)
                node = child
            self.token[node], self.checked[node] = i, False
        self.follows: dict[int, bool] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        self.reset()

    def reset(self) -> None:
        """Forgets the states and transitions made so far."""
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        # state << 8 | byte -> next state, or ~i where tokens are emitted: emits[i] is (next state, tokens).
        # Plain numbers, which the garbage collector never visits.
        self.moves: dict[int, int] = {}
        self.emits: list[tuple[int, tuple]] = []
        self.start = self.state(((0, NONE, ()),))

    def state(self, items: tuple) -> int:
        n = self.number.get(items)
        if n is None:
            n = self.number[items] = len(self.states)
            self.states.append(items)
        return n

    def whole(self, node: int) -> int:
        """The token at a trie node, if merging its bytes gives it."""
        if not self.checked[node]:
            self.checked[node] = True
            t = self.bytes_of[self.token[node]]
            if len(merge(t, self.ranks)) != 1:
                self.token[node] = NONE
        return self.token[node]

    def may_follow(self, a: int, b: int) -> bool:
        if a == NONE:
            return True
        key = a << 32 | b
        ok = self.follows.get(key)
        if ok is None:
            if len(self.follows) > 1_000_000:
                self.follows.clear()
            ok = self.follows[key] = self._meet(a, b)
        return ok

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens that a token's last merge joins; None for a single byte."""
        if token not in self.split:
            text = self.bytes_of[token]
            two = merge(text, self.ranks, 2) if len(text) > 1 else ()
            self.split[token] = (self.ranks[two[0]], self.ranks[two[1]]) if two else None
        return self.split[token]

    def _meet(self, a: int, b: int) -> bool:
        """Whether merging a's and b's bytes leaves a, b. Goes back through the merges of both, the
        latest first (of equal ones the right one, which merges later): at no time may the tokens on
        either side of the border merge before the merge that was just undone."""
        get, bytes_of = self.ranks.get, self.bytes_of
        limit = 1 << 60
        while True:
            if get(bytes_of[a] + bytes_of[b], 1 << 60) < limit:
                return False
            left, right = self.parts(a), self.parts(b)
            if left is None and right is None:
                return True
            if right is None or left is not None and a > b:
                limit, a = a, left[1]
            else:
                limit, b = b + 1, right[0]

    def move(self, s: int, b: int) -> int:
        """The transition from state ``s`` on byte ``b``, as in ``moves``; made once."""
        below, follows = self.next, self.follows
        alive, last = [], None
        for node, prev, pending in self.states[s]:
            child = below[node].get(b)
            if child is None:
                continue
            if last is None:
                t = self.token[child] if self.checked[child] else self.whole(child)
                if t != NONE and (follows.get(prev << 32 | t) or self.may_follow(prev, t)):
                    last = (0, t, (*pending, t))
            if below[child]:
                alive.append((child, prev, pending))
        alive.append(last)  # one token always ends here: every prefix has an encoding
        out = alive[0][2]
        for _, _, p in alive:  # what all agree on
            if not out:
                break
            if p[: len(out)] != out:
                sure = 0
                while sure < len(p) and p[sure] == out[sure]:
                    sure += 1
                out = out[:sure]
        if out:
            sure = len(out)
            to = ~len(self.emits)
            self.emits.append((self.state(tuple([(n, p, q[sure:]) for n, p, q in alive])), out))
        else:
            to = self.state(tuple(alive))
        self.moves[s << 8 | b] = to
        return to

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.moves) > TRANSITIONS:
            self.reset()
        ids: list[int] = []
        s, moves = self.start, self.moves
        for b in piece:
            to = moves.get(s << 8 | b)
            if to is None:
                to = self.move(s, b)
            if to < 0:
                s, out = self.emits[~to]
                ids += out
            else:
                s = to
        ids += self.states[s][-1][2]
        return ids


class Utf8Stream:
    """Bytes to characters, in chunks cut anywhere. The state is how many bytes the open character
    still needs and the range its next byte must lie in; faulty bytes become U+FFFD as in
    ``bytes.decode(errors='replace')``."""

    def __init__(self):
        self.need, self.low, self.high, self.open = 0, 0x80, 0xBF, b""

    @staticmethod
    def lead(b: int) -> tuple[int, int, int]:
        """(bytes that follow, least and greatest second byte) of a first byte; -1: none such."""
        if b < 0x80:
            return 0, 0x80, 0xBF
        n = 1 if 0xC2 <= b <= 0xDF else 2 if 0xE0 <= b <= 0xEF else 3 if 0xF0 <= b <= 0xF4 else -1
        low = 0xA0 if b == 0xE0 else 0x90 if b == 0xF0 else 0x80  # no overlong forms
        high = 0x9F if b == 0xED else 0x8F if b == 0xF4 else 0xBF  # no surrogates, none past U+10FFFF
        return n, low, high

    def feed(self, chunk: bytes) -> str:
        if not self.need:
            # whole characters at once; the state machine takes the last bytes or a faulty chunk
            cut = len(chunk)
            while cut and len(chunk) - cut < 4 and chunk[cut - 1] & 0xC0 == 0x80:
                cut -= 1
            if cut and chunk[cut - 1] >= 0x80:
                cut -= 1
            try:
                return chunk[:cut].decode("utf-8") + (self.steps(chunk[cut:]) if cut < len(chunk) else "")
            except UnicodeDecodeError:
                pass
        return self.steps(chunk)

    def steps(self, chunk: bytes) -> str:
        out: list[str] = []
        for b in chunk:
            if self.need:
                if self.low <= b <= self.high:
                    self.open += bytes([b])
                    self.need, self.low, self.high = self.need - 1, 0x80, 0xBF
                    if not self.need:
                        out.append(self.open.decode("utf-8"))
                    continue
                out.append("�")
                self.need = 0
            n, self.low, self.high = self.lead(b)
            if n < 0:
                out.append("�")
            elif n:
                self.need, self.open = n, bytes([b])
            else:
                out.append(chr(b))
        return "".join(out)

    def end(self) -> str:
        """What an unfinished character at the end of the stream gives."""
        need, self.need = self.need, 0
        return "�" if need else ""


class Codec:
    """Texts to ids and back; pre-tokens' ids are remembered."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.fst = Transducer(load_ranks(path))
        space = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}") \
            .replace(r"\S", r"\P{White_Space}")
        self.any_words = regex.compile(space).findall
        latin = pattern
        for name, chars in ((r"\p{L}", C.LETTERS), (r"\p{N}", C.NUMBERS)):
            latin = latin.replace(f" ?{name}", f" ?[{chars}]").replace(name, chars)
        spaces = re.escape(C.SPACES)
        latin = latin.replace(r"[^\s", f"[^{spaces}").replace(r"\S", f"[^{spaces}]").replace(r"\s", f"[{spaces}]")
        self.latin_words = re.compile(latin).findall
        codec = self

        class Known(dict):  # pre-token -> its ids, decimal, joined by commas, and their bytes, decoded id by id
            old: dict = {}

            def __missing__(self, word: str) -> tuple[str, bytes]:
                if len(self) > REMEMBER:
                    self.old = dict(self)
                    self.clear()
                row = self.old.get(word)
                if row is None:
                    ids = codec.fst.encode(word.encode("utf-8"))
                    row = ",".join(map(str, ids)), codec.decode_bytes(ids)
                if len(word) <= 64:
                    self[word] = row
                return row

        self.known = Known()

    def pieces(self, text: str) -> list[str]:
        return self.latin_words(text) if C.BEYOND_LATIN1.search(text) is None else self.any_words(text)

    def encode(self, text: str) -> list[int]:
        return [i for p in self.pieces(text) for i in self.fst.encode(p.encode("utf-8"))]

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.fst.bytes_of.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        """Text of a stream of ids, token by token."""
        stream = Utf8Stream()
        return "".join([stream.feed(self.fst.bytes_of[i]) for i in ids]) + stream.end()

    def digest(self, text: str) -> tuple[int, str, str]:
        """Ids, the digest of the ids, and the digest of the decoded characters' bytes."""
        if not text:
            nothing = hashlib.sha256(b"").hexdigest()
            return 0, nothing, nothing
        stream, decoded, hashed, n = Utf8Stream(), hashlib.sha256(), hashlib.sha256(), 0
        pieces = self.pieces(text)
        for at in range(0, len(pieces), CHUNK):
            part = pieces[at : at + CHUNK]
            rows, runs = zip(*map(self.known.__getitem__, part))
            ids = ",".join(rows)
            hashed.update(("," * bool(at) + ids).encode("ascii"))
            n += ids.count(",") + 1
            decoded.update(stream.feed(b"".join(runs)).encode("utf-8"))
        decoded.update(stream.end().encode("utf-8"))
        return n, hashed.hexdigest(), decoded.hexdigest()


@functools.lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> Codec:
    """One codec a worker: its next task goes on with the words and transitions met before."""
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the decoded bytes. One
    scan, no shuffle."""

    def make():
        codec = _codec(path, pattern)

        def run(cols: dict) -> dict:
            rows = [codec.digest(t) for t in cols["text"]]
            n, ids, decoded = zip(*rows) if rows else ((), (), ())
            return {"doc_id": cols["doc_id"], "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}
        return run

    return C.map_rows(C.texts(docs), SCHEMA, make)
