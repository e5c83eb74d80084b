"""Cost-balanced packing of documents into training sequences.

Each task tokenises its documents and packs groups of about ``GROUP_TOKENS`` ids (fewer where these are
more than ``GROUP_DOCS`` documents, so many short ones do not make a large group). The cost of a
sequence is estimated as ``LINEAR * tokens + QUADRATIC * sum(piece length ** 2)``: attention
runs inside a document's piece. Whole sequences are cut from long documents first; then the
other documents, longest first, go to the lowest-cost sequence with room for them; what fits
nowhere whole is cut into the room left, lowest cost first. The ids over at the end of a group
go into sequences of power-of-two lengths, which need no padding. So all sequences are full or
a power of two, whatever the documents' lengths.

No shuffle: a group lies in one task and its size is bounded, and a lost task is packed again
from the same rows in the same order. Sequence ids are the task's number and a count in it.

Cases: a null or empty text is one id, the end id; documents of any length are cut, none is
shortened; repeated rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import common as C
from .token_count import byte_letters, library

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens int")
FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
          "sequence_tokens"]
TYPES = [pa.int64()] * 7 + [pa.int32()]
GROUP_TOKENS, GROUP_DOCS = 4_000_000, 50_000
#: Cost of a token outside attention, and of a token pair in it, relative to it.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
REMEMBER = 500_000


class Encoder:
    """Ids (little-endian unsigned 32-bit, as bytes) of a text by a byte-level BPE JSON. The
    pre-tokens' ids come from the library's model and are remembered."""

    def __init__(self, path: str):
        tok, letters = library(path), byte_letters()
        self.pre, self.model = tok.pre_tokenizer, tok.model
        added = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
        self.special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.added = {s: np.uint32(i).astype("<u4").tobytes() for s, i in added.items()}
        L, N, S = C.LETTERS, C.NUMBERS, re.escape(C.SPACES)
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+"
                                f"|[{S}]+(?![^{S}])|[{S}]+").findall
        model = self.model

        class Known(dict):
            def __missing__(self, word: str) -> bytes:
                if len(self) > REMEMBER:
                    self.clear()
                piece = "".join(map(letters.__getitem__, word.encode("utf-8")))
                ids = np.array([t.id for t in model.tokenize(piece)], "<u4").tobytes()
                if len(word) <= 64:
                    self[word] = ids
                return ids

        self.known = Known()
        self.back = {c: bytes([b]) for b, c in enumerate(letters)}

    def part(self, text: str) -> bytes:
        if C.BEYOND_LATIN1.search(text) is None:
            return b"".join(map(self.known.__getitem__, self.words(text)))
        return b"".join(np.array([t.id for t in self.model.tokenize(p)], "<u4").tobytes()
                        for p, _ in self.pre.pre_tokenize_str(text))

    def encode(self, text: str) -> bytes:
        if self.special is None or "<" not in text:
            return self.part(text)
        return b"".join(self.added.get(p) or self.part(p) for p in self.special.split(text) if p)


def powers(n: int, size: int) -> list[int]:
    """``n`` as powers of two below ``size``, largest first."""
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1] if n < size else [size, *powers(n - size, size)]


def pack(lengths: list[int], size: int = 2048, linear: float = LINEAR,
         quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of the pieces of documents of the given
    lengths; every id lies in one piece, sequences are gapless, and each is ``size`` long or a
    power of two."""
    out: list[tuple[int, int, int, int, int]] = []
    n_seq = 0
    rest: list[tuple[int, int, int]] = []  # (length, document, start)
    for d, n in enumerate(lengths):
        for at in range(0, n - n % size, size):
            out.append((d, at, size, n_seq, 0))
            n_seq += 1
        if n % size:
            rest.append((n % size, d, n - n % size))
    rest.sort(key=lambda x: (-x[0], x[1]))
    total = sum(n for n, _, _ in rest)
    k = total // size
    room = np.full(k, size, np.int64)
    cost = np.zeros(k)

    def place(s: int, n: int, d: int, start: int) -> None:
        out.append((d, start, n, n_seq + s, int(size - room[s])))
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n

    over: list[tuple[int, int, int]] = []
    for n, d, start in rest:
        fits = np.where(room >= n, cost, np.inf) if k else cost
        s = int(fits.argmin()) if k else 0
        if k and room[s] >= n:
            place(s, n, d, start)
        else:
            over.append((n, d, start))
    tail = powers(total - k * size, size)
    gaps = [(int(s), int(room[s])) for s in np.argsort(cost, kind="stable") if room[s]]
    gaps += [(k + i, n) for i, n in enumerate(tail)]
    room = np.concatenate([room, np.array(tail, np.int64)])
    cost = np.concatenate([cost, np.zeros(len(tail))])
    full = dict(gaps)
    at = 0
    for n, d, start in over:
        while n:
            s, free = gaps[at]
            take = min(n, free)
            begin = (size if s < k else full[s]) - int(room[s])
            out.append((d, start, take, n_seq + s, begin))
            room[s] -= take
            n, start = n - take, start + take
            if free == take:
                at += 1
            else:
                gaps[at] = (s, free - take)
    return out


def pack_documents(docs: DataFrame, path: str, end_id: int = 1, size: int = 2048) -> DataFrame:
    """One row per piece: where it lies in its document (``start``, ``length``) and in its
    sequence (``sequence_id``, ``offset``), with the crc32 of its ids."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        base = TaskContext.get().partitionId() << 36
        held: list[tuple[int, bytes]] = []
        n_held = n_seq = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, n_held, n_seq
            pieces = pack([len(b) // 4 for _, b in held], size)
            length = {}
            for _, _, n, s, _ in pieces:
                length[s] = length.get(s, 0) + n
            rows = [(held[d][0], start, n, zlib.crc32(memoryview(held[d][1])[4 * start : 4 * (start + n)]),
                     len(held[d][1]) // 4, base + n_seq + s, off, length[s])
                    for d, start, n, s, off in pieces]
            n_seq += len(length)
            held, n_held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], FIELDS)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    held.append((doc_id, ids := enc.encode(text) + end))
                    n_held += len(ids) // 4
                    if n_held >= GROUP_TOKENS or len(held) >= GROUP_DOCS:
                        yield flush()
        if held:
            yield flush()

    return C.texts(docs).mapInArrow(run, SCHEMA)
