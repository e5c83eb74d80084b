"""Alignment of the tokens of two tokenizers over the same bytes, by interval coalescing.

Both tokenizers cut a document's bytes into tokens. All tokens of A and B are lexsorted by start;
with the running maximum of the ends (``maximum.accumulate``) a group breaks where a start reaches
it, so a group is a least stretch of bytes that tokens of both cover exactly. Every A token of a
group is linked to every B token of it. A pair of ids counts the documents that hold it linked.

Counts reach the documents in blocks, never row by row:

* each task aligns its documents and gathers them into blocks of about ``BLOCK_PAIRS`` entries (an
  entry: a document holds a pair, with the number of its links); blocks are written once, as a
  table in the shared folder, with their entries as compressed numbers into the block's own pairs;
* a block asks for each of its pairs once, with the number of its documents that hold it, so a pair
  that every document holds arrives once a block, not once a document; sums over the blocks are the
  corpus-wide counts, and the highest count of an A id comes from the sums (a table no longer than
  A's vocabulary, which bounds its broadcast);
* the answers go back to their blocks, where the documents' figures are added up.

Only one group's links are ever expanded in full, and in a group of more than ``WIDE`` links equal
ids are merged first, so a long text of one letter stays small.

Cases: texts that are null, empty, or whose joined A or B bytes differ from space + text have no
tokens: zeros and an empty digest; rows with a null id keep their row and count as documents;
repeated rows are documents of their own; ties for the highest count all are best; special strings
inside texts are plain text; texts are read whole; an empty table gives no rows; extra columns have
no influence.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stationlens.session import checkpoint_dir

from . import common as C
from .token_count import byte_letters

BLOCK_PAIRS = 2_000_000
#: Characters aligned at a time.
SLICE_CHARS = 1 << 20
WIDE = 4096
#: Chunks remembered in a worker before a new generation starts; two are kept (bounds memory, not work).
REMEMBER = 300_000
LONG = 50_000
_RUN = re.compile(r"\s{%d}" % (LONG // 2))
_CUT = re.compile(r"(?<=[^ ])(?= )")
SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")
#: A block: its documents' figures; its distinct pairs, in order, and how many documents hold each;
#: the entries as gaps between pair numbers, document after document, and the links of each entry.
BLOCKS = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
          "n_links array<long>, groups_sha256 array<string>, n_entries array<int>, "
          "pairs binary, holders binary, entries binary, links binary")
_written = itertools.count()


def coalesce(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, int]:
    """(group of each interval, number of groups). Intervals overlap only inside a group."""
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    first = np.r_[True, start[order][1:] >= reach[:-1]] if len(order) else np.zeros(0, bool)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(first) - 1
    return group, int(first.sum())


def _spread(n: np.ndarray) -> np.ndarray:
    """0 .. n[0] - 1, 0 .. n[1] - 1, and so on."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def link(ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, doc: np.ndarray,
         width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, links) of every pair that a document holds linked, by document, then pair,
    where a pair is ``a * width + b``. Group g has the next ``n_a[g]`` and ``n_b[g]`` ids and lies
    in document ``doc[g]``."""
    at_a, at_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    wide = n_a * n_b > WIDE
    partners = np.where(wide, 0, n_b)
    group = np.repeat(np.arange(len(n_a)), n_a)
    times = partners[group]
    a = np.repeat(ids_a, times)
    b = ids_b[np.repeat(at_b[group], times) + _spread(times)]
    keys, weights = [np.repeat(doc[group], times) << 32 | (a * width + b)], []
    for g in np.flatnonzero(wide).tolist():
        a, times_a = np.unique(ids_a[at_a[g] : at_a[g] + n_a[g]], return_counts=True)
        b, times_b = np.unique(ids_b[at_b[g] : at_b[g] + n_b[g]], return_counts=True)
        keys.append((doc[g] << 32 | (a[:, None] * width + b)).ravel())
        weights.append((times_a[:, None] * times_b).ravel())
    if weights:
        key = np.concatenate(keys)
        weight = np.concatenate([np.ones(len(keys[0]), np.int64), *weights])
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
    else:
        key = np.sort(keys[0])
        weight = np.ones(len(key), np.int64)
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    key, weight = key[at], np.add.reduceat(weight, at) if len(at) else weight
    return key >> 32, key & 0xFFFFFFFF, weight


@dataclass
class Aligned:
    """Some documents' alignments: figures of each document, and the pairs each holds."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digest: list[str]
    entry_doc: np.ndarray
    entry_pair: np.ndarray
    entry_links: np.ndarray


class Aligner:
    """Aligns texts by a byte-level BPE JSON (A) and a sentencepiece model (B).

    A: if the vocabulary's ids rise with its merges (checked), ids are ranks, and the rank encoder
    gives the library's ids faster; else the library encodes. B cuts before a space that follows another
    character (checked on its vocabulary), so texts are encoded in such chunks, mostly a word each, and
    chunks are remembered."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.encode_a, self.bytes_a = _byte_level(path_a)
        self.model_b = _model(path_b)
        n_b = self.model_b.get_piece_size()
        pieces = [self.model_b.id_to_piece(i) for i in range(n_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.model_b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.in_chunks = not any(re.search("[^▁]▁", p) for p in pieces)
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.width = n_b
        if len(self.bytes_a) * n_b >= 1 << 32:
            raise ValueError("pairs of these vocabularies do not fit in 32 bits")
        self.written, self.written_size = _decimals(max(len(self.bytes_a), n_b))
        self.known: dict[str, bytes] = {}  # chunk without its first space -> B ids, little-endian 32-bit
        self.old: dict[str, bytes] = {}  # those of the generation before

    def _encode_b(self, text: str) -> bytes:
        """B ids of a text (B adds a space before it), nothing where the joined bytes are not space + text."""
        ids = self.model_b.encode(text, num_threads=1)
        same = b"".join(map(self.bytes_b.__getitem__, ids)) == b" " + text.encode("utf-8")
        return array("I", ids).tobytes() if same else b""

    def _encode_chunks(self, chunks: list[str]) -> Iterator[bytes]:
        """Each chunk's B ids. Many chunks are encoded as one text; where tokens end at all of the chunks'
        ends, no merge ever crossed one, so these are the chunks' own tokens."""
        for at in range(0, len(chunks), 4096):
            part = chunks[at : at + 4096]
            raw = self._encode_b(" ".join(part))
            upto = np.cumsum(self.size_b[np.frombuffer(raw, "<u4")])
            ends = np.cumsum([1 + len(c.encode("utf-8")) for c in part])
            k = np.searchsorted(upto, ends)
            if raw and (upto[k] == ends).all():
                cuts = [0, *(4 * (k + 1)).tolist()]
                yield from (raw[x:y] for x, y in zip(cuts, cuts[1:]))
            else:
                yield from map(self._encode_b, part)

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) of each text; none where the joined bytes are not space + text."""
        none = np.zeros(0, np.int64)
        chunks = [t.split(" ") if self.in_chunks and t and "  " not in t and t[0] != " " and t[-1] != " " else
                  [c[1:] for c in _CUT.split(" " + t)] if self.in_chunks and t else [] for t in texts]
        if len(self.known) > REMEMBER:
            self.old, self.known = self.known, {}
        new = set().union(*chunks) - self.known.keys()
        again = new & self.old.keys()
        self.known.update((c, self.old[c]) for c in again)
        new = list(new - again)
        self.known.update(zip(new, self._encode_chunks(new)))
        out = []
        for t, cs in zip(texts, chunks):
            n = 1 + len(t.encode("utf-8"))
            b = np.frombuffer(b"".join(map(self.known.__getitem__, cs)), "<u4")
            if t and self.size_b[b].sum() != n:  # some chunk's bytes are not its text's, or no chunks
                b = np.frombuffer(self._encode_b(t), "<u4")
            a = self.encode_a(" " + t) if len(b) else none
            if not len(b) or self.size_a[a].sum() != n:
                a = b = none
            out.append((a.astype(np.int64), b.astype(np.int64)))
        return out

    def align(self, texts: list[str]) -> Aligned:
        pairs = self.tokens(texts)
        docs = np.arange(len(texts))
        n_a, n_b = (np.array([len(p[k]) for p in pairs], np.int64) for k in (0, 1))
        a, b = (np.concatenate([p[k] for p in pairs] or [np.zeros(0, np.int64)]) for k in (0, 1))
        # one byte axis for all documents: both tokenizers end where a document ends
        end = np.concatenate([np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])])
        start = end - np.concatenate([self.size_a[a], self.size_b[b]])
        group, n = coalesce(start, end, np.repeat([0, 1], [len(a), len(b)]))
        group_a, group_b = group[: len(a)], group[len(a) :]
        in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        doc = np.empty(n, np.int64)
        doc[group_a] = np.repeat(docs, n_a)
        entry_doc, pair, links = link(a, b, in_a, in_b, doc, self.width)
        return Aligned(n_a, n_b, np.bincount(doc, minlength=len(texts)),
                       np.bincount(doc, in_a * in_b, minlength=len(texts)).astype(np.int64),
                       self.digests(a, b, group_a, group_b, in_a, in_b, doc, len(texts)), entry_doc, pair, links)

    def digests(self, a, b, group_a, group_b, in_a, in_b, doc, n_docs: int) -> list[str]:
        """Of each document the digest of its groups, written ``a1,a2|b1;a3|b2,b3``."""
        upto_a, upto_b = np.cumsum(in_a), np.cumsum(in_b)
        here_a, here_b = np.arange(len(a)), np.arange(len(b))
        # separators: 0 "," inside a list, 1 "|" after A's list, 2 ";" after a group, 3 none after the last
        ends_doc = np.r_[doc[1:] != doc[:-1], True] if len(doc) else np.zeros(0, bool)
        code = np.empty(len(a) + len(b), np.int64)
        code[here_a + (upto_b - in_b)[group_a]] = 4 * a + (here_a + 1 == upto_a[group_a])
        after = np.where(ends_doc, 3, 2)
        code[here_b + upto_a[group_b]] = 4 * b + np.where(here_b + 1 == upto_b[group_b], after[group_b], 0)
        size = self.written_size[code]
        flat = self.written[code][np.arange(self.written.shape[1]) < size[:, None]].tobytes()
        tokens = np.bincount(doc, in_a + in_b, minlength=n_docs).astype(np.int64)
        upto = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(tokens)]].tolist()
        return [hashlib.sha256(flat[x:y]).hexdigest() if y > x else "" for x, y in zip(upto, upto[1:])]


@functools.lru_cache(maxsize=2)
def _aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner a worker: its next task goes on with the chunks met before."""
    return Aligner(path_a, path_b)


@functools.lru_cache(maxsize=4)
def _byte_level(path: str) -> tuple[Callable[[str], np.ndarray], list[bytes]]:
    """(ids of a text, special strings being plain text; the bytes of each id) of a byte-level BPE JSON."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    back = {c: b for b, c in enumerate(byte_letters())}
    of_id = [bytes(back.get(c, 0) for c in tok.id_to_token(i) or "") for i in range(tok.get_vocab_size())]
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    plain = spec.get("normalizer") is None and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" \
        and not spec["pre_tokenizer"].get("add_prefix_space") and spec["pre_tokenizer"].get("use_regex", True)
    if plain and len(vocab) - len(merged) >= 256 and all(x < y for x, y in zip(merged, merged[1:])):
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {of_id[i]: i for t, i in vocab.items() if t not in special}
        enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        # long runs of white space are more than the rank encoder's pattern can hold
        return lambda text: np.array(enc.encode_ordinary(text) if len(text) < LONG or not _RUN.search(text) else
                                     tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64), of_id
    return lambda text: np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64), of_id


@functools.lru_cache(maxsize=4)
def _model(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row 4 * i + s holds the decimal number i and separator s of ",|;" (3: none), and its size."""
    rows = [(str(i) + sep).encode() for i in range(n) for sep in (",", "|", ";", "")]
    size = np.array(list(map(len, rows)), np.int64)
    return np.frombuffer(b"".join(r.ljust(size.max(), b"\0") for r in rows), np.uint8).reshape(len(rows), -1), size


def pack_numbers(x: np.ndarray) -> bytes:
    """Numbers below 2^32, byte plane after byte plane, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack_numbers(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _block(number: int, held: list[tuple[list, Aligned]]) -> dict:
    """A block's row."""
    doc_ids = [i for ids, _ in held for i in ids]
    base = np.cumsum([0, *(len(ids) for ids, _ in held)])
    entry_doc = np.concatenate([x.entry_doc + n for (_, x), n in zip(held, base.tolist())])
    pairs, entry = np.unique(np.concatenate([x.entry_pair for _, x in held]), return_inverse=True)
    n_entries = np.bincount(entry_doc, minlength=len(doc_ids))
    gaps = np.diff(entry, prepend=0)
    first = np.flatnonzero(np.r_[True, entry_doc[1:] != entry_doc[:-1]]) if len(entry) else []
    gaps[first] = entry[first]  # pair numbers rise inside a document
    column = lambda f: np.concatenate([getattr(x, f) for _, x in held])
    return {"block": number, "doc_id": doc_ids, "n_a": column("n_a"), "n_b": column("n_b"),
            "n_groups": column("n_groups"), "n_links": column("n_links"),
            "groups_sha256": [d for _, x in held for d in x.digest], "n_entries": n_entries.astype(np.int32),
            "pairs": pack_numbers(np.diff(pairs, prepend=0)), "holders": pack_numbers(np.bincount(entry, minlength=len(pairs))),
            "entries": pack_numbers(gaps), "links": pack_numbers(column("entry_links"))}


def align_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The documents' alignments in blocks, written to the shared folder."""
    schema = T._parse_datatype_string(BLOCKS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        ids: list = []
        texts: list[str] = []
        held: list[tuple[list, Aligned]] = []
        n_chars = n_pairs = n_docs = 0

        def block() -> pa.RecordBatch:
            row = _block(next(numbers), held)
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], type=f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids.append(doc_id)
                    texts.append(text)
                    n_chars += len(text) + 16
                    if n_chars >= SLICE_CHARS:
                        held.append((ids, aligner.align(texts)))
                        n_pairs += len(held[-1][1].entry_doc) + len(ids)
                        ids, texts, n_chars = [], [], 0
                        if n_pairs >= BLOCK_PAIRS:
                            yield block()
                            held, n_pairs = [], 0
        if ids:
            held.append((ids, aligner.align(texts)))
        if held:
            yield block()

    spark = docs.sparkSession
    at = f"{checkpoint_dir(spark)}/alignment-{spark.sparkContext.applicationId}-{next(_written)}"
    C.texts(docs).mapInArrow(run, schema).write.mode("overwrite").parquet(at)
    return spark.read.schema(schema).parquet(at)


def asked_pairs(blocks: DataFrame) -> DataFrame:
    """(pair, block, n): each block's distinct pairs and how many of its documents hold each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pair, n = np.cumsum(unpack_numbers(row["pairs"])), unpack_numbers(row["holders"])
                for at in range(0, len(pair), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    block = np.full(len(pair[part]), row["block"], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (pair[part], block, n[part])], ["pair", "block", "n"])

    return blocks.select("block", "pairs", "holders").mapInArrow(run, "pair long, block long, n long")


def pair_counts(blocks: DataFrame, path_b: str) -> DataFrame:
    """(a, b, n_docs, best): corpus-wide, how many documents hold the ids linked, and whether no
    other B id is linked to ``a`` in more documents."""
    width = _model(path_b).get_piece_size()
    counted = asked_pairs(blocks).groupBy("pair").agg(F.sum("n").alias("n_docs"))
    counted = counted.select(F.expr(f"pair div {width}").alias("a"), (F.col("pair") % width).alias("b"), "n_docs")
    return _with_best(counted, counted, "n_docs")


def _with_best(rows: DataFrame, counted: DataFrame, n: str) -> DataFrame:
    """Rows with ``best``: has the A id no higher count? The table of highest counts has at most
    one row for each id of A's vocabulary, which bounds the broadcast."""
    top = counted.groupBy("a").agg(F.max(n).alias("top"))
    return rows.join(F.broadcast(top), "a").withColumn("best", F.col(n) == F.col("top")).drop("top")


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: tokens of both, groups, links, how many links join an A id with a B id
    of its highest corpus-wide count, the sum of the links' counts, and the groups' digest."""
    blocks = align_blocks(docs, path_a, path_b)
    width = _model(path_b).get_piece_size()
    asked = (asked_pairs(blocks)
             .withColumn("n", F.sum("n").over(Window.partitionBy("pair")))  # a row per block that holds it
             .withColumn("a", F.expr(f"pair div {width}")))
    answers = _with_best(asked, asked, "n").select("block", "pair", "n", "best")
    schema = T._parse_datatype_string(SCHEMA)
    arrow = to_arrow_schema(schema)

    def add_up(block: pa.Table, answer: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        order = np.argsort(answer.column("pair").to_numpy(), kind="stable")
        count, best = answer.column("n").to_numpy()[order], answer.column("best").to_numpy()[order]
        n_entries = np.array(row["n_entries"], np.int64)
        doc = np.repeat(np.arange(len(n_entries)), n_entries)
        gaps, links = unpack_numbers(row["entries"]), unpack_numbers(row["links"])
        total = np.cumsum(gaps)
        before = np.r_[0, total][np.cumsum(n_entries) - n_entries]  # gaps add up inside a document
        entry = total - before[doc]
        out = row | {"n_best": np.zeros(len(n_entries), np.int64), "count_sum": np.zeros(len(n_entries), np.int64)}
        if len(entry):
            np.add.at(out["n_best"], doc, links * best[entry])
            np.add.at(out["count_sum"], doc, links * count[entry])
        return pa.Table.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    rows = blocks.drop("pairs", "holders")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add_up, schema)
