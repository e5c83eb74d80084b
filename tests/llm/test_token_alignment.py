"""Token alignment against a plain walk over both token lists."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from stationlens.llm import token_alignment as A

from .conftest import texts_of

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(PATHS[0])
    tok.encode_special_tokens = True
    sp = SentencePieceProcessor(model_file=PATHS[1])
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    back = {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(rest)}

    def tokens(text: str):
        if not text:
            return [], []
        a = [(i, bytes(back[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode())
             for i in sp.encode(text) for p in [sp.id_to_piece(i)]]
        whole = b" " + text.encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    def groups(text: str) -> list[tuple[list[int], list[int]]]:
        a, b = tokens(text)
        out, i, j = [], 0, 0
        while i < len(a):
            end_a, end_b, ids_a, ids_b = len(a[i][1]), len(b[j][1]), [a[i][0]], [b[j][0]]
            i, j = i + 1, j + 1
            while end_a != end_b:
                if end_a < end_b:
                    end_a, i = end_a + len(a[i][1]), i + 1
                    ids_a.append(a[i - 1][0])
                else:
                    end_b, j = end_b + len(b[j][1]), j + 1
                    ids_b.append(b[j - 1][0])
            out.append((ids_a, ids_b))
        return out

    return groups


def digest(groups) -> str:
    text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
    return hashlib.sha256(text.encode()).hexdigest() if groups else ""


def expected(rows: list[tuple], groups) -> tuple[Counter, dict]:
    aligned = [(i, groups(t)) for i, t in rows]
    held = Counter()
    for _, g in aligned:
        held.update({(a, b) for ids_a, ids_b in g for a in ids_a for b in ids_b})
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    out = Counter()
    for i, g in aligned:
        links = [(a, b) for ids_a, ids_b in g for a in ids_a for b in ids_b]
        out[(i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
             sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), digest(g))] += 1
    return out, held


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_documents_equal_plain_walk(which, request, plain, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_PAIRS", 3000)
    monkeypatch.setattr(A, "SLICE_CHARS", 20_000)
    df = request.getfixturevalue(which)
    got = Counter(map(tuple, A.align_documents(df, *PATHS).collect()))
    want, held = expected(texts_of(df), plain)
    assert got == want
    pairs = A.pair_counts(A.align_blocks(df, *PATHS), PATHS[1]).collect()
    assert {(r.a, r.b): r.n_docs for r in pairs} == held


def test_nothing_and_empty_texts(spark, nothing):
    assert A.align_documents(nothing, *PATHS).collect() == []
    df = spark.createDataFrame([(1, None), (2, ""), (None, None)], "doc_id long, text string")
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in A.align_documents(df, *PATHS).collect())


def test_odd_texts(plain):
    r = random.Random(8)
    spice = "abc 'st  12²é\x85\xa0\t\nİΣ漢字ки​\U0001f44d\U0001f3fd<|endoftext|><s>▁_"
    texts = ["".join(r.choice(spice) for _ in range(r.randint(0, 60))) for _ in range(300)] + ["x" * 5000, "漢" * 3000, " " * 70, " " * 200_000 + "x", "a\n\n" + "\n" * 100_000]
    got = A.Aligner(*PATHS).align(texts)
    for k, t in enumerate(texts):
        g = plain(t)
        assert (got.n_groups[k], got.digest[k]) == (len(g), digest(g)), t
        links = Counter((a * 32000 + b) for ids_a, ids_b in g for a in ids_a for b in ids_b)
        here = got.entry_doc == k
        assert dict(zip(got.entry_pair[here].tolist(), got.entry_links[here].tolist())) == links
        assert got.n_links[k] == sum(links.values())


def test_wide_groups_merge_equal_ids():
    ids_a, ids_b = np.array([5] * 3000 + [7]), np.array([1, 2] * 1000)
    doc, pair, links = A.link(ids_a, ids_b, np.array([3001]), np.array([2000]), np.array([4]), 10)
    assert dict(zip(pair.tolist(), links.tolist())) == {51: 3_000_000, 52: 3_000_000, 71: 1000, 72: 1000}
    assert set(doc.tolist()) == {4}


def test_coalesce():
    group, n = A.coalesce(np.array([0, 2, 5, 0, 3, 5]), np.array([2, 5, 6, 3, 5, 6]), np.array([0, 0, 0, 1, 1, 1]))
    assert n == 2 and group.tolist() == [0, 0, 1, 0, 0, 1]


def test_numbers_round_trip():
    x = np.array([0, 1, 255, 256, 70_000, (1 << 32) - 1])
    assert A.unpack_numbers(A.pack_numbers(x)).tolist() == x.tolist()
    assert A.unpack_numbers(A.pack_numbers(x[:0])).tolist() == []


def test_aligner_is_kept_and_forgets_by_generations(monkeypatch):
    """A worker keeps its aligner; a chunk of the generation before is taken over, not encoded again."""
    monkeypatch.setattr(A, "REMEMBER", 3)
    aligner = A._aligner(*PATHS)
    assert A._aligner(*PATHS) is aligner
    fresh = A.Aligner(*PATHS)
    asked = []
    plain = fresh._encode_chunks
    fresh._encode_chunks = lambda chunks: asked.extend(chunks) or plain(chunks)
    first = fresh.tokens(["the cat sat on the mat", "a dog"])
    assert len(asked) == len(set(asked)) == 7
    again = fresh.tokens(["the cat sat on the mat", "a dog"])
    assert len(asked) == 7
    for x, y in zip(first, again):
        assert all((p == q).all() for p, q in zip(x, y)) and len(x[0])
