"""Token counts, packing and byte-level BPE against the public libraries."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from stationlens.llm import bpe_fst, packing, token_count

from .conftest import texts_of

SPICE = "abc'stdm 12²½µªßÉé\x85\xa0\x1c\t\nİΣσς漢字кирÅÅ​\U0001f44d\U0001f3fd<|endoftext|>!?_"


def odd_texts(n: int) -> list[str]:
    r = random.Random(3)
    out = ["".join(r.choice(SPICE) for _ in range(r.randint(0, 40))) for _ in range(n)]
    return out + ["", "a<|endoftext|>b <|startoftext|>", "<|endoftext|", "x" * 3000, "é" * 2000, "don't I'LL 'S", "  a  \n\n b "]


def test_whole_words_are_single_tokens():
    path = P.path("word_bpe_49k.json")
    proven = token_count.whole_words(path)
    counter = token_count.WordCounter(path, frozenset())
    assert len(proven) > 30_000
    assert all(counter.merged(w) == 1 for w in random.Random(1).sample(sorted(proven), 500))


def test_word_counts_equal_library():
    path = P.path("word_bpe_49k.json")
    tok, counter = Tokenizer.from_file(path), token_count.WordCounter(path, token_count.whole_words(path))
    for t in odd_texts(600):
        assert counter.count(t) == len(tok.encode(t, add_special_tokens=False).ids), t


def test_token_count_rows(documents, edges, nothing):
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    for df in (documents, edges):
        want = Counter((i, len(t.encode()), n := len(tok.encode(t, add_special_tokens=False).ids), n > 100) for i, t in texts_of(df))
        assert Counter(map(tuple, token_count.token_counts(df, path, limit=100).collect())) == want
    assert token_count.token_counts(nothing, path).collect() == []


def ids_of(text: str, tok) -> bytes:
    return np.array([*tok.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_packing(which, request):
    df, path = request.getfixturevalue(which), P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rows = packing.pack_documents(df, path, size=256).collect()
    want = Counter((i, t) for i, t in texts_of(df))
    ids = {k: ids_of(k[1], tok) for k in want}
    # every id of every row once, with its crc; a repeated row as often as it occurs
    pieces = Counter()
    for (i, _), raw in ids.items():
        assert any(r.doc_id == i and r.doc_tokens == len(raw) // 4 for r in rows)
    for r in rows:
        match = [k for k, raw in ids.items() if k[0] == r.doc_id and len(raw) // 4 == r.doc_tokens
                 and zlib.crc32(raw[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32]
        assert match
        pieces[match[0]] += r.length
    assert pieces == Counter({k: n * len(ids[k]) // 4 for k, n in want.items()})
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length, r.sequence_tokens))
    for seq in used.values():
        at = 0
        for off, n, total in sorted(seq):
            assert off == at and n > 0
            at += n
        assert at == total and (at == 256 or at < 256 and at & (at - 1) == 0)


def test_packing_nothing(nothing):
    assert packing.pack_documents(nothing, P.path("byte_bpe_50k.json")).collect() == []


def test_pack_balances_cost():
    r = random.Random(5)
    lengths = [r.choice([40, 300, 700, 1500]) for _ in range(2000)]
    out = packing.pack(lengths)
    cost, total = defaultdict(float), defaultdict(int)
    for _, _, n, s, _ in out:
        cost[s] += packing.LINEAR * n + packing.QUADRATIC * n * n
        total[s] += n
    full = [cost[s] for s, n in total.items() if n == 2048]
    worst = packing.LINEAR * 2048 + packing.QUADRATIC * 2048**2  # one long document
    assert max(full) < 0.9 * worst and np.std(full) < 0.2 * np.mean(full)
    assert sum(total.values()) == sum(lengths)
    assert packing.pack([]) == [] and packing.pack([0, 0]) == []


def test_transducer_equals_library():
    path = P.path("byte_bpe_multi_50k.tiktoken")
    codec = bpe_fst.Codec(path, P.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_fst.load_ranks(path), special_tokens={})
    for t in odd_texts(600):
        ids = codec.encode(t)
        assert ids == enc.encode_ordinary(t), t
        assert codec.decode(ids) == t
    r = random.Random(8)
    for _ in range(300):  # any bytes, also faulty ones, as one pre-token
        raw = bytes(r.choice([32, 97, 98, 101, 116, 195, 169, 240, 159, 145, 141, r.randrange(256)]) for _ in range(r.randint(1, 30)))
        ids = codec.fst.encode(raw)
        assert ids == enc._core_bpe.encode_single_piece(raw) and codec.decode_bytes(ids) == raw


def test_transducer_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(bpe_fst, "TRANSITIONS", 50)
    monkeypatch.setattr(bpe_fst, "REMEMBER", 20)
    path = P.path("byte_bpe_multi_50k.tiktoken")
    codec = bpe_fst.Codec(path, P.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_fst.load_ranks(path), special_tokens={})
    for t in odd_texts(80):
        assert codec.digest(t)[0] == len(enc.encode_ordinary(t))


def test_stream_decoding_cut_anywhere():
    r = random.Random(4)
    for _ in range(400):
        raw = bytes(r.choice([65, 0xC3, 0xA9, 0xE6, 0xBC, 0xA2, 0xF0, 0x9F, 0x91, 0x8D, 0xED, 0xA0, 0x80, r.randrange(256)])
                    for _ in range(r.randint(0, 25)))
        stream, out, at = bpe_fst.Utf8Stream(), "", 0
        while at < len(raw):
            n = r.randint(1, 6)
            out += stream.feed(raw[at : at + n])
            at += n
        assert out + stream.end() == raw.decode("utf-8", "replace")


def test_encoded_documents(documents, edges, nothing):
    import hashlib

    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_fst.load_ranks(path), special_tokens={})

    def row(i, t):
        ids = enc.encode_ordinary(t)
        return (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())

    for df in (documents, edges):
        got = Counter(map(tuple, bpe_fst.encode_documents(df, path, P.PATTERN).collect()))
        assert got == Counter(row(i, t) for i, t in texts_of(df))
    assert bpe_fst.encode_documents(nothing, path, P.PATTERN).collect() == []


def test_pairs_meet_as_their_bytes_merge():
    """Whether two tokens may stand side by side, found by undoing their merges, is what merging their
    bytes anew says, also for tokens that their own bytes do not give; no pair merges anything anew."""
    import itertools

    from stationlens.llm import bpe_fst as B
    texts = [b"a", b"b", b"c", b"ab", b"bc", b"ca", b"abc", b"cab", b"bcab", b"aa", b"aaaa", b"abca", b"cc"]
    ranks = {t: i for i, t in enumerate(texts)}
    fst = B.Transducer(ranks)
    whole = [t for t in texts if len(B.merge(t, ranks)) == 1]
    calls = []
    for a, b in itertools.product(whole, whole):
        assert fst.may_follow(ranks[a], ranks[b]) == (B.merge(a + b, ranks) == [a, b]), (a, b)
    plain = B.merge
    B.merge = lambda *args: calls.append(args) or plain(*args)
    try:
        fst.follows.clear()
        for a, b in itertools.product(whole, whole):
            fst.may_follow(ranks[a], ranks[b])
    finally:
        B.merge = plain
    assert not calls and fst.split
    for n in range(1, 7):
        for piece in map(bytes, itertools.product(b"abc", repeat=n)):
            assert [fst.bytes_of[i] for i in fst.encode(piece)] == ([piece] if piece in ranks else plain(piece, ranks))


def test_codec_is_kept_between_tasks():
    """A worker's next task goes on with the pre-tokens and transitions met before, and makes none anew."""
    path = P.path("byte_bpe_multi_50k.tiktoken")
    made = []
    codec = bpe_fst._codec(path, P.PATTERN)
    before = [codec.digest(t) for t in odd_texts(40)]
    fst = bpe_fst._codec(path, P.PATTERN).fst
    plain = fst.move
    fst.move = lambda *args: made.append(args) or plain(*args)
    try:
        assert [bpe_fst._codec(path, P.PATTERN).digest(t) for t in odd_texts(40)] == before and not made
    finally:
        del fst.move
    assert all(type(to) is int for to in fst.moves.values())
