"""Bundles of WARC records: round trip, seek table, random access, revisits."""

import gzip
import hashlib
import random
from collections import Counter

import pyarrow.fs
import pytest
import zstandard

from stationlens.llm import warc_bundles as W

SCHEMA = "page_id long, url string, html string, key string, n long, keeper long, bundle string, frame int"


def page_rows() -> list[tuple]:
    r = random.Random(4)
    big = "<p>" + "same words again " * 100
    rows = [(i, f"https://a.example/{i}", f"<html>{r.random()}" + "x" * r.randint(0, 3000)) for i in range(300)]
    rows += [(1000 + i, "https://b.example/", big) for i in range(200)]  # a third of all rows
    rows += [(1199, "https://b.example/again", big)]  # repeats the largest id
    rows += [(2000 + i, None, "short") for i in range(5)] + [(2100 + i, "u", "é" * 500) for i in range(3)]
    rows += [(None, "https://c.example", big), (None, None, None), (3000, "a b\r\nWARC-Type: x", ""), (3001, "", None)]
    rows += [(None, "x", "null ids only " * 100), (None, "x", "null ids only " * 100)]
    rows += [(4000, "https://d.example", "\r\n\r\nWARC/1.1\r\n\r\n" * 200), (-7, "neg", "漢字 " * 300_000)]
    return [(*row, "k", 1, 2, "b", 3) for row in rows]


def expected(rows: list[tuple]) -> Counter:
    keeper: dict[str, int | None] = {}
    for i, _, html, *_ in rows:
        if len((html or "").encode()) >= 1000:
            have = keeper.get(html)
            keeper[html] = i if have is None else have if i is None else max(i, have)
    out = Counter()
    for i, _, html, *_ in rows:
        raw, to = (html or "").encode(), keeper.get(html)
        again = to is not None and to != i
        out[(i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", to if again else None)] += 1
    return out


def test_round_trip(spark):
    rows = page_rows()
    got = W.archive_pages(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert Counter(tuple(r)[:5] for r in got) == expected(rows)
    urls = {r.page_id: r.url for r in got}
    assert urls[3000] == "a%20b%0D%0AWARC-Type:%20x" and urls[2000] is None


def test_empty(spark):
    assert W.archive_pages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_fetch_and_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "BUNDLE_BYTES", 200_000)
    rows = [r for r in page_rows() if r[0] is not None]
    rows += [(5, "u", rows[0][2] + "another page of the same id", "k", 1, 2, "b", 3)]
    folder = f"file://{tmp_path}"
    index = W.write_bundles(spark.createDataFrame(rows, SCHEMA).repartition(2), folder)
    wanted = spark.createDataFrame([(5,), (1003,), (1199,), (3000,), (-7,), (99_999,)], "page_id long")
    got = Counter((r.page_id, bytes(r.payload)) for r in W.fetch(wanted, folder).collect())
    want = Counter((i, (html or "").encode()) for i, _, html, *_ in rows if i in (5, 1003, 1199, 3000, -7))
    assert got == want
    # the bundles' own indexes equal the table
    fs, root = pyarrow.fs.FileSystem.from_uri(f"{folder}/bundles")
    listed = index.collect()
    own = Counter((name, *row) for name in {r.bundle for r in listed} for row in W.BundleFile(fs, f"{root}/{name}").index())
    assert own == Counter((r.bundle, r.record_id, r.frame, r.offset, r.size) for r in listed)
    assert len({r.bundle for r in listed}) > 2


def test_bundles_are_plain_zstandard(spark, tmp_path):
    """Read from front to back by the library, a bundle is one WARC file."""
    rows = page_rows()
    W.write_bundles(spark.createDataFrame(rows, SCHEMA).coalesce(1), f"file://{tmp_path}")
    n = 0
    for path in (tmp_path / "bundles").iterdir():
        data = zstandard.ZstdDecompressor().stream_reader(path.open("rb"), read_across_frames=True).read()
        at = 0
        while at < len(data):
            _, at = W.parse_record(data, at)
            n += 1
    assert n == len(rows)


def test_lost_attempts_are_not_read(spark, tmp_path):
    folder = f"file://{tmp_path}"
    W.write_bundles(spark.createDataFrame(page_rows()[:20], SCHEMA).coalesce(1), folder)
    (tmp_path / "bundles" / "part-00000-99-0000.warc.zst").write_bytes(b"half a bundle")
    assert W.read_bundles(spark, folder).count() == 20


def test_damage_is_an_error(tmp_path):
    b = W.Bundle()
    data = W.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None, False)
    b.add(W.record_id(1), data)
    raw = bytearray(b.finish())
    (tmp_path / "x").write_bytes(raw)
    fs = pyarrow.fs.LocalFileSystem()
    assert W.parse_record(W.BundleFile(fs, str(tmp_path / "x")).content(0))[0].payload == b"payload"
    raw[-15] ^= 1  # the checksum of a frame
    raw[-27] ^= 1
    (tmp_path / "y").write_bytes(raw)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        W.BundleFile(fs, str(tmp_path / "y")).content(0)
    (tmp_path / "z").write_bytes(gzip.compress(b"no bundle at all"))
    with pytest.raises(ValueError):
        W.BundleFile(fs, str(tmp_path / "z"))
