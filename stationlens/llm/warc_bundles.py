"""WARC records in seekable Zstandard bundles.

``write_bundles`` turns pages into WARC 1.1 records and groups them into bundles: files of
independent Zstandard frames of about ``FRAME_BYTES`` each (of their content), then a skippable
frame with the bundle's own record index, then the seek table of the seekable format as a footer (a
skippable frame of each frame's compressed size, content size and checksum). Any Zstandard tool
reads a bundle from front to back as one WARC file; a reader that knows the seek table reads
single frames. A table beside the bundles maps every record identifier to its bundle, its frame
and its offset in that frame.

Of records with equal payloads of ``min_bytes`` or more, the largest page_id is a ``response``, the
others ``revisit`` it: they hold the HTTP header only. Equal payloads are found by SHA-256 and
counted before any shuffle of payloads. Payloads that hold more than a ``HOT_SHARE``-th of all
pages are at most ``HOT_SHARE`` in number, so they are broadcast and their pages are spread over
all tasks; the other repeated payloads meet their pages in a join, where no key is hot.

Lost executors: a task writes its bundles under names of its own attempt, and the index is
committed by Spark's writer; a reader takes only bundles that the index names, so what a lost or
repeated attempt leaves behind is never read. A bundle is held in memory until it has about
``BUNDLE_BYTES``, a record of any size is one frame. The folder is a path or URI that executors
reach through pyarrow.fs (as file: or a cluster store); pages are read by Spark alone.

Cases: a null payload is the empty one; a null url is left out, control characters and blanks in
urls are percent-encoded; rows with a null page_id are records too, never the one that others refer
to; rows that repeat the largest page_id of a payload all are responses; equal payloads of null ids
alone all are responses; an empty table gives an empty index and no bundles; extra columns have no
influence.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.session import checkpoint_dir

from . import common as C

FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 32 << 20
HOT_SHARE, MAX_TASKS = 2000, 100_000
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the Zstandard and seekable formats.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC, WITH_CHECKSUMS = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("page_id long, record_id string, record_type string, refers_to long, "
         "payload_digest string, bundle string, frame int, offset long, size long")
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
_runs = itertools.count()


# --- records ---------------------------------------------------------------

def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    number = identifier.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record. ``sha1``: the payload's, in hex; a revisit holds no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    fields: dict[str, str]
    payload: bytes
    payload_bytes: int  # also of a revisit, whose payload is elsewhere

    def sha1(self) -> str:
        return base64.b32decode(self.fields["warc-payload-digest"].removeprefix("sha1:")).hex()


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}


def parse_record(data: bytes, at: int = 0) -> tuple[Record, int]:
    """(record at ``at``, where the next one begins)."""
    if not data.startswith(b"WARC/1.1\r\n", at):
        raise ValueError(f"no WARC record at {at}")
    body = data.index(b"\r\n\r\n", at) + 4
    fields = _fields(data[at : body - 4])
    end = body + int(fields["content-length"])
    payload = data.index(b"\r\n\r\n", body) + 4
    size = int(_fields(data[body : payload - 4])["content-length"])
    return Record(fields, data[payload:end], size), end + 4


# --- bundles ---------------------------------------------------------------

class Bundle:
    """Frames of records, to be written as one file."""

    def __init__(self):
        self.frames: list[bytes] = []
        self.entries: list[tuple[int, int, int]] = []  # compressed size, content size, checksum
        self.open: list[bytes] = []
        self.n_open = self.size = 0
        self.index: list[tuple[str, int, int, int]] = []  # record id, frame, offset, size
        self.zstd = zstandard.ZstdCompressor(level=3, write_content_size=True)

    def add(self, identifier: str, data: bytes) -> tuple[int, int]:
        """(frame, offset in it) of the record."""
        if self.open and self.n_open + len(data) > FRAME_BYTES:
            self.flush()
        at = len(self.frames), self.n_open
        self.index.append((identifier, *at, len(data)))
        self.open.append(data)
        self.n_open += len(data)
        return at

    def flush(self) -> None:
        content = b"".join(self.open)
        frame = self.zstd.compress(content)
        self.frames.append(frame)
        self.entries.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.size += len(frame)
        self.open, self.n_open = [], 0

    def finish(self) -> bytes:
        if self.open:
            self.flush()
        rows = "".join(f"{i}\t{f}\t{o}\t{n}\n" for i, f, o, n in self.index)
        index = zstandard.ZstdCompressor(level=3).compress(rows.encode())
        entries = [*self.entries, (len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        table = b"".join(struct.pack("<III", *e) for e in entries) + struct.pack("<IBI", len(entries), WITH_CHECKSUMS, SEEK_MAGIC)
        return b"".join([*self.frames, struct.pack("<II", SKIPPABLE_INDEX, len(index)), index,
                         struct.pack("<II", SKIPPABLE_SEEK, len(table)), table])


class BundleFile:
    """Reads frames of a bundle by its seek table."""

    def __init__(self, fs: pa.fs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEK_MAGIC:
            raise ValueError(f"{path} has no seek table")
        width = 12 if flags & WITH_CHECKSUMS else 8
        raw = self._read(size - 9 - n * width, n * width)
        self.entries = [struct.unpack_from("<II", raw, k * width) for k in range(n)]
        self.checks = [struct.unpack_from("<I", raw, k * width + 8)[0] for k in range(n)] if width == 12 else None
        self.starts = [0, *itertools.accumulate(c for c, _ in self.entries)]

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def frames(self) -> list[int]:
        """The frames that hold records."""
        return [k for k, (_, size) in enumerate(self.entries) if size]

    def content(self, k: int) -> bytes:
        data = zstandard.ZstdDecompressor().decompress(self._read(self.starts[k], self.entries[k][0]), self.entries[k][1])
        if len(data) != self.entries[k][1] or self.checks and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checks[k]:
            raise ValueError(f"frame {k} is damaged")
        return data

    def index(self) -> list[tuple[str, int, int, int]]:
        """(record id, frame, offset, size), as the bundle itself has them."""
        k = len(self.entries) - 1
        raw = self._read(self.starts[k] + 8, self.entries[k][0] - 8)
        rows = (line.split("\t") for line in zstandard.ZstdDecompressor().decompress(raw).decode().splitlines())
        return [(i, int(f), int(o), int(n)) for i, f, o, n in rows]

    def close(self) -> None:
        self.file.close()


# --- jobs ------------------------------------------------------------------

def classified(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """(page_id, url, payload, sha1, revisit, refers_to) of every page."""
    spark = pages.sparkSession
    C.ship(spark)
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         payload.alias("payload"))
            .withColumn("key", F.when(F.length("payload") >= min_bytes, F.sha2("payload", 256))))
    repeated = (rows.where(F.col("key").isNotNull()).groupBy("key")
                .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1"))
    checkpoint_dir(spark)
    repeated = repeated.checkpoint()
    bound = -(-pages.count() // HOT_SHARE)  # at most HOT_SHARE payloads lie on more pages than this
    hot = repeated.where(F.col("n") > bound).select(F.col("key").alias("hot_key"), F.col("keeper").alias("hot_keeper"))
    rest = repeated.where(F.col("n") <= bound).select(F.col("key").alias("rest_key"), F.col("keeper").alias("rest_keeper"))
    alone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))  # matches nothing, lies anywhere
    found = (rows.join(F.broadcast(hot), F.col("key") == F.col("hot_key"), "left")
             .withColumn("rest", F.when(F.col("key").isNotNull() & F.col("hot_key").isNull(), F.col("key")).otherwise(alone))
             .join(rest, F.col("rest") == F.col("rest_key"), "left")
             .withColumn("keeper", F.coalesce("hot_keeper", "rest_keeper")))
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return found.select("page_id", "url", "payload", F.sha1("payload").alias("sha1"), revisit.alias("revisit"),
                        F.when(revisit, F.col("keeper")).alias("refers_to"))


def write_bundles(pages: DataFrame, folder: str, min_bytes: int = 1000) -> DataFrame:
    """Writes the pages' records below ``folder`` (``bundles`` and ``index``); the index."""
    spark = pages.sparkSession
    names = [f.split()[0] for f in INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(f"{folder}/bundles")
        task = TaskContext.get()
        numbers = itertools.count()
        bundle, rows = Bundle(), []

        def finish() -> pa.RecordBatch:
            name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{next(numbers):04d}.warc.zst"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(bundle.finish())
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            cols = list(zip(*((*r[:5], name, *r[5:]) for r in rows)))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for page_id, url, payload, sha1, revisit, refers_to in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    data = record(page_id, url, payload, sha1, refers_to, revisit)
                    frame, offset = bundle.add(record_id(page_id), data)
                    rows.append((page_id, record_id(page_id), "revisit" if revisit else "response", refers_to, sha1,
                                 frame, offset, len(data)))
                    if bundle.size + bundle.n_open >= BUNDLE_BYTES:
                        yield finish()
                        bundle, rows = Bundle(), []
        if rows:
            yield finish()

    classified(pages, min_bytes).mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives: of responses the payload's size and digest as read, of
    revisits what the record says of the payload it refers to. A payload that differs from its
    record's digest is an error."""
    C.ship(spark)
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(f"{folder}/bundles")
        for batch in batches:
            for name in batch.column(0).to_pylist():
                bundle = BundleFile(fs, f"{root}/{name}")
                for k in bundle.frames():
                    data, at, rows = bundle.content(k), 0, []
                    while at < len(data):
                        r, at = parse_record(data, at)
                        kind, sha1 = r.fields["warc-type"], r.sha1()
                        if kind == "response" and (len(r.payload) != r.payload_bytes or hashlib.sha1(r.payload).hexdigest() != sha1):
                            raise ValueError(f"{name}: {r.fields['warc-record-id']} is damaged")
                        to = r.fields.get("warc-refers-to")
                        rows.append((page_of(r.fields["warc-record-id"]), r.payload_bytes, sha1, kind,
                                     page_of(to) if to else None, r.fields.get("warc-target-uri")))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                bundle.close()

    bundles = read_index(spark, folder).select("bundle").distinct()
    n = bundles.count()  # by number, so that many bundles are not put into one task for their short names
    return bundles.repartition(max(1, min(n, MAX_TASKS)), "bundle").mapInArrow(run, RECORDS)


def fetch(wanted: DataFrame, folder: str) -> DataFrame:
    """(page_id, record_type, refers_to, payload binary) of the pages wanted (``page_id``), read
    from their frames alone; a revisit has the payload of the record it refers to."""
    spark = wanted.sparkSession
    C.ship(spark)
    index = read_index(spark, folder)
    asked = index.join(wanted.select(F.col("page_id").cast("long").alias("page_id")).distinct(), "page_id", "left_semi")
    place = ["bundle", "frame", "offset"]
    others = (index.where("record_type = 'response'")
              .groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.min(F.struct(*place)).alias("at"))
              .select("refers_to", "payload_digest", "at.*"))
    rows = (asked.where("record_type = 'response'")
            .unionByName(asked.where("record_type = 'revisit'").drop(*place).join(others, ["refers_to", "payload_digest"]))
            .select("page_id", "record_type", "refers_to", *place)
            .repartition("bundle", "frame").sortWithinPartitions("bundle", "frame"))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(f"{folder}/bundles")
        found = ((row["bundle"], row["frame"], row) for batch in batches for row in batch.to_pylist())
        for name, of_bundle in itertools.groupby(found, lambda x: x[0]):
            bundle = BundleFile(fs, f"{root}/{name}")
            for frame, of_frame in itertools.groupby(of_bundle, lambda x: x[1]):
                data = bundle.content(frame)
                out = [(r["page_id"], r["record_type"], r["refers_to"], parse_record(data, r["offset"])[0].payload)
                       for _, _, r in of_frame]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 ["page_id", "record_type", "refers_to", "payload"])
            bundle.close()

    return rows.mapInArrow(run, "page_id long, record_type string, refers_to long, payload binary")


def archive_pages(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """The pages written to bundles in the shared folder and read back."""
    spark = pages.sparkSession
    folder = f"{checkpoint_dir(spark)}/warc-{spark.sparkContext.applicationId}-{next(_runs)}"
    write_bundles(pages, folder, min_bytes)
    return read_bundles(spark, folder)
