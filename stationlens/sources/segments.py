"""Versioned history as change segments (SCD1-SCD3).

A run adds one segment: the versions it opened and a closing record (id, end) for each earlier version
that it closed -- never a copy of what did not change. Segments are cut into hash buckets of
the key, so a run that changes few keys reads the open versions of their buckets only. A manifest,
appended by Spark's commit as in ``sources.tables``, names the segments in order and what wrote
them; a run that dies leaves no row there and therefore no trace in the history. ``compact`` merges
all segments into one, bucket by bucket, and a manifest row switches readers to it.

``read_history`` gives every version with its end: a version's own end, or its closing record's.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlens.operators.history import CLOSES, SCD_ID, VALID_FROM, VALID_TO
from stationlens.sources.tables import append_rows

MANIFEST = ("run long, folder string, compacted boolean, source string, opened long, closed long, key array<string>, "
            "buckets int, schema string, written_at timestamp_ntz")
BUCKET = "_bucket"


@dataclass(frozen=True)
class History:
    """What a manifest says: the segments that count, oldest first."""

    path: str
    run: int
    folders: tuple[str, ...]
    sources: frozenset[str]
    key: tuple[str, ...]
    buckets: int
    schema: T.StructType


def open_history(spark: SparkSession, path: str) -> History | None:
    """None where nothing was written yet; any other failure is raised."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy("run", "written_at").collect()  # a row a run
    except AnalysisException as e:
        if (e.getCondition() or "") == "PATH_NOT_FOUND":
            return None
        raise
    if not rows:
        return None
    last_merge = max((i for i, r in enumerate(rows) if r.compacted), default=0)
    last = rows[-1]
    return History(path, last.run, tuple(r.folder for r in rows[last_merge:]), frozenset(r.source for r in rows if not r.compacted),
                   tuple(last.key), last.buckets, T.StructType.fromJson(json.loads(last.schema)))


def _bucket(key: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, h: History) -> DataFrame:
    schema = T.StructType([*h.schema.fields, T.StructField("segment", T.StringType()), T.StructField(BUCKET, T.IntegerType())])
    return spark.read.option("basePath", f"{h.path}/segments").schema(schema).parquet(*[f"{h.path}/{f}" for f in h.folders])


def _ended(rows: DataFrame, data: Sequence[str]) -> DataFrame:
    """Versions with their ends. Closings are few between two compactions; the join is left to AQE."""
    ends = rows.filter(F.col(CLOSES)).select(F.col(BUCKET).alias("_b"), F.col(SCD_ID).alias("_id"), F.col(VALID_TO).alias("_end"))
    v = rows.filter(~F.col(CLOSES))
    joined = v.join(ends, (F.col(BUCKET) == F.col("_b")) & (F.col(SCD_ID) == F.col("_id")), "left")
    return joined.select(*data, VALID_FROM, F.coalesce(F.col(VALID_TO), F.col("_end")).alias(VALID_TO), SCD_ID, BUCKET)


def _data(h: History) -> list[str]:
    return [f.name for f in h.schema.fields if f.name not in (VALID_FROM, VALID_TO, SCD_ID, CLOSES)]


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """All versions (data columns, valid_from, valid_to, scd_id), None before the first run."""
    h = open_history(spark, path)
    return None if h is None else _ended(_rows(spark, h), _data(h)).drop(BUCKET)


def open_versions(spark: SparkSession, path: str, buckets_of: DataFrame | None = None) -> DataFrame | None:
    """The versions without an end; ``buckets_of``: only those in the buckets of these rows' keys (the
    semi join on the partition column prunes the other buckets' files)."""
    h = open_history(spark, path)
    if h is None:
        return None
    rows = _rows(spark, h)
    if buckets_of is not None:
        wanted = buckets_of.select(_bucket(h.key, h.buckets).alias("_wanted")).distinct()  # at most h.buckets rows
        rows = rows.join(F.broadcast(wanted), F.col(BUCKET) == F.col("_wanted"), "left_semi")
    return _ended(rows, _data(h)).filter(F.col(VALID_TO).isNull()).drop(BUCKET)


def append_changes(changes: DataFrame, path: str, key: Sequence[str], source: str = "run", buckets: int = 16,
                   compacted: bool = False) -> int:
    """Adds a segment; the run's number. ``changes``: see operators.history (new versions, closings)."""
    spark = changes.sparkSession
    h = open_history(spark, path)
    buckets = h.buckets if h else buckets
    run = 0 if h is None else h.run + 1
    folder = f"segments/segment={run:08d}-{uuid.uuid4().hex}"
    seen = Observation(folder)
    laid = (changes.withColumn(BUCKET, _bucket(key, buckets)).repartition(BUCKET, F.pmod(F.xxhash64(SCD_ID), F.lit(4)))
            .observe(seen, F.count_if(~F.col(CLOSES)).alias("opened"), F.count_if(F.col(CLOSES)).alias("closed")))
    laid.write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
    got = seen.get
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = (run, folder, compacted, source, int(got["opened"]), int(got["closed"]), list(key), buckets, changes.schema.json(), now)
    append_rows(spark.createDataFrame([row], MANIFEST), f"{path}/manifest")
    return run


def compact(spark: SparkSession, path: str) -> int | None:
    """Merges all segments into one without closings; readers of the old ones are not disturbed."""
    h = open_history(spark, path)
    if h is None:
        return None
    whole = _ended(_rows(spark, h), _data(h)).drop(BUCKET).withColumn(CLOSES, F.lit(False))
    return append_changes(whole.select(*h.schema.fieldNames()), path, h.key, source="compact", compacted=True)


def run_changes(spark: SparkSession, path: str, key: Sequence[str], incoming: DataFrame,
                changes: Callable[[DataFrame | None], DataFrame], source: str = "run", all_keys: bool = False,
                buckets: int = 16) -> int | None:
    """One run: ``changes`` gets the open versions (of the incoming keys' buckets, or of all keys) and
    returns what to add. A source that is in the manifest already is skipped (None): a replay."""
    h = open_history(spark, path)
    if h is not None and source != "run" and source in h.sources:
        return None
    known = None if h is None else open_versions(spark, path, None if all_keys else incoming)
    return append_changes(changes(known), path, key, source, buckets)
