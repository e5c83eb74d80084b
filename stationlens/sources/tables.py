"""Published tables (SRC6, SRC7, SRC11, SRC14, AGG12): written beside, then switched.

A table is a folder with ``data`` (a folder for each version) and ``manifest`` (a row for each
version, appended by Spark's own commit, so a row is there whole or not at all). ``publish`` writes a new
data folder and then its manifest row; readers take the folder that the latest row names. A job that
dies in either step leaves the earlier version as it was, and no reader ever sees half a table or
two versions mixed: a plan that reads a version keeps reading it after the next one is published.

The manifest row holds the schema, the row count and the least and greatest values of chosen columns,
observed while the data is written. Counts and latest dates are then read without touching the data.
Of two writers of one version the later row counts. Old versions stay until the storage's own tools
remove the folders that ``live_folders`` no longer names.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = ("version long, folder string, source string, rows long, least map<string,string>, greatest map<string,string>, "
            "schema string, partitions array<string>, published_at timestamp_ntz")


@dataclass(frozen=True)
class Version:
    """A manifest row."""

    version: int
    folder: str
    source: str
    rows: int
    least: dict[str, str | None]
    greatest: dict[str, str | None]
    schema: T.StructType
    partitions: tuple[str, ...] = ()


def append_rows(df: DataFrame, path: str) -> None:
    """Adds a few rows to an append-only table as one file, committed whole."""
    df.coalesce(1).write.mode("append").parquet(path)


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The table's manifest, None where there is no table yet; any other failure is raised (a storage
    fault must not look like a missing table)."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as e:
        if (e.getCondition() or "") == "PATH_NOT_FOUND":
            return None
        raise


def current(spark: SparkSession, path: str) -> Version | None:
    """The latest version."""
    rows = manifest(spark, path)
    last = None if rows is None else rows.orderBy(F.col("version").desc(), F.col("published_at").desc(), F.col("folder").desc()).first()
    if last is None:
        return None
    return Version(last.version, last.folder, last.source, last.rows, last.least, last.greatest,
                   T.StructType.fromJson(json.loads(last.schema)), tuple(last.partitions))


def exists(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), ranges: Sequence[str] = (),
            source: str = "run") -> Version:
    """Writes ``df`` as the next version of the table at ``path``; ``ranges``: columns whose least and
    greatest values the manifest keeps. ``df`` may read the table itself."""
    spark = df.sparkSession
    last = current(spark, path)
    version = 0 if last is None else last.version + 1
    folder = f"data/{version:08d}-{uuid.uuid4().hex}"
    seen = Observation(folder)
    found = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[f(F.col(c)).cast("string").alias(f"{k}:{c}")
                                                              for c in ranges for k, f in (("least", F.min), ("greatest", F.max))])
    found.write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    got = seen.get
    pick = lambda k: {c: got[f"{k}:{c}"] for c in ranges}
    done = Version(version, folder, source, int(got["rows"]), pick("least"), pick("greatest"), df.schema, tuple(partition_by))
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = (version, folder, source, done.rows, done.least, done.greatest, df.schema.json(), list(partition_by), now)
    append_rows(spark.createDataFrame([row], MANIFEST), f"{path}/manifest")
    return done


def read_version(spark: SparkSession, path: str, v: Version) -> DataFrame:
    return spark.read.schema(v.schema).parquet(f"{path}/{v.folder}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The latest version's rows, with the schema it was written with (no footer is read for it)."""
    v = current(spark, path)
    if v is None:
        raise FileNotFoundError(f"no published table at {path}")
    return read_version(spark, path, v)


def live_folders(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Data folders of the last ``keep`` versions; the others may be removed."""
    rows = manifest(spark, path)
    if rows is None:
        return []
    first = F.max("version").alias("v")
    least = rows.select(first).first()["v"] - keep
    return sorted(r.folder for r in rows.where(F.col("version") > least).select("folder").collect())


def table_facts(spark: SparkSession, tables: Mapping[str, str], column: str | None = None) -> DataFrame:
    """SRC14 / QRY11 / AGG12 from manifests alone: (table_name, row_count, least, greatest) of each table
    (name -> path); ``column``: whose range (NULL where a table does not keep it)."""
    parts = []
    for name, path in tables.items():
        rows = manifest(spark, path)
        if rows is None:
            raise FileNotFoundError(f"no published table at {path}")
        last = F.max_by(F.struct("rows", "least", "greatest"), F.struct("version", "published_at", "folder")).alias("m")
        value: Column = F.lit(column) if column else F.lit("")
        parts.append(rows.agg(last).select(F.lit(name).alias("table_name"), F.col("m.rows").alias("row_count"),
                                           F.element_at("m.least", value).alias("least"), F.element_at("m.greatest", value).alias("greatest")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
