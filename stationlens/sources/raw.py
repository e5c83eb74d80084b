"""Raw tables (SRC6-SRC10): fixed all-string schemas, create-if-absent, full-refresh loads that are
published whole (sources.tables) with their row counts, malformed feed elements, the run log, the
product seed."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stationlens.sources import tables

S, TS = T.StringType(), T.TimestampNTZType()


def _schema(*names: str, loaded: bool = True) -> T.StructType:
    fields = [T.StructField(n, S) for n in names]
    if loaded:
        fields.append(T.StructField("_loaded_at", TS))
    return T.StructType(fields)


RAW_STATIONS = _schema("station_id", "latitude", "longitude", "cp", "pop", "adresse", "ville",
                       "services", "automate_24_24", "horaires_json")
RAW_PRICES = _schema("station_id", "carburant_nom", "carburant_id", "valeur", "maj")
RAW_SHORTAGES = _schema("station_id", "carburant_nom", "carburant_id", "debut", "fin", "type")
RAW_RUN_LOG = T.StructType([
    T.StructField("ingestion_id", S), T.StructField("started_at", TS), T.StructField("completed_at", TS),
    T.StructField("stations_count", T.IntegerType()), T.StructField("prix_count", T.IntegerType()),
    T.StructField("ruptures_count", T.IntegerType()), T.StructField("status", S),
    T.StructField("error_message", S),
])
RAW_REJECTED = _schema("element")
RAW_TABLES = {"raw_stations": RAW_STATIONS, "raw_prix": RAW_PRICES, "raw_ruptures": RAW_SHORTAGES,
              "raw_rejected": RAW_REJECTED}
RUN_LOG = "raw_ingestion_log"


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """SRC6: publish an empty table at ``path`` unless one exists."""
    if not tables.exists(spark, path):
        tables.publish(spark.createDataFrame([], schema), path, source="create")


def ensure_raw_tables(spark: SparkSession, base: str) -> dict[str, str]:
    paths = {name: f"{base}/{name}" for name in RAW_TABLES}
    for name, schema in RAW_TABLES.items():
        ensure_table(spark, paths[name], schema)
    paths[RUN_LOG] = f"{base}/{RUN_LOG}"  # append-only
    spark.createDataFrame([], RAW_RUN_LOG).write.mode("ignore").parquet(paths[RUN_LOG])
    return paths


def full_refresh(df: DataFrame, path: str, allow_empty: bool = True, upper_case: bool = False) -> int:
    """SRC7: replace the table at ``path`` with ``df``; returns the row count, observed
    during the write (no second pass). Readers see the old table until the new one is whole; a load
    that fails changes nothing. With ``allow_empty=False`` an empty input
    leaves the old table in place and returns 0 (the reference's skip-with-warning)."""
    if not allow_empty and df.isEmpty():
        return 0
    out = df.toDF(*[c.upper() for c in df.columns]) if upper_case else df
    return tables.publish(out, path).rows


def append_run_log(spark: SparkSession, path: str, ingestion_id: str, started_at: _dt.datetime,
                   counts: tuple[int, int, int], status: str, error: str | None = None,
                   completed_at: _dt.datetime | None = None) -> None:
    """SRC8: append one run row (also written when the run failed)."""
    completed = completed_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = (ingestion_id, started_at.replace(tzinfo=None), completed, int(counts[0]), int(counts[1]),
           int(counts[2]), status, error)
    tables.append_rows(spark.createDataFrame([row], RAW_RUN_LOG), path)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC9: typed CSV seed (header, explicit schema, no inference)."""
    return spark.read.csv(path, header=True, schema=schema)


def read_raw(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC10: raw table scan (filters and column pruning reach the Parquet reader) of a published
    table or of plain Parquet files; with a known schema no inference pass over the footers is needed."""
    v = tables.current(spark, path)
    if v is not None:
        return tables.read_version(spark, path, v)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def ingest(spark: SparkSession, feed_path: str, raw_base: str, as_of: _dt.datetime,
           ingestion_id: str | None = None) -> dict[str, int]:
    """The ingestion run: feed -> three raw tables (full refresh), malformed elements -> raw_rejected,
    -> run log. The counts of the log are those of the three tables.

    The feed scan is persisted (MEMORY_AND_DISK: lost blocks are recomputed from the
    files) so the three outputs read it once."""
    from pyspark import StorageLevel

    from stationlens.sources.feed import explode_prices, explode_shortages, flatten_stations, read_feed, rejected, well_formed

    run_id = ingestion_id or as_of.strftime("%Y%m%d_%H%M%S")
    paths = ensure_raw_tables(spark, raw_base)
    started = as_of
    scan = None
    try:
        scan = read_feed(spark, feed_path, keep_malformed=True).persist(StorageLevel.MEMORY_AND_DISK)
        n_bad = full_refresh(rejected(scan, as_of), paths["raw_rejected"])
        feed = well_formed(scan)
        n_st = full_refresh(flatten_stations(feed, as_of), paths["raw_stations"])
        n_px = full_refresh(explode_prices(feed, as_of), paths["raw_prix"])
        n_ru = full_refresh(explode_shortages(feed, as_of), paths["raw_ruptures"])
        append_run_log(spark, paths["raw_ingestion_log"], run_id, started, (n_st, n_px, n_ru), "SUCCESS")
        return {"raw_stations": n_st, "raw_prix": n_px, "raw_ruptures": n_ru, "raw_rejected": n_bad}
    except Exception as exc:  # the failure is logged, then re-raised
        append_run_log(spark, paths["raw_ingestion_log"], run_id, started, (0, 0, 0), "FAILED", str(exc))
        raise
    finally:
        if scan is not None:
            scan.unpersist()
