"""The full model build (MOD1-MOD16) as one Spark job: raw tables -> staging ->
enriched entities -> daily series -> star schema -> reports -> history -> checks.

Fault tolerance and lineage:
* the two intermediates every mart reads (enriched entities, the daily series) are
  cut with ``checkpoint()`` into the shared folder named by ``spark.checkpoint.dir``
  -- reliable storage, so a lost executor never forces a recompute from the raw
  tables, and later stages do not re-run the enrichment aggregates;
* every table is published (sources.tables): a build that dies leaves each table at its last whole
  version, and dashboards read on meanwhile;
* the history gets a segment of what changed (sources.segments);
* staged prices (the only large staging model, read by five consumers) are written
  once as a Parquet table instead of being re-derived from raw strings per consumer.

Row counts and latest days come from the manifests, not from scans.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.operators import quality as Q
from stationlens.operators.anomalies import (
    bucket_state, price_anomalies, run_volume_anomalies, state_freshness_anomalies, state_volume_anomalies,
)
from stationlens.operators.dims import entity_dim, price_fact, product_dim, region_dim
from stationlens.operators.enrich import enrich, ts_literal
from stationlens.operators.explode import calendar
from stationlens.operators.history import check_changes, timestamp_changes
from stationlens.operators.reports import cheapest, regional, weekly
from stationlens.operators.series import price_series
from stationlens.functions.labels import surrogate_key
from stationlens.plans import fuel
from stationlens.session import checkpoint_dir, configure
from stationlens.sources import marts as M
from stationlens.sources import segments, tables
from stationlens.plans.checks import DECLARED, singular
from stationlens.sources.raw import RAW_PRICES, RAW_RUN_LOG, RAW_SHORTAGES, RAW_STATIONS, RUN_LOG, read_raw, read_seed

# Monitored tables (OBS3) -> sensitivity of their row counts between builds.
MONITORED_TABLES = {"fct_prix_produits": 3.0, "dim_stations": 2.0, "dim_produits": 3.0, "dim_regions": 3.0, "dim_date": 3.0}
FACT_SENSITIVITY = 3.0
STATION_SNAPSHOT_COLS = ("adresse", "ville", "code_postal", "services_list", "is_automate_24_24", "type_station")


@dataclass
class BuildConfig:
    raw_base: str
    out_base: str
    as_of: _dt.datetime
    seed_path: str | None = None
    product_key: str = "id"
    weekly_compat: bool = False


@dataclass
class Models:
    """What one build published: where, the number of entities, and the staging models that stay
    unstored (small, or read once)."""

    out: str
    entities: int
    staged: dict[str, DataFrame] = field(default_factory=dict)


def publish_models(spark: SparkSession, out: str, raw: dict[str, DataFrame], seed: DataFrame, as_of,
                   price_bounds: tuple[float, float] = (fuel.PRICE_MIN, fuel.PRICE_MAX), product_key: str = "id",
                   weekly_compat: bool = False, price_type: str | None = None) -> Models:
    """MOD1-MOD16: raw tables (stations, prices, shortages) -> published staged prices, dimensions, fact,
    reports and anomalies below ``out``. ``price_type``: type of the price column (as staged by default)."""
    configure(spark)
    checkpoint_dir(spark)
    # Station-side models are small at any scale: their joins are left to AQE (measured
    # broadcasts), not pinned to a shared hash partitioning.
    stations = fuel.clean_stations(raw["stations"])
    staged = fuel.clean_prices(raw["prices"], *price_bounds)
    M.write_mart(staged.withColumn("prix_euros", F.col("prix_euros").cast(price_type)) if price_type else staged, f"{out}/stg_prix")
    prices = M.read_mart(spark, f"{out}/stg_prix")
    services, hours, short = fuel.station_services(raw["stations"]), fuel.opening_hours(raw["stations"]), fuel.shortages(raw["shortages"])
    enriched = enrich(stations, services, hours, prices, short, as_of, fuel.region_of).checkpoint()
    series = price_series(prices, enriched, entity_key="station_key").checkpoint()

    dims = {"dim_stations": entity_dim(enriched), "dim_produits": product_dim(prices, seed),
            "dim_regions": region_dim(enriched, fuel.REGION_CODES, fuel.REGION_CODE_DEFAULT, fuel.REGION_CHIEF_TOWNS),
            "dim_date": calendar(spark)}
    versions = {name: M.write_mart(df, f"{out}/{name}") for name, df in dims.items()}
    d_st, d_pr, d_rg, d_dt = (M.read_mart(spark, f"{out}/{n}") for n in dims)

    written = M.write_fact(price_fact(series, d_st, d_pr, d_dt, d_rg, product_key=product_key), f"{out}/fct_prix_produits",
                           ranges=["derniere_maj"])
    fact = M.read_mart(spark, f"{out}/fct_prix_produits")  # keeps mois_prix for pruning
    # The latest day is in the fact's manifest, so the reports read that day's month directory only.
    last_day = F.lit(written.greatest["date_prix"]).cast("date")
    M.write_mart(cheapest(fact, d_st, latest_day=last_day), f"{out}/rpt_stations_moins_cheres")
    M.write_mart(regional(fact, d_rg, as_of), f"{out}/rpt_prix_moyen_region", ranges=["date_prix"])
    M.write_mart(weekly(fact, as_of, fuel.WEEKLY_PIVOT_REGIONS, compat=weekly_compat, dim_date=d_dt), f"{out}/rpt_evolution_prix_hebdo")
    M.write_mart(price_anomalies(fact, d_st, as_of), f"{out}/analysis_price_anomalies")
    return Models(out, versions["dim_stations"].rows, {
        "raw_stations": raw["stations"], "raw_prix": raw["prices"], "stg_stations": stations, "stg_services": services,
        "stg_hours": hours, "stg_shortages": short, "stations_enriched": enriched, "daily_series": series, "seed_produits": seed})


#: Tables that a build publishes.
PUBLISHED = ("stg_prix", "dim_stations", "dim_produits", "dim_regions", "dim_date", "fct_prix_produits", "rpt_stations_moins_cheres",
             "rpt_prix_moyen_region", "rpt_evolution_prix_hebdo", "analysis_price_anomalies")


def checked_tables(spark: SparkSession, models: Models) -> dict[str, DataFrame]:
    """Every table that a declared check reads."""
    return models.staged | {n: M.read_mart(spark, f"{models.out}/{n}") for n in PUBLISHED}


def build(spark: SparkSession, cfg: BuildConfig) -> dict[str, int]:
    configure(spark)
    base, out = cfg.raw_base, cfg.out_base
    raw = {"stations": read_raw(spark, f"{base}/raw_stations", RAW_STATIONS), "prices": read_raw(spark, f"{base}/raw_prix", RAW_PRICES),
           "shortages": read_raw(spark, f"{base}/raw_ruptures", RAW_SHORTAGES)}
    seed = read_seed(spark, cfg.seed_path, fuel.PRODUCT_SEED_SCHEMA) if cfg.seed_path else fuel.product_seed(spark)
    models = publish_models(spark, out, raw, seed, cfg.as_of, product_key=cfg.product_key, weekly_compat=cfg.weekly_compat)
    checked = checked_tables(spark, models)

    # History: a segment of each snapshot with what changed.
    prices, enriched = checked["stg_prix"], checked["stations_enriched"]
    snap = prices.filter(~F.col("is_prix_invalide")).select(
        surrogate_key("station_id", "carburant_nom").alias("prix_snapshot_key"), "station_id",
        "carburant_nom", "carburant_id", "prix_euros", "date_maj", "date_prix", "is_prix_invalide",
        "is_prix_suspect", F.col("_loaded_at").alias("source_loaded_at"))
    key = ["prix_snapshot_key"]
    segments.run_changes(spark, f"{out}/snap_prix", key, snap,
                         lambda known: timestamp_changes(known, snap, key, "date_maj", ["prix_euros", "carburant_id"]))
    snap_st = enriched.select("station_id", *[c for c in enriched.columns if c not in ("station_id", "_loaded_at")],
                              F.col("_loaded_at").alias("source_loaded_at"))
    segments.run_changes(spark, f"{out}/snap_stations", ["station_id"], snap_st, lambda known: check_changes(
        known, snap_st, ["station_id"], STATION_SNAPSHOT_COLS, cfg.as_of), all_keys=True)

    log = spark.read.schema(RAW_RUN_LOG).parquet(f"{base}/{RUN_LOG}")
    M.write_mart(Q.run_rules(spark, checked, DECLARED, singular(checked["stg_stations"], prices, log, cfg.as_of)), f"{out}/quality_results")
    M.write_mart(Q.source_freshness({"raw_stations": raw["stations"], "raw_prix": raw["prices"], "raw_ruptures": raw["shortages"]}, cfg.as_of),
                 f"{out}/source_freshness")
    _monitors(spark, out, checked["daily_series"], cfg.as_of)
    return {"entities": models.entities}


def monitored_counts(spark: SparkSession, out: str, as_of) -> DataFrame:
    """OBS3: row counts of the monitored tables, from their manifests: (table_name, run_at, row_count)."""
    facts = tables.table_facts(spark, {t: f"{out}/{t}" for t in MONITORED_TABLES})
    return facts.select("table_name", ts_literal(as_of).alias("run_at"), "row_count")


def _monitors(spark: SparkSession, out: str, series: DataFrame, as_of: _dt.datetime) -> None:
    """OBS1-OBS3 without reading a stored table: row counts kept from build to build come from the
    manifests; the fact's rows by price day and the age of its updates from states of the series it was
    made of (a row a bucket, published with the build)."""
    tables.append_rows(monitored_counts(spark, out, as_of), f"{out}/run_counts")
    runs = spark.read.parquet(f"{out}/run_counts")
    M.write_mart(bucket_state(series.withColumn("day", F.col("date_prix").cast("timestamp_ntz")), "day"), f"{out}/state_days")
    M.write_mart(bucket_state(series, "derniere_maj", "6 hours"), f"{out}/state_updates")
    by_day = state_volume_anomalies(M.read_mart(spark, f"{out}/state_days"), sensitivity=FACT_SENSITIVITY, table="fct_prix_produits by day")
    M.write_mart(run_volume_anomalies(runs, MONITORED_TABLES).unionByName(by_day), f"{out}/volume_monitors")
    M.write_mart(state_freshness_anomalies(M.read_mart(spark, f"{out}/state_updates"), sensitivity=FACT_SENSITIVITY,
                                           table="fct_prix_produits"), f"{out}/freshness_monitors")
