"""Driver queries, part 2: history (SCD1-4), data quality (DQ1-12), monitors (OBS1-2)
and the dashboard query API (QRY1-11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stationlens.functions.labels import surrogate_key
from stationlens.operators import dashboard as D
from stationlens.operators import history as H
from stationlens.operators import quality as Q
from stationlens.operators.anomalies import (
    bucket_state, freshness_anomalies, merge_states, state_volume_anomalies, volume_anomalies,
)
from stationlens.operators.enrich import ts_literal
from stationlens.plans import adapters as A
from stationlens.plans import checks as CHECKS
from stationlens.plans import fuel
from stationlens.plans import oracle as O
from stationlens.plans import stored
from stationlens.plans.build import MONITORED_TABLES, PUBLISHED, checked_tables, monitored_counts
from stationlens.plans.catalog import EventsBuild, neutral, register
from stationlens.plans.oracle import cte, q, rnd, sk, sql
from stationlens.sources import feed as FEED
from stationlens.sources import raw as RAW
from stationlens.sources import segments, tables

# ---------------------------------------------------------------------------
# History (SCD1-4)
# ---------------------------------------------------------------------------
SNAP_CUT = "2024-01-16 00:00:00"
ASOF_READ = "2024-01-20 00:00:00"
RUN1, RUN2 = "2024-01-15 00:00:00", "2024-01-31 00:00:00"
STATION_CHECK_COLS = ("adresse", "ville", "code_postal", "services_raw", "is_automate_24_24", "type_station")


def _snap_source(b: EventsBuild):
    p = b.prices.filter(~F.col("is_prix_invalide"))
    return p.select(surrogate_key("station_id", "carburant_nom").alias("prix_snapshot_key"),
                    "station_id", "carburant_nom", "carburant_id",
                    F.col("prix_euros").cast("double").alias("prix_euros"), "date_maj", "date_prix",
                    "is_prix_invalide", "is_prix_suspect", F.col("_loaded_at").alias("source_loaded_at"))


def price_history(spark, d, compacted=False):
    """Two loads into a new history of segments, read back."""
    src, cut, key = _snap_source(EventsBuild(spark, d)), ts_literal(SNAP_CUT), ["prix_snapshot_key"]
    path = stored.folder(spark, "history")
    for load in (src.filter(F.col("date_maj") < cut), src.filter(F.col("date_maj") >= cut)):
        segments.run_changes(spark, path, key, load, lambda known, load=load: H.timestamp_changes(
            known, load, key, "date_maj", ["prix_euros", "carburant_id"]))
    if compacted:
        segments.compact(spark, path)
    return segments.read_history(spark, path)


cte("snap_src", ("stg_prix",), f"""
SELECT {sk('station_id', 'carburant_nom')} AS prix_snapshot_key, station_id, carburant_nom, carburant_id,
       CAST(prix_euros AS DOUBLE) AS prix_euros, date_maj, date_prix, is_prix_invalide, is_prix_suspect,
       _loaded_at AS source_loaded_at
FROM stg_prix WHERE NOT is_prix_invalide AND date_maj IS NOT NULL""")


cte("price_hist", ("snap_src",), f"""
SELECT * EXCLUDE (rn), date_maj AS valid_from,
       lead(date_maj) OVER (PARTITION BY prix_snapshot_key ORDER BY date_maj) AS valid_to,
       {sk('prix_snapshot_key', 'date_maj')} AS scd_id
FROM (SELECT *, row_number() OVER (PARTITION BY prix_snapshot_key, date_maj
                                   ORDER BY prix_euros DESC, carburant_id DESC) AS rn FROM snap_src) u
WHERE rn = 1""")


@register("scd_prices", sql("SELECT * FROM price_hist", "price_hist"))
def q_scd_prices(spark, d):
    """SCD1: timestamp-strategy history over two loads (before / after a cut-off)."""
    return price_history(spark, d)


@register("scd_compacted", sql("SELECT * FROM price_hist", "price_hist"))
def q_scd_compacted(spark, d):
    """SCD1: the same history after its segments were merged."""
    return price_history(spark, d, compacted=True)


@register("scd_asof", sql(f"""
SELECT * FROM price_hist WHERE valid_from <= TIMESTAMP '{ASOF_READ}'
  AND (valid_to IS NULL OR TIMESTAMP '{ASOF_READ}' < valid_to)""", "price_hist"))
def q_scd_asof(spark, d):
    """SCD3: versions valid at a point in time."""
    return H.as_of_version(price_history(spark, d), ASOF_READ)


@register("scd_versions", sql("""
SELECT station_id, carburant_nom, count(*) AS nb_versions, count(*) - 1 AS nb_changes,
       min(valid_from) AS first_valid_from, max(valid_from) AS last_valid_from
FROM price_hist GROUP BY station_id, carburant_nom""", "price_hist"))
def q_scd_versions(spark, d):
    """SCD3: versions and changes per (entity, product)."""
    return H.version_counts(price_history(spark, d), ["station_id", "carburant_nom"])


def _station_snapshots(b: EventsBuild):
    cols = ["station_id", *STATION_CHECK_COLS]
    s1 = b.stations.filter(F.col("type_station") != "Route").select(*cols)
    s2 = b.stations.filter(F.col("latitude").isNotNull()).select(
        "station_id",
        F.when(F.col("is_automate_24_24"), F.upper("adresse")).otherwise(F.col("adresse")).alias("adresse"),
        *STATION_CHECK_COLS[1:])
    return s1, s2


_CHK = " OR ".join(f"h.{c} IS DISTINCT FROM s2.{c}" for c in STATION_CHECK_COLS)
cte("st_s1", ("stg_stations",), f"""
SELECT station_id, {', '.join(STATION_CHECK_COLS)} FROM stg_stations WHERE type_station <> 'Route'""")
cte("st_s2", ("stg_stations",), f"""
SELECT station_id, CASE WHEN is_automate_24_24 THEN upper(adresse) ELSE adresse END AS adresse,
       {', '.join(STATION_CHECK_COLS[1:])} FROM stg_stations WHERE latitude IS NOT NULL""")
cte("st_h1", ("st_s1",), f"""
SELECT *, TIMESTAMP '{RUN1}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
       {sk('station_id', f"TIMESTAMP '{RUN1}'")} AS scd_id FROM st_s1""")
cte("station_hist", ("st_h1", "st_s2"), f"""
SELECT h.station_id, {', '.join('h.' + c for c in STATION_CHECK_COLS)}, h.valid_from,
       CASE WHEN s2.station_id IS NULL OR {_CHK} THEN TIMESTAMP '{RUN2}' END AS valid_to, h.scd_id
FROM st_h1 h LEFT JOIN st_s2 s2 ON h.station_id = s2.station_id
UNION ALL
SELECT s2.*, TIMESTAMP '{RUN2}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
       {sk('s2.station_id', f"TIMESTAMP '{RUN2}'")} AS scd_id
FROM st_s2 s2 LEFT JOIN st_h1 h ON h.station_id = s2.station_id
WHERE h.station_id IS NULL OR {_CHK}""")


@register("scd_stations", sql("SELECT * FROM station_hist", "station_hist"))
def q_scd_stations(spark, d):
    """SCD2: check strategy over 6 columns, missing keys closed, two runs."""
    s1, s2 = _station_snapshots(EventsBuild(spark, d))
    h1 = H.scd2_check(None, s1, ["station_id"], STATION_CHECK_COLS, RUN1)
    return H.scd2_check(h1, s2, ["station_id"], STATION_CHECK_COLS, RUN2)


@register("scd_rebuild", sql(f"""
SELECT user_id, event_type, band, ts AS valid_from,
       lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, band) AS valid_to,
       {sk('user_id', 'event_type', 'ts')} AS scd_id
FROM (SELECT *, lag(band) OVER (PARTITION BY user_id, event_type ORDER BY ts, band) AS pb,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, band) AS rn
      FROM (SELECT DISTINCT user_id, event_type, ts, CAST(floor(value / 100) AS BIGINT) AS band FROM events) o) m
WHERE rn = 1 OR pb IS DISTINCT FROM band"""))
def q_scd_rebuild(spark, d):
    """SCD4: versions rebuilt from the full observation history (change rows only)."""
    ev = A.read_table(spark, d, "events").select(
        "user_id", "event_type", "ts", F.floor(F.col("value") / 100).cast("bigint").alias("band"))
    return H.scd2_rebuild(ev, ["user_id", "event_type"], "ts", ["band"])


# ---------------------------------------------------------------------------
# Data quality (DQ1-12)
# ---------------------------------------------------------------------------

@register("dq_unique", sql("""
SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey HAVING count(*) > 1"""))
def q_dq_unique(spark, d):
    """DQ1: unique."""
    return Q.unique(A.read_table(spark, d, "orders"), ["o_custkey"])


@register("dq_not_null", sql("SELECT station_id, latitude FROM enriched WHERE latitude IS NULL", "enriched"))
def q_dq_not_null(spark, d):
    """DQ2: not_null."""
    return neutral(Q.not_null(EventsBuild(spark, d).enriched, "latitude", keep=["station_id"]))


_NAMES = ", ".join(q(n) for n in fuel.PRODUCT_NAMES)


@register("dq_accepted", sql(f"""
SELECT carburant_nom, count(*) AS n_records FROM stg_prix
WHERE carburant_nom IS NOT NULL AND carburant_nom NOT IN ({_NAMES}) GROUP BY carburant_nom""", "stg_prix"))
def q_dq_accepted(spark, d):
    """DQ3: accepted_values (product names)."""
    return Q.accepted_values(EventsBuild(spark, d).prices, "carburant_nom", fuel.PRODUCT_NAMES)


@register("dq_relationships", sql("""
SELECT f.station_id, count(*) AS n_records FROM fact f
WHERE f.station_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_stations s WHERE s.station_id = f.station_id)
GROUP BY f.station_id""", "fact", "dim_stations"))
def q_dq_relationships(spark, d):
    """DQ4 / JOI13: fact -> entity dimension."""
    return Q.relationships(stored.fact(spark, d), "station_id", stored.mart(spark, d, "dim_stations"), "station_id")


@register("dq_between", sql(f"""
SELECT station_id, carburant_nom, date_maj, CAST(prix_euros AS DOUBLE) AS prix_euros FROM stg_prix
WHERE prix_euros IS NOT NULL AND (prix_euros < {fuel.PRICE_MIN} OR prix_euros > {fuel.PRICE_MAX})""", "stg_prix"))
def q_dq_between(spark, d):
    """DQ5: value between (price range)."""
    return neutral(Q.between(EventsBuild(spark, d).prices, "prix_euros", fuel.PRICE_MIN, fuel.PRICE_MAX,
                             keep=["station_id", "carburant_nom", "date_maj"]))


@register("dq_length", sql("""
SELECT station_id, carburant_nom, carburant_id FROM stg_prix
WHERE carburant_id IS NOT NULL AND length(carburant_id) <> 1""", "stg_prix"))
def q_dq_length(spark, d):
    """DQ6: string length equals."""
    return Q.length_eq(EventsBuild(spark, d).prices, "carburant_id", 1, keep=["station_id", "carburant_nom"])


@register("dq_coordinates", sql(f"""
SELECT station_id, latitude, longitude, code_postal, ville,
       CASE WHEN latitude < {Q.BOX_LAT[0]} THEN {q(Q.BOX_REASONS[0])}
            WHEN latitude > {Q.BOX_LAT[1]} THEN {q(Q.BOX_REASONS[1])}
            WHEN longitude < {Q.BOX_LON[0]} THEN {q(Q.BOX_REASONS[2])}
            WHEN longitude > {Q.BOX_LON[1]} THEN {q(Q.BOX_REASONS[3])}
            ELSE {q(Q.BOX_REASONS[4])} END AS coordinate_issue
FROM stg_stations
WHERE code_departement NOT LIKE '97%' AND code_departement NOT LIKE '98%'
  AND latitude IS NOT NULL AND longitude IS NOT NULL
  AND (latitude < 41.0 OR latitude > 52.0 OR longitude < -6.0 OR longitude > 10.0)""", "stg_stations"))
def q_dq_coordinates(spark, d):
    """DQ7 / PRJ33: bounding-box check with reason."""
    return neutral(Q.in_box(EventsBuild(spark, d).stations))


@register("dq_orphans", sql("""
SELECT p.station_id, count(*) AS price_records
FROM (SELECT DISTINCT station_id FROM stg_prix) p
WHERE NOT EXISTS (SELECT 1 FROM stg_stations s WHERE s.station_id = p.station_id)
GROUP BY p.station_id""", "stg_prix", "stg_stations"))
def q_dq_orphans(spark, d):
    """DQ8 / JOI8: prices whose entity is missing (anti join)."""
    b = EventsBuild(spark, d)
    return Q.orphans(b.prices, b.stations)


def run_log(spark, d):
    """Run-log adapter: each order is an ingestion run (status from the order status)."""
    o = A.read_table(spark, d, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("ingestion_id"),
                    F.col("o_orderdate").alias("started_at"),
                    (F.col("o_orderdate") + F.expr("INTERVAL 1 HOURS")).alias("completed_at"),
                    F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"))


cte("run_log", (), """
SELECT CAST(o_orderkey AS VARCHAR) AS ingestion_id, o_orderdate AS started_at,
       o_orderdate + INTERVAL 1 HOUR AS completed_at,
       CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status
FROM orders""")

# the first rule that holds gives the message: (rule, number of the message)
_OLD = f"< {O.EV_ASOF} - INTERVAL 24 HOUR"
_FRESH_RULES = (("last_success IS NULL", 0), (f"last_success {_OLD}", 1), ("most_recent_price_update IS NULL", 2),
                (f"most_recent_price_update {_OLD}", 3), ("stations_with_recent_data < 100", 4))


_FRESHNESS = (f"""
WITH seen AS (
  SELECT (SELECT max(completed_at) FROM run_log) AS last_successful_ingestion,
         (SELECT max(completed_at) FROM run_log WHERE status = 'SUCCESS') AS last_success,
         (SELECT max(date_maj) FROM stg_prix WHERE NOT date_maj {_OLD}) AS most_recent_price_update,
         (SELECT count(DISTINCT station_id) FROM stg_prix WHERE NOT date_maj {_OLD}) AS stations_with_recent_data)
SELECT *, list_filter([{', '.join(f'if({rule}, {q(Q.FRESHNESS_MESSAGES[m])}, NULL)' for rule, m in _FRESH_RULES)}],
                      lambda x: x IS NOT NULL)[1] AS freshness_status
FROM seen WHERE {' OR '.join(rule for rule, _ in _FRESH_RULES)}""",)


@register("dq_freshness", sql(_FRESHNESS[0], "run_log", "stg_prix"))
def q_dq_freshness(spark, d):
    """DQ9: pipeline freshness (AGG13, AGG14, JOI9)."""
    return Q.pipeline_freshness(run_log(spark, d), EventsBuild(spark, d).prices, A.AS_OF_EVENTS)


SOURCE_ASOF = "2024-01-31 18:00:00"


@register("dq_source_freshness", sql(f"""
SELECT table_name, max_loaded_at,
       {rnd(f"(epoch_us(TIMESTAMP '{SOURCE_ASOF}') - epoch_us(max_loaded_at)) / 3.6e9", 6)} AS age_hours,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN (epoch_us(TIMESTAMP '{SOURCE_ASOF}') - epoch_us(max_loaded_at)) / 3.6e9 > 24 THEN 'error'
            WHEN (epoch_us(TIMESTAMP '{SOURCE_ASOF}') - epoch_us(max_loaded_at)) / 3.6e9 > 12 THEN 'warn'
            ELSE 'pass' END AS status
FROM (SELECT 'raw_prix' AS table_name, max(_loaded_at) AS max_loaded_at FROM raw_prix
      UNION ALL SELECT 'raw_stations', max(_loaded_at) FROM raw_stations
      UNION ALL SELECT 'raw_ruptures', max(_loaded_at) FROM raw_ruptures) t""",
    "raw_prix", "raw_stations", "raw_ruptures"))
def q_dq_source_freshness(spark, d):
    """DQ10: source freshness (warn 12 h / error 24 h on load time)."""
    return Q.source_freshness({"raw_prix": A.raw_prices(spark, d), "raw_stations": A.raw_stations(spark, d),
                               "raw_ruptures": A.raw_shortages(spark, d)}, SOURCE_ASOF)


# oracle name of each checked table
_CHECKED = {"raw_stations": "raw_stations", "raw_prix": "raw_prix", "stg_stations": "stg_stations", "stg_prix": "stg_prix", "stg_services": "stg_services", "stg_hours": "stg_hours",
            "stg_shortages": "stg_shortages", "stations_enriched": "enriched", "daily_series": "series",
            "dim_stations": "dim_stations", "dim_produits": "dim_products", "dim_regions": "dim_regions", "dim_date": "date_keys",
            "fct_prix_produits": "fact", "rpt_prix_moyen_region": "regional", "rpt_stations_moins_cheres": "cheapest",
            "rpt_evolution_prix_hebdo": "weekly", "seed_produits": "seed"}


def _failures(table: str, col: str, rule) -> str:
    """SQL that counts what breaks a declared rule."""
    t, a = _CHECKED[table], rule.args
    text = lambda v: q(v) if isinstance(v, str) else str(v)
    return {
        "unique": lambda: f"SELECT count(*) FROM (SELECT {col} FROM {t} GROUP BY {col} HAVING count({col}) > 1)",
        "not_null": lambda: f"SELECT count(*) - count({col}) FROM {t}",
        "accepted": lambda: f"SELECT count(*) FROM {t} WHERE {col} NOT IN ({', '.join(map(text, a))})",
        "between": lambda: f"SELECT count(*) FROM {t} WHERE {col} NOT BETWEEN {a[0]} AND {a[1]}",
        "length": lambda: f"SELECT count(*) FROM {t} WHERE length({col}) <> {a[0]}",
        "parent": lambda: f"SELECT count(*) FROM (SELECT DISTINCT {col} AS k FROM {t} WHERE {col} IS NOT NULL) "
                          f"WHERE k NOT IN (SELECT {a[1]} FROM {_CHECKED[a[0]]})",
    }[rule.kind]()


_SUITE = [(f"{r.kind}_{col}", table, col, r.severity, _failures(table, col, r))
          for table, columns in CHECKS.DECLARED.items() for col, rules in columns.items() for r in rules]
_SUITE += [("orphan_prices", "stg_prix", "station_id", "warn",
            "SELECT count(DISTINCT station_id) FROM stg_prix WHERE station_id NOT IN (SELECT station_id FROM stg_stations)"),
           ("coordinates_in_box", "stg_stations", "latitude,longitude", "warn",
            "SELECT count(*) FROM stg_stations WHERE NOT (latitude BETWEEN 41 AND 52 AND longitude BETWEEN -6 AND 10) "
            "AND left(code_departement, 2) NOT IN ('97', '98')"),
           ("data_freshness", "run_log", "freshness_status", "warn", "SELECT count(*) FROM stale")]
cte("stale", ("run_log", "stg_prix"), _FRESHNESS[0])


@register("dq_suite", sql("SELECT *, if(failures = 0, 'pass', if(severity = 'error', 'error', 'warn')) AS status FROM (\n" + " UNION ALL\n".join(
    f"SELECT {q(n)} AS check_name, {q(t)} AS table_name, {q(c)} AS column_name, {q(s)} AS severity, ({f}) AS failures"
    for n, t, c, s, f in _SUITE) + ")", *_CHECKED.values(), "stale"))
def q_dq_suite(spark, d):
    """DQ1-DQ9, DQ11, DQ12: every declared check over all tables, in one result table."""
    checked = checked_tables(spark, stored.models(spark, d))
    return Q.run_rules(spark, checked, CHECKS.DECLARED, CHECKS.singular(checked["stg_stations"], checked["stg_prix"], run_log(spark, d), A.AS_OF_EVENTS))


# ---------------------------------------------------------------------------
# Monitors (OBS1, OBS2)
# ---------------------------------------------------------------------------

_XMEAN = "(CAST(sum(CAST(metric AS DECIMAL(38,6))) OVER w AS DOUBLE) / CAST(count(metric) OVER w AS DOUBLE))"


def _zsql(metric_sql: str, src: str, step: str) -> str:
    return f"""
SELECT table_name, bucket_start, metric,
       {rnd(_XMEAN, 6)} AS trailing_mean,
       {rnd('stddev_samp(metric) OVER w', 6)} AS trailing_stddev,
       {rnd(f'(metric - {_XMEAN}) / nullif(stddev_samp(metric) OVER w, 0)', 6)} AS z_score,
       coalesce(abs((metric - {_XMEAN}) / nullif(stddev_samp(metric) OVER w, 0)) > 3, FALSE) AS is_anomaly
FROM ({metric_sql}) t
WINDOW w AS (PARTITION BY table_name ORDER BY bucket_start ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)"""


_VOL = """
SELECT 'events' AS table_name, s.bucket_start, CAST(coalesce(c.n, 0) AS BIGINT) AS metric
FROM (SELECT CAST(unnest(generate_series(min(b), max(b), INTERVAL 1 DAY)) AS TIMESTAMP) AS bucket_start
      FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS b FROM events) x) s
LEFT JOIN (SELECT time_bucket(INTERVAL 1 DAY, ts) AS b, count(*) AS n FROM events GROUP BY 1) c
  ON s.bucket_start = c.b"""

_FRESH = """
SELECT 'events' AS table_name, bucket_start,
       CAST((epoch_us(bucket_start + INTERVAL 6 HOUR)
             - epoch_us(max(last_ts) OVER (ORDER BY bucket_start ROWS UNBOUNDED PRECEDING))) / 1e6 AS DOUBLE) AS metric
FROM (SELECT s.bucket_start, c.last_ts
      FROM (SELECT CAST(unnest(generate_series(min(b), max(b), INTERVAL 6 HOUR)) AS TIMESTAMP) AS bucket_start
            FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS b FROM events) x) s
      LEFT JOIN (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS b, max(ts) AS last_ts FROM events GROUP BY 1) c
        ON s.bucket_start = c.b) y"""


def _round_monitor(df, metric):
    return df.select("table_name", "bucket_start", F.col(metric).alias(metric),
                     F.round("trailing_mean", 6).alias("trailing_mean"),
                     F.round("trailing_stddev", 6).alias("trailing_stddev"),
                     F.round("z_score", 6).alias("z_score"), "is_anomaly")


@register("volume_anomalies", sql(_zsql(_VOL, "events", "1 day").replace(
    "metric", "row_count")))
def q_volume(spark, d):
    """OBS1: daily volume z-score against the 14 previous days (gaps = 0)."""
    ev = A.read_table(spark, d, "events")
    return _round_monitor(volume_anomalies(ev, "ts", sensitivity=3.0, table="events"), "row_count")


@register("freshness_anomalies", sql(_zsql(_FRESH, "events", "6 hours").replace(
    "metric", "staleness_seconds")))
def q_freshness(spark, d):
    """OBS2: staleness at each 6-hour bucket end, z-score against 14 previous buckets."""
    ev = A.read_table(spark, d, "events")
    return _round_monitor(freshness_anomalies(ev, "ts", sensitivity=3.0, table="events"), "staleness_seconds")


# ---------------------------------------------------------------------------
# Dashboard query API (QRY1-11)
# ---------------------------------------------------------------------------
PRODUCT, CITY, DEPT = "GAZOLE", "nation_1", "01"

_SEARCH = f"""
SELECT f.station_id, s.ville, s.adresse, s.code_postal, s.code_departement, s.region, s.type_station,
       s.is_automate_24_24, f.carburant_nom, f.carburant_id, f.prix_euros, f.categorie_prix, f.tendance_prix,
       f.rang_national, f.rang_region, s.latitude, s.longitude, f.date_prix
FROM fact f JOIN dim_stations s ON f.station_id = s.station_id
WHERE f.carburant_nom = '{PRODUCT}'
  AND f.date_prix = (SELECT max(date_prix) FROM fact WHERE carburant_nom = '{PRODUCT}')
  AND lower(s.ville) LIKE '%' || lower('{CITY}') || '%'"""


def _selection(spark, d):
    return D.search_selection(stored.fact(spark, d), stored.mart(spark, d, "dim_stations"), PRODUCT, city=CITY)


@register("qry_cheapest", sql(f"""
SELECT * FROM cheapest WHERE carburant_nom = '{PRODUCT}' ORDER BY rang_national, station_id LIMIT 20""", "cheapest"))
def q_qry_cheapest(spark, d):
    """QRY1: cheapest stations for a product, first n."""
    return neutral(D.cheapest_stations(stored.mart(spark, d, "rpt_stations_moins_cheres"), PRODUCT, n=20))


@register("qry_regional_latest", sql("SELECT * FROM regional WHERE is_latest", "regional"))
def q_qry_regional(spark, d):
    """QRY2: latest regional prices."""
    return D.regional_latest(stored.mart(spark, d, "rpt_prix_moyen_region"))


@register("qry_products", sql("SELECT DISTINCT carburant_nom FROM dim_products WHERE carburant_nom IS NOT NULL",
                              "dim_products"))
def q_qry_products(spark, d):
    """QRY3 / SRT5: ordered product list."""
    return D.products(stored.mart(spark, d, "dim_produits"))


@register("qry_search", sql(f"{_SEARCH} ORDER BY f.prix_euros, f.station_id, f.carburant_id NULLS LAST LIMIT 500",
                            "fact", "dim_stations"))
def q_qry_search(spark, d):
    """QRY4: search by city substring for one product on its latest day (JOI12, PRJ32, SRT3)."""
    return neutral(D.search_stations(_selection(spark, d)))


@register("qry_kpis", sql(f"""
SELECT min(prix_euros) AS prix_min, max(prix_euros) AS prix_max, {O.xavg('prix_euros')} AS prix_moyen,
       count(*) AS nb_stations FROM ({_SEARCH}) s""", "fact", "dim_stations"))
def q_qry_kpis(spark, d):
    """QRY5 / AGG19: KPIs of the selection."""
    return D.selection_kpis(_selection(spark, d))


@register("qry_map_points", sql(f"SELECT * FROM ({_SEARCH}) s WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
                                "fact", "dim_stations"))
def q_qry_map(spark, d):
    """QRY6: selection rows with coordinates."""
    return neutral(D.map_points(_selection(spark, d)))


@register("qry_cities", sql(f"""
SELECT ville, count(*) AS nb_stations FROM dim_stations WHERE code_departement = '{DEPT}'
GROUP BY ville ORDER BY nb_stations DESC, ville LIMIT 50""", "dim_stations"))
def q_qry_cities(spark, d):
    """QRY7 / AGG15: cities of a department, top 50."""
    return D.cities_top(stored.mart(spark, d, "dim_stations"), DEPT)


@register("qry_product_distribution", sql(f"""
SELECT f.carburant_nom, count(*) AS nb_prix, count(DISTINCT f.station_id) AS nb_stations,
       min(f.prix_euros) AS prix_min, max(f.prix_euros) AS prix_max, {O.xavg('f.prix_euros')} AS prix_moyen
FROM fact f JOIN dim_stations s ON f.station_id = s.station_id
WHERE s.code_departement = '{DEPT}' GROUP BY f.carburant_nom""", "fact", "dim_stations"))
def q_qry_distribution(spark, d):
    """QRY8 / AGG16."""
    return D.product_distribution(stored.fact(spark, d), stored.mart(spark, d, "dim_stations"), DEPT)


@register("qry_product_dates", sql(f"""
SELECT f.carburant_nom, min(f.date_prix) AS date_min, max(f.date_prix) AS date_max,
       count(DISTINCT f.date_prix) AS nb_jours
FROM fact f JOIN dim_stations s ON f.station_id = s.station_id
WHERE s.code_departement = '{DEPT}' GROUP BY f.carburant_nom""", "fact", "dim_stations"))
def q_qry_dates(spark, d):
    """QRY9 / AGG17."""
    return D.product_date_range(stored.fact(spark, d), stored.mart(spark, d, "dim_stations"), DEPT)


@register("qry_latest_dates", sql("""
SELECT carburant_nom, max(date_prix) AS max_date, (SELECT max(date_prix) FROM fact) AS global_max_date,
       count(*) AS nb_rows FROM fact GROUP BY carburant_nom""", "fact"))
def q_qry_latest(spark, d):
    """QRY10 / AGG18."""
    return D.latest_dates(stored.fact(spark, d))


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@register("qry_table_counts", sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES)))
def q_qry_tables(spark, d):
    """QRY11 / SRC14: row counts per table."""
    return D.table_counts(spark, {t: A.read_table(spark, d, t) for t in _TABLES})


# ---------------------------------------------------------------------------
# Weekly report, reference-compatible mode (S13) on the long line-item series
# ---------------------------------------------------------------------------
def _li_weekly_input(spark, d):
    from stationlens.plans.catalog import _li_daily
    b = EventsBuild(spark, d)
    reg = b.enriched.select(F.col("station_id").alias("_sid"), "region")
    li = _li_daily(spark, d)
    return li.join(reg, li["station_id"] == reg["_sid"], "left").drop("_sid")


cte("li_wf", ("li_daily", "enriched"), """
SELECT d.station_id, d.carburant_nom, e.region, d.date_prix, d.prix_euros
FROM li_daily d LEFT JOIN enriched e ON d.station_id = e.station_id""")
cte("li_cal", ("li_daily",), O.calendar_select(
    "(SELECT CAST(unnest(generate_series(min(date_prix), max(date_prix), INTERVAL 1 DAY)) AS DATE) AS d FROM li_daily)"))
cte("weekly_compat", ("li_wf", "li_cal"), f"""
SELECT v.annee, v.semaine, v.debut_semaine, v.fin_semaine, v.carburant_nom,
       {rnd('v.m', 3)} AS prix_moyen_national, {rnd('v.mn', 3)} AS prix_min_national,
       {rnd('v.mx', 3)} AS prix_max_national, {rnd('v.med', 3)} AS prix_median_national,
       {rnd('v.sd', 4)} AS prix_ecart_type, v.nb_stations, v.nb_observations,
       {O._var('prix_semaine_precedente', 'variation_hebdo', 'variation_hebdo_pct')},
       {O._var('prix_mois_precedent', 'variation_mensuelle', 'variation_mensuelle_pct')},
       {O._var('prix_annee_precedente', 'variation_annuelle', 'variation_annuelle_pct')},
       {O.trend_sql(O._WOW, 3, 1, O._WEEKLY_LABELS)} AS tendance_hebdo,
       {O._PIVOT_OUT},
       {O._SPREAD} AS ecart_regional_max
FROM (SELECT *, lag(m, 1) OVER w AS prix_semaine_precedente, lag(m, 4) OVER w AS prix_mois_precedent,
             lag(m, 52) OVER w AS prix_annee_precedente
      FROM (SELECT c.annee, c.semaine_annee AS semaine, c.debut_semaine, c.fin_semaine, f.carburant_nom,
                   {O.xavg('f.prix_euros')} AS m, min(f.prix_euros) AS mn, max(f.prix_euros) AS mx,
                   quantile_cont(CAST(f.prix_euros AS DOUBLE), 0.5) AS med, stddev_samp(f.prix_euros) AS sd,
                   count(DISTINCT f.station_id) AS nb_stations, count(*) AS nb_observations
            FROM li_wf f JOIN li_cal c ON f.date_prix = c.date_day
            GROUP BY c.annee, c.semaine_annee, c.debut_semaine, c.fin_semaine, f.carburant_nom) n
      WINDOW w AS (PARTITION BY carburant_nom ORDER BY debut_semaine, annee)) v
LEFT JOIN (SELECT debut_semaine AS ws, carburant_nom,
       {O._PIVOT}
      FROM (SELECT c.annee, c.semaine_annee, c.debut_semaine, f.region, f.carburant_nom,
                   {O.xavg('f.prix_euros')} AS ravg
            FROM li_wf f JOIN li_cal c ON f.date_prix = c.date_day
            GROUP BY 1, 2, 3, 4, 5) x
      GROUP BY annee, semaine_annee, debut_semaine, carburant_nom) r
  ON v.debut_semaine = r.ws AND v.carburant_nom = r.carburant_nom""")


@register("weekly_report_compat", sql("SELECT * FROM weekly_compat", "weekly_compat"))
def q_weekly_compat(spark, d):
    """MOD15 compat (S13): calendar-year x ISO-week grouping through the calendar (JOI5),
    pivot joined on week start only -- New-Year weeks fan out as in the reference."""
    from stationlens.operators.explode import calendar_span
    from stationlens.operators.reports import weekly
    from stationlens.operators.series import valid_observations
    from stationlens.plans.catalog import li_prices
    days = calendar_span(valid_observations(li_prices(spark, d)), "date_prix")
    return weekly(_li_weekly_input(spark, d), A.AS_OF_LINEITEM, fuel.WEEKLY_PIVOT_REGIONS, weeks=None,
                  compat=True, dim_date=days)


cte("weekly_li", ("li_wf",), O.CTES["weekly"][1].replace("FROM fact", "FROM li_wf")
    .replace(f"WHERE date_prix >= {O.EV_DAY} - 84", ""))


@register("weekly_report_li", sql("SELECT * FROM weekly_li", "weekly_li"))
def q_weekly_li(spark, d):
    """MOD15 fixed mode on the line-item series: ISO-week grouping, New-Year weeks whole."""
    from stationlens.operators.reports import weekly
    return weekly(_li_weekly_input(spark, d), A.AS_OF_LINEITEM, fuel.WEEKLY_PIVOT_REGIONS, weeks=None)


STALE_HOURS = 24


@register("dq_stale_rows", sql(f"""
SELECT count(*) FILTER (WHERE date_maj < {O.EV_ASOF} - INTERVAL {STALE_HOURS} HOUR) AS stale_records
FROM stg_prix""", "stg_prix"))
def q_dq_stale(spark, d):
    """AGG20 / UDF5: stale-row count (older than n hours before as-of)."""
    from stationlens.operators.anomalies import stale_count
    return stale_count(EventsBuild(spark, d).prices, "date_maj", A.AS_OF_EVENTS, STALE_HOURS)


@register("dq_product_ids", sql("""
SELECT p.carburant_nom, p.carburant_id AS feed_id, s.carburant_id AS reference_id
FROM (SELECT DISTINCT carburant_nom, carburant_id FROM stg_prix) p
JOIN seed s ON upper(trim(p.carburant_nom)) = upper(trim(s.carburant_nom))
WHERE p.carburant_id IS DISTINCT FROM s.carburant_id""", "stg_prix", "seed"))
def q_dq_product_ids(spark, d):
    """S16 / DQ: feed product ids that differ from the reference table's ids."""
    return Q.product_id_mismatch(EventsBuild(spark, d).prices, fuel.product_seed(spark))


# ---------------------------------------------------------------------------
# Feed flattening and explodes (SRC2-5) over nested rows
# ---------------------------------------------------------------------------

_FEED_STATIONS = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS station_id, CAST(s_nationkey * 1000 AS VARCHAR) AS latitude,
       if(s_acctbal > 0, CAST(s_suppkey AS VARCHAR), NULL) AS longitude,
       lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS cp, if(s_acctbal > 5000, 'R', NULL) AS pop,
       if(s_acctbal > 0, s_name, '') AS adresse, n_name AS ville,
       if(s_acctbal >= 2000, 'Lavage,Boutique ' || s_nationkey, '') AS services,
       if(s_acctbal > 5000, '1', '') AS automate_24_24,
       if(s_acctbal > 1000, 'Lundi::08.00-12.00;14.00-|Dimanche:1:', '') AS horaires_json, {O.EV_ASOF} AS _loaded_at
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


@register("feed_stations", sql(_FEED_STATIONS))
def q_feed_stations(spark, d):
    """SRC2 + SRC5: nested station rows flattened; missing nodes give empty texts."""
    from stationlens.sources.feed import flatten_stations
    return flatten_stations(A.feed_rows(spark, d), A.AS_OF_EVENTS)


@register("feed_prices", sql(f"""
SELECT CAST(s_suppkey AS VARCHAR) AS station_id, x.n AS carburant_nom, x.i AS carburant_id, x.v AS valeur, x.m AS maj,
       {O.EV_ASOF} AS _loaded_at
FROM supplier JOIN nation ON s_nationkey = n_nationkey,
     LATERAL (SELECT 'Gazole' AS n, '1' AS i, CAST(s_acctbal AS VARCHAR) AS v, '2024-01-01 08:00:00' AS m
              UNION ALL SELECT n_name, NULL, '', NULL) x
WHERE s_acctbal > 0"""))
def q_feed_prices(spark, d):
    """SRC3: a row for each price child; stations without prices give none."""
    from stationlens.sources.feed import explode_prices
    return explode_prices(A.feed_rows(spark, d), A.AS_OF_EVENTS)


@register("feed_shortages", sql(f"""
SELECT CAST(o_custkey AS VARCHAR) AS station_id, if(o_orderstatus = 'O', o_orderpriority, NULL) AS carburant_nom,
       if(o_orderstatus = 'O', substr(o_orderpriority, 1, 1), NULL) AS carburant_id,
       if(o_orderstatus = 'O', CAST(o_orderdate AS VARCHAR), NULL) AS debut, CAST(NULL AS VARCHAR) AS fin,
       if(o_orderstatus = 'O', 'temporaire', NULL) AS type, {O.EV_ASOF} AS _loaded_at
FROM orders WHERE o_orderstatus <> 'F'"""))
def q_feed_shortages(spark, d):
    """SRC4: a row for each shortage child, also an empty one."""
    from stationlens.sources.feed import explode_shortages
    return explode_shortages(A.feed_shortage_rows(spark, d), A.AS_OF_EVENTS)


# ---------------------------------------------------------------------------
# Stored tables (SRC6-SRC9, SRC11-SRC14, AGG12, OBS1, OBS3) and the feed as XML (SRC1, SRC5)
# ---------------------------------------------------------------------------

@register("stored_fact", sql("SELECT * FROM fact", "fact"))
def q_stored_fact(spark, d):
    """SRC11-SRC13: the fact as published (month folders, ranges by day, product and station), read back."""
    return stored.fact(spark, d).drop("mois_prix")


_STORED = {"stg_prix": "stg_prix", "dim_stations": "dim_stations", "dim_produits": "dim_products", "dim_regions": "dim_regions",
           "dim_date": "date_keys", "fct_prix_produits": "fact", "rpt_stations_moins_cheres": "cheapest", "rpt_prix_moyen_region": "regional",
           "rpt_evolution_prix_hebdo": "weekly", "analysis_price_anomalies": "anomalies"}
_RANGED = ("fct_prix_produits", "rpt_prix_moyen_region")


def _counts(names) -> list[str]:
    day = lambda t, f: f"CAST({f}(date_prix) AS VARCHAR)" if t in _RANGED else "CAST(NULL AS VARCHAR)"
    return [f"SELECT '{t}' AS table_name, count(*) AS row_count, {day(t, 'min')} AS least, {day(t, 'max')} AS greatest FROM {_STORED[t]}" for t in names]


@register("stored_counts", sql(" UNION ALL ".join(_counts(PUBLISHED)), *_STORED.values()))
def q_stored_counts(spark, d):
    """SRC14 / QRY11 / AGG12: row counts and day ranges of the published tables, from their manifests."""
    out = stored.models(spark, d).out
    return tables.table_facts(spark, {t: f"{out}/{t}" for t in PUBLISHED}, "date_prix")


@register("monitored_tables", sql(f"SELECT table_name, {O.EV_ASOF} AS run_at, row_count FROM ({' UNION ALL '.join(_counts(MONITORED_TABLES))})",
                                  *[_STORED[t] for t in MONITORED_TABLES]))
def q_monitored(spark, d):
    """OBS3: the monitored tables' row counts of a build."""
    return monitored_counts(spark, stored.models(spark, d).out, A.AS_OF_EVENTS)


@register("monitor_states", sql(_zsql(_VOL, "events", "1 day").replace("metric", "row_count")))
def q_monitor_states(spark, d):
    """OBS1 kept up by loads: each load adds its buckets to the published state, the monitor reads the state."""
    ev, at = A.read_table(spark, d, "events"), stored.folder(spark, "state")
    cut = ts_literal(SNAP_CUT)
    tables.publish(bucket_state(ev.filter(F.col("ts") < cut), "ts"), at)
    tables.publish(merge_states(tables.read_table(spark, at), bucket_state(ev.filter(F.col("ts") >= cut), "ts")), at)
    return _round_monitor(state_volume_anomalies(tables.read_table(spark, at), table="events"), "row_count")


def _feed_files(spark, d) -> str:
    """The feed as XML files: stations with prices, one element an order with its shortage (a NULL child is
    not written), and a broken element for each supplier with a negative balance."""
    at = stored.folder(spark, "feed")
    FEED.write_feed(A.feed_rows(spark, d), f"{at}/stations")
    FEED.write_feed(A.feed_shortage_rows(spark, d), f"{at}/shortages")
    broken = A.read_table(spark, d, "supplier").filter("s_acctbal < 0").select(
        F.format_string('<pdv id="%s" cp="00000"><adresse>a & b</adresse></pdv>', F.col("s_suppkey").cast("string")))
    broken.write.text(f"{at}/broken")
    return f"{at}/*"


@register("feed_roundtrip", sql(_FEED_STATIONS))
def q_feed_roundtrip(spark, d):
    """SRC1, SRC2, SRC5: stations written as XML and scanned back, broken elements left out."""
    scan = FEED.read_feed(spark, _feed_files(spark, d), keep_malformed=True)
    return FEED.flatten_stations(FEED.well_formed(scan).filter(F.col("_cp").isNotNull()), A.AS_OF_EVENTS)


def _ingested(spark, d) -> str:
    """The raw tables of an ingestion of the feed files."""
    raw = stored.folder(spark, "raw")
    RAW.ingest(spark, _feed_files(spark, d), raw, dt.datetime.fromisoformat(A.AS_OF_EVENTS))
    return raw


@register("feed_rejected", sql(f"""
SELECT '<pdv id="' || s_suppkey || '" cp="00000"><adresse>a & b</adresse></pdv>' AS element, {O.EV_ASOF} AS _loaded_at
FROM supplier WHERE s_acctbal < 0"""))
def q_feed_rejected(spark, d):
    """SRC1: the malformed elements of the feed, as an ingestion keeps them."""
    return tables.read_table(spark, f"{_ingested(spark, d)}/raw_rejected")


@register("ingest_run", sql("""
SELECT 'raw_stations' AS table_name, (SELECT count(*) FROM supplier) + (SELECT count(*) FROM orders) AS row_count, 'SUCCESS' AS status
UNION ALL SELECT 'raw_prix', 2 * count(*), 'SUCCESS' FROM supplier WHERE s_acctbal > 0
UNION ALL SELECT 'raw_ruptures', count(*), 'SUCCESS' FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'raw_rejected', count(*), 'SUCCESS' FROM supplier WHERE s_acctbal < 0"""))
def q_ingest_run(spark, d):
    """SRC1, SRC5-SRC8: an ingestion of the feed files: published raw tables with their counts, run log."""
    raw = _ingested(spark, d)
    status = RAW.read_raw(spark, f"{raw}/{RAW.RUN_LOG}", RAW.RAW_RUN_LOG).select(F.max("status")).scalar()
    counts = tables.table_facts(spark, {t: f"{raw}/{t}" for t in RAW.RAW_TABLES})
    return counts.select("table_name", "row_count", status.alias("status"))
