"""Adapters: the driver's test tables in the roles of the fuel feed's raw tables.

There is no fuel data under the test folders, so each raw table is derived from a
test table by a plain projection (identical text lives in the oracle SQL,
``stationlens.plans.oracle``). Every derived table grows with the scale factor.

* raw prices    <- events   (entity = user_id, product = event_type, value, ts);
  values above 480 are spelt 'n/a' (invalid), values below 0.05 get an unparseable
  update time -- data-dependent edge rows, not a sample.
* raw stations  <- supplier x nation (department = 2-digit code derived from the
  nation, 97 for the last one); services / hours strings assembled from fixed
  lists chosen by the account balance.
* raw shortages <- orders (entity = o_custkey; open when status 'O' or 'P').
* long series   <- lineitem x part (entity = l_suppkey, product = p_type); 600+ series
  longer than 31 days for the 30-row lag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.operators.enrich import ts_literal

AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_LINEITEM = "2001-11-05 00:00:00"
EVENT_PRICE_BOUNDS = (0.5, 200.0)
LINEITEM_PRICE_BOUNDS = (1000.0, 100000.0)

# Fixed strings for the assembled raw station fields (one set per balance band).
SERVICES_HIGH = "Lavage automatique,Boutique alimentaire,Toilettes publiques,Boutique alimentaire,Boutique lavage"
SERVICES_MID = "Station de gonflage,Vente de gaz domestique (GPL),,DAB (Distributeur automatique de billets)"
SERVICES_LOW = "Relais colis, Wifi ,Bornes électriques,Automate CB 24/24,Piste poids lourds,Restauration sur place"
HOURS_HIGH = ("Lundi::08.00-12.00;14.00-20.00|Mardi::07.00-21.00|Mercredi::07.00-21.00|"
              "Jeudi::07.00-21.00|Vendredi::07.00-21.00|Samedi::08.00-19.00|Dimanche:1:")
HOURS_LOW = ("Lundi::06.00-22.00|Mardi::06.00-22.00|Mercredi::|Jeudi::06.00-22.00|"
             "Vendredi::06.00-22.00|Samedi::06.00-22.00|Dimanche::06.00-22.00|Funday::01.00-02.00")


# Event type -> product name / product id in the feed. Names carry case and blanks
# that staging normalises; one id differs from the reference table's (S16), one type
# has no reference row at all.
EVENT_PRODUCT_NAMES = {"click": "Gazole", "view": "sp95", "purchase": "SP98 ", "signup": "E10"}
EVENT_PRODUCT_IDS = {"click": "1", "view": "2", "purchase": "3", "signup": "44"}
OTHER_PRODUCT_ID = "9"


def _case(col, mapping, default):
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(default)


# Declared schemas of the driver's test tables (TESTDATA.md / FIXTURES.md section 6): reading
# with an explicit schema skips per-read schema inference from the Parquet footers.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, read with its declared schema when known."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


_read = read_table


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    v = F.col("value")
    return ev.select(
        F.col("user_id").cast("string").alias("station_id"),
        _case(F.col("event_type"), EVENT_PRODUCT_NAMES, F.col("event_type")).alias("carburant_nom"),
        _case(F.col("event_type"), EVENT_PRODUCT_IDS, F.lit(OTHER_PRODUCT_ID)).alias("carburant_id"),
        F.when(v > 480, F.lit("n/a")).otherwise(v.cast("string")).alias("valeur"),
        F.when(v < 0.05, F.lit("not a date")).otherwise(F.col("ts").cast("string")).alias("maj"),
        ts_literal(AS_OF_EVENTS).alias("_loaded_at"),
    )


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    n = _read(spark, sf_dir, "nation")
    bal = F.col("s_acctbal")
    j = s.join(n, s["s_nationkey"] == n["n_nationkey"], "inner")
    dept = F.lpad((F.col("s_nationkey") * 4 + 1).cast("string"), 2, "0")
    return j.select(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.when(bal < 0, F.lit("x")).otherwise(
            (F.round(bal * 100) + F.lit(4000000)).cast("bigint").cast("string")).alias("latitude"),
        (F.col("s_nationkey") * 40000 - 500000).cast("string").alias("longitude"),
        F.concat(dept, F.lpad(F.col("s_suppkey").cast("string"), 3, "0")).alias("cp"),
        F.when(bal > 5000, F.lit("r")).when(bal > 0, F.lit("A")).alias("pop"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")).alias("adresse"),
        F.lower("n_name").alias("ville"),
        F.when(bal > 6000, F.lit(SERVICES_HIGH)).when(bal > 2000, F.lit(SERVICES_MID))
        .when(bal > 0, F.lit(SERVICES_LOW)).otherwise(F.lit("")).alias("services"),
        F.when(bal > 8000, F.lit("Oui")).when(bal > 4000, F.lit("1"))
        .when(bal > 0, F.lit("")).alias("automate_24_24"),
        F.when(bal > 5000, F.lit(HOURS_HIGH)).when(bal > 0, F.lit(HOURS_LOW))
        .otherwise(F.lit("")).alias("horaires_json"),
        ts_literal(AS_OF_EVENTS).alias("_loaded_at"),
    )


def raw_shortages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("string")
    return o.select(
        F.col("o_custkey").cast("string").alias("station_id"),
        F.concat(F.lit(" "), F.lower(F.substring("o_orderpriority", 3, 100))).alias("carburant_nom"),
        F.substring("o_orderpriority", 1, 1).alias("carburant_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.replace(d, F.lit(" "), F.lit("T")))
        .otherwise(d).alias("debut"),
        F.when(F.col("o_orderstatus") == "O", F.lit(""))
        .when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .otherwise((F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS")).cast("string")).alias("fin"),
        F.when(F.col("o_totalprice") > 200000, F.lit("temporaire"))
        .otherwise(F.lit(" definitive ")).alias("type"),
        ts_literal(AS_OF_EVENTS).alias("_loaded_at"),
    )


def raw_line_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    p = _read(spark, sf_dir, "part")
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    return j.select(
        F.col("l_suppkey").cast("string").alias("station_id"),
        F.col("p_type").alias("carburant_nom"),
        F.substring("p_type", 1, 2).alias("carburant_id"),
        F.col("l_extendedprice").cast("string").alias("valeur"),
        F.col("l_shipdate").cast("string").alias("maj"),
        ts_literal(AS_OF_LINEITEM).alias("_loaded_at"),
    )


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested feed rows in the shape of the XML scan (sources.feed): one station per supplier, with
    missing, empty and NULL nodes by the account balance."""
    s, n = read_table(spark, sf_dir, "supplier"), read_table(spark, sf_dir, "nation")
    nodes = {
        "_id": "CAST(s_suppkey AS STRING)", "_latitude": "CAST(s_nationkey * 1000 AS STRING)",
        "_longitude": "CASE WHEN s_acctbal > 0 THEN CAST(s_suppkey AS STRING) END",
        "_cp": "lpad(CAST(s_suppkey AS STRING), 5, '0')", "_pop": "CASE WHEN s_acctbal > 5000 THEN 'R' END",
        "adresse": "CASE WHEN s_acctbal > 0 THEN s_name END", "ville": "n_name",
        "services": """CASE WHEN s_acctbal >= 0 THEN named_struct('service', CASE WHEN s_acctbal < 2000 THEN CAST(array() AS ARRAY<STRING>)
            ELSE array('Lavage', '', CAST(NULL AS STRING), concat('Boutique ', s_nationkey)) END) END""",
        "horaires": """CASE WHEN s_acctbal >= 0 THEN named_struct('_automate-24-24', CASE WHEN s_acctbal > 5000 THEN '1' END, 'jour',
            CASE WHEN s_acctbal > 1000 THEN array(
              named_struct('_nom', 'Lundi', '_ferme', CAST(NULL AS STRING), 'horaire', array(
                named_struct('_ouverture', '08.00', '_fermeture', '12.00'), named_struct('_ouverture', '14.00', '_fermeture', CAST(NULL AS STRING)))),
              named_struct('_nom', 'Dimanche', '_ferme', '1', 'horaire', NULL)) END) END""",
        "prix": """CASE WHEN s_acctbal > 0 THEN array(
              named_struct('_nom', 'Gazole', '_id', '1', '_valeur', CAST(s_acctbal AS STRING), '_maj', '2024-01-01 08:00:00'),
              named_struct('_nom', n_name, '_id', CAST(NULL AS STRING), '_valeur', '', '_maj', CAST(NULL AS STRING))) END""",
    }
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(*[F.expr(e).alias(c) for c, e in nodes.items()])


def feed_shortage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested feed rows with a shortage child for each order that is not finished, none otherwise."""
    child = """CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderstatus = 'P' THEN array(CAST(NULL AS STRUCT<_nom: STRING, _id: STRING, _debut: STRING, _fin: STRING, _type: STRING>))
        ELSE array(named_struct('_nom', o_orderpriority, '_id', substr(o_orderpriority, 1, 1), '_debut', CAST(o_orderdate AS STRING),
                                '_fin', CAST(NULL AS STRING), '_type', 'temporaire')) END"""
    return read_table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("_id"), F.expr(child).alias("rupture"))
