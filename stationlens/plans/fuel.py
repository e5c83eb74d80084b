"""Fuel-price domain: fixed reference values and the staging models (MOD1-5).

Staging functions take the all-string raw tables and return typed DataFrames.
They are lazy projections/filters/generators: no shuffle except the DISTINCT of
the services unpivot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlens.functions.cleaning import (
    blank, label_map, norm, null_flag, ongoing_flag, prefix_code, range_flag, safe_decimal,
    safe_ts, scaled_coordinate, to_day, truthy,
)
from stationlens.functions.labels import classify, map_code
from stationlens.operators.explode import explode_list, explode_periods

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical output)
# ---------------------------------------------------------------------------

# Station type code -> label, default.
STATION_TYPES = {"R": "Route", "A": "Autoroute"}
STATION_TYPE_DEFAULT = "Inconnu"

# Spellings of "true" for the 24/24 automaton flag (compared lower-case).
TRUE_SPELLINGS = ("oui", "1")

# Department prefixes whose extended code keeps three characters.
EXTENDED_DEPARTMENT_PREFIXES = ("97", "98")

# Plausible price range (euros per litre); outside = suspect.
PRICE_MIN, PRICE_MAX = 0.5, 5.0

# Service name -> category: ordered substring rules, first match wins.
SERVICE_RULES = (
    ("LAVAGE", "Lavage"),
    ("GONFLAGE", "Entretien"),
    ("VIDANGE", "Entretien"),
    ("BOUTIQUE", "Commerce"),
    ("RESTAURATION", "Restauration"),
    ("RELAIS", "Commerce"),
    ("TOILETTES", "Commodités"),
    ("WC", "Commodités"),
    ("DOUCHES", "Commodités"),
    ("WIFI", "Commodités"),
    ("BORNE", "Recharge"),
    ("ELECTRIQUE", "Recharge"),
    ("GPL", "Carburant"),
    ("GNV", "Carburant"),
    ("AUTOMATE", "Paiement"),
    ("CB", "Paiement"),
    ("DAB", "Paiement"),
    ("PISTE", "Entretien"),
)
SERVICE_DEFAULT = "Autre"
SERVICE_CATEGORIES = ("Lavage", "Entretien", "Commerce", "Restauration", "Commodités",
                      "Recharge", "Carburant", "Paiement", "Autre")

# Department code -> region (membership lists, tested in this order), then prefix rule.
REGION_GROUPS = (
    ("Île-de-France", ("75", "77", "78", "91", "92", "93", "94", "95")),
    ("Grand Est", ("08", "10", "51", "52", "54", "55", "57", "67", "68", "88")),
    ("Hauts-de-France", ("02", "59", "60", "62", "80")),
    ("Normandie", ("14", "27", "50", "61", "76")),
    ("Bretagne", ("22", "29", "35", "56")),
    ("Centre-Val de Loire", ("18", "28", "36", "37", "41", "45")),
    ("Pays de la Loire", ("44", "49", "53", "72", "85")),
    ("Nouvelle-Aquitaine", ("16", "17", "19", "23", "24", "33", "40", "47", "64", "79", "86", "87")),
    ("Occitanie", ("09", "11", "12", "30", "31", "32", "34", "46", "48", "65", "66", "81", "82")),
    ("Auvergne-Rhône-Alpes", ("01", "03", "07", "15", "26", "38", "42", "43", "63", "69", "73", "74")),
    ("Provence-Alpes-Côte d'Azur", ("04", "05", "06", "13", "83", "84")),
    ("Corse", ("2A", "2B", "20")),
    ("Bourgogne-Franche-Comté", ("21", "25", "39", "58", "70", "71", "89", "90")),
)
REGION_PREFIX_RULES = (("97", "DOM-TOM"),)
REGION_DEFAULT = "Autre"

# Region -> short code (default 'AUT') and chief town (default NULL).
REGION_CODES = {
    "Île-de-France": "IDF", "Grand Est": "GES", "Hauts-de-France": "HDF", "Normandie": "NOR",
    "Bretagne": "BRE", "Centre-Val de Loire": "CVL", "Pays de la Loire": "PDL",
    "Nouvelle-Aquitaine": "NAQ", "Occitanie": "OCC", "Auvergne-Rhône-Alpes": "ARA",
    "Provence-Alpes-Côte d'Azur": "PAC", "Corse": "COR", "Bourgogne-Franche-Comté": "BFC",
    "DOM-TOM": "DOM",
}
REGION_CODE_DEFAULT = "AUT"
REGION_CHIEF_TOWNS = {
    "Île-de-France": "Paris", "Grand Est": "Strasbourg", "Hauts-de-France": "Lille",
    "Normandie": "Rouen", "Bretagne": "Rennes", "Centre-Val de Loire": "Orléans",
    "Pays de la Loire": "Nantes", "Nouvelle-Aquitaine": "Bordeaux", "Occitanie": "Toulouse",
    "Auvergne-Rhône-Alpes": "Lyon", "Provence-Alpes-Côte d'Azur": "Marseille",
    "Corse": "Ajaccio", "Bourgogne-Franche-Comté": "Dijon",
}

# Regions broken out as columns in the weekly report: output column -> region.
WEEKLY_PIVOT_REGIONS = {
    "prix_ile_de_france": "Île-de-France",
    "prix_paca": "Provence-Alpes-Côte d'Azur",
    "prix_auvergne_rhone_alpes": "Auvergne-Rhône-Alpes",
    "prix_nouvelle_aquitaine": "Nouvelle-Aquitaine",
    "prix_occitanie": "Occitanie",
}

# Product names accepted by the feed check.
PRODUCT_NAMES = ("GAZOLE", "SP95", "SP98", "E10", "E85", "GPLC")

# Product reference table (seed): id, name, full name, category, petrol, diesel, bio, bio %, text.
PRODUCT_SEED_SCHEMA = T.StructType([
    T.StructField("carburant_id", T.StringType()),
    T.StructField("carburant_nom", T.StringType()),
    T.StructField("carburant_nom_complet", T.StringType()),
    T.StructField("categorie", T.StringType()),
    T.StructField("est_essence", T.BooleanType()),
    T.StructField("est_diesel", T.BooleanType()),
    T.StructField("est_bio", T.BooleanType()),
    T.StructField("taux_bio_pct", T.IntegerType()),
    T.StructField("description", T.StringType()),
])
PRODUCT_SEED = (
    ("1", "GAZOLE", "Gazole", "Diesel", False, True, False, 0, "Carburant diesel standard pour moteurs diesel"),
    ("2", "SP95", "Sans Plomb 95", "Essence", True, False, False, 0, "Essence sans plomb avec indice d'octane 95"),
    ("3", "SP98", "Sans Plomb 98", "Essence", True, False, False, 0, "Essence sans plomb premium avec indice d'octane 98"),
    ("4", "E10", "SP95-E10", "Essence", True, False, True, 10, "Essence avec 10% de bioéthanol"),
    ("5", "E85", "Superéthanol E85", "Biocarburant", True, False, True, 85, "Biocarburant avec 85% de bioéthanol"),
    ("6", "GPLC", "GPL Carburant", "GPL", False, False, False, 0, "Gaz de pétrole liquéfié pour véhicules équipés"),
)
PRODUCT_CATEGORIES = ("Essence", "Diesel", "Biocarburant", "GPL")

# Shortage timestamp pattern (explicit, unlike price timestamps which auto-detect).
SHORTAGE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


# ---------------------------------------------------------------------------
# Staging models
# ---------------------------------------------------------------------------

def clean_stations(raw: DataFrame) -> DataFrame:
    """MOD1: typed station rows; NULL ids dropped."""
    cp = norm("cp")
    return raw.filter(F.col("station_id").isNotNull()).select(
        "station_id",
        scaled_coordinate("latitude").alias("latitude"),
        scaled_coordinate("longitude").alias("longitude"),
        cp.alias("code_postal"),
        prefix_code(cp, 2).alias("code_departement"),
        prefix_code(cp, 2, EXTENDED_DEPARTMENT_PREFIXES, 3).alias("code_departement_extended"),
        norm("ville").alias("ville"),
        F.trim("adresse").alias("adresse"),
        label_map(F.upper("pop"), STATION_TYPES, STATION_TYPE_DEFAULT).alias("type_station"),
        truthy("automate_24_24", TRUE_SPELLINGS).alias("is_automate_24_24"),
        F.col("services").alias("services_raw"),
        F.col("horaires_json").alias("horaires_raw"),
        "_loaded_at",
    )


def keep_latest_station(stations: DataFrame) -> DataFrame:
    """S35 option: one row per station id, the most recently loaded (ties: greatest
    row). The reference never deduplicates -- only tests uniqueness -- so this is an
    opt-in step before enrichment."""
    from stationlens.operators.history import latest_per_key
    return latest_per_key(stations, ["station_id"], ["_loaded_at", "code_postal", "adresse"])


def clean_prices(raw: DataFrame, lo: float = PRICE_MIN, hi: float = PRICE_MAX) -> DataFrame:
    """MOD2: typed price rows with invalid / suspect flags."""
    price = safe_decimal("valeur", 10, 3)
    ts = safe_ts("maj")
    return (raw.filter(F.col("station_id").isNotNull() & F.col("carburant_nom").isNotNull()
                       & F.col("valeur").isNotNull())
            .select(
                "station_id",
                norm("carburant_nom").alias("carburant_nom"),
                F.trim("carburant_id").alias("carburant_id"),
                price.alias("prix_euros"),
                ts.alias("date_maj"),
                to_day(ts).alias("date_prix"),
                null_flag(price).alias("is_prix_invalide"),
                range_flag(price, lo, hi).alias("is_prix_suspect"),
                "_loaded_at",
            ))


def station_services(raw_stations: DataFrame) -> DataFrame:
    """MOD3: station x service, categorised by the ordered rules, distinct."""
    items = explode_list(raw_stations, "services", ",", "_svc", ["station_id", "_loaded_at"])
    named = items.select("station_id", F.upper("_svc").alias("service_nom"), "_loaded_at")
    return (named.select("station_id", "service_nom",
                         classify("service_nom", SERVICE_RULES, SERVICE_DEFAULT).alias("service_categorie"),
                         "_loaded_at")
            .distinct())


def opening_hours(raw_stations: DataFrame) -> DataFrame:
    """MOD4: station x day with up to two opening periods."""
    return explode_periods(raw_stations, "horaires_json", ["station_id", "_loaded_at"]).select(
        "station_id", "jour_numero", "jour_nom", "is_ferme", "ouverture_1", "fermeture_1",
        "ouverture_2", "fermeture_2", "horaires_raw", "_loaded_at")


def shortages(raw: DataFrame) -> DataFrame:
    """MOD5: typed shortage rows; open-ended when the end is missing."""
    return raw.filter(F.col("station_id").isNotNull()).select(
        "station_id",
        norm("carburant_nom").alias("carburant_nom"),
        F.trim("carburant_id").alias("carburant_id"),
        safe_ts("debut", SHORTAGE_TS_FORMAT).alias("date_debut"),
        safe_ts("fin", SHORTAGE_TS_FORMAT).alias("date_fin"),
        norm("type").alias("type_rupture"),
        ongoing_flag("fin").alias("is_en_cours"),
        "_loaded_at",
    )


def region_of(department) -> F.Column:
    """PRJ13: department code (column name or Column) -> region."""
    return map_code(department, REGION_GROUPS, REGION_PREFIX_RULES, REGION_DEFAULT)


def product_seed(spark) -> DataFrame:
    """SRC9 (in-memory form): the 6-row product reference table."""
    return spark.createDataFrame(list(PRODUCT_SEED), PRODUCT_SEED_SCHEMA)


__all__ = [
    "clean_stations", "clean_prices", "station_services", "opening_hours", "shortages",
    "region_of", "product_seed", "blank",
]
