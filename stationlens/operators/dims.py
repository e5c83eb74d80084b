"""Star schema: entity, product and region dimensions and the price fact (MOD8-10, MOD12).

Join strategy: the calendar has a size fixed by construction (a date range) and is
broadcast explicitly. The product and region dimensions are looked up in the fact while they are small
(``with_dimension_key``): a shuffle on their few values would leave all but a few tasks idle; beyond a
measured size they are joined with salted keys. The entity dimension grows with the data; its key is
carried by the series, or its join is left to AQE.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlens.functions.labels import (
    TREND_DAILY, lookup, price_bucket, surrogate_key, trend_preset,
)
from stationlens.operators.enrich import sorted_distinct_list
from stationlens.operators.ranking import constants, with_position

ENTITY_COLUMNS = (
    "station_id", "latitude", "longitude", "code_postal", "code_departement", "region", "ville",
    "adresse", "type_station", "is_automate_24_24", "is_ouvert_7j_7", "nb_services",
    "services_list", "services_categories", "has_lavage", "has_restauration", "has_boutique",
    "has_borne_electrique", "has_gpl", "jours_ouverts_semaine", "heure_ouverture_min",
    "heure_fermeture_max", "nb_produits_disponibles", "derniere_maj_prix",
    "nb_ruptures_en_cours", "produits_en_rupture", "data_quality_score",
)


def entity_dim(enriched: DataFrame, key: str = "station_id") -> DataFrame:
    """MOD8: surrogate key + enriched attributes."""
    cols = [c for c in ENTITY_COLUMNS if c in enriched.columns]
    return enriched.select(surrogate_key(key).alias("station_key"), *cols,
                           F.col("_loaded_at").alias("loaded_at"))


def product_dim(prices: DataFrame, seed: DataFrame) -> DataFrame:
    """MOD9: products seen in the feed, completed from the reference table.

    Seed id wins over the feed id (reference behaviour); two feed ids for one name
    therefore give two rows with the same coalesced id (caught by the unique check).
    """
    seen = prices.select("carburant_nom", "carburant_id").distinct()
    s = seed.alias("s")
    j = seen.alias("p").join(s, F.upper(F.trim("p.carburant_nom")) == F.upper(F.trim("s.carburant_nom")),
                             "left")
    combined = j.select(
        F.coalesce("s.carburant_id", "p.carburant_id").alias("carburant_id"),
        F.coalesce("s.carburant_nom", "p.carburant_nom").alias("carburant_nom"),
        "s.carburant_nom_complet", "s.categorie", "s.est_essence", "s.est_diesel", "s.est_bio",
        "s.taux_bio_pct", "s.description")
    return combined.select(
        surrogate_key("carburant_id").alias("carburant_key"),
        "carburant_id", "carburant_nom",
        F.coalesce("carburant_nom_complet", "carburant_nom").alias("carburant_nom_complet"),
        F.coalesce("categorie", F.lit("Inconnu")).alias("categorie"),
        F.coalesce("est_essence", F.lit(False)).alias("est_essence"),
        F.coalesce("est_diesel", F.lit(False)).alias("est_diesel"),
        F.coalesce("est_bio", F.lit(False)).alias("est_bio"),
        F.coalesce("taux_bio_pct", F.lit(0)).cast("int").alias("taux_bio_pct"),
        "description")


def region_dim(enriched: DataFrame, codes: Mapping[str, str], code_default: str,
               chief_towns: Mapping[str, str], key: str = "station_id") -> DataFrame:
    """MOD10: one row per region that has at least one department code."""
    depts = (enriched.filter(F.col("code_departement").isNotNull())
             .select("code_departement", "region").distinct())
    dept_counts = depts.groupBy("region").agg(
        F.count_distinct("code_departement").alias("nb_departements"),
        sorted_distinct_list("code_departement").alias("departements_list"))
    station_counts = enriched.groupBy("region").agg(F.count_distinct(key).alias("nb_stations"))
    regions = depts.select("region").distinct()
    out = (regions.join(dept_counts, "region", "left")
           .join(station_counts, "region", "left"))
    return out.select(
        surrogate_key("region").alias("region_key"),
        lookup(F.col("region"), codes, code_default).alias("region_code"),
        F.col("region").alias("region_nom"),
        lookup(F.col("region"), chief_towns).alias("chef_lieu"),
        F.coalesce("nb_departements", F.lit(0)).cast("long").alias("nb_departements"),
        "departements_list",
        F.coalesce("nb_stations", F.lit(0)).cast("long").alias("nb_stations"))


#: A dimension of up to so many keys and bytes travels with the plan; a larger one is joined.
LOOKUP_KEYS, LOOKUP_BYTES = 50_000, 4 << 20
SALTS = 8
_ENTRY = T.StructType([T.StructField("at", T.StringType()), T.StructField("vs", T.ArrayType(T.StringType()))])


@dataclass(frozen=True)
class DimensionKeys:
    """key -> values of a dimension: the table, and its text (JSON) if it is small."""

    table: DataFrame  # _k, _vs
    value: str
    text: str | None
    n: int


def dimension_keys(dim: DataFrame, key: Column, value: str) -> DimensionKeys:
    """Measures a dimension by a small job that reads at most ``LOOKUP_KEYS`` + 1 keys."""
    lists = dim.select(key.cast("string").alias("_k"), F.col(value).cast("string").alias("_v")).filter(F.col("_k").isNotNull()) \
        .groupBy("_k").agg(F.sort_array(F.collect_list("_v")).alias("_vs"))
    rows = lists.limit(LOOKUP_KEYS + 1).collect()
    text = json.dumps([{"at": r["_k"], "vs": r["_vs"]} for r in rows]) if len(rows) <= LOOKUP_KEYS else ""
    small = len(rows) <= LOOKUP_KEYS and len(text) <= LOOKUP_BYTES
    return DimensionKeys(lists, value, text if small else None, len(rows))


def with_dimension_key(rows: DataFrame, at: Column, keys: DimensionKeys, spread: str) -> DataFrame:
    """Adds the value of the dimension row whose key equals ``at`` (NULL where there is none, a row
    for each where there are several, as a left join).

    A small dimension is a sorted constant array that each row searches by halves: the rows are not
    shuffled, on five products or fourteen regions least of all. A larger one is joined; hot keys are dealt
    over ``SALTS`` partitions by a hash of the column ``spread``, and the dimension is repeated for each
    salt."""
    value = keys.value
    if keys.text is not None:
        entries = sorted(json.loads(keys.text), key=lambda e: e["at"].encode("utf-8"))  # Spark's order of strings
        array = constants([json.dumps(e) for e in entries], _ENTRY)
        placed = rows.select("*", at.cast("string").alias("_at"))
        found = with_position(placed, "_at", [json.dumps(e["at"]) for e in entries], T.StringType(), "_n")
        hit = F.get(array, F.col("_n"))
        values = F.when(hit["at"] == F.col("_at"), hit["vs"])
        return found.select(*[F.col(f"`{c}`") for c in rows.columns], F.explode_outer(values).alias(value))
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    salted = keys.table.select("_k", "_vs", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt2"))
    joined = rows.select("*", at.cast("string").alias("_at"), salt.alias("_salt")).join(
        salted, (F.col("_at") == F.col("_k")) & (F.col("_salt") == F.col("_salt2")), "left")
    return joined.select("*", F.explode_outer("_vs").alias(value)).drop("_at", "_salt", "_salt2", "_k", "_vs")


FACT_MEASURES = (
    "prix_euros", "nb_updates_jour", "prix_veille", "variation_jour", "variation_jour_pct",
    "prix_semaine_precedente", "variation_semaine", "variation_semaine_pct",
    "prix_mois_precedent", "variation_mois", "variation_mois_pct",
    "rang_national", "rang_departement", "rang_region", "percentile_national",
)


def price_fact(series: DataFrame, dim_entity: DataFrame, dim_product: DataFrame,
               dim_date: DataFrame, dim_region: DataFrame, product_key: str = "id",
               trend_preset_=TREND_DAILY, keys: tuple[DimensionKeys, DimensionKeys] | None = None) -> DataFrame:
    """MOD12: daily series + dimension keys + percentile bucket and trend labels. ``keys``: of the products
    and the regions (see :func:`dimension_keys`), measured here if not given.

    ``product_key='id'`` joins the product dimension on the feed's product id (the
    reference behaviour); ``'name'`` joins on the normalised product name instead.
    """
    p = series.alias("p")
    # When the series already carries the entity key (price_series(entity_key=...),
    # from the same entity rows the dimension is built from), the entity join -- the
    # only one with a data-sized dimension -- is skipped: no shuffle of the series.
    key_in_series = "station_key" in series.columns
    ds = dim_entity.select("station_key", F.col("station_id").alias("_sid"))
    if product_key == "name":
        dc, pk = F.upper(F.trim("carburant_nom")), F.upper(F.trim(F.col("p.carburant_nom")))
    else:
        dc, pk = F.col("carburant_id"), F.col("p.carburant_id")
    dd = F.broadcast(dim_date.select("date_key", F.col("date_day").alias("_day")))
    j = p if key_in_series else p.join(ds, F.col("p.station_id") == ds["_sid"], "left")
    j = j.join(dd, F.col("p.date_prix") == dd["_day"], "left")
    j = j.select("p.*", *[c for c in ("station_key",) if not key_in_series], "date_key", pk.alias("_pk"))
    keys = keys or (dimension_keys(dim_product, dc, "carburant_key"), dimension_keys(dim_region, F.col("region_nom"), "region_key"))
    j = with_dimension_key(j, F.col("_pk"), keys[0], "station_id").drop("_pk")
    j = with_dimension_key(j, F.col("region"), keys[1], "station_id").alias("p")
    return j.select(
        surrogate_key("p.station_id", "p.carburant_nom", "p.date_prix").alias("prix_key"),
        F.col("p.station_key").alias("station_key"),
        "carburant_key", "date_key", "region_key",
        "p.station_id", "p.carburant_nom", "p.carburant_id", "p.date_prix",
        "p.code_departement", "p.region", "p.type_station",
        *[F.col(f"p.{m}") for m in FACT_MEASURES if m in series.columns],
        *[price_bucket(F.col("p.percentile_national")).alias("categorie_prix") for _ in [0] if "percentile_national" in series.columns],
        trend_preset(F.col("p.variation_semaine_pct"), trend_preset_).alias("tendance_prix"),
        "p.derniere_maj")
