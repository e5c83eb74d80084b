"""Entity enrichment (MOD6: AGG1-6, JOI1, PRJ13, PRJ18-20).

Four per-entity aggregates (services, hours, prices, shortages) are each folded to one
row per entity with map-side combine and left-joined on the entity key; all sides
hash on the same key, so the joins reuse the aggregates' partitioning (or become
broadcasts under AQE when an aggregate turns out small). The region is computed
inline from the department code -- no self-join, so a duplicated entity id is not
multiplied (see README, deviations).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlens.functions.aggregates import exact_avg
from stationlens.functions.labels import weighted_score


def ts_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session time zone."""
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def sorted_distinct_list(c: str | Column, sep: str = ", ") -> Column:
    """AGG3: ordered distinct string aggregation; NULLs skipped (bounded by distinct values)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.array_sort(F.collect_set(col)), sep)


# Category flags derived from the services (flag -> category).
CATEGORY_FLAGS = {
    "has_lavage": "Lavage",
    "has_restauration": "Restauration",
    "has_boutique": "Commerce",
    "has_borne_electrique": "Recharge",
}
NAME_FLAGS = {"has_gpl": "GPL"}  # flag -> substring of the service name


# What an absent summary counts as.
DEFAULTS = {"nb_services": 0, "jours_ouverts_semaine": 0, "nb_produits_disponibles": 0, "nb_ruptures_en_cours": 0}


def summaries(services: DataFrame, hours: DataFrame, prices: DataFrame, shortage_rows: DataFrame,
              category_flags: Mapping[str, str] = CATEGORY_FLAGS,
              name_flags: Mapping[str, str] = NAME_FLAGS) -> list[tuple[DataFrame, dict[str, Column]]]:
    """What an entity's detail tables say about it: (rows that count, name -> aggregate)."""
    open_day, good = ~F.col("is_ferme"), ~F.col("is_prix_invalide") & ~F.col("is_prix_suspect")
    flags = {f: F.bool_or(F.col("service_categorie") == cat) for f, cat in category_flags.items()}
    flags |= {f: F.bool_or(F.col("service_nom").contains(part)) for f, part in name_flags.items()}
    return [
        (services, {"nb_services": F.count(F.lit(1)), "services_list": sorted_distinct_list("service_nom"),
                    "services_categories": sorted_distinct_list("service_categorie"), **flags}),
        (hours.filter(open_day), {"jours_ouverts_semaine": F.count(F.lit(1)), "heure_ouverture_min": F.min("ouverture_1"),
                                  "heure_fermeture_max": F.max("fermeture_1")}),
        (prices.filter(good), {"nb_produits_disponibles": F.count_distinct("carburant_nom"),
                               "derniere_maj_prix": F.max("date_maj"), "prix_moyen_tous_produits": exact_avg("prix_euros")}),
        (shortage_rows.filter("is_en_cours"), {"nb_ruptures_en_cours": F.count(F.lit(1)),
                                               "produits_en_rupture": sorted_distinct_list("carburant_nom")}),
    ]


def quality_score(as_of) -> Column:
    """PRJ18: completeness score, 20..100; the freshness term uses ``as_of`` (not the clock)."""
    cutoff = ts_literal(as_of) - F.expr("INTERVAL 1 DAY")
    return weighted_score([
        (F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), 20, 0),
        (F.col("adresse").isNotNull() & (F.col("adresse") != ""), 10, 0),
        (F.col("nb_services") > 0, 20, 0),
        (F.col("nb_produits_disponibles") >= 3, 20, 10),
        (F.coalesce(F.col("derniere_maj_prix") >= cutoff, F.lit(False)), 30, 10),
    ])


ATTRIBUTES = ("latitude", "longitude", "code_postal", "code_departement", "ville", "adresse", "type_station",
              "is_automate_24_24")


def enrich(stations: DataFrame, services: DataFrame, hours: DataFrame, prices: DataFrame,
           shortage_rows: DataFrame, as_of, region_fn: Callable[[str], Column],
           key: str = "station_id", category_flags: Mapping[str, str] = CATEGORY_FLAGS,
           name_flags: Mapping[str, str] = NAME_FLAGS) -> DataFrame:
    """MOD6: an entity's attributes with the summaries of its detail tables, their defaults filled
    in, and the completeness score."""
    out = stations.select(key, *ATTRIBUTES, region_fn("code_departement").alias("region"), "_loaded_at")
    names: list[Column] = []
    for rows, aggregates in summaries(services, hours, prices, shortage_rows, category_flags, name_flags):
        out = out.join(rows.groupBy(key).agg(*[a.alias(n) for n, a in aggregates.items()]), key, "left")
        for n in aggregates:
            if n in DEFAULTS:
                names.append(F.coalesce(n, F.lit(DEFAULTS[n])).cast("long").alias(n))
            elif n in category_flags or n in name_flags:
                names.append(F.coalesce(n, F.lit(False)).alias(n))
            else:
                names.append(F.col(n))
    out = out.select(key, *ATTRIBUTES, "region", *names, "_loaded_at")
    always_open = F.col("is_automate_24_24") | (F.col("jours_ouverts_semaine") == 7)
    return out.select(*[c for c in out.columns if c != "_loaded_at"], always_open.alias("is_ouvert_7j_7"),
                      quality_score(as_of).cast("int").alias("data_quality_score"), "_loaded_at")
