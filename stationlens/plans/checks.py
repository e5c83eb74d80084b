"""The declared checks (DQ1-DQ12) as one spec: table -> column -> rules.

A rule is ``unique``, ``not_null``, ``accepted(values)``, ``between(low, high)``, ``length(n)`` or
``parent(table, column)``; see ``operators.quality.run_rules``.
"""

from __future__ import annotations

from stationlens.functions import labels as L
from stationlens.operators import quality as Q
from stationlens.operators.quality import Rule, accepted, between_rule, length, not_null_rule, parent, unique_rule
from stationlens.plans import fuel

UNIQUE, NOT_NULL = unique_rule(), not_null_rule()
KEY = (UNIQUE, NOT_NULL)
PRICE = between_rule(fuel.PRICE_MIN, fuel.PRICE_MAX)

# Which columns are checked for what.
DECLARED: dict[str, dict[str, tuple[Rule, ...]]] = {
    "raw_stations": {"station_id": (NOT_NULL,)},
    "raw_prix": {"station_id": (NOT_NULL,)},
    "stg_stations": {"station_id": KEY, "latitude": (between_rule(41.0, 52.0),), "longitude": (between_rule(-5.5, 10.0),),
                     "code_postal": (NOT_NULL, length(5)), "type_station": (accepted(("Route", "Autoroute", "Inconnu")),)},
    "stg_prix": {"station_id": (NOT_NULL,), "carburant_nom": (NOT_NULL, accepted(fuel.PRODUCT_NAMES)), "prix_euros": (PRICE,)},
    "stg_services": {"station_id": (NOT_NULL,), "service_nom": (NOT_NULL,),
                     "service_categorie": (accepted(fuel.SERVICE_CATEGORIES),)},
    "stg_hours": {"station_id": (NOT_NULL,), "jour_numero": (accepted(range(1, 8)),)},
    "stg_shortages": {"station_id": (NOT_NULL,)},
    "stations_enriched": {"station_id": KEY, "data_quality_score": (between_rule(0, 100),)},
    "daily_series": {"station_id": (NOT_NULL,), "carburant_nom": (NOT_NULL,), "date_prix": (NOT_NULL,)},
    "dim_stations": {"station_key": KEY, "station_id": KEY, "region": (NOT_NULL,)},
    "dim_produits": {"carburant_key": KEY, "carburant_id": KEY, "carburant_nom": (NOT_NULL,)},
    "dim_regions": {"region_key": KEY, "region_code": KEY, "region_nom": KEY},
    "dim_date": {"date_key": KEY, "date_day": KEY},
    "fct_prix_produits": {
        "prix_key": KEY, "station_key": (NOT_NULL, parent("dim_stations", "station_key")),
        "carburant_key": (parent("dim_produits", "carburant_key"),), "date_key": (parent("dim_date", "date_key"),),
        "prix_euros": (NOT_NULL, PRICE), "categorie_prix": (accepted(L.PERCENTILE_LABELS),),
        "tendance_prix": (accepted(L.TREND_LABELS),)},
    "rpt_prix_moyen_region": {"region": (NOT_NULL,), "carburant_nom": (NOT_NULL,), "date_prix": (NOT_NULL,),
                              "comparaison_nationale": (accepted(L.NATIONAL_BAND_LABELS),)},
    "rpt_stations_moins_cheres": {"station_id": (NOT_NULL,), "carburant_nom": (NOT_NULL,), "prix_euros": (NOT_NULL,)},
    "rpt_evolution_prix_hebdo": {"annee": (NOT_NULL,), "semaine": (NOT_NULL,), "carburant_nom": (NOT_NULL,),
                                 "tendance_hebdo": (accepted(L.WEEKLY_TREND_LABELS),)},
    "seed_produits": {"carburant_id": KEY, "carburant_nom": KEY,
                      "categorie": (accepted(("Essence", "Diesel", "Biocarburant", "GPL")),), "taux_bio_pct": (between_rule(0, 100),)},
}


def singular(stations, prices, run_log, as_of) -> list[Q.Check]:
    """The checks that are queries of their own (DQ7-DQ9)."""
    return [Q.Check("orphan_prices", "stg_prix", "station_id", Q.orphans(prices, stations)),
            Q.Check("coordinates_in_box", "stg_stations", "latitude,longitude", Q.in_box(stations)),
            Q.Check("data_freshness", "run_log", "freshness_status", Q.pipeline_freshness(run_log, prices, as_of))]
