"""Analytical reports over the price fact (MOD13-15: JOI5/6/10/11/14/15, AGG7-10,
AGG12, WIN6-9, PRJ24-28, PRJ30).

Every report slices the fact by date first (partition pruning when the fact is
stored partitioned by date), aggregates with map-side combine, and only runs windows
over aggregated rows (at most one row per region / week per key) -- the cheapest
report's two station ranks run over slices of the latest day's prices (see
operators.ranking), so a product of any size is spread over tasks.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlens.functions.aggregates import exact_avg
from stationlens.functions.calendar import iso_year, week_start
from stationlens.functions.labels import (
    NATIONAL_BAND_LABELS, NATIONAL_BAND_TOLERANCE, TREND_WEEKLY, band, spread, trend_preset,
)
from stationlens.operators.ranking import Bounds, add_ranks, summed


def date_literal(value) -> Column:
    if isinstance(value, _dt.datetime):
        value = value.date()
    return F.lit(str(value)[:10]).cast("date")


def since(day_col: str, as_of, days: int) -> Column:
    """PRJ28: day >= as_of's date - ``days`` days."""
    return F.col(day_col) >= F.date_sub(date_literal(as_of), days)


PARTITION_MONTH = "mois_prix"


def slice_since(df: DataFrame, day_col: str, as_of, days: int) -> DataFrame:
    """Date slice of a fact. On the stored fact (partitioned by month start) the implied
    month predicate is added too, so whole directories are pruned before any file is
    opened, then row groups by the day's min/max statistics."""
    out = df.filter(since(day_col, as_of, days))
    if PARTITION_MONTH in df.columns:
        cutoff = F.date_sub(date_literal(as_of), days)
        out = out.filter(F.col(PARTITION_MONTH) >= F.trunc(cutoff, "month"))
    return out


CHEAPEST_ENTITY_COLUMNS = ("station_key", "ville", "adresse", "code_postal", "type_station",
                           "is_automate_24_24", "is_ouvert_7j_7", "nb_services", "services_list",
                           "has_lavage", "has_restauration", "has_boutique", "latitude", "longitude")


def cheapest(fact: DataFrame, dim_entity: DataFrame, k_group: int = 10, k_all: int = 100,
             group: str = "region", entity: str = "station_id", product: str = "carburant_nom",
             value: str = "prix_euros", day: str = "date_prix", tiebreak: Sequence[str] = ("carburant_id",),
             latest_day: Column | None = None, bounds: Bounds | None = None) -> DataFrame:
    """MOD13: latest day's cheapest entities: top ``k_group`` per (group, product) OR top
    ``k_all`` per product, each row carrying both full-population ranks.

    The latest day's rows are ranked here, whatever ranks the fact carries. ``latest_day`` (a scalar
    Column) may be given when a cheaper upstream determines the fact's latest day; by default it
    is a scalar subquery on the fact (cheap on the stored, month-partitioned one). ``bounds`` (see
    ``ranking.order_bounds``, over product, value, entity and tiebreak) may come from that upstream too."""
    last = latest_day if latest_day is not None else fact.select(F.max(day)).scalar()
    latest = fact.filter(F.col(day) == last)
    if PARTITION_MONTH in fact.columns:  # stored fact: read one month directory only
        latest = latest.filter(F.col(PARTITION_MONTH) == F.trunc(last, "month"))
    ranked = add_ranks(latest, [product], value, {"position_nationale_top100": [], "position_regionale_top10": [group]},
                       tiebreak=[entity, *tiebreak], bounds=bounds)
    top = ranked.filter((F.col("position_regionale_top10") <= k_group)
                        | (F.col("position_nationale_top100") <= k_all))
    cols = [c for c in CHEAPEST_ENTITY_COLUMNS if c in dim_entity.columns]
    top = top.drop(*[c for c in cols if c in top.columns])
    ent = dim_entity.select(F.col(entity).alias("_e"), *cols)
    j = top.join(ent, top[entity] == ent["_e"], "left")
    rn_all, rn_grp = F.col("position_nationale_top100"), F.col("position_regionale_top10")
    front = [c for c in ("station_key",) if c in cols]
    mid = [c for c in ("ville", "adresse", "code_postal") if c in cols]
    attrs = [c for c in ("type_station", "is_automate_24_24", "is_ouvert_7j_7", "nb_services",
                         "services_list", "has_lavage", "has_restauration", "has_boutique") if c in cols]
    geo = [c for c in ("latitude", "longitude") if c in cols]
    return j.select(
        *front, entity, *mid, "code_departement", group, *attrs,
        product, value, "categorie_prix", "tendance_prix",
        "rang_national", "rang_region", "rang_departement",
        rn_grp.alias("position_regionale_top10"), rn_all.alias("position_nationale_top100"),
        (rn_all <= 10).alias("is_top10_france"), (rn_all <= 100).alias("is_top100_france"),
        (rn_grp <= 3).alias("is_top3_region"), (rn_grp <= 10).alias("is_top10_region"),
        *geo, day)


def regional(fact: DataFrame, dim_region: DataFrame | None, as_of, days: int = 30,
             group: str = "region", entity: str = "station_id", product: str = "carburant_nom",
             value: str = "prix_euros", day: str = "date_prix",
             latest_day: Column | None = None) -> DataFrame:
    """MOD14: daily per-region statistics over the last ``days`` days vs the national
    mean (unweighted mean of region means), with region rank and latest-day flag."""
    f = slice_since(fact, day, as_of, days)
    d = f.groupBy(group, product, day).agg(
        exact_avg(value).alias("_avg"), F.min(value).alias("_min"), F.max(value).alias("_max"),
        F.count_distinct(entity).alias("nb_stations"), F.stddev_samp(value).alias("_std"))
    w = Window.partitionBy(product, day)
    wr = w.orderBy(F.col("_avg").asc_nulls_last(), F.col(group).asc_nulls_last())
    # Mean of region means as an exact decimal sum / count: order-independent.
    nat_mean = F.sum(F.col("_avg").cast("decimal(38,12)")).over(w).cast("double") / F.count("_avg").over(w)
    s = d.select("*", nat_mean.alias("_nat"), F.row_number().over(wr).alias("rang_region"),
                 F.count(group).over(w).alias("total_regions"))
    # of the grouped rows: one per group, product and day of the slice
    latest = latest_day if latest_day is not None else F.max(day).over(Window.partitionBy(F.lit(0)))
    m, nat = F.col("_avg"), F.col("_nat")
    out = s.select(
        group, product, day,
        F.round(m, 3).alias("prix_moyen_euros"), F.round("_min", 3).alias("prix_min_euros"),
        F.round("_max", 3).alias("prix_max_euros"), F.round("_std", 4).alias("prix_ecart_type"),
        F.round(nat, 3).alias("prix_moyen_national"), F.round(m - nat, 3).alias("ecart_vs_national"),
        F.round(F.try_divide(m - nat, nat) * 100, 2).alias("ecart_vs_national_pct"),
        band(m, nat, NATIONAL_BAND_TOLERANCE, NATIONAL_BAND_LABELS).alias("comparaison_nationale"),
        "nb_stations", F.col("rang_region").cast("int").alias("rang_region"), "total_regions",
        F.coalesce(F.col(day) == latest, F.lit(False)).alias("is_latest"))
    if dim_region is None:
        return out
    r = dim_region.select("region_key", F.col("region_nom").alias("_rn"))
    j = out.join(r, out[group] == r["_rn"], "left")
    return j.select("region_key", *[out[c] for c in out.columns])


def weekly(fact: DataFrame, as_of, pivot_regions: Mapping[str, str], weeks: int | None = 12,
           compat: bool = False, dim_date: DataFrame | None = None, group: str = "region",
           entity: str = "station_id", product: str = "carburant_nom", value: str = "prix_euros",
           day: str = "date_prix", lags: Mapping[int, str] | None = None,
           history_weeks: int | None = None) -> DataFrame:
    """MOD15: weekly national statistics, week-over-week / 4-week / 52-week variations,
    trend label and a per-region pivot with its spread.

    The exact median keeps a (value -> count) map per week and product: its size is the
    number of distinct prices, which the fixed decimals and the valid price range bound.
    ``weeks=None`` reads the whole fact.

    ``history_weeks`` (S15): aggregate and lag over that many weeks, then show only the
    last ``weeks`` -- so the 4- and 52-week comparisons can be filled. By default the
    lags see only the displayed slice, as in the reference (52-week values are NULL).

    Default groups by ISO week start (year = ISO year), so a week straddling New Year
    is one row. ``compat=True`` reproduces the reference: group by calendar year + ISO
    week through the calendar dimension (inner join), pivot joined on week start only.
    """
    lags = lags or {1: "prix_semaine_precedente", 4: "prix_mois_precedent", 52: "prix_annee_precedente"}
    span = max(weeks, history_weeks or weeks) if weeks is not None else None
    f = fact if span is None else slice_since(fact, day, as_of, 7 * span)
    if compat:
        if dim_date is None:
            raise ValueError("compat=True needs the calendar dimension")
        cal = F.broadcast(dim_date.select(F.col("date_day").alias("_d"), "annee",
                                          F.col("semaine_annee").alias("semaine"),
                                          "debut_semaine", "fin_semaine"))
        wk = f.join(cal, f[day] == cal["_d"], "inner")
        nat_keys = ["annee", "semaine", "debut_semaine", "fin_semaine", product]
        reg_keys = ["annee", "semaine", "debut_semaine", product]
    else:
        ws = week_start(F.col(day))
        wk = f.select("*", ws.alias("debut_semaine"), iso_year(F.col(day)).alias("annee"),
                      F.weekofyear(F.col(day)).cast("int").alias("semaine"),
                      F.date_add(ws, 6).alias("fin_semaine"))
        nat_keys = ["annee", "semaine", "debut_semaine", "fin_semaine", product]
        reg_keys = ["debut_semaine", product]
    v = F.col(value)
    # both aggregates read one exchange, dealt by entity: no week or product lies in one task
    wk = wk.select(*dict.fromkeys([*nat_keys, *reg_keys, group, entity, value])).repartition(entity)
    nat = summed(wk, nat_keys,
        exact_avg(v).alias("_avg"), F.min(v).alias("_min"), F.max(v).alias("_max"),
        F.percentile(v.cast("double"), F.lit(0.5)).alias("_med"),
        F.stddev_samp(v).alias("_std"),
        F.count_distinct(entity).alias("nb_stations"), F.count(F.lit(1)).alias("nb_observations"))
    nat = nat.select(*nat_keys, "_avg", "_min", "_max", "_med", "_std", "nb_stations", "nb_observations")
    wl = Window.partitionBy(product).orderBy(F.col("debut_semaine").asc_nulls_last(),
                                             F.col("annee").asc_nulls_last())
    nat = nat.select("*", *[F.lag("_avg", n).over(wl).alias(name) for n, name in lags.items()])
    regional_avg = summed(wk, [*reg_keys, group], exact_avg(v).alias("_ravg"))
    pivot = (regional_avg.groupBy(*reg_keys)
             .pivot(group, list(pivot_regions.values())).agg(F.first("_ravg")))
    for out_name, region in pivot_regions.items():
        pivot = pivot.withColumnRenamed(region, out_name)
    pivot = pivot.select(F.col("debut_semaine").alias("_ws"), F.col(product).alias("_pp"),
                         *pivot_regions.keys())
    # keys compared as one struct: a filter on them would go below the exchange in one branch only
    same = F.struct(nat["debut_semaine"], nat[product]) == F.struct(pivot["_ws"], pivot["_pp"])
    j = nat.join(pivot, same & nat["debut_semaine"].isNotNull() & nat[product].isNotNull(), "left")
    m = F.col("_avg")
    prev = list(lags.values())

    def var_cols(prev_name: str, abs_name: str, pct_name: str) -> list[Column]:
        p = F.col(prev_name)
        return [F.round(p, 3).alias(prev_name), F.round(m - p, 3).alias(abs_name),
                F.round(F.try_divide(m - p, F.nullif(p, F.lit(0))) * 100, 2).alias(pct_name)]

    wow = F.try_divide(m - F.col(prev[0]), F.nullif(F.col(prev[0]), F.lit(0))) * 100
    if span is not None and span > weeks:  # display only the last `weeks` after the lags have seen the history
        j = j.filter(F.col("debut_semaine") >= F.date_sub(date_literal(as_of), 7 * weeks))
    return j.select(
        "annee", "semaine", "debut_semaine", "fin_semaine", product,
        F.round(m, 3).alias("prix_moyen_national"), F.round("_min", 3).alias("prix_min_national"),
        F.round("_max", 3).alias("prix_max_national"), F.round("_med", 3).alias("prix_median_national"),
        F.round("_std", 4).alias("prix_ecart_type"), "nb_stations", "nb_observations",
        *var_cols(prev[0], "variation_hebdo", "variation_hebdo_pct"),
        *var_cols(prev[1], "variation_mensuelle", "variation_mensuelle_pct"),
        *var_cols(prev[2], "variation_annuelle", "variation_annuelle_pct"),
        trend_preset(wow, TREND_WEEKLY).alias("tendance_hebdo"),
        *[F.round(F.col(c), 3).alias(c) for c in pivot_regions],
        F.round(spread([F.col(c) for c in pivot_regions]), 3).alias("ecart_regional_max"))
