"""User-level query API over the marts (QRY1-11; AGG15-19, JOI12, JOI14, PRJ32, SRT1-5,
SRC13-14).

All parameters enter as Column literals -- no SQL text is assembled from user input.
Limits here are the feature (a top-n listing), always behind a total order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlens.functions.aggregates import exact_avg


def cheapest_stations(report: DataFrame, product: str, region: str | None = None,
                      n: int = 20) -> DataFrame:
    """QRY1: the cheapest-stations report for one product (optionally one region),
    in national rank order, first ``n``."""
    r = report.filter(F.col("carburant_nom") == F.lit(product))
    if region is not None:
        r = r.filter(F.col("region") == F.lit(region))
    return r.orderBy(F.col("rang_national").asc_nulls_last(), F.col("station_id").asc_nulls_last()).limit(n)


def regional_latest(report: DataFrame) -> DataFrame:
    """QRY2: latest day of the regional report, by product then region rank."""
    return report.filter(F.col("is_latest")).orderBy("carburant_nom", "rang_region")


def products(dim_product: DataFrame, col: str = "carburant_nom") -> DataFrame:
    """QRY3 / SRT5 / UDF6: ordered distinct non-NULL values."""
    return dim_product.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def search_selection(fact: DataFrame, dim_entity: DataFrame, product: str, city: str | None = None,
                     department: str | None = None, latest_day=None) -> DataFrame:
    """All stations of a city (case-insensitive substring) and/or department, priced for
    ``product`` on that product's latest day: what the KPIs and the map read."""
    f = fact.filter(F.col("carburant_nom") == F.lit(product))
    latest = latest_day if latest_day is not None else f.select(F.max("date_prix")).scalar()
    f = f.filter(F.col("date_prix") == latest)
    if "mois_prix" in fact.columns:  # stored fact: one month directory
        f = f.filter(F.col("mois_prix") == F.trunc(latest, "month"))
    s = dim_entity.select(F.col("station_id").alias("_sid"), "ville", "adresse", "code_postal",
                          F.col("code_departement").alias("_dept"), F.col("region").alias("_reg"),
                          F.col("type_station").alias("_type"), "is_automate_24_24", "latitude", "longitude")
    if city:
        s = s.filter(F.lower("ville").contains(F.lower(F.lit(city))))
    if department:
        s = s.filter(F.col("_dept") == F.lit(department))
    j = f.join(s, f["station_id"] == s["_sid"], "inner")
    return j.select(
        "station_id", "ville", "adresse", "code_postal", F.col("_dept").alias("code_departement"),
        F.col("_reg").alias("region"), F.col("_type").alias("type_station"), "is_automate_24_24",
        "carburant_nom", "carburant_id", "prix_euros", "categorie_prix", "tendance_prix", "rang_national",
        "rang_region", "latitude", "longitude", "date_prix")


def search_stations(selection: DataFrame, limit: int = 500) -> DataFrame:
    """QRY4 / SRT3: the first ``limit`` rows of a selection, cheapest first. The order is total: a
    station has one row for each product id."""
    return selection.orderBy(*[F.col(c).asc_nulls_last() for c in ("prix_euros", "station_id", "carburant_id")]).limit(limit)


def selection_kpis(selection: DataFrame, value: str = "prix_euros") -> DataFrame:
    """QRY5 / AGG19: min, max, mean and row count of a selection (one row)."""
    return selection.agg(F.min(value).alias("prix_min"), F.max(value).alias("prix_max"),
                         exact_avg(value).alias("prix_moyen"), F.count(F.lit(1)).alias("nb_stations"))


def map_points(selection: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """QRY6: rows that can be placed on a map."""
    return selection.dropna(subset=[lat, lon])


def cities_top(dim_entity: DataFrame, department: str, n: int = 50) -> DataFrame:
    """QRY7 / AGG15: entities per city of a department, most first."""
    return (dim_entity.filter(F.col("code_departement") == F.lit(department))
            .groupBy("ville").agg(F.count(F.lit(1)).alias("nb_stations"))
            .orderBy(F.col("nb_stations").desc(), F.col("ville").asc_nulls_last()).limit(n))


def _dept_fact(fact: DataFrame, dim_entity: DataFrame, department: str) -> DataFrame:
    s = dim_entity.filter(F.col("code_departement") == F.lit(department)).select(
        F.col("station_id").alias("_sid"))
    return fact.join(s, fact["station_id"] == s["_sid"], "inner")


def product_distribution(fact: DataFrame, dim_entity: DataFrame, department: str) -> DataFrame:
    """QRY8 / AGG16: per product in a department: rows, entities, min, max, mean."""
    return (_dept_fact(fact, dim_entity, department).groupBy("carburant_nom").agg(
        F.count(F.lit(1)).alias("nb_prix"), F.count_distinct("station_id").alias("nb_stations"),
        F.min("prix_euros").alias("prix_min"), F.max("prix_euros").alias("prix_max"),
        exact_avg("prix_euros").alias("prix_moyen")))


def product_date_range(fact: DataFrame, dim_entity: DataFrame, department: str) -> DataFrame:
    """QRY9 / AGG17: per product in a department: first and last day, distinct days."""
    return (_dept_fact(fact, dim_entity, department).groupBy("carburant_nom").agg(
        F.min("date_prix").alias("date_min"), F.max("date_prix").alias("date_max"),
        F.count_distinct("date_prix").alias("nb_jours")))


def latest_dates(fact: DataFrame) -> DataFrame:
    """QRY10 / AGG18: latest day per product next to the global latest day."""
    by_product = fact.groupBy("carburant_nom").agg(F.max("date_prix").alias("max_date"), F.count(F.lit(1)).alias("nb_rows"))
    whole = F.max("max_date").over(Window.partitionBy(F.lit(0)))  # over a row a product
    return by_product.select("carburant_nom", "max_date", whole.alias("global_max_date"), "nb_rows")


def table_counts(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """QRY11 / SRC14: row count per table, one aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

