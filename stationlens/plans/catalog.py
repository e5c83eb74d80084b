"""Driver query catalogue: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a lazy DataFrame over the whole test
tables. Outputs use engine-neutral types (DOUBLE instead of DECIMAL, BIGINT counts)
and averages are rounded to 6 digits on both sides so summation order cannot show.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlens.plans import adapters as A
from stationlens.plans import fuel
from stationlens.plans import oracle as O
from stationlens.session import configure

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}
_dimension_keys: dict[tuple[str, str], tuple] = {}


def register(name: str, oracle_sql: str | None):
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, oracle_sql)
        return fn
    return deco


def neutral(df: DataFrame, round6: tuple[str, ...] = ()) -> DataFrame:
    """DECIMAL -> DOUBLE; listed float columns rounded to 6 digits."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if f.name in round6:
            c = F.round(c.cast("double"), 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Shared Spark builders (lazy; each query re-plans from the parquet scans)
# ---------------------------------------------------------------------------

class EventsBuild:
    """The fuel pipeline fed by the adapters (events prices, supplier stations, orders
    shortages). Members are built on first use, so a query only constructs the part
    of the plan it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw_stations(self) -> DataFrame:
        return A.raw_stations(self.spark, self.sf_dir)

    @cached_property
    def prices(self) -> DataFrame:
        return fuel.clean_prices(A.raw_prices(self.spark, self.sf_dir), *A.EVENT_PRICE_BOUNDS)

    @cached_property
    def stations(self) -> DataFrame:
        return fuel.clean_stations(self.raw_stations)

    @cached_property
    def services(self) -> DataFrame:
        return fuel.station_services(self.raw_stations)

    @cached_property
    def hours(self) -> DataFrame:
        return fuel.opening_hours(self.raw_stations)

    @cached_property
    def shortages(self) -> DataFrame:
        return fuel.shortages(A.raw_shortages(self.spark, self.sf_dir))

    @cached_property
    def enriched(self) -> DataFrame:
        from stationlens.operators.enrich import enrich
        return enrich(self.stations, self.services, self.hours, self.prices, self.shortages,
                      A.AS_OF_EVENTS, fuel.region_of)

    def latest_day(self, product: str | None = None, since_days: int | None = None):
        """Scalar subquery: the latest day among valid observations -- the same as the
        fact's latest day (one series row per valid entity/product/day), from a far
        smaller plan."""
        from stationlens.operators.reports import since
        from stationlens.operators.series import valid_observations
        v = valid_observations(self.prices)
        if product is not None:
            v = v.filter(F.col("carburant_nom") == F.lit(product))
        if since_days is not None:
            v = v.filter(since("date_prix", A.AS_OF_EVENTS, since_days))
        return v.select(F.max("date_prix")).scalar()

    def series(self) -> DataFrame:
        from stationlens.operators.series import price_series

        p = self.prices.withColumn("prix_euros", F.col("prix_euros").cast("double"))
        return price_series(p, self.enriched)

    @cached_property
    def dim_stations(self) -> DataFrame:
        from stationlens.operators.dims import entity_dim
        return entity_dim(self.enriched)

    @cached_property
    def dim_products(self) -> DataFrame:
        from stationlens.operators.dims import product_dim
        return product_dim(self.prices, fuel.product_seed(self.spark))

    @cached_property
    def dim_regions(self) -> DataFrame:
        from stationlens.operators.dims import region_dim
        return region_dim(self.enriched, fuel.REGION_CODES, fuel.REGION_CODE_DEFAULT,
                          fuel.REGION_CHIEF_TOWNS)

    @cached_property
    def dim_date(self) -> DataFrame:
        from stationlens.operators.explode import calendar
        return calendar(self.spark)

    def fact(self, ranked: bool = True) -> DataFrame:
        """The price fact; ``ranked=False``: without rank, percentile and price-class columns."""
        from stationlens.operators.dims import dimension_keys, price_fact
        from stationlens.operators.series import price_series
        p = self.prices.withColumn("prix_euros", F.col("prix_euros").cast("double"))
        series = price_series(p, self.enriched, entity_key="station_key", ranked=ranked)
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _dimension_keys:  # measured once in an application and folder
            _dimension_keys[key] = (dimension_keys(self.dim_products, F.col("carburant_id"), "carburant_key"),
                                    dimension_keys(self.dim_regions, F.col("region_nom"), "region_key"))
        return price_fact(series, self.dim_stations, self.dim_products, self.dim_date, self.dim_regions, keys=_dimension_keys[key])


def li_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fuel.clean_prices(A.raw_line_prices(spark, sf_dir), *A.LINEITEM_PRICE_BOUNDS)
    return p.withColumn("prix_euros", F.col("prix_euros").cast("double"))


# ---------------------------------------------------------------------------
# Staging (MOD1-5)
# ---------------------------------------------------------------------------

@register("clean_prices", O.sql("SELECT * REPLACE (CAST(prix_euros AS DOUBLE) AS prix_euros) FROM stg_prix",
                                "stg_prix"))
def q_clean_prices(spark, d):
    """MOD2: PRJ1, PRJ2, PRJ4-8 on raw price strings."""
    return neutral(fuel.clean_prices(A.raw_prices(spark, d), *A.EVENT_PRICE_BOUNDS))


@register("clean_stations", O.sql("SELECT * FROM stg_stations", "stg_stations"))
def q_clean_stations(spark, d):
    """MOD1: PRJ1, PRJ3, PRJ8-11."""
    return neutral(fuel.clean_stations(A.raw_stations(spark, d)))


@register("station_services", O.sql("SELECT * FROM stg_services", "stg_services"))
def q_station_services(spark, d):
    """MOD3: GEN1, PRJ12, SET1."""
    return fuel.station_services(A.raw_stations(spark, d))


@register("opening_hours", O.sql("SELECT * FROM stg_hours", "stg_hours"))
def q_opening_hours(spark, d):
    """MOD4: GEN2, PRJ16, PRJ17."""
    return fuel.opening_hours(A.raw_stations(spark, d))


@register("shortages", O.sql("SELECT * FROM stg_shortages", "stg_shortages"))
def q_shortages(spark, d):
    """MOD5: PRJ4 (patterned), PRJ8, PRJ15."""
    return fuel.shortages(A.raw_shortages(spark, d))


# ---------------------------------------------------------------------------
# Enrichment and series (MOD6, MOD7)
# ---------------------------------------------------------------------------

@register("enriched_stations", O.sql(
    "SELECT * REPLACE (CAST(round(CAST(CAST(prix_moyen_tous_produits AS VARCHAR) AS DECIMAL(38,20)), 6) AS DOUBLE) AS prix_moyen_tous_produits) FROM enriched",
    "enriched"))
def q_enriched(spark, d):
    """MOD6: AGG1-6, JOI1, PRJ13, PRJ18-20."""
    return neutral(EventsBuild(spark, d).enriched, round6=("prix_moyen_tous_produits",))


@register("daily_last", O.sql("SELECT * FROM daily", "daily"))
def q_daily_last(spark, d):
    """AGG21 (WIN1/WIN2 semantics as one aggregate)."""
    from stationlens.operators.series import daily_last, valid_observations

    p = EventsBuild(spark, d).prices.withColumn("prix_euros", F.col("prix_euros").cast("double"))
    out = daily_last(valid_observations(p), "station_id", "carburant_nom", "date_prix", "date_maj",
                     "prix_euros", ids=["carburant_id"])
    return out.select("station_id", "carburant_nom", "carburant_id", "date_prix", "prix_euros",
                      "derniere_maj", "nb_updates_jour")


@register("price_variations", O.sql(f"""
SELECT station_id, carburant_nom, carburant_id, date_prix, prix_euros, {O._VARS}
FROM li_varied""", "li_varied"))
def q_price_variations(spark, d):
    """WIN3 + PRJ21 on long series (line items): row lags 1/7/30."""
    from stationlens.operators.series import add_variations, daily_last, valid_observations

    daily = daily_last(valid_observations(li_prices(spark, d)), "station_id", "carburant_nom",
                       "date_prix", "date_maj", "prix_euros", ids=["carburant_id"])
    v = add_variations(daily, "station_id", "carburant_nom", "date_prix", "prix_euros",
                       tiebreak=[F.col("carburant_id").asc_nulls_last()])
    return v.select("station_id", "carburant_nom", "carburant_id", "date_prix", "prix_euros",
                    "prix_veille", "variation_jour", "variation_jour_pct",
                    "prix_semaine_precedente", "variation_semaine", "variation_semaine_pct",
                    "prix_mois_precedent", "variation_mois", "variation_mois_pct")


@register("daily_series", O.sql("SELECT * FROM series", "series"))
def q_daily_series(spark, d):
    """MOD7: PRJ29, AGG21, JOI4, WIN3-5, PRJ21."""
    return EventsBuild(spark, d).series()


# ---------------------------------------------------------------------------
# Dimensions, fact, calendar (MOD8-12)
# ---------------------------------------------------------------------------

@register("station_dim", O.sql("SELECT * FROM dim_stations", "dim_stations"))
def q_station_dim(spark, d):
    """MOD8: PRJ37 surrogate key over the enriched entities."""
    return neutral(EventsBuild(spark, d).dim_stations)


@register("product_dim", O.sql("SELECT * FROM dim_products", "dim_products"))
def q_product_dim(spark, d):
    """MOD9: SRC9 seed, SET1, JOI3 (normalised-name join), PRJ20, PRJ37."""
    return EventsBuild(spark, d).dim_products


@register("region_dim", O.sql("SELECT * FROM dim_regions", "dim_regions"))
def q_region_dim(spark, d):
    """MOD10: SET1, AGG2, AGG3, PRJ14, PRJ37."""
    return EventsBuild(spark, d).dim_regions


@register("calendar", O.sql(O.calendar_select(
    "(SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d "
    "FROM (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem))")))
def q_calendar(spark, d):
    """MOD11: GEN3 spine + PRJ34-36 over the line items' ship-date range."""
    from stationlens.operators.explode import calendar_span
    return calendar_span(A.read_table(spark, d, "lineitem"), "l_shipdate")


@register("price_fact", O.sql("SELECT * FROM fact", "fact"))
def q_price_fact(spark, d):
    """MOD12: JOI2 (4 dimension lookups), PRJ22, PRJ23, PRJ37."""
    return EventsBuild(spark, d).fact()


# ---------------------------------------------------------------------------
# Reports and anomalies (MOD13-16)
# ---------------------------------------------------------------------------

@register("cheapest_stations", O.sql("SELECT * FROM cheapest", "cheapest"))
def q_cheapest(spark, d):
    """MOD13: JOI10 (scalar max date), WIN6 (two ranks, OR filter), PRJ27, PRJ30, JOI14."""
    from stationlens.operators.ranking import order_bounds
    from stationlens.operators.reports import cheapest
    from stationlens.operators.series import valid_observations
    b = EventsBuild(spark, d)
    p = b.prices.withColumn("prix_euros", F.col("prix_euros").cast("double"))
    seen = valid_observations(p).filter(F.col("date_prix") == b.latest_day())
    bounds = order_bounds(seen, ["carburant_nom", "prix_euros", "station_id", "carburant_id"], counted=p)
    return neutral(cheapest(b.fact(), b.dim_stations, latest_day=b.latest_day(), bounds=bounds))


@register("regional_report", O.sql("SELECT * FROM regional", "regional"))
def q_regional(spark, d):
    """MOD14: PRJ28, AGG7, AGG12, WIN7, WIN8, JOI11, JOI15, PRJ24, PRJ25."""
    from stationlens.operators.reports import regional
    b = EventsBuild(spark, d)
    return regional(b.fact(ranked=False), b.dim_regions, A.AS_OF_EVENTS, days=30, latest_day=b.latest_day(since_days=30))


@register("weekly_report", O.sql("SELECT * FROM weekly", "weekly"))
def q_weekly(spark, d):
    """MOD15: AGG8 (median), AGG9, AGG10 (pivot), WIN9, JOI6, PRJ23 (weekly), PRJ25, PRJ26."""
    from stationlens.operators.reports import weekly
    b = EventsBuild(spark, d)
    return weekly(b.fact(ranked=False), A.AS_OF_EVENTS, fuel.WEEKLY_PIVOT_REGIONS, weeks=12)


def _anomalies(spark, d):
    from stationlens.operators.anomalies import price_anomalies
    b = EventsBuild(spark, d)
    return price_anomalies(b.fact(ranked=False), b.dim_stations, A.AS_OF_EVENTS, days=7)


@register("price_anomalies", O.sql("SELECT * FROM anomalies", "anomalies"))
def q_anomalies(spark, d):
    """OBS4 / MOD16: AGG11, JOI7, PRJ31: all anomalies."""
    return _anomalies(spark, d)


@register("top_anomalies", O.sql("""SELECT * FROM anomalies
ORDER BY abs(z_score) DESC NULLS FIRST, date_prix DESC, station_id, carburant_nom, carburant_id NULLS LAST LIMIT 100""",
                                 "anomalies"))
def q_top_anomalies(spark, d):
    """SRT2: the 100 most extreme anomalies."""
    from stationlens.operators.anomalies import top_anomalies
    return top_anomalies(_anomalies(spark, d), 100)


# ---------------------------------------------------------------------------
# Label presets and calendar-exact lags on the long line-item series
# ---------------------------------------------------------------------------

def _li_daily(spark, d, cluster_by=None):
    from stationlens.operators.series import daily_last, valid_observations
    return daily_last(valid_observations(li_prices(spark, d)), "station_id", "carburant_nom",
                      "date_prix", "date_maj", "prix_euros", ids=["carburant_id"], cluster_by=cluster_by)


@register("trend_labels", O.sql(f"""
SELECT station_id, carburant_nom, carburant_id, date_prix, variation_semaine_pct,
       {O.trend_sql('variation_semaine_pct', 2, 0.5, O._TREND_LABELS)} AS tendance_jour,
       {O.trend_sql('variation_semaine_pct', 3, 1, O._WEEKLY_LABELS)} AS tendance_hebdo,
       {O.trend_sql('variation_semaine_pct', 5, 1, O._TREND_LABELS, 'Inconnu')} AS tendance_macro,
       CASE WHEN prix_semaine_precedente IS NULL OR prix_euros IS NULL OR prix_semaine_precedente = 0 THEN NULL
            ELSE CAST(round(CAST(CAST((prix_euros - prix_semaine_precedente) / prix_semaine_precedente * 100 AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE) END AS variation_macro,
       pr AS percentile,
       {O.bucket_sql('pr', 'Inconnu')} AS categorie_macro
FROM (SELECT *, {O._VARS},
             percent_rank() OVER (PARTITION BY carburant_nom, date_prix ORDER BY prix_euros) AS pr
      FROM li_varied) t""", "li_varied"))
def q_trend_labels(spark, d):
    """PRJ22/PRJ23 presets: daily (+-0.5/2), weekly (+-1/3), macro (+-1/5, 'Inconnu'); UDF2-4."""
    from stationlens.functions.labels import (
        TREND_DAILY, TREND_MACRO, TREND_WEEKLY, pct_variation, price_bucket, trend_preset)
    from stationlens.operators.ranking import add_ranks, order_bounds
    from stationlens.operators.series import add_variations, valid_observations
    series = ["station_id", "carburant_nom"]
    v = add_variations(_li_daily(spark, d, cluster_by=series), *series, "date_prix", "prix_euros",
                       tiebreak=[F.col("carburant_id").asc_nulls_last()])
    v = v.select(*series, "carburant_id", "date_prix", "prix_euros", "variation_semaine_pct",
                 pct_variation("prix_euros", "prix_semaine_precedente", 2, positive_only=False).alias("variation_macro"))
    # the product comes from the parts, the rest from the line items: these are sampled before the join
    bounds = order_bounds(valid_observations(li_prices(spark, d)),
                          ["carburant_nom", "date_prix", "prix_euros", "station_id", "carburant_id"],
                          counted=A.read_table(spark, d, "lineitem"), hashed=["date_prix", "prix_euros", "station_id"])
    v = add_ranks(v, ["carburant_nom", "date_prix"], "prix_euros", {}, percent="percentile",
                  tiebreak=["station_id", "carburant_id"], bounds=bounds)
    x = F.col("variation_semaine_pct")
    return v.select(
        "station_id", "carburant_nom", "carburant_id", "date_prix", "variation_semaine_pct",
        trend_preset(x, TREND_DAILY).alias("tendance_jour"),
        trend_preset(x, TREND_WEEKLY).alias("tendance_hebdo"),
        trend_preset(x, TREND_MACRO).alias("tendance_macro"),
        "variation_macro", "percentile", price_bucket("percentile", "Inconnu").alias("categorie_macro"))


@register("calendar_lags", O.sql(f"""
SELECT station_id, carburant_nom, carburant_id, date_prix, prix_euros, {O._VARS}
FROM (SELECT a.*, b1.p AS prix_veille, b7.p AS prix_semaine_precedente, b30.p AS prix_mois_precedent
      FROM li_daily a
      LEFT JOIN (SELECT station_id, carburant_nom, date_prix, max(prix_euros) AS p FROM li_daily GROUP BY 1, 2, 3) b1
        ON b1.station_id = a.station_id AND b1.carburant_nom = a.carburant_nom AND b1.date_prix = a.date_prix - 1
      LEFT JOIN (SELECT station_id, carburant_nom, date_prix, max(prix_euros) AS p FROM li_daily GROUP BY 1, 2, 3) b7
        ON b7.station_id = a.station_id AND b7.carburant_nom = a.carburant_nom AND b7.date_prix = a.date_prix - 7
      LEFT JOIN (SELECT station_id, carburant_nom, date_prix, max(prix_euros) AS p FROM li_daily GROUP BY 1, 2, 3) b30
        ON b30.station_id = a.station_id AND b30.carburant_nom = a.carburant_nom AND b30.date_prix = a.date_prix - 30) t""",
    "li_daily"))
def q_calendar_lags(spark, d):
    """WIN3 calendar-exact variant (value exactly 1/7/30 days earlier)."""
    from stationlens.operators.series import add_variations
    v = add_variations(_li_daily(spark, d), "station_id", "carburant_nom", "date_prix", "prix_euros",
                       calendar_exact=True)
    return v.select("station_id", "carburant_nom", "carburant_id", "date_prix", "prix_euros",
                    "prix_veille", "variation_jour", "variation_jour_pct",
                    "prix_semaine_precedente", "variation_semaine", "variation_semaine_pct",
                    "prix_mois_precedent", "variation_mois", "variation_mois_pct")


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
