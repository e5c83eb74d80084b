"""Dimension and enrichment edge semantics."""

import datetime as dt

from pyspark.sql import functions as F

from stationlens.operators import quality as Q
from stationlens.operators.dims import price_fact, product_dim
from stationlens.operators.enrich import enrich
from stationlens.operators.explode import calendar
from stationlens.plans import fuel
from stationlens.sources.raw import RAW_PRICES, RAW_STATIONS, RAW_SHORTAGES

T0 = dt.datetime(2024, 1, 1, 6)


def test_calendar_end_exclusive(spark):
    cal = calendar(spark)
    agg = cal.agg(F.count(F.lit(1)).alias("n"), F.min("date_day").alias("lo"), F.max("date_day").alias("hi")).first()
    assert (agg["n"], agg["lo"], agg["hi"]) == (2921, dt.date(2023, 1, 1), dt.date(2030, 12, 30))


def test_product_dim_seed_id_wins_and_duplicates(spark):
    raw = [("s1", "E10", "4", "1.8", "2024-01-01 08:00:00", T0), ("s1", "E10", "44", "1.8", "2024-01-01 09:00:00", T0),
           ("s1", "XX", "9", "1.8", "2024-01-01 09:00:00", T0)]
    prices = fuel.clean_prices(spark.createDataFrame(raw, RAW_PRICES))
    dim = product_dim(prices, fuel.product_seed(spark))
    rows = sorted((r["carburant_id"], r["carburant_nom"], r["categorie"]) for r in dim.collect())
    # two feed ids for E10 both take the seed id (S17); unknown product keeps its own
    assert rows == [("4", "E10", "Essence"), ("4", "E10", "Essence"), ("9", "XX", "Inconnu")]
    assert Q.unique(dim, ["carburant_id"]).count() == 1
    mism = Q.product_id_mismatch(prices, fuel.product_seed(spark)).collect()
    assert [(r["feed_id"], r["reference_id"]) for r in mism] == [("44", "4")]


def test_fact_product_key_by_id_or_name(spark):
    series = spark.createDataFrame(
        [("s1", "E10", "44", "01", "Autre", "Route", dt.date(2024, 1, 1), 1.8)],
        "station_id string, carburant_nom string, carburant_id string, code_departement string, "
        "region string, type_station string, date_prix date, prix_euros double")
    for c in ("nb_updates_jour", "prix_veille", "variation_jour", "variation_jour_pct", "prix_semaine_precedente",
              "variation_semaine", "variation_semaine_pct", "prix_mois_precedent", "variation_mois",
              "variation_mois_pct", "rang_national", "rang_departement", "rang_region", "percentile_national"):
        series = series.withColumn(c, F.lit(None).cast("double"))
    series = series.withColumn("derniere_maj", F.lit(None).cast("timestamp_ntz"))
    dim_p = product_dim(spark.createDataFrame([("x", "E10", "4", "1.8", "2024-01-01 08:00:00", T0)], RAW_PRICES)
                        .transform(fuel.clean_prices), fuel.product_seed(spark))
    ent = spark.createDataFrame([("k", "s1")], "station_key string, station_id string")
    reg = spark.createDataFrame([("r", "Autre")], "region_key string, region_nom string")
    by_id = price_fact(series, ent, dim_p, calendar(spark), reg).first()
    by_name = price_fact(series, ent, dim_p, calendar(spark), reg, product_key="name").first()
    assert by_id["carburant_key"] is None          # feed id 44 is not the dimension's id (S16)
    assert by_name["carburant_key"] is not None    # normalised-name join finds it
    assert by_id["tendance_prix"] == "Stable" and by_id["categorie_prix"] == "Très cher"  # NULL inputs (S7, S9)


def test_open_days_and_quality_score(spark):
    hours7 = "|".join(f"{d}::" for d in ("Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"))
    raw_st = spark.createDataFrame([
        ("1", "4885660", "235220", "75001", "R", "a", "Paris", "Boutique", "", hours7, T0),
        ("2", "x", "235220", "75001", "R", "", "Paris", "", "", "Lundi:1:", T0)], RAW_STATIONS)
    prices = fuel.clean_prices(spark.createDataFrame(
        [("1", p, "1", "1.8", "2024-01-01 08:00:00", T0) for p in ("GAZOLE", "SP95", "E10")], RAW_PRICES))
    short = fuel.shortages(spark.createDataFrame([], RAW_SHORTAGES))
    out = {r["station_id"]: r for r in enrich(
        fuel.clean_stations(raw_st), fuel.station_services(raw_st), fuel.opening_hours(raw_st), prices, short,
        "2024-01-01 12:00:00", fuel.region_of).collect()}
    # seven days listed without hours and not flagged closed count as open (S24)
    assert out["1"]["jours_ouverts_semaine"] == 7 and out["1"]["is_ouvert_7j_7"]
    assert out["1"]["data_quality_score"] == 100  # located, address, services, 3 products, fresh (S25)
    assert out["2"]["data_quality_score"] == 20   # floors: 10 (products) + 10 (freshness)
    assert not out["2"]["is_ouvert_7j_7"] and out["2"]["jours_ouverts_semaine"] == 0


def test_dimension_keys_looked_up_or_joined(spark, monkeypatch):
    """Small dimensions are searched, large ones joined: the same rows, also for repeated and missing keys."""
    from stationlens.operators import dims as D
    dim = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "3"), (None, "4"), ("é", "5")], "k string, v string")
    rows = spark.createDataFrame([(f"s{i}", ["a", "b", "x", None, "é"][i % 5]) for i in range(60)], "station_id string, at string")
    small = D.dimension_keys(dim, F.col("k"), "v")
    monkeypatch.setattr(D, "LOOKUP_KEYS", 2)
    large = D.dimension_keys(dim, F.col("k"), "v")
    assert small.text and large.text is None
    found = lambda keys: D.with_dimension_key(rows, F.col("at"), keys, "station_id")
    assert "Join" not in found(small)._jdf.queryExecution().optimizedPlan().toString()
    want = rows.join(dim.filter("k is not null"), F.col("at") == F.col("k"), "left").select("station_id", "at", "v")
    for keys in (small, large):
        assert sorted(map(repr, found(keys).collect())) == sorted(map(repr, want.collect()))
    empty = found(D.dimension_keys(dim.limit(0), F.col("k"), "v"))
    assert empty.count() == 60 and empty.filter("v is not null").count() == 0


def test_a_dimension_of_a_million_keys(spark):
    """Beyond the lookup's size the rows are joined with salted keys: no cap, no error."""
    from stationlens.operators import dims as D
    dim = spark.range(1_000_000).select(F.col("id").cast("string").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    keys = D.dimension_keys(dim, F.col("k"), "v")
    assert keys.text is None
    rows = spark.range(3000).select(F.concat(F.lit("s"), "id").alias("station_id"), (F.col("id") * 400).cast("string").alias("at"))
    got = D.with_dimension_key(rows, F.col("at"), keys, "station_id")
    assert got.filter("v = md5(at)").count() == 2500 and got.filter("v is null").count() == 500
