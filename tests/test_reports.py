"""Report semantics on literal facts."""

import datetime as dt

from pyspark.sql import functions as F

from stationlens.operators.explode import calendar
from stationlens.operators.reports import cheapest, regional, weekly

PIVOT = {"prix_a": "A", "prix_b": "B"}


def _fact(spark, rows):
    df = spark.createDataFrame(rows, "station_id string, carburant_nom string, region string, date_prix date, prix_euros double")
    return df.select("*", F.lit("1").alias("carburant_id"), F.lit("01").alias("code_departement"),
                     F.lit("x").alias("categorie_prix"), F.lit("Stable").alias("tendance_prix"),
                     F.lit(1).alias("rang_national"), F.lit(1).alias("rang_region"), F.lit(1).alias("rang_departement"))


def test_weekly_new_year_fixed_vs_compat(spark):
    days = [dt.date(2024, 12, 30) + dt.timedelta(days=i) for i in range(7)]
    rows = [(f"s{i}", "GAZOLE", "A" if i % 2 else "B", d, 1.5 + i / 100) for i, d in enumerate(days)]
    fact = _fact(spark, rows)
    fixed = weekly(fact, "2025-01-10", PIVOT, weeks=12).collect()
    assert len(fixed) == 1 and fixed[0]["annee"] == 2025 and fixed[0]["semaine"] == 1
    assert fixed[0]["nb_observations"] == 7
    compat = weekly(fact, "2025-01-10", PIVOT, weeks=12, compat=True, dim_date=calendar(spark)).collect()
    assert len(compat) == 4  # two calendar years x two pivot rows on the same week start


def test_regional_national_mean_is_unweighted(spark):
    d = dt.date(2024, 1, 10)
    rows = [("s1", "P", "A", d, 1.0), ("s2", "P", "A", d, 1.0), ("s3", "P", "A", d, 1.0), ("s4", "P", "B", d, 2.0)]
    out = {r["region"]: r for r in regional(_fact(spark, rows), None, "2024-01-11").collect()}
    assert out["A"]["prix_moyen_national"] == 1.5  # (1.0 + 2.0) / 2, not 5/4
    assert out["A"]["comparaison_nationale"] == "Moins cher que la moyenne"
    assert out["A"]["rang_region"] == 1 and out["B"]["total_regions"] == 2 and out["A"]["is_latest"]


def test_cheapest_or_filter_keeps_full_ranks(spark):
    d = dt.date(2024, 1, 10)
    rows = [(f"s{i:03d}", "P", "A" if i < 150 else "B", d, 1.0 + i / 1000) for i in range(200)]
    ent = spark.createDataFrame([(f"s{i:03d}", "c") for i in range(200)], "station_id string, ville string")
    out = cheapest(_fact(spark, rows), ent).collect()
    # top 100 nationally (all in A) + top 10 of B (national ranks 151..160)
    assert len(out) == 110
    b = sorted(r["position_nationale_top100"] for r in out if r["region"] == "B")
    assert b == list(range(151, 161))


def test_weekly_history_weeks_fills_year_over_year(spark):
    start = dt.date(2023, 1, 2)  # a Monday
    rows = [("s1", "GAZOLE", "A", start + dt.timedelta(weeks=w), 1.0 + w / 100) for w in range(60)]
    fact = _fact(spark, rows)
    as_of = start + dt.timedelta(weeks=60)
    plain = weekly(fact, as_of, PIVOT, weeks=4).collect()
    assert len(plain) == 4 and all(r["prix_annee_precedente"] is None for r in plain)
    longer = weekly(fact, as_of, PIVOT, weeks=4, history_weeks=60).collect()
    assert len(longer) == 4 and all(r["prix_annee_precedente"] is not None for r in longer)
    last = max(longer, key=lambda r: r["debut_semaine"])
    assert last["prix_annee_precedente"] == round(1.0 + 7 / 100, 3)  # week 59 vs week 7
