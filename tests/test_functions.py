"""Column builders: boundaries of buckets/trends, guards, sentinels, keys, calendar."""

import datetime as dt

from pyspark.sql import functions as F

from stationlens.functions import calendar as CAL
from stationlens.functions import labels as L
from stationlens.functions.aggregates import exact_avg


def _one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_percentile_bucket_bounds_inclusive(spark):
    vals = [(0.1,), (0.1000001,), (0.25,), (0.75,), (0.9,), (0.95,), (None,)]
    got = _one(spark, L.price_bucket("x"), vals, "x double")
    assert got == ["Très bon marché", "Bon marché", "Bon marché", "Prix moyen", "Cher", "Très cher", "Très cher"]
    assert _one(spark, L.price_bucket("x", "Inconnu"), [(None,)], "x double") == ["Inconnu"]


def test_trend_presets(spark):
    vals = [(2.01,), (2.0,), (0.5,), (0.51,), (-0.51,), (-2.5,), (None,)]
    assert _one(spark, L.trend_preset("x", L.TREND_DAILY), vals, "x double") == \
        ["Forte hausse", "Hausse", "Stable", "Hausse", "Baisse", "Forte baisse", "Stable"]
    assert _one(spark, L.trend_preset("x", L.TREND_WEEKLY), [(3.5,), (1.5,), (-1.5,)], "x double") == \
        ["Forte hausse", "Hausse modérée", "Baisse modérée"]
    assert _one(spark, L.trend_preset("x", L.TREND_MACRO), [(None,), (5.0,), (5.1,)], "x double") == \
        ["Inconnu", "Hausse", "Forte hausse"]


def test_pct_variation_guards(spark):
    rows = [(1.1, 1.0), (1.0, 0.0), (1.0, None), (1.0, -1.0)]
    assert _one(spark, L.pct_variation("c", "p"), rows, "c double, p double") == [10.0, None, None, None]
    assert _one(spark, L.pct_variation("c", "p", positive_only=False), rows, "c double, p double") == \
        [10.0, None, None, -200.0]


def test_spread_sentinels_and_band(spark):
    rows = [(1.0, 2.5, None), (None, None, None)]
    assert _one(spark, L.spread(["a", "b", "c"]), rows, "a double, b double, c double") == [1.5, -999.0]
    got = _one(spark, L.band("v", "r", 0.02, L.NATIONAL_BAND_LABELS), [(0.97, 1.0), (1.03, 1.0), (1.0, 1.0)],
               "v double, r double")
    assert got == list(L.NATIONAL_BAND_LABELS)


def test_surrogate_key_matches_convention(spark):
    import hashlib
    got = _one(spark, L.surrogate_key("a", "b"), [("x", None)], "a string, b string")[0]
    assert got == hashlib.md5(("x-" + L.SURROGATE_NULL).encode()).hexdigest()


def test_exact_avg_is_order_independent(spark):
    rows = [(0.1,)] * 7 + [(0.2,)] * 3
    a = spark.createDataFrame(rows, "v double").agg(exact_avg("v")).first()[0]
    b = spark.createDataFrame(list(reversed(rows)), "v double").repartition(5).agg(exact_avg("v")).first()[0]
    assert a == b == 0.13


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2025, 7, 14),)], "d date")
    rows = df.select(*CAL.calendar_columns("d")).collect()
    a, b = rows
    assert (a["semaine_iso"], a["debut_semaine"], a["jour_semaine"], a["jour_nom_fr"]) == \
        (1, dt.date(2024, 12, 30), 1, "Lundi")
    assert a["fin_trimestre"] == dt.date(2024, 12, 31) and a["mois_nom_fr"] == "Décembre"
    assert b["is_jour_ferie"] and not b["is_weekend"] and b["jour_nom_en"] == "Mon"
    assert CAL.iso_year(F.lit("2024-12-30").cast("date")) is not None


def test_configure_tolerates_static_confs(spark, monkeypatch):
    """configure() runs on sessions built elsewhere (the driver's): a conf that cannot be
    changed at runtime must not make every query fail."""
    from stationlens import session as S
    conf = dict(S.RUNTIME_CONF)
    conf["spark.sql.warehouse.dir"] = "/nonexistent/other-warehouse"  # static conf
    monkeypatch.setattr(S, "RUNTIME_CONF", conf)
    assert S.configure(spark) is spark
    assert "spark.python.sql.dataFrameDebugging.enabled" not in S.RUNTIME_CONF


def test_scale_conf_sizing():
    from stationlens.session import scale_conf
    big = scale_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    small = scale_conf(10 << 20, 64)  # tiny input: never fewer than 2x cores
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert small["spark.sql.files.maxPartitionBytes"] == str(512 << 20)
