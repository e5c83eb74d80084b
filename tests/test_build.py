"""End-to-end: XML feed -> raw tables -> full build (twice: history gets version 1)."""

import datetime as dt
import os

from stationlens.plans.build import BuildConfig, build
from stationlens.sources import marts as M
from stationlens.sources import segments as S
from stationlens.sources.raw import ingest
from test_sources import AS_OF, _feed_file


def test_full_build(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    out = os.path.join(tmp_dir, "marts")
    ingest(spark, _feed_file(tmp_dir), raw, AS_OF)
    cfg = BuildConfig(raw_base=raw, out_base=out, as_of=AS_OF + dt.timedelta(hours=1))
    info = build(spark, cfg)
    assert info["entities"] == 2
    fact = M.read_mart(spark, f"{out}/fct_prix_produits")
    assert fact.count() == 2
    rep = M.read_mart(spark, f"{out}/rpt_stations_moins_cheres").collect()
    assert {r["carburant_nom"] for r in rep} == {"GAZOLE", "SP95"}
    q = {r["check_name"]: r["failures"] for r in M.read_mart(spark, f"{out}/quality_results").collect()}
    assert q["unique_station_id"] == 0 and q["orphan_prices"] == 0 and len(q) > 40
    assert M.read_mart(spark, f"{out}/source_freshness").count() == 3
    assert M.read_mart(spark, f"{out}/freshness_monitors").count() > 0
    st = {r["station_id"]: r for r in M.read_mart(spark, f"{out}/dim_stations").collect()}
    assert st["1001"]["region"] == "Île-de-France" and st["1002"]["region"] == "DOM-TOM"
    assert st["1001"]["services_list"] == "BOUTIQUE, LAVAGE AUTOMATIQUE" and st["1001"]["has_lavage"]
    build(spark, cfg)  # second run: next history segment, unchanged rows stay open
    assert S.open_history(spark, f"{out}/snap_prix").run == 1
    h = S.read_history(spark, f"{out}/snap_prix")
    assert h.filter("valid_to IS NULL").count() == 2


def test_cli_ingest_build_query(spark, tmp_dir, capsys):
    from stationlens.__main__ import QUERIES, main, run_query
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "marts")
    assert main(["ingest", "--feed", _feed_file(tmp_dir), "--raw", raw, "--as-of", "2024-01-01T12:00:00"], spark) == 0
    assert main(["build", "--raw", raw, "--out", out, "--as-of", "2024-01-01T13:00:00"], spark) == 0
    for name in QUERIES:
        df = run_query(spark, out, name, product="GAZOLE", city="paris", department="75")
        df.collect()
    got = run_query(spark, out, "search", product="GAZOLE", city="paris").collect()
    assert [r["station_id"] for r in got] == ["1001"]
    kp = run_query(spark, out, "kpis", product="SP95", department="75").first()
    assert kp["nb_stations"] == 1 and float(kp["prix_min"]) == 1.899
    assert main(["query", "--out", out, "cheapest", "--product", "SP95"], spark) == 0
    assert "1001" in capsys.readouterr().out


def test_a_drop_between_builds_is_flagged(spark):
    from stationlens.operators.anomalies import run_volume_anomalies
    at = lambda i: dt.datetime(2024, 1, 1 + i)
    rows = [("dim_stations", at(i), n) for i, n in enumerate([100, 104, 101, 103, 102, 100, 104, 101, 103, 102])] + [("dim_stations", at(10), 40), ("dim_regions", at(10), 13)]
    df = spark.createDataFrame(rows, "table_name string, run_at timestamp_ntz, row_count long")
    got = run_volume_anomalies(df, {"dim_stations": 2.0}).filter("is_anomaly").collect()
    assert [(r["table_name"], r["bucket_start"], r["row_count"]) for r in got] == [("dim_stations", at(10), 40)]


def test_selection_reads_above_the_listing(spark):
    """KPIs and map read the whole selection; only the listing is cut."""
    from stationlens.operators import dashboard as D
    n, day = 700, dt.date(2024, 1, 10)
    fact = spark.createDataFrame([(f"s{i}", "P", "1", day, 1.0 + i, "c", "t", i + 1, i + 1) for i in range(n)],
                                 "station_id string, carburant_nom string, carburant_id string, date_prix date, prix_euros double, "
                                 "categorie_prix string, tendance_prix string, rang_national long, rang_region long")
    ent = spark.createDataFrame([(f"s{i}", "Ville", "a", "75001", "75", "IDF", "Route", True, 48.0, 2.0) for i in range(n)],
                                "station_id string, ville string, adresse string, code_postal string, code_departement string, "
                                "region string, type_station string, is_automate_24_24 boolean, latitude double, longitude double")
    sel = D.search_selection(fact, ent, "P", city="vil")
    k = D.selection_kpis(sel).first()
    assert (k["nb_stations"], k["prix_max"], D.map_points(sel).count()) == (n, float(n), n)
    assert D.search_stations(sel).count() == 500
