"""Staging edge rows (FIXTURES.md section 2)."""

import datetime as dt

from pyspark.sql import functions as F

from stationlens.plans import fuel
from stationlens.sources.raw import RAW_PRICES, RAW_SHORTAGES, RAW_STATIONS

T0 = dt.datetime(2024, 1, 1, 6, 0, 0)


def station_row(sid, lat="4885660", lon="235220", cp="75001", pop="R", adresse="a", ville="Paris",
                services="", automate="", hours=""):
    return (sid, lat, lon, cp, pop, adresse, ville, services, automate, hours, T0)


def test_clean_stations_edges(spark):
    rows = [
        station_row(None),
        station_row("1", lat="x"), station_row("2", lat=""), station_row("3", lat="4859912.3"),
        station_row("4", cp=" 2a004 ", pop="r"), station_row("5", cp="20000", pop="A"),
        station_row("6", cp="97110", pop=None), station_row("7", cp="98800", automate="Oui"),
        station_row("8", cp="01000", automate="1"), station_row("9", automate=None),
    ]
    df = fuel.clean_stations(spark.createDataFrame(rows, RAW_STATIONS))
    got = {r["station_id"]: r for r in df.collect()}
    assert None not in got and len(got) == 9
    assert got["1"]["latitude"] is None and got["2"]["latitude"] is None
    assert float(got["3"]["latitude"]) == 48.599123
    assert got["4"]["code_postal"] == "2A004" and got["4"]["code_departement"] == "2A"
    assert got["4"]["type_station"] == "Route" and got["5"]["type_station"] == "Autoroute"
    assert got["6"]["type_station"] == "Inconnu"
    assert got["6"]["code_departement_extended"] == "971"
    assert got["7"]["code_departement_extended"] == "988"
    assert got["5"]["code_departement_extended"] == "20"
    assert got["7"]["is_automate_24_24"] and got["8"]["is_automate_24_24"]
    assert not got["9"]["is_automate_24_24"] and not got["1"]["is_automate_24_24"]
    assert fuel.region_of is not None


def test_region_mapping(spark):
    df = spark.createDataFrame([("75",), ("2A",), ("20",), ("971",), ("98",), ("01",), (None,)], "d string")
    got = [r[0] for r in df.select(fuel.region_of(F.col("d"))).collect()]
    assert got == ["Île-de-France", "Corse", "Corse", "DOM-TOM", "Autre", "Auvergne-Rhône-Alpes", "Autre"]


def test_clean_prices_flags(spark):
    vals = ["abc", "0.499", "0.5", "5.0", "5.001", None]
    rows = [("s", "gazole ", " 1 ", v, "2024-01-01 08:00:00", T0) for v in vals]
    rows.append(("s", "SP95", "2", "1.8", "not a time", T0))
    df = fuel.clean_prices(spark.createDataFrame(rows, RAW_PRICES))
    got = {(r["prix_euros"] and float(r["prix_euros"])): r for r in df.collect() if r["date_maj"]}
    assert len(df.collect()) == 6  # NULL value dropped
    inv = [r for r in df.collect() if r["is_prix_invalide"]]
    assert len(inv) == 1 and not inv[0]["is_prix_suspect"]
    assert got[0.499]["is_prix_suspect"] and got[5.001]["is_prix_suspect"]
    assert not got[0.5]["is_prix_suspect"] and not got[5.0]["is_prix_suspect"]
    assert got[0.5]["carburant_nom"] == "GAZOLE" and got[0.5]["carburant_id"] == "1"
    bad = [r for r in df.collect() if r["date_maj"] is None]
    assert len(bad) == 1 and bad[0]["date_prix"] is None


def test_services_unpivot(spark):
    rows = [station_row("1", services=""), station_row("2", services=None),
            station_row("3", services="a,,b"), station_row("4", services="Boutique lavage,Wifi,Wifi"),
            station_row("5", services="Station de gonflage, DAB ")]
    df = fuel.station_services(spark.createDataFrame(rows, RAW_STATIONS))
    got = sorted((r["station_id"], r["service_nom"], r["service_categorie"]) for r in df.collect())
    assert got == [("3", "A", "Autre"), ("3", "B", "Autre"), ("4", "BOUTIQUE LAVAGE", "Lavage"),
                   ("4", "WIFI", "Commodités"), ("5", "DAB", "Paiement"), ("5", "STATION DE GONFLAGE", "Entretien")]


def test_opening_hours(spark):
    h = "Lundi::08.00-12.00;14.00-20.00|Dimanche:1:|Mardi::|Funday::01.00-02.00|"
    rows = [station_row("1", hours=h), station_row("2", hours="")]
    df = fuel.opening_hours(spark.createDataFrame(rows, RAW_STATIONS))
    got = {r["jour_nom"]: r for r in df.collect()}
    assert set(got) == {"Lundi", "Dimanche", "Mardi", "Funday"}
    lun = got["Lundi"]
    assert (lun["jour_numero"], lun["ouverture_1"], lun["fermeture_1"], lun["ouverture_2"], lun["fermeture_2"]) == \
        (1, "08:00", "12:00", "14:00", "20:00")
    assert got["Dimanche"]["is_ferme"] and got["Dimanche"]["ouverture_1"] is None
    assert not got["Mardi"]["is_ferme"] and got["Mardi"]["ouverture_1"] is None
    assert got["Funday"]["jour_numero"] is None


def test_shortages(spark):
    rows = [("1", " sp95 ", "2", "2024-01-01 00:00:00", "", "temporaire", T0),
            ("1", "E10", "4", "2024-01-01T00:00:00", None, "x", T0),
            ("1", "E85", "5", "2024-01-01 00:00:00", "2024-01-02 10:00:00", "y", T0),
            (None, "E85", "5", "", "", "y", T0)]
    df = fuel.shortages(spark.createDataFrame(rows, RAW_SHORTAGES))
    got = {r["carburant_nom"]: r for r in df.collect()}
    assert len(got) == 3
    assert got["SP95"]["is_en_cours"] and got["E10"]["is_en_cours"] and not got["E85"]["is_en_cours"]
    assert got["E10"]["date_debut"] is None  # 'T' separator rejected by the explicit pattern
    assert got["E85"]["date_fin"] == dt.datetime(2024, 1, 2, 10, 0)
    assert got["SP95"]["type_rupture"] == "TEMPORAIRE"


def test_keep_latest_station(spark):
    t1 = dt.datetime(2024, 1, 2)
    rows = [station_row("1", adresse="old"), ("1", "1", "1", "75001", "R", "new", "P", "", "", "", t1),
            station_row("2")]
    st = fuel.clean_stations(spark.createDataFrame(rows, RAW_STATIONS))
    got = {r["station_id"]: r["adresse"] for r in fuel.keep_latest_station(st).collect()}
    assert got == {"1": "new", "2": "a"}
