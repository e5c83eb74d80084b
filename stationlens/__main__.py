"""Command line: the three things the reference is run for.

  python -m stationlens ingest --feed FEED_DIR --raw RAW_DIR [--as-of TS]
  python -m stationlens build  --raw RAW_DIR --out MARTS_DIR [--as-of TS] [--seed CSV] [--weekly-compat]
  python -m stationlens query  --out MARTS_DIR NAME [--product P] [--region R] [--city C]
                               [--department D] [--n N]

Query names: cheapest, regional, products, search, kpis, cities, distribution, dates,
latest, tables. On a cluster, submit with spark-submit and set spark.checkpoint.dir.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import DataFrame, SparkSession

QUERIES = ("cheapest", "regional", "products", "search", "kpis", "cities", "distribution", "dates",
           "latest", "tables")


def _ts(text: str | None) -> dt.datetime:
    return dt.datetime.fromisoformat(text) if text else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def run_query(spark: SparkSession, out: str, name: str, product: str = "GAZOLE", region: str | None = None,
              city: str | None = None, department: str | None = None, n: int = 20) -> DataFrame:
    """One dashboard query over the stored marts (QRY1-QRY11)."""
    from stationlens.operators import dashboard as D
    from stationlens.sources.marts import read_mart
    from stationlens.sources.tables import table_facts

    def mart(m: str) -> DataFrame:
        return read_mart(spark, f"{out}/{m}")

    if name == "cheapest":
        return D.cheapest_stations(mart("rpt_stations_moins_cheres"), product, region, n)
    if name == "regional":
        return D.regional_latest(mart("rpt_prix_moyen_region"))
    if name == "products":
        return D.products(mart("dim_produits"))
    if name in ("search", "kpis"):
        sel = D.search_selection(mart("fct_prix_produits"), mart("dim_stations"), product, city, department)
        return D.selection_kpis(sel) if name == "kpis" else D.search_stations(sel)
    if name == "cities":
        return D.cities_top(mart("dim_stations"), department or "")
    if name == "distribution":
        return D.product_distribution(mart("fct_prix_produits"), mart("dim_stations"), department or "")
    if name == "dates":
        return D.product_date_range(mart("fct_prix_produits"), mart("dim_stations"), department or "")
    if name == "latest":
        return D.latest_dates(mart("fct_prix_produits"))
    if name == "tables":
        names = ("dim_stations", "dim_produits", "dim_regions", "dim_date", "fct_prix_produits",
                 "rpt_stations_moins_cheres", "rpt_prix_moyen_region", "rpt_evolution_prix_hebdo")
        return table_facts(spark, {m: f"{out}/{m}" for m in names}).select("table_name", "row_count")
    raise ValueError(f"unknown query {name!r}; one of {QUERIES}")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stationlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p_in = sub.add_parser("ingest")
    p_in.add_argument("--feed", required=True)
    p_in.add_argument("--raw", required=True)
    p_in.add_argument("--as-of")
    p_b = sub.add_parser("build")
    p_b.add_argument("--raw", required=True)
    p_b.add_argument("--out", required=True)
    p_b.add_argument("--as-of")
    p_b.add_argument("--seed")
    p_b.add_argument("--weekly-compat", action="store_true")
    p_q = sub.add_parser("query")
    p_q.add_argument("--out", required=True)
    p_q.add_argument("name", choices=QUERIES)
    p_q.add_argument("--product", default="GAZOLE")
    p_q.add_argument("--region")
    p_q.add_argument("--city")
    p_q.add_argument("--department")
    p_q.add_argument("--n", type=int, default=20)
    args = ap.parse_args(argv)

    from stationlens.session import configure, get_spark
    spark = configure(spark or SparkSession.getActiveSession() or get_spark())
    if args.cmd == "ingest":
        from stationlens.sources.raw import ingest
        print(json.dumps(ingest(spark, args.feed, args.raw, _ts(args.as_of))))
    elif args.cmd == "build":
        from stationlens.plans.build import BuildConfig, build
        cfg = BuildConfig(raw_base=args.raw, out_base=args.out, as_of=_ts(args.as_of),
                          seed_path=args.seed, weekly_compat=args.weekly_compat)
        print(json.dumps(build(spark, cfg)))
    else:
        df = run_query(spark, args.out, args.name, args.product, args.region, args.city, args.department, args.n)
        df.show(args.n, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
