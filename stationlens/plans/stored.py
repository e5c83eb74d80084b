"""The marts of the test tables as a build stores them: what the dashboard queries, the declared checks
and the monitors read. They are built and published once in an application and test folder; the queries
over them read the published tables, as a dashboard does."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.plans import adapters as A
from stationlens.plans import fuel
from stationlens.plans.build import Models, publish_models
from stationlens.session import checkpoint_dir
from stationlens.sources.marts import read_mart
from stationlens.sources.raw import read_seed

_built: dict[tuple[str, str], Models] = {}
_runs = itertools.count()


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{checkpoint_dir(spark)}/{name}-{spark.sparkContext.applicationId}-{next(_runs)}"


def seed_table(spark: SparkSession, out: str) -> DataFrame:
    """SRC9: the product reference rows as a CSV file, read with their types."""
    fuel.product_seed(spark).coalesce(1).write.mode("overwrite").csv(f"{out}/types.csv", header=True)
    return read_seed(spark, f"{out}/types.csv", fuel.PRODUCT_SEED_SCHEMA)


def models(spark: SparkSession, sf_dir: str) -> Models:
    """The published models of a test folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        out = folder(spark, "marts")
        raw = {"stations": A.raw_stations(spark, sf_dir), "prices": A.raw_prices(spark, sf_dir), "shortages": A.raw_shortages(spark, sf_dir)}
        _built[key] = publish_models(spark, out, raw, seed_table(spark, out), A.AS_OF_EVENTS, A.EVENT_PRICE_BOUNDS, price_type="double")
    return _built[key]


def mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_mart(spark, f"{models(spark, sf_dir).out}/{name}")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir, "fct_prix_produits")


def latest_day(spark: SparkSession, sf_dir: str):
    """The fact's latest day, from its manifest."""
    from stationlens.sources.tables import current
    v = current(spark, f"{models(spark, sf_dir).out}/fct_prix_produits")
    return F.lit(v.greatest["date_prix"]).cast("date")
