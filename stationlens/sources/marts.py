"""Mart sinks and readers (SRC11-SRC13).

* marts are published: a new version is written beside the old one and a manifest switches readers to
  it (see ``sources.tables``);
* the fact is laid out for pruning: one directory per month, rows range-partitioned
  and sorted by (date, product, entity) so Parquet min/max statistics are tight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.sources.tables import Version, publish, read_table

MONTH_COL = "mois_prix"  # fact partition column: first day of the month (DATE)


def write_mart(df: DataFrame, path: str, ranges: Sequence[str] = ()) -> Version:
    """SRC11: full rebuild of a mart table; readers see the old one until the new one is whole."""
    return publish(df, path, ranges=ranges)


def write_fact(df: DataFrame, path: str, day: str = "date_prix", product: str = "carburant_nom",
               tail: Sequence[str] = ("station_id", "carburant_id"), ranges: Sequence[str] = (),
               num_partitions: int | None = None) -> Version:
    """SRC12: clustered fact: month directories, range-partitioned and sorted by (day, product,
    ``tail``) inside. Date filters prune directories, then row groups. The tail is part of the range
    bounds, so one (day, product), however large, is split over as many tasks as its share is worth.

    Without ``num_partitions`` the range exchange is left to AQE, which coalesces it to
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` -- file sizes follow the data
    instead of the shuffle-partition count (which, sized for the raw input, would
    write thousands of tiny files per month)."""
    order = [day, product, *[c for c in tail if c in df.columns]]
    with_month = df.withColumn(MONTH_COL, F.trunc(F.col(day), "month"))
    ranged = with_month.repartitionByRange(num_partitions, *order) if num_partitions else with_month.repartitionByRange(*order)
    return publish(ranged.sortWithinPartitions(*order), path, partition_by=[MONTH_COL], ranges=[day, *ranges])


def read_mart(spark: SparkSession, path: str, lower: bool = True) -> DataFrame:
    """SRC13: mart scan with lower-cased column names."""
    df = read_table(spark, path)
    return df.toDF(*[c.lower() for c in df.columns]) if lower else df
