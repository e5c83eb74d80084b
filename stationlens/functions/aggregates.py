"""Aggregate Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationlens.functions.cleaning import ColumnOrName, _c


def exact_avg(c: ColumnOrName, scale: int = 3, precision: int = 38) -> Column:
    """Mean as (exact DECIMAL sum) / count, returned as DOUBLE.

    Prices carry a fixed number of decimals; summing them as decimals makes the
    mean independent of partitioning and summation order (a double sum is not), so
    the same data gives bit-identical means on 8 or 8,000 tasks. The partial sums
    are still combined map-side like any sum.
    """
    col = _c(c)
    total = F.sum(col.cast(f"decimal({precision},{scale})")).cast("double")
    return F.try_divide(total, F.count(col).cast("double"))
