"""Table-generating operators (GEN1-3, PRJ16-17)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.functions.cleaning import _c, blank
from stationlens.functions.calendar import DAY_NAMES_FR, HOLIDAYS_FR, calendar_columns
from stationlens.functions.labels import surrogate_key


def literal_regex(sep: str) -> str:
    """Java-regex escape of a literal delimiter (Spark's split is regex-based)."""
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in sep)


def explode_list(df: DataFrame, col: str, sep: str, out: str, keep: Sequence[str]) -> DataFrame:
    """GEN1: one row per non-blank trimmed item of a delimited string.

    NULL or '' inputs produce no rows; blank items are dropped. The explode is a
    narrow (per-partition) generator: no shuffle.
    """
    items = F.explode(F.split(F.col(col), literal_regex(sep))).alias("_item")
    exploded = df.filter(~blank(col)).select(*keep, items)
    return (exploded.select(*keep, F.trim(F.col("_item")).alias(out))
            .filter(F.col(out) != F.lit("")))


# Day name (upper case) -> ISO day number.
DAY_NUMBERS = {name.upper(): i + 1 for i, name in enumerate(DAY_NAMES_FR)}


def explode_periods(df: DataFrame, col: str, keep: Sequence[str],
                    day_numbers: Mapping[str, int] = DAY_NUMBERS) -> DataFrame:
    """GEN2 + PRJ16/17: 'Day:closed:o-f;o-f|Day:...' -> one row per day.

    Columns: jour_numero, jour_nom, is_ferme, ouverture_1, fermeture_1, ouverture_2,
    fermeture_2, horaires_raw. Times are 'HH.MM' in the source and 'HH:MM' out.
    """
    day = F.explode(F.split(F.col(col), literal_regex("|"))).alias("_day")
    raw = df.filter(~blank(col)).select(*keep, day).select(*keep, F.trim("_day").alias("_day"))
    parsed = raw.select(
        *keep,
        F.trim(F.split_part("_day", F.lit(":"), F.lit(1))).alias("_name"),
        (F.trim(F.split_part("_day", F.lit(":"), F.lit(2))) == F.lit("1")).alias("is_ferme"),
        F.trim(F.split_part("_day", F.lit(":"), F.lit(3))).alias("horaires_raw"),
    ).filter(F.col("_name").isNotNull() & (F.trim("_name") != F.lit("")))

    h = F.col("horaires_raw")
    open_ = ~F.col("is_ferme")

    def part(period: int, side: int) -> Column:
        seg = F.split_part(h, F.lit(";"), F.lit(period))
        return F.replace(F.split_part(seg, F.lit("-"), F.lit(side)), F.lit("."), F.lit(":"))

    numbers = F.create_map(*[F.lit(x) for kv in day_numbers.items() for x in kv])
    has_first = open_ & (h != F.lit(""))
    has_second = open_ & h.contains(";")
    return parsed.select(
        *keep,
        F.try_element_at(numbers, F.upper("_name")).cast("int").alias("jour_numero"),
        F.initcap("_name").alias("jour_nom"),
        "is_ferme",
        F.when(has_first, part(1, 1)).alias("ouverture_1"),
        F.when(has_first, part(1, 2)).alias("fermeture_1"),
        F.when(has_second, part(2, 1)).alias("ouverture_2"),
        F.when(has_second, part(2, 2)).alias("fermeture_2"),
        "horaires_raw",
    )


def date_spine(spark: SparkSession, start: str | _dt.date, end_exclusive: str | _dt.date,
               name: str = "date_day") -> DataFrame:
    """GEN3: one row per day in [start, end). Generated by ``spark.range`` so the rows
    are produced in parallel, never materialised as one array."""
    s = _dt.date.fromisoformat(str(start))
    e = _dt.date.fromisoformat(str(end_exclusive))
    n = (e - s).days
    return spark.range(0, max(n, 0)).select(
        F.date_add(F.lit(s), F.col("id").cast("int")).alias(name))


def calendar(spark: SparkSession, start: str = "2023-01-01", end: str = "2030-12-31",
             holidays=HOLIDAYS_FR) -> DataFrame:
    """MOD11: calendar dimension over [start, end) (end exclusive, as the spine macro)."""
    spine = date_spine(spark, start, end)
    return spine.select(surrogate_key("date_day").alias("date_key"), "date_day",
                        *calendar_columns("date_day", holidays))


def calendar_span(df: DataFrame, day_col: str, holidays=HOLIDAYS_FR) -> DataFrame:
    """MOD11 over the observed date range of ``df`` (first to last day, inclusive).

    The bounds are one aggregate row; the spine length is the number of days in the
    range (bounded by the calendar, not by the row count)."""
    d = F.to_date(F.col(day_col))
    bounds = df.agg(F.min(d).alias("_lo"), F.max(d).alias("_hi"))
    spine = bounds.select(F.explode(F.sequence("_lo", "_hi")).alias("date_day"))
    return spine.select(surrogate_key("date_day").alias("date_key"), "date_day",
                        *calendar_columns("date_day", holidays))
