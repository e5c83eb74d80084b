"""Calendar attributes of a DATE column (PRJ34-36, SCA6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationlens.functions.cleaning import ColumnOrName, _c

# Localised names (index 0 = January / Monday) and the fixed-date holidays.
MONTH_NAMES_FR = ("Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet", "Août",
                  "Septembre", "Octobre", "Novembre", "Décembre")
DAY_NAMES_FR = ("Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche")
HOLIDAYS_FR = ((1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25))


def iso_weekday(d: ColumnOrName) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(_c(d)) + F.lit(1)).cast("int")


def week_start(d: ColumnOrName) -> Column:
    """Monday of the ISO week."""
    return F.trunc(_c(d), "week").cast("date")


def iso_year(d: ColumnOrName) -> Column:
    """ISO week-numbering year: the year of the week's Thursday."""
    return F.year(F.date_add(week_start(d), 3)).cast("int")


def holiday_flag(d: ColumnOrName, holidays: Sequence[tuple[int, int]] = HOLIDAYS_FR) -> Column:
    col = _c(d)
    cond = F.lit(False)
    for m, day in holidays:
        cond = cond | ((F.month(col) == m) & (F.dayofmonth(col) == day))
    return cond


def calendar_columns(d: ColumnOrName, holidays: Sequence[tuple[int, int]] = HOLIDAYS_FR) -> list[Column]:
    """The calendar dimension's attribute columns for date column ``d``."""
    col = _c(d)
    q_start = F.trunc(col, "quarter")
    wd = iso_weekday(col)
    months_fr = F.array(*[F.lit(x) for x in MONTH_NAMES_FR])
    days_fr = F.array(*[F.lit(x) for x in DAY_NAMES_FR])
    return [
        F.year(col).cast("int").alias("annee"),
        F.trunc(col, "year").alias("debut_annee"),
        F.make_date(F.year(col), F.lit(12), F.lit(31)).alias("fin_annee"),
        F.quarter(col).cast("int").alias("trimestre"),
        q_start.alias("debut_trimestre"),
        F.date_sub(F.add_months(q_start, 3), 1).alias("fin_trimestre"),
        F.month(col).cast("int").alias("mois"),
        F.date_format(col, "MMMM").alias("mois_nom_en"),
        F.element_at(months_fr, F.month(col)).alias("mois_nom_fr"),
        F.trunc(col, "month").alias("debut_mois"),
        F.last_day(col).alias("fin_mois"),
        F.weekofyear(col).cast("int").alias("semaine_annee"),
        week_start(col).alias("debut_semaine"),
        F.date_add(week_start(col), 6).alias("fin_semaine"),
        F.weekofyear(col).cast("int").alias("semaine_iso"),
        wd.alias("jour_semaine"),
        F.date_format(col, "EEE").alias("jour_nom_en"),
        F.element_at(days_fr, wd).alias("jour_nom_fr"),
        F.dayofmonth(col).cast("int").alias("jour_mois"),
        F.dayofyear(col).cast("int").alias("jour_annee"),
        (wd >= 6).alias("is_weekend"),
        (wd < 6).alias("is_weekday"),
        holiday_flag(col, holidays).alias("is_jour_ferie"),
        F.add_months(col, -12).alias("prior_year_date_day"),
    ]
