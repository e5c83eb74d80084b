"""Typed parsing and normalisation of raw string columns (PRJ1-11, PRJ15, SCA1-5).

Every builder returns a ``Column``; nothing here triggers a job or leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: ColumnOrName) -> Column:
    """PRJ8: trim + upper."""
    return F.upper(F.trim(_c(c)))


def safe_decimal(c: ColumnOrName, precision: int = 10, scale: int = 3) -> Column:
    """PRJ2: string -> DECIMAL(p, s), NULL when it does not parse (half-up at scale)."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def scaled_coordinate(c: ColumnOrName, scale: int = 100000,
                      precision: int = 15, digits: int = 5) -> Column:
    """PRJ3 / UDF1: raw integer-encoded coordinate -> decimal degrees (exact decimal division)."""
    return safe_decimal(c, precision, digits) / F.lit(scale)


def safe_ts(c: ColumnOrName, fmt: str | None = None) -> Column:
    """PRJ4: string -> TIMESTAMP_NTZ, NULL on failure or on ''.

    Without ``fmt`` the cast auto-detects ISO-like text (date, 'T' or ' ' separator,
    fractions); with ``fmt`` the text must match the pattern exactly.
    """
    col = _c(c)
    blank = col.isNull() | (col == F.lit(""))
    if fmt is None:
        parsed = col.try_cast("timestamp_ntz")
    else:
        parsed = F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")
    return F.when(blank, F.lit(None).cast("timestamp_ntz")).otherwise(parsed)


def to_day(c: ColumnOrName) -> Column:
    """PRJ5: date part of a timestamp."""
    return F.to_date(_c(c))


def null_flag(c: ColumnOrName) -> Column:
    """PRJ6: true when the typed value is missing (did not parse)."""
    return _c(c).isNull()


def range_flag(c: ColumnOrName, lo, hi) -> Column:
    """PRJ7: true when the value lies outside [lo, hi]; NULL is *not* out of range."""
    col = _c(c)
    return F.coalesce((col < F.lit(lo)) | (col > F.lit(hi)), F.lit(False))


def truthy(c: ColumnOrName, values: Iterable[str] = ("oui", "1")) -> Column:
    """PRJ11: case-insensitive membership in a set of true spellings; NULL -> false."""
    return F.coalesce(F.lower(_c(c)).isin(list(values)), F.lit(False))


def prefix_code(c: ColumnOrName, n: int = 2, extended_prefixes: Iterable[str] = (),
                extended_n: int = 3) -> Column:
    """PRJ9: first ``n`` characters; ``extended_n`` characters when the short code is
    one of ``extended_prefixes``."""
    col = _c(c)
    short = F.left(col, F.lit(n))
    ext = list(extended_prefixes)
    if not ext:
        return short
    return F.when(short.isin(ext), F.left(col, F.lit(extended_n))).otherwise(short)


def label_map(c: ColumnOrName, mapping: Mapping[str, str], default: str | None) -> Column:
    """PRJ10: code -> label with a default, first listed match wins."""
    col = _c(c)
    out = None
    for code, label in mapping.items():
        out = (F.when(col == F.lit(code), F.lit(label)) if out is None
               else out.when(col == F.lit(code), F.lit(label)))
    default_col = F.lit(default) if default is not None else F.lit(None).cast("string")
    return default_col if out is None else out.otherwise(default_col)


def blank(c: ColumnOrName) -> Column:
    """True for NULL or ''."""
    col = _c(c)
    return col.isNull() | (col == F.lit(""))


def ongoing_flag(end: ColumnOrName) -> Column:
    """PRJ15: open-ended interval (end missing or '')."""
    return blank(end)
