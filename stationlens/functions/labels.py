"""Derived measures and labels (PRJ12-14, PRJ18, PRJ21-27, PRJ31, PRJ37, UDF2-4)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationlens.functions.cleaning import ColumnOrName, _c

# Fixed value: the marker that stands for NULL inside surrogate keys (identical keys
# require the same marker).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: ColumnOrName) -> Column:
    """PRJ37: md5 over '-'-joined string forms, NULL spelt as a fixed marker
    (the documented generate_surrogate_key convention)."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def pct_variation(cur: ColumnOrName, prev: ColumnOrName, digits: int = 2,
                  positive_only: bool = True) -> Column:
    """PRJ21 / UDF2: round((cur - prev) / prev * 100, digits).

    ``positive_only`` (the daily series rule) gives NULL unless prev > 0; otherwise
    only prev = 0 / NULL give NULL (the reusable macro's rule).
    """
    c, p = _c(cur), _c(prev)
    ratio = F.try_divide(c - p, p) * F.lit(100)
    guard = (p > F.lit(0)) if positive_only else (p.isNotNull() & c.isNotNull() & (p != F.lit(0)))
    return F.when(guard, F.round(ratio, digits))


def bucket(c: ColumnOrName, bounds: Sequence[float], labels: Sequence[str],
           null_label: str | None = None) -> Column:
    """PRJ22 / UDF4: first label whose upper bound (inclusive) holds; last label otherwise."""
    assert len(labels) == len(bounds) + 1
    col = _c(c)
    out = F.when(col.isNull(), F.lit(null_label)) if null_label is not None else None
    for b, lab in zip(bounds, labels):
        cond = col <= F.lit(b)
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(labels[-1]))


def trend(c: ColumnOrName, strong: float, mild: float, labels: Sequence[str],
          null_label: str | None = None) -> Column:
    """PRJ23 / UDF3: labels = (strong up, up, strong down, down, stable); tested in that order."""
    up2, up1, down2, down1, stable = labels
    col = _c(c)
    out = F.when(col.isNull(), F.lit(null_label)) if null_label is not None else None
    rules = [(col > F.lit(strong), up2), (col > F.lit(mild), up1),
             (col < F.lit(-strong), down2), (col < F.lit(-mild), down1)]
    for cond, lab in rules:
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(stable))


def band(value: ColumnOrName, ref: ColumnOrName, tolerance: float, labels: Sequence[str]) -> Column:
    """PRJ24: below / above / within ``ref`` +- tolerance (fraction)."""
    below, above, within = labels
    v, r = _c(value), _c(ref)
    return (F.when(v < r * F.lit(1 - tolerance), F.lit(below))
            .when(v > r * F.lit(1 + tolerance), F.lit(above))
            .otherwise(F.lit(within)))


def gap_pct(value: ColumnOrName, ref: ColumnOrName, digits: int = 2) -> Column:
    """PRJ25: round((v - ref) / ref * 100, digits); NULL when ref is 0 or NULL."""
    v, r = _c(value), _c(ref)
    return F.round(F.try_divide(v - r, F.nullif(r, F.lit(0))) * F.lit(100), digits)


def spread(cols: Iterable[ColumnOrName], low_sentinel=0, high_sentinel=999) -> Column:
    """PRJ26: greatest(coalesce(x, low)) - least(coalesce(x, high))."""
    cs = [_c(c) for c in cols]
    hi = F.greatest(*[F.coalesce(c, F.lit(low_sentinel)) for c in cs])
    lo = F.least(*[F.coalesce(c, F.lit(high_sentinel)) for c in cs])
    return hi - lo


def sql_str(s: str) -> str:
    """A Spark SQL string literal (backslash escapes are on by default)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def classify(c: ColumnOrName, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """PRJ12: ordered substring rules, first match wins (LIKE '%pat%' on the value).

    Given a column name, the rules become one SQL CASE expression (one call to the
    JVM instead of several per rule; the same plan either way)."""
    if isinstance(c, str):
        whens = " ".join(f"WHEN contains({_ident(c)}, {sql_str(p)}) THEN {sql_str(lab)}" for p, lab in rules)
        return F.expr(f"CASE {whens} ELSE {sql_str(default)} END") if whens else F.lit(default)
    out = None
    for pattern, label in rules:
        cond = c.contains(F.lit(pattern))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def map_code(c: ColumnOrName, groups: Sequence[tuple[str, Sequence[str]]],
             prefix_rules: Sequence[tuple[str, str]] = (), default: str | None = None) -> Column:
    """PRJ13: code-set membership -> label, then prefix rules, then default (in order).
    A column name gives one SQL CASE expression (see :func:`classify`)."""
    dflt_sql = sql_str(default) if default is not None else "CAST(NULL AS STRING)"
    if isinstance(c, str):
        col = _ident(c)
        whens = [f"WHEN {col} IN ({', '.join(sql_str(x) for x in codes)}) THEN {sql_str(label)}"
                 for label, codes in groups]
        whens += [f"WHEN startswith({col}, {sql_str(p)}) THEN {sql_str(label)}" for p, label in prefix_rules]
        return F.expr(f"CASE {' '.join(whens)} ELSE {dflt_sql} END") if whens else F.expr(dflt_sql)
    out = None
    for label, codes in groups:
        cond = c.isin(list(codes))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    for prefix, label in prefix_rules:
        cond = c.startswith(F.lit(prefix))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    dflt = F.lit(default) if default is not None else F.lit(None).cast("string")
    return out.otherwise(dflt) if out is not None else dflt


def lookup(c: ColumnOrName, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """PRJ14: value mapping through a literal map (no join)."""
    if not mapping:
        return F.lit(default).cast("string")
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = F.try_element_at(m, _c(c))
    return F.coalesce(hit, F.lit(default).cast("string")) if default is not None else hit


def weighted_score(terms: Sequence[tuple[Column, int, int]]) -> Column:
    """PRJ18: sum of (condition ? points_if : points_else)."""
    total = None
    for cond, yes, no in terms:
        t = F.when(cond, F.lit(yes)).otherwise(F.lit(no))
        total = t if total is None else total + t
    return total


def out_of_box(lat: ColumnOrName, lon: ColumnOrName, lat_range, lon_range, labels) -> tuple[Column, Column]:
    """PRJ33: (predicate, reason) for points outside a lat/lon box."""
    la, lo = _c(lat), _c(lon)
    (lat_lo, lat_hi), (lon_lo, lon_hi) = lat_range, lon_range
    pred = (la < lat_lo) | (la > lat_hi) | (lo < lon_lo) | (lo > lon_hi)
    reason = (F.when(la < lat_lo, F.lit(labels[0])).when(la > lat_hi, F.lit(labels[1]))
              .when(lo < lon_lo, F.lit(labels[2])).when(lo > lon_hi, F.lit(labels[3]))
              .otherwise(F.lit(labels[4])))
    return pred, reason


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical labels.
# ---------------------------------------------------------------------------

# Percentile bucket: upper bounds and labels (cheapest to dearest).
PERCENTILE_BOUNDS = (0.1, 0.25, 0.75, 0.9)
PERCENTILE_LABELS = ("Très bon marché", "Bon marché", "Prix moyen", "Cher", "Très cher")
UNKNOWN_LABEL = "Inconnu"

# Trend presets: (strong threshold, mild threshold, labels up2/up1/down2/down1/stable, null label).
TREND_LABELS = ("Forte hausse", "Hausse", "Forte baisse", "Baisse", "Stable")
WEEKLY_TREND_LABELS = ("Forte hausse", "Hausse modérée", "Forte baisse", "Baisse modérée", "Stable")
TREND_DAILY = (2.0, 0.5, TREND_LABELS, None)          # price fact, weekly variation
TREND_WEEKLY = (3.0, 1.0, WEEKLY_TREND_LABELS, None)   # weekly report
TREND_MACRO = (5.0, 1.0, TREND_LABELS, UNKNOWN_LABEL)  # reusable macro

# Band comparison against the national mean (+-2 %).
NATIONAL_BAND_TOLERANCE = 0.02
NATIONAL_BAND_LABELS = ("Moins cher que la moyenne", "Plus cher que la moyenne", "Dans la moyenne")

# Anomaly severity labels.
ANOMALY_LABELS = (
    "CRITICAL: Price anomaly (>3 std dev)",
    "WARNING: Unusual price (>2 std dev)",
    "WARNING: Large daily change (>10%)",
    "Normal",
)


def price_bucket(c: ColumnOrName, null_label: str | None = None) -> Column:
    return bucket(c, PERCENTILE_BOUNDS, PERCENTILE_LABELS, null_label)


def trend_preset(c: ColumnOrName, preset=TREND_DAILY) -> Column:
    strong, mild, labels, null_label = preset
    return trend(c, strong, mild, labels, null_label)
