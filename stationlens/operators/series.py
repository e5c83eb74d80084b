"""Daily price series (AGG21, WIN1-3, PRJ21, PRJ29).

Grain after :func:`daily_last` is one row per (entity, product, day[, product id]);
every later window is partitioned by a series key, so a window partition never
holds more rows than there are days in a series -- the heavy lifting (many updates
per day) is folded by a hash aggregate with map-side combine first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlens.functions.labels import pct_variation, surrogate_key


def valid_observations(df: DataFrame, invalid: str = "is_prix_invalide",
                       suspect: str = "is_prix_suspect", day: str = "date_prix") -> DataFrame:
    """PRJ29: keep parsed, in-range, dated rows (pushed into the scan where possible)."""
    return df.filter(~F.col(invalid) & ~F.col(suspect) & F.col(day).isNotNull())


_SPAN = 10**16  # room for a packed value: 12 digits, up to 3 decimals, both signs


def daily_last(df: DataFrame, entity: str, product: str, day: str, ts: str, value: str,
               ids: Sequence[str] = (), last_ts: str = "derniere_maj",
               n_updates: str = "nb_updates_jour",
               cluster_by: Sequence[str] | None = None, scale: int = 3) -> DataFrame:
    """AGG21: last value of the day per (entity, product, day).

    * last = value at the latest ``ts``; equal timestamps resolve to the larger value
      (deterministic, unlike an order-by-time-only ``last_value``);
    * ``last_ts`` = latest update, ``n_updates`` = rows of the day;
    * ``ids`` (e.g. a product id) stay in the output grain: two ids for one
      product/day give two rows carrying the same name-level last value and count.

    One hash aggregation, no sort, one shuffle: time and value are packed into one
    DECIMAL (microseconds, then the value in units of 10**-``scale``), whose ``max`` is the
    last update with the larger value first among ties; the partial aggregate folds each
    task's share of a key, however hot, to one row before the shuffle. (``max_by`` over a
    struct, or collect_set, would force Spark's sort-based aggregation on every row.) Values
    must have at most ``scale`` decimals and 12 digits before them, and neither they nor the
    times may be NULL (``valid_observations``). With ids, the per-id rows of one product/day
    -- a handful -- are combined by a window over (keys).

    ``cluster_by`` (a subset of the keys, e.g. the entity) hash-partitions the
    aggregated rows once so that this window and the caller's next joins/windows on
    that subset need no further exchange.
    """
    keys = [entity, product, day]
    ids = list(ids)
    types = dict(df.dtypes)
    units = (F.col(value).cast(f"decimal({12 + scale},{scale})") * F.lit(10**scale)).cast("decimal(20,0)")
    at = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(20,0)")
    packed = (at * F.lit(_SPAN).cast("decimal(18,0)") + units + F.lit(_SPAN // 2)).cast("decimal(38,0)")
    per_id = df.groupBy(*keys, *ids).agg(F.max(packed).alias("_last"), F.count(F.lit(1)).alias(n_updates))
    micros = F.expr(f"_last div {_SPAN}BD")
    unpacked = (F.col("_last") - micros.cast("decimal(20,0)") * F.lit(_SPAN).cast("decimal(18,0)") - F.lit(_SPAN // 2))
    per_id = per_id.select(*keys, *ids, F.try_divide(unpacked.cast("decimal(20,0)"), F.lit(10**scale)).cast(
        f"decimal({12 + scale},{scale})").cast(types[value]).alias(value),
        F.timestamp_micros(micros).cast(types[ts]).alias(last_ts), n_updates)
    if not ids:
        return per_id.select(*keys, value, last_ts, F.col(n_updates).cast("long").alias(n_updates))
    if cluster_by:
        per_id = per_id.repartition(*cluster_by)
    w = Window.partitionBy(*keys)
    return per_id.select(
        *keys, *ids,
        F.max_by(value, F.struct(F.col(last_ts), F.col(value))).over(w).alias(value),
        F.max(last_ts).over(w).alias(last_ts),
        F.sum(n_updates).over(w).cast("long").alias(n_updates))


def add_lags(df: DataFrame, series: Sequence[str], order: Sequence[str | Column], value: str,
             lags: Mapping[int, str]) -> DataFrame:
    """WIN3: value ``n`` observed rows earlier in each series (row-count semantics)."""
    w = Window.partitionBy(*series).orderBy(*order)
    return df.select("*", *[F.lag(value, n).over(w).alias(name) for n, name in lags.items()])


def add_calendar_lags(df: DataFrame, series: Sequence[str], day: str, value: str,
                      lags: Mapping[int, str]) -> DataFrame:
    """WIN3 calendar-exact variant: value exactly ``n`` calendar days earlier (NULL when
    that day was not observed). Same partitioning as :func:`add_lags`; a RANGE frame of
    width zero at offset -n, so no self-join."""
    day_num = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    tmp = df.withColumn("_day_num", day_num)
    w = Window.partitionBy(*series).orderBy("_day_num")
    cols = [F.max(value).over(w.rangeBetween(-n, -n)).alias(name) for n, name in lags.items()]
    return tmp.select("*", *cols).drop("_day_num")


def variation_columns(value: str, prev: str, abs_name: str, pct_name: str,
                      digits: int = 2) -> list[Column]:
    """PRJ21: absolute change and guarded percentage change."""
    v, p = F.col(value), F.col(prev)
    return [(v - p).alias(abs_name), pct_variation(v, p, digits).alias(pct_name)]


DEFAULT_LAGS = {1: "prix_veille", 7: "prix_semaine_precedente", 30: "prix_mois_precedent"}
VARIATION_NAMES = {
    "prix_veille": ("variation_jour", "variation_jour_pct"),
    "prix_semaine_precedente": ("variation_semaine", "variation_semaine_pct"),
    "prix_mois_precedent": ("variation_mois", "variation_mois_pct"),
}


def add_variations(df: DataFrame, entity: str, product: str, day: str, value: str,
                   tiebreak: Sequence[str] = (), lags: Mapping[int, str] = DEFAULT_LAGS,
                   names: Mapping[str, tuple[str, str]] = VARIATION_NAMES,
                   calendar_exact: bool = False) -> DataFrame:
    """WIN3 + PRJ21: lags per (entity, product) by day and the derived variations."""
    if calendar_exact:
        out = add_calendar_lags(df, [entity, product], day, value, lags)
    else:
        ties = [F.col(t).asc_nulls_last() if isinstance(t, str) else t for t in tiebreak]
        out = add_lags(df, [entity, product], [F.col(day).asc_nulls_last(), *ties], value, lags)
    extra = []
    for prev in lags.values():
        a, p = names[prev]
        extra += variation_columns(value, prev, a, p)
    return out.select("*", *extra)


def price_series(prices: DataFrame, entities: DataFrame, entity: str = "station_id",
                 product: str = "carburant_nom", product_id: str = "carburant_id",
                 day: str = "date_prix", ts: str = "date_maj", value: str = "prix_euros",
                 attributes: Sequence[str] = ("code_departement", "region", "type_station"),
                 rank_groups: Mapping[str, Sequence[str]] | None = None,
                 calendar_exact: bool = False,
                 entity_key: str | None = None, ranked: bool = True) -> DataFrame:
    """MOD7: valid rows -> daily last value -> entity attributes -> lags/variations -> ranks.

    Windows: lags partition by (entity, product) (one series, at most one row per day
    and id); ranks within (product, day) and finer groups are numbered in slices of the rows'
    order (see operators.ranking) and share one exchange. ``entity_key`` carries the entity
    dimension's surrogate key from the attribute join (NULL for unknown entities), so
    the fact needs no second join with the entity dimension. ``ranked=False`` leaves out the ranks
    and the percentile, for consumers that read none of them (no optimizer rule removes the
    joins and the exchange behind unread window columns).
    """
    from stationlens.operators.ranking import add_ranks, order_bounds

    valid = valid_observations(prices, day=day)
    daily = daily_last(valid, entity, product, day, ts, value,
                       ids=[product_id] if product_id else (), cluster_by=[entity])
    key_col = [surrogate_key(entity).alias(entity_key)] if entity_key else []
    attrs = entities.select(entity, *attributes, *key_col)
    with_attrs = daily.join(attrs, entity, "left")
    tiebreak = [product_id] if product_id else []
    varied = add_variations(with_attrs, entity, product, day, value, tiebreak=tiebreak,
                            calendar_exact=calendar_exact)
    groups = rank_groups if rank_groups is not None else {
        "rang_national": [], "rang_departement": ["code_departement"], "rang_region": ["region"]}
    order = [product, day, value, entity, *tiebreak]
    done = add_ranks(varied, [product, day], value, groups, tiebreak=[entity, *tiebreak], percent="percentile_national",
                     bounds=order_bounds(valid, order, counted=prices)) if ranked else varied
    lag_cols = []
    for prev, (a, p) in VARIATION_NAMES.items():
        lag_cols += [prev, a, p]
    rank_cols = [*groups, "percentile_national"] if ranked else []
    return done.select(entity, product, *tiebreak, *attributes, day, value, "derniere_maj",
                       "nb_updates_jour", *lag_cols, *rank_cols, *([entity_key] if entity_key else []))
