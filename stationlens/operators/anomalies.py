"""Price anomalies and table monitors (OBS1, OBS2, OBS4 = MOD16; AGG11, JOI7, PRJ31, SRT2).

Group statistics are computed with a hash aggregate (partial + final) and joined back
-- never a window over a (region, product, day) partition, which would put a hot
group into one task. The joined statistics table has one row per group.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens.functions.aggregates import exact_avg
from stationlens.functions.labels import ANOMALY_LABELS
from stationlens.operators.enrich import ts_literal
from stationlens.operators.ranking import summed
from stationlens.operators.reports import slice_since


def price_anomalies(fact: DataFrame, dim_entity: DataFrame, as_of, days: int = 7,
                    z_warn: float = 2.0, z_crit: float = 3.0, jump_pct: float = 10.0,
                    group: str = "region", entity: str = "station_id",
                    product: str = "carburant_nom", value: str = "prix_euros",
                    day: str = "date_prix", change: str = "variation_jour_pct",
                    tiebreak: tuple[str, ...] = ("carburant_id",)) -> DataFrame:
    """OBS4: z-score of each price against its (group, product, day) mean over the last
    ``days`` days, a large-daily-change rule, a severity label: all anomalies, in no order
    (see :func:`top_anomalies`)."""
    keys = [group, product, day]
    # rows and statistics read one exchange, dealt by entity
    f = slice_since(fact, day, as_of, days).select(*keys, entity, value, change, *tiebreak).repartition(entity)
    stats = summed(f, keys, exact_avg(value).alias("regional_avg"), F.stddev_samp(value).alias("_std"))
    ent = dim_entity.select(F.col(entity).alias("_e"), "ville", "adresse")
    sp = (f.join(ent, f[entity] == ent["_e"], "inner")
          .join(stats, keys, "inner"))
    z = F.try_divide(F.col(value) - F.col("regional_avg"), F.nullif(F.col("_std"), F.lit(0)))
    sp = sp.select("*", z.alias("_z"))
    az, ach = F.abs(F.col("_z")), F.abs(F.col(change))
    crit, warn, jump, normal = ANOMALY_LABELS
    status = (F.when(az > z_crit, F.lit(crit)).when(az > z_warn, F.lit(warn))
              .when(ach > jump_pct, F.lit(jump)).otherwise(F.lit(normal)))
    return sp.filter((az > z_warn) | (ach > jump_pct)).select(
        entity, "ville", "adresse", group, product, day, value, "regional_avg",
        F.round("_z", 2).alias("z_score"), F.round(change, 2).alias(change),
        status.alias("anomaly_status"), *tiebreak)


def top_anomalies(anomalies: DataFrame, n: int = 100) -> DataFrame:
    """SRT2: the ``n`` most extreme anomalies. Ordered by the reported (rounded) score: ties
    resolve on day and keys, independently of last-bit differences in the deviation."""
    return anomalies.orderBy(
        F.abs("z_score").desc_nulls_first(), F.col("date_prix").desc_nulls_first(),
        *[F.col(c).asc_nulls_last() for c in ("station_id", "carburant_nom", "carburant_id")]).limit(n)


def _bucket_spine(df: DataFrame, bucket_col: str, step_seconds: int) -> DataFrame:
    """Every bucket start between the first and last observed bucket (gap filling).
    The spine is generated from a one-row range by ``sequence``: its length is the
    number of buckets in the observed time span, not the number of rows."""
    bounds = df.agg(F.min(bucket_col).alias("_lo"), F.max(bucket_col).alias("_hi"))
    return bounds.select(F.explode(F.sequence(
        F.col("_lo"), F.col("_hi"), F.make_dt_interval(secs=F.lit(step_seconds)))).alias(bucket_col))


def bucket_state(df: DataFrame, ts: str, bucket: str = "1 day") -> DataFrame:
    """What the monitors need of a table: (bucket_start, row_count, last_ts) of each time bucket. The states
    of two loads add up to the state of both (:func:`merge_states`), so a table that grows by loads is
    monitored without reading it again."""
    return df.filter(F.col(ts).isNotNull()).groupBy(F.window(F.col(ts), bucket).start.cast("timestamp_ntz").alias("bucket_start")) \
        .agg(F.count(F.lit(1)).alias("row_count"), F.max(ts).alias("last_ts"))


def merge_states(*states: DataFrame) -> DataFrame:
    both = functools.reduce(DataFrame.unionByName, states)
    return both.groupBy("bucket_start").agg(F.sum("row_count").alias("row_count"), F.max("last_ts").alias("last_ts"))


def volume_anomalies(df: DataFrame, ts: str, bucket: str = "1 day", step_seconds: int = 86400,
                     sensitivity: float = 3.0, trailing: int = 14, table: str = "table") -> DataFrame:
    """OBS1: rows per time bucket, z-score against the ``trailing`` previous buckets
    (empty buckets count as 0); anomaly when |z| > sensitivity."""
    return state_volume_anomalies(bucket_state(df, ts, bucket), step_seconds, sensitivity, trailing, table)


def state_volume_anomalies(state: DataFrame, step_seconds: int = 86400, sensitivity: float = 3.0, trailing: int = 14,
                           table: str = "table") -> DataFrame:
    """OBS1 from a table's state (a row a bucket)."""
    counts = state.select("bucket_start", "row_count")
    spine = _bucket_spine(counts, "bucket_start", step_seconds)
    filled = spine.join(counts, "bucket_start", "left").select(
        F.lit(table).alias("table_name"), "bucket_start",
        F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"))
    return _trailing_z(filled, "row_count", trailing, sensitivity)


def run_volume_anomalies(runs: DataFrame, sensitivity: dict[str, float], trailing: int = 14,
                         default: float = 3.0) -> DataFrame:
    """OBS1 between builds: ``runs`` has a row for each build and table (table_name, run_at,
    row_count); each count against the builds before. For tables whose rows carry one load time,
    buckets of that time would hold a single value."""
    found = _trailing_z(runs.select("table_name", F.col("run_at").alias("bucket_start"), "row_count"), "row_count", trailing, default)
    limit = F.lit(default)
    for table, s in sensitivity.items():
        limit = F.when(F.col("table_name") == table, F.lit(s)).otherwise(limit)
    return found.withColumn("is_anomaly", F.coalesce(F.abs("z_score") > limit, F.lit(False)))


def freshness_anomalies(df: DataFrame, ts: str, bucket: str = "6 hours", step_seconds: int = 21600,
                        sensitivity: float = 3.0, trailing: int = 14, table: str = "table") -> DataFrame:
    """OBS2: staleness at each bucket end = seconds since the last update seen so far;
    z-score against the trailing buckets."""
    return state_freshness_anomalies(bucket_state(df, ts, bucket), step_seconds, sensitivity, trailing, table)


def state_freshness_anomalies(state: DataFrame, step_seconds: int = 21600, sensitivity: float = 3.0, trailing: int = 14,
                              table: str = "table") -> DataFrame:
    """OBS2 from a table's state (a row a bucket)."""
    last = state.select("bucket_start", F.col("last_ts").alias("_last"))
    spine = _bucket_spine(last, "bucket_start", step_seconds)
    filled = spine.join(last, "bucket_start", "left")
    w = Window.partitionBy(F.lit(table)).orderBy("bucket_start").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("bucket_start") + F.make_dt_interval(secs=F.lit(step_seconds))
    seen = F.max("_last").over(w)
    # Wall-clock (NTZ) difference: independent of the session time zone and of DST.
    staleness = F.timestamp_diff("MICROSECOND", seen, end) / F.lit(1e6)
    out = filled.select(F.lit(table).alias("table_name"), "bucket_start",
                        staleness.cast("double").alias("staleness_seconds"))
    return _trailing_z(out, "staleness_seconds", trailing, sensitivity)


def _trailing_z(df: DataFrame, metric: str, trailing: int, sensitivity: float) -> DataFrame:
    # One row per bucket: the window partition (table) holds #buckets rows, not #rows.
    w = Window.partitionBy("table_name").orderBy("bucket_start").rowsBetween(-trailing, -1)
    # Exact mean (metrics are counts or microsecond-resolution seconds): decimal sum / count.
    mean = F.try_divide(F.sum(F.col(metric).cast("decimal(38,6)")).over(w).cast("double"),
                        F.count(metric).over(w).cast("double"))
    sd = F.stddev_samp(metric).over(w)
    z = F.try_divide(F.col(metric) - mean, F.nullif(sd, F.lit(0)))
    out = df.select("*", mean.alias("trailing_mean"), sd.alias("trailing_stddev"), z.alias("z_score"))
    return out.select("*", F.coalesce(F.abs("z_score") > sensitivity, F.lit(False)).alias("is_anomaly"))


def stale_count(df: DataFrame, ts: str, as_of, max_hours: int) -> DataFrame:
    """AGG20 / UDF5: count of rows older than ``max_hours`` before ``as_of`` (one row)."""
    cutoff = ts_literal(as_of) - F.make_dt_interval(hours=F.lit(max_hours))
    return df.agg(F.count(F.when(F.col(ts) < cutoff, 1)).alias("stale_records"))
