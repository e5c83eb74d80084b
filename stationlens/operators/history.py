"""Versioned (SCD type 2) history (SCD1-4).

History rows carry ``valid_from`` / ``valid_to`` (NULL = current) and ``scd_id``.
``timestamp_changes`` and ``check_changes`` compare the *open* versions with an incoming batch and return
what changes only: the versions to open (``closes`` false) and a closing record for each version
that ends (``closes`` true: key, scd_id and valid_to). ``sources.segments`` stores them. ``scd2_timestamp``
and ``scd2_check`` apply the same changes to a whole history and return the whole new one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlens.functions.labels import surrogate_key
from stationlens.operators.enrich import ts_literal

VALID_FROM, VALID_TO, SCD_ID, CLOSES = "valid_from", "valid_to", "scd_id", "closes"


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple, and of equal ones the greatest
    row (a single aggregate with map-side combine)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    best = F.max_by(row, F.struct(*[F.col(o) for o in order], row.alias("_row")))
    return df.groupBy(*key).agg(best.alias("_r")).select("_r.*")


def timestamp_changes(open_: DataFrame | None, incoming: DataFrame, key: Sequence[str], updated_at: str,
                      tiebreak: Sequence[str] = ()) -> DataFrame:
    """SCD1: timestamp strategy. Every update of a key that is newer than its open version is a
    version, valid until the next update; the first of them closes the open version. So several
    batches give the same history as one, if no batch holds updates older than an open version (late
    updates are left out). Of updates with equal times the greatest by ``tiebreak`` counts. Keys absent
    from the batch stay open (deletes are not closed). Rows with a NULL ``updated_at`` cannot be ordered
    and are ignored; NULL key parts are values like others.

    Next updates are found in slices of the order (operators.ranking.sliced_shift), so a key with a
    third of all updates is spread over tasks."""
    from stationlens.operators.ranking import order_bounds, sliced_shift

    key = list(key)
    dated = incoming.filter(F.col(updated_at).isNotNull())
    inc = latest_per_key(dated, [*key, updated_at], tiebreak)
    data = inc.columns

    def version(df: DataFrame, new: bool) -> DataFrame:
        return df.select(*data, F.lit(new).alias("_new"), (F.lit(None).cast("string") if new else F.col(SCD_ID)).alias("_id"))

    rows = version(inc, True)
    if open_ is not None:
        times = open_.select(*[F.col(k).alias(f"_o_{k}") for k in key], F.col(updated_at).alias("_o_at"), F.lit(True).alias("_o"))
        same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in key]
        newer = inc.join(times, same, "left").filter(F.col("_o").isNull() | F.col("_o_at").isNull() | (F.col(updated_at) > F.col("_o_at")))
        rows = version(newer, True).unionByName(version(open_, False))
    bounds = order_bounds(dated, [*key, updated_at], counted=incoming)
    after = sliced_shift(rows, key, ["_new", updated_at], [updated_at], "_next", +1, bounds, by=[updated_at])
    after = after.filter(F.col("_new") | F.col("_next").isNotNull())
    return after.select(*[F.col(c) if c in key else F.when(F.col("_new"), F.col(c)).alias(c) for c in data],
                        F.when(F.col("_new"), F.col(updated_at)).alias(VALID_FROM),
                        F.col(f"_next.{updated_at}").cast("timestamp_ntz").alias(VALID_TO),
                        F.when(F.col("_new"), surrogate_key(*key, updated_at)).otherwise(F.col("_id")).alias(SCD_ID), (~F.col("_new")).alias(CLOSES))


def check_changes(open_: DataFrame | None, incoming: DataFrame, key: Sequence[str], check_cols: Sequence[str], run_ts,
                  close_missing: bool = True, order: Sequence[str] = ()) -> DataFrame:
    """SCD2: check strategy. A new version (valid from ``run_ts``) when any check column
    differs null-safely from the open version; keys missing from the batch are closed
    at ``run_ts`` when ``close_missing``. Rows that repeat a key count once (the greatest by
    ``order``); NULL key parts are values like others."""
    key = list(key)
    run = ts_literal(run_ts)
    inc = latest_per_key(incoming, key, order)
    data = inc.columns
    if open_ is None:
        return inc.select(*data, run.alias(VALID_FROM), F.lit(None).cast("timestamp_ntz").alias(VALID_TO), surrogate_key(*key, run).alias(SCD_ID), F.lit(False).alias(CLOSES))
    o = open_.withColumn("_open", F.lit(True)).alias("o")
    i = inc.select(*[F.col(c).alias(f"_i_{c}") for c in data], F.lit(True).alias("_came"))
    j = o.join(i, [F.col(f"o.{k}").eqNullSafe(F.col(f"_i_{k}")) for k in key], "full")
    was, came = F.col("_open").isNotNull(), F.col("_came").isNotNull()
    differs = F.lit(False)
    for c in check_cols:
        differs = differs | ~F.col(f"o.{c}").eqNullSafe(F.col(f"_i_{c}"))
    changed = was & came & differs
    types = dict(inc.dtypes)
    gone = F.struct(*[(F.col(f"o.{c}") if c in key else F.lit(None).cast(types[c])).alias(c) for c in data], F.lit(None).cast("timestamp_ntz").alias(VALID_FROM),
                    run.alias(VALID_TO), F.col(f"o.{SCD_ID}").alias(SCD_ID), F.lit(True).alias(CLOSES))
    added = F.struct(*[F.col(f"_i_{c}").alias(c) for c in data], run.alias(VALID_FROM), F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
                     surrogate_key(*[F.col(f"_i_{k}") for k in key], run).alias(SCD_ID), F.lit(False).alias(CLOSES))
    ends = changed | (was & ~came & F.lit(close_missing))
    # both rows of a key from one pass over the join
    both = F.filter(F.array(F.when(ends, gone), F.when(came & (~was | changed), added)), lambda x: x.isNotNull())
    return j.select(F.explode(both).alias("_r")).select("_r.*")


def apply_changes(current: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The whole history after ``changes``."""
    opened = changes.filter(~F.col(CLOSES)).drop(CLOSES)
    if current is None:
        return opened
    ends = changes.filter(F.col(CLOSES)).select(F.col(SCD_ID).alias("_id"), F.col(VALID_TO).alias("_end"))
    data = [c for c in current.columns if c not in (VALID_FROM, VALID_TO, SCD_ID)]
    kept = current.join(ends, F.col(SCD_ID) == F.col("_id"), "left").select(
        *data, VALID_FROM, F.coalesce(F.col(VALID_TO), F.col("_end")).alias(VALID_TO), SCD_ID)
    return kept.unionByName(opened)


def _open(current: DataFrame | None) -> DataFrame | None:
    return None if current is None else current.filter(F.col(VALID_TO).isNull())


def scd2_timestamp(current: DataFrame | None, incoming: DataFrame, key: Sequence[str],
                   updated_at: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """SCD1 on a whole history: see :func:`timestamp_changes`."""
    return apply_changes(current, timestamp_changes(_open(current), incoming, key, updated_at, tiebreak))


def scd2_check(current: DataFrame | None, incoming: DataFrame, key: Sequence[str],
               check_cols: Sequence[str], run_ts, close_missing: bool = True,
               order: Sequence[str] = ()) -> DataFrame:
    """SCD2 on a whole history: see :func:`check_changes`."""
    return apply_changes(current, check_changes(_open(current), incoming, key, check_cols, run_ts, close_missing, order))


def as_of_version(history: DataFrame, t) -> DataFrame:
    """SCD3: the versions valid at time ``t``."""
    tt = ts_literal(t)
    return history.filter((F.col(VALID_FROM) <= tt)
                          & (F.col(VALID_TO).isNull() | (tt < F.col(VALID_TO))))


def version_counts(history: DataFrame, key: Sequence[str]) -> DataFrame:
    """SCD3: versions and changes per key, first and last validity start."""
    return history.groupBy(*key).agg(
        F.count(F.lit(1)).alias("nb_versions"),
        (F.count(F.lit(1)) - 1).alias("nb_changes"),
        F.min(VALID_FROM).alias("first_valid_from"),
        F.max(VALID_FROM).alias("last_valid_from"))


def scd2_rebuild(observations: DataFrame, key: Sequence[str], ts: str,
                 cols: Sequence[str], bounds: Column | None = None) -> DataFrame:
    """SCD4: versions from a full observation history: rows whose tracked columns differ
    from the previous observation of the key; valid until the next version.

    Duplicate observations are folded first (distinct). Previous and next rows are found in
    slices of time (operators.ranking.sliced_shift), so one key holding a third of all rows is
    spread over many tasks."""
    key = list(key)
    obs = observations.select(*key, ts, *cols).distinct()
    from stationlens.operators.ranking import order_bounds, sliced_shift

    cur = F.struct(*[F.col(c) for c in cols])
    if bounds is None:
        bounds = order_bounds(observations, [*key, ts])
    order = [ts, *cols]
    seen = sliced_shift(obs, key, order, cols, "_prev", -1, bounds, by=[ts])
    versions = seen.filter(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(cur)).drop("_prev")
    following = sliced_shift(versions, key, order, [ts], "_next", +1, bounds, by=[ts])
    return following.select(*key, *cols, F.col(ts).alias(VALID_FROM), F.col(f"_next.{ts}").alias(VALID_TO),
                            surrogate_key(*key, F.col(ts)).alias(SCD_ID))
