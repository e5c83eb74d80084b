"""Data-quality checks (DQ1-12): each check returns the violating rows (zero rows =
pass); :func:`run_rules` folds the declared ones into one result table.

Every check is a filter or a pre-aggregated group-by; relationship checks
deduplicate child keys before the anti join, so a hot key is one row by then.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.functions.labels import out_of_box
from stationlens.operators.enrich import ts_literal


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ1: key values occurring more than once (rows with a NULL key part ignored)."""
    nn = df
    for c in cols:
        nn = nn.filter(F.col(c).isNotNull())
    return nn.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def not_null(df: DataFrame, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """DQ2: rows where ``col`` is NULL."""
    return df.filter(F.col(col).isNull()).select(*keep, col) if keep else df.filter(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """DQ3: non-NULL values outside the accepted set, with their counts."""
    vals = list(values)
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(vals))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """DQ4 / JOI13: child keys (non-NULL) without a parent row, with their counts.
    Child keys are counted first (partial aggregation), then anti-joined."""
    keys = child.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
    parents = parent.select(F.col(parent_col).alias("_p")).distinct()
    return keys.join(parents, keys[col] == parents["_p"], "left_anti")


def between(df: DataFrame, col: str, lo, hi, keep: Sequence[str] = ()) -> DataFrame:
    """DQ5: non-NULL values outside [lo, hi]."""
    c = F.col(col)
    bad = df.filter(c.isNotNull() & ((c < F.lit(lo)) | (c > F.lit(hi))))
    return bad.select(*keep, col) if keep else bad


def length_eq(df: DataFrame, col: str, n: int, keep: Sequence[str] = ()) -> DataFrame:
    """DQ6: non-NULL strings whose length differs from ``n``."""
    bad = df.filter(F.col(col).isNotNull() & (F.length(col) != n))
    return bad.select(*keep, col) if keep else bad


# The coordinate box of the metropolitan-area check and its reasons.
BOX_LAT, BOX_LON = (41.0, 52.0), (-6.0, 10.0)
BOX_REASONS = ("Latitude too low (south of France)", "Latitude too high (north of France)",
               "Longitude too low (west of France)", "Longitude too high (east of France)",
               "Unknown issue")
BOX_EXCLUDED_PREFIXES = ("97", "98")


def in_box(stations: DataFrame, lat: str = "latitude", lon: str = "longitude",
           dept: str = "code_departement", lat_range=BOX_LAT, lon_range=BOX_LON,
           reasons=BOX_REASONS, excluded_prefixes=BOX_EXCLUDED_PREFIXES,
           keep: Sequence[str] = ("station_id",), extra: Sequence[str] = ("code_postal", "ville")) -> DataFrame:
    """DQ7: located entities outside the box, with a reason; excluded department
    prefixes (overseas) are skipped."""
    s = stations.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    for p in excluded_prefixes:
        s = s.filter(~F.col(dept).startswith(p))
    pred, reason = out_of_box(lat, lon, lat_range, lon_range, reasons)
    return s.filter(pred).select(*keep, lat, lon, *extra, reason.alias("coordinate_issue"))


def orphans(children: DataFrame, parents: DataFrame, key: str = "station_id") -> DataFrame:
    """DQ8: distinct child keys with no parent (anti join; one row per key, count of
    distinct key rows as in the reference test, i.e. 1)."""
    c = children.select(key).distinct()
    p = parents.select(F.col(key).alias("_p")).distinct()
    return (c.join(p, c[key] == p["_p"], "left_anti")
            .groupBy(key).agg(F.count(F.lit(1)).alias("price_records")))


def product_id_mismatch(prices: DataFrame, seed: DataFrame, name: str = "carburant_nom",
                        pid: str = "carburant_id") -> DataFrame:
    """S16 check: feed (name, id) pairs whose id differs from the reference table's id for
    the same normalised name -- the fact joins the product dimension on the feed id, so
    such rows get no product key. One row per distinct pair."""
    pairs = prices.select(name, pid).distinct()
    ref = seed.select(F.upper(F.trim(name)).alias("_n"), F.col(pid).alias("reference_id"))
    j = pairs.join(ref, F.upper(F.trim(pairs[name])) == ref["_n"], "inner")
    return j.filter(~F.col(pid).eqNullSafe(F.col("reference_id"))).select(
        name, F.col(pid).alias("feed_id"), "reference_id")


# The message of each freshness rule, in the order of the rules.
FRESHNESS_MESSAGES = (
    "No successful ingestion found", "Last successful ingestion is too old",
    "No recent price data found", "Most recent price update is too old",
    "Too few stations with recent data", "OK",
)


def pipeline_freshness(run_log: DataFrame, prices: DataFrame, as_of, hours: int = 24,
                       min_entities: int = 100, entity: str = "station_id",
                       updated: str = "date_maj") -> DataFrame:
    """DQ9: ordered status rules over the run log and the recent prices; one row when
    the status is not OK, none otherwise."""
    cutoff = ts_literal(as_of) - F.make_dt_interval(hours=F.lit(hours))
    runs = run_log.agg(
        F.max("completed_at").alias("last_successful_ingestion"),
        F.max(F.when(F.col("status") == "SUCCESS", F.col("completed_at"))).alias("last_success"))
    recent = prices.filter(F.col(updated) >= cutoff).agg(
        F.max(updated).alias("most_recent_price_update"),
        F.count_distinct(entity).alias("stations_with_recent_data"))
    both = runs.crossJoin(recent)  # two single-row aggregates (JOI9)
    m = FRESHNESS_MESSAGES
    status = (F.when(F.col("last_success").isNull(), m[0])
              .when(F.col("last_success") < cutoff, m[1])
              .when(F.col("most_recent_price_update").isNull(), m[2])
              .when(F.col("most_recent_price_update") < cutoff, m[3])
              .when(F.col("stations_with_recent_data") < min_entities, m[4])
              .otherwise(m[5]))
    return both.select("*", status.alias("freshness_status")).filter(F.col("freshness_status") != m[5])


def source_freshness(tables: dict[str, DataFrame], as_of, warn_hours: int = 12, error_hours: int = 24,
                     loaded: str = "_loaded_at") -> DataFrame:
    """DQ10: per table, age of the newest load time vs ``as_of`` -> pass / warn / error."""
    now = ts_literal(as_of)
    parts = []
    for name, df in tables.items():
        parts.append(df.agg(F.max(loaded).alias("max_loaded_at")).select(
            F.lit(name).alias("table_name"), "max_loaded_at"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    age_h = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now) / 3.6e9  # zone-independent
    status = (F.when(F.col("max_loaded_at").isNull(), "error")
              .when(age_h > error_hours, "error").when(age_h > warn_hours, "warn").otherwise("pass"))
    return out.select("table_name", "max_loaded_at", F.round(age_h, 6).alias("age_hours"),
                      status.alias("status"))


@dataclass
class Check:
    """DQ11/12: one declared check: its violating-rows DataFrame and metadata."""
    name: str
    table: str
    column: str
    violations: DataFrame
    severity: str = "warn"


# ---------------------------------------------------------------------------
# Declared rules: one scan per table, one shuffle for all keys
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """One declared rule of a column. The project's default severity is ``warn``."""
    kind: str
    args: tuple = ()
    severity: str = "warn"

    def broken(self, col: str):
        """Whether a row breaks a rule that rows can break (None for unique and parent)."""
        c = F.col(col)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "between":
            return c.isNotNull() & ((c < F.lit(self.args[0])) | (c > F.lit(self.args[1])))
        if self.kind == "length":
            return c.isNotNull() & (F.length(col) != self.args[0])
        if self.kind == "accepted":
            return c.isNotNull() & ~c.isin(list(self.args))
        return None


def unique_rule() -> Rule:
    return Rule("unique")


def not_null_rule() -> Rule:
    return Rule("not_null")


def accepted(values: Iterable) -> Rule:
    return Rule("accepted", tuple(values))


def between_rule(low, high) -> Rule:
    return Rule("between", (low, high))


def length(n: int) -> Rule:
    return Rule("length", (n,))


def parent(table: str, column: str) -> Rule:
    return Rule("parent", (table, column))


def run_rules(spark: SparkSession, tables: dict[str, DataFrame],
              declared: dict[str, dict[str, tuple[Rule, ...]]], singular: Sequence[Check] = ()) -> DataFrame:
    """DQ12: a row for each declared rule (and each check in ``singular``) with its failures.

    Each table is scanned once. A row gives an entry (rule, key, child, parent) for each rule of its
    own that it breaks, for each ``unique`` or ``parent`` rule it has a key for, and for each rule of
    another table whose parent it is. One shuffle of all tables' entries, summed before it, counts
    every key: ``unique`` fails where a key has several rows, ``parent`` where it has children and no
    parent; failures of row rules are their entries. A hot key is one entry a task by then."""
    rules = [(table, col, r) for table, columns in declared.items() for col, rs in columns.items() for r in rs]

    def entry(rule: int, when: Column, key: Column | None, child: int, parent: int) -> Column:
        k = (F.lit(None) if key is None else key).cast("string")
        return F.when(when, F.struct(F.lit(rule).alias("rule"), k.alias("key"), F.lit(child).alias("child"), F.lit(parent).alias("parent")))

    entries: dict[str, list[Column]] = {}
    for i, (table, col, r) in enumerate(rules):
        c, broken = F.col(col), r.broken(col)
        mine = entries.setdefault(table, [])
        mine.append(entry(i, c.isNotNull(), c, 1, 0) if broken is None else entry(i, broken, None, 1, 0))
        if r.kind == "parent":
            c = F.col(r.args[1])
            entries.setdefault(r.args[0], []).append(entry(i, c.isNotNull(), c, 0, 1))
    scans = [tables[t].select(F.explode(F.filter(F.array(*es), lambda e: e.isNotNull())).alias("e")).select("e.*") for t, es in entries.items()]
    keys = functools.reduce(DataFrame.unionByName, scans).groupBy("rule", "key").agg(F.sum("child").alias("n"), F.sum("parent").alias("p"))
    kinds = [i for i, (_, _, r) in enumerate(rules) if r.kind == "unique"], [i for i, (_, _, r) in enumerate(rules) if r.kind == "parent"]
    rule = F.col("rule")
    counted = keys.groupBy("rule").agg(F.sum(
        F.when(rule.isin(kinds[0]), (F.col("n") > 1).cast("long")).when(rule.isin(kinds[1]), ((F.col("n") > 0) & (F.col("p") == 0)).cast("long"))
        .otherwise(F.col("n"))).alias("failures"))

    def row(i: int, name: str, table: str, col: str, severity: str) -> Column:
        return F.struct(F.lit(i).alias("i"), F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
                        F.lit(col).alias("column_name"), F.lit(severity).alias("severity"))

    named = spark.range(1).select(F.explode(F.array(*[row(i, f"{r.kind}_{col}", t, col, r.severity)
                                                      for i, (t, col, r) in enumerate(rules)])).alias("r")).select("r.*")
    out = named.join(counted, F.col("i") == rule, "left")
    parts = [out.select("check_name", "table_name", "column_name", "severity", F.coalesce("failures", F.lit(0)).cast("long").alias("failures"))]
    for c in singular:
        n = c.violations.agg(F.count(F.lit(1)).cast("long").alias("failures"))
        parts.append(n.select(F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"),
                              F.lit(c.severity).alias("severity"), "failures"))
    out = functools.reduce(DataFrame.unionByName, parts)
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "error", "error").otherwise("warn")
    return out.select("*", status.alias("status"))
