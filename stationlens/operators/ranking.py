"""Exact ranks and neighbours over groups of any size (WIN4-6, WIN8, PRJ27, PRJ30, SCD1, SCD4).

One layout serves all. The rows' total order -- (group columns, order columns, unique tie-break) --
is cut into *slices* of about equal size by bounds taken from a sample, as a range partitioning
does, but as a plain column: a group that holds a third of all rows is spread over as many slices
as its share is worth, equal values too (the tie-break is part of the order), and small groups lie
whole in one slice. The rows are shuffled once, on (group, slice). Rows are numbered inside their
slice; only groups that a bound cuts need more: what lies before each of their slices, from
counts of at most a few rows a slice, joined back on the same partitioning.

The counts read the same exchange as the rows (``summed``), so the input is evaluated once. Bounds are
constants; a row finds its slice by binary search (``with_position``). Any bounds give the same result, so
they may come from a cheaper table with about the same values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Slices are twice the shuffle partitions, never more than this (the bounds travel with the plan).
MAX_SLICES = 8192
#: Sampled rows per slice.
SAMPLE = 20
_HASHES = 1 << 30


def _sort_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def _place(cols: Sequence[str]) -> Column:
    """A row's place in the order of ``cols`` as one comparable value (NULL last)."""
    parts = []
    for i, c in enumerate(cols):
        parts += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*parts)


@dataclass(frozen=True)
class Bounds:
    """Places that cut an order into slices, as constants of the plan."""

    places: tuple[str, ...]  # sorted, each as JSON
    type: T.StructType

    @property
    def n(self) -> int:
        return len(self.places)


def order_bounds(source: DataFrame, order: Sequence[str], slices: int | None = None,
                 counted: DataFrame | None = None, hashed: Sequence[str] | None = None) -> Bounds:
    """Bounds that cut the order of ``order`` into about equal shares of ``source``'s distinct places.
    Like a range partitioning's, they are read by a small job when the query is built. They come from a
    hash sample of about ``SAMPLE`` places a slice: the same in every run and retry, however often one place
    is repeated. ``counted``: a cheap table with at least as many rows as ``source``, by whose size the
    sample is bounded. ``hashed``: the order columns whose hash takes the sample, if not all; where they come
    from one side of a join in ``source``, that side's rows are sampled before they are shuffled for it."""
    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(2, min(slices or 2 * parts, MAX_SLICES))
    total = (source if counted is None else counted).select(F.count(F.lit(1)).alias("n")).scalar()
    at = _place(order)
    taken = F.xxhash64(at) if hashed is None else F.xxhash64(*[F.col(c) for c in hashed])
    sample = (source.select(at.alias("at"), F.pmod(taken, F.lit(_HASHES)).alias("h"))
              .filter(F.col("h") * total < F.lit(SAMPLE * n * _HASHES)).agg(F.sort_array(F.collect_set("at")).alias("s")))
    marks = F.transform(F.sequence(F.lit(1), F.lit(n - 1)),
                        lambda i: F.get("s", F.floor(i * F.size("s") / F.lit(n)).cast("int")))
    bounds = sample.select(F.array_distinct(F.filter(marks, lambda b: b.isNotNull())).alias("b"))
    row = bounds.select(F.transform("b", lambda b: F.to_json(b)).alias("b")).first()
    fields = bounds.schema["b"].dataType.elementType.fields
    return Bounds(tuple(row.b), T.StructType([T.StructField(f.name, f.dataType) for f in fields]))


def constants(texts: Sequence[str], of: T.DataType) -> Column:
    """A constant array of JSON texts; the optimizer reads them once."""
    return F.from_json(F.lit(f"[{','.join(texts)}]"), T.ArrayType(of))


def with_position(df: DataFrame, at: str, texts: Sequence[str], of: T.DataType, out: str) -> DataFrame:
    """Adds ``out``, how many of the sorted constants (JSON texts of type ``of``) lie before column ``at``.

    A binary search written as one plain projection a step, each with the constants that step can
    meet: compiled code that copies nothing. (A higher-order function copies its whole
    accumulator, the array with it, at every step: its cost per row grows with the array.)"""
    cols = [F.col(f"`{c}`") for c in df.columns]
    found = df.select(*cols, F.lit(0).alias(out))
    for bit in reversed(range(len(texts).bit_length())):
        size = 1 << bit
        middle = F.get(constants(texts[size - 1::2 * size], of), F.shiftright(F.col(out), bit + 1))
        found = found.select(*cols, (F.col(out) + F.when(middle < F.col(at), size).otherwise(0)).alias(out))
    return found


def with_slice(df: DataFrame, order: Sequence[str], bounds: Bounds, group: int = 0) -> DataFrame:
    """Adds ``_slice``, the number of bounds before the row, never decreasing in the order, and
    ``_cut``: may a bound cut the row's group (the first ``group`` order columns)?"""
    cols = [F.col(f"`{c}`") for c in df.columns]
    placed = df.select(*cols, _place(order).cast(bounds.type).alias("_at"))
    found = with_position(placed, "_at", bounds.places, bounds.type, "_slice")
    # the groups of the bounds on either side of each slice
    sides = T.StructType([T.StructField(side, T.StructType(bounds.type.fields[:2 * group])) for side in ("p", "x")])
    ends = ["null", *bounds.places, "null"]
    near = [f'{{"p":{p},"x":{x}}}' for p, x in zip(ends, ends[1:])]
    found = found.select("*", F.get(constants(near, sides), F.col("_slice")).alias("_near"))

    def same(bound: Column) -> Column:
        out = bound.isNotNull()
        for i in range(group):
            out = out & bound[f"v{i}"].eqNullSafe(F.col(f"_at.v{i}"))
        return out

    return found.select(*cols, "_slice", (same(F.col("_near.x")) | same(F.col("_near.p"))).alias("_cut"))


def summed(laid: DataFrame, by: Sequence[str], *aggs: Column, having: Column | None = None) -> DataFrame:
    """Aggregates of rows that another branch of the plan reads too, from the exchange that dealt them
    (``laid`` = ``repartition``). A hash of all columns is part of the aggregate and of its filter:
    it keeps the optimizer from pruning columns or pushing filters below the exchange in this branch
    alone, so both branches have the same exchange and Spark runs it once."""
    rest = F.max(F.xxhash64(*[F.col(f"`{c}`") for c in laid.columns]))
    out = laid.groupBy(*by).agg(*aggs, rest.alias("_rest"))
    keep = F.col("_rest").isNotNull()
    return out.filter(keep if having is None else keep & having).drop("_rest")


def add_ranks(df: DataFrame, base: Sequence[str], value: str, groups: Mapping[str, Sequence[str]],
              tiebreak: Sequence[str] = (), percent: str | None = None,
              bounds: Bounds | None = None) -> DataFrame:
    """WIN4/WIN5: row numbers by ascending ``value`` (then ``tiebreak``) within ``base`` + each extra
    group, plus ``percent_rank`` within ``base``.

    ``groups`` maps output name -> extra partition columns (``[]`` = base only; attributes of which
    a slice holds few values). ``bounds``: see :func:`order_bounds`, over base, value and tiebreak. The
    order must be total for the row numbers to be determined; base columns must not be NULL. All columns of
    ``df`` go through the exchange, so it should hold only those that are read afterwards."""
    base = list(base)
    order = [*base, value, *tiebreak]
    bounds = order_bounds(df, order) if bounds is None else bounds
    cell = [*base, "_slice"]
    laid = with_slice(df, order, bounds, len(base)).repartition(*cell)
    extra = list(dict.fromkeys(c for cols in groups.values() for c in cols))

    # What lies before each slice of the groups that a bound cuts: a few rows a slice.
    cut = F.max("_cut").alias("_split")
    cells = summed(laid, [*cell, *extra], F.count(F.lit(1)).alias("_n"), cut, having=F.col("_split"))
    earlier = lambda cols: Window.partitionBy(*base, *cols).orderBy("_slice").rangeBetween(Window.unboundedPreceding, -1)
    before = lambda cols: F.coalesce(F.sum("_n").over(earlier(cols)), F.lit(0))
    cells = cells.select(*cell, *extra, before([]).alias("_b"), F.sum("_n").over(Window.partitionBy(*base)).alias("_all"),
                         *[before(c).alias(f"_b{i}") for i, c in enumerate(groups.values())])
    # the join's keys are aggregates, so that no filter on them is pushed below the shared exchange
    names = [f"_g{i}" for i in range(len(cell))]
    offsets = cells.groupBy(*cell).agg(
        *[F.first(c).alias(g) for c, g in zip(cell, names)], F.first("_all").alias("_all"), F.first("_b").alias("_b"),
        *[F.map_from_entries(F.collect_set(F.struct(_place(c).alias("at"), F.col(f"_b{i}").alias("n")))).alias(f"_m{i}")
          for i, c in enumerate(groups.values()) if c])
    if percent:
        offsets = _with_ties(offsets, laid, base, value)
    # A condition that always holds and reads every column: else what the caller does not read is pruned in
    # this branch alone, the exchanges differ and the input is evaluated twice.
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in laid.columns]) >= F.lit(-(1 << 63))
    joined = laid.join(offsets.drop(*cell), [*[F.col(c) == F.col(g) for c, g in zip(cell, names)], whole], "left")

    def offset(i: int, cols: Sequence[str]) -> Column:
        return F.element_at(f"_m{i}", _place(cols)) if cols else F.col("_b")

    found = joined.select(*[F.col(f"`{c}`") for c in df.columns], "_slice", "_all", "_b", *(["_low", "_less"] if percent else []), *[
        F.when(F.col("_cut") & F.col("_b").isNotNull(), offset(i, c)).otherwise(F.lit(0)).alias(f"_o{i}") for i, c in enumerate(groups.values())])
    total = _sort_cols([value, *tiebreak])
    out = [(F.row_number().over(Window.partitionBy(*cell, *cols).orderBy(*total)) + F.col(f"_o{i}")).cast("long").alias(name)
           for i, (name, cols) in enumerate(groups.items())]
    if percent:
        # equal values of a cut group may lie in several slices: the first of them gives the rank
        rank = F.when(_place([value]) == F.col("_low"), F.col("_less")).otherwise(
            F.rank().over(Window.partitionBy(*cell).orderBy(*_sort_cols([value]))) - 1 + F.coalesce("_b", F.lit(0)))
        n = F.coalesce(F.col("_all"), F.count(F.lit(1)).over(Window.partitionBy(*cell)))
        out.append(F.when(n <= 1, F.lit(0.0)).otherwise(rank.cast("double") / (n - 1).cast("double")).alias(percent))
    return found.select(*[F.col(f"`{c}`") for c in df.columns], *out)


def _with_ties(offsets: DataFrame, laid: DataFrame, base: list[str], value: str) -> DataFrame:
    """Offsets with ``_low``, the least value of each slice, and ``_less``, the number of the group's
    rows below it, where the slices before may end with the same value."""
    cell = [*base, "_slice"]
    values = summed(laid.select("*", _place([value]).alias("_v")), [*cell, "_v"], F.count(F.lit(1)).alias("_n"),
                    F.max("_cut").alias("_split"), having=F.col("_split"))
    ends = values.groupBy(*cell).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"),
                                     F.max_by("_n", "_v").alias("_top"), F.sum("_n").alias("_n"))
    w = Window.partitionBy(*base).orderBy("_slice")
    ends = ends.select("*", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    # rows below a slice's highest value: the least over the slices that end with this value
    below = F.min(F.col("_before") + F.col("_n") - F.col("_top")).over(Window.partitionBy(*base, "_high"))
    ends = ends.select("*", below.alias("_below"))
    less = F.when(F.lag("_high").over(w) == F.col("_low"), F.lag("_below").over(w)).otherwise(F.col("_before"))
    key = F.struct(*cell)  # never NULL, so no filter on it goes below the shared exchange
    return offsets.withColumn("_key", key).join(ends.select(key.alias("_key"), "_low", less.alias("_less")), "_key").drop("_key")


def top_k(df: DataFrame, partition: Sequence[str], order: Sequence[str | Column], k: int,
          out: str | None = None) -> DataFrame:
    """WIN6 single-rank top-k: ``filter(rn <= k)`` lets Spark plan a WindowGroupLimit
    (partial limit before the shuffle), so each task ships at most k rows per key."""
    name = out or "_rn"
    w = Window.partitionBy(*partition).orderBy(*_sort_cols(order))
    ranked = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
    return ranked if out else ranked.drop(name)


def sliced_shift(df: DataFrame, partition: Sequence[str], order: Sequence[str], cols: Sequence[str],
                 out: str, direction: int = -1, bounds: Bounds | None = None, by: Sequence[str] | None = None) -> DataFrame:
    """``lag``/``lead`` by one row of ``struct(cols)`` within ``partition`` by ``order`` (``direction``
    -1 = previous row, +1 = next row), for keys of any size: the neighbour comes from the row's
    slice or, at the edge of a slice of a key that a bound cuts, from the nearest slice's edge row.
    ``by``: the order columns that slices are cut by, if not all; they must never decrease in the
    order within a key. ``bounds``: over partition and ``by``."""
    partition, by = list(partition), list(by or order)
    places = [*partition, *by]
    bounds = order_bounds(df, places) if bounds is None else bounds
    cell = [*partition, "_slice"]
    laid = with_slice(df, places, bounds, len(partition)).repartition(*cell)
    payload = F.struct(*[F.col(c) for c in cols])
    shift = F.lag if direction < 0 else F.lead
    edge = (F.max if direction < 0 else F.min)(F.struct(_place(order).alias("at"), payload.alias("row")))
    edges = summed(laid, cell, edge.alias("_edge"), F.max("_cut").alias("_split"), having=F.col("_split"))
    names = [f"_g{i}" for i in range(len(cell))]
    beyond = shift(F.col("_edge.row")).over(Window.partitionBy(*partition).orderBy("_slice"))  # one row a slice
    edges = edges.select(*[F.col(k).alias(n) for k, n in zip(cell, names)], beyond.alias("_beyond"))
    w = Window.partitionBy(*cell).orderBy(*_sort_cols(order))
    marked = laid.select("*", shift(payload).over(w).alias("_local"), shift(F.lit(1)).over(w).isNull().alias("_ends"))
    # a bound cuts one key, so there are at most two edge rows a bound
    joined = marked.join(F.broadcast(edges), [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(cell, names)], "left")
    value = F.when(F.col("_ends") & F.col("_cut"), F.col("_beyond")).otherwise(F.col("_local"))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], value.alias(out))
