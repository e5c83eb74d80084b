"""Daily series, lags, ranks in slices against plain windows."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stationlens.operators.ranking import add_ranks, order_bounds, sliced_shift, with_slice
from stationlens.operators.series import add_calendar_lags, add_lags, daily_last


def _ts(day, h):
    return dt.datetime(2024, 1, day, h)


def test_daily_last_ties_and_ids(spark):
    rows = [
        ("s1", "GAZOLE", "1", _ts(1, 8), 1.70), ("s1", "GAZOLE", "1", _ts(1, 9), 1.75),
        ("s1", "GAZOLE", "1", _ts(1, 9), 1.72),  # tied update time -> larger value
        ("s1", "SP95", "2", _ts(1, 8), 1.90), ("s1", "SP95", "9", _ts(1, 10), 1.95),  # two ids
    ]
    df = spark.createDataFrame(rows, "station string, product string, pid string, ts timestamp_ntz, v double")
    df = df.withColumn("day", F.to_date("ts"))
    out = {(r["product"], r["pid"]): r for r in
           daily_last(df, "station", "product", "day", "ts", "v", ids=["pid"]).collect()}
    g = out[("GAZOLE", "1")]
    assert g["v"] == 1.75 and g["nb_updates_jour"] == 3 and g["derniere_maj"] == _ts(1, 9)
    assert out[("SP95", "2")]["v"] == out[("SP95", "9")]["v"] == 1.95
    assert out[("SP95", "2")]["nb_updates_jour"] == 2


def test_lags_by_rows_and_calendar(spark):
    days = [1, 2, 4, 8, 9]
    rows = [("s", "p", dt.date(2024, 1, d), float(d)) for d in days]
    df = spark.createDataFrame(rows, "e string, p string, day date, v double")
    by_rows = {r["day"].day: r["l1"] for r in add_lags(df, ["e", "p"], ["day"], "v", {1: "l1"}).collect()}
    assert by_rows == {1: None, 2: 1.0, 4: 2.0, 8: 4.0, 9: 8.0}
    cal = {r["day"].day: r["l1"] for r in add_calendar_lags(df, ["e", "p"], "day", "v", {1: "l1"}).collect()}
    assert cal == {1: None, 2: 1.0, 4: None, 8: None, 9: 8.0}


def _windows(df, base, groups, value, tiebreak):
    """The same ranks by one window for each group."""
    order = [F.col(value).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tiebreak]]
    cols = [F.row_number().over(Window.partitionBy(*base, *c).orderBy(*order)).cast("long").alias(n) for n, c in groups.items()]
    return df.select("*", *cols, F.percent_rank().over(Window.partitionBy(*base).orderBy(F.col(value).asc_nulls_last())).alias("pr"))


def _same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_ranks_equal_windows(spark):
    rnd = random.Random(3)
    # one product-day holds most rows; equal prices, NULL prices and NULL groups
    rows = [(f"s{i}", "A" if i % 3 else rnd.choice("BCD"), rnd.choice(["r1", "r2", None]),
             rnd.choice([None, 1.5, 1.5, round(rnd.uniform(1, 2), 2), 1e9, -1.0])) for i in range(3000)]
    df = spark.createDataFrame(rows, "e string, p string, r string, v double").withColumn("d", F.lit("2024-01-01"))
    groups = {"rn_all": [], "rn_reg": ["r"], "rn_two": ["r", "e"]}
    want = _windows(df, ["p", "d"], groups, "v", ["e"])
    order = ["p", "d", "v", "e"]
    for slices in (2, 7, 64, 500):
        _same(add_ranks(df, ["p", "d"], "v", groups, ["e"], "pr", order_bounds(df, order, slices)), want)
    far = order_bounds(df.select("p", "d", (F.col("v") * 7).alias("v"), "e"), order, 9)  # bounds of other data: same ranks
    _same(add_ranks(df, ["p", "d"], "v", groups, ["e"], "pr", far), want)
    none = order_bounds(df.limit(0), order, 4)
    _same(add_ranks(df, ["p", "d"], "v", groups, ["e"], "pr", none), want)
    assert add_ranks(df.limit(0), ["p", "d"], "v", groups, ["e"], "pr").count() == 0


def _window_partitions(df) -> list[str]:
    import re
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [re.sub(r"#\d+L?", "", m) for m in re.findall(r"Window \[.*?\], \[([^\]]*)\]", plan)]


def test_rows_are_ranked_in_slices(spark):
    """No window over the rows partitions by a whole product-day: those over whole groups read slice
    counts, made by an aggregate."""
    df = spark.createDataFrame([("e", "p", "d", "r", 1.0)], "e string, p string, d string, r string, v double")
    out = add_ranks(df, ["p", "d"], "v", {"a": [], "b": ["r"]}, tiebreak=["e"], percent="pr")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    import re
    ranks = [re.sub(r"#\d+L?", "", x) for x in plan.split("\n") if "row_number()" in x or " rank(" in x]
    assert ranks and all("_slice" in x.split("windowspecdefinition(")[1].split(" ASC")[0] for x in ranks)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(p") >= 1


def test_a_hot_product_day_is_spread(spark):
    """A product-day with a third of all rows, all of one price: no (group, slice) holds much more than a
    slice's share, and groups that no bound cuts are known."""
    rows = [(f"s{i}", "hot" if i % 3 == 0 else f"p{i % 97}", 1.5 if i % 3 == 0 else float(i % 1009)) for i in range(9000)]
    df = spark.createDataFrame(rows, "e string, p string, v double")
    order = ["p", "v", "e"]
    laid = with_slice(df, order, order_bounds(df, order, 30), 1)
    assert laid.groupBy("p", "_slice").count().agg(F.max("count")).first()[0] < 9000 / 30 * 2
    per = {r["p"]: r for r in laid.groupBy("p").agg(F.count_distinct("_slice").alias("n"), F.max("_cut").alias("cut")).collect()}
    assert per["hot"]["n"] >= 8 and all(r["cut"] for r in per.values() if r["n"] > 1)
    assert sum(not r["cut"] for r in per.values()) > 50


def test_slices_are_found_by_plain_projections(spark):
    """A row's slice comes from compiled comparisons with constants: no higher-order function, which copies
    the bounds at each of its steps (the time per row grew with their number), and no row carries them."""
    df = spark.createDataFrame([(f"p{i % 3}", float(i % 700), f"s{i}") for i in range(3000)], "p string, v double, e string")
    order = ["p", "v", "e"]
    for slices in (2, 300):
        bounds = order_bounds(df, order, slices)
        assert list(bounds.places) == sorted(set(bounds.places), key=bounds.places.index) and 0 < bounds.n < slices
        laid = with_slice(df, order, bounds, 1)
        assert "lambdafunction" not in laid._jdf.queryExecution().optimizedPlan().toString()
        assert laid.columns == [*df.columns, "_slice", "_cut"]
        places = [json.loads(b) for b in bounds.places]
        for r in laid.collect():
            before = sum((b["v0"], b["v1"], b["v2"]) < (r["p"], r["v"], r["e"]) for b in places)
            assert r["_slice"] == before
    ranks = add_ranks(df, ["p"], "v", {"a": [], "b": ["e"]}, ["e"], "pr", order_bounds(df, order, 300))
    assert "lambdafunction" not in ranks._jdf.queryExecution().optimizedPlan().toString()


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_and_counts_read_one_exchange(spark):
    """The input of the ranks is evaluated once: the counts reuse the rows' exchange."""
    rows = [(f"s{i % 50}", "p", i % 7, float(i % 11)) for i in range(3000)]
    df = (spark.createDataFrame(rows, "e string, p string, d int, x double").groupBy("e", "p", "d")
          .agg(F.sum("x").alias("v"), F.max("x").alias("unread")))
    order = ["p", "d", "v", "e"]
    source = spark.createDataFrame([("p", 3, float(v), f"s{v}") for v in range(50)], "p string, d int, v double, e string")
    out = add_ranks(df, ["p", "d"], "v", {"a": [], "b": ["e"]}, ["e"], "pr", order_bounds(source, order, 12))
    plan = _final_plan(out)
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 2
    assert final.count("partial_sum(x") == 1, final


@pytest.mark.parametrize("read", [["e", "a"], ["e", "b", "unread"], ["pr"]])
def test_rows_and_counts_read_one_exchange_whatever_is_read(spark, read):
    """A caller that reads few of the columns still has the input of the ranks evaluated once."""
    rows = [(f"s{i % 50}", "p", i % 7, float(i % 11)) for i in range(3000)]
    df = (spark.createDataFrame(rows, "e string, p string, d int, x double").groupBy("e", "p", "d")
          .agg(F.sum("x").alias("v"), F.max("x").alias("unread")))
    source = spark.createDataFrame([("p", 3, float(v), f"s{v}") for v in range(50)], "p string, d int, v double, e string")
    groups = {} if read == ["pr"] else {"a": [], "b": ["e"]}
    out = add_ranks(df, ["p", "d"], "v", groups, ["e"], "pr", order_bounds(source, ["p", "d", "v", "e"], 12))
    final = _final_plan(out.select(*read)).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 2 and final.count("partial_sum(x") == 1, final
    _same(out.select(*read), _windows(df, ["p", "d"], groups, "v", ["e"]).select(*read))


def test_trend_labels_evaluates_its_series_once(spark):
    """The line items are scanned once, and shuffled only for the join, the daily values, the series and the ranks."""
    import __spark_entry__ as entry
    from conftest import SF_SMALL
    df = entry.queries()["trend_labels"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("lineitem.parquet") == 1
    dealt = [x for x in final.split("\n") if "Exchange hashpartitioning(station_id" in x and "Reused" not in x]
    assert len(dealt) == 2, dealt
    assert sum("_slice" in x and "REPARTITION_BY_COL" in x and "Reused" not in x for x in final.split("\n")) == 1


def test_bounds_by_the_hash_of_some_columns(spark):
    """Sampled by one side's columns of a join, the bounds still cut the order into about equal slices, a repeated
    place or a hot group too, and give the same ranks."""
    rows = [(f"s{i % 1500}", i % 40, float(i % 1009), i % 5 == 0) for i in range(9000)] + [("s1", 1, 1.0, True)] * 3000
    items = spark.createDataFrame(rows, "e string, k int, v double, odd boolean")
    kinds = spark.createDataFrame([(k, "hot" if k % 3 else f"p{k}") for k in range(40)], "k int, p string")
    df = items.join(kinds, "k").select("p", "v", "e").distinct()
    order = ["p", "v", "e"]
    bounds = order_bounds(df, order, 30, counted=items, hashed=["v", "e"])
    again = order_bounds(df.repartition(7), order, 30, counted=items, hashed=["v", "e"])
    assert bounds == again and 15 < bounds.n < 30
    n = df.count()
    sizes = [r["count"] for r in with_slice(df, order, bounds, 1).groupBy("_slice").count().collect()]
    assert sum(sizes) == n and max(sizes) < 3 * n / 30
    _same(add_ranks(df, ["p"], "v", {"a": []}, ["e"], "pr", bounds), _windows(df, ["p"], {"a": []}, "v", ["e"]))


def test_neighbours_read_one_exchange(spark):
    df = spark.createDataFrame([("k", i, i % 5) for i in range(2000)], "g string, t int, v int").groupBy("g", "t").agg(F.sum("v").alias("v"))
    source = spark.createDataFrame([("k", i) for i in range(2000)], "g string, t int")
    final = _final_plan(sliced_shift(df, ["g"], ["t"], ["v"], "pv", -1, order_bounds(source, ["g", "t"], 8))).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("partial_sum(v") == 1


def test_neighbours_equal_windows(spark):
    rnd = random.Random(5)
    rows = [("hot" if i % 4 else (f"k{i % 13}" if i % 8 else None), i // 2, i, float(rnd.randint(0, 3))) for i in range(2500)]
    df = spark.createDataFrame(rows, "g string, t int, i int, v double")
    w = Window.partitionBy("g").orderBy("t", "i")
    want = df.select("*", F.lag(F.struct("v")).over(w).alias("pv"), F.lead(F.struct("v")).over(w).alias("nx"))
    for slices in (2, 9):
        b = order_bounds(df, ["g", "t"], slices)
        got = sliced_shift(sliced_shift(df, ["g"], ["t", "i"], ["v"], "pv", -1, b, by=["t"]), ["g"], ["t", "i"], ["v"], "nx", +1, b, by=["t"])
        _same(got, want)


def test_scd_rebuild_equals_plain_changes(spark):
    from stationlens.operators.history import scd2_rebuild
    rnd = random.Random(9)
    base = dt.datetime(2024, 1, 1)
    rows = [("hot" if i % 3 else f"k{i % 7}", base + dt.timedelta(minutes=i), float(rnd.randint(0, 2))) for i in range(1500)]
    got = sorted((r["k"], r["valid_from"], r["valid_to"], r["v"])
                 for r in scd2_rebuild(spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double"), ["k"], "ts", ["v"]).collect())
    want = []
    for k in {r[0] for r in rows}:
        seen = [r for r in rows if r[0] == k]
        kept = [r for a, r in zip([None, *seen], seen) if a is None or a[2] != r[2]]
        want += [(k, r[1], n[1] if n else None, r[2]) for r, n in zip(kept, [*kept[1:], None])]
    key = lambda x: (x[0], x[1])
    assert sorted(got, key=key) == sorted(want, key=key) and len(got) > 100


def test_top_k_uses_window_group_limit(spark):
    from stationlens.operators.ranking import top_k
    df = spark.createDataFrame([(f"g{i % 3}", float(i)) for i in range(60)], "g string, v double")
    out = top_k(df, ["g"], ["v"], 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted((r["g"], r["v"]) for r in out.collect()) == [
        ("g0", 0.0), ("g0", 3.0), ("g1", 1.0), ("g1", 4.0), ("g2", 2.0), ("g2", 5.0)]


def test_daily_last_is_hash_aggregated_with_map_side_combine(spark):
    rows = [("hot", "GAZOLE", "1", _ts(1, h % 24), float(h)) for h in range(300)] + \
           [(f"s{i}", "SP95", "2", _ts(1, 8), 1.5) for i in range(50)]
    df = spark.createDataFrame(rows, "station string, product string, pid string, ts timestamp_ntz, v double")
    df = df.withColumn("day", F.to_date("ts"))
    out = daily_last(df, "station", "product", "day", "ts", "v", ids=["pid"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert plan.count("partial_max(") == 1 and plan.count("Exchange") == 2  # the aggregate's, the ids'
    hot = [r for r in out.collect() if r["station"] == "hot"]
    # latest time 23:00 is shared by h = 23, 47, ..., 287: ties resolve to the larger value
    assert len(hot) == 1 and hot[0]["nb_updates_jour"] == 300 and hot[0]["v"] == 287.0


@pytest.mark.parametrize("name", ["daily_series", "weekly_report", "price_anomalies", "regional_report"])
def test_the_fact_is_evaluated_once(spark, name):
    """Branches of one query share exchanges: the price events are scanned once in the executed plan."""
    import __spark_entry__ as entry
    from conftest import SF_SMALL
    df = entry.queries()[name](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("events.parquet") == 1
