"""SCD merges vs rebuild, data-quality checks."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stationlens.operators import history as H
from stationlens.operators import quality as Q


def _obs(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")


def test_scd_timestamp_batches_equal_one(spark):
    """Any split into batches gives the same versions as all updates at once: every dated update."""
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = [(f"k{rnd.randint(0, 9)}" if i % 3 else "hot", base + dt.timedelta(hours=i), float(rnd.randint(1, 3)))
            for i in range(120)]
    rows += [("k1", None, 9.0), (None, base, 1.0), (None, base + dt.timedelta(hours=7), 2.0)]
    rows += rows[:10]  # repeated updates
    df = _obs(spark, rows)
    want = []
    for k in {r[0] for r in rows}:
        times = sorted({r[1] for r in rows if r[0] == k and r[1]})
        want += [(k, t, n) for t, n in zip(times, [*times[1:], None])]
    key = lambda x: (x[0] or "", x[1])
    for cuts in ((0, 120), (0, 40, 80, 120), (0, 7, 60, 61, 120)):
        hist = None
        for lo, hi in zip(cuts, cuts[1:]):
            part = df.filter(F.col("ts").isNull() | ((F.col("ts") >= base + dt.timedelta(hours=lo))
                                                     & (F.col("ts") < base + dt.timedelta(hours=hi))))
            hist = H.scd2_timestamp(hist, part, ["k"], "ts").checkpoint()
        got = sorted(((r["k"], r["valid_from"], r["valid_to"]) for r in hist.collect()), key=key)
        assert got == sorted(want, key=key)
        again = H.scd2_timestamp(hist, df, ["k"], "ts")  # a replay adds nothing
        assert again.count() == len(want)
    at = H.as_of_version(hist, "2024-01-03 00:30:00").filter("k = 'hot'").collect()
    assert [r["valid_from"] for r in at] == [max(r[1] for r in rows if r[0] == "hot" and r[1] and r[1] <= dt.datetime(2024, 1, 3, 0, 30))]


def test_scd_check_repeated_and_null_keys(spark):
    cols = "a string, b string, x string"
    s1 = spark.createDataFrame([("k", "1", "p"), ("k", "1", "q"), (None, "2", "r"), ("k", None, "s"), (None, None, "t")], cols)
    h = None
    for day in (1, 2, 3):  # the same rows again change nothing
        h = H.scd2_check(h, s1, ["a", "b"], ["x"], f"2024-01-0{day} 00:00:00").checkpoint()
    got = sorted((r["a"] or "", r["b"] or "", r["x"], r["valid_to"]) for r in h.collect())
    assert got == [("", "", "t", None), ("", "2", "r", None), ("k", "", "s", None), ("k", "1", "q", None)]
    assert h.select("scd_id").distinct().count() == 4
    h = H.scd2_check(h, s1.filter("a is not null"), ["a", "b"], ["x"], "2024-01-04 00:00:00")
    assert h.filter("a is null and valid_to is not null").count() == 2


def test_scd_check_closes_missing_and_changed(spark):
    s1 = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None)], "id string, addr string")
    s2 = spark.createDataFrame([("a", "x"), ("b", "Y"), ("c", None), ("d", "z")], "id string, addr string")
    s3 = spark.createDataFrame([("a", "x")], "id string, addr string")
    h = H.scd2_check(None, s1, ["id"], ["addr"], "2024-01-01 00:00:00")
    h = H.scd2_check(h, s2, ["id"], ["addr"], "2024-01-02 00:00:00")
    h = H.scd2_check(h, s3, ["id"], ["addr"], "2024-01-03 00:00:00")
    rows = sorted((r["id"], r["addr"], str(r["valid_from"])[:10], str(r["valid_to"])[:10] if r["valid_to"] else None)
                  for r in h.collect())
    assert rows == [
        ("a", "x", "2024-01-01", None),
        ("b", "Y", "2024-01-02", "2024-01-03"),
        ("b", "y", "2024-01-01", "2024-01-02"),
        ("c", None, "2024-01-01", "2024-01-03"),
        ("d", "z", "2024-01-02", "2024-01-03"),
    ]
    at = H.as_of_version(h, "2024-01-02 12:00:00")
    assert sorted(r["id"] for r in at.collect()) == ["a", "b", "c", "d"]


def test_scd_rebuild_change_rows(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("k", base + dt.timedelta(hours=h), v) for h, v in enumerate([1.0, 1.0, 2.0, 2.0, 1.0])]
    out = H.scd2_rebuild(_obs(spark, rows), ["k"], "ts", ["v"]).orderBy("valid_from").collect()
    assert [(r["v"], r["valid_from"].hour, r["valid_to"].hour if r["valid_to"] else None) for r in out] == \
        [(1.0, 0, 2), (2.0, 2, 4), (1.0, 4, None)]


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", "GAZOLE", 1.0, "75001"), ("a", "XX", 6.0, "7500"), (None, None, None, None)],
                               "id string, p string, v double, cp string")
    assert Q.unique(df, ["id"]).collect()[0]["n_records"] == 2
    assert Q.not_null(df, "id").count() == 1
    assert [r["p"] for r in Q.accepted_values(df, "p", ["GAZOLE"]).collect()] == ["XX"]
    assert Q.between(df, "v", 0.5, 5.0).count() == 1
    assert Q.length_eq(df, "cp", 5).count() == 1
    parent = spark.createDataFrame([("b",)], "id string")
    rel = Q.relationships(df, "id", parent, "id").collect()
    assert [(r["id"], r["n_records"]) for r in rel] == [("a", 2)]
    plan = Q.orphans(df, parent, "id")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan
    declared = {"t": {"id": (Q.Rule("unique", severity="error"), Q.not_null_rule(), Q.parent("pa", "id")),
                      "cp": (Q.length(5),), "v": (Q.between_rule(0.5, 6.0),), "p": (Q.accepted(["GAZOLE"]),)},
                "pa": {"id": (Q.unique_rule(),)}}
    single = Q.Check("none", "t", "id", Q.not_null(df, "id").limit(0), "warn")
    suite = Q.run_rules(spark, {"t": df, "pa": parent}, declared, [single])
    got = {(r["table_name"], r["check_name"]): (r["failures"], r["status"]) for r in suite.collect()}
    assert got == {("t", "unique_id"): (1, "error"), ("t", "not_null_id"): (1, "warn"), ("t", "parent_id"): (1, "warn"),
                   ("t", "length_cp"): (1, "warn"), ("t", "between_v"): (0, "pass"), ("t", "accepted_p"): (1, "warn"),
                   ("pa", "unique_id"): (0, "pass"), ("t", "none"): (0, "pass")}


def test_rules_scan_each_table_once(spark):
    """All rules of all tables: one scan a table, one shuffle of keys (and one of the rules' counts)."""
    import random
    rnd = random.Random(4)
    child = spark.createDataFrame([(rnd.choice(["a", "b", "c", None, f"k{i}"]), i % 7 if i % 5 else None, f"u{i // 2}") for i in range(400)], "k string, n int, u string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,)] + [(f"k{i}",) for i in range(0, 400, 2)], "k string")
    declared = {"c": {"k": (Q.not_null_rule(), Q.parent("p", "k")), "n": (Q.between_rule(0, 4), Q.not_null_rule()), "u": (Q.unique_rule(),)},
                "p": {"k": (Q.unique_rule(), Q.not_null_rule())}}
    out = Q.run_rules(spark, {"c": child, "p": parent}, declared)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 2 and plan.count("Exchange hashpartitioning(rule") <= 2
    got = {(r["table_name"], r["check_name"]): r["failures"] for r in out.collect()}
    assert got == {("c", "not_null_k"): Q.not_null(child, "k").count(), ("c", "parent_k"): Q.relationships(child, "k", parent, "k").count(),
                   ("c", "between_n"): Q.between(child, "n", 0, 4).count(), ("c", "not_null_n"): Q.not_null(child, "n").count(),
                   ("c", "unique_u"): Q.unique(child, ["u"]).count(), ("p", "unique_k"): Q.unique(parent, ["k"]).count(),
                   ("p", "not_null_k"): 1}
    assert got[("c", "unique_u")] == 200 and got[("c", "parent_k")] > 10
