"""XML feed, raw loads with observed counts, run log, fact layout, versioned history,
streaming refresh."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from stationlens.sources import feed as FD
from stationlens.sources import marts as M
from stationlens.sources import raw as R
from stationlens.sources import segments as S
from stationlens.sources import tables as TB

XML = """<?xml version="1.0" encoding="ISO-8859-1"?>
<pdv_liste>
 <pdv id="1001" latitude="4885660" longitude="235220" cp="75001" pop="R">
  <adresse>1 rue du Test</adresse><ville>Paris</ville>
  <horaires automate-24-24="1">
   <jour nom="Lundi" ferme=""><horaire ouverture="08.00" fermeture="12.00"/><horaire ouverture="14.00" fermeture="20.00"/></jour>
   <jour nom="Dimanche" ferme="1"/></horaires>
  <services><service>Boutique</service><service>Lavage automatique</service></services>
  <prix nom="Gazole" id="1" maj="2024-01-01 08:00:00" valeur="1.799"/>
  <prix nom="SP95" id="2" maj="2024-01-01 09:00:00" valeur="1.899"/>
  <rupture nom="SP95" id="2" debut="2024-01-01 00:00:00" fin="" type="temporaire"/>
 </pdv>
 <pdv id="1002" latitude="" longitude="x" cp="97110" pop="A"><adresse/><ville>Pointe-à-Pitre</ville></pdv>
</pdv_liste>
"""
AS_OF = dt.datetime(2024, 1, 1, 12, 0, 0)


def _feed_file(tmp_dir):
    path = os.path.join(tmp_dir, "feed.xml")
    with open(path, "wb") as fh:
        fh.write(XML.encode("latin-1"))
    return path


def test_feed_flatten_and_explode(spark, tmp_dir):
    feed = FD.read_feed(spark, _feed_file(tmp_dir))
    st = {r["station_id"]: r for r in FD.flatten_stations(feed, AS_OF).collect()}
    assert st["1001"]["services"] == "Boutique,Lavage automatique"
    assert st["1001"]["horaires_json"] == "Lundi::08.00-12.00;14.00-20.00|Dimanche:1:"
    assert st["1001"]["automate_24_24"] == "1"
    assert st["1002"]["services"] == "" and st["1002"]["horaires_json"] == ""
    assert st["1002"]["ville"] == "Pointe-à-Pitre" and st["1002"]["adresse"] == ""
    px = FD.explode_prices(feed, AS_OF).collect()
    assert sorted((r["carburant_nom"], r["valeur"]) for r in px) == [("Gazole", "1.799"), ("SP95", "1.899")]
    ru = FD.explode_shortages(feed, AS_OF).collect()
    assert len(ru) == 1 and ru[0]["fin"] == ""


def test_ingest_counts_and_run_log(spark, tmp_dir):
    counts = R.ingest(spark, _feed_file(tmp_dir), os.path.join(tmp_dir, "raw"), AS_OF)
    assert counts == {"raw_stations": 2, "raw_prix": 2, "raw_ruptures": 1, "raw_rejected": 0}
    log = spark.read.parquet(os.path.join(tmp_dir, "raw", "raw_ingestion_log")).collect()
    assert len(log) == 1 and log[0]["status"] == "SUCCESS" and log[0]["prix_count"] == 2
    try:
        R.ingest(spark, os.path.join(tmp_dir, "missing.xml"), os.path.join(tmp_dir, "raw"), AS_OF, "bad")
    except Exception:
        pass
    log = spark.read.parquet(os.path.join(tmp_dir, "raw", "raw_ingestion_log"))
    assert log.filter("status = 'FAILED'").count() == 1


def test_fact_layout_and_pruning(spark, tmp_dir):
    rows = [(f"s{i}", "GAZOLE" if i % 2 else "SP95", dt.date(2024, 1 + i % 3, 1 + i % 20), 1.5) for i in range(60)]
    df = spark.createDataFrame(rows, "station_id string, carburant_nom string, date_prix date, prix_euros double")
    path = os.path.join(tmp_dir, "fact")
    M.write_fact(df, path)
    from stationlens.operators.reports import slice_since
    back = slice_since(M.read_mart(spark, path), "date_prix", "2024-03-10", 9)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mois_prix" in plan, plan
    assert "PushedFilters: [IsNotNull(date_prix), GreaterThanOrEqual(date_prix" in plan, plan
    assert back.count() == sum(1 for r in rows if r[2] >= dt.date(2024, 3, 1))


def test_versioned_history_and_stream(spark, tmp_dir):
    from stationlens.streaming.snapshots import start_price_history_stream

    landing = os.path.join(tmp_dir, "landing")
    hist = os.path.join(tmp_dir, "hist")
    ck = os.path.join(tmp_dir, "ck")
    t = dt.datetime(2024, 1, 1)
    b1 = [("s1", "GAZOLE", "1", "1.70", "2024-01-01 08:00:00", t), ("s2", "GAZOLE", "1", "1.80", "2024-01-01 08:00:00", t)]
    spark.createDataFrame(b1, R.RAW_PRICES).write.parquet(os.path.join(landing, "b1"))
    q = start_price_history_stream(spark, landing + "/*", hist, ck)
    q.awaitTermination(120)
    b2 = [("s1", "GAZOLE", "1", "1.75", "2024-01-02 08:00:00", t)]
    spark.createDataFrame(b2, R.RAW_PRICES).write.parquet(os.path.join(landing, "b2"))
    q = start_price_history_stream(spark, landing + "/*", hist, ck)
    q.awaitTermination(120)
    h = S.read_history(spark, hist)
    rows = sorted((r["station_id"], float(r["prix_euros"]), r["valid_to"] is None) for r in h.collect())
    assert rows == [("s1", 1.7, False), ("s1", 1.75, True), ("s2", 1.8, True)]
    assert S.open_history(spark, hist).run == 1


def test_stream_batch_replay_is_skipped(spark, tmp_dir):
    from stationlens.streaming.snapshots import merge_batch
    hist = os.path.join(tmp_dir, "hist_replay")
    t = dt.datetime(2024, 1, 1)
    batch = spark.createDataFrame([("s1", "GAZOLE", "1", "1.70", "2024-01-01 08:00:00", t)], R.RAW_PRICES)
    run = merge_batch(hist, "a")
    run(batch, 0)
    run(batch, 0)  # replay after a committed write: no second segment
    assert S.read_history(spark, hist).count() == 1
    assert S.open_history(spark, hist).run == 0
    other = spark.createDataFrame([("s2", "GAZOLE", "1", "1.80", "2024-01-01 09:00:00", t)], R.RAW_PRICES)
    merge_batch(hist, "b")(other, 0)  # a stream with a new checkpoint: its ids start at 0 again
    third = spark.createDataFrame([("s3", "GAZOLE", "1", "1.90", "2024-01-01 10:00:00", t)], R.RAW_PRICES)
    run(third, 5)  # a gap in the ids
    assert sorted(r["station_id"] for r in S.read_history(spark, hist).collect()) == ["s1", "s2", "s3"]
    assert S.open_history(spark, hist).run == 2


def test_failing_read_is_not_an_empty_history(spark, tmp_dir):
    bad = os.path.join(tmp_dir, "bad", "manifest")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("this is no parquet file")
    with pytest.raises(Exception):
        S.open_history(spark, os.path.join(tmp_dir, "bad"))
    with pytest.raises(Exception):
        TB.current(spark, os.path.join(tmp_dir, "bad"))
    assert S.open_history(spark, os.path.join(tmp_dir, "nowhere")) is None
    assert TB.current(spark, os.path.join(tmp_dir, "nowhere")) is None


# --- published tables -------------------------------------------------------

def test_publish_switches_whole_versions(spark, tmp_dir):
    at = os.path.join(tmp_dir, "t")
    first = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 5))], "x int, d date")
    v = TB.publish(first, at, ranges=["d"])
    assert (v.version, v.rows, v.least, v.greatest) == (0, 2, {"d": "2024-01-01"}, {"d": "2024-01-05"})
    reader = TB.read_table(spark, at)  # a plan made before the next version
    TB.publish(TB.read_table(spark, at).filter("x = 2").withColumn("y", F.lit("new")), at, ranges=["d"])  # reads itself
    assert sorted(r.x for r in reader.collect()) == [1, 2]
    assert [tuple(r) for r in TB.read_table(spark, at).collect()] == [(2, dt.date(2024, 1, 5), "new")]
    assert len(TB.live_folders(spark, at, keep=2)) == 2 and len(TB.live_folders(spark, at)) == 1
    TB.publish(first.limit(0), at)  # an empty table is a table
    assert TB.read_table(spark, at).count() == 0 and TB.current(spark, at).rows == 0


def test_a_write_that_dies_leaves_the_table(spark, tmp_dir):
    """The job fails in the middle of the write; then a writer is killed before and after its data were whole:
    readers, counts and the next publication see none of it."""
    at = os.path.join(tmp_dir, "t")
    TB.publish(spark.range(10), at)
    dies = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        TB.publish(dies, at)
    with pytest.raises(Exception, match="lost"):
        R.full_refresh(dies, at)
    spark.range(77).write.parquet(os.path.join(at, "data", "00000001-killed"))  # data whole, no manifest row
    os.makedirs(os.path.join(at, "manifest", "_temporary", "0", "task"))
    open(os.path.join(at, "manifest", "_temporary", "0", "task", "part-0.parquet"), "w").close()  # row not committed
    assert TB.read_table(spark, at).count() == 10 and TB.current(spark, at).rows == 10
    assert TB.publish(spark.range(5), at).version == 1
    assert TB.read_table(spark, at).count() == 5


def test_killed_process_leaves_the_table(spark, tmp_dir):
    """A process that writes the table is killed: the old version is still there."""
    import signal
    import subprocess
    import sys
    import time
    at = os.path.join(tmp_dir, "t")
    TB.publish(spark.range(10), at)
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from stationlens.session import get_spark
from stationlens.sources.tables import publish
from pyspark.sql import functions as F
spark = get_spark(master="local[2]")
slow = spark.range(0, 10**13, 1, 64).select("id", F.sha2(F.col("id").cast("string"), 512).alias("h"))
print("go", flush=True)
publish(slow, {at!r})
"""
    child = subprocess.Popen([sys.executable, "-c", code], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, start_new_session=True)
    assert child.stdout.readline().strip() == b"go"
    data = os.path.join(at, "data")
    for _ in range(300):  # until the writer has begun a second folder
        if len(os.listdir(data)) > 1:
            break
        time.sleep(0.1)
    time.sleep(0.5)
    os.killpg(child.pid, signal.SIGKILL)
    child.wait()
    assert len(os.listdir(data)) == 2
    assert TB.read_table(spark, at).count() == 10 and TB.current(spark, at).version == 0


def test_counts_and_ranges_read_manifests_only(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    TB.publish(spark.createDataFrame([(1, "2024-01-01"), (2, None)], "x int, day string"), a, ranges=["day"])
    TB.publish(spark.range(7), b)
    got = TB.table_facts(spark, {"a": a, "b": b}, "day")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "/data" not in plan and plan.count("FileScan parquet") == 2
    assert sorted(map(tuple, got.collect())) == [("a", 2, "2024-01-01", "2024-01-01"), ("b", 7, None, None)]


def test_a_hot_product_day_is_written_by_several_tasks(spark, tmp_dir):
    rows = [(f"s{i}", "1", "GAZOLE" if i % 3 == 0 else f"P{i % 50}", dt.date(2024, 1, 1 + (0 if i % 3 == 0 else i % 28)), 1.5) for i in range(6000)]
    df = spark.createDataFrame(rows, "station_id string, carburant_id string, carburant_nom string, date_prix date, prix_euros double")
    at = os.path.join(tmp_dir, "fact")
    v = M.write_fact(df, at, num_partitions=12)
    assert v.greatest["date_prix"] == "2024-01-28"
    files = M.read_mart(spark, at).filter("carburant_nom = 'GAZOLE' and date_prix = '2024-01-01'").groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 4 and max(r["count"] for r in files) < 2000 / 2.5


# --- history as segments ------------------------------------------------------

def _bytes(folder: str) -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


def test_segments_equal_full_copies(spark, tmp_dir):
    import random

    from stationlens.operators import history as H
    rnd, base = random.Random(2), dt.datetime(2024, 1, 1)
    at = os.path.join(tmp_dir, "h")
    whole = None
    for run in range(5):
        rows = [(rnd.choice(["a", "b", None, f"k{rnd.randint(0, 30)}"]), base + dt.timedelta(hours=100 * run + rnd.randint(0, 99)), float(rnd.randint(0, 3)))
                for _ in range(60)]
        df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
        whole = H.scd2_timestamp(whole, df, ["k"], "ts", ["v"]).checkpoint()
        S.run_changes(spark, at, ["k"], df, lambda known: H.timestamp_changes(known, df, ["k"], "ts", ["v"]), source=f"load {run}")
        assert S.run_changes(spark, at, ["k"], df, lambda known: 1 / 0, source=f"load {run}") is None  # a replay
        if run == 2:
            S.compact(spark, at)
            assert len(S.open_history(spark, at).folders) == 1
        same = lambda x: sorted(map(repr, x.select("k", "ts", "v", "valid_from", "valid_to", "scd_id").collect()))
        assert same(S.read_history(spark, at)) == same(whole)
    assert S.open_versions(spark, at).count() == whole.filter("valid_to is null").count()


def test_check_segments_equal_full_copies(spark, tmp_dir):
    from stationlens.operators import history as H
    at, whole = os.path.join(tmp_dir, "h"), None
    runs = [[("a", "x"), ("b", "y"), (None, "n")], [("a", "X"), ("b", "y"), ("c", "z")], [("a", "X")], [], [("b", "y")]]
    for i, rows in enumerate(runs):
        df, when = spark.createDataFrame(rows, "id string, addr string"), f"2024-01-0{i + 1} 00:00:00"
        whole = H.scd2_check(whole, df, ["id"], ["addr"], when).checkpoint()
        S.run_changes(spark, at, ["id"], df, lambda known: H.check_changes(known, df, ["id"], ["addr"], when), all_keys=True)
        same = lambda x: sorted(map(repr, x.select("id", "addr", "valid_from", "valid_to", "scd_id").collect()))
        assert same(S.read_history(spark, at)) == same(whole)


def test_a_run_writes_what_changed(spark, tmp_dir):
    """One of a hundred keys changes: about one of a hundred bytes is written, and only its buckets are read."""
    from stationlens.operators import history as H
    at = os.path.join(tmp_dir, "h")
    first = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
                                       F.sha2((F.col("id") + 1).cast("string"), 256).alias("v"))
    changes = lambda df: lambda known: H.timestamp_changes(known, df, ["k"], "ts")
    S.run_changes(spark, at, ["k"], first, changes(first), buckets=4)
    before = _bytes(at)
    second = first.filter(F.pmod(F.xxhash64("k"), F.lit(400)) == 0).withColumn("ts", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    S.run_changes(spark, at, ["k"], second, changes(second))
    n = second.count()
    assert 100 < n < 250 and _bytes(at) - before < 0.03 * before
    h = S.read_history(spark, at)
    assert h.count() == 60_000 + n and h.filter("valid_to is not null").count() == n


def test_a_run_that_dies_leaves_the_history(spark, tmp_dir):
    from stationlens.operators import history as H
    at = os.path.join(tmp_dir, "h")
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1)], "k string, ts timestamp_ntz, v int")
    S.run_changes(spark, at, ["k"], df, lambda known: H.timestamp_changes(known, df, ["k"], "ts"))
    with pytest.raises(Exception, match="lost"):
        S.append_changes(H.timestamp_changes(None, df, ["k"], "ts").withColumn("v", F.raise_error(F.lit("lost")).cast("int")), at, ["k"])
    assert S.open_history(spark, at).run == 0 and S.read_history(spark, at).count() == 1


def test_malformed_elements_are_kept_apart(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "feed.xml"), "wb") as f:
        f.write(XML.replace("</pdv_liste>", ' <pdv id="9"><adresse>open</pdv>\n</pdv_liste>').encode("latin-1"))
    scan = FD.read_feed(spark, os.path.join(tmp_dir, "feed.xml"), keep_malformed=True).persist()
    assert [r["_id"] for r in FD.well_formed(scan).orderBy("_id").collect()] == ["1001", "1002"]
    assert ["open" in r["element"] for r in FD.rejected(scan, AS_OF).collect()] == [True]
    assert FD.read_feed(spark, os.path.join(tmp_dir, "feed.xml")).count() == 2
