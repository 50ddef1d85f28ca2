"""Incremental fact by month, counts of the jobs, scanned bytes, the query log."""
import os

import pytest
from pyspark.sql import functions as F

from paths import SMALL
from tidemark import registry_jobs as RJ
from tidemark.operators import changes as C
from tidemark.operators import quality as Q
from tidemark.plans import jobs as J
from tidemark.plans import metrics as M
from tidemark.plans import pipeline as P
from tidemark.sources import fixtures as X
from tidemark.sources import scans as SC
from tidemark.sources import tables as T


def files(path):
    """Every data file of a partitioned folder, with what changes if it is written again."""
    return {os.path.join(d, f): (os.stat(os.path.join(d, f)).st_mtime_ns, os.stat(os.path.join(d, f)).st_ino)
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture(scope="module")
def first_build(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("months"))
    RJ.land_everything(spark, SMALL, root + "/raw")
    J.raw_to_cleansed(spark, root + "/raw", root + "/cleansed", root + "/checkpoints")
    for d in ("/inc", "/full"):
        J.publish_curated(spark, root + d, J.cleansed_to_curated(spark, root + "/cleansed", root + d, *RJ.BUILDS[0]))
    return root


def test_only_touched_months_are_written(spark, first_build):
    root = first_build
    base = J.published_curated(spark, root + "/inc")["fact_order_item"]
    before = files(base)
    # one order of one month is canceled, another one moves a year ahead: three months
    orders = X.orders(spark, SMALL).orderBy("order_id").limit(2).withColumns(
        {"Op": F.lit("U"), "dms_ts": F.lit(RJ.LATE_TS).cast("timestamp"), "order_status": F.lit("canceled"),
         "order_delivered_customer_date": F.lit(None).cast("timestamp")})
    ids = sorted(r["order_id"] for r in orders.collect())
    orders.withColumn("order_purchase_timestamp", F.when(F.col("order_id") == ids[1], F.timestamp_add("YEAR", F.lit(1), "order_purchase_timestamp"))
                      .otherwise(F.col("order_purchase_timestamp"))).write.mode("append").parquet(root + "/raw/orders")
    J.raw_to_cleansed(spark, root + "/raw", root + "/cleansed", root + "/checkpoints")
    later = RJ.BUILDS[1][0], RJ.BUILDS[0][1]  # the same as-of time
    staged = J.cleansed_to_curated(spark, root + "/cleansed", root + "/inc", *later, incremental=True)
    patch = staged["fact_order_item"]
    assert isinstance(patch, J.MonthPatch) and 1 <= len(patch.months) <= 3
    assert files(base) == before                                    # nothing is visible yet
    seen = {tuple(r) for r in J.staged_tables(spark, staged)["fact_order_item"].collect()}
    J.publish_curated(spark, root + "/inc", staged)
    after = files(base)
    changed = {os.path.dirname(f) for f in set(before.items()) ^ set(after.items()) for f in [f[0]]}
    assert {os.path.basename(d) for d in changed} == {f"order_month={m}" for m in patch.months}
    got = J.read_curated(spark, root + "/inc")["fact_order_item"]
    assert {tuple(r) for r in got.collect()} == seen
    J.publish_curated(spark, root + "/full", J.cleansed_to_curated(spark, root + "/cleansed", root + "/full", *later))
    want = J.read_curated(spark, root + "/full")["fact_order_item"]
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and want.count() == got.count()
    assert got.where(F.col("order_id") == ids[1]).select("order_month").distinct().count() == 1
    # publishing the same months again changes no row
    patch.apply(spark)
    assert {tuple(r) for r in spark.read.parquet(base).collect()} == seen
    # no batch since: no month is touched
    again = J.cleansed_to_curated(spark, root + "/cleansed", root + "/inc", "1998-01-01 00:00:00", RJ.BUILDS[0][1], incremental=True)
    assert again["fact_order_item"].months == ()


def test_a_blocked_incremental_run_leaves_the_months(spark, first_build):
    root = first_build
    base = J.published_curated(spark, root + "/full")["fact_order_item"]
    before, pointer = files(base), J.published_curated(spark, root + "/full")
    row = J.daily_pipeline(spark, root + "/cleansed", root + "/full", "1999-01-01 00:00:00", "2031-01-01 00:00:00",
                           [Q.RowCount(">", 1 << 60)], incremental=True).first()
    assert row["outcome"] == "blocked" and files(base) == before and J.published_curated(spark, root + "/full") == pointer


def test_an_emptied_month_goes(spark, tmp_dir):
    rows = [("a", 1, "1990-01-05 00:00:00"), ("b", 1, "1990-02-05 00:00:00"), ("c", 1, None)]
    fact = spark.createDataFrame(rows, "order_id string, order_item_id int, ts string").select(
        "order_id", "order_item_id", F.col("ts").cast("timestamp").alias("order_ts"))
    T.write_fact(J.S.with_order_month(fact), tmp_dir + "/fact")
    moved = fact.where("order_id <> 'b'").withColumn("order_ts", F.lit("1990-02-07 00:00:00").cast("timestamp"))
    patch = J.stage_months(spark, tmp_dir + "/fact", moved)
    assert set(patch.months) == {"1990-01", "1990-02", None}
    patch.apply(spark)
    got = spark.read.parquet(tmp_dir + "/fact")
    assert sorted((r["order_id"], r["order_month"]) for r in got.collect()) == [("a", "1990-02"), ("b", "1990-02"), ("c", "1990-02")]
    assert sorted(d for d in os.listdir(tmp_dir + "/fact") if "=" in d) == ["order_month=1990-02"]


def test_counts_of_every_batch(spark, first_build):
    got = {(r["table_name"], r["batch_id"]): r.asDict() for r in J.applied_counts(spark, first_build + "/cleansed").collect()}
    n = X.order_items(spark, SMALL).count()
    assert got["order_items", 0]["inserted"] == n == got["order_items", 0]["latest_rows"] and got["order_items", 0]["rejected"] == 0
    assert {t for t, _ in got} == {"orders", "order_items", "products", "category_translation", "customers"}


def test_observed_counts_equal_the_plan(spark, tmp_dir):
    from pyspark.sql import Observation
    schema = "customer_id string, customer_city string, Op string, dms_ts timestamp"
    row = lambda k, op, t: (k, "x", op, __import__("datetime").datetime(2024, 1, t))
    target = C.initial_load(C.prepare(spark.createDataFrame([row(k, "I", 5) for k in "abcd"], schema), ["customer_id"]))
    latest = C.prepare(spark.createDataFrame([row("a", "U", 6), row("b", "D", 6), row("c", "U", 1), row("e", "I", 6), row("f", "D", 6)], schema), ["customer_id"])
    for keys in (False, True):
        seen = Observation()
        C.apply_changes(target, latest, ["customer_id"], True, broadcast_keys=keys, observe=seen).write.parquet(f"{tmp_dir}/{keys}")
        assert seen.get == {"inserted": 1, "updated": 1, "deleted": 1, "ignored": 2, "latest_rows": 5}


def test_a_stale_delete_is_ignored_too(spark):
    schema = "customer_id string, customer_city string, Op string, dms_ts timestamp"
    target = C.initial_load(C.prepare(spark.sql(f"SELECT 'a' AS customer_id, 'new' AS customer_city, 'I' AS Op, timestamp'2024-05-01' AS dms_ts"), ["customer_id"]))
    late = C.prepare(spark.sql("SELECT 'a' AS customer_id, 'old' AS customer_city, 'D' AS Op, timestamp'2024-01-01' AS dms_ts"), ["customer_id"])
    assert schema and C.apply_changes(target, late, ["customer_id"], ignore_stale=True).count() == 1
    assert C.apply_changes(target, late, ["customer_id"]).count() == 0


def test_validations_report_what_they_scanned(spark, tmp_dir):
    df = spark.range(3000).withColumn("m", F.col("id") % 3)
    df.repartition(2).write.partitionBy("m").parquet(tmp_dir + "/t")
    t, log = spark.read.parquet(tmp_dir + "/t"), tmp_dir + "/log"
    checks = [("all", "SELECT * FROM {t}"), ("one", "SELECT * FROM {t} WHERE m = 1"),
              ("both", "SELECT a.id FROM {t} a JOIN {t} b ON a.id = b.id WHERE a.m = 0 AND b.m = 0"), ("bad", "SELECT nothing FROM {t}")]
    rows = {r["name"]: r for r in P.run_validations(spark, checks, query_log=log, t=t).collect()}
    sizes = [os.path.getsize(f) for f in files(tmp_dir + "/t")]
    assert (rows["all"]["scanned_files"], rows["all"]["scanned_bytes"]) == (len(sizes), sum(sizes))
    assert rows["one"]["scanned_bytes"] < rows["all"]["scanned_bytes"] and rows["one"]["rows"] == 1000
    assert rows["both"]["scanned_files"] == 4 or rows["both"]["scanned_files"] == 2  # a reused exchange scans once
    assert rows["bad"]["state"] == "FAILED" and rows["bad"]["scanned_bytes"] is None
    cost = M.scan_cost(spark.read.parquet(log), 50).first()
    assert cost["queries"] == 4 and cost["scanned_bytes"] == sum(r["scanned_bytes"] or 0 for r in rows.values())
    assert SC.listed(t.where("m = 7")) == SC.Scanned(0, 0)


def test_inventory_reads_no_row(spark, tmp_dir):
    spark.range(100).withColumn("m", F.col("id") % 2).write.partitionBy("m").parquet(tmp_dir + "/t")
    t = spark.read.parquet(tmp_dir + "/t")
    inventory = T.file_inventory(t.where("m = 1"))
    plan = inventory._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "LocalTableScan" in plan or "Scan ExistingRDD" in plan
    size = [os.path.getsize(f) for f in files(tmp_dir + "/t/m=1")]
    row = inventory.first()
    assert row["files"] == len(size) and row["avg_file_mb"] == round(sum(size) / len(size) / 2**20, 2)
    assert T.file_inventory(t.where("m = 5")).first()["avg_file_mb"] is None


def test_reconciliation_of_two_ledgers(spark):
    a = spark.createDataFrame([("1", 10.0), ("1", 5.0), ("2", 100.0), ("3", 1.0), (None, 2.0), ("5", 0.0)], "k string, x double")
    b = spark.createDataFrame([("1", 15.0), ("2", 101.0), ("4", 1.0), (None, 2.0), ("5", 0.0)], "k string, y double")
    got = {r["k"]: r["state"] for r in Q.reconcile(a, b, ["k"], "x", "y").collect()}
    assert got == {"1": Q.BALANCED, "2": Q.OFF, "3": Q.LEFT_ONLY, "4": Q.RIGHT_ONLY, None: Q.BALANCED, "5": Q.BALANCED}
    assert {r["k"]: r["state"] for r in Q.reconcile(a, b, ["k"], "x", "y", 0.01).collect()}["2"] == Q.BALANCED
    rule = Q.Balance(b, ("k",), "x", "y", 0.01)
    row = Q.evaluate(spark, a, [rule]).first()
    assert (row["outcome"], row["observed"], row["message"]) == ("FAILED", 2.0, "2 of 6 keys out of balance")
    assert Q.evaluate(spark, a.limit(0), [Q.Balance(b.limit(0), ("k",), "x", "y")]).first()["passed"]
