"""End to end: change files -> cleansed -> curated -> gate -> publish."""
from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.plans import jobs as J
from tidemark.plans.curated import change_batches
from tidemark.sources import fixtures as X
from tidemark.sources.tables import VersionedTable

from paths import SMALL


def land(spark, raw, sf):
    """Full load of every table, then the three customer change batches."""
    def full(df):
        return df.withColumn("Op", F.lit("I")).withColumn("dms_ts", F.lit(X.FULL_LOAD_TS).cast("timestamp"))
    full(X.orders(spark, sf)).write.parquet(f"{raw}/orders")
    full(X.order_items(spark, sf)).write.parquet(f"{raw}/order_items")
    full(X.products(spark, sf)).write.parquet(f"{raw}/products")
    full(X.category_translation(spark, sf)).write.parquet(f"{raw}/category_translation")
    for b in change_batches(spark, sf):
        b.write.mode("append").parquet(f"{raw}/customers")


def test_jobs_end_to_end(spark, tmp_dir):
    raw, cleansed, curated = tmp_dir + "/raw", tmp_dir + "/cleansed", tmp_dir + "/curated"
    land(spark, raw, SMALL)
    done = J.raw_to_cleansed(spark, raw, cleansed, tmp_dir + "/ckpt", buckets={"order_items": 8})
    assert set(done) == {"orders", "order_items", "products", "category_translation", "customers"}
    again = J.raw_to_cleansed(spark, raw, cleansed, tmp_dir + "/ckpt", buckets={"order_items": 8})
    assert again == done                                                       # nothing new: nothing written

    # customers deleted before the first run have no version: their lines carry
    # no customer_key, which the full ruleset (correctly) refuses
    lenient = [r for r in Q.fact_ruleset(min_rows=0, max_price=1e9, min_delivered=0.0)
               if r.label() != 'IsComplete "customer_key"']
    log = tmp_dir + "/runlog"
    r1 = J.daily_pipeline(spark, cleansed, curated, X.RUN_TS[0], X.AS_OF_TS, lenient, run_log=log,
                          validations=[("no_orphans", "SELECT * FROM {fact_order_item} f LEFT ANTI JOIN "
                                                      "{dim_customer} d ON d.customer_key = f.customer_key")])
    assert r1.first()["outcome"] == "ok", r1.first()
    tables = J.read_curated(spark, curated)
    assert tables["fact_order_item"].count() == X.order_items(spark, SMALL).join(
        X.orders(spark, SMALL), "order_id").count()
    assert "order_month" in tables["fact_order_item"].columns

    strict = Q.fact_ruleset()                                                     # fails on this data
    r2 = J.daily_pipeline(spark, cleansed, curated, X.RUN_TS[1], X.AS_OF_TS, strict, run_log=log)
    assert r2.first()["outcome"] == "blocked"
    fact_t = VersionedTable(spark, curated + "/fact_order_item")
    assert len(fact_t.versions()) == 2 and len(fact_t.published()) == 1         # blocked version stays hidden
    assert spark.read.parquet(log).count() == 2


def test_command_line(spark, tmp_dir, capsys):
    from tidemark.__main__ import main
    raw, cleansed, curated = tmp_dir + "/raw", tmp_dir + "/cleansed", tmp_dir + "/curated"
    land(spark, raw, SMALL)
    assert main(["ingest", "--raw", raw, "--cleansed", cleansed, "--checkpoints", tmp_dir + "/ck"]) == 0
    # the full ruleset blocks this data: exit code 2, nothing published
    assert main(["build", "--cleansed", cleansed, "--curated", curated, "--run-ts", X.RUN_TS[0],
                 "--as-of", X.AS_OF_TS]) == 2
    assert main(["--json", "profile", "--dir", SMALL]) == 0
    out = capsys.readouterr().out
    assert '"table":"lineitem"' in out and "blocked" in out


def test_incremental_build_equals_full_rebuild(spark, tmp_dir):
    """Second build with only affected orders gives the same fact as a full one,
    with a change that lands late and a later as-of time."""
    raw, cleansed = tmp_dir + "/raw", tmp_dir + "/cleansed"
    land(spark, raw, SMALL)
    J.raw_to_cleansed(spark, raw, cleansed, tmp_dir + "/ckpt")
    full_dir, inc_dir = tmp_dir + "/full", tmp_dir + "/inc"
    for d in (full_dir, inc_dir):
        J.publish_curated(spark, d, J.cleansed_to_curated(spark, cleansed, d, X.RUN_TS[0], X.AS_OF_TS))
    # more changes land after the first build: an order changes status, a customer moves
    upd = (X.orders(spark, SMALL).orderBy("order_id").limit(3)
           .withColumn("order_status", F.lit("canceled")).withColumn("Op", F.lit("U"))
           .withColumn("dms_ts", F.lit("2000-01-01 00:00:00").cast("timestamp")))   # older than the first run
    upd.write.mode("append").parquet(f"{raw}/orders")
    cust = (spark.read.parquet(f"{raw}/customers").where("customer_id = '1000'").limit(1)
            .withColumn("customer_city", F.lit("Elsewhere")).withColumn("Op", F.lit("U"))
            .withColumn("dms_ts", F.lit("2024-03-01 00:00:00").cast("timestamp")))
    cust.write.mode("append").parquet(f"{raw}/customers")
    J.raw_to_cleansed(spark, raw, cleansed, tmp_dir + "/ckpt")
    later = "2031-01-01 00:00:00"                     # open orders become overdue
    J.publish_curated(spark, full_dir, J.cleansed_to_curated(spark, cleansed, full_dir, X.RUN_TS[1], later))
    J.publish_curated(spark, inc_dir, J.cleansed_to_curated(spark, cleansed, inc_dir, X.RUN_TS[1], later,
                                                            incremental=True))
    a = J.read_curated(spark, full_dir)["fact_order_item"]
    b = J.read_curated(spark, inc_dir)["fact_order_item"]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ids = [r["order_id"] for r in upd.select("order_id").collect()]
    assert b.where(F.col("order_id").isin(ids)).where("order_status <> 'canceled'").count() == 0


def test_readers_follow_one_pointer(spark, tmp_dir):
    """Versions without a pointer that names all four stay invisible."""
    raw, cleansed, curated = tmp_dir + "/raw", tmp_dir + "/cleansed", tmp_dir + "/curated"
    land(spark, raw, SMALL)
    J.raw_to_cleansed(spark, raw, cleansed, tmp_dir + "/ckpt")
    staged = J.cleansed_to_curated(spark, cleansed, curated, X.RUN_TS[0], X.AS_OF_TS)
    VersionedTable(spark, curated + "/dim_customer").publish(staged["dim_customer"])
    assert J.published_curated(spark, curated) is None
    J.publish_curated(spark, curated, staged)
    assert J.published_curated(spark, curated) == staged
