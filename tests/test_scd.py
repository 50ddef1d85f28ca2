"""SCD2: changes, change back, no change, disappearance; intervals; as-of keys."""
import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators import scd
from tidemark.operators.star import build_fact

SRC = "customer_id string, customer_city string, customer_state string, customer_zip_code_prefix string"
RUNS = ["2020-01-01 00:00:00", "2020-02-01 00:00:00", "2020-03-01 00:00:00"]


def dims(spark, snaps, **kw):
    srcs = [scd.customer_source(spark.createDataFrame(s, SRC)) for s in snaps]
    return scd.scd2_runs(spark, srcs, RUNS[:len(snaps)], checkpoint=False, **kw)


def history(dim, cid):
    return [(r["customer_city"], str(r["valid_from"])[:10], str(r["valid_to"])[:10] if r["valid_to"] else None,
             r["is_current"]) for r in dim.where(F.col("customer_id") == cid).orderBy("valid_from").collect()]


SNAPS = [
    [("1", "a", "ON", "1"), ("2", "a", "ON", "1"), ("3", "a", "ON", "1"), ("4", "a", "ON", "1")],
    [("1", "b", "ON", "1"), ("2", "a", "ON", "1"), ("3", "b", "ON", "1")],           # 4 disappears
    [("1", "a", "ON", "1"), ("2", "a", "ON", "1"), ("3", "b", "ON", "1"), ("5", "n", "ON", "1")],
]


def test_versions(spark):
    d = dims(spark, SNAPS)[-1]
    assert history(d, "1") == [("a", "2020-01-01", "2020-02-01", False), ("b", "2020-02-01", "2020-03-01", False),
                               ("a", "2020-03-01", None, True)]
    assert history(d, "2") == [("a", "2020-01-01", None, True)]
    assert history(d, "4") == [("a", "2020-01-01", None, True)]          # deletes keep the version
    assert history(d, "5") == [("n", "2020-03-01", None, True)]


def test_on_source_delete_options(spark):
    closed = dims(spark, SNAPS[:2], on_source_delete="close")[-1]
    assert history(closed, "4") == [("a", "2020-01-01", "2020-02-01", False)]
    deleted = dims(spark, SNAPS[:2], on_source_delete="delete")[-1]
    assert history(deleted, "4") == []


def test_interval_properties(spark):
    d = dims(spark, SNAPS)[-1]
    assert d.groupBy("customer_id").agg(F.count_if("is_current").alias("c")).where("c > 1").count() == 0
    w = Window.partitionBy("customer_id").orderBy("valid_from")
    gaps = d.withColumn("nxt", F.lead("valid_from").over(w)).where(
        F.col("nxt").isNotNull() & ~F.col("valid_to").eqNullSafe(F.col("nxt")))
    assert gaps.count() == 0
    assert d.select("customer_key").distinct().count() == d.count()


def test_rerun_same_snapshot_changes_nothing(spark):
    ds = dims(spark, [SNAPS[0], SNAPS[0]])
    assert ds[0].count() == ds[1].count()


def test_as_of_and_current_keys(spark):
    d = dims(spark, SNAPS)[-1]
    items = spark.createDataFrame([("o1", 1, "p", "s", 10.0, 1.0), ("o2", 1, "p", "s", 10.0, 1.0),
                                   ("o3", 1, "p", "s", 10.0, 1.0), ("o4", 1, "p", "s", 10.0, 1.0)],
                                  "order_id string, order_item_id int, product_id string, seller_id string, "
                                  "price double, freight_value double")
    t = dt.datetime
    orders = spark.createDataFrame([
        ("o1", "1", "delivered", t(2019, 6, 1), None, t(2019, 6, 10)),     # before the first version
        ("o2", "1", "delivered", t(2020, 2, 1), None, t(2020, 2, 10)),     # on a boundary
        ("o3", "1", "delivered", t(2020, 2, 15), None, t(2020, 2, 20)),
        ("o4", "1", "delivered", t(2021, 1, 1), None, t(2021, 1, 10)),     # after the last
    ], "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
       "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp")
    keys = {r["customer_key"]: r["valid_from"] for r in d.collect()}
    as_of = {r["order_id"]: str(keys[r["customer_key"]])[:10]
             for r in build_fact(items, orders, d, "2022-01-01", "as_of").collect()}
    assert as_of == {"o1": "2020-01-01", "o2": "2020-02-01", "o3": "2020-02-01", "o4": "2020-03-01"}
    cur = {str(keys[r["customer_key"]])[:10] for r in build_fact(items, orders, d, "2022-01-01", "current").collect()}
    assert cur == {"2020-03-01"}


def test_as_of_plan_is_not_a_nested_loop(spark):
    d = dims(spark, SNAPS)[-1]
    f = spark.createDataFrame([("1", dt.datetime(2020, 1, 5))], "customer_id string, order_ts timestamp")
    plan = scd.join_as_of(f, d, "order_ts")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_partial_source_equals_full_snapshot(spark):
    import pytest
    full = dims(spark, SNAPS)[-1]
    srcs = [scd.customer_source(spark.createDataFrame(s, SRC)) for s in SNAPS]
    d = scd.scd2_apply(scd.empty_dim(spark), srcs[0], RUNS[0])
    touched = [["1", "3"], ["1", "5"]]        # keys each later batch touched (4 was deleted: untouched)
    for k, keys in enumerate(touched, start=1):
        part = srcs[k].where(F.col("customer_id").isin(*keys))
        for bk in (True, False):
            alt = scd.scd2_apply(d, part, RUNS[k], src_is_complete=False, broadcast_keys=bk)
            assert alt.count() == scd.scd2_apply(d, srcs[k], RUNS[k]).count()
        d = scd.scd2_apply(d, part, RUNS[k], src_is_complete=False, broadcast_keys=True)
    assert sorted(map(tuple, d.collect())) == sorted(map(tuple, full.collect()))
    with pytest.raises(ValueError):
        scd.scd2_apply(d, srcs[0], RUNS[0], src_is_complete=False, on_source_delete="close")
