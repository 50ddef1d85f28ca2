"""Work that must not be done twice: shuffles of order lines, inputs of several writes,
parts of the star that a query doesn't use."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark import registry
from tidemark.operators import star as S
from tidemark.plans import curated as CU
from tidemark.sources import fixtures as X
from tidemark.sources.formats import format_sizes
from tidemark.sources.tables import merge_into_partitions


def counted(spark, df):
    """``df`` with a column ``seen`` that counts every row computed."""
    n = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(x):
        n.add(1)
        return 0

    return df.withColumn("seen", seen.asNondeterministic()(F.lit(0))), n


def test_order_lines_are_shuffled_once(spark):
    """lines meet their order in the partition where they were told apart."""
    lines = S.fact_lines(X.order_items(spark, SMALL), X.orders(spark, SMALL).hint("merge"), X.AS_OF_TS)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_order_items_keep_the_latest_of_repeated_and_null_keys(spark, tmp_dir):
    rows = [(1, 1, 5, 7, 10.0, 1.0, "1996-01-01 00:00:00"), (1, 1, 4, 7, 10.0, 1.0, "1996-01-02 00:00:00"),
            (1, 1, 9, 7, 10.0, 1.0, "1996-01-02 00:00:00"), (1, 2, 9, 7, 10.0, 1.0, None),
            (None, 1, 3, 7, 10.0, 1.0, "1996-01-01 00:00:00"), (None, 1, 2, 7, 10.0, 1.0, "1996-01-01 00:00:00")]
    (spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, "
                           "l_quantity double, ship string").withColumn("l_shipdate", F.col("ship").cast("timestamp_ntz"))
     .write.parquet(f"{tmp_dir}/lineitem.parquet"))
    got = {(r["order_id"], r["order_item_id"]): r["product_id"] for r in X.order_items(spark, tmp_dir).collect()}
    assert got == {("1", 1): "4", ("1", 2): "9", (None, 1): "2"}


def test_formats_compute_their_input_once(spark, tmp_dir):
    df, n = counted(spark, spark.range(100))
    format_sizes(df, f"{tmp_dir}/f")
    assert n.value == 100


def test_partition_merge_computes_the_changes_once(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.range(20).selectExpr("id as k", "0 as seen", "id % 4 as part").write.partitionBy("part").parquet(path)
    df, n = counted(spark, spark.range(5, 8).selectExpr("id as k", "'U' as Op", "2L as part"))
    merge_into_partitions(spark, path, df, ["k"], "part")
    assert n.value == 3
    moved = {r["k"]: r["part"] for r in spark.read.parquet(path).collect()}
    assert moved == {k: 2 if k in (5, 6, 7) else k % 4 for k in range(20)}


@pytest.mark.parametrize("name", ["cdc_applied_counts", "cdc_stream_bucketed"])
def test_customer_feed_does_not_wait_for_the_dimension(spark, name, monkeypatch):
    def unasked(*_):
        raise AssertionError("dimension runs")

    monkeypatch.setattr(CU, "_MEMO", {})
    monkeypatch.setattr(CU, "incremental_scd2", unasked)
    assert registry.QUERIES[name](spark, SMALL).count() > 0


def test_batches_land_in_one_file_from_many_tasks(spark, monkeypatch):
    """F8: one file a trigger, without one task for the whole scan."""
    def narrowed(self, n):
        raise AssertionError("the scan runs in one task")

    monkeypatch.setattr(type(spark.range(1)), "coalesce", narrowed)
    assert registry.streamed_batches(spark, SMALL, buckets=8).count() > 0


def test_late_lines_come_from_the_landed_ones(spark, tmp_dir, monkeypatch):
    """lines are told apart once; late ones are the landed first lines, dearer by one."""
    from tidemark import registry_jobs as RJ
    RJ.land_everything(spark, SMALL, tmp_dir)
    landed = spark.read.parquet(f"{tmp_dir}/order_items").collect()
    monkeypatch.setattr(X, "order_items", None)
    RJ.land_late_changes(spark, SMALL, tmp_dir)
    late = spark.read.parquet(f"{tmp_dir}/order_items").where("Op = 'U'").collect()
    want = {(r["order_id"], r["price"] + 1, r["product_id"]) for r in landed if int(r["order_id"]) % 50 == 3 and r["order_item_id"] == 1}
    assert want and {(r["order_id"], r["price"], r["product_id"]) for r in late} == want and len(late) == len(want)


def shuffle_files(spark):
    """Shuffle files that the session holds on its disk now."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.length()))
    return {n for n in names if n.startswith("shuffle_")}


def scratch(spark):
    from tidemark.session import local_path, work_dir
    top = local_path(work_dir(spark) + "/tidemark")
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_daily_runs_give_their_disk_back(spark, tmp_dir, monkeypatch):
    """neither shuffles nor scratch tables nor old versions outlive the step that
    needs them, and slices of the orders give the same fact."""
    from tidemark import registry_jobs as RJ
    from tidemark.plans import jobs as J
    before, there = shuffle_files(spark), scratch(spark)
    facts = []
    for name, size in (("whole", J.SLICE_BYTES), ("sliced", 1)):
        monkeypatch.setattr(J, "SLICE_BYTES", size)
        cleansed, curated = RJ.incremental_runs(spark, SMALL, f"{tmp_dir}/{name}")
        assert [len([v for v in os.listdir(f"{cleansed}/{t}") if v.startswith("v")]) for t in ("orders", "order_items")] == [1, 1]
        facts.append(J.read_curated(spark, curated)["fact_order_item"])
    for _ in range(100):  # files are removed in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert not {p for p in scratch(spark) - there if p.startswith(("fact-lines", "fact-months", "affected"))}
    whole, sliced = ({tuple(r) for r in f.collect()} for f in facts)
    assert whole and whole == sliced and facts[1].count() == len(sliced)


def test_a_daily_step_shuffles_a_slice_at_a_time(spark, tmp_dir, monkeypatch):
    """all months in slices of their files, null and emptied ones too; keys that move
    to another month and null keys are merged as in one piece."""
    from tidemark.plans import jobs as J
    monkeypatch.setattr(J, "SLICE_BYTES", 1)
    rows = [(f"o{k}" if k else None, k % 3, f"1990-{k % 5 + 1:02d}-05 00:00:00" if k % 7 else None) for k in range(60)]
    schema = "order_id string, order_item_id int, ts string"
    fact = lambda rows: spark.createDataFrame(rows, schema).select(
        "order_id", "order_item_id", F.col("ts").cast("timestamp").alias("order_ts"))
    old, new = fact(rows), fact([(o, i, "1991-01-01 00:00:00") for o, i, ts in rows if ts and ts[:7] in ("1990-01", "1990-02")] + [(None, 9, None), ("x", 1, None)])
    got = {}
    for n in (1, 5):
        base = f"{tmp_dir}/{n}"
        J.write_fact(J.S.with_order_month(old), base)
        patch = J.stage_months(spark, base, *[J.order_slice(new, k, n) for k in range(n)])
        assert set(patch.months) == {"1990-01", "1990-02", "1991-01", None}
        cut = patch.month_slices(spark)
        assert len(cut) > 1 and sorted(map(str, sum(cut, []))) == sorted(map(str, patch.months))
        for _ in range(2):  # a publication that failed half-way is run again
            patch.apply(spark)
            got[n] = sorted(map(str, spark.read.parquet(base).collect()))
    assert got[1] == got[5] and len(got[1]) == 62
