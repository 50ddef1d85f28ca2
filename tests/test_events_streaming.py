"""Partition techniques (S10-S15) and streaming change application (ST1)."""
import os

from pyspark.sql import functions as F

from tidemark.operators import changes as C
from tidemark.sources import events as EV
from tidemark.sources import fixtures as X
from tidemark.sources.tables import VersionedTable
from tidemark.streaming import changes as ST

from paths import SMALL

HOUR = {"event_type": "pos_sale", "y": "2024", "m": "01", "d": "05", "h": "13"}
ENUMS = {"event_type": ["pos_sale", "page_view", "inventory_move"]}
RANGES = {"y": (2024, 2025, 4), "m": (1, 12, 2), "d": (1, 31, 2), "h": (0, 23, 2)}


def landed(spark, tmp_dir):
    root = tmp_dir + "/raw"
    EV.land_events(X.raw_events(spark, SMALL), root).collect()
    return root


def test_partition_techniques(spark, tmp_dir):
    root = landed(spark, tmp_dir)
    flat = EV.read_events_flat(spark, root)
    total = flat.count()
    assert total == X.read_table(spark, SMALL, "events").count()
    paths = EV.read_events_paths(spark, root)
    first = paths.where(F.col("event_type") == "pos_sale").orderBy("event_id").first()
    HOUR = {k: first[k] for k in EV.PART_COLS}
    hour = paths
    for k, v in HOUR.items():
        hour = hour.where(F.col(k) == v)
    n_hour = hour.count()
    EV.create_events_table(spark, "ev_test", root)
    assert spark.table("ev_test").count() == 0                      # nothing registered: 0 rows, no error
    EV.repair_partitions(spark, "ev_test")
    assert spark.table("ev_test").count() == 0                      # repair finds no key=value folders
    EV.add_partitions(spark, "ev_test", [HOUR], root)
    assert spark.table("ev_test").count() == n_hour
    proj = EV.read_projected(spark, root, ENUMS, RANGES, HOUR)
    assert proj.count() == n_hour
    files = {os.path.normpath(os.path.dirname(f.replace("file:", ""))).replace("//", "/") for f in proj.inputFiles()}
    assert n_hour > 0 and files == {os.path.join(root, EV.render(EV.PATH_TEMPLATE, HOUR))}   # only the wanted folder is read
    future = EV.read_projected(spark, root, ENUMS, {**RANGES, "y": (2026, 2027, 4)}, {"y": "2026"})
    assert future.count() == 0                                       # outside the ranges: invisible


def test_optimized_copy(spark, tmp_dir):
    root = landed(spark, tmp_dir)
    out = EV.optimize_events(EV.read_events_flat(spark, root), tmp_dir + "/opt")
    assert out.where(F.col("event_ts").isNull()).count() == 0
    assert sorted(d for d in os.listdir(tmp_dir + "/opt") if d.startswith("event_type=")) == ["event_type=inventory_move", "event_type=page_view",
                                                        "event_type=pos_sale"]


def test_stream_equals_batch_and_replays_are_harmless(spark, tmp_dir):
    from tidemark.plans.curated import change_batches
    batches = change_batches(spark, SMALL)
    src = tmp_dir + "/cdc"
    pk = C.TABLE_KEYS["customers"]
    for b in batches:
        b.write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    table = VersionedTable(spark, tmp_dir + "/customers")
    ST.apply_stream(spark, src, schema, table, pk, tmp_dir + "/ckpt", max_files_per_trigger=1)
    expected = C.replay(None, batches, pk, checkpoint=False)[-1]
    got = table.read()
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    n_versions = len(table.versions())
    assert n_versions > 1                                            # several micro-batches
    ST.apply_stream(spark, src, schema, table, pk, tmp_dir + "/ckpt")  # second run: nothing new
    assert len(table.versions()) == n_versions
    late = spark.createDataFrame([("0", "Customer#000000000", "9", "cityX", "SP", "U",
                                   __import__("datetime").datetime(2024, 2, 1))], schema)
    late.write.mode("append").parquet(src)                              # third run: only the new file
    ST.apply_stream(spark, src, schema, table, pk, tmp_dir + "/ckpt")
    assert len(table.versions()) == n_versions + 1
    assert table.read().where("customer_id = '0'").first()["customer_city"] == "cityX"
    assert ST.merge_batch(table, batches[1], pk, batch_id=0) is False  # replayed batch id: no-op


def test_bucketed_stream_rewrites_only_touched_buckets(spark, tmp_dir):
    from tidemark.plans.curated import change_batches
    batches = change_batches(spark, SMALL)
    src = tmp_dir + "/cdc"
    pk = C.TABLE_KEYS["customers"]
    for b in batches:
        b.write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    path = tmp_dir + "/customers_b"
    ST.apply_stream(spark, src, schema, path, pk, tmp_dir + "/ckpt", max_files_per_trigger=1, buckets=16)
    expected = C.replay(None, batches, pk, checkpoint=False)[-1]
    got = spark.read.parquet(path).drop("_bucket")
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    assert ST.merge_batch_bucketed(spark, path, batches[1], pk, 0, 16) is False     # replay: no-op
