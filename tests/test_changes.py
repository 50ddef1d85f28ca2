"""Change application: T4, T5, T5b, T5c, idempotency, C4-C6."""
import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import changes as C

SCHEMA = "customer_id string, customer_city string, customer_state string, Op string, dms_ts timestamp"
PK = ["customer_id"]


def ts(h):
    return dt.datetime(2024, 1, 1, h)


def rows(df, cols=("customer_id", "customer_city")):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_latest_ties_and_null_ts(spark):
    df = spark.createDataFrame([
        ("1", "a", "SP", "U", ts(1)), ("1", "b", "SP", "D", ts(1)),      # same time: D wins
        ("2", "a", "SP", "U", None), ("2", "b", "SP", "U", ts(0)),       # NULL time loses
    ], SCHEMA)
    latest = {r["customer_id"]: r for r in C.prepare(df, PK).collect()}
    assert latest["1"]["Op"] == "D"
    assert latest["2"]["customer_city"] == "b"


def test_merge_semantics_null_op_insert_on_existing_delete_missing(spark):
    target = C.initial_load(C.prepare(spark.createDataFrame([
        ("1", "a", "SP", "I", ts(0)), ("2", "a", "SP", "I", ts(0))], SCHEMA), PK))
    batch = spark.createDataFrame([
        ("1", "x", "SP", None, ts(1)),   # NULL Op, matched -> update
        ("3", "x", "SP", None, ts(1)),   # NULL Op, unmatched -> not inserted
        ("2", "y", "SP", "I", ts(1)),    # I on an existing key -> update
        ("9", "z", "SP", "D", ts(1)),    # D on a missing key -> nothing
    ], SCHEMA)
    plan = C.merge_plan(target, C.prepare(batch, PK), PK)
    out = C.apply_changes(target, C.prepare(batch, PK), PK)
    assert rows(out) == [("1", "x"), ("2", "y")]
    counts = C.applied_counts(plan, "customers").first()
    assert (counts["inserted"], counts["updated"], counts["deleted"], counts["ignored"], counts["latest_rows"]) == (0, 2, 0, 2, 4)


def test_late_batch_parity_and_ignore_stale(spark):
    target = C.initial_load(C.prepare(spark.createDataFrame([("1", "new", "SP", "I", ts(5))], SCHEMA), PK))
    late = C.prepare(spark.createDataFrame([("1", "old", "SP", "U", ts(1))], SCHEMA), PK)
    assert rows(C.apply_changes(target, late, PK)) == [("1", "old")]          # parity: no guard
    assert rows(C.apply_changes(target, late, PK, ignore_stale=True)) == [("1", "new")]


def test_blank_keys_are_quarantined_not_inserted(spark):
    batch = spark.createDataFrame([("", "a", "SP", "I", ts(1)), ("  ", "b", "SP", "I", ts(1)),
                                   ("1", "c", " ", "I", ts(1))], SCHEMA)
    latest = C.prepare(batch, PK)
    assert rows(latest) == [("1", "c")]
    assert latest.first()["customer_state"] == "ON"        # blank -> NULL -> default province
    assert C.quarantined_keys(batch, PK).count() == 2


def test_province_map_and_kept_spaces(spark):
    batch = spark.createDataFrame([("1", " a ", "RJ", "I", ts(1)), ("2", "b", "ZZ", "I", ts(1)),
                                   ("3", "c", None, "I", ts(1))], SCHEMA)
    got = {r["customer_id"]: (r["customer_city"], r["customer_state"]) for r in C.prepare(batch, PK).collect()}
    assert got == {"1": (" a ", "QC"), "2": ("b", "ON"), "3": ("c", "ON")}


def test_same_batch_twice_is_idempotent(spark):
    base = C.initial_load(C.prepare(spark.createDataFrame([("1", "a", "SP", "I", ts(0)),
                                                            ("2", "a", "SP", "I", ts(0))], SCHEMA), PK))
    b = C.prepare(spark.createDataFrame([("1", "x", "SP", "U", ts(1)), ("2", None, None, "D", ts(1)),
                                         ("3", "n", "SP", "I", ts(1))], SCHEMA), PK)
    once = C.apply_changes(base, b, PK)
    twice = C.apply_changes(once, b, PK)
    assert rows(once) == rows(twice) == [("1", "x"), ("3", "n")]


def test_replay_matches_closed_form(spark):
    """State after n batches = last change of the last batch touching a key."""
    batches = [
        [("1", "a", "SP", "I", ts(0)), ("2", "a", "SP", "I", ts(0))],
        [("1", "b", "SP", "U", ts(1)), ("1", "c", "SP", "U", ts(2)), ("2", None, None, "D", ts(1))],
        [("2", "d", "SP", "U", ts(3)), ("3", "e", "SP", "I", ts(3))],
    ]
    states = C.replay(None, [spark.createDataFrame(b, SCHEMA) for b in batches], PK, checkpoint=False)
    assert rows(states[0]) == [("1", "a"), ("2", "a")]
    assert rows(states[1]) == [("1", "c")]
    assert rows(states[2]) == [("1", "c"), ("2", "d"), ("3", "e")]    # update after delete revives


def test_update_delete_upsert(spark):
    df = spark.createDataFrame([("1", "a", 1), ("2", "b", 2), ("3", "c", 3)], "k string, v string, n int")
    keys = spark.createDataFrame([("1",), ("1",), ("3",)], "k string")
    up = C.update_where(df, keys, ["k"], {"v": F.lit("z")})
    assert sorted(map(tuple, up.collect())) == [("1", "z", 1), ("2", "b", 2), ("3", "z", 3)]
    assert sorted(r["k"] for r in C.delete_keys(df, keys, ["k"]).collect()) == ["2"]
    src = spark.createDataFrame([("2", "B", 20), ("4", "d", 4)], "k string, v string, n int")
    merged = C.upsert(df, src, ["k"])
    assert merged.count() == merged.select("k").distinct().count() == 4
    assert {r["k"]: r["v"] for r in merged.collect()}["2"] == "B"


def test_upsert_rewrites_only_touched_partitions_and_moves_rows(spark, tmp_dir):
    import os

    from tidemark.sources.tables import upsert_partitions
    path = tmp_dir + "/fact"
    df = spark.createDataFrame([("1", 1, "a", "2024-01"), ("2", 1, "b", "2024-01"), ("3", 1, "c", "2024-02"),
                                ("4", 1, "d", "2024-03")], "order_id string, order_item_id int, v string, order_month string")
    df.write.partitionBy("order_month").parquet(path)
    untouched = sorted(os.listdir(path + "/order_month=2024-02"))
    src = spark.createDataFrame([("1", 1, "A", "2024-03"), ("4", 1, "D", "2024-04"), ("5", 1, "e", "2024-01")],
                                "order_id string, order_item_id int, v string, order_month string")
    touched = sorted(r[0] for r in upsert_partitions(spark, path, src, ["order_id", "order_item_id"],
                                                     "order_month").collect())
    assert touched == ["2024-01", "2024-03", "2024-04"]
    got = sorted((r["order_id"], r["v"], r["order_month"]) for r in spark.read.parquet(path).collect())
    assert got == [("1", "A", "2024-03"), ("2", "b", "2024-01"), ("3", "c", "2024-02"), ("4", "D", "2024-04"),
                   ("5", "e", "2024-01")]
    assert sorted(os.listdir(path + "/order_month=2024-02")) == untouched   # not rewritten


def test_seed_csv_and_csv_table(spark, tmp_dir):
    from tidemark.sources.files import read_csv_table, read_seed_csv, write_csv
    p = tmp_dir + "/items.csv"
    with open(p, "w") as fh:
        fh.write('order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n'
                 '"o1",1,"p\nx",s,2024-01-01 10:00:00,10.50,\n')
    df = read_seed_csv(spark, p, "order_items")
    r = df.first()
    assert (r["product_id"], str(r["price"]), r["freight_value"]) == ("p\nx", "10.50", None)
    write_csv(df, tmp_dir + "/out")
    back = read_csv_table(spark, tmp_dir + "/out", df.schema)
    assert back.count() == 1 and back.first()["product_id"] == "p\nx"


def test_broadcast_and_shuffle_paths_agree(spark):
    base = C.initial_load(C.prepare(spark.createDataFrame(
        [(str(i), "a", "SP", "I", ts(0)) for i in range(50)], SCHEMA), PK))
    b = C.prepare(spark.createDataFrame([("1", "x", "SP", "U", ts(1)), ("2", None, None, "D", ts(1)),
                                         ("77", "n", "SP", "I", ts(1)), ("3", "y", "SP", None, ts(1))], SCHEMA), PK)
    small = C.apply_changes(base, b, PK, broadcast_keys=True)
    big = C.apply_changes(base, b, PK, broadcast_keys=False)
    assert rows(small) == rows(big) and len(rows(small)) == 50
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_partition_merge_keeps_the_null_partition(spark, tmp_dir):
    """Rows that no change names stay, in the NULL partition and in one whose
    name needs escaping; a partition left empty goes."""
    from tidemark.sources.tables import merge_into_partitions
    rows = [(1, "a/b", "x"), (2, "a/b", "x"), (3, None, "x"), (4, None, "x"), (5, "gone=1", "x")]
    spark.createDataFrame(rows, "id int, part string, v string").write.partitionBy("part").parquet(tmp_dir + "/t")
    latest = spark.createDataFrame([(3, None, "new", "U"), (1, None, "moved", "U"), (5, "gone=1", "x", "D")],
                                   "id int, part string, v string, Op string")
    merge_into_partitions(spark, tmp_dir + "/t", latest, ["id"], "part")
    got = sorted((r.id, r.part, r.v) for r in spark.read.parquet(tmp_dir + "/t").collect())
    assert got == [(1, None, "moved"), (2, "a/b", "x"), (3, None, "new"), (4, None, "x")]


def test_blank_keys_are_rejected_and_stale_changes_ignored_alike(spark, tmp_dir):
    from tidemark.sources.tables import VersionedTable
    from tidemark.streaming import changes as ST
    load = spark.sql("SELECT * FROM VALUES ('1', 'new', 'I', timestamp'2024-02-01'), (' ', 'none', 'I', timestamp'2024-02-01') "
                     "AS t(customer_id, customer_city, Op, dms_ts)")
    old = spark.sql("SELECT '1' AS customer_id, 'old' AS customer_city, 'U' AS Op, timestamp'2024-01-01' AS dms_ts")
    table = VersionedTable(spark, tmp_dir + "/versioned")
    for k, batch in enumerate((load, old)):
        ST.merge_batch(table, batch, ["customer_id"], k, ignore_stale=True)
        ST.merge_batch_bucketed(spark, tmp_dir + "/bucketed", batch, ["customer_id"], k, 4, ignore_stale=True)
    for df in (table.read(), spark.read.parquet(tmp_dir + "/bucketed")):
        assert [(r.customer_id, r.customer_city) for r in df.collect()] == [("1", "new")]
    for path in (table.path, tmp_dir + "/bucketed"):
        assert [r.customer_city for r in ST.rejects(spark, path).collect()] == ["none"]
