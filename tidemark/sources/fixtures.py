"""Adapters from the driver's TPC-H-like tables to the order-platform schemas.

Each adapter is a projection (plus one de-duplicating aggregate for order
lines); nothing is collected.  The same mappings are written as DuckDB SQL in
``oracle_sql.py`` so that every query can be checked by an independent engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleanse import STATE_TO_PROVINCE
from tidemark.functions.exprs import to_ts
from tidemark.operators.relational import pick_max

# Batch boundaries of the customer change feed, the replayed
# run times of the pipeline (one per load: full load, batch 1, 2, 3) and the
# "now" used for at-risk orders in the tests.
BATCH_SPLITS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
FULL_LOAD_TS = "2024-01-01 00:00:00"
RUN_TS = ("1996-01-01 00:00:00", "1997-07-01 00:00:00", "1999-01-01 00:00:00", "2000-07-01 00:00:00")
AS_OF_TS = "2001-06-01 00:00:00"

SOURCE_CODES = list(STATE_TO_PROVINCE)  # SP, RJ, ... in table order


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code_by_index(idx: Column, extra: list[str] | None = None) -> Column:
    codes = SOURCE_CODES + (extra or [])
    return F.element_at(F.array(*[F.lit(c) for c in codes]), (idx + 1).cast("int"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    purchase = to_ts("o_orderdate")
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderstatus") == "P",
              F.when(key % 10 == 0, "canceled").when(key % 10 == 1, "unavailable").otherwise("processing"))
    )
    return o.select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        purchase.alias("order_approved_at"),
        F.lit(None).cast("timestamp").alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "F",
               F.timestamp_add("DAY", (key % 40).cast("int"), purchase)).alias("order_delivered_customer_date"),
        F.timestamp_add("DAY", (key % 20 + 10).cast("int"), purchase).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines keyed by (order_id, order_item_id).

    The source is not unique on that key: keep the line with the latest ship
    date, ties broken by part, supplier, price, quantity (ascending).  Few lines
    share a key, so combining before the shuffle would sort them all to little
    effect: they go to their order's partition as they are, and the order joins
    them there without another shuffle."""
    li = read_table(spark, sf_dir, "lineitem")
    lines = li.select(F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linenumber").cast("int").alias("order_item_id"),
                      "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", to_ts("l_shipdate").alias("l_shipdate"))
    chosen = pick_max(
        lines.repartition("order_id"),
        keys=["order_id", "order_item_id"],
        order=[F.col("l_shipdate"), -F.col("l_partkey"), -F.col("l_suppkey"),
               -F.col("l_extendedprice"), -F.col("l_quantity")],
    )
    return chosen.select(
        "order_id", "order_item_id",
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        (F.col("l_quantity") * F.lit(0.25)).cast("decimal(10,2)").alias("freight_value"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source customers with region *codes* (mapped to provinces on cleanse)."""
    c = read_table(spark, sf_dir, "customer")
    nk = F.col("c_nationkey")
    state = F.when(nk < 12, _code_by_index(nk)).otherwise(nk.cast("string"))
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        nk.cast("string").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        state.alias("customer_state"),
    )


def customer_full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The initial full-load change file: every customer as an insert."""
    return customers(spark, sf_dir).select(
        "*", F.lit("I").alias("Op"), F.lit(FULL_LOAD_TS).cast("timestamp").alias("dms_ts"))


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed derived from ``events`` with a ``batch`` column (1, 2, 3)."""
    e = read_table(spark, sf_dir, "events")
    ts = to_ts("ts")
    v = F.floor("value")
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    batch = F.when(ts < F.lit(BATCH_SPLITS[0]).cast("timestamp"), 1).when(
        ts < F.lit(BATCH_SPLITS[1]).cast("timestamp"), 2).otherwise(3)
    return e.select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("customer_unique_id"),
        (F.col("user_id") % 25).cast("string").alias("customer_zip_code_prefix"),
        F.concat(F.lit("city"), (v % 3).cast("string")).alias("customer_city"),
        _code_by_index(v % 13, [" "]).alias("customer_state"),
        op.alias("Op"),
        ts.alias("dms_ts"),
        batch.alias("batch"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("product_category_name"),
        (size * 100).cast("int").alias("product_weight_g"),
        size.cast("int").alias("product_length_cm"),
        (size + 1).cast("int").alias("product_height_cm"),
        (size + 2).cast("int").alias("product_width_cm"),
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return (p.where(F.col("p_type") != "LARGE").select("p_type").distinct()
            .select(F.col("p_type").alias("product_category_name"),
                    F.lower("p_type").alias("product_category_name_english")))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the landed JSON shape, plus the landing path columns."""
    e = read_table(spark, sf_dir, "events")
    ts = to_ts("ts")
    etype = (F.when(F.col("event_type") == "view", "page_view")
             .when(F.col("event_type") == "purchase", "pos_sale").otherwise("inventory_move"))
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        etype.alias("event_type"),
        F.concat(F.lit("store-"), (F.col("user_id") % 20).cast("string")).alias("store_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        (F.col("event_id") % 5 + 1).cast("int").alias("quantity"),
        F.col("value").cast("double").alias("amount"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"),
        F.date_format(F.timestamp_add("SECOND", F.lit(2), ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingest_time"),
        (F.col("event_id") % 10 == 0).alias("late"),
        F.date_format(ts, "yyyy").alias("y"),
        F.date_format(ts, "MM").alias("m"),
        F.date_format(ts, "dd").alias("d"),
        F.date_format(ts, "HH").alias("h"),
    )
