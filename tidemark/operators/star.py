"""Star-schema builders: product (SCD1), calendar, order-line fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import calendar_days, to_ts
from tidemark.operators.relational import dedupe, maybe_broadcast
from tidemark.operators.scd import join_as_of, join_current

FACT_COLUMNS = [
    "order_id", "order_item_id", "customer_key", "customer_id", "product_id", "seller_id",
    "order_status", "order_ts", "delivered_ts", "estimated_delivery", "price", "freight_value",
    "line_total", "delivery_days", "is_late", "at_risk",
]
# Statuses that can never be at risk of late delivery.
CLOSED_STATUSES = ("canceled", "unavailable")


def build_dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Translated category, else the original, else 'unknown'; volume in a
    64-bit integer (three 32-bit factors overflow)."""
    t = maybe_broadcast(translation.select(
        F.col("product_category_name").alias("_t_name"), "product_category_name_english"))
    p = products.join(t, F.col("product_category_name") == F.col("_t_name"), "left")
    out = p.select(
        F.col("product_id"),
        F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown")).alias("category"),
        F.col("product_weight_g").cast("int").alias("weight_g"),
        (F.col("product_length_cm").cast("long") * F.col("product_height_cm").cast("long")
         * F.col("product_width_cm").cast("long")).alias("volume_cm3"),
    )
    return dedupe(out, ["product_id"])


def build_dim_date(orders: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Calendar over the order history.  The bounds stay a DataFrame (no
    driver round trip); no orders gives an empty calendar."""
    bounds = orders.agg(F.min(F.to_date(ts)).alias("d0"), F.max(F.to_date(ts)).alias("d1"))
    days = bounds.select(F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("date_key"))
    d = F.col("date_key")
    return days.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    )


def order_header(orders: DataFrame) -> DataFrame:
    """The order columns the fact needs, with zone-less times made UTC."""
    return orders.select(
        "order_id", "customer_id", "order_status",
        to_ts("order_purchase_timestamp").alias("order_ts"),
        to_ts("order_delivered_customer_date").alias("delivered_ts"),
        to_ts("order_estimated_delivery_date").alias("estimated_delivery"),
    )


def at_risk(as_of: str) -> Column:
    """Undelivered, not closed, and promised before ``as_of``; over an order's or a
    fact line's columns."""
    return (F.col("delivered_ts").isNull() & ~F.col("order_status").isin(*CLOSED_STATUSES)
            & (F.col("estimated_delivery") < F.lit(as_of).cast("timestamp")))


def _lines(items: DataFrame, header: DataFrame, as_of: str) -> DataFrame:
    extra = [c for c in header.columns if c == "customer_key"]
    j = items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value") \
        .join(header, "order_id")
    delivered, promised = F.col("delivered_ts"), F.col("estimated_delivery")
    return j.select(
        "order_id", F.col("order_item_id").cast("int").alias("order_item_id"), *extra, "customer_id",
        "product_id", "seller_id", "order_status", "order_ts", "delivered_ts", "estimated_delivery",
        F.col("price").cast("decimal(10,2)").alias("price"),
        F.col("freight_value").cast("decimal(10,2)").alias("freight_value"),
        (F.col("price") + F.col("freight_value")).cast("decimal(10,2)").alias("line_total"),
        calendar_days(delivered, "order_ts").alias("delivery_days"),
        (delivered.isNotNull() & (delivered > promised)).alias("is_late"),
        at_risk(as_of).alias("at_risk"),
    )


def fact_lines(items: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """Order lines joined to their order (inner: lines without an order vanish)
    with the derived measures.  ``as_of`` is the run's "now" for ``at_risk``."""
    return _lines(items, order_header(orders), as_of)


def build_fact(items: DataFrame, orders: DataFrame, dim_customer: DataFrame, as_of: str,
               key_mode: str = "as_of") -> DataFrame:
    """Order-line fact with the customer surrogate key.

    ``key_mode="as_of"``: the version valid at order time (the documented
    meaning); ``"current"``: the current version (what a plain current join
    gives, so history moves on every run).  The key depends only on the
    order, so orders are keyed first and the lines join them afterwards:
    the customer-keyed shuffle carries orders, not order lines."""
    header = order_header(orders)
    if key_mode == "as_of":
        keyed = join_as_of(header, dim_customer, "order_ts")
    elif key_mode == "current":
        keyed = join_current(header, dim_customer)
    else:
        raise ValueError(f"key_mode must be 'as_of' or 'current', not {key_mode!r}")
    return _lines(items, keyed, as_of).select(*FACT_COLUMNS)


def with_order_month(fact: DataFrame) -> DataFrame:
    """Explicit month partition column (Parquet has no hidden partitioning)."""
    return fact.withColumn("order_month", F.date_format("order_ts", "yyyy-MM"))


# ---- the star's joins, by name (J3, J7-J10, J15) ------------------------------
def join_translation(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name, if any (J3, left join)."""
    t = maybe_broadcast(translation.select(F.col("product_category_name").alias("_t_name"),
                                           "product_category_name_english"))
    return products.join(t, F.col("product_category_name") == F.col("_t_name"), "left").drop("_t_name")


def with_customer(fact: DataFrame, dim: DataFrame, cols: tuple[str, ...] = ("province",)) -> DataFrame:
    """Fact rows with attributes of the referenced version (J8, inner on the surrogate key)."""
    return fact.join(dim.select("customer_key", *cols), "customer_key")


def with_current_customer(fact: DataFrame, dim: DataFrame, cols: tuple[str, ...] = ("province",)) -> DataFrame:
    """Fact rows with attributes of the customer's current version."""
    return fact.join(dim.where(F.col("is_current")).select("customer_id", *cols), "customer_id")


def with_product(fact: DataFrame, product: DataFrame, cols: tuple[str, ...] = ("category",)) -> DataFrame:
    """Fact rows with product attributes (J15, inner: unknown products drop out)."""
    return fact.join(maybe_broadcast(product.select("product_id", *cols)), "product_id")


def with_first_order(fact: DataFrame, key: str = "customer_id") -> DataFrame:
    """Each row with its customer's first order time (J10, A1): a map-side
    combined aggregate joined back, so a hot customer's rows can be split."""
    first = fact.groupBy(F.col(key).alias("_key")).agg(F.min("order_ts").alias("acquired_ts"))
    return fact.join(first, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def star(fact: DataFrame, product: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fact x product x calendar on ``date(order_ts) = date_key`` (J7); the
    calendar is broadcast if small."""
    f = with_product(fact, product)
    return f.join(maybe_broadcast(calendar), F.to_date("order_ts") == F.col("date_key"))
