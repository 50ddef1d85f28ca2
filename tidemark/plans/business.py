"""Business questions over the star.

Every query aggregates the fact *before* joining a dimension whenever the
grouping allows it (the fact is the only table that grows with the data), so
the shuffle carries one row per customer / version / product-day instead of
one per order line.  Averages and percentages are rounded half-up with exact
integer arithmetic (``round_ratio``) and money is ``decimal(18,2)``, so the
numbers do not depend on an engine's decimal-division typing.  Every sort
under a LIMIT is extended to a unique key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import count_true, elapsed_days, money, round_ratio
from tidemark.operators.relational import between_ts, maybe_broadcast, top_n


def month_bounds_filter(fact: DataFrame, lo: str | None, hi: str | None) -> DataFrame:
    """Half-open ``order_ts`` range plus the derived ``order_month`` predicate
    when the fact carries that partition column, so the scan is pruned to the
    wanted month folders (Parquet has no hidden partitioning)."""
    out = between_ts(fact, "order_ts", lo, hi)
    if "order_month" in fact.columns:
        m = F.col("order_month")
        if lo is not None:
            out = out.where(m >= F.lit(lo[:7]))
        if hi is not None:
            # an upper bound at the first instant of a month excludes that month
            starts_month = hi[8:].strip("0: ") in ("1", "") and hi[8:10] == "01"
            out = out.where(m < F.lit(hi[:7]) if starts_month else m <= F.lit(hi[:7]))
    return out


def clv_by_cohort(fact: DataFrame, dim: DataFrame, min_customers: int = 20, n: int = 50,
                  key: str = "customer_id") -> DataFrame:
    """Lifetime value by acquisition month and province (B1).

    First order, lifetime value and order count come from one aggregate per
    customer (``key``), then one join with the current versions."""
    per_customer = fact.groupBy(key).agg(
        F.min("order_ts").alias("acquired_ts"),
        F.sum("line_total").alias("lifetime_value"),
        F.count_distinct("order_id").alias("orders"),
    )
    current = dim.where(F.col("is_current")).select(key, "province")
    cohort = per_customer.join(current, key).select(
        F.date_format("acquired_ts", "yyyy-MM").alias("cohort_month"), "province",
        "lifetime_value", "orders")
    agg = cohort.groupBy("cohort_month", "province").agg(
        F.count("*").alias("customers"),
        F.sum((F.col("lifetime_value") * 100).cast("long")).alias("_ltv_cents"),
        F.sum("orders").alias("_orders"),
        F.sum("lifetime_value").alias("_revenue"),
    ).where(F.col("customers") >= min_customers)
    out = agg.select(
        "cohort_month", "province", "customers",
        round_ratio("_ltv_cents", F.col("customers") * 100, 2).alias("avg_clv"),
        round_ratio("_orders", "customers", 2).alias("avg_orders"),
        money("_revenue").alias("cohort_revenue"),
    )
    return top_n(out, [F.col("cohort_month").desc(), F.col("avg_clv").desc(), F.col("province")], n)


def at_risk_orders(fact: DataFrame, dim: DataFrame, as_of: str, n: int = 100) -> DataFrame:
    """Undelivered orders past their promise date, most overdue first (B2)."""
    per_order = fact.where(F.col("at_risk")).groupBy(
        "order_id", "customer_key", "order_status", "order_ts", "estimated_delivery"
    ).agg(F.sum("line_total").alias("_value"))
    j = per_order.join(dim.select("customer_key", "province"), "customer_key")
    out = j.select(
        "order_id", "province", "order_status", "order_ts", "estimated_delivery",
        elapsed_days("estimated_delivery", F.lit(as_of).cast("timestamp")).alias("days_overdue"),
        money("_value").alias("order_value"),
    )
    return top_n(out, [F.col("days_overdue").desc(), F.col("order_value").desc(), F.col("order_id")], n)


def late_rate_by_province(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Delivered lines, late lines, late percent and average delivery days
    per province of the referenced customer version (B3)."""
    per_key = fact.where(F.col("delivered_ts").isNotNull()).groupBy("customer_key").agg(
        F.count("*").alias("_n"),
        count_true(F.col("is_late")).alias("_late"),
        F.sum("delivery_days").alias("_days"),
        F.count("delivery_days").alias("_days_n"),
    )
    j = per_key.join(dim.select("customer_key", "province"), "customer_key")
    agg = j.groupBy("province").agg(
        F.sum("_n").alias("delivered_lines"),
        F.sum("_late").alias("late_lines"),
        F.sum("_days").alias("_days"),
        F.sum("_days_n").alias("_days_n"),
    )
    out = agg.select(
        "province", "delivered_lines", "late_lines",
        round_ratio(F.col("late_lines") * 100, "delivered_lines", 2).alias("late_pct"),
        round_ratio("_days", "_days_n", 1).alias("avg_delivery_days"),
    )
    return out.orderBy(F.col("late_pct").desc(), "province")


def sales_by_month_category(fact: DataFrame, product: DataFrame, calendar: DataFrame,
                            since: str, n: int = 100) -> DataFrame:
    """Units and revenue by month and category since a date.

    Lines are first summed per product and day; calendar and products
    are broadcast only if small."""
    f = month_bounds_filter(fact, since, None)
    per_day = f.groupBy("product_id", F.to_date("order_ts").alias("date_key")).agg(
        F.count("*").alias("_units"), F.sum("line_total").alias("_revenue"))
    j = (per_day.join(maybe_broadcast(product.select("product_id", "category")), "product_id")
         .join(maybe_broadcast(calendar.select("date_key", "year_month")), "date_key"))
    agg = j.groupBy("year_month", "category").agg(
        F.sum("_units").alias("units"), money(F.sum("_revenue")).alias("revenue"))
    return top_n(agg, [F.col("year_month").desc(), F.col("revenue").desc(), F.col("category")], n)


def total(fact: DataFrame, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Line count and revenue, whole table or a half-open time range."""
    f = month_bounds_filter(fact, lo, hi)
    return f.agg(F.count("*").alias("lines"), money(F.sum("line_total")).alias("revenue"))


def revenue_by_province(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Lines and revenue by province of the referenced version."""
    per_key = fact.groupBy("customer_key").agg(F.count("*").alias("_n"), F.sum("line_total").alias("_rev"))
    j = per_key.join(dim.select("customer_key", "province"), "customer_key")
    agg = j.groupBy("province").agg(F.sum("_n").alias("lines"), money(F.sum("_rev")).alias("revenue"))
    return agg.orderBy(F.col("revenue").desc(), "province")


def revenue_by_status(fact: DataFrame) -> DataFrame:
    """Revenue per order status."""
    return fact.groupBy("order_status").agg(money(F.sum("line_total")).alias("revenue"))


def top_categories(fact: DataFrame, product: DataFrame, n: int = 10) -> DataFrame:
    """Units per category, top n (A13): per-product counts, then the join."""
    per_product = fact.groupBy("product_id").agg(F.count("*").alias("_units"))
    j = per_product.join(maybe_broadcast(product.select("product_id", "category")), "product_id")
    agg = j.groupBy("category").agg(F.sum("_units").alias("units"))
    return top_n(agg, [F.col("units").desc(), F.col("category")], n)


def dashboard_queries(fact: DataFrame, dim: DataFrame, product: DataFrame,
                      month_lo: str, month_hi: str) -> dict[str, DataFrame]:
    """The five dashboard numbers (B9), each its own small result."""
    return {
        "line_count": total(fact).select("lines"),
        "revenue_by_status": revenue_by_status(fact),
        "top_categories": top_categories(fact, product),
        "revenue_by_province": revenue_by_province(fact, dim).select("province", "revenue"),
        "month_count": total(fact, month_lo, month_hi).select("lines"),
    }


def first_order(fact: DataFrame, key: str = "customer_id") -> DataFrame:
    """First order time per customer (A1)."""
    return fact.groupBy(key).agg(F.min("order_ts").alias("acquired_ts"))


def bounds(df: DataFrame, ts: str) -> DataFrame:
    """Earliest and latest date of a timestamp column, as a one-row DataFrame."""
    return df.agg(F.min(F.to_date(ts)).alias("d0"), F.max(F.to_date(ts)).alias("d1"))


cohort = clv_by_cohort   # A9: the two-level aggregation is B1
