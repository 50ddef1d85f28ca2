"""Fact measures, calendar and product rules: T6, T9, T12, T13."""
import datetime as dt

from decimal import Decimal as D

from tidemark.functions.exprs import calendar_days, elapsed_days, round_ratio
from tidemark.operators.star import build_dim_date, build_dim_product, fact_lines

ORD = ("order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
       "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp")
ITEMS = "order_id string, order_item_id int, product_id string, seller_id string, price decimal(10,2), freight_value decimal(10,2)"


def test_day_counts(spark):
    t = dt.datetime
    df = spark.createDataFrame([(t(2024, 1, 1, 23), t(2024, 1, 2, 1)), (t(2024, 1, 1, 0), t(2024, 1, 1, 23)),
                                (t(2024, 1, 1, 0), t(2024, 1, 2, 1))], "a timestamp, b timestamp")
    got = [(r[0], r[1]) for r in df.select(calendar_days("b", "a"), elapsed_days("a", "b")).collect()]
    assert got == [(1, 0), (0, 0), (1, 1)]


def test_three_valued_flags(spark):
    t = dt.datetime
    orders = spark.createDataFrame([
        ("o1", "c", None, t(2024, 1, 1), None, t(2024, 1, 5)),          # NULL status, undelivered -> NULL at_risk
        ("o2", "c", None, t(2024, 1, 1), t(2024, 1, 9), t(2024, 1, 5)),  # delivered -> at_risk false
        ("o3", "c", "delivered", t(2024, 1, 1), t(2024, 1, 9), None),    # NULL promise -> NULL is_late
        ("o4", "c", "canceled", t(2024, 1, 1), None, t(2024, 1, 5)),     # closed status -> false
    ], ORD)
    items = spark.createDataFrame([(o, 1, "p", "s", D(1), D(0)) for o in ("o1", "o2", "o3", "o4")], ITEMS)
    got = {r["order_id"]: (r["is_late"], r["at_risk"]) for r in fact_lines(items, orders, "2024-02-01").collect()}
    assert got == {"o1": (False, None), "o2": (True, False), "o3": (None, False), "o4": (False, False)}


def test_zero_money_and_line_total(spark):
    orders = spark.createDataFrame([("o1", "c", "shipped", dt.datetime(2024, 1, 1), None, dt.datetime(2024, 1, 5))], ORD)
    items = spark.createDataFrame([("o1", 1, "p", "s", D(0), D(0)), ("o9", 1, "p", "s", D(5), D(5))], ITEMS)
    rows = fact_lines(items, orders, "2024-01-02").collect()
    assert len(rows) == 1 and rows[0]["line_total"] == 0       # lines without an order vanish


def test_calendar(spark):
    one = spark.createDataFrame([(dt.datetime(2024, 1, 6, 15),), (dt.datetime(2024, 1, 7, 1),)],
                                "order_purchase_timestamp timestamp")
    cal = {r["date_key"].isoformat(): (r["day_name"], r["is_weekend"], r["year_month"])
           for r in build_dim_date(one).collect()}
    assert cal == {"2024-01-06": ("Saturday", True, "2024-01"), "2024-01-07": ("Sunday", True, "2024-01")}
    empty = spark.createDataFrame([], "order_purchase_timestamp timestamp")
    assert build_dim_date(empty).count() == 0


def test_product_category_arms_and_volume(spark):
    products = spark.createDataFrame([("1", "x", 1, 2000, 2000, 2000), ("2", "y", 1, 1, 1, 1), ("3", None, 1, 1, 1, 1)],
                                     "product_id string, product_category_name string, product_weight_g int, "
                                     "product_length_cm int, product_height_cm int, product_width_cm int")
    tr = spark.createDataFrame([("x", "ex")], "product_category_name string, product_category_name_english string")
    got = {r["product_id"]: (r["category"], r["volume_cm3"]) for r in build_dim_product(products, tr).collect()}
    assert got == {"1": ("ex", 8_000_000_000), "2": ("y", 1), "3": ("unknown", 1)}


def test_round_ratio_half_up_exact(spark):
    df = spark.createDataFrame([(29, 20000), (1, 8), (2, 3), (0, 5), (1, 0)], "n long, d long")
    got = [r[0] for r in df.select(round_ratio("n", "d", 5)).collect()]
    assert [str(x) if x is not None else None for x in got] == ["0.00145", "0.12500", "0.66667", "0.00000", None]
    got2 = [str(r[0]) for r in spark.createDataFrame([(29, 200)], "n long, d long")
            .select(round_ratio("n", "d", 2)).collect()]
    assert got2 == ["0.15"]      # 0.145 rounds up (a double would give 0.14)


def test_every_region_code_maps(spark):
    from tidemark.functions.cleanse import STATE_TO_PROVINCE, province_of
    codes = list(STATE_TO_PROVINCE) + ["XX", None]
    df = spark.createDataFrame([(c,) for c in codes], "s string")
    got = [r[0] for r in df.select(province_of("s")).collect()]
    assert got == list(STATE_TO_PROVINCE.values()) + ["ON", "ON"]


def test_missing_product_drops_sales_and_shows_as_orphan(spark):
    from tidemark.plans import business as B
    from tidemark.plans import metrics as M
    t = dt.datetime
    fact = spark.createDataFrame([("o1", "p1", t(2024, 1, 1), D("10.00")), ("o2", "p2", t(2024, 1, 1), D("5.00"))],
                                 "order_id string, product_id string, order_ts timestamp, line_total decimal(10,2)")
    product = spark.createDataFrame([("p1", "toys")], "product_id string, category string")
    cal = build_dim_date(spark.createDataFrame([(t(2024, 1, 1),)], "order_purchase_timestamp timestamp"))
    rows = B.sales_by_month_category(fact, product, cal, "2023-01-01 00:00:00").collect()
    assert [(r["category"], r["units"]) for r in rows] == [("toys", 1)]          # p2's sale is dropped
    assert M.orphans(fact, product, "product_id").first()["orphan_rows"] == 1    # and counted as an orphan
