"""Benchmark: build the star from the driver tables, write the fact as
month-partitioned Parquet, then time the business queries, the quality pass
and the change-application steps.  Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import changes as C  # noqa: E402
from tidemark.operators import quality as Q  # noqa: E402
from tidemark.operators import scd  # noqa: E402
from tidemark.operators.star import build_dim_date, build_dim_product, build_fact, with_order_month  # noqa: E402
from tidemark.plans import business as B  # noqa: E402
from tidemark.plans import curated as CU  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402
from tidemark.sources import fixtures as X  # noqa: E402
from tidemark.sources.formats import format_sizes  # noqa: E402
from tidemark.sources.tables import file_inventory, write_fact  # noqa: E402


def timed(fn, repeat: int = 2) -> float:
    best = None
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        dt = time.perf_counter() - t0
        best = dt if best is None else min(best, dt)
    return best


def run_all(df) -> None:
    """Execute the whole plan without bringing rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="tidemark-bench")
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    times: dict[str, float] = {}

    # JVM and code-generation warm-up, reported but not counted: one scan of
    # each input table
    t0 = time.perf_counter()
    for name in ("orders", "lineitem", "customer", "part", "events"):
        X.read_table(spark, sf_dir, name).agg(F.count("*")).collect()
    warmup = time.perf_counter() - t0

    # 1. change application (full load + 3 batches), then SCD2 (4 runs);
    #    every state is written to the shared folder, as in production
    pk = C.TABLE_KEYS["customers"]
    batches = CU.change_batches(spark, sf_dir)
    t0 = time.perf_counter()
    states = C.replay(None, batches, pk)
    times["cdc_replay_4_loads"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    dims = CU.incremental_scd2(spark, batches, states)
    times["scd2_4_runs"] = time.perf_counter() - t0
    times["apply_changes_1_batch"] = timed(lambda: run_all(C.apply_changes(states[2], C.prepare(batches[3], pk), pk)))
    times["scd2_apply_1_run"] = timed(lambda: run_all(scd.scd2_apply(dims[2], scd.customer_source(states[3], unique=True),
                                                                     X.RUN_TS[3])))
    orders = X.orders(spark, sf_dir)
    items = X.order_items(spark, sf_dir)
    product = build_dim_product(X.products(spark, sf_dir), X.category_translation(spark, sf_dir))
    calendar = build_dim_date(orders)
    dim = dims[-1]

    # 2. fact (as-of keys) written partitioned by month
    fact_path = scratch_path(spark, "bench-fact")
    t0 = time.perf_counter()
    fact_df = build_fact(items, orders, dim, X.AS_OF_TS, "as_of")
    write_fact(with_order_month(fact_df), fact_path)
    times["build_fact"] = time.perf_counter() - t0
    fact = spark.read.parquet(fact_path)

    # 3. business queries over the written star
    queries = {
        "b1_clv_by_cohort": lambda: B.clv_by_cohort(fact, dim, 20, 50),
        "b2_at_risk_orders": lambda: B.at_risk_orders(fact, dim, X.AS_OF_TS, 100),
        "b3_late_rate_by_province": lambda: B.late_rate_by_province(fact, dim),
        "b4_sales_by_month_category": lambda: B.sales_by_month_category(fact, product, calendar,
                                                                        "1998-01-01 00:00:00", 100),
        "b5_full_total": lambda: B.total(fact),
        "b5_month_total": lambda: B.total(fact, "1998-06-01 00:00:00", "1998-07-01 00:00:00"),
        "b8_revenue_by_province": lambda: B.revenue_by_province(fact, dim),
        "dq_13_rules": lambda: Q.evaluate(spark, fact, Q.fact_ruleset()),
    }
    for name, build in queries.items():
        times[name] = timed(lambda b=build: b().collect())

    # 4. pruning: bytes and files read for one month against the whole table
    month = B.total(fact, "1998-06-01 00:00:00", "1998-07-01 00:00:00")
    month_files = fact.where(F.col("order_month") == "1998-06")
    inv_full = file_inventory(fact).first()
    inv_month = file_inventory(month_files).first()
    month.collect()

    # 5. bytes per format of orders x items (reported, not counted in the total)
    t0 = time.perf_counter()
    sizes = format_sizes(orders.join(items, "order_id"), scratch_path(spark, "bench-formats"))
    format_bytes = {r["format"]: r["bytes"] for r in sizes.collect()}
    format_sec = time.perf_counter() - t0

    # 6. the reference's published facts, measured on this data (not timed)
    facts = fact.agg(F.count("*").alias("rows"), F.count("delivered_ts").alias("delivered"),
                     F.min("price").alias("pmin"), F.max("price").alias("pmax")).first()
    uniq = Q.evaluate(spark, fact, [Q.Uniqueness(("order_id", "order_item_id"), "=", 1.0)]).first()["observed"]
    dq = Q.score(Q.evaluate(spark, fact, Q.fact_ruleset())).first()
    from tidemark.operators import govern as G
    pii = G.synth_pii(G.current_customers(dim))
    analyst = G.default_registry([]).view_for("analyst", "customer_pii", pii)
    reference_facts = {
        "fact_rows": facts["rows"],
        "fact_key_uniqueness": uniq,
        "delivered_ts_completeness_pct": round(100.0 * facts["delivered"] / max(facts["rows"], 1), 2),
        "price_range": [float(facts["pmin"]), float(facts["pmax"])],
        "quality_rules": len(Q.fact_ruleset()),
        "quality_score": dq["score"],
        "month_scan_share_of_files": round(inv_month["files"] / max(inv_full["files"], 1), 4),
        "analyst_visible_columns": f"{len(analyst.columns)} of {len(pii.columns)}",
        "analyst_visible_rows_share": round(analyst.count() / max(pii.count(), 1), 4),
    }

    total = sum(v for k, v in times.items())
    out = {
        "metric": "total_query_seconds",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "fact_rows": fact.count(),
        "fact_files": inv_full["files"],
        "fact_mb": inv_full["total_mb"],
        "month_files": inv_month["files"],
        "month_mb": inv_month["total_mb"],
        "format_bytes": format_bytes,
        "format_sizes_sec": round(format_sec, 3),
        "warmup_sec": round(warmup, 3),
        "reference_facts": reference_facts,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
