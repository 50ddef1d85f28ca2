"""Named queries over a folder of driver tables: name -> (spark, sf_dir) -> DataFrame.

Each entry is one operator or business query of the toolkit applied to the
star built from ``sf_dir`` (see ``plans.curated``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.cleanse import status_step
from tidemark.operators import changes as C
from tidemark.operators import govern as G
from tidemark.operators import profile as PR
from tidemark.operators import quality as Q
from tidemark.operators import relational as R
from tidemark.operators import scd
from tidemark.operators.star import CLOSED_STATUSES, with_order_month
from tidemark.plans import business as B
from tidemark.plans import curated as CU
from tidemark.plans import metrics as M
from tidemark.plans import pipeline as P
from tidemark.session import materialize, scratch_path
from tidemark.sources import events as EV
from tidemark.sources import fixtures as X
from tidemark.sources import formats as FM
from tidemark.sources import tables as T
from tidemark.sources.tables import VersionedTable
from tidemark.streaming import changes as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---- step 1: star -------------------------------------------------------
@query("dim_date")
def q_dim_date(spark, sf):
    return CU.curated(spark, sf).dim_date


@query("dim_product")
def q_dim_product(spark, sf):
    return CU.curated(spark, sf).dim_product


@query("fact_order_item")
def q_fact(spark, sf):
    return CU.fact(spark, sf)


@query("late_rate_by_province")
def q_late_rate(spark, sf):
    return B.late_rate_by_province(CU.fact(spark, sf), CU.curated(spark, sf).dim_customer)


# ---- step 2: change application ----------------------------------------


# Fixed values of the test scenarios (seeded draws, sizes as in the
# reference's activity generator: 100 status updates, 10 deletes, 5 keys).
SAMPLE_SEED = "tidemark"
N_STATUS_UPDATES = 100
N_DELETES = 10
N_FIRST_KEYS = 5
CUSTOMER_PK = C.TABLE_KEYS["customers"]
ITEM_PK = C.TABLE_KEYS["order_items"]


@query("cdc_latest_per_key")
def q_cdc_latest(spark, sf):
    return C.prepare(CU.curated(spark, sf).change_batches[1], CUSTOMER_PK)


@query("cdc_first_load")
def q_cdc_first(spark, sf):
    return CU.curated(spark, sf).cleansed_states[0]


@query("cdc_after_batch1")
def q_cdc_b1(spark, sf):
    return CU.curated(spark, sf).cleansed_states[1]


@query("cdc_after_batch2")
def q_cdc_b2(spark, sf):
    return CU.curated(spark, sf).cleansed_states[2]


@query("cdc_after_batch3")
def q_cdc_b3(spark, sf):
    return CU.curated(spark, sf).cleansed_states[3]


@query("cdc_applied_counts")
def q_cdc_counts(spark, sf):
    c = CU.curated(spark, sf)
    out = None
    for k in (1, 2, 3):
        plan = C.merge_plan(c.cleansed_states[k - 1], c.latest_batches[k], CUSTOMER_PK)
        counts = C.applied_counts(plan, "customers").withColumn("batch", F.lit(k))
        out = counts if out is None else out.unionByName(counts)
    return out


@query("update_where_keys")
def q_update_where(spark, sf):
    customers = CU.curated(spark, sf).cleansed_states[3]
    keys = R.first_keys(customers, "customer_id", N_FIRST_KEYS)
    return C.update_where(customers, keys, ["customer_id"], {
        "customer_city": F.lit("Mississauga"), "customer_state": F.lit("ON")})


@query("delete_by_keys")
def q_delete_keys(spark, sf):
    items = CU.curated(spark, sf).items
    doomed = R.seeded_sample(items.select(*ITEM_PK), ITEM_PK, N_DELETES, SAMPLE_SEED)
    return C.delete_keys(items, doomed, ITEM_PK)


def stepped_fact_lines(fact):
    """Fact lines of a seeded sample of undelivered orders, one status step on."""
    orders = fact.where(F.col("order_status") != "delivered").select("order_id").distinct()
    picked = R.seeded_sample(orders, "order_id", N_STATUS_UPDATES, SAMPLE_SEED)
    lines = R.where_key_in(fact, picked, "order_id")
    new_status = status_step("order_status")
    return lines.withColumn("order_status", new_status).withColumn(
        "at_risk", F.col("delivered_ts").isNull() & ~F.col("order_status").isin(*CLOSED_STATUSES)
        & (F.col("estimated_delivery") < F.lit(X.AS_OF_TS).cast("timestamp")))


@query("upsert_fact")
def q_upsert_fact(spark, sf):
    fact = CU.fact(spark, sf)
    return C.upsert(fact, stepped_fact_lines(fact), ["order_id", "order_item_id"])


# ---- step 3: dimensions -------------------------------------------------
@query("attr_hash")
def q_attr_hash(spark, sf):
    return scd.customer_source(CU.curated(spark, sf).cleansed_states[3])


@query("scd2_after_3_batches")
def q_scd2(spark, sf):
    return CU.curated(spark, sf).dim_customer


@query("scd2_history")
def q_scd2_history(spark, sf):
    return scd.scd2_history(CU.curated(spark, sf).dim_customer)


@query("scd2_versioned")
def q_scd2_versioned(spark, sf):
    return scd.scd2_versioned(CU.curated(spark, sf).dim_customer)


@query("fact_key_current")
def q_fact_key_current(spark, sf):
    return CU.fact(spark, sf, key_mode="current").select("order_id", "order_item_id", "customer_id", "customer_key")


@query("fact_key_as_of")
def q_fact_key_as_of(spark, sf):
    return CU.fact(spark, sf, key_mode="as_of").select("order_id", "order_item_id", "customer_id", "customer_key")


# ---- step 4: business queries --------------------------------------------
# Query parameters over the test data's order history.
SINCE = "1998-01-01 00:00:00"
MONTH_LO, MONTH_HI = "1998-06-01 00:00:00", "1998-07-01 00:00:00"


@query("clv_by_cohort")
def q_clv(spark, sf):
    return B.clv_by_cohort(CU.fact(spark, sf), CU.curated(spark, sf).dim_customer, 20, 50)


@query("at_risk_orders")
def q_at_risk(spark, sf):
    return B.at_risk_orders(CU.fact(spark, sf), CU.curated(spark, sf).dim_customer, X.AS_OF_TS, 100)


@query("sales_by_month_category")
def q_sales(spark, sf):
    c = CU.curated(spark, sf)
    return B.sales_by_month_category(CU.fact(spark, sf), c.dim_product, c.dim_date, SINCE, 100)


@query("month_total")
def q_month_total(spark, sf):
    return B.total(spark.read.parquet(written_fact(spark, sf)), MONTH_LO, MONTH_HI)


@query("full_total")
def q_full_total(spark, sf):
    return B.total(CU.fact(spark, sf))


@query("min_customer_versions")
def q_min_versions(spark, sf):
    return scd.min_customer_versions(CU.curated(spark, sf).dim_customer)


@query("revenue_by_province")
def q_rev_province(spark, sf):
    return B.revenue_by_province(CU.fact(spark, sf), CU.curated(spark, sf).dim_customer)


@query("revenue_by_status")
def q_rev_status(spark, sf):
    return B.revenue_by_status(CU.fact(spark, sf))


@query("top_categories")
def q_top_categories(spark, sf):
    return B.top_categories(CU.fact(spark, sf), CU.curated(spark, sf).dim_product, 10)


# ---- step 5: quality gate, validations -------------------------------------

DQ_COLUMNS = ["rule_index", "rule", "outcome", "passed", "observed", "message"]


@query("dq_fact_rules")
def q_dq_rules(spark, sf):
    return Q.evaluate(spark, CU.fact(spark, sf), Q.fact_ruleset()).select(*DQ_COLUMNS)


@query("dq_score")
def q_dq_score(spark, sf):
    return Q.score(Q.evaluate(spark, CU.fact(spark, sf), Q.fact_ruleset()))


@query("dq_raw_lineitem")
def q_dq_raw(spark, sf):
    raw = X.read_table(spark, sf, "lineitem")
    rules = [Q.IsPrimaryKey(("l_orderkey", "l_linenumber")), Q.Uniqueness(("l_orderkey", "l_linenumber"), "=", 1.0)]
    return Q.evaluate(spark, raw, rules).select(*DQ_COLUMNS)


VALIDATIONS = [
    ("orphan_customer_keys",
     "SELECT f.order_id FROM {fact} f LEFT ANTI JOIN {dim_customer} d ON d.customer_key = f.customer_key"),
    ("one_current_version",
     "SELECT customer_id FROM {dim_customer} WHERE is_current GROUP BY customer_id HAVING count(*) > 1"),
    ("calendar_covers_orders",
     "SELECT f.order_id FROM {fact} f LEFT ANTI JOIN {dim_date} d ON d.date_key = to_date(f.order_ts)"),
    ("delivered_lines",
     "SELECT order_id FROM {fact} WHERE delivered_ts IS NOT NULL"),
]


@query("validations")
def q_validations(spark, sf):
    c = CU.curated(spark, sf)
    states = P.run_validations(spark, VALIDATIONS, fact=CU.fact(spark, sf), dim_customer=c.dim_customer,
                               dim_date=c.dim_date)
    return states.select("name", "state", "rows", "error")


@query("publish_blocked")
def q_publish_blocked(spark, sf):
    """The 13-rule gate on the test fact (its volumes and prices do not meet
    thresholds set for other data): the staged version is not published."""
    table = VersionedTable(spark, scratch_path(spark, "fact_gate"))
    row = P.run_pipeline(spark, lambda: CU.fact(spark, sf), Q.fact_ruleset(), table, run_id="gate-check")
    return row.select("run_id", "outcome", "score", "failed_rules", "version")


# ---- step 6: profiles and metrics --------------------------------------------

FRESHNESS_NOW = "2024-02-01 00:00:00"


@query("profile_tables")
def q_profile_tables(spark, sf):
    return PR.profile_dir(spark, sf)


def curated_tables(spark, sf):
    c = CU.curated(spark, sf)
    return {"fact_order_item": CU.fact(spark, sf), "dim_customer": c.dim_customer,
            "dim_product": c.dim_product, "dim_date": c.dim_date}


@query("row_counts")
def q_row_counts(spark, sf):
    return M.with_total(M.row_counts(curated_tables(spark, sf)))


@query("orphan_rows")
def q_orphans(spark, sf):
    t = curated_tables(spark, sf)
    f = t["fact_order_item"]
    cust = M.orphans(f, t["dim_customer"], "customer_key").select(F.lit("dim_customer").alias("dimension"), "orphan_rows")
    prod = M.orphans(f, t["dim_product"], "product_id").select(F.lit("dim_product").alias("dimension"), "orphan_rows")
    return cust.unionByName(prod)


def load_run_log(spark, sf):
    """The replayed loads as a run log: one successful run per change batch,
    from its first to its last change time."""
    parts = []
    for i, b in enumerate(CU.curated(spark, sf).change_batches):
        parts.append(b.agg(F.min("dms_ts").alias("started_at"), F.max("dms_ts").alias("finished_at")).select(
            F.lit(f"load-{i}").alias("run_id"), F.lit("ok").alias("outcome"), "started_at", "finished_at"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("freshness")
def q_freshness(spark, sf):
    return M.freshness(load_run_log(spark, sf), FRESHNESS_NOW)


# ---- step 8: governance -------------------------------------------------------

ROLE_SQLS = [
    "SELECT * FROM {customer_pii}",
    "SELECT customer_id, email FROM {customer_pii}",
    "SELECT province, count(*) AS rows_visible FROM {customer_pii} GROUP BY province",
]
SHARED = ["fact_order_item", "dim_customer", "dim_product", "dim_date"]


def pii_table(spark, sf):
    return G.synth_pii(G.current_customers(CU.curated(spark, sf).dim_customer))


def gov_tables(spark, sf):
    return {"customer_pii": pii_table(spark, sf), **curated_tables(spark, sf)}


@query("pii")
def q_pii(spark, sf):
    return pii_table(spark, sf)


@query("pii_analyst")
def q_pii_analyst(spark, sf):
    reg = G.default_registry(SHARED)
    return reg.view_for("analyst", "customer_pii", pii_table(spark, sf))


@query("pii_rows_by_role")
def q_pii_rows_by_role(spark, sf):
    reg = G.default_registry(SHARED)
    tables = {"customer_pii": pii_table(spark, sf)}
    parts = [G.query_as(spark, reg, role, ROLE_SQLS[2], tables).withColumn("role", F.lit(role))
             for role in ("analyst", "fraud")]
    return parts[0].unionByName(parts[1])


@query("role_comparison")
def q_role_comparison(spark, sf):
    reg = G.default_registry(SHARED)
    return G.compare_roles(spark, reg, ROLE_SQLS, ["analyst", "fraud"], {"customer_pii": pii_table(spark, sf)}) \
        .drop("message")


@query("grants")
def q_grants(spark, sf):
    return G.grants(G.default_registry(SHARED), gov_tables(spark, sf))


# ---- step 7: events, partitions, files, formats ---------------------------------

# The hour and day the partition queries look at, the declared
# projection (types, years, months, days, hours) and an out-of-range year.
HOUR = {"event_type": "pos_sale", "y": "2024", "m": "01", "d": "05", "h": "13"}
DAY = {"y": "2024", "m": "01", "d": "05"}
REGISTERED = [HOUR, {**HOUR, "h": "14"}, {**HOUR, "event_type": "page_view"}]
PROJ_ENUMS = {"event_type": ["pos_sale", "page_view", "inventory_move"]}
PROJ_RANGES = {"y": (2024, 2025, 4), "m": (1, 12, 2), "d": (1, 31, 2), "h": (0, 23, 2)}
FUTURE_RANGES = {**PROJ_RANGES, "y": (2026, 2027, 4)}
COMPACT_TARGET_MB = 1


def landed_events(spark, sf):
    key = CU._memo_key(spark, "landed", sf)
    if key not in CU._MEMO:
        root = scratch_path(spark, "raw-events")
        EV.land_events(X.raw_events(spark, sf), root).collect()
        CU._MEMO[key] = root
    return CU._MEMO[key]


def pos_totals(df):
    return df.agg(F.count("*").alias("events"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("decimal(18,2)")
                  .alias("amount"))


def where_spec(df, spec):
    for k, v in spec.items():
        df = df.where(F.col(k) == v)
    return df


@query("events_flat")
def q_events_flat(spark, sf):
    return pos_totals(EV.read_events_flat(spark, landed_events(spark, sf)).where(F.col("event_type") == "pos_sale"))


@query("events_one_hour_paths")
def q_events_hour_paths(spark, sf):
    return pos_totals(where_spec(EV.read_events_paths(spark, landed_events(spark, sf)), HOUR))


@query("events_registered")
def q_events_registered(spark, sf):
    root = landed_events(spark, sf)
    name = "events_manual_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    EV.create_events_table(spark, name, root)
    try:
        EV.add_partitions(spark, name, REGISTERED, root)
        return materialize(spark.table(name).groupBy("event_type", "h").agg(
            F.count("*").alias("events"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("decimal(18,2)").alias("amount")), "events-registered")
    finally:
        spark.sql(f"DROP TABLE {name}")  # external: the files stay


@query("events_projected")
def q_events_projected(spark, sf):
    return pos_totals(EV.read_projected(spark, landed_events(spark, sf), PROJ_ENUMS, PROJ_RANGES, HOUR))


@query("events_by_type")
def q_events_by_type(spark, sf):
    day = EV.read_projected(spark, landed_events(spark, sf), PROJ_ENUMS, PROJ_RANGES, DAY)
    return day.groupBy("event_type").agg(F.count("*").alias("events"))


@query("events_out_of_range")
def q_events_out_of_range(spark, sf):
    root = landed_events(spark, sf)
    out = EV.read_projected(spark, root, PROJ_ENUMS, FUTURE_RANGES, {"y": "2026"})
    inside = EV.read_projected(spark, root, PROJ_ENUMS, PROJ_RANGES, DAY)
    return (inside.select(F.lit("inside").alias("where")).unionByName(out.select(F.lit("outside").alias("where")))
            .groupBy().pivot("where", ["inside", "outside"]).count().na.fill(0))


def optimized_events(spark, sf):
    key = CU._memo_key(spark, "optimized", sf)
    if key not in CU._MEMO:
        CU._MEMO[key] = EV.optimize_events(EV.read_events_flat(spark, landed_events(spark, sf)),
                                           scratch_path(spark, "events-parquet"))
    return CU._MEMO[key]


@query("events_parquet")
def q_events_parquet(spark, sf):
    return optimized_events(spark, sf)


def written_fact(spark, sf):
    key = CU._memo_key(spark, "written_fact", sf)
    if key not in CU._MEMO:
        path = scratch_path(spark, "fact")
        T.write_fact(with_order_month(CU.fact(spark, sf)), path)
        CU._MEMO[key] = path
    return CU._MEMO[key]


@query("compacted")
def q_compacted(spark, sf):
    return T.compact(spark, written_fact(spark, sf), scratch_path(spark, "fact-compacted"),
                     COMPACT_TARGET_MB, ["order_month"])


@query("format_sizes")
def q_format_sizes(spark, sf):
    """Rows and shares of CSV of every written format, each read back and listed."""
    c = CU.curated(spark, sf)
    joined = c.orders.join(c.items, "order_id")
    out = scratch_path(spark, "formats")
    sizes = FM.format_sizes(joined, out)
    back = FM.read_back(spark, out)
    csv = F.max(F.when(F.col("format") == "csv", F.col("listed_bytes"))).over(Window.partitionBy())
    return sizes.join(back, "format", "left").select(
        "format", "rows", (F.col("bytes") == F.col("listed_bytes")).alias("bytes_listed"),
        (F.abs(F.col("pct_of_csv") - F.col("listed_bytes") * 100.0 / csv) < 0.051).alias("pct_listed"))


@query("seeded_sample")
def q_seeded_sample(spark, sf):
    return R.seeded_sample(CU.curated(spark, sf).cleansed_states[3], "customer_id", 50, SAMPLE_SEED)


# ---- streaming --------------------------------------------------------------------


def landed_changes(spark, sf):
    """Change files landed in load order (full load, batch 1, 2, 3)."""
    key = CU._memo_key(spark, "landed_changes", sf)
    if key not in CU._MEMO:
        folder = scratch_path(spark, "cdc-files")
        for b in CU.curated(spark, sf).change_batches:
            b.write.mode("append").parquet(folder)
        CU._MEMO[key] = folder
    return CU._MEMO[key]


@query("cdc_stream")
def q_cdc_stream(spark, sf):
    folder = landed_changes(spark, sf)
    schema = spark.read.parquet(folder).schema
    table = VersionedTable(spark, scratch_path(spark, "customers-stream"))
    ST.apply_stream(spark, folder, schema, table, CUSTOMER_PK, scratch_path(spark, "cdc-checkpoint"))
    return table.read()


@query("events_stream")
def q_events_stream(spark, sf):
    out = scratch_path(spark, "events-stream")
    ST.optimize_events_stream(spark, landed_events(spark, sf), out, scratch_path(spark, "events-checkpoint"))
    return spark.read.parquet(out)


# ---- more metrics ------------------------------------------------------------------
RULE_LOG_TS = ("2024-02-01 06:00:00", "2024-02-02 06:00:00")


def rule_log(spark, sf):
    """The 13-rule evaluation of two fact builds (as-of keys, then current
    keys) as a rule-result log."""
    parts = []
    for i, mode in enumerate(("as_of", "current")):
        res = Q.evaluate(spark, CU.fact(spark, sf, key_mode=mode), Q.fact_ruleset())
        parts.append(res.select(F.lit(f"dq-{i + 1}").alias("run_id"),
                                F.lit(RULE_LOG_TS[i]).cast("timestamp").alias("evaluated_at"), "rule", "passed"))
    return parts[0].unionByName(parts[1])


@query("latest_score")
def q_latest_score(spark, sf):
    return M.latest_score(rule_log(spark, sf))


@query("health_metrics")
def q_health_metrics(spark, sf):
    t = curated_tables(spark, sf)
    recs = M.health_metrics(t["fact_order_item"], {k: v for k, v in t.items() if k != "fact_order_item"},
                            t["dim_customer"], FRESHNESS_NOW)
    return recs.select("metric", "value", "unit", F.coalesce(F.col("dims")["Table"], F.lit("")).alias("table_dim"),
                       "measured_at")


@query("upsert_partitioned")
def q_upsert_partitioned(spark, sf):
    """The fact's stepped lines upserted into a folder by month that has a NULL
    partition: second lines carry no month."""
    part = F.when(F.col("order_item_id") != 2, F.date_format("order_ts", "yyyy-MM"))
    cols = ["order_id", "order_item_id", "order_status", "at_risk"]
    path = scratch_path(spark, "fact-by-month")
    fact = CU.fact(spark, sf)
    T.write_fact(fact.select(*cols, part.alias("part")), path, "part")
    T.upsert_partitions(spark, path, stepped_fact_lines(fact).select(*cols, part.alias("part")),
                        ["order_id", "order_item_id"], "part")
    return spark.read.parquet(path).select(*cols, F.col("part").cast("string").alias("part"))


def streamed_batches(spark, sf, buckets=None):
    """Two runs of the incremental job, one file a trigger; the last two batches
    land between the runs."""
    landing, checkpoint = scratch_path(spark, "cdc-landing"), scratch_path(spark, "cdc-checkpoint")
    target = scratch_path(spark, "customers-batches")
    table = target if buckets else VersionedTable(spark, target)
    batches = CU.curated(spark, sf).change_batches
    for run in (batches[:2], batches[2:]):
        for b in run:
            b.repartition(1).write.mode("append").parquet(landing)  # one file, from a scan by many tasks
        schema = batches[0].schema
        ST.apply_stream(spark, landing, schema, table, CUSTOMER_PK, checkpoint, max_files_per_trigger=1, buckets=buckets)
    return spark.read.parquet(target).drop("_bucket") if buckets else table.read()


@query("cdc_stream_batches")
def q_cdc_stream_batches(spark, sf):
    return streamed_batches(spark, sf)


@query("cdc_stream_bucketed")
def q_cdc_stream_bucketed(spark, sf):
    return streamed_batches(spark, sf, buckets=8)


@query("cdc_rejects")
def q_cdc_rejects(spark, sf):
    """Changes whose key is blank are rejected beside the table, the others applied."""
    load = CU.curated(spark, sf).change_batches[0]
    blank = F.when(F.col("customer_id").endswith("7"), F.lit(" ")).otherwise(F.col("customer_id"))
    table = VersionedTable(spark, scratch_path(spark, "customers-rejects"))
    ST.merge_batch(table, load.withColumn("customer_id", blank), CUSTOMER_PK, 0)
    rejected = ST.rejects(spark, table.path)
    both = table.read().select(F.lit(True).alias("ok")).unionByName(rejected.select(F.lit(False).alias("ok")))
    return both.agg(F.count_if("ok").alias("applied"), F.count_if(~F.col("ok")).alias("rejected"))


@query("pipeline_outcomes")
def q_pipeline_outcomes(spark, sf):
    """One run per outcome: published, no rules, blocked, a validation that fails
    as it runs; and the lines a reader sees after each."""
    fact = lambda: CU.fact(spark, sf)
    complete = [Q.IsComplete("order_id")]
    divide = [("divides", "SELECT * FROM {published} WHERE 1 / (order_item_id - order_item_id) > 0")]
    out = None
    for run, rules, checks in (("ok", complete, ()), ("no_rules", [], ()),
                               ("blocked", [Q.RowCount(">", 1 << 60)], ()), ("failed", complete, divide)):
        table = VersionedTable(spark, scratch_path(spark, "outcome"))
        row = P.run_pipeline(spark, fact, rules, table, checks, run_id=run).select("run_id", "outcome", "score")
        seen = table.read() if table.exists() else fact().limit(0)
        lines = seen.agg(F.count("*").alias("published_lines"))
        row = row.withColumn("published_lines", F.lit(None).cast("long")).unionByName(lines.select(
            F.lit(run).alias("run_id"), F.lit(None).cast("string").alias("outcome"), F.lit(None).cast("double").alias("score"),
            "published_lines"))
        out = row if out is None else out.unionByName(row)
    return out.groupBy("run_id").agg(*[F.max(c).alias(c) for c in ("outcome", "score", "published_lines")])


from tidemark import registry_jobs  # noqa: E402,F401  (registers its queries here)
