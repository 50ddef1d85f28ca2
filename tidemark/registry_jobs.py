"""Registered queries of the jobs, governance and file operators (see ``registry``).

Like there, each entry takes (spark, sf_dir) and works on the driver tables, or
on what the jobs derive from them under the work folder.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import changes as C
from tidemark.operators import govern as G
from tidemark.operators import quality as Q
from tidemark.operators import scd
from tidemark.plans import curated as CU
from tidemark.plans import jobs as J
from tidemark.plans import metrics as M
from tidemark.plans import pipeline as P
from tidemark.registry import CUSTOMER_PK, ROLE_SQLS, curated_tables, pii_table, query, written_fact
from tidemark.session import freed_shuffles, materialize, scratch_path
from tidemark.sources import events as EV
from tidemark.sources import files as FI
from tidemark.sources import fixtures as X
from tidemark.sources import scans as SC
from tidemark.sources import tables as T
from tidemark.sources.tables import VersionedTable
from tidemark.streaming import changes as ST

# ---- a role's queries ---------------------------------------------------------


def role_attacks(raw_path: str, raw_view: str, raw_table: str) -> dict[str, str]:
    """What an analyst may and may not ask, by name."""
    new = f"{raw_table}_copy"
    return {
        "granted": "SELECT * FROM {customer_pii}",
        "granted_cte": "WITH mine AS (SELECT * FROM {customer_pii}) SELECT province, count(*) AS n FROM mine GROUP BY province",
        "granted_subquery": "SELECT customer_id FROM {customer_pii} WHERE customer_id IN (SELECT max(customer_id) FROM {customer_pii})",
        "granted_constants": "SELECT * FROM VALUES (1), (2) AS t(x)",
        "hidden_column": "SELECT full_name FROM {customer_pii}",
        "hidden_in_filter": "SELECT customer_id FROM {customer_pii} WHERE email LIKE 'a%'",
        "path": f"SELECT full_name FROM parquet.`{raw_path}`",
        "view": f"SELECT full_name FROM {raw_view}",
        "table": f"SELECT full_name FROM {raw_table}",
        "identifier": f"SELECT full_name FROM IDENTIFIER('{raw_view}')",
        "identifier_path": f"SELECT full_name FROM IDENTIFIER('parquet.`{raw_path}`')",
        "shadowing_cte": f"WITH {raw_view} AS (SELECT * FROM {raw_view}) SELECT full_name FROM {raw_view}",
        "scalar_subquery": f"SELECT (SELECT max(full_name) FROM {raw_view}) AS x FROM {{customer_pii}}",
        "in_subquery": f"SELECT customer_id FROM {{customer_pii}} WHERE customer_id IN (SELECT customer_id FROM {raw_view})",
        "lateral": f"SELECT p.full_name FROM {{customer_pii}} v, LATERAL (SELECT * FROM {raw_view} r WHERE r.customer_id = v.customer_id) p",
        "join": f"SELECT p.* FROM {{customer_pii}} v JOIN {raw_view} p ON v.customer_id = p.customer_id",
        "union": f"SELECT customer_id FROM {{customer_pii}} UNION ALL SELECT full_name FROM {raw_table}",
        "not_there": "SELECT * FROM no_such_table",
        "drop_table": f"DROP TABLE {raw_table}",
        "create_as": f"CREATE TABLE {new} USING parquet AS SELECT * FROM IDENTIFIER('{raw_view}')",
        "insert": f"INSERT INTO {raw_table} SELECT * FROM {raw_table}",
        "overwrite_folder": f"INSERT OVERWRITE DIRECTORY '{raw_path}' USING parquet SELECT 1 AS x",
        "set": "SET spark.sql.ansi.enabled=false",
        "show_tables": "SHOW TABLES",
        "describe": f"DESCRIBE TABLE {raw_table}",
        "explain": f"EXPLAIN SELECT * FROM {raw_table}",
        "cache": f"CACHE TABLE {raw_table}",
        "immediate": f"EXECUTE IMMEDIATE 'SELECT full_name FROM {raw_view}'",
        "script": f"BEGIN SELECT full_name FROM {raw_view}; END",
        "reflection": "SELECT reflect('java.lang.System', 'getProperty', 'user.home') AS x FROM {customer_pii}",
    }


@query("role_attacks")
def q_role_attacks(spark, sf):
    """Each attack as the analyst: state and rows; then what is left of the raw table."""
    people, tag = pii_table(spark, sf), uuid.uuid4().hex[:12]
    path, view, table = scratch_path(spark, "people"), f"people_view_{tag}", f"people_table_{tag}"
    people.write.parquet(path)
    spark.read.parquet(path).createTempView(view)
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    try:
        asked = role_attacks(path, view, table)
        got = G.compare_roles(spark, G.default_registry(()), list(asked.values()), ["analyst"], {"customer_pii": spark.read.parquet(path)})
        still = spark.catalog.tableExists(table) and not spark.catalog.tableExists(f"{table}_copy")
    finally:
        spark.catalog.dropTempView(view)
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay
    names = F.create_map(*[F.lit(x) for i, name in enumerate(asked) for x in (i, name)])
    left = spark.read.parquet(path).agg(F.count("*").alias("rows")).select(
        F.lit("raw_table_after").alias("attack"), F.lit("KEPT" if still else "GONE").alias("state"), "rows")
    return got.select(names[F.col("sql_id")].alias("attack"), "state", "rows").unionByName(left)


def revoked_roles(spark, sf):
    registry, tables = G.default_registry(()), {"customer_pii": pii_table(spark, sf)}
    registry.revoke("fraud", "customer_pii")
    return registry, tables


@query("role_comparison_revoked")
def q_role_comparison_revoked(spark, sf):
    registry, tables = revoked_roles(spark, sf)
    return G.compare_roles(spark, registry, ROLE_SQLS, ["analyst", "fraud"], tables).drop("message")


@query("pii_masked")
def q_pii_masked(spark, sf):
    return G.mask(pii_table(spark, sf), {"email": "hash", "phone": "partial", "sin_test": "redact"})


@query("pii_first_customers")
def q_pii_first_customers(spark, sf):
    return G.synth_pii(G.current_customers(CU.curated(spark, sf).dim_customer, limit=25))


@query("pii_csv")
def q_pii_csv(spark, sf):
    """The PII table written as CSV with headers and read back as an external table."""
    path = scratch_path(spark, "pii-csv")
    FI.write_pii(pii_table(spark, sf), path)
    return FI.read_pii(spark, path)


# ---- the jobs -----------------------------------------------------------------

# Run and as-of times of the two builds, and where late changes go.
BUILDS = (("1996-01-01 00:00:00", "1996-06-01 00:00:00"), ("1997-07-01 00:00:00", "2001-06-01 00:00:00"))
LATE_TS = "2000-01-01 00:00:00"


def land_everything(spark, sf, raw):
    """Full loads of all tables, then the three customer change batches."""
    def full(df):
        return df.withColumn("Op", F.lit("I")).withColumn("dms_ts", F.lit(X.FULL_LOAD_TS).cast("timestamp"))

    full(X.orders(spark, sf)).write.parquet(f"{raw}/orders")
    full(X.order_items(spark, sf)).write.parquet(f"{raw}/order_items")
    full(X.products(spark, sf)).write.parquet(f"{raw}/products")
    full(X.category_translation(spark, sf)).write.parquet(f"{raw}/category_translation")
    for b in CU.change_batches(spark, sf):
        b.write.mode("append").parquet(f"{raw}/customers")


def land_late_changes(spark, sf, raw):
    """Changes older than the first load: canceled orders, orders that move to another
    month, dearer first lines, and customers that moved."""
    change = {"Op": F.lit("U"), "dms_ts": F.lit(LATE_TS).cast("timestamp")}
    orders, of = X.orders(spark, sf), F.col("order_id").cast("long") % 50
    canceled = orders.where(of == 1).withColumn("order_status", F.lit("canceled"))
    moved = orders.where(of == 2).withColumn("order_purchase_timestamp", F.timestamp_add("DAY", F.lit(40), "order_purchase_timestamp"))
    canceled.unionByName(moved).withColumns(change).write.mode("append").parquet(f"{raw}/orders")
    items = spark.read.parquet(f"{raw}/order_items").drop("Op", "dms_ts")  # as landed, not computed again
    (items.where((of == 3) & (F.col("order_item_id") == 1))
     .withColumn("price", (F.col("price") + 1).cast("decimal(10,2)")).withColumns(change).write.mode("append").parquet(f"{raw}/order_items"))
    (CU.change_batches(spark, sf)[0].where(F.col("customer_id").cast("long") % 100 == 0)
     .withColumn("customer_city", F.lit("Elsewhere")).withColumns(change).write.mode("append").parquet(f"{raw}/customers"))


def lenient_rules():
    """The fact's rules with thresholds that the test data meets; customers deleted
    before the first run leave lines without a key."""
    return [r for r in Q.fact_ruleset(min_rows=0, max_price=1e9, min_delivered=0.0) if r.label() != 'IsComplete "customer_key"']


def incremental_runs(spark, sf, root):
    """Two gated daily runs, the second one incremental after late changes."""
    raw, cleansed, curated = f"{root}/raw", f"{root}/cleansed", f"{root}/curated"
    with freed_shuffles(spark):
        land_everything(spark, sf, raw)
    outcomes = []
    for k, (run_ts, as_of) in enumerate(BUILDS):
        if k:
            land_late_changes(spark, sf, raw)
        J.raw_to_cleansed(spark, raw, cleansed, f"{root}/checkpoints", keep_versions=1)
        outcomes.append(J.daily_pipeline(spark, cleansed, curated, run_ts, as_of, lenient_rules(), incremental=k > 0).first()["outcome"])
    if outcomes != ["ok", "ok"]:
        raise RuntimeError(f"daily runs ended {outcomes}")
    return cleansed, curated


@query("fact_incremental")
def q_fact_incremental(spark, sf):
    """The fact after an incremental build with late changes, moved months and a later
    as-of time; the oracle rebuilds it whole."""
    _, curated = incremental_runs(spark, sf, scratch_path(spark, "incremental"))
    return J.read_curated(spark, curated)["fact_order_item"]


@query("cdc_job_counts")
def q_cdc_job_counts(spark, sf):
    """What four loads did, as counted by the merges of a versioned and a bucketed table."""
    root = scratch_path(spark, "counted")
    batches = CU.curated(spark, sf).change_batches
    for k, b in enumerate(batches):
        b.coalesce(1).write.mode("append").parquet(f"{root}/landing")
        for name, buckets in (("versioned", None), ("bucketed", 8)):
            target = f"{root}/{name}"
            ST.apply_stream(spark, f"{root}/landing", batches[0].schema, target if buckets else VersionedTable(spark, target),
                            CUSTOMER_PK, f"{root}/checkpoint-{name}", buckets=buckets, counts=f"{root}/counts")
    return ST.read_counts(spark, f"{root}/counts")


@query("cdc_replayed_batch")
def q_cdc_replayed_batch(spark, sf):
    """The same batch applied twice changes nothing the second time."""
    c = CU.curated(spark, sf)
    latest = C.prepare(c.change_batches[1], CUSTOMER_PK)
    return C.apply_changes(materialize(C.apply_changes(c.cleansed_states[0], latest, CUSTOMER_PK), "once"), latest, CUSTOMER_PK)


@query("cdc_empty_batch")
def q_cdc_empty_batch(spark, sf):
    """An empty batch between two loads writes no version."""
    batches = CU.curated(spark, sf).change_batches
    table = VersionedTable(spark, scratch_path(spark, "customers-empty"))
    for k, b in enumerate((batches[0], batches[1].limit(0), batches[1])):
        ST.merge_batch(table, b, CUSTOMER_PK, k)
    return table.read().agg(F.count("*").alias("rows")).withColumn("versions", F.lit(len(table.published())).cast("long"))


@query("cdc_stale_ignored")
def q_cdc_stale_ignored(spark, sf):
    """Full load, batch 3, then batch 1 late: rows that are newer stay, in both kinds of table."""
    batches = CU.curated(spark, sf).change_batches
    root = scratch_path(spark, "stale")
    table = VersionedTable(spark, f"{root}/versioned")
    for k, b in enumerate((batches[0], batches[3], batches[1])):
        ST.merge_batch(table, b, CUSTOMER_PK, k, ignore_stale=True)
        ST.merge_batch_bucketed(spark, f"{root}/bucketed", b, CUSTOMER_PK, k, 8, ignore_stale=True)
    both = [(table.read(), "versioned"), (spark.read.parquet(f"{root}/bucketed").drop("_bucket"), "bucketed")]
    return both[0][0].withColumn("kind", F.lit(both[0][1])).unionByName(both[1][0].withColumn("kind", F.lit(both[1][1])))


@query("cdc_latest_all")
def q_cdc_latest_all(spark, sf):
    """The latest change of every customer over the full load and all three batches."""
    batches = CU.curated(spark, sf).change_batches
    return C.prepare(reduce(DataFrame.unionByName, batches), CUSTOMER_PK)


@query("cdc_rejects_all")
def q_cdc_rejects_all(spark, sf):
    """Four loads in which customers whose id ends in 7 have a blank key: rows applied,
    and rejected rows by batch."""
    table = VersionedTable(spark, scratch_path(spark, "customers-rejects"))
    for k, b in enumerate(CU.curated(spark, sf).change_batches):
        blank = F.when(F.col("customer_id").endswith("7"), F.lit(" ")).otherwise(F.col("customer_id"))
        ST.merge_batch(table, b.withColumn("customer_id", blank), CUSTOMER_PK, k)
    applied = table.read().select(F.lit("applied").alias("what"))
    rejected = ST.rejects(spark, table.path).select(F.concat(F.lit("rejected in "), F.col("batch_id").cast("string")).alias("what"))
    return applied.unionByName(rejected).groupBy("what").agg(F.count("*").alias("rows"))


@query("cdc_merge_plans")
def q_cdc_merge_plans(spark, sf):
    """The first batch merged by either plan: its keys broadcast, or one full outer join."""
    c = CU.curated(spark, sf)
    latest = C.prepare(c.change_batches[1], CUSTOMER_PK)
    parts = [C.apply_changes(c.cleansed_states[0], latest, CUSTOMER_PK, broadcast_keys=b).withColumn("broadcast_keys", F.lit(b)) for b in (True, False)]
    return parts[0].unionByName(parts[1])


@query("scd2_two_steps")
def q_scd2_two_steps(spark, sf):
    """Close, then open (D2, D3), run by run: the same dimension as the one-step runs."""
    dim = scd.empty_dim(spark)
    for state, run_ts in zip(CU.curated(spark, sf).cleansed_states, X.RUN_TS):
        src = scd.customer_source(state, unique=True)
        dim = materialize(scd.scd2_open(scd.scd2_close(dim, src, run_ts), src, run_ts), "two-steps")
    return dim


@query("customers_without_version")
def q_customers_without_version(spark, sf):
    """Customers of the last load without a current version among Ontario's."""
    c = CU.curated(spark, sf)
    return scd.without_current(scd.customer_source(c.cleansed_states[3], unique=True), c.dim_customer.where("province = 'ON'"))


# ---- scans, costs, files ------------------------------------------------------

SCANS = [
    ("full", "SELECT line_total FROM {fact}"),
    ("one_month", "SELECT line_total FROM {fact} WHERE order_month = '1998-06'"),
    ("two_scans", "SELECT a.order_id FROM {fact} a LEFT ANTI JOIN {fact} b ON a.order_id = b.order_id AND b.order_month = '1998-06'"),
    ("fails", "SELECT * FROM {fact} WHERE 1 / (order_item_id - order_item_id) > 0"),
    ("not_there", "SELECT no_such_column FROM {fact}"),
]


@query("validation_scans")
def q_validation_scans(spark, sf):
    """What each validation scanned of the fact by month: files, and bytes against the
    files' own sizes."""
    fact = spark.read.parquet(written_fact(spark, sf))
    states = P.run_validations(spark, SCANS, fact=fact)
    whole, month = SC.listed(fact).bytes, SC.listed(fact.where("order_month = '1998-06'")).bytes
    sizes = F.create_map(*[F.lit(x) for x in ("full", whole, "one_month", month, "two_scans", whole + month)])
    return states.select("name", "state", "rows", "scanned_files", (F.col("scanned_bytes") == sizes[F.col("name")]).alias("bytes_match"),
                         (F.col("scanned_bytes") < whole).alias("less_than_full"))


@query("scan_cost")
def q_scan_cost(spark, sf):
    """The newest two of the validations' logged runs, priced."""
    fact, log = spark.read.parquet(written_fact(spark, sf)), scratch_path(spark, "query-log")
    for name_sql in SCANS[:3]:
        P.run_validations(spark, [name_sql], query_log=log, fact=fact)
    logged = spark.read.parquet(log)
    newest = M.scan_cost(logged, 2)
    expected = F.lit(SC.listed(fact).bytes + 2 * SC.listed(fact.where("order_month = '1998-06'")).bytes)
    price = F.round(expected / F.lit(2.0**40) * F.lit(5.0), 6)
    return newest.select("queries", "scanned_files", (F.col("scanned_bytes") - expected).alias("bytes_off"),
                         (F.col("cost_usd") - price).alias("usd_off"))


@query("file_inventory")
def q_file_inventory(spark, sf):
    """Files of the fact by month: of the whole table, of one year and of no month, and
    how far their sizes are from those that an object listing gives."""
    path = written_fact(spark, sf)
    fact, out = spark.read.parquet(path), None
    scopes = (("whole", fact, "*"), ("year_1997", fact.where("order_month LIKE '1997-%'"), "order_month=1997-*"),
              ("nothing", fact.where("order_month = '1066-10'"), None))
    for scope, part, glob in scopes:
        size = T.folder_bytes(spark, f"{path}/{glob}").first()["bytes"] if glob else 0  # one number
        one = T.file_inventory(part).select(F.lit(scope).alias("scope"), "files", "total_mb", "avg_file_mb", F.lit(size / 1024.0**2).alias("mb"))
        out = one if out is None else out.unionByName(one)
    return out.select("scope", "files", (F.col("total_mb") - F.round("mb", 1)).alias("mb_off"),
                      F.when(F.col("files") > 0, F.col("avg_file_mb") - F.round(F.col("mb") / F.col("files"), 2)).alias("avg_off"))


@query("zone_size")
def q_zone_size(spark, sf):
    """Objects of the zone that holds the fact by month (M7), and their bytes against its scan's listing."""
    path = written_fact(spark, sf)
    return M.zone_size(spark, path).select("objects", (F.col("bytes") - F.lit(SC.listed(spark.read.parquet(path)).bytes)).alias("bytes_off"))


@query("csv_round_trip")
def q_csv_round_trip(spark, sf):
    """Order lines written as CSV and loaded back typed."""
    path = scratch_path(spark, "items-csv")
    FI.write_csv(CU.curated(spark, sf).items, path)
    return FI.read_seed_csv(spark, path, "order_items")


@query("full_refresh")
def q_full_refresh(spark, sf):
    """A folder refreshed twice holds the second state only."""
    states, path = CU.curated(spark, sf).cleansed_states, scratch_path(spark, "refreshed")
    for state in (states[0], states[3]):
        FI.load_table(state, path)
    return spark.read.parquet(path)


@query("report_json")
def q_report_json(spark, sf):
    """Rows per curated table as a JSON report, read back."""
    path = scratch_path(spark, "report")
    FI.write_report(M.row_counts(curated_tables(spark, sf)), path)
    return spark.read.schema("table_name string, rows long").json(path)


@query("catalog_partitions")
def q_catalog_partitions(spark, sf):
    """A catalog table made where it is missing, appended to in two steps, repaired
    (S7, S13, S23): rows by partition as the catalog lists them."""
    name, path = f"dates_{uuid.uuid4().hex[:12]}", scratch_path(spark, "dates")
    days = CU.curated(spark, sf).dim_date.select("date_key", "month", F.col("year").cast("string").alias("year"))
    T.ensure_table(spark, name, days.schema, path, ["year"])
    try:
        for odd in (0, 1):
            T.append(days.where(F.col("month") % 2 == odd), path, ["year"])
        T.ensure_table(spark, name, days.schema, path, ["year"])  # there already
        before = spark.table(name).count()
        listed = EV.repair_partitions(spark, name).select(F.split("partition", "=")[1].alias("year"))
        counted = materialize(spark.table(name).groupBy("year").agg(F.count("*").alias("days")), "dates-by-year")
        return materialize(listed.join(counted, "year").withColumn("before_repair", F.lit(before).cast("long")), "dates-listed")
    finally:
        spark.sql(f"DROP TABLE {name}")  # external: the files stay


@query("bucketed_lines")
def q_bucketed_lines(spark, sf):
    """Order lines with their order's status from two tables bucketed by order (S22, J1):
    the join reads its buckets and shuffles nothing."""
    c, tag = CU.curated(spark, sf), uuid.uuid4().hex[:12]
    names = {n: f"{n}_{tag}" for n in ("orders", "items")}
    T.write_bucketed(c.orders.select("order_id", "order_status"), names["orders"], 8, ["order_id"], scratch_path(spark, "orders-bucketed"))
    T.write_bucketed(c.items.select("order_id", "order_item_id", "price"), names["items"], 8, ["order_id"], scratch_path(spark, "items-bucketed"))
    try:
        joined = spark.table(names["items"]).hint("merge").join(spark.table(names["orders"]), "order_id")
        exchanges = joined._jdf.queryExecution().executedPlan().toString().count("Exchange ")
        totals = joined.groupBy("order_status").agg(F.count("*").alias("lines"), F.sum("price").alias("price"))
        return materialize(totals.withColumn("join_exchanges", F.lit(exchanges).cast("long")), "bucketed")
    finally:
        for n in names.values():
            spark.sql(f"DROP TABLE {n}")


# ---- quality ------------------------------------------------------------------


def other_ledger(spark, sf):
    """The order totals of a second source, with differences: small and large ones,
    orders it lacks and orders that only it has."""
    key = F.col("order_id").cast("long")
    lines = CU.curated(spark, sf).items.join(CU.curated(spark, sf).orders.select("order_id"), "order_id")
    totals = lines.groupBy("order_id").agg(F.sum(F.col("price") + F.col("freight_value")).alias("amount"))
    amount = (F.when(key % 40 == 0, F.col("amount") * F.lit("1.01").cast("decimal(5,2)"))
              .when(key % 40 == 1, F.col("amount") * F.lit("1.001").cast("decimal(5,3)")).otherwise(F.col("amount")))
    order = F.when(key % 40 == 3, F.concat(F.lit("only-"), F.col("order_id"))).otherwise(F.col("order_id"))
    return totals.where(key % 40 != 2).select(order.alias("order_id"), amount.cast("decimal(20,4)").alias("amount"))


@query("reconcile_orders")
def q_reconcile_orders(spark, sf):
    """Fact totals by order against the other ledger, within half a percent."""
    found = Q.reconcile(CU.fact(spark, sf), other_ledger(spark, sf), ["order_id"], "line_total", "amount", 0.005)
    return found.groupBy("state").agg(F.count("*").alias("orders"), F.sum("left_sum").cast("decimal(20,2)").alias("fact_total"))


@query("dq_more_rules")
def q_dq_more_rules(spark, sf):
    """Rules that the fact's ruleset leaves out (Q7, Q10), a balance, and one that names
    an unknown column (Q12)."""
    rules = [Q.BetweenExclusive("price", 1000, 50000), Q.NotAfter("order_ts", "1998-06-01 00:00:00"), Q.NotAfter("order_ts", "2030-01-01 00:00:00"),
             Q.Balance(other_ledger(spark, sf), ("order_id",), "line_total", "amount", 0.005), Q.IsComplete("no_such_column")]
    return Q.evaluate(spark, CU.fact(spark, sf), rules).select("rule_index", "outcome", "passed", "observed", "message")


@query("quarantined_lines")
def q_quarantined_lines(spark, sf):
    """Lines with the value rules that they fail (Q14)."""
    rules = [Q.IsComplete("delivered_ts"), Q.BetweenExclusive("price", 1000, 50000), Q.InSet("order_status", ("delivered", "shipped"))]
    rows = Q.quarantine(spark, CU.fact(spark, sf), rules).where(F.size("failed_rules") > 0)
    return rows.select("order_id", "order_item_id", F.size("failed_rules").alias("failures"), F.array_join("failed_rules", "; ").alias("failed"))


@query("suggested_rules")
def q_suggested_rules(spark, sf):
    """Rules that a profile of the fact's own columns suggests (Q15)."""
    return Q.suggest_rules(CU.fact(spark, sf).select("order_id", "delivered_ts", "order_item_id", "delivery_days"))
