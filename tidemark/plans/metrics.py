"""Health metrics as DataFrames (M1-M8).

Each metric is computed where the data lives and returned as rows of the
metric record ``(metric, value, unit, dims, measured_at)``, ready to be
appended to a metrics table.  Nothing is looked up by "latest execution".
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scan price, USD per 2^40 bytes.
USD_PER_TIB = 5.0
TIB = float(2 ** 40)


def metric(name: str, value: Column, unit: str, dims: Mapping[str, Column | str] | None = None,
           measured_at: str | None = None) -> Column:
    """One metric record as a struct column (M8)."""
    d = dims or {}
    dim_map = (F.create_map(*[x for k, v in d.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v))])
               if d else F.create_map().cast("map<string,string>"))
    at = F.lit(measured_at).cast("timestamp") if measured_at else F.current_timestamp()
    return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"),
                    F.lit(unit).alias("unit"), dim_map.alias("dims"), at.alias("measured_at"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and the total (M1, U1): one count per table, unioned."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_total(counts: DataFrame) -> DataFrame:
    total = counts.agg(F.sum("rows").alias("rows")).select(F.lit("TOTAL").alias("table_name"), "rows")
    return counts.unionByName(total)


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key finds no dimension row (M3, J6); a NULL key counts."""
    d = dim.select(F.col(dim_key or key).alias(key)).distinct()
    return fact.join(d, key, "left_anti").agg(F.count("*").alias("orphan_rows"))


def latest_score(rule_log: DataFrame) -> DataFrame:
    """Score of the newest evaluation in a rule-result log (M4):
    ``rule_log(run_id, evaluated_at, rule, passed)``."""
    per_run = rule_log.groupBy("run_id").agg(
        F.max("evaluated_at").alias("at"), (F.avg(F.col("passed").cast("double")) * 100).alias("score_pct"),
        F.count_if(~F.col("passed")).alias("failed_rules"))
    newest = per_run.agg(F.max_by(F.struct("run_id", "score_pct", "failed_rules"),
                                  F.struct("at", "run_id")).alias("r"))
    return newest.select("r.*")


def freshness(run_log: DataFrame, now: str) -> DataFrame:
    """Minutes since the last successful run and its duration in seconds (M5):
    ``run_log(run_id, outcome, started_at, finished_at)``."""
    ok = run_log.where(F.col("outcome") == "ok")
    last = ok.agg(F.max_by(F.struct("started_at", "finished_at", "run_id"),
                           F.struct("finished_at", "run_id")).alias("r"))
    now_c = F.lit(now).cast("timestamp")
    return last.select(
        F.col("r.run_id").alias("run_id"),
        F.timestamp_diff("MINUTE", F.col("r.finished_at"), now_c).alias("minutes_since_success"),
        F.timestamp_diff("SECOND", F.col("r.started_at"), F.col("r.finished_at")).alias("duration_seconds"),
    )


def scan_cost(query_log: DataFrame, last_n: int = 50, usd_per_tib: float = USD_PER_TIB) -> DataFrame:
    """Bytes scanned and their price over the newest ``last_n`` queries (M6):
    ``query_log(query_id, submitted_at, scanned_bytes)``, as ``run_validations``
    writes it; a failed query scanned an unknown number of bytes and counts 0."""
    newest = query_log.orderBy(F.col("submitted_at").desc(), F.col("query_id").desc()).limit(last_n)
    return newest.agg(
        F.count("*").alias("queries"),
        F.coalesce(F.sum("scanned_bytes"), F.lit(0)).cast("long").alias("scanned_bytes"),
        *([F.coalesce(F.sum("scanned_files"), F.lit(0)).cast("long").alias("scanned_files")] if "scanned_files" in query_log.columns else []),
    ).withColumn("cost_usd", F.round(F.col("scanned_bytes") / F.lit(TIB) * F.lit(usd_per_tib), 6))


def health_metrics(fact: DataFrame, dims: Mapping[str, DataFrame], dim_customer: DataFrame,
                   measured_at: str) -> DataFrame:
    """Row counts per table, versioned customers and orphan fact rows as
    metric records (M1-M3 in the M8 shape)."""
    parts = []
    for name, df in {"fact_order_item": fact, **dims}.items():
        parts.append(df.agg(metric("CuratedRowCount", F.count("*"), "Count", {"Table": name}, measured_at).alias("m")))
    versioned = dim_customer.groupBy("customer_id").count().where(F.col("count") > 1)
    parts.append(versioned.agg(metric("Scd2VersionedCustomers", F.count("*"), "Count", None, measured_at).alias("m")))
    orphan = orphans(fact, dim_customer, "customer_key")
    parts.append(orphan.select(metric("OrphanFactRows", F.col("orphan_rows"), "Count", None, measured_at).alias("m")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("m.*")


def all_metrics(spark, fact: DataFrame, dims: Mapping[str, DataFrame], dim_customer: DataFrame,
                measured_at: str, rule_log: DataFrame | None = None, run_log: DataFrame | None = None,
                query_log: DataFrame | None = None, zone: str | None = None) -> DataFrame:
    """Every health metric as metric records (M1-M8): row counts, versioned
    customers, orphans, and - when their inputs are given - the latest quality
    score and failed rules, freshness and run duration, bytes scanned and
    their price, and the object count and bytes of a storage zone."""
    out = health_metrics(fact, dims, dim_customer, measured_at)
    extra = []
    if rule_log is not None:
        s = latest_score(rule_log)
        extra.append(s.select(F.explode(F.array(
            metric("DataQualityScore", F.col("score_pct"), "Percent", None, measured_at),
            metric("DataQualityRulesFailed", F.col("failed_rules"), "Count", None, measured_at))).alias("m")))
    if run_log is not None:
        f = freshness(run_log, measured_at)
        extra.append(f.select(F.explode(F.array(
            metric("MinutesSinceLastRefresh", F.col("minutes_since_success"), "Count", None, measured_at),
            metric("PipelineDurationSeconds", F.col("duration_seconds"), "Seconds", None, measured_at))).alias("m")))
    if query_log is not None:
        c = scan_cost(query_log)
        extra.append(c.select(F.explode(F.array(
            metric("BytesScanned", F.col("scanned_bytes"), "Bytes", None, measured_at),
            metric("EstimatedCostUSD", F.col("cost_usd"), "None", None, measured_at))).alias("m")))
    if zone is not None:
        from tidemark.sources.tables import folder_bytes
        z = folder_bytes(spark, zone)
        extra.append(z.select(F.explode(F.array(
            metric("ZoneObjectCount", F.col("objects"), "Count", {"Zone": zone}, measured_at),
            metric("ZoneBytes", F.col("bytes"), "Bytes", {"Zone": zone}, measured_at))).alias("m")))
    for e in extra:
        out = out.unionByName(e.select("m.*"))
    return out


def zone_size(spark, path: str) -> DataFrame:
    """Object count and bytes of a storage zone (M7); reads no file content."""
    from tidemark.sources.tables import folder_bytes
    return folder_bytes(spark, path)
