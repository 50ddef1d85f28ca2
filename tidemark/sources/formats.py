"""Format and compression size report.

The same DataFrame is written as CSV, gzip CSV, gzip JSON lines, Snappy
Parquet, ORC and (when the Avro module is on the classpath) deflate Avro;
sizes come from a ``binaryFile`` listing that reads no file content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.cleanse import lenient_timestamps

# Fixed values: (label, writer format, options) of each variant; CSV first
# because the others are reported as a share of it.
FORMATS = [
    ("csv", "csv", {"header": "true"}),
    ("csv_gz", "csv", {"header": "true", "compression": "gzip"}),
    ("json_gz", "json", {"compression": "gzip"}),
    ("parquet", "parquet", {"compression": "snappy"}),
    ("orc", "orc", {"compression": "snappy"}),
    ("avro", "avro", {"compression": "deflate"}),
]


def format_available(spark: SparkSession, fmt: str) -> bool:
    """Whether a data source can be resolved (Avro is an optional module)."""
    try:
        spark.sparkContext._jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource(
            fmt, spark._jsparkSession.sessionState().conf())
        return True
    except Exception:  # noqa: BLE001 - the module is optional
        return False


def format_sizes(df: DataFrame, out_dir: str, report_path: str | None = None) -> DataFrame:
    """Write every variant under ``out_dir/<label>`` and report
    ``(format, bytes, pct_of_csv)``; unavailable formats get NULL bytes.

    ``df`` is computed once, for the Parquet variant; the others are written from it."""
    spark = df.sparkSession
    root = out_dir.rstrip("/")
    label, fmt, opts = next(f for f in FORMATS if f[1] == "parquet")
    lenient_timestamps(df).write.mode("error").format(fmt).options(**opts).save(f"{root}/{label}")
    data = spark.read.format(fmt).load(f"{root}/{label}")
    parts = []
    for label, fmt, opts in FORMATS:
        path = f"{root}/{label}"
        if not format_available(spark, fmt):
            parts.append(spark.createDataFrame([(label, None)], "format string, bytes long"))
            continue
        if fmt != "parquet":
            data.write.mode("error").format(fmt).options(**opts).save(path)
        files = spark.read.format("binaryFile").load(path).select("length")
        parts.append(files.agg(F.sum("length").alias("bytes")).select(F.lit(label).alias("format"), "bytes"))
    sizes = parts[0]
    for p in parts[1:]:
        sizes = sizes.unionByName(p)
    # The report has one row per format: a window over it is a handful of rows.
    csv_bytes = F.max(F.when(F.col("format") == "csv", F.col("bytes"))).over(Window.partitionBy())
    report = sizes.select("format", "bytes", F.round(F.col("bytes") * 100.0 / csv_bytes, 1).alias("pct_of_csv"))
    if report_path:
        from tidemark.sources.files import write_report
        write_report(report, report_path)
    return report


def read_back(spark: SparkSession, out_dir: str) -> DataFrame:
    """``(format, rows, listed_bytes)`` of every variant that was written."""
    from tidemark.sources.scans import listed
    out = None
    for label, fmt, opts in FORMATS:
        if format_available(spark, fmt):
            data = spark.read.format(fmt).options(**opts).load(f"{out_dir.rstrip('/')}/{label}")
            one = data.agg(F.count("*").alias("rows")).select(
                F.lit(label).alias("format"), "rows", F.lit(listed(data).bytes).cast("long").alias("listed_bytes"))
            out = one if out is None else out.unionByName(one)
    return out
