"""Raw JSON events in a non-Hive folder tree ``<type>/<yyyy>/<MM>/<dd>/<HH>/``
and the four ways to find them (S10-S15, P10).

* flat: read the whole tree with an explicit schema (every file, always);
* path columns: derive ``event_type, y, m, d, h`` from each file's path;
* registered partitions: a catalog table whose partitions are added one by
  one with explicit locations (unregistered folders are invisible; a repair
  only discovers ``key=value`` folders, so it finds nothing here);
* projection: enumerate partition values from enums and padded integer
  ranges, prune them by the wanted values, render one pattern from a template and
  read only the folders that exist (data outside the ranges is invisible).
The optimised copy is Snappy Parquet partitioned by ``event_type``.
"""

from __future__ import annotations

import gzip
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from tidemark.sources.tables import exists

EVENT_SCHEMA = StructType([
    StructField("event_id", StringType()),
    StructField("event_type", StringType()),
    StructField("store_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("product_id", StringType()),
    StructField("quantity", IntegerType()),
    StructField("amount", DoubleType()),
    StructField("event_time", StringType()),
    StructField("ingest_time", StringType()),
    StructField("late", BooleanType()),
])
PART_COLS = ["event_type", "y", "m", "d", "h"]
# The landing path layout and its pattern.
PATH_TEMPLATE = "${event_type}/${y}/${m}/${d}/${h}"
PATH_PATTERN = r"/([^/]+)/(\d{4})/(\d{2})/(\d{2})/(\d{2})/[^/]+$"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark itself takes it for."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub(r"^file:/+", "file:///", fs.makeQualified(p).toString())


def land_events(df: DataFrame, root: str) -> DataFrame:
    """Write events as gzip JSON lines under ``root/<type>/<yyyy>/<MM>/<dd>/<HH>/``.

    Stands in for the stream producer: every task writes its own small files
    for the hours it holds (no shuffle, so a hot hour is never one task).
    File names are fixed per input split and each file is written under a
    temporary name and then moved into place, so task retries replace their
    own output instead of duplicating events.  Executors write through
    Arrow's file-system layer (``file:``, ``s3://``, ``hdfs://``); a path without a
    scheme is on the session's default file system.
    Returns one row with the number of files and rows written."""
    cols = [f.name for f in EVENT_SCHEMA.fields]
    uri = qualified(df.sparkSession, root)

    def write(batches):
        import pandas as pd
        from pyarrow import fs as pafs
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid, attempt = ctx.partitionId(), ctx.attemptNumber()
        fs, base = pafs.FileSystem.from_uri(uri)
        files = rows = 0
        for b, pdf in enumerate(batches):
            for key, g in pdf.groupby(PART_COLS, sort=False):
                folder = "/".join([base.rstrip("/"), *key])
                fs.create_dir(folder, recursive=True)
                name = f"part-{pid:05d}-{b:04d}.json.gz"
                tmp = f"{folder}/.{name}.{attempt}-{uuid.uuid4().hex}.tmp"
                body = g[cols].to_json(orient="records", lines=True, double_precision=15)
                with fs.open_output_stream(tmp) as out:
                    out.write(gzip.compress(body.encode("utf-8")))
                fs.move(tmp, f"{folder}/{name}")
                files += 1
                rows += len(g)
        yield pd.DataFrame({"files": [files], "rows": [rows]})

    return (df.select(*cols, *PART_COLS[1:])
            .mapInPandas(write, "files long, rows long")
            .agg(F.sum("files").alias("files"), F.sum("rows").alias("rows")))


def read_events_flat(spark: SparkSession, root: str) -> DataFrame:
    """Every object under the root, explicit schema."""
    return spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").json(root)


def with_path_columns(df: DataFrame) -> DataFrame:
    """Partition columns from a non-``key=value`` path."""
    p = F.col("_metadata.file_path")
    out = df.drop("event_type")
    for i, c in enumerate(PART_COLS, start=1):
        out = out.withColumn(c, F.regexp_extract(p, PATH_PATTERN, i))
    return out


def read_events_paths(spark: SparkSession, root: str) -> DataFrame:
    return with_path_columns(read_events_flat(spark, root))


# ---- registered partitions (catalog) ------------------------------------------
def create_events_table(spark: SparkSession, name: str, root: str) -> None:
    """External JSON table partitioned by (event_type, y, m, d, h); nothing is
    registered yet, so it returns zero rows, not an error."""
    data = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields if f.name != "event_type")
    parts = ", ".join(f"{c} string" for c in PART_COLS)
    spark.sql(f"CREATE TABLE {name} ({data}, {parts}) USING json PARTITIONED BY ({', '.join(PART_COLS)}) "
              f"LOCATION '{root}'")


def add_partitions(spark: SparkSession, name: str, specs: Sequence[Mapping[str, str]], root: str) -> None:
    """Targeted registration with explicit locations (no listing of the root)."""
    clauses = []
    for spec in specs:
        kv = ", ".join(f"{c}='{spec[c]}'" for c in PART_COLS)
        loc = render(PATH_TEMPLATE, spec)
        clauses.append(f"PARTITION ({kv}) LOCATION '{root.rstrip('/')}/{loc}'")
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(clauses))


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")


def repair_partitions(spark: SparkSession, name: str) -> DataFrame:
    """Discovers ``key=value`` folders only: finds nothing in this layout."""
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return show_partitions(spark, name)


# ---- projection -------------------------------------------------------------------
def render(template: str, values: Mapping[str, str]) -> str:
    return re.sub(r"\$\{(\w+)\}", lambda m: str(values[m.group(1)]), template)


def projected_partitions(spark: SparkSession, enums: Mapping[str, Sequence[str]],
                         ranges: Mapping[str, tuple[int, int, int]],
                         wanted: Mapping[str, str] | None = None, order: Sequence[str] = PART_COLS) -> DataFrame:
    """Enumerate partition values: enums as given, integer ranges ``(lo, hi,
    digits)`` zero-padded.  Each dimension is pruned by ``wanted`` as soon as
    it is generated, so only the wanted combinations are ever built."""
    wanted = wanted or {}
    spec = spark.range(1).select()
    for c in order:
        if c in enums:
            spec = spec.select("*", F.explode(F.array(*[F.lit(v) for v in enums[c]])).alias(c))
        else:
            lo, hi, digits = ranges[c]
            spec = (spec.select("*", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("_v"))
                    .withColumn(c, F.lpad(F.col("_v").cast("string"), digits, "0")).drop("_v"))
        if c in wanted:
            spec = spec.where(F.col(c) == F.lit(wanted[c]))
    return spec


def projected_glob(enums: Mapping[str, Sequence[str]], ranges: Mapping[str, tuple[int, int, int]],
                   wanted: Mapping[str, str] | None = None, template: str = PATH_TEMPLATE) -> str | None:
    """The declared, wanted partitions as one glob pattern: the values of each
    dimension side by side, not their combinations.  None: a dimension has no value."""
    def quoted(v):
        return re.sub(r"([\\{}\[\]*?,])", r"\\\1", str(v))

    parts = {}
    for c in re.findall(r"\$\{(\w+)\}", template):
        if c in enums:
            values = [str(v) for v in enums[c]]
        else:
            lo, hi, digits = ranges[c]
            values = [str(v).zfill(digits) for v in range(lo, hi + 1)]
        values = [v for v in values if c not in (wanted or {}) or v == str(wanted[c])]
        if not values:
            return None
        parts[c] = "{" + ",".join(quoted(v) for v in values) + "}"
    return render(template, parts)


def projected_folders(spark: SparkSession, root: str, pattern: str | None) -> list[str]:
    """The folders that match: the file system walks the pattern level by level and
    lists only what exists, so the cost is that of the folders there are, whatever
    the declared ranges span."""
    if pattern is None:
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{pattern}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return [s.getPath().toString() for s in found] if found else []


def read_projected(spark: SparkSession, root: str, enums: Mapping[str, Sequence[str]],
                   ranges: Mapping[str, tuple[int, int, int]], wanted: Mapping[str, str] | None = None,
                   template: str = PATH_TEMPLATE) -> DataFrame:
    """Read only the projected, wanted, existing folders.

    Folders are found by one pattern over the declared values; Spark lists the files
    in them as a distributed job where there are many."""
    present = projected_folders(spark, root, projected_glob(enums, ranges, wanted, template))
    if not present:
        empty = spark.createDataFrame([], EVENT_SCHEMA).drop("event_type")
        for c in PART_COLS:
            empty = empty.withColumn(c, F.lit(None).cast("string"))
        return empty
    df = spark.read.schema(EVENT_SCHEMA).json(present)
    return with_path_columns(df)


def existing_paths(spark: SparkSession, root: str, paths: Sequence[str]) -> list[str]:
    """Probe folders level by level: a missing prefix drops its whole subtree
    with one call, so projected ranges far from the data cost little."""
    base = root.rstrip("/")
    rel = [p[len(base) + 1:].split("/") for p in paths]
    alive = {()}
    depth = max((len(r) for r in rel), default=0)
    for k in range(1, depth + 1):
        cands = {tuple(r[:k]) for r in rel if tuple(r[:k - 1]) in alive}
        alive = {c for c in cands if exists(spark, base + "/" + "/".join(c))}
    return [p for p, r in zip(paths, rel) if tuple(r) in alive]


def optimize_events(df: DataFrame, out: str) -> DataFrame:
    """CTAS to Snappy Parquet partitioned by event_type with a parsed
    timestamp (S15).  ISO-8601 text with 'Z' or an offset parses; anything
    else becomes NULL."""
    typed = df.select("event_id", "store_id", "customer_id", "product_id", "quantity", "amount",
                      F.expr("try_cast(event_time AS timestamp)").alias("event_ts"), "late", "event_type")
    typed.write.mode("error").partitionBy("event_type").option("compression", "snappy").parquet(out)
    return df.sparkSession.read.parquet(out)


def events_by_type(events: DataFrame, day: dict[str, str]) -> DataFrame:
    """Events per type in one day (A15): ``day`` holds y, m, d path values."""
    out = events
    for k, v in day.items():
        out = out.where(F.col(k) == v)
    return out.groupBy("event_type").agg(F.count("*").alias("events"))
