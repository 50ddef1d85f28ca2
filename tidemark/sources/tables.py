"""Table writes on plain files.

Plain Parquet has no row-level MERGE and cannot be overwritten while it is
being read, so a table is a folder of *versions*: every replace writes a new
``v000001``-style folder, and a version becomes visible only when its
``_PUBLISHED`` marker is written (after the quality gate, if any).  Readers
take the newest published version.  No file is renamed or moved.

File-system calls go through Hadoop's FileSystem API, so the same code runs
on a local disk, HDFS or an object store.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PUBLISHED = "_PUBLISHED"


# ---- Hadoop file-system helpers -------------------------------------------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def folder_state(spark: SparkSession, path: str) -> tuple:
    """Name, size and time of everything that lies directly in a folder."""
    fs, p = _fs(spark, path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)))


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


# ---- catalog tables -------------------------------------------------------
def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_table(spark: SparkSession, name: str, schema: StructType, path: str,
                 partition_by: Sequence[str] = (), fmt: str = "parquet") -> DataFrame:
    """CREATE TABLE IF NOT EXISTS with an explicit schema and location."""
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {name} ({cols}) USING {fmt}{part} LOCATION '{path}'")
    return spark.table(name)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """INSERT INTO ... SELECT on files."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, name: str, n: int, cols: Sequence[str], path: str | None = None) -> None:
    """Bucketed table (S22): later joins on ``cols`` between tables bucketed
    the same way need no shuffle."""
    w = df.write.mode("overwrite").bucketBy(n, *cols).sortBy(*cols)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


# ---- versioned tables -------------------------------------------------------
class VersionedTable:
    """A folder of immutable versions; the newest published one is current."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)

    def versions(self) -> list[str]:
        return [d for d in list_dirs(self.spark, self.path) if d.startswith("v") and d[1:].isdigit()]

    def published(self) -> list[str]:
        return [v for v in self.versions() if exists(self.spark, f"{self.path}/{v}/{PUBLISHED}")]

    def current_path(self) -> str | None:
        pub = self.published()
        return f"{self.path}/{pub[-1]}" if pub else None

    def exists(self) -> bool:
        return self.current_path() is not None

    def read(self) -> DataFrame:
        cur = self.current_path()
        if cur is None:
            raise FileNotFoundError(f"no published version under {self.path}")
        return self.spark.read.parquet(cur)

    def stage(self, df: DataFrame) -> str:
        """Write a new, not yet visible version; returns its folder."""
        return self.stage_parts([df])

    def stage_parts(self, parts: Iterable[DataFrame]) -> str:
        """``stage`` of a version that is computed and written part by part."""
        n = int(self.versions()[-1][1:]) + 1 if self.versions() else 1
        target = f"{self.path}/v{n:06d}"
        for k, df in enumerate(parts):
            w = df.write.mode("append" if k else "error")
            if self.partition_by:
                w = w.partitionBy(*self.partition_by)
            w.parquet(target)
        return target

    def publish(self, staged: str) -> None:
        touch(self.spark, f"{staged}/{PUBLISHED}")

    def expire(self, keep: int) -> None:
        """Remove all published versions but the newest ``keep``; who still reads an
        older one fails."""
        for v in self.published()[:-keep]:
            discard(self.spark, f"{self.path}/{v}")

    def replace(self, df: DataFrame) -> str:
        """Create-or-replace (S8): stage, then publish."""
        staged = self.stage(df)
        self.publish(staged)
        return staged


def partition_folder(spark: SparkSession, path: str, col: str, value) -> str:
    """The folder of one partition value as Spark's writers name it (NULL and
    special characters included)."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{path.rstrip('/')}/{utils.getPartitionPathString(col, None if value is None else str(value))}"


def partition_sizes(spark: SparkSession, path: str, col: str, values: Sequence) -> list[int]:
    """Bytes of the files of each partition value, 0 where there is none."""
    out = []
    for v in values:
        fs, p = _fs(spark, partition_folder(spark, path, col, v))
        out.append(fs.getContentSummary(p).getLength() if fs.exists(p) else 0)
    return out


def merge_into_partitions(spark: SparkSession, path: str, latest: DataFrame, keys: Sequence[str], part_col: str,
                          ignore_stale: bool = False, rows_move: bool = True, observe=None) -> DataFrame:
    """Apply latest changes (with ``Op``) to a partitioned Parquet folder,
    rewriting only the touched partitions (C3/C4 on plain files).

    Touched = the partitions of the incoming rows plus, where rows can move,
    the partitions in which their keys live today, so a row whose partition
    value changed leaves its old partition; with ``rows_move=False`` (the
    partition is a function of the key) the table is not searched for them.
    NULL is a partition like any other.  The new content is first written to
    the shared work folder (a table cannot be overwritten while it is read),
    then swapped in with dynamic partition overwrite, set on the writer so that
    concurrent merges do not see each other's mode; a touched partition left
    with no rows is removed.  Re-running the same changes converges to the
    same table, which is what makes a retry after a failure mid-way safe; plain
    files give no multi-partition atomicity.  ``observe`` takes the merge's counts
    (see ``apply_changes``).  Returns the touched values."""
    from tidemark.operators.changes import apply_changes
    from tidemark.session import materialize

    target = spark.read.parquet(path)
    latest = materialize(latest, "latest")  # read for the touched values, their keys and the merge
    parts = latest.select(F.col(part_col).cast(target.schema[part_col].dataType).alias(part_col))
    if rows_move:
        parts = parts.unionByName(target.join(latest.select(*keys).distinct(), list(keys), "left_semi").select(part_col))
    touched = materialize(parts.distinct(), "touched")
    values = [r[0] for r in touched.collect()]  # bounded by the touched partitions; prunes the scan
    affected = target.where(in_partitions(part_col, values))
    new_rows = materialize(apply_changes(affected, latest, keys, ignore_stale, observe=observe), "merged")
    (new_rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col).parquet(path))
    left = {r[0] for r in new_rows.select(part_col).distinct().collect()}
    for v in values:
        if v not in left:
            delete_partition(spark, path, part_col, v)
    return touched


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                      part_col: str) -> DataFrame:
    """Full-row upsert (no deletes) that rewrites only the touched partitions (C4)."""
    target_cols = spark.read.parquet(path).columns
    latest = source.select(*target_cols).withColumn("Op", F.lit("U"))
    return merge_into_partitions(spark, path, latest, keys, part_col)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Stable bucket of a key (a function of the key only, so rows never move)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def in_partitions(part_col: str, values: Sequence) -> Column:
    """The rows of these partitions, NULL among them or not; prunes the scan."""
    here = F.coalesce(F.col(part_col).isin([v for v in values if v is not None]), F.lit(False))
    return here | F.col(part_col).isNull() if None in values else here


def delete_partition(spark: SparkSession, path: str, part_col: str, value) -> None:
    discard(spark, partition_folder(spark, path, part_col, value))


def write_fact(df: DataFrame, path: str, part_col: str = "order_month", mode: str = "error", dynamic: bool = False,
               sort: Sequence[str] = ()) -> None:
    """Month-partitioned fact write (S9).  ``rebalance`` on the partition
    column gives about one file per month per advisory size: adaptive
    execution splits a month holding much of the data over several tasks and
    merges small months, instead of every task writing a file per month.
    ``dynamic`` overwrites only the partitions that ``df`` has rows of; ``sort``: the
    order of rows in a file (like rows beside each other take less disk)."""
    rows = df.hint("rebalance", part_col)
    if sort:
        rows = rows.sortWithinPartitions(part_col, *sort)
    (rows.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy(part_col).parquet(path))


# ---- file inventory and compaction ------------------------------------------
def file_inventory(df: DataFrame) -> DataFrame:
    """Data files behind a file-based DataFrame (S16): count, total MB (1 dp),
    average MB (2 dp), NULL for none.

    From the scan's own listing after partition pruning, so a filter on partition
    columns lists only what it would read; neither a row nor a footer is read."""
    from tidemark.sources.scans import listed
    found, mb = listed(df), F.lit(1024.0 * 1024.0)
    row = df.sparkSession.createDataFrame([(found.files, found.bytes)], "files long, bytes long")
    return row.select("files", F.round(F.col("bytes") / mb, 1).alias("total_mb"),
                      F.when(F.col("files") > 0, F.round(F.col("bytes") / mb / F.col("files"), 2)).alias("avg_file_mb"))


def folder_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Object count and bytes under a folder (M7); the listing reads no content."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "length"))
    return files.agg(F.count("*").alias("objects"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def compact(spark: SparkSession, path: str, out: str, target_mb: int = 128,
            partition_by: Sequence[str] = ()) -> DataFrame:
    """Bin-pack small files (S17) into a new folder.

    The ``rebalance`` hint lets adaptive execution cut the data into
    partitions of about ``target_mb`` each (splitting a large partition value
    over several tasks, merging small ones) instead of one task per value."""
    from tidemark.session import apply_core_conf
    # a session of its own, so that no other query runs under its partition size
    own = spark.newSession()
    apply_core_conf(own)
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_mb * 1024 * 1024))
    df = own.read.parquet(path)
    packed = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    w = packed.write.mode("error")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(out)
    return spark.read.parquet(out)


def replace_table(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Create-or-replace (S8): a new version folder that becomes current."""
    return VersionedTable(spark, path, partition_by).replace(df)
