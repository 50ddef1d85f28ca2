"""Table profiles.

One profile = one aggregate for the null counts plus one grouped aggregate for
duplicate rows (NULL equals NULL there, as in a row comparison); all tables of a
folder share both.  The worst null column is chosen inside Spark (first column on
ties); no loop of jobs over columns or files and nothing collected.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import round_ratio
from tidemark.operators.relational import maybe_broadcast
from tidemark.session import materialize

PROFILE_SCHEMA = ("table string, rows long, columns int, duplicate_rows long, "
                  "worst_null_col string, worst_null_pct decimal(18,2)")


def null_counts(df: DataFrame) -> DataFrame:
    """One row: ``_rows`` and the NULL count of every column."""
    return df.agg(F.count("*").alias("_rows"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}") for i, c in enumerate(df.columns)])


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows (A17), as one row ``duplicate_rows``.

    Exact, in two steps so that wide rows are not shuffled whole: a 64-bit
    row hash is counted first (8 bytes per row cross the network), and only
    rows whose hash occurs more than once are grouped on all their columns.
    Copies of one row combine map-side, so a group of copies holding a large
    share of the table is never one task's input."""
    if not df.columns:
        return df.sparkSession.createDataFrame([(0,)], "duplicate_rows long")
    cols = [F.col(f"`{c}`") for c in df.columns]
    # a NULL mask makes the hash tell (NULL, x) from (x, NULL); the exact
    # grouping below settles any remaining collision
    mask = F.concat_ws("", *[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    hashed = df.withColumn("_h", F.xxhash64(*cols, mask))
    repeated = hashed.groupBy("_h").agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select("_h")
    # written once, so its real size decides the join: a small set of repeated
    # hashes is broadcast and no full row is shuffled for the filter
    repeated = maybe_broadcast(materialize(repeated, "repeated_hashes"))
    candidates = hashed.join(repeated, "_h", "left_semi").drop("_h")
    per_row = candidates.groupBy(*cols).agg(F.count("*").alias("_n"))
    return per_row.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def _nulls(df: DataFrame, name: str) -> DataFrame:
    """rows, columns, worst NULL column and its percent of one table, one pass."""
    cols = df.columns
    nulls = null_counts(df)
    if cols:
        cands = F.array(*[F.struct(F.col(f"_null_{i}").alias("n"), F.lit(-i).alias("neg_idx"),
                                   F.lit(c).alias("name")) for i, c in enumerate(cols)])
        worst = F.array_max(cands)
        worst_name, worst_n = worst["name"], worst["n"]
    else:
        worst_name, worst_n = F.lit(None).cast("string"), F.lit(0).cast("long")
    pct = round_ratio(worst_n * 100, F.greatest(F.col("_rows"), F.lit(1)), 2)
    return nulls.select(
        F.lit(name).alias("table"), F.col("_rows").cast("long").alias("rows"),
        F.lit(len(cols)).cast("int").alias("columns"), F.lit(None).cast("long").alias("duplicate_rows"),
        worst_name.alias("worst_null_col"),
        F.coalesce(pct, F.lit(0).cast("decimal(18,2)")).alias("worst_null_pct"))


def _hashed(df: DataFrame, name: str) -> DataFrame:
    """table, row (every value as text, NULLs kept) and a 64-bit hash of it."""
    whole = F.array(*[F.hex(f"`{f.name}`") if f.dataType.typeName() == "binary" else F.col(f"`{f.name}`").cast("string")
                      for f in df.schema.fields]).cast("array<string>")
    row = df.select(whole.alias("row"))
    mask = F.array_join(F.transform("row", lambda x: F.when(x.isNull(), "1").otherwise("0")), "")
    return row.select(F.lit(name).alias("table"), "row", F.xxhash64("row", mask).alias("h"))


def profile_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    """rows, columns, duplicate rows, worst NULL column and its percent of every
    table (X1), all tables in one plan.

    Duplicates are found for all tables together: row hashes of every table are
    counted in one aggregate (8 bytes a row cross the network, copies combine
    map-side), the repeated ones are written once, and only their rows are compared
    whole.  What runs is two jobs, however many tables there are."""
    heads = hashes = None
    for name, df in tables.items():
        head, hashed = _nulls(df, name), _hashed(df, name)
        heads = head if heads is None else heads.unionByName(head)
        hashes = hashed if hashes is None else hashes.unionByName(hashed)
    repeated = hashes.groupBy("table", "h").agg(F.count("*").alias("n")).where("n > 1").select("table", "h")
    repeated = maybe_broadcast(materialize(repeated, "repeated_hashes"))
    copies = (hashes.join(repeated, ["table", "h"], "left_semi").groupBy("table", "row").agg(F.count("*").alias("n"))
              .groupBy("table").agg(F.sum(F.col("n") - 1).alias("more")))
    more = copies.select("table", F.lit(None).cast("long").alias("rows"), F.lit(None).cast("int").alias("columns"),
                         F.col("more").cast("long").alias("duplicate_rows"), F.lit(None).cast("string").alias("worst_null_col"),
                         F.lit(None).cast("decimal(18,2)").alias("worst_null_pct"))
    both = heads.unionByName(more).groupBy("table").agg(
        *[F.max(c).alias(c) for c in ("rows", "columns", "duplicate_rows", "worst_null_col", "worst_null_pct")])
    return both.select("table", "rows", "columns", F.coalesce("duplicate_rows", F.lit(0)).cast("long").alias("duplicate_rows"),
                       "worst_null_col", "worst_null_pct")


def profile(df: DataFrame, name: str) -> DataFrame:
    """The profile of one table."""
    return profile_all({name: df})


def profile_dir(spark: SparkSession, path: str) -> DataFrame:
    """Every ``*.csv`` and every ``*.parquet`` of a folder, one profile each, CSV files
    first and by name (X2).  CSV files are read with a header, all strings; of two
    files that differ only in their ending each is profiled.  All files are profiled
    in one plan (see ``profile_all``)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    files = [n for n in names if n.endswith(".csv")] + [n for n in names if n.endswith(".parquet")]
    if not files:
        return spark.createDataFrame([], PROFILE_SCHEMA)
    tables = {}
    for i, n in enumerate(files):
        full = f"{path.rstrip('/')}/{n}"
        # records may hold line breaks and doubled quotes inside quotes
        tables[f"{i:06d} {n.rsplit('.', 1)[0]}"] = (
            spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(full)
            if n.endswith(".csv") else spark.read.parquet(full))
    return profile_all(tables).orderBy("table").withColumn("table", F.substring("table", 8, 1 << 30))


def null_pct(df: DataFrame) -> DataFrame:
    """NULL percent of every column, 2 dp, in one aggregate."""
    one = null_counts(df)
    rows = F.greatest(F.col("_rows"), F.lit(1))
    return one.select(*[round_ratio(F.col(f"_null_{i}") * 100, rows, 2).alias(c) for i, c in enumerate(df.columns)])
