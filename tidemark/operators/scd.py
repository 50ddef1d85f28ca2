"""Type 2 customer dimension.

Each run takes the current source snapshot and a ``run_ts``:
  * versions whose tracked attributes changed are closed at ``run_ts``;
  * changed and brand-new customers get a version opening at ``run_ts``;
  * a customer missing from the source keeps its current version (parity),
    or is closed / removed with ``on_source_delete``.
One ``run_ts`` is used for both the close and the open, so consecutive
versions meet exactly: ``valid_to(old) == valid_from(new)``.

Only current versions are shuffled (history rows pass through untouched), and
the number of versions per customer is bounded by the number of runs, which is
what keeps the per-key work of the as-of join bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampType

from tidemark.functions.exprs import attr_hash, surrogate_key
from tidemark.operators.relational import dedupe, where_key_in, worth_broadcasting_keys
from tidemark.session import materialize

DIM_CUSTOMER_SCHEMA = StructType([
    StructField("customer_key", StringType()),
    StructField("customer_id", StringType()),
    StructField("customer_city", StringType()),
    StructField("province", StringType()),
    StructField("postal_prefix", StringType()),
    StructField("attr_hash", StringType()),
    StructField("valid_from", TimestampType()),
    StructField("valid_to", TimestampType()),
    StructField("is_current", BooleanType()),
])
TRACKED = ("customer_city", "province", "postal_prefix")


def customer_source(cleansed_customers: DataFrame, unique: bool = False) -> DataFrame:
    """Renamed customer attributes, one row per id, with the attribute hash.

    ``unique=True`` skips the de-duplication (one aggregate, i.e. one shuffle)
    for input known to hold one row per id, such as a table maintained by
    ``apply_changes``."""
    s = cleansed_customers.select(
        F.col("customer_id"),
        F.col("customer_city"),
        F.col("customer_state").alias("province"),
        F.col("customer_zip_code_prefix").alias("postal_prefix"),
    )
    if not unique:
        s = dedupe(s, ["customer_id"])
    return s.withColumn("attr_hash", attr_hash(*TRACKED))


def empty_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIM_CUSTOMER_SCHEMA)


def scd2_apply(dim: DataFrame, src: DataFrame, run_ts: str, key: str = "customer_id",
               tracked: Sequence[str] = TRACKED, on_source_delete: str = "keep",
               src_is_complete: bool = True, broadcast_keys: bool | None = None) -> DataFrame:
    """One SCD2 run: untouched history + (current versions full-outer source).

    ``src_is_complete=False`` means ``src`` holds only the customers touched
    since the last run (their new state); everyone else keeps the current
    version, which is exactly the ``keep`` rule for absent customers.  Then,
    when the touched set is small and the dimension large (or
    ``broadcast_keys``), its keys are broadcast and untouched current
    versions are not shuffled at all."""
    if on_source_delete not in ("keep", "close", "delete"):
        raise ValueError(f"on_source_delete must be keep, close or delete, not {on_source_delete!r}")
    if not src_is_complete and on_source_delete != "keep":
        raise ValueError("a partial source cannot tell deleted customers from untouched ones")
    run = F.lit(run_ts).cast("timestamp")
    cols = [f.name for f in DIM_CUSTOMER_SCHEMA.fields]
    history = dim.where(~F.col("is_current"))
    current = dim.where(F.col("is_current"))
    if not src_is_complete:
        if broadcast_keys is None:
            broadcast_keys = worth_broadcasting_keys(current, src.select(key))
        if broadcast_keys:
            keys = F.broadcast(src.select(key))
            history = history.unionByName(current.join(keys, key, "left_anti").select(*cols))
            current = current.join(keys, key, "left_semi")

    c = current.select(*[F.col(x).alias(f"_c_{x}") for x in cols])
    s = src.select(F.col(key).alias("_s_key"), *[F.col(t).alias(f"_s_{t}") for t in tracked],
                   F.col("attr_hash").alias("_s_hash"))
    j = c.join(s, F.col(f"_c_{key}") == F.col("_s_key"), "full_outer")

    def version(**over):
        return F.struct(*[over.get(x, F.col(f"_c_{x}")).alias(x) for x in cols])

    kept = version()
    closed = version(valid_to=run, is_current=F.lit(False))
    opened = F.struct(
        surrogate_key(F.col("_s_key"), run).alias("customer_key"),
        F.col("_s_key").alias(key),
        *[F.col(f"_s_{t}").alias(t) for t in tracked],
        F.col("_s_hash").alias("attr_hash"),
        run.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    gone = {
        "keep": F.array(kept),
        "close": F.array(closed),
        "delete": F.filter(F.array(kept), lambda v: F.lit(False)),  # typed empty array
    }[on_source_delete]
    rows = (
        F.when(F.col(f"_c_{key}").isNull(), F.array(opened))
        .when(F.col("_s_key").isNull(), gone)
        .when(F.col(f"_c_attr_hash") != F.col("_s_hash"), F.array(closed, opened))
        .otherwise(F.array(kept))
    )
    moved = j.select(F.explode(rows).alias("v")).select("v.*")
    return history.select(*cols).unionByName(moved)


def scd2_close(dim: DataFrame, src: DataFrame, run_ts: str, key: str = "customer_id") -> DataFrame:
    """Step 1 of 2 (D2): close current versions whose attribute hash changed."""
    run = F.lit(run_ts).cast("timestamp")
    cols = [f.name for f in DIM_CUSTOMER_SCHEMA.fields]
    s = src.select(F.col(key).alias("_s_key"), F.col("attr_hash").alias("_s_hash"))
    j = dim.join(s, (F.col(key) == F.col("_s_key")) & F.col("is_current"), "left")
    changed = F.col("_s_hash").isNotNull() & (F.col("attr_hash") != F.col("_s_hash"))
    return j.select(*[
        (F.when(changed, run).otherwise(F.col("valid_to")) if c == "valid_to" else
         F.when(changed, F.lit(False)).otherwise(F.col("is_current")) if c == "is_current" else F.col(c)).alias(c)
        for c in cols])


def scd2_open(dim: DataFrame, src: DataFrame, run_ts: str, key: str = "customer_id",
              tracked: Sequence[str] = TRACKED) -> DataFrame:
    """Step 2 of 2 (D3): a new version for every source customer without a
    current one (new customers and those just closed)."""
    run = F.lit(run_ts).cast("timestamp")
    new = without_current(src, dim, key).select(
        surrogate_key(F.col(key), run).alias("customer_key"), F.col(key), *[F.col(t) for t in tracked],
        "attr_hash", run.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"))
    return dim.unionByName(new)


def scd2_runs(spark: SparkSession, sources: Sequence[DataFrame], run_ts: Sequence[str],
              dim: DataFrame | None = None, checkpoint: bool = True, **kw) -> list[DataFrame]:
    """Apply several runs in order; each result is written to the shared
    work folder so that lineage does not grow with the number of runs."""
    out = []
    dim = empty_dim(spark) if dim is None else dim
    for src, ts in zip(sources, run_ts):
        dim = scd2_apply(dim, src, ts, **kw)
        if checkpoint:
            dim = materialize(dim, "dim_customer")
        out.append(dim)
    return out


def without_current(src: DataFrame, dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Source customers that have no current version (J4, left anti)."""
    return src.join(dim.where(F.col("is_current")).select(key), key, "left_anti")


def versioned_keys(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Customers carrying more than one version."""
    return dim.groupBy(key).agg(F.count("*").alias("versions")).where(F.col("versions") > 1)


def scd2_versioned(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    return versioned_keys(dim, key).agg(F.count("*").alias("versioned_customers"))


def scd2_history(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Full version history of multi-version customers."""
    hist = where_key_in(dim, versioned_keys(dim, key).select(key), key)
    return hist.select(key, "customer_city", "province", "valid_from", "valid_to", "is_current") \
        .orderBy(key, "valid_from")


def min_customer_versions(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Versions of the smallest customer id (scalar-subquery equality, B6)."""
    lowest = dim.agg(F.min(key).alias(key))
    return dim.join(lowest, key).select(
        "customer_key", key, "customer_city", "province", "valid_from", "valid_to", "is_current")


def join_current(fact: DataFrame, dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """``customer_key`` of the current version (the job's behaviour, J2)."""
    d = dim.where(F.col("is_current")).select(key, "customer_key")
    return fact.join(d, key, "left")


def join_as_of(fact: DataFrame, dim: DataFrame, ts: str, key: str = "customer_id") -> DataFrame:
    """``customer_key`` of the version valid at ``ts``.

    Equi-join on the key with a residual range ``[valid_from, valid_to)``; a
    customer's first version also covers everything before it.  Sort-merge on
    the key, never a nested loop over all pairs; a fact-side hot key is split by
    AQE's skew join, and the version side per key is bounded by the run count.
    """
    # a window, not an aggregate joined back: the dimension is shuffled once,
    # by the key the join needs anyway (versions per key are few, see above);
    # the key keeps its name so the join reuses that partitioning
    d = dim.select(key, "customer_key", "valid_from", "valid_to",
                   F.min("valid_from").over(Window.partitionBy(key)).alias("_first_from")).alias("_d")
    f = fact.alias("_f")
    t = F.col(f"_f.{ts}")
    cond = ((F.col(f"_f.{key}") == F.col(f"_d.{key}"))
            & ((t >= F.col("_d.valid_from")) | (F.col("_d.valid_from") == F.col("_d._first_from")))
            & (F.col("_d.valid_to").isNull() | (t < F.col("_d.valid_to"))))
    return f.join(d, cond, "left").select(*[F.col(f"_f.`{c}`") for c in fact.columns], F.col("_d.customer_key"))
