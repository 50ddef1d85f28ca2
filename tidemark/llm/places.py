"""Places of rows in their groups, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.relational import estimated_bytes
from tidemark.session import materialize

#: Tables of no more bytes, as written, are broadcast; beyond that joins shuffle.
BROADCAST_BYTES = 2 << 20
ROW_BITS = 33  # of monotonically_increasing_id


def small(df: DataFrame) -> DataFrame:
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= BROADCAST_BYTES else df


def numbered(df: DataFrame, group: str | None, order: list[str], cut_by: list[str] | None = None) -> DataFrame:
    """``df`` with ``place`` (from 0, by ``order`` within ``group``) and, for a group, ``n`` (its rows).

    Sorted over range partitions; only row numbers of partitions are summed.
    ``cut_by``: short columns in the sense of ``order`` that the partitions are cut by
    (a sample of them goes to the driver), where ``order`` has long ones; rows that
    agree in them share a partition.  Without it, rows alike in all of ``order`` may lie
    in several partitions."""
    first = [group] if group else []
    keys = [F.col(c).asc_nulls_first() for c in first + order]
    cuts = [F.col(c).asc_nulls_first() for c in first + cut_by] if cut_by else [*keys, F.col("__row")]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (df.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(parts, *cuts)
                   .sortWithinPartitions(*keys, "__row").withColumn("__row", F.monotonically_increasing_id()))
    rows = materialize(sorted_rows, "places-sorted").withColumn("__part", F.shiftright("__row", ROW_BITS))
    by = [F.col(group).alias("__group")] if group else []
    sums = rows.groupBy(*by, "__part").agg(F.min("__row").alias("__first"), F.count("*").alias("__rows"))
    whole = Window.partitionBy("__group") if group else Window.partitionBy()
    upto = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = materialize(sums.select(
        *["__group"] * bool(group), F.col("__part").alias("__p"), (F.sum("__rows").over(upto) - F.col("__rows") - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(whole).alias("n")), "places-starts")
    on = F.col("__part") == F.col("__p")
    if group:
        on = on & F.col(group).eqNullSafe(F.col("__group"))
    return (rows.join(small(starts), on).withColumn("place", F.col("__row") + F.col("__shift"))
            .drop("__row", "__part", "__p", "__shift", "__group"))
