"""Cleansing projections: blank strings, province codes, lenient timestamps,
status steps (P3, P4, F20, F22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Source region code -> province, applied in the cleansed layer.
STATE_TO_PROVINCE = {
    "SP": "ON", "RJ": "QC", "MG": "BC", "RS": "AB", "PR": "MB", "SC": "SK",
    "BA": "NS", "DF": "NB", "ES": "NL", "GO": "PE", "PE": "YT", "CE": "NT",
}
DEFAULT_PROVINCE = "ON"

# Order status progression; the last status stays, anything
# unknown steps to "approved".
STATUS_STEP = {
    "created": "approved",
    "approved": "processing",
    "processing": "shipped",
    "shipped": "delivered",
    "delivered": "delivered",
}
UNKNOWN_STATUS_STEP = "approved"


def blank_to_null(df: DataFrame, skip: tuple[str, ...] = ("Op",)) -> DataFrame:
    """Every string column except ``skip``: '' or spaces-only -> NULL.

    Kept values are not trimmed.  One projection, no per-column loop of
    ``withColumn`` calls."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType) and f.name not in skip:
            c = F.col(f.name)
            out.append(F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def province_of(c: str | Column) -> Column:
    """Known region code -> province; anything else, NULL included -> ON."""
    c = F.col(c) if isinstance(c, str) else c
    mapping = F.create_map(*[F.lit(x) for kv in STATE_TO_PROVINCE.items() for x in kv])
    return F.coalesce(mapping[c], F.lit(DEFAULT_PROVINCE))


def map_province(df: DataFrame, col: str) -> DataFrame:
    """No-op when the column is absent (tables without a region column)."""
    if col not in df.columns:
        return df
    return df.withColumn(col, province_of(col))


def status_step(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    mapping = F.create_map(*[F.lit(x) for kv in STATUS_STEP.items() for x in kv])
    return F.coalesce(mapping[c], F.lit(UNKNOWN_STATUS_STEP))


def lenient_timestamps(df: DataFrame) -> DataFrame:
    """Columns whose name contains 'timestamp' or 'date' parse to timestamps;
    unparseable text becomes NULL instead of failing the job."""
    out = []
    for f in df.schema.fields:
        name = f.name
        if ("timestamp" in name or "date" in name) and isinstance(f.dataType, StringType):
            out.append(F.try_to_timestamp(F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)
