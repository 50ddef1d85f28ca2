"""Column expressions shared by the operators (F1-F25 of the survey).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp text used inside hashes and surrogate keys.  The
# microseconds are always printed so that every engine agrees on the text.
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ts(c: str | Column) -> Column:
    """Zone-less source timestamps become session-zone (UTC) timestamps."""
    return col_(c).cast("timestamp")


def ts_text(c: str | Column) -> Column:
    return F.date_format(col_(c), TS_TEXT_FORMAT)


def attr_hash(*cols: str | Column) -> Column:
    """md5 over the tracked attributes joined with '||', NULL read as ''.

    Values that themselves contain '||' can collide (kept for parity)."""
    return F.md5(F.concat_ws("||", *[F.coalesce(col_(c).cast("string"), F.lit("")) for c in cols]))


def surrogate_key(id_col: str | Column, ts_col: str | Column) -> Column:
    """md5(id || timestamp text): one key per version, reproducible."""
    return F.md5(F.concat(col_(id_col).cast("string"), ts_text(ts_col)))


def elapsed_days(start: str | Column, end: str | Column) -> Column:
    """Whole 24-hour periods from start to end (truncated toward zero)."""
    return F.timestamp_diff("DAY", col_(start), col_(end)).cast("long")


def calendar_days(end: str | Column, start: str | Column) -> Column:
    """Calendar-day difference of the dates, as ``datediff``."""
    return F.datediff(col_(end), col_(start))


def round_ratio(num: str | Column, den: str | Column, scale: int) -> Column:
    """round(num / den, scale), half up, exact, as decimal(18, scale).

    Integer arithmetic only, so the result does not depend on how an engine
    types decimal division.  Meant for non-negative ratios (rates, averages of
    non-negative amounts); a zero denominator gives NULL.
    """
    k = 10 ** scale
    n = col_(num).cast("long")
    d = col_(den).cast("long")
    a = n * F.lit(2 * k) + d
    b = d * F.lit(2)
    q = (a - F.pmod(a, b)).cast("decimal(38,0)") / b.cast("decimal(38,0)")
    out = (q / F.lit(k)).cast(f"decimal(18,{scale})")
    return F.when(d != 0, out)


def money(c: str | Column) -> Column:
    return col_(c).cast("decimal(18,2)")


def count_true(cond: Column) -> Column:
    """Conditional count; NULL counts as not true."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def lpad_int(c: str | Column, digits: int) -> Column:
    return F.lpad(col_(c).cast("string"), digits, "0")


def avg_round(c: str | Column, n: int, scale: int = 0) -> Column:
    """round(avg(c), n), half up and exact (A5): an aggregate expression.
    ``scale`` is the number of decimals of ``c`` (2 for money)."""
    k = 10 ** scale
    return round_ratio((F.sum(col_(c)) * k).cast("long"), F.count(col_(c)) * k, n)


def pct_true(cond: Column, n: int = 2) -> Column:
    """Percentage of rows where ``cond`` holds, rounded (A7): an aggregate."""
    return round_ratio(count_true(cond) * 100, F.count(F.lit(1)), n)
