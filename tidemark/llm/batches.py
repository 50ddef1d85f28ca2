"""How many rows go to a Python worker at once."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Texts of a few thousand characters make batches of a few megabytes, on both
#: sides of the pipe; Spark's default of 10,000 rows makes them tens.
ROWS = 2_000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in whose session Arrow batches hold at most ROWS rows from now on
    (the setting is read when a plan runs, so it stays set)."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    return df
