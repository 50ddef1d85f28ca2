"""Connected components by hooking labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.relational import maybe_broadcast
from tidemark.session import materialize

ROWS_PER_TASK = 500_000


def components(links: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """(a, b) links of longs -> (node, label), the smallest node reachable.

    Nodes that share a label move together: every round each label becomes the
    smallest one that any of its nodes hears of over a link, and that label's own
    new one in turn, so a chain of n links needs about log n rounds.  ``start``
    gives labels that are known already (of links that need not come again).
    Labels are written each round and minima are combined map-side; no
    neighbourhood is ever gathered."""
    one = links.where("a <> b").select("a", "b")
    edges = materialize(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = edges.select(F.col("a").alias("node"), F.col("a").alias("label"))
    if start is not None:
        labels = labels.unionByName(start.select("node", "label"))
    # as many tasks as the rows are worth, for tables that many rounds read
    tasks = 1 + (edges.count() + (start.count() if start is not None else 0)) // ROWS_PER_TASK

    def keep(df, name):
        return materialize(df.coalesce(tasks), name)

    # a start label is a node of the same component and never larger than the node
    labels = keep(labels.groupBy("node").agg(F.min("label").alias("label")), "cc-labels")
    while True:
        over = (edges.join(maybe_broadcast(labels.withColumnRenamed("node", "b")), "b")
                .select(F.col("a").alias("node"), F.lit(None).cast("long").alias("label"), F.col("label").alias("heard")))
        heard = keep(labels.withColumn("heard", F.col("label")).unionByName(over).groupBy("node").agg(
            F.max("label").alias("label"), F.min("heard").alias("heard")), "cc-heard")
        moves = keep(heard.where("heard < label").groupBy(F.col("label").alias("root")).agg(
            F.min("heard").alias("to")), "cc-moves")
        if moves.isEmpty():
            return heard.select("node", "label")
        labels = heard.select("node", "label")
        for _ in range(2):
            labels = (labels.join(maybe_broadcast(moves), F.col("label") == F.col("root"), "left")
                      .select("node", F.coalesce("to", "label").alias("label")))
        labels = keep(labels, "cc-labels")
