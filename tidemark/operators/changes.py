"""Change application by key.

A change row carries the table columns plus ``Op`` (I/U/D) and ``dms_ts``.
Plain Parquet has no row-level MERGE, so every function here returns the new
state as a DataFrame; writing it (to a new version folder, or only the
touched partitions) is a separate step in ``sources.tables``.

Merge semantics, kept on purpose (SQL three-valued logic):
  matched and Op = 'D'        -> delete
  matched otherwise           -> update all columns (Op NULL or 'I' included)
  unmatched and Op <> 'D'     -> insert (a NULL Op is therefore never inserted)
Rows whose key is NULL after cleansing never match; they are split off into
a quarantine instead of being inserted again on every batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.cleanse import blank_to_null, map_province
from tidemark.operators.relational import BROADCAST_LIMIT_BYTES, pick_max, worth_broadcasting_keys
from tidemark.session import materialize

# Primary key of each source table.
TABLE_KEYS = {
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "category_translation": ["product_category_name"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"],
}

# Tie-break rank of the operation when two changes of one key
# share a timestamp (a delete wins over an update over an insert).
OP_RANK = {"D": 3, "U": 2, "I": 1}

ACTION_KEEP, ACTION_INSERT, ACTION_UPDATE, ACTION_DELETE = "keep", "insert", "update", "delete"
ACTION_IGNORE, ACTION_STALE = "ignore", "stale"
LIVE_ACTIONS = (ACTION_KEEP, ACTION_INSERT, ACTION_UPDATE, ACTION_STALE)


def op_rank(op: str | Column = "Op") -> Column:
    c = F.col(op) if isinstance(op, str) else op
    expr = None
    for k, v in OP_RANK.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr.otherwise(0)


def cleanse_changes(df: DataFrame) -> DataFrame:
    """Blank strings -> NULL (all strings but Op), region codes -> provinces."""
    df = blank_to_null(df, skip=("Op",))
    df = map_province(df, "customer_state")
    return map_province(df, "seller_state")


def latest_per_key(changes: DataFrame, pk: Sequence[str], ts: str = "dms_ts") -> DataFrame:
    """Latest change per key (C1): greatest ``ts`` (NULL last), then Op rank,
    then the remaining columns; ``ts`` is renamed ``_cdc_ts``."""
    latest = pick_max(changes, pk, [F.col(ts), op_rank("Op")])
    return latest.withColumnRenamed(ts, "_cdc_ts")


def split_null_keys(df: DataFrame, pk: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    bad = F.lit(False)
    for k in pk:
        bad = bad | F.col(k).isNull()
    return df.where(~bad), df.where(bad)


def prepare(changes: DataFrame, pk: Sequence[str], ts: str = "dms_ts") -> DataFrame:
    """cleanse -> drop NULL keys -> latest per key."""
    valid, _ = split_null_keys(cleanse_changes(changes), pk)
    return latest_per_key(valid, pk, ts)


def quarantined_keys(changes: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Change rows rejected because a key is NULL after cleansing."""
    _, bad = split_null_keys(cleanse_changes(changes), pk)
    return bad


def initial_load(latest: DataFrame, observe: Observation | None = None) -> DataFrame:
    """First load (C2): latest rows whose Op is not 'D' become the table.
    ``observe`` takes the counts of ``action_counts`` as the result is written."""
    if observe:
        live = F.coalesce(F.col("Op") != "D", F.lit(False))
        latest = latest.observe(observe, *action_counts(F.when(live, ACTION_INSERT).otherwise(ACTION_IGNORE)))
    return latest.where(F.col("Op") != "D").drop("Op")


def merge_plan(target: DataFrame, latest: DataFrame, pk: Sequence[str],
               ignore_stale: bool = False) -> DataFrame:
    """One full outer join of the table and the latest changes on the key.

    Returns the table's columns plus ``_action``.  Both inputs hold at most one
    row per key, so the join cannot be skewed by a hot key; it costs one
    shuffle per side (none when both are already partitioned by the key)."""
    cols = target.columns
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    s = latest.select(*[F.col(c).alias(f"_s_{c}") for c in latest.columns], F.lit(True).alias("_in_s"))
    cond = None
    for k in pk:
        e = F.col(f"_t_{k}") == F.col(f"_s_{k}")
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full_outer")
    in_t = F.coalesce(F.col("_in_t"), F.lit(False))
    in_s = F.coalesce(F.col("_in_s"), F.lit(False))
    op = F.col("_s_Op")
    is_delete = F.coalesce(op == "D", F.lit(False))
    inserts = F.coalesce(op != "D", F.lit(False))
    action = F.when(~in_s, ACTION_KEEP)
    if ignore_stale:  # a late delete does not remove a newer row either
        action = action.when(in_t & (F.col("_s__cdc_ts") < F.col("_t__cdc_ts")), ACTION_STALE)
    action = (
        action.when(in_t & is_delete, ACTION_DELETE)
        .when(in_t, ACTION_UPDATE)
        .when(inserts, ACTION_INSERT)
        .otherwise(ACTION_IGNORE)
    )
    j = j.withColumn("_action", action)
    take_s = F.col("_action").isin(ACTION_UPDATE, ACTION_INSERT)
    out = []
    for c in cols:
        src = F.col(f"_s_{c}") if c in latest.columns else F.lit(None)
        out.append(F.when(take_s, src).otherwise(F.col(f"_t_{c}")).cast(target.schema[c].dataType).alias(c))
    return j.select(*out, "_action")


def apply_changes(target: DataFrame, latest: DataFrame, pk: Sequence[str],
                  ignore_stale: bool = False, broadcast_limit: int = BROADCAST_LIMIT_BYTES,
                  broadcast_keys: bool | None = None, observe: Observation | None = None) -> DataFrame:
    """New table state after one batch.

    When the batch's keys are small (estimated under ``broadcast_limit``) and
    the table is large enough for its shuffle to matter, the keys are
    broadcast: rows the batch does not touch stream through without any
    shuffle, and only the touched rows meet the batch in the merge join.
    Otherwise one full outer join of table and batch is cheaper.
    ``broadcast_keys`` forces either plan (the caller knows the batch size).
    ``observe`` takes the counts of ``action_counts`` as the result is written,
    without a pass of its own."""
    def live(plan: DataFrame) -> DataFrame:
        if observe:
            plan = plan.observe(observe, *action_counts(F.col("_action")))
        return plan.where(F.col("_action").isin(*LIVE_ACTIONS)).drop("_action")

    if broadcast_keys is None:
        broadcast_keys = worth_broadcasting_keys(target, latest.select(*pk), broadcast_limit)
    if broadcast_keys:
        keys = F.broadcast(latest.select(*pk))
        untouched = target.join(keys, list(pk), "left_anti")
        touched = target.join(keys, list(pk), "left_semi")
        return untouched.unionByName(live(merge_plan(touched, latest, pk, ignore_stale)))
    return live(merge_plan(target, latest, pk, ignore_stale))


def action_counts(a: Column) -> list[Column]:
    """Counts by merge action; ``latest_rows`` counts every latest change, deletes included."""
    return [F.count_if(a == ACTION_INSERT).alias("inserted"),
            F.count_if(a == ACTION_UPDATE).alias("updated"),
            F.count_if(a == ACTION_DELETE).alias("deleted"),
            F.count_if(a.isin(ACTION_IGNORE, ACTION_STALE)).alias("ignored"),
            F.count_if(a != ACTION_KEEP).alias("latest_rows")]


def applied_counts(plan: DataFrame, table: str) -> DataFrame:
    """Counts by action from the merge's own output, in one pass."""
    return plan.agg(*action_counts(F.col("_action"))).select(F.lit(table).alias("table_name"), "*")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], broadcast_keys: bool | None = None) -> DataFrame:
    """Full-row upsert without deletes (C4): source rows replace or add."""
    src = source.select(*target.columns, F.lit("U").alias("Op"))
    return apply_changes(target, src, keys, broadcast_keys=broadcast_keys)


def update_where(df: DataFrame, keys: DataFrame, on: Sequence[str],
                 assignments: dict[str, Column]) -> DataFrame:
    """``UPDATE df SET ... WHERE (on) IN (keys)`` (C5) as one left join.

    The key set is de-duplicated first so that the join cannot multiply rows."""
    hits = keys.select(*on).distinct().withColumn("_hit", F.lit(True))
    j = df.join(hits, on=list(on), how="left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = []
    for c in df.columns:
        if c in assignments:
            out.append(F.when(hit, assignments[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def delete_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """``DELETE FROM df WHERE (on) IN (keys)`` (C6) as a left anti join."""
    return df.join(keys.select(*on), on=list(on), how="left_anti")


def replay(target: DataFrame | None, batches: Sequence[DataFrame], pk: Sequence[str],
           checkpoint: bool = True) -> list[DataFrame]:
    """States after each batch.  Each state is written to the shared work
    folder so that lineage stays one batch deep (and survives executor loss).
    ``target=None`` means the first batch is the initial load."""
    return replay_latest(target, (prepare(b, pk) for b in batches), pk, checkpoint)


def replay_latest(target: DataFrame | None, latest_batches: Iterable[DataFrame], pk: Sequence[str],
                  checkpoint: bool = True) -> list[DataFrame]:
    """``replay`` of batches that ``prepare`` has been through."""
    states = []
    state = target
    for latest in latest_batches:
        state = initial_load(latest) if state is None else apply_changes(state, latest, pk)
        if checkpoint:
            state = materialize(state, "cleansed")
        states.append(state)
    return states
