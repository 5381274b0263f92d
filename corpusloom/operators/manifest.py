"""Content manifests, refresh plans, and the chunk store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by order: one aggregation with map-side combining, no sort."""
    value = F.struct(*order, *(c for c in rows.columns if c not in order))
    return rows.groupBy(*keys).agg(F.max(F.struct(F.struct(*order).alias("o"), value.alias("v"))).alias("m")).select(*(F.col(f"m.v.{c}").alias(c) for c in rows.columns))


def mark_changed(fetches: DataFrame, order: list[str], snapshot: DataFrame | None = None, url_col: str = "url", checksum_col: str = "checksum") -> DataFrame:
    """fetches with changed: whether the URL has no earlier checksum, or another one.

    Earlier is the row before by order within fetches, else the snapshot's (url, checksum), of which each URL has one row.
    """
    w = Window.partitionBy(url_col).orderBy(*order)
    before = F.lag(checksum_col).over(w)
    first = F.row_number().over(w) == 1
    rows = fetches
    if snapshot is not None:
        had = snapshot.select(F.col(url_col).alias("had_url"), F.col(checksum_col).alias("had_checksum"))
        rows = fetches.join(had, F.col(url_col) == F.col("had_url"), "left")
        before = F.when(first, F.col("had_checksum")).otherwise(before)
    return rows.withColumn("changed", ~F.col(checksum_col).eqNullSafe(before) | before.isNull()).drop("had_url", "had_checksum")


def refresh_plan(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(url, checksum, previous_checksum, reason, action) from two (url, checksum) snapshots with one row a URL.

    New and changed URLs are to embed, those gone to delete (with their old checksum on both sides); equal ones are left out.
    """
    c = current.select(F.col("url").alias("c_url"), F.col("checksum").alias("c_sum"))
    p = previous.select(F.col("url").alias("p_url"), F.col("checksum").alias("p_sum"))
    both = c.join(p, F.col("c_url") == F.col("p_url"), "full_outer")
    reason = F.when(F.col("p_url").isNull(), "new").when(F.col("c_url").isNull(), "deleted").when(~F.col("c_sum").eqNullSafe(F.col("p_sum")), "changed")
    return both.withColumn("reason", reason).where("reason is not null").select(
        F.coalesce("c_url", "p_url").alias("url"), F.coalesce("c_sum", "p_sum").alias("checksum"), F.col("p_sum").alias("previous_checksum"), "reason", F.when(F.col("reason") == "deleted", "delete").otherwise("embed").alias("action")
    )


def plan_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("reason").agg(F.count("*").alias("n"))


def only_changed(pages: DataFrame, manifest: DataFrame, url_col: str = "url") -> DataFrame:
    """pages that manifest (url, changed; one row a URL) does not call unchanged; an absent URL counts as changed."""
    same = manifest.where(~F.col("changed")).select(F.col("url").alias("same_url"))
    return pages.join(same, F.col(url_col) == F.col("same_url"), "left_anti")


def upsert(store: DataFrame, incoming: DataFrame, keys: list[str], seq: Column) -> DataFrame:
    """store with incoming's rows in place of those of equal keys; of incoming rows with equal keys the last by seq wins."""
    new = latest(incoming.withColumn("batch_seq", seq), keys, ["batch_seq"]).drop("batch_seq")
    return store.join(new.select(*keys), keys, "left_anti").unionByName(new)


def insert_only(store: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """store and incoming together; a key that is in both, or twice in incoming, is an error."""
    taken = incoming.select(*keys).join(store.select(*keys), keys, "left_semi").unionByName(incoming.groupBy(*keys).count().where("count > 1").select(*keys))
    first = taken.first()
    if first is not None:
        raise ValueError(f"key exists already: {first.asDict()}")
    return store.unionByName(incoming)


def apply_plan(store: DataFrame, plan: DataFrame, fresh_chunks: DataFrame) -> DataFrame:
    """store without the URLs that the plan names (deleted or to embed anew), and with fresh_chunks: no stale chunk stays."""
    return store.join(plan.select("url").distinct(), "url", "left_anti").unionByName(fresh_chunks)


def ledger(plan: DataFrame, emitted_at_epoch_ms: int) -> DataFrame:
    return plan.select(F.lit(emitted_at_epoch_ms).cast("bigint").alias("emitted_at_epoch_ms"), "*")


def plan_totals(current: DataFrame, previous: DataFrame, plan: DataFrame) -> DataFrame:
    """One row (current_urls, previous_urls, new, changed, deleted, unchanged) of two snapshots and their plan."""
    by = plan.agg(*(F.count_if(F.col("reason") == r).alias(r) for r in ("new", "changed", "deleted")))
    row = current.agg(F.count("*").alias("current_urls")).crossJoin(previous.agg(F.count("*").alias("previous_urls"))).crossJoin(by)  # a row each
    return row.withColumn("unchanged", F.col("current_urls") - F.col("new") - F.col("changed"))


def write_snapshot(fetches: DataFrame, path: str, order: list[str], previous: DataFrame | None = None, carry_forward: bool = False) -> DataFrame:
    """Marks fetches (url, checksum, last_seen_epoch_ms, order) as changed or not against previous, and writes them to path as JSON lines.

    A snapshot is what this run fetched, as many rows as it fetched; carry_forward adds the URLs of previous that it did not
    fetch, as unchanged. path must be new: the snapshot read from is never written over. The rows written are returned.
    """
    kept = ["url", "checksum", "last_seen_epoch_ms", "changed"]
    out = mark_changed(fetches, order, previous).select(*kept)
    if carry_forward and previous is not None:
        out = out.unionByName(previous.join(fetches.select("url"), "url", "left_anti").select("url", "checksum", "last_seen_epoch_ms", F.lit(False).alias("changed")))
    out.write.mode("errorifexists").option("ignoreNullFields", False).json(path)
    return out


def execute_plan(store: DataFrame, plan: DataFrame, fresh_chunks: DataFrame, dry_run: bool = False) -> DataFrame:
    """apply_plan(), or on a dry run what it would do: (action, urls, store_rows, fresh_rows) for each action, with nothing done."""
    if not dry_run:
        return apply_plan(store, plan, fresh_chunks)
    actions = plan.select("url", "action").distinct()
    had = store.groupBy("url").agg(F.count("*").alias("s"))
    new = fresh_chunks.groupBy("url").agg(F.count("*").alias("f"))
    both = actions.join(had, "url", "left").join(new, "url", "left")
    return both.groupBy("action").agg(F.count("*").alias("urls"), F.coalesce(F.sum("s"), F.lit(0)).alias("store_rows"), F.coalesce(F.sum("f"), F.lit(0)).alias("fresh_rows"))
