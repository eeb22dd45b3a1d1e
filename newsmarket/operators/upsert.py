"""Keyed upserts as one join; the result is a table to write to a new path."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def collapse(updates: DataFrame, keys: list[str], order: list[str], overwrite: list[str], keep: list[str]) -> DataFrame:
    """One row a key: overwritten columns from the last row in ``order``, kept columns from the first. Partial aggregates, no window."""
    at = F.struct(*order)
    last, first = F.max_by(F.struct(*overwrite), at), F.min_by(F.struct(*keep), at)
    out = updates.groupBy(*keys).agg(last.alias("_last"), *([first.alias("_first")] if keep else []))
    return out.select(*keys, "_last.*", *(["_first.*"] if keep else []))


def merged(target: DataFrame, updates: DataFrame, keys: list[str], overwrite: list[str], keep: list[str], order: list[str]) -> DataFrame:
    """Target and updates side by side with ``is_new`` and ``is_updated``: the base of an upsert and of its counts."""
    new = collapse(updates, keys, order, overwrite, keep).withColumn("_u", F.lit(True))
    old = target.select(*keys, *overwrite, *keep).withColumn("_t", F.lit(True))
    both = old.alias("t").join(new.alias("u"), keys, "full_outer")
    hit = F.col("u._u").isNotNull()
    columns = [F.when(hit, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in overwrite]
    columns += [F.when(F.col("t._t").isNotNull(), F.col(f"t.{c}")).otherwise(F.col(f"u.{c}")).alias(c) for c in keep]
    return both.select(*keys, *columns, F.col("t._t").isNull().alias("is_new"), (hit & F.col("t._t").isNotNull()).alias("is_updated"))


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], overwrite: list[str], keep: list[str], order: list[str]) -> DataFrame:
    """Updates overwrite ``overwrite``; ``keep`` stays as first seen; the last of several updates wins."""
    return merged(target, updates, keys, overwrite, keep, order).drop("is_new", "is_updated")


def upsert_counts(target: DataFrame, updates: DataFrame, keys: list[str], overwrite: list[str], keep: list[str], order: list[str]) -> DataFrame:
    both = merged(target, updates, keys, overwrite, keep, order)
    return both.agg(F.count_if("is_new").alias("n_new"), F.count_if("is_updated").alias("n_updated"), F.count("*").alias("n_rows"))


#: What a quarantine row carries of its latest rejection, as far as the input has it.
CARRIED = ("reason", "detail", "payload", "batch")


def dead_letters(target: DataFrame, rejects: DataFrame) -> DataFrame:
    """Quarantine by (source, guid): reason, detail, payload and batch of the latest rejection, times_rejected added up, first time kept.

    target: source, guid, reason, detail, payload, batch, times_rejected, first_rejected_at, rejected_at;
    rejects has the same but for times_rejected and first_rejected_at, and both may lack detail and
    batch. Rows without a guid are always appended.
    """
    new = rejects.withColumn("times_rejected", F.lit(1).cast("long")).withColumn("first_rejected_at", F.col("rejected_at"))
    both = target.unionByName(new.select(target.columns))
    carried = [c for c in CARRIED if c in target.columns]
    keyed = both.where("guid is not null").groupBy("source", "guid")
    last = F.max_by(F.struct(*carried), F.struct("rejected_at", *carried))
    grouped = keyed.agg(last.alias("_l"), F.sum("times_rejected").alias("times_rejected"), F.min("first_rejected_at").alias("first_rejected_at"), F.max("rejected_at").alias("rejected_at"))
    return grouped.select("source", "guid", "_l.*", "times_rejected", "first_rejected_at", "rejected_at").select(target.columns).unionByName(both.where("guid is null"))


def collapse_dead_letters(rows: DataFrame) -> DataFrame:
    """Accumulated duplicates: of each (source, guid) the smallest id, first and last time, count and the reason, detail, payload and batch of the latest."""
    carried = [c for c in CARRIED if c in rows.columns]
    last = F.max_by(F.struct(*carried), F.struct("rejected_at", "id"))
    out = rows.where("guid is not null").groupBy("source", "guid").agg(F.min("id").alias("id"), F.min("rejected_at").alias("first_rejected_at"), F.max("rejected_at").alias("last_rejected_at"), F.count("*").alias("times_rejected"), last.alias("_l"))
    return out.select("source", "guid", "id", "first_rejected_at", "last_rejected_at", "times_rejected", "_l.*")


def pending(rows: DataFrame, done: DataFrame, key: str, newest: str, limit: int | None = None, reprocess: bool = False) -> DataFrame:
    """Work that is not done yet, newest first; all of it with ``reprocess``. The limit is asked for by the caller."""
    todo = rows if reprocess else rows.join(done.select(key).distinct(), key, "left_anti")
    todo = todo.orderBy(F.desc(newest), key)
    return todo if limit is None else todo.limit(limit)


def mark_processed(rows: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Adds enriched: a result exists in which one pass at least did not fail (errors < 2)."""
    ok = results.where("errors < 2").select(key).distinct().withColumn("_ok", F.lit(True))
    return rows.join(ok, key, "left").withColumn("enriched", F.coalesce("_ok", F.lit(False))).drop("_ok")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))).where("_rn = 1").drop("_rn")
