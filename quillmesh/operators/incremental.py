"""Incremental loads: anti-joins, first-seen dedup, upserts, status changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def link_key(link: Column) -> Column:
    """A link without its last slash."""
    return F.regexp_replace(F.trim(link), "/$", "")


def first_seen(rows: DataFrame, key: Column, order: list) -> DataFrame:
    """The first row of each key by a total order; rows whose key is null or blank are left out.

    An aggregation, so that a key with many rows is reduced before it is shuffled.
    """
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct(*order)).alias("_row")
    return rows.withColumn("_k", key).where(F.col("_k").cast("string") != "").groupBy("_k").agg(first).select("_row.*")


def new_rows(rows: DataFrame, stored: DataFrame, column: str, order: list) -> DataFrame:
    """Rows whose link isn't stored, each link once."""
    have = stored.select(link_key(F.col(column)).alias("_have")).distinct()
    fresh = first_seen(rows, link_key(F.col(column)), order)
    return fresh.join(have, link_key(fresh[column]) == F.col("_have"), "left_anti")


def upsert(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target with rows of the same key replaced and the other changes added; changes hold each key once (see `sources.snapshots` for others)."""
    return target.join(changes.select(key), key, "left_anti").unionByName(changes.select(*target.columns))


def set_status(rows: DataFrame, done: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """Rows of status `old` whose key is in `done` get status `new`."""
    marked = done.select(F.col(key).alias("_done")).distinct()
    out = rows.join(marked, rows[key] == F.col("_done"), "left")
    return out.withColumn("status", F.when(F.col("_done").isNotNull() & (F.col("status") == old), new).otherwise(F.col("status"))).drop("_done")


def top_queue(rows: DataFrame, n: int = 50) -> DataFrame:
    """The n queued rows of the highest score; ties by link."""
    return rows.where("status = 'queued'").orderBy(F.desc("score"), "link").limit(n)
