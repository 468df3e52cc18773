"""Sinks: star tables, exports, incremental appends, upserted tables (kept by `snapshots`)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.operators.incremental import link_key, new_rows
from quillmesh.sources.snapshots import Table


def write_star(tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """One folder per table; Fact_Document is partitioned by Year where it has one."""
    for name, df in tables.items():
        out = df.write.mode("overwrite").format(fmt).option("header", "true")
        (out.partitionBy("Year") if name == "Fact_Document" and "Year" in df.columns else out).save(f"{path}/{name}")


def append_new(rows: DataFrame, stored: DataFrame, path: str, column: str, order: list) -> None:
    """Append the rows whose link isn't stored yet, partitioned by source."""
    new_rows(rows, stored, column, order).write.mode("append").partitionBy("source").parquet(path)


def export(df: DataFrame, path: str, fmt: str = "json") -> None:
    df.write.mode("overwrite").option("header", "true").option("escape", '"').format(fmt).save(path)


def by_source(df: DataFrame) -> DataFrame:
    """Summary of an export: rows per source, missing ones as Unknown."""
    return df.groupBy(F.coalesce(F.nullif("source", F.lit("")), F.lit("Unknown")).alias("source")).agg(F.count("*").alias("rows"))


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted CSV with a header that `readers.read_csv` gives back, line ends in fields included."""
    df.write.mode("overwrite").options(header="true", quote='"', escape='"', quoteAll="true").csv(path)


def upsert_table(changes: DataFrame, path: str, key: str, order: list[str]) -> None:
    """A snapshot table with rows of the same key replaced, the others added; of several the last by the order columns counts."""
    Table(changes.sparkSession, path, [key]).upsert(changes, order)


def migrate(rows: DataFrame, path: str, order: list[str]) -> DataFrame:
    """Upsert articles by link, the last by the order columns, and tell by source how many rows were fit to store and how many not."""
    fit = (F.coalesce(F.trim("link"), F.lit("")) != "") & (F.length("extract") > 10)
    totals = rows.groupBy("source").agg(F.count_if(fit).alias("stored"), F.count_if(~F.coalesce(fit, F.lit(False))).alias("skipped"))
    upsert_table(rows.where(fit).withColumn("link", link_key(F.col("link"))), path, "link", order)
    return totals


def with_ids(rows: DataFrame, ids: DataFrame, key: str, column: str) -> DataFrame:
    """rows with `column` taken from ids by a key; rows without an id keep theirs."""
    found = ids.groupBy(key).agg(F.max(column).alias("_id"))
    return rows.join(found, key, "left").withColumn(column, F.coalesce("_id", column)).select(*rows.columns)
