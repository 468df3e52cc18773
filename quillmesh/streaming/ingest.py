"""Incremental ingest as a stream: the same final set as the batch, in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.operators.incremental import link_key
from quillmesh.sources.snapshots import Table


def dedup_stream(stream: DataFrame, column: str, time: str | None = None, late: str = "1 day") -> DataFrame:
    """First row of each link. The state is the set of links seen, those of the last `late` only if a time column is given."""
    keyed = stream.withColumn("link_key", link_key(F.col(column)))
    return keyed.dropDuplicates(["link_key"]) if time is None else keyed.withWatermark(time, late).dropDuplicatesWithinWatermark(["link_key"])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window and key, with a watermark for late ones."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def run_available(df: DataFrame, out: str, checkpoint: str, files: str = "append") -> None:
    """Everything that is there now, exactly once per checkpoint."""
    df.writeStream.format("parquet").outputMode(files).option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_stream(df: DataFrame, table: Table, order: list[str], name: str, checkpoint: str) -> None:
    """Everything that is there now, upserted batch by batch; a batch that is delivered again changes nothing.

    The table's manifest holds the last batch of each named stream, published with
    the batch's rows, so neither a restart between the sink and the checkpoint nor
    a lost checkpoint adds rows twice. Bound a batch's files when reading.
    """
    write = df.writeStream.foreachBatch(lambda batch, number: table.upsert(batch, order, (name, number)) and None)
    write.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def flush_every(df: DataFrame, out: str, checkpoint: str, every: str = "5 minutes"):
    """A running query that writes what has come in batches of at most this age; bound a batch's files when reading."""
    return df.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
