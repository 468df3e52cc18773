"""Sitemaps to any depth: index files lead to other files, plain or gzipped, and at last to pages.

Landed files (url of the file, its text) give two tables: links from index to
child, and pages of each file. Files are reached level by level: the children of
a level that were not reached before are the next one, so cycles end, and each
level is a checkpoint of file names alone. Fetching is left to the job that
lands the files.

Edge cases: a file that isn't there ends its branch; a file reached in several
ways counts once, at its least depth; pages are told apart by url and file.
"""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillmesh.functions.text import strip, unescape
from quillmesh.session import durable


@F.pandas_udf(StringType())
def _unzipped(data: pd.Series) -> pd.Series:
    return data.map(lambda d: None if d is None else gzip.decompress(d).decode("utf-8", "replace"))


def plain_text(data: Column) -> Column:
    """Text of a file's bytes, unzipped if they are gzipped; plain files stay in the JVM's reach."""
    zipped = F.startswith(F.hex(F.substring(data, 1, 2)), F.lit("1F8B"))
    return F.coalesce(F.when(~zipped, data.cast("string")), _unzipped(F.when(zipped, data)))


def landed_files(spark: SparkSession, path: str, base: str) -> DataFrame:
    """file (base and file name), text of the sitemap files of a folder."""
    df = spark.read.format("binaryFile").load(path)
    return df.select(F.concat(F.lit(base), F.element_at(F.split("path", "/"), -1)).alias("file"), plain_text(F.col("content")).alias("text"))


def _element(item: Column, tag: str) -> Column:
    return strip(unescape(F.regexp_extract(item, rf"(?s)<{tag}>(.*?)</{tag}>", 1)))


def _items(files: DataFrame, tag: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(rf"(?s)<{tag}>.*?</{tag}>"), F.lit(0))
    item = F.col("item")
    rows = files.select("file", F.explode(found).alias("item"))
    return rows.select("file", _element(item, "loc").alias("url"), F.nullif(_element(item, "lastmod"), F.lit("")).alias("lastmod")).where("url != ''")


def walk(files: DataFrame, start: str) -> DataFrame:
    """file, depth, url, lastmod of all pages that a start leads to."""
    there = durable(files.select("file").distinct())
    links = durable(_items(files, "sitemap").select("file", F.col("url").alias("child")).distinct().join(there.withColumnRenamed("file", "child"), "child", "left_semi"))
    level = there.where(F.col("file") == start).select("file", F.lit(0).alias("depth"))
    seen, depth = level, 0
    while not level.isEmpty():
        depth += 1
        level = links.join(level, "file").select(F.col("child").alias("file")).distinct().join(seen, "file", "left_anti")
        level = durable(level.select("file", F.lit(depth).alias("depth")))
        seen = seen.unionByName(level)
    return _items(files, "url").join(seen, "file").select("file", "depth", "url", "lastmod")
