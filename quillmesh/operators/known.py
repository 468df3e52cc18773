"""Known companies in running text, and the merge with names from a keyword column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.entities import mention_count, normalize_entity
from quillmesh.functions.text import title_case
from quillmesh.operators.rewrite import keyword_finder

#: characters of context on either side in which a display name is looked for
CONTEXT = 20


def _safe(name: Column) -> Column:
    return F.regexp_replace(name, r"([\\.^$|?*+()\[\]{}\-&~#])", r"\\$1")


def display_name(text: Column, name: Column) -> Column:
    """The name as it stands near its first whole-word mention, with what is joined to it, in title case; null if it is written otherwise."""
    word = F.concat(F.lit(r"\b"), _safe(name))
    at = F.regexp_instr(F.lower(text), F.concat(word, F.lit(r"\b")))
    context = F.substring(text, F.greatest(at - CONTEXT, F.lit(1)), F.length(name) + CONTEXT + F.least(at - 1, F.lit(CONTEXT)))
    found = F.call_function("regexp_extract", context, F.concat(word, F.lit(r"[^\s,.;:]*")), F.lit(0))
    return F.when((at > 0) & (found != ""), title_case(F.trim(found)))


def known_companies(docs: DataFrame, companies: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, name, confidence 0.7 of the known companies (name, lower-cased, of any number of words) in a text.

    One automaton over all names finds those that a text holds as whole words, in
    one pass over the rows; the display name is looked up for those, in the row.
    """
    names = companies.select(F.lower(F.trim("name")).alias("keyword")).where("keyword != ''").distinct()
    finder = keyword_finder(names.select(F.lit("").alias("tag"), "keyword"))
    held = docs.select(key, F.col(text).alias("_text"), F.explode(finder(F.col(text))).alias("_found"))
    found = held.select(key, display_name(F.col("_text"), F.col("_found.keyword")).alias("name"))
    return found.where("name is not null").select(key, "name", F.lit(0.7).alias("confidence")).distinct()


def with_mentions(found: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """found with mentions: how often the document's text holds each name."""
    texts = docs.select(key, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_low"))
    return found.join(texts, key).withColumn("mentions", mention_count(F.col("_low"), F.col("name")).cast("long")).drop("_low")


def merge_entities(by_column: DataFrame, by_text: DataFrame, manual: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """key, norm, name, confidence, mentions: of names with one normal form the surest counts, column before text.

    Mentions are the most that any had. manual: norm, name that override with confidence 1.0.
    """
    both = by_column.withColumn("_from", F.lit(0)).unionByName(by_text.withColumn("_from", F.lit(1)))
    both = both.withColumn("norm", normalize_entity(F.col("name"))).where("norm != ''")
    best = F.min_by(F.struct("name", "confidence"), F.struct(-F.col("confidence"), "_from", -F.length("name"), "name"))
    out = both.groupBy(key, "norm").agg(best.alias("b"), F.max("mentions").alias("mentions")).select(key, "norm", "b.name", "b.confidence", "mentions")
    if manual is None:
        return out
    m = manual.groupBy("norm").agg(F.min("name").alias("_manual"))
    out = out.join(m, "norm", "left").withColumn("confidence", F.when(F.col("_manual").isNotNull(), 1.0).otherwise(F.col("confidence")))
    return out.select(key, "norm", F.coalesce("_manual", "name").alias("name"), "confidence", "mentions")


def entity_frequency(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """norm, documents: in how many documents a normal form occurs."""
    return found.groupBy("norm").agg(F.count_distinct(key).alias("documents"))


def company_rows(spark, path: str, name: str = "name", ticker: str | None = None) -> DataFrame:
    """name, ticker of a company list file whose columns are named."""
    df = spark.read.options(header="true", multiLine="true", quote='"', escape='"').csv(path)
    return df.select(F.trim(F.col(f"`{name}`")).alias("name"), (F.trim(F.col(f"`{ticker}`")) if ticker else F.lit(None).cast("string")).alias("ticker")).where("name is not null and name != ''")

