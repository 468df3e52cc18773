"""The star schema: dimensions, fact, bridges, and roll-ups over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.functions import fixed
from quillmesh.functions.dates import calendar, date_key, ddmmyy, parse_date
from quillmesh.functions.entities import source_type
from quillmesh.functions.text import clean_value
from quillmesh.session import durable

FIRST_FACT, FIRST_TAG, FIRST_ENTITY = 1000, 10, 200


def valid_source(c: Column) -> Column:
    """2 to 100 characters, not digits alone, a letter or digit among them."""
    t = F.trim(c)
    return F.coalesce(F.length(t).between(2, 100) & ~t.rlike(r"^\p{Nd}+$") & t.rlike(r"[\p{L}\p{N}]"), F.lit(False))


def numbered(df: DataFrame, name: str, order: list, first: int) -> DataFrame:
    """Consecutive keys by a total order, without gathering the rows in one task.

    Rows are range-partitioned and sorted, so each partition's count and the
    counts before it (one row per partition) give every key. The bounds come
    from a sample, so the sorted rows are checkpointed before they are counted;
    give only the columns that are needed and join the others afterwards.
    """
    spread = durable(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    here = F.row_number().over(Window.partitionBy("_part").orderBy("_at"))
    counts = spread.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return spread.withColumn("_row", here).join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + F.col("_row") + (first - 1)).cast("long")).drop("_part", "_at", "_row", "_before")


def dim_time(dates: DataFrame, column: str) -> DataFrame:
    """Calendar rows of the different dates; unreadable ones are 1900-01-01."""
    return dates.select(F.coalesce(F.col(column).cast("date"), F.lit("1900-01-01").cast("date")).alias("d")).distinct().select(*calendar(F.col("d")))


def dim_source(names: DataFrame, column: str) -> DataFrame:
    """Keys over the sorted valid names."""
    found = names.select(F.trim(column).alias("Source_Name")).where(valid_source(F.col("Source_Name"))).distinct()
    keyed = numbered(found, "Source_Key", ["Source_Name"], 1)
    return keyed.select(F.col("Source_Key").cast("int").alias("Source_Key"), "Source_Name", source_type(F.col("Source_Name")).alias("Source_Type"))


def dim_entity(entities: DataFrame) -> DataFrame:
    """Keys over the sorted different (name, type, domain) rows."""
    order = ["Entity_Name", "Entity_Type", "Entity_Domain"]
    return numbered(entities.select(*order).distinct(), "Entity_Key", order, FIRST_ENTITY).select(F.col("Entity_Key").cast("int").alias("Entity_Key"), *order)


def entity_list(rows: DataFrame, column: str, domain: str = "Healthcare") -> DataFrame:
    """Keyed entities of a list column of (name, type) structs; a blank type is Company."""
    e = rows.select(F.explode(column).alias("e")).select(F.trim("e.name").alias("Entity_Name"), F.coalesce(F.nullif(F.trim("e.type"), F.lit("")), F.lit("Company")).alias("Entity_Type"))
    return dim_entity(e.where("Entity_Name != ''").withColumn("Entity_Domain", F.lit(domain)))


def dim_tag_rows(tags: DataFrame, order: list[str]) -> DataFrame:
    """Keys by an order of columns, for tags (tag, category, domain) in a table."""
    keyed = numbered(tags.select("tag", "category", "domain", *[c for c in order if c != "tag"]), "Tag_Key", order, FIRST_TAG)
    return keyed.select(F.col("Tag_Key").cast("int").alias("Tag_Key"), F.col("tag").alias("Tag_Name"), F.col("category").alias("Tag_Category"), F.col("domain").alias("Tag_Domain"))


def dim_tag(tags: list[tuple[str, str, str]], spark) -> DataFrame:
    """Keys in the order of definition."""
    return spark.createDataFrame([(FIRST_TAG + i, *t) for i, t in enumerate(tags)], "Tag_Key int, Tag_Name string, Tag_Category string, Tag_Domain string")


def document_ids(docs: DataFrame, source: str, date: str, order: list) -> DataFrame:
    """docs with Document_ID: N, source code, ddMMyy, running number of three digits or more.

    The columns of the order must tell rows apart; rows that tie share a number.
    Numbers come from one range-partitioned sort over source, day and order, so a
    day with very many documents of one source is spread over tasks.
    """
    codes = F.create_map(*[F.lit(x) for pair in fixed.SOURCE_CODES.items() for x in pair])
    base = docs.withColumn("_code", codes[F.lower(F.trim(source))])
    known = F.col("_code").isNotNull() & ~F.coalesce(F.col(source).rlike("^[0-9]+$"), F.lit(True))
    base = base.withColumn("_base", F.when(known, F.concat(F.lit("N"), "_code", ddmmyy(F.col(date))))).drop("_code")
    keys = numbered(base.where("_base is not null").select("_base", *order).distinct(), "_number", ["_base", *order], 0)
    first = keys.groupBy("_base").agg(F.min("_number").alias("_first"))
    ids = keys.join(first, "_base").select(*order, F.concat("_base", F.format_string("%03d", F.col("_number") - F.col("_first") + 1)).alias("Document_ID"))
    same = reduce(lambda a, b: a & b, [ids[c].eqNullSafe(base[c]) for c in order])
    out = base.join(ids, same & base["_base"].isNotNull(), "left")
    return out.select(*[base[c] for c in docs.columns], F.coalesce(ids["Document_ID"], F.lit("")).alias("Document_ID"))


def fact_rows(articles: DataFrame, sources: DataFrame, order: list, strict_compat: bool = False) -> DataFrame:
    """Fact columns from articles (date, source, headline, body, link, sentiment), numbered by an order of columns.

    Rows that tie on the order are one article for its number: the columns of
    the order must tell articles apart. Only they are sorted; the texts are joined.
    """
    keys = numbered(articles.select(*order), "Fact_ID", order, FIRST_FACT)
    same = [keys[c].eqNullSafe(articles[c]) for c in order]
    rows = articles.join(keys.select("Fact_ID", *order), reduce(lambda a, b: a & b, same)).drop(*[keys[c] for c in order])
    return fact_columns(rows, sources, strict_compat)


def fact_columns(rows: DataFrame, sources: DataFrame, strict_compat: bool = False) -> DataFrame:
    """Fact columns of articles that have their Fact_ID.

    Unknown sources get key -1 and 'Unknown'; with strict_compat key 1 and its name.
    """
    named = rows.withColumn("_source", clean_value(F.col("source"))).withColumn("_date", parse_date(F.col("date")))
    unknown = (-1, "Unknown", "Other")
    if strict_compat and (first := sources.where("Source_Key = 1").select("Source_Name", "Source_Type").first()):
        unknown = (1, *first)
    rows = named.join(sources.withColumnRenamed("Source_Name", "_name"), F.col("_source") == F.col("_name"), "left")
    d = F.coalesce("_date", F.lit("1900-01-01").cast("date"))
    return rows.select(
        "Fact_ID",
        date_key(F.col("_date")).alias("Date_Key"),
        F.coalesce("Source_Key", F.lit(unknown[0])).cast("int").alias("Source_Key"),
        F.year(d).alias("Year"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("Quarter"),
        F.date_format(d, "MMMM").alias("Month"),
        F.date_format(d, "yyyy-MM-dd").alias("Date_String"),
        F.coalesce("_name", F.lit(unknown[1])).alias("Source_Name"),
        F.coalesce("Source_Type", F.lit(unknown[2])).alias("Source_Type"),
        clean_value(F.col("headline")).alias("Headline"),
        clean_value(F.col("body")).alias("Body_Text"),
        clean_value(F.col("link")).alias("News_Link"),
        F.expr("try_cast(sentiment as double)").alias("Sentiment_Score"),
        F.lit(1).alias("Document_Count"),
    )


def bridge_tag(tags: DataFrame, dim: DataFrame, key: str = "Fact_ID") -> DataFrame:
    """(key, Tag_Key, Confidence_Score); of tags with one name the largest key counts."""
    last = dim.groupBy("Tag_Name").agg(F.max("Tag_Key").alias("Tag_Key"))
    return tags.join(last, tags["tag"] == last["Tag_Name"]).select(key, "Tag_Key", F.col("confidence").alias("Confidence_Score"))


def with_tag_counts(fact: DataFrame, bridge: DataFrame, key: str = "Fact_ID") -> DataFrame:
    """Fact with Tag_Count and Has_Key_Event."""
    counts = bridge.groupBy(key).agg(F.count("*").cast("int").alias("Tag_Count"))
    out = fact.join(counts, key, "left").withColumn("Tag_Count", F.coalesce("Tag_Count", F.lit(0)))
    return out.withColumn("Has_Key_Event", F.when(F.col("Tag_Count") > 0, "Yes").otherwise("No"))


def rollup(fact: DataFrame, by: list[str], how: str = "rollup") -> DataFrame:
    """Documents, average sentiment and their grouping id by `rollup`, `cube` or plain groups."""
    grouped = {"rollup": fact.rollup, "cube": fact.cube, "group": fact.groupBy}[how](*by)
    out = grouped.agg(F.count("*").alias("documents"), F.round(F.avg("value"), 6).alias("mean_value"), *([] if how == "group" else [F.grouping_id().alias("level")]))
    return out
