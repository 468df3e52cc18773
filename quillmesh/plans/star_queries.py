"""Queries over the star schema, its dimensions and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmesh.functions import fixed, text
from quillmesh.functions.dates import ddmmyy, parse_date
from quillmesh.functions.entities import source_type, tag_category
from quillmesh.operators import match, star
from quillmesh.plans import common as c

#: names put on the hosts src0, src1, ... of the documents, some of them not valid
_NAMES = ["BioSpace", "FierceBiotech", "STAT News", "FDA", "Nature Biotechnology", "12345", "x", "pharma voice", "University Press", "Genome Post", "***", " PMLive "]


def _articles(spark, sf):
    """Documents as articles: a name for the host, a date from doc_id, the first line as headline."""
    names = F.array(*map(F.lit, _NAMES))
    number = F.regexp_extract("source", "[0-9]+", 0).cast("int")
    day = F.date_add(F.lit("2019-12-28").cast("date"), (F.col("doc_id") % 1500).cast("int"))
    return c.table(spark, sf, "documents").select(
        "doc_id",
        F.element_at(names, number % len(_NAMES) + 1).alias("source"),
        F.when(F.col("doc_id") % 97 == 0, "not a date").when(F.col("doc_id") % 3 == 0, F.date_format(day, "yyyy/MM/dd")).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("date"),
        F.substring_index(F.coalesce("text", F.lit("")), "\n", 1).alias("headline"),
        F.coalesce("text", F.lit("")).alias("body"),
        F.concat(F.lit("https://example.org/"), "doc_id").alias("link"),
        F.when(F.col("doc_id") % 5 == 0, "n/a").otherwise((F.col("doc_id") % 21 / 10 - 1).cast("string")).alias("sentiment"),
        "lang",
    )


_ARTICLES = f"""
articles AS (
  SELECT doc_id, [{', '.join(c.quote(n) for n in _NAMES)}][(regexp_extract(source, '[0-9]+'))::INT % {len(_NAMES)} + 1] AS source,
    CASE WHEN doc_id % 97 = 0 THEN NULL ELSE DATE '2019-12-28' + (doc_id % 1500)::INT END AS d,
    trim(split_part(coalesce(text, ''), chr(10), 1)) AS headline, trim(coalesce(text, '')) AS body, 'https://example.org/' || doc_id AS link,
    CASE WHEN doc_id % 5 = 0 THEN NULL ELSE (doc_id % 21) / 10.0::DOUBLE - 1 END AS sentiment, lang
  FROM documents
), named AS (SELECT DISTINCT trim(source) AS name FROM articles WHERE length(trim(source)) BETWEEN 2 AND 100 AND NOT regexp_matches(trim(source), '^[0-9]+$') AND regexp_matches(trim(source), '[\\p{{L}}\\p{{N}}]')
), sources AS (SELECT row_number() OVER (ORDER BY name)::INT AS Source_Key, name AS Source_Name, {c.SOURCE_TYPE_SQL.replace('%s', 'name')} AS Source_Type FROM named)
"""
_TIME = """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS Date_Key, year(d)::INT AS Year, 'Q' || quarter(d) AS Quarter, monthname(d) AS Month, month(d)::INT AS Month_Number,
  day(d)::INT AS Day, dayname(d) AS Day_of_Week, week(d)::INT AS Week_of_Year, strftime(d, '%Y-%m-%d') AS Date_String"""


def dim_time(spark, sf):
    days = c.table(spark, sf, "events").select(F.to_date("ts").alias("d")).union(_articles(spark, sf).select(parse_date(F.col("date"))))
    return star.dim_time(days, "d")


def dim_source(spark, sf):
    return star.dim_source(_articles(spark, sf), "source")


def _defined(spark):
    """The tags of the keyword queries, in the order of their definition."""
    return star.dim_tag([t[:3] for t in c.TAGS], spark)


def dim_tag(spark, sf):
    """The words that documents begin with as tags, with their categories, in alphabetical order."""
    word = F.get(text.tokens(F.lower(F.coalesce("text", F.lit("")))), 0)
    tags = c.table(spark, sf, "documents").select(F.concat_ws(" ", word, F.when(F.col("doc_id") % 2 == 0, "therapy")).alias("tag")).where(word.isNotNull()).distinct()
    kind = tag_category(F.col("tag"))
    return star.dim_tag_rows(tags.select("tag", kind["category"].alias("category"), kind["domain"].alias("domain")), ["tag"])


def dim_entity(spark, sf):
    rows = c.table(spark, sf, "customer").select(F.col("c_name").alias("Entity_Name"), F.lit("Company").alias("Entity_Type"), F.col("c_mktsegment").alias("Entity_Domain"))
    return star.dim_entity(rows.unionByName(c.table(spark, sf, "supplier").select(F.col("s_name").alias("Entity_Name"), F.lit("Company").alias("Entity_Type"), F.lit("SUPPLY").alias("Entity_Domain"))))


def fact_document(spark, sf):
    return star.fact_rows(_articles(spark, sf), dim_source(spark, sf), ["doc_id"])


def fact_strict(spark, sf):
    return star.fact_rows(_articles(spark, sf), dim_source(spark, sf), ["doc_id"], strict_compat=True).select("Fact_ID", "Source_Key", "Source_Name", "Source_Type")


def _tags(spark, sf):
    docs = c.table(spark, sf, "documents").select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    return match.tag_confidence(match.keyword_hits(docs, c.VOCAB), docs, c.CATEGORIES, c.MEDICAL)


def bridge_fact_tag(spark, sf):
    return star.bridge_tag(_tags(spark, sf), _defined(spark), "doc_id")


def fact_tag_counts(spark, sf):
    facts = c.table(spark, sf, "documents").select("doc_id")
    return star.with_tag_counts(facts, bridge_fact_tag(spark, sf), "doc_id")


def source_code_ids(spark, sf):
    return star.document_ids(_articles(spark, sf), "source", "date", ["doc_id"]).select("doc_id", "Document_ID")


def ddmmyy_dates(spark, sf):
    return _articles(spark, sf).select("doc_id", ddmmyy(F.col("date")).alias("out"))


def source_type_rules(spark, sf):
    return _articles(spark, sf).select("source", source_type(F.col("source")).alias("source_type")).distinct()


def _facts(spark, sf):
    return c.table(spark, sf, "events").select(F.year("ts").alias("Year"), F.month("ts").alias("Month_Number"), "event_type", F.col("value"))


def star_rollup(spark, sf):
    return star.rollup(_facts(spark, sf), ["Year", "Month_Number", "event_type"])


def star_cube(spark, sf):
    return star.rollup(_facts(spark, sf), ["Month_Number", "event_type"], "cube")


def star_grouping_sets(spark, sf):
    c.table(spark, sf, "events").createOrReplaceTempView("star_events")
    return spark.sql("SELECT event_type, to_date(ts) AS day, count(*) AS documents, grouping_id() AS level FROM star_events GROUP BY GROUPING SETS ((event_type, to_date(ts)), (event_type), ())")


def tags_by_source(spark, sf):
    """Fact joined with the tag bridge and dimensions, rolled up by source type and tag category."""
    fact = fact_document(spark, sf).select((F.col("Fact_ID") - 1000).alias("at"), "Source_Type")
    order = c.table(spark, sf, "documents").select("doc_id")
    numbered = star.numbered(order, "at", ["doc_id"], 0)
    bridge = bridge_fact_tag(spark, sf).join(F.broadcast(_defined(spark)), "Tag_Key")
    return bridge.join(numbered, "doc_id").join(fact, "at").groupBy("Source_Type", "Tag_Category").agg(F.count("*").alias("links"), F.count_distinct("doc_id").alias("documents"), F.round(F.avg("Confidence_Score"), 6).alias("confidence"))


def top_tags_per_source(spark, sf):
    """The three most frequent tags of each host."""
    from pyspark.sql import Window

    counts = match.keyword_hits(c.table(spark, sf, "documents"), c.VOCAB).select("doc_id", "tag").distinct().join(c.table(spark, sf, "documents").select("doc_id", "source"), "doc_id").groupBy("source", "tag").agg(F.count("*").alias("n"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "tag"))).where("place <= 3")


from quillmesh.plans.text_queries import _CONF_SQL  # noqa: E402

_TAGDIM = c.sql_values([(10 + i, *t[:3]) for i, t in enumerate(c.TAGS)], "Tag_Key, Tag_Name, Tag_Category, Tag_Domain")
_FACT = """
SELECT (999 + row_number() OVER (ORDER BY doc_id))::BIGINT AS Fact_ID, coalesce(CAST(strftime(d, '%Y%m%d') AS INT), 19000101) AS Date_Key, {key} AS Source_Key,
  year(coalesce(d, DATE '1900-01-01'))::INT AS Year, 'Q' || quarter(coalesce(d, DATE '1900-01-01')) AS Quarter, monthname(coalesce(d, DATE '1900-01-01')) AS Month, strftime(coalesce(d, DATE '1900-01-01'), '%Y-%m-%d') AS Date_String,
  {name} AS Source_Name, {type} AS Source_Type, headline AS Headline, body AS Body_Text, link AS News_Link, sentiment AS Sentiment_Score, 1 AS Document_Count
FROM articles LEFT JOIN sources ON trim(articles.source) = sources.Source_Name"""


def _kind_sql(i: int) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains(tag, {c.quote(m)})" for m in r[2]) + f" THEN {c.quote(r[i])}" for r in fixed.TAG_CATEGORIES) + f" ELSE {c.quote(('Other', 'General')[i])} END"


_CODES = c.sql_values(list(fixed.SOURCE_CODES.items()), "name, code")

QUERIES = {
    "dim_time": dim_time, "dim_source": dim_source, "dim_tag": dim_tag, "dim_entity": dim_entity, "fact_document": fact_document, "fact_strict": fact_strict,
    "bridge_fact_tag": bridge_fact_tag, "fact_tag_counts": fact_tag_counts, "source_code_ids": source_code_ids, "ddmmyy_dates": ddmmyy_dates, "source_type_rules": source_type_rules,
    "star_rollup": star_rollup, "star_cube": star_cube, "star_grouping_sets": star_grouping_sets, "tags_by_source": tags_by_source, "top_tags_per_source": top_tags_per_source,
}
ORACLES = {
    "dim_time": f"WITH {_ARTICLES}, days AS (SELECT DISTINCT d FROM (SELECT ts::DATE AS d FROM events UNION ALL SELECT coalesce(d, DATE '1900-01-01') FROM articles)) {_TIME} FROM days",
    "dim_source": f"WITH {_ARTICLES} SELECT * FROM sources",
    "dim_tag": f"""WITH t AS (SELECT DISTINCT CASE WHEN doc_id % 2 = 0 THEN w || ' therapy' ELSE w END AS tag FROM (SELECT doc_id, {c.sql_tokens("lower(coalesce(text, ''))")}[1] AS w FROM documents) WHERE w IS NOT NULL)
      SELECT (9 + row_number() OVER (ORDER BY tag))::INT AS Tag_Key, tag AS Tag_Name, {_kind_sql(0)} AS Tag_Category, {_kind_sql(1)} AS Tag_Domain FROM t""",
    "dim_entity": "SELECT (199 + row_number() OVER (ORDER BY Entity_Name, Entity_Type, Entity_Domain))::INT AS Entity_Key, * FROM (SELECT DISTINCT c_name AS Entity_Name, 'Company' AS Entity_Type, c_mktsegment AS Entity_Domain FROM customer UNION SELECT s_name, 'Company', 'SUPPLY' FROM supplier)",
    "fact_document": f"WITH {_ARTICLES}" + _FACT.format(key="coalesce(Source_Key, -1)", name="coalesce(Source_Name, 'Unknown')", type="coalesce(Source_Type, 'Other')"),
    "fact_strict": f"WITH {_ARTICLES} SELECT Fact_ID, Source_Key, Source_Name, Source_Type FROM (" + _FACT.format(key="coalesce(Source_Key, 1)", name="coalesce(Source_Name, (SELECT Source_Name FROM sources WHERE Source_Key = 1))", type="coalesce(Source_Type, (SELECT Source_Type FROM sources WHERE Source_Key = 1))") + ")",
    "bridge_fact_tag": f"WITH {c.HITS_SQL}, {_CONF_SQL} SELECT doc_id, Tag_Key, confidence AS Confidence_Score FROM conf JOIN {_TAGDIM} ON tag = Tag_Name",
    "fact_tag_counts": f"WITH {c.HITS_SQL} SELECT d.doc_id, count(DISTINCT tag)::INT AS Tag_Count, CASE WHEN count(DISTINCT tag) > 0 THEN 'Yes' ELSE 'No' END AS Has_Key_Event FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY d.doc_id",
    "source_code_ids": f"WITH {_ARTICLES}, based AS (SELECT doc_id, CASE WHEN code IS NOT NULL THEN 'N' || code || coalesce(strftime(d, '%d%m%y'), '000000') END AS base FROM articles LEFT JOIN {_CODES} ON lower(trim(source)) = name) SELECT doc_id, CASE WHEN base IS NULL THEN '' ELSE base || format('{{:03d}}', row_number() OVER (PARTITION BY base ORDER BY doc_id)) END AS Document_ID FROM based",
    "ddmmyy_dates": f"WITH {_ARTICLES} SELECT doc_id, coalesce(strftime(d, '%d%m%y'), '000000') AS out FROM articles",
    "source_type_rules": f"WITH {_ARTICLES} SELECT DISTINCT source, {c.SOURCE_TYPE_SQL.replace('%s', 'source')} AS source_type FROM articles",
    "star_rollup": "SELECT year(ts)::INT AS Year, month(ts)::INT AS Month_Number, event_type, count(*)::BIGINT AS documents, round(avg(value), 6) AS mean_value, grouping(year(ts)::INT, month(ts)::INT, event_type)::BIGINT AS level FROM events GROUP BY ROLLUP (year(ts)::INT, month(ts)::INT, event_type)",
    "star_cube": "SELECT month(ts)::INT AS Month_Number, event_type, count(*)::BIGINT AS documents, round(avg(value), 6) AS mean_value, grouping(month(ts)::INT, event_type)::BIGINT AS level FROM events GROUP BY CUBE (month(ts)::INT, event_type)",
    "star_grouping_sets": "SELECT event_type, ts::DATE AS day, count(*)::BIGINT AS documents, grouping(event_type, ts::DATE)::BIGINT AS level FROM events GROUP BY GROUPING SETS ((event_type, ts::DATE), (event_type), ())",
    "tags_by_source": f"WITH {_ARTICLES}, {c.HITS_SQL}, {_CONF_SQL} SELECT coalesce(Source_Type, 'Other') AS Source_Type, Tag_Category, count(*)::BIGINT AS links, count(DISTINCT conf.doc_id)::BIGINT AS documents, round(avg(confidence), 6) AS confidence FROM conf JOIN {_TAGDIM} ON tag = Tag_Name JOIN articles ON conf.doc_id = articles.doc_id LEFT JOIN sources ON trim(articles.source) = sources.Source_Name GROUP BY 1, 2",
    "top_tags_per_source": f"WITH {c.HITS_SQL}, n AS (SELECT source, tag, count(DISTINCT h.doc_id)::BIGINT AS n FROM hits h JOIN documents d ON h.doc_id = d.doc_id GROUP BY source, tag) SELECT source, tag, n, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, tag) AS place FROM n) WHERE place <= 3",
}
