"""Queries over tables that change: upserts, replayed batches, a star that grows by loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmesh.plans import common as c
from quillmesh.plans import star_queries
from quillmesh.plans.increments import GrowingStar
from quillmesh.sources.snapshots import Table
from quillmesh.session import work_folder
from quillmesh.streaming import ingest


def table_upsert(spark, sf):
    """Orders, then a batch of changes (replaced and new keys, several of one key, some that came too late), delivered twice."""
    o = c.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("at"), "o_orderstatus", "o_totalprice")
    key, at = F.col("o_orderkey"), F.col("at")

    def changed(where: str, status: str, days: int, shift: int = 0):
        return o.where(where).select((key + shift).alias("o_orderkey"), (at + F.expr(f"interval {days} days")).alias("at"), F.lit(status).alias("o_orderstatus"), "o_totalprice")

    changes = changed("o_orderkey % 10 = 0", "X", 10).union(changed("o_orderkey % 30 = 0", "Y", 20)).union(changed("o_orderkey % 10 = 5", "S", -10)).union(changed("o_orderkey % 20 = 1", "N", 0, 10_000_000))
    table = Table(spark, work_folder(spark, "orders"), ["o_orderkey"], 8)
    table.upsert(o, ["at"])
    table.upsert(changes, ["at"], ("changes", 1))
    table.upsert(changes.withColumn("o_orderstatus", F.lit("Z")).withColumn("at", at + F.expr("interval 90 days")), ["at"], ("changes", 1))
    return table.read()


def stream_upsert_latest(spark, sf):
    """Each user's latest event, by a stream into a table; the stream is run again from the start and adds nothing."""
    table = Table(spark, work_folder(spark, "latest"), ["user_id"], 4)
    schema = c.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf}/events.parquet*").select("user_id", "ts", "event_id", "event_type", "value")
    for shown in (events, events.withColumn("event_type", F.lit("again"))):
        ingest.upsert_stream(shown, table, ["ts", "event_id"], "events", work_folder(spark, "stream-state"))
    return table.read()


def _grown(spark, sf) -> GrowingStar:
    """Documents loaded in three parts, the second of them twice and together with the first."""
    articles = star_queries._articles(spark, sf)
    growing = GrowingStar(spark, work_folder(spark, "star"))
    for part, rows in enumerate((F.col("doc_id") % 3 == 0, F.col("doc_id") % 3 <= 1, F.lit(True))):
        growing.load(articles.where(rows), part)
        if part == 1:
            growing.load(articles, part)
    return growing


def star_load_facts(spark, sf):
    return _grown(spark, sf).facts.read()


def star_load_sources(spark, sf):
    return _grown(spark, sf).sources.read().select(F.col("Source_Key").cast("int").alias("Source_Key"), "Source_Name")


def star_load_rollup(spark, sf):
    return _grown(spark, sf).totals(["Year", "Source_Key"])


QUERIES = {f.__name__: f for f in (table_upsert, stream_upsert_latest, star_load_facts, star_load_sources, star_load_rollup)}

_LOADED = star_queries._ARTICLES.replace("sources AS (SELECT row_number() OVER (ORDER BY name)::INT AS Source_Key, name AS Source_Name,", "old_sources AS (SELECT 1 AS Source_Key, name AS Source_Name,") + """, firsts AS (
  SELECT trim(source) AS Source_Name, min(doc_id % 3) AS part FROM articles WHERE trim(source) IN (SELECT name FROM named) GROUP BY 1
), sources AS (SELECT row_number() OVER (ORDER BY part, Source_Name)::INT AS Source_Key, Source_Name, (SELECT any_value(Source_Type) FROM old_sources o WHERE o.Source_Name = firsts.Source_Name) AS Source_Type FROM firsts
), facts AS (""" + star_queries._FACT.format(key="coalesce(Source_Key, -1)", name="coalesce(Source_Name, 'Unknown')", type="coalesce(Source_Type, 'Other')").replace("ORDER BY doc_id", "ORDER BY doc_id % 3, d NULLS FIRST, link").replace("1 AS Document_Count", "1 AS Document_Count, doc_id % 3 AS Load_Number") + ")"  # fmt: skip

ORACLES = {
    "table_upsert": """
WITH o AS (SELECT o_orderkey, o_orderdate AS "at", o_orderstatus, o_totalprice FROM orders), every AS (
  SELECT * FROM o
  UNION ALL SELECT o_orderkey, "at" + INTERVAL 10 DAYS, 'X', o_totalprice FROM o WHERE o_orderkey % 10 = 0
  UNION ALL SELECT o_orderkey, "at" + INTERVAL 20 DAYS, 'Y', o_totalprice FROM o WHERE o_orderkey % 30 = 0
  UNION ALL SELECT o_orderkey + 10000000, "at", 'N', o_totalprice FROM o WHERE o_orderkey % 20 = 1)
SELECT o_orderkey, max("at") AS "at", arg_max(o_orderstatus, "at") AS o_orderstatus, arg_max(o_totalprice, "at") AS o_totalprice FROM every GROUP BY o_orderkey""",
    "stream_upsert_latest": "SELECT user_id, ts, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "star_load_facts": f"WITH {_LOADED} SELECT * FROM facts",
    "star_load_sources": f"WITH {_LOADED} SELECT Source_Key, Source_Name FROM sources",
    "star_load_rollup": f"WITH {_LOADED} SELECT Year, Source_Key, count(*)::BIGINT AS documents, round(avg(Sentiment_Score), 6) AS mean_score, min(Date_Key) AS first_day, max(Date_Key) AS last_day FROM facts GROUP BY Year, Source_Key",
}
