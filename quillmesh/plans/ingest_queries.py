"""Queries over what comes in: streams of status events, sitemap trees, rejects of files, landed pages, queues."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from quillmesh.plans import collectors, entity_queries
from quillmesh.plans import common as c
from quillmesh.plans.source_queries import _FEED_SQL, _feeds, _fetched, _pages_sql, _stored
from quillmesh.sources import paged, readers, rejects, sinks, sitemaps
from quillmesh.session import work_folder
from quillmesh.streaming import ingest, status

PATIENCE = 6 * 3600


def stream_status(spark, sf):
    """Events as findings and readings of links, one link a user; the transitions of the status machine."""
    schema = c.table(spark, sf, "events").schema
    e = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
    n = F.col("event_id")
    found = n % 5 == 0
    detail = F.when(found, F.element_at(F.array(*map(F.lit, ("high", "medium", "low"))), (n / 5 % 3 + 1).cast("int"))).when(n % 3 == 0, "enough").otherwise("short")
    events = e.select(F.concat(F.lit("u"), "user_id").alias("link"), F.col("ts").cast("timestamp").alias("at"), n.alias("number"), F.when(found, "found").otherwise("read").alias("kind"), detail.alias("detail"))
    out, checkpoint = work_folder(spark, "stream-out"), work_folder(spark, "stream-state")
    ingest.run_available(status.transitions(events, PATIENCE), out, checkpoint)
    return spark.read.schema(status.TRANSITION).parquet(out)


MAPS = "https://maps.example.org/"


def sitemap_walk(spark, sf):
    """Pages in a tree of sitemaps with cycles, missing files and files that nothing leads to."""
    p = c.table(spark, sf, "pages").select("page_id", F.replace("url", F.lit("&"), F.lit("&amp;")).alias("url"))
    k = F.col("page_id") % 10
    url = F.concat(F.lit("<url><loc>"), "url", F.lit("</loc><lastmod>2024-01-01</lastmod></url>"))
    leaves = p.groupBy(k.alias("k")).agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(url), "\n"), F.lit("</urlset>")).alias("text"))
    leaves = leaves.select(F.concat(F.lit(MAPS), F.lit("leaf-"), "k", F.lit(".xml")).alias("file"), "text")
    trees = {"root": ["mid-0", "mid-1", "missing", "leaf-2"], "mid-0": ["root", "leaf-0", "leaf-3", "leaf-6", "leaf-9"], "mid-1": ["mid-0", "leaf-1", "leaf-4", "leaf-7", "leaf-1"]}
    made = [(f"{MAPS}{name}.xml", "<sitemapindex>" + "".join(f"<sitemap><loc> {MAPS}{x}.xml </loc></sitemap>" for x in children) + "</sitemapindex>") for name, children in trees.items()]
    files = leaves.unionByName(spark.createDataFrame(made, "file string, text string"))
    return sitemaps.walk(files, f"{MAPS}root.xml").select("depth", "url", "lastmod")


def csv_rejects(spark, sf):
    """Documents as lines of a file, some too short or too long, blank, or headers again; good rows and rejects."""
    k = F.col("doc_id") % 10
    columns = [F.col("doc_id").cast("string"), F.col("lang"), F.concat(F.lit('"a, '), "source", F.lit('"'))]
    line = F.when(k == 0, F.concat_ws(",", *columns[:2])).when(k == 1, F.concat_ws(",", *columns, F.lit("more"))).when(k == 2, " ,,").when(k == 3, "id,lang,source").otherwise(F.concat_ws(",", *columns))
    path = work_folder(spark, "lines")
    c.table(spark, sf, "documents").select(line.alias("value")).write.text(path)
    good, bad = rejects.split_rows(rejects.read_checked(spark, path, "id string, lang string, source string", multiline=False, header=False))
    return good.select("id", "lang", "source", F.lit(None).cast("string").alias("reason")).unionByName(bad.select(F.col("text").alias("id"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), "reason"))


def _land(rows, folder: str) -> None:
    for r in rows:
        with open(f"{folder}/page-{r.page:06d}.json", "w", encoding="utf-8") as f:
            json.dump([i.asDict() for i in r.items], f)


def paged_orders(spark, sf):
    """Orders landed as pages of 200, read back by the source of paged services."""
    folder = work_folder(spark, "pages").removeprefix("file://")
    os.makedirs(folder)
    o = c.table(spark, sf, "orders").select(F.floor(F.col("o_orderkey") / 200).cast("int").alias("page"), F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_totalprice").alias("price")).alias("item"))
    o.groupBy("page").agg(F.collect_list("item").alias("items")).foreachPartition(lambda rows: _land(rows, folder))
    paged.register(spark)
    return spark.read.format("landed_pages").schema("id string, price string").option("errors", 10).load(folder).select("id", F.col("price").cast("double").alias("price"))


def queue_drain(spark, sf):
    """The 50 best queued pages are read; all links with their new status."""
    scored = entity_queries._scored(spark, sf).select(F.col("url").alias("link"), "score", F.when(F.col("priority") == "low", "ignored").otherwise("queued").alias("status"))
    pages = c.table(spark, sf, "pages").select(F.col("url").alias("link"), "html")
    return collectors.drain_queue(scored, pages, 50)[1].select("link", "score", "status")


def hybrid_feed(spark, sf):
    items = readers.parse_feed(_feeds(spark, sf), "xml")
    return collectors.hybrid_feed(items, _fetched(spark, sf), _stored(spark, sf), "Feed", least=20).select("link", "title", "extract", "author")


def id_merge(spark, sf):
    """Orders with the ids of a second table where it has one, the greatest of several."""
    o = c.table(spark, sf, "orders")
    rows = o.select("o_custkey", "o_orderkey", F.concat(F.lit("old"), "o_orderkey").alias("id"))
    ids = o.where("o_orderkey % 3 = 0").select("o_custkey", F.concat(F.lit("N"), "o_orderkey").alias("id"))
    return sinks.with_ids(rows, ids, "o_custkey", "id")


QUERIES = {f.__name__: f for f in (stream_status, sitemap_walk, csv_rejects, paged_orders, queue_drain, hybrid_feed, id_merge)}


def _drain_sql() -> str:
    from quillmesh.plans.page_queries import _BODY

    return f"""WITH {entity_queries._SCORED}, best AS (SELECT url FROM routed WHERE priority <> 'low' ORDER BY score DESC, url LIMIT 50),
      done AS (SELECT url FROM best JOIN pages USING (url) WHERE length({_BODY}) >= 100)
      SELECT url AS link, score, CASE WHEN priority = 'low' THEN 'ignored' WHEN url IN (SELECT url FROM done) THEN 'scraped' ELSE 'queued' END AS status FROM routed"""


ORACLES = {
    "stream_status": f"""
WITH e AS (
  SELECT 'u' || user_id AS link, ts AS t, event_id AS n, event_id % 5 = 0 AS found, ['high', 'medium', 'low'][event_id // 5 % 3 + 1] AS prio, event_id % 5 <> 0 AND event_id % 3 = 0 AS enough FROM events
), firsts AS (SELECT * FROM e WHERE found QUALIFY row_number() OVER (PARTITION BY link ORDER BY t, n) = 1
), reads AS (SELECT e.link, min(e.t) AS r FROM e JOIN firsts f ON e.link = f.link AND (e.t > f.t OR (e.t = f.t AND e.n > f.n)) WHERE e.enough GROUP BY e.link
), fate AS (
  SELECT f.link, f.t, f.prio, r, f.t + INTERVAL {PATIENCE} SECONDS AS until, (SELECT max(t) FROM e WHERE e.link = f.link) AS latest, (SELECT max(t) FROM e) - INTERVAL 1 HOUR AS mark
  FROM firsts f LEFT JOIN reads USING (link)
)
SELECT link, t AS "at", NULL AS before, CASE prio WHEN 'high' THEN 'pending' WHEN 'medium' THEN 'queued' ELSE 'ignored' END AS after FROM fate
UNION ALL SELECT link, r, CASE prio WHEN 'high' THEN 'pending' ELSE 'queued' END, 'scraped' FROM fate WHERE prio <> 'low' AND r IS NOT NULL AND (prio = 'medium' OR r <= until)
UNION ALL SELECT link, until, 'pending', 'expired' FROM fate WHERE prio = 'high' AND (r IS NULL OR r > until) AND (latest > until OR mark > until)""",
    "sitemap_walk": "SELECT CASE WHEN page_id % 10 = 2 THEN 1 ELSE 2 END::INT AS depth, url, '2024-01-01' AS lastmod FROM pages WHERE page_id % 10 NOT IN (5, 8)",
    "csv_rejects": """SELECT CASE k WHEN 0 THEN doc_id || ',' || lang WHEN 1 THEN doc_id || ',' || lang || ',"a, ' || source || '",more' WHEN 2 THEN ' ,,' WHEN 3 THEN 'id,lang,source' ELSE doc_id::VARCHAR END AS id,
      CASE WHEN k > 3 THEN lang END AS lang, CASE WHEN k > 3 THEN 'a, ' || source END AS source, CASE k WHEN 0 THEN 'width' WHEN 1 THEN 'width' WHEN 2 THEN 'blank' WHEN 3 THEN 'header' END AS reason
      FROM (SELECT *, doc_id % 10 AS k FROM documents)""",
    "paged_orders": "SELECT o_orderkey::VARCHAR AS id, o_totalprice AS price FROM orders",
    "queue_drain": _drain_sql(),
    "hybrid_feed": f"""WITH {_FEED_SQL}, {_pages_sql()}, j AS (
        SELECT fresh.*, concat_ws(chr(10) || chr(10), CASE WHEN NOT contains(coalesce(body, ''), 'Short ' || n) THEN 'Short ' || n END, body, CASE WHEN rss THEN 'Categories: a, b' ELSE 'Categories: c' END) AS extract
        FROM fresh LEFT JOIN pg ON regexp_replace(fresh.link, '/$', '') = pg.key)
      SELECT link, title, extract, CASE WHEN rss THEN 'Ann ' || n ELSE 'Bob' END AS author FROM j WHERE length(extract) >= 20""",
    "id_merge": "SELECT o.o_custkey, o.o_orderkey, coalesce(x.id, 'old' || o.o_orderkey) AS id FROM orders o LEFT JOIN (SELECT o_custkey, max('N' || o_orderkey) AS id FROM orders WHERE o_orderkey % 3 = 0 GROUP BY o_custkey) x ON o.o_custkey = x.o_custkey",
}
