"""Queries over pages, JSON, links, increments, counts and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmesh.functions import html, text
from quillmesh.operators import incremental
from quillmesh.plans import common as c
from quillmesh.sources import sinks
from quillmesh.session import work_folder
from quillmesh.streaming import ingest

HTML = "html"


def _pages(spark, sf):
    return c.table(spark, sf, "pages")


def html_title(spark, sf):
    """Pages given an author and a date: in meta elements for even ids, in JSON-LD for odd ones."""
    n, day = F.col("page_id").cast("string"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("page_id").cast("int") % 300), "yyyy-MM-dd")
    meta = F.concat(F.lit('<head><meta name="author" content="Ann '), n, F.lit('"><meta property="article:published_time" content="'), day, F.lit('">'))
    ld = F.concat(F.lit('<head><script type="application/ld+json">{"author": {"name": "Bob '), n, F.lit('"}, "datePublished": "'), day, F.lit('"}</script>'))
    h = F.replace(F.col(HTML), F.lit("<head>"), F.when(F.col("page_id") % 2 == 0, meta).otherwise(ld))
    return _pages(spark, sf).select("page_id", html.title(h).alias("title"), html.language(h).alias("lang"), html.author(h).alias("author"), html.published(h).alias("published"))


def html_strip(spark, sf):
    return _pages(spark, sf).select("page_id", text.strip_tags(F.col(HTML)).alias("out"))


def html_paragraphs(spark, sf):
    return _pages(spark, sf).select("page_id", F.posexplode(html.paragraphs(F.col(HTML))).alias("pos", "paragraph"))


def html_body(spark, sf):
    return _pages(spark, sf).select("page_id", html.body(F.col(HTML)).alias("body"), html.paywalled(F.col(HTML)).alias("paywall"))


def html_links(spark, sf):
    return _pages(spark, sf).select("page_id", F.explode(html.links(F.col(HTML), html.host(F.col("url")))).alias("link"))


def url_filters(spark, sf):
    u = F.col("url")
    return _pages(spark, sf).select(
        "page_id",
        html.valid_url(u).alias("valid"),
        html.clean_url(F.regexp_replace(u, "^https?:", "")).alias("cleaned"),
        (u.contains("/en/") & ~u.rlike(r"page=|\.html$")).alias("article"),
        u.rlike(r"/[0-9]{3}([/?#.]|$)").alias("numbered"),
    )


def url_parts(spark, sf):
    u = F.col("url")
    return _pages(spark, sf).select("page_id", F.expr("try_parse_url(url, 'HOST')").alias("host"), F.expr("try_parse_url(url, 'PATH')").alias("path"), F.expr("try_parse_url(url, 'PROTOCOL')").alias("scheme"), incremental.link_key(u).alias("key"))


def title_from_slug(spark, sf):
    return _pages(spark, sf).select("page_id", text.title_from_slug(F.regexp_replace("url", r"/en/", "/new-results-")).alias("title"))


def json_props(spark, sf):
    return c.table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.from_json("props", "k int")["k"].alias("k2"))


def map_explode_range(spark, sf):
    """Daily maps per event type exploded to rows inside a date range."""
    daily = c.table(spark, sf, "events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("volume")).alias("bar"))
    series = daily.groupBy("event_type").agg(F.map_from_entries(F.collect_list(F.struct("day", "bar"))).alias("days"))
    rows = series.select("event_type", F.explode("days").alias("day", "bar"))
    return rows.where(F.col("day").between("2024-01-05", "2024-01-12")).select("event_type", "day", "bar.low", "bar.high", "bar.volume")


def latest_day(spark, sf):
    e = c.table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    daily = e.groupBy("event_type", "day").agg(F.count("*").alias("n"))
    return daily.groupBy("event_type").agg(F.max("day").alias("day"), F.max_by("n", "day").alias("n"))


def hourly_windows(spark, sf):
    w = F.window("ts", "6 hours")
    return c.table(spark, sf, "events").groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", "total")


def _doubled(spark, sf):
    """Pages with a second row for each that ends in a slash or a query."""
    p = _pages(spark, sf).select("page_id", F.regexp_replace("url", r"[?#].*$", "").alias("link"))
    return p.withColumn("at", F.lit(0)).unionByName(p.select((F.col("page_id") + 100000).alias("page_id"), F.concat("link", F.lit("/")).alias("link"), F.lit(1).alias("at")))


def link_dedup_first_seen(spark, sf):
    return incremental.first_seen(_doubled(spark, sf), incremental.link_key(F.col("link")), ["at", "page_id"]).select("page_id", "link")


def new_vs_existing_anti(spark, sf):
    rows = _doubled(spark, sf)
    return incremental.new_rows(rows, rows.where("page_id % 2 = 0 and at = 0"), "link", ["at", "page_id"]).select("page_id", "link")


def union_distinct_urls(spark, sf):
    p = _pages(spark, sf)
    return p.select("url").union(p.where("page_id % 3 = 0").select("url")).union(html_links(spark, sf).select("link")).distinct()


def upsert_by_key(spark, sf):
    o = c.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changes = o.where("o_orderkey % 10 = 0").select((F.col("o_orderkey") + F.when(F.col("o_orderkey") % 20 == 0, 10_000_000).otherwise(0)).alias("o_orderkey"), F.lit("X").alias("o_orderstatus"), F.col("o_totalprice"))
    return incremental.upsert(o, changes, "o_orderkey")


def qc_flag(spark, sf):
    d = c.table(spark, sf, "documents").select("doc_id", "source", text.normalize_core(F.coalesce("text", F.lit(""))).alias("t"))
    flag = F.when(F.trim(F.coalesce("source", F.lit(""))) == "", "empty").when(F.length("t") < 10, "empty").otherwise("ok")
    return d.groupBy(flag.alias("qc")).agg(F.count("*").alias("n"))


def length_filters(spark, sf):
    n = F.length(F.coalesce("text", F.lit("")))
    return c.table(spark, sf, "documents").select("doc_id", (n > 100).alias("long"), (n >= 50).alias("enough"), F.when(n < 100, "reject").when(n < 1000, "short").otherwise("full").alias("kind"))


def corpus_stats(spark, sf):
    d = c.table(spark, sf, "documents").join(c.table(spark, sf, "labels"), "doc_id", "left")
    return d.groupBy("lang").agg(F.count("*").alias("n"), F.count("quality").alias("labelled"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"), F.sum(F.length("text")).alias("chars"), F.round(F.avg("quality"), 6).alias("quality"))


def source_counts(spark, sf):
    return sinks.by_source(c.table(spark, sf, "documents"))


def coverage(spark, sf):
    """Share of documents with any keyword, by host."""
    from quillmesh.operators import match

    ids = match.matched_ids(c.table(spark, sf, "documents"), c.VOCAB)
    d = c.table(spark, sf, "documents").select("doc_id", "source").join(ids, "doc_id")
    return d.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("ids") != "").alias("matched"), F.round(100 * F.count_if(F.col("ids") != "") / F.count("*"), 2).alias("percent"))


def ordered_list_dedup(spark, sf):
    t = c.table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    return t.select("conv_id", F.array_join(F.array_distinct("turns.role"), ",").alias("roles"), F.size("turns").alias("turns"))


def price_text(spark, sf):
    o = c.table(spark, sf, "orders")
    return o.select("o_orderkey", F.concat(F.lit("Order "), F.col("o_orderkey"), F.lit(" of "), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(": "), F.format_string("%.2f", F.col("o_totalprice")), F.lit(" USD")).alias("line"))


def stream_dedup_available_now(spark, sf):
    """Pages read as a stream, every link twice (once with a slash more), deduplicated by link; the sink's keys."""
    schema = _pages(spark, sf).schema
    out, checkpoint = work_folder(spark, "stream-out"), work_folder(spark, "stream-state")
    source = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/pages.parquet*")
    base = F.regexp_replace("url", "/$", "")
    links = source.select(F.explode(F.array(base, F.concat(base, F.lit("/")))).alias("link"))
    ingest.run_available(ingest.dedup_stream(links, "link"), out, checkpoint)
    return spark.read.schema("link string, link_key string").parquet(out).select("link_key")


def stream_windowed(spark, sf):
    """Events per hour as a stream; closed windows only."""
    schema = c.table(spark, sf, "events").schema
    out, checkpoint = work_folder(spark, "stream-out"), work_folder(spark, "stream-state")
    source = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
    ingest.run_available(ingest.windowed_counts(source.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type"), out, checkpoint)
    return spark.read.schema("start timestamp, event_type string, n long").parquet(out)


QUERIES = {f.__name__: f for f in (html_title, html_strip, html_paragraphs, html_body, html_links, url_filters, url_parts, title_from_slug, json_props, map_explode_range, latest_day, hourly_windows, link_dedup_first_seen, new_vs_existing_anti, union_distinct_urls, upsert_by_key, qc_flag, length_filters, corpus_stats, source_counts, coverage, ordered_list_dedup, price_text, stream_dedup_available_now, stream_windowed)}

_STRIPTAGS = "trim(regexp_replace(regexp_replace({x}, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"
_NOISE = "html"
for _tag in html.NOISE:
    _NOISE = f"regexp_replace({_NOISE}, '(?is)<{_tag}[^>]*>.*?</{_tag}>', ' ', 'g')"
_EL = "nullif(" + _STRIPTAGS.replace("{x}", "regexp_extract(html, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}>', 1)") + ", '')"
_PARAS = f"list_filter(list_transform(regexp_extract_all({_NOISE}, '(?is)<p\\b[^>]*>(.*?)</p>', 1), lambda p: {_STRIPTAGS.replace('{x}', 'p')}), lambda p: length(p) > 40)"
_LINKS = "SELECT DISTINCT page_id, CASE WHEN starts_with(u, '/') THEN host || u ELSE u END AS link FROM (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS host, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS u FROM pages)"
_DOUBLED = "doubled AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS link, 0 AS seen FROM pages UNION ALL SELECT page_id + 100000, regexp_replace(url, '[?#].*$', '') || '/', 1 FROM pages), firsts AS (SELECT * FROM (SELECT *, regexp_replace(link, '/$', '') AS k, row_number() OVER (PARTITION BY regexp_replace(link, '/$', '') ORDER BY seen, page_id) AS p FROM doubled) WHERE p = 1)"
_ARTICLE = _STRIPTAGS.replace("{x}", f"regexp_extract({_NOISE}, '(?is)<article\\b[^>]*>(.*)</article>', 1)")
_BODY = f"CASE WHEN length({_ARTICLE}) > 200 THEN {_ARTICLE} ELSE array_to_string(list_filter({_PARAS}, lambda q: NOT regexp_matches(q, '(?i)^(menu|navigation|share|follow|subscribe|read more|click here|home|about|contact)')), chr(10) || chr(10)) END"
ORACLES = {
    "html_title": f"SELECT page_id, coalesce({_EL.replace('{tag}', 'h1')}, {_EL.replace('{tag}', 'title')}) AS title, nullif(regexp_extract(html, '(?i)<html[^>]*lang=[\"'']([^\"'']+)', 1), '') AS lang, CASE WHEN page_id % 2 = 0 THEN 'Ann ' ELSE 'Bob ' END || page_id AS author, strftime(DATE '2024-01-01' + (page_id % 300)::INT, '%Y-%m-%d') AS published FROM pages",
    "html_strip": f"SELECT page_id, {_STRIPTAGS.replace('{x}', 'html')} AS out FROM pages",
    "html_paragraphs": f"SELECT page_id, (generate_subscripts(ps, 1) - 1)::INT AS pos, unnest(ps) AS paragraph FROM (SELECT page_id, {_PARAS} AS ps FROM pages)",
    "html_body": f"SELECT page_id, CASE WHEN length({_BODY}) >= 100 THEN {_BODY} END AS body, regexp_matches(lower({_STRIPTAGS.replace('{x}', 'html')}), 'subscribe|subscription|premium|sign in to continue|log in to read|unlock this article|become a member|already a subscriber|free articles remaining|you have reached your|limited free articles') AS paywall FROM pages",
    "html_links": _LINKS,
    "url_filters": r"SELECT page_id, regexp_matches(url, '^https?://[^/\s]+') AS valid, 'https:' || regexp_replace(url, '^https?:', '') AS cleaned, contains(url, '/en/') AND NOT regexp_matches(url, 'page=|\.html$') AS article, regexp_matches(url, '/[0-9]{3}([/?#.]|$)') AS numbered FROM pages",
    "url_parts": "SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '^(https?)', 1) AS scheme, regexp_replace(url, '/$', '') AS key FROM pages",
    "title_from_slug": r"SELECT page_id, array_to_string(list_transform(string_split(replace(string_split(regexp_replace(replace(url, '/en/', '/new-results-'), '/*[?#].*$|/+$', '', 'g'), '/')[-1], '-', ' '), ' '), lambda w: upper(left(w, 1)) || lower(w[2:])), ' ') AS title FROM pages",
    "json_props": "SELECT event_id, (props::JSON ->> 'k')::INT AS k, (props::JSON ->> 'k')::INT AS k2 FROM events",
    "map_explode_range": "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, min(value) AS low, max(value) AS high, count(*)::BIGINT AS volume FROM events GROUP BY 1, 2 HAVING day BETWEEN '2024-01-05' AND '2024-01-12'",
    "latest_day": "SELECT event_type, max(day) AS day, arg_max(n, day)::BIGINT AS n FROM (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY event_type",
    "hourly_windows": "SELECT strftime(time_bucket(INTERVAL 6 HOURS, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "link_dedup_first_seen": f"WITH {_DOUBLED} SELECT page_id, link FROM firsts",
    "new_vs_existing_anti": f"WITH {_DOUBLED} SELECT page_id, link FROM firsts WHERE k NOT IN (SELECT regexp_replace(link, '/$', '') FROM doubled WHERE page_id % 2 = 0 AND seen = 0)",
    "union_distinct_urls": f"SELECT url FROM pages UNION SELECT link FROM ({_LINKS})",
    "upsert_by_key": "WITH ch AS (SELECT o_orderkey + CASE WHEN o_orderkey % 20 = 0 THEN 10000000 ELSE 0 END AS o_orderkey, 'X' AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 = 0) SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ch) UNION ALL SELECT * FROM ch",
    "qc_flag": f"SELECT CASE WHEN trim(coalesce(source, '')) = '' OR length({c.sql_core(chr(99) + 'oalesce(text, ' + chr(39) * 2 + ')')}) < 10 THEN 'empty' ELSE 'ok' END AS qc, count(*)::BIGINT AS n FROM documents GROUP BY 1",
    "length_filters": "SELECT doc_id, length(coalesce(text, '')) > 100 AS long, length(coalesce(text, '')) >= 50 AS enough, CASE WHEN length(coalesce(text, '')) < 100 THEN 'reject' WHEN length(text) < 1000 THEN 'short' ELSE 'full' END AS kind FROM documents",
    "corpus_stats": "SELECT lang, count(*)::BIGINT AS n, count(quality)::BIGINT AS labelled, coalesce(sum(toxic), 0)::BIGINT AS toxic, sum(length(text))::BIGINT AS chars, round(avg(quality), 6) AS quality FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang",
    "source_counts": "SELECT coalesce(nullif(source, ''), 'Unknown') AS source, count(*)::BIGINT AS rows FROM documents GROUP BY 1",
    "coverage": f"WITH {c.HITS_SQL} SELECT source, count(*)::BIGINT AS n, count(m)::BIGINT AS matched, round(100.0 * count(m) / count(*), 2)::DOUBLE AS percent FROM documents d LEFT JOIN (SELECT DISTINCT doc_id AS m FROM hits) h ON d.doc_id = h.m GROUP BY source",
    "ordered_list_dedup": "SELECT conv_id, array_to_string(list_transform(list_sort(list_transform(map_entries(fr), lambda e: [lpad(e.value::VARCHAR, 9, '0'), e.key])), lambda x: x[2]), ',') AS roles, n AS turns FROM (SELECT conv_id, map_from_entries(list((role, t))) AS fr, sum(n)::INT AS n FROM (SELECT conv_id, role, min(turn) AS t, count(*) AS n FROM conversations GROUP BY conv_id, role) GROUP BY conv_id)",
    "price_text": "SELECT o_orderkey, 'Order ' || o_orderkey || ' of ' || strftime(o_orderdate, '%Y%m%d') || ': ' || printf('%.2f', o_totalprice) || ' USD' AS line FROM orders",
    "stream_dedup_available_now": "SELECT DISTINCT regexp_replace(url, '/$', '') AS link_key FROM pages",
    "stream_windowed": "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOURS FROM events)",
}
