"""Collector chains: feeds, sitemaps and pages to articles that are not stored yet.

Pages stand for fetched articles: link, html. Fetching is left to the job that
lands them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions import html, text
from quillmesh.operators import incremental, links
from quillmesh.plans import pipelines

COLUMNS = ("link", "title", "date", "author", "extract", "source")


def page_articles(pages: DataFrame) -> DataFrame:
    """link, title, date, author, extract of fetched pages."""
    h = F.col("html")
    return pages.select("link", html.title(h).alias("title"), html.published(h).alias("date"), html.author(h).alias("author"), html.body(h).alias("extract"))


def _by_link(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """Page fields under names of their own, by link key, each once; only pages whose key is wanted are read any further."""
    p = pages.withColumn("_key", incremental.link_key(F.col("link"))).join(wanted.select("_key").distinct(), "_key", "left_semi")
    first = p.groupBy("_key").agg(F.min_by(F.struct("link", "html"), F.struct("link")).alias("_p")).select("_key", "_p.*")
    fields = page_articles(first).withColumn("_key", incremental.link_key(F.col("link")))
    return fields.select("_key", F.struct("title", "date", "author", "extract").alias("_page"))


def _fresh(items: DataFrame, stored: DataFrame) -> DataFrame:
    rows = items.withColumn("link", html.clean_url(F.col("link"))).where(html.valid_url(F.col("link")))
    return incremental.new_rows(rows, stored, "link", ["date", "title"]).withColumn("_key", incremental.link_key(F.col("link")))


def scraped_feed(items: DataFrame, pages: DataFrame, stored: DataFrame, source: str, least: int = 50) -> DataFrame:
    """Feed items with the text of their page; the description where that has fewer than 100 characters."""
    rows = _fresh(items, stored)
    rows = rows.join(_by_link(pages, rows), "_key", "left")
    page, description = F.col("_page.extract"), text.strip_tags(F.coalesce("description", F.lit("")))
    body = F.when(F.length(page) >= 100, page).otherwise(description)
    return _article(rows, source, body).where(F.length("extract") >= least)


def hybrid_feed(items: DataFrame, pages: DataFrame, stored: DataFrame, source: str, least: int = 100) -> DataFrame:
    """Feed items joined with what their page adds: description, then page text, then categories."""
    rows = _fresh(items, stored)
    rows = rows.join(_by_link(pages, rows), "_key", "left")
    description, page = text.strip_tags(F.coalesce("description", F.lit(""))), F.coalesce("_page.extract", F.lit(""))
    apart = F.when((description != "") & ~F.contains(page, description), description)
    tags = F.when(F.size("categories") > 0, F.concat(F.lit("Categories: "), F.array_join("categories", ", ")))
    return _article(rows, source, F.concat_ws("\n\n", apart, F.nullif(page, F.lit("")), tags)).where(F.length("extract") >= least)


def _article(rows: DataFrame, source: str, body: Column) -> DataFrame:
    """Feed date and author win over the page's; the page's title over a blank one."""
    return rows.select(
        "link",
        F.coalesce(F.nullif("title", F.lit("")), "_page.title").alias("title"),
        F.coalesce("date", "_page.date").alias("date"),
        F.coalesce(text.strip_author_prefix(F.col("author")), "_page.author").alias("author"),
        body.alias("extract"),
        F.lit(source).alias("source"),
    )


def sitemap_articles(urls: DataFrame, pages: DataFrame, stored: DataFrame, rule: tuple, most: int | None = None, since: int = 2000, least: int = 100) -> DataFrame:
    """Articles of a sitemap: links that fit a source's rule and year, not stored yet, with the text of their page.

    most: newest links taken at most (None: all).
    """
    rows = urls.where(links.article_link(F.col("url"), rule) & links.recent(F.col("lastmod"), since)).select(F.col("url").alias("link"), F.col("lastmod").alias("date")).distinct()
    rows = incremental.new_rows(rows, stored, "link", ["date", "link"])
    if most is not None:
        rows = rows.orderBy(F.desc_nulls_last("date"), "link").limit(most)
    rows = rows.withColumn("_key", incremental.link_key(F.col("link")))
    rows = rows.join(_by_link(pages, rows), "_key")
    out = rows.select("link", F.coalesce("_page.title", text.title_from_slug(F.col("link"))).alias("title"), F.coalesce("_page.date", "date").alias("date"), F.coalesce(F.nullif(F.lit(rule[7]), F.lit("")), "_page.author").alias("author"), F.col("_page.extract").alias("extract"), F.lit(rule[0]).alias("source"))
    return out.where(F.length("extract") >= least)


def collect_hybrid(items: DataFrame, urls: DataFrame, stored: DataFrame, source: str, most: int | None = None) -> DataFrame:
    """Feed articles, and sitemap links that no feed item has with a title made from the link; newest first, `most` at most."""
    feed = pipelines.feed_articles(items, source).select(*COLUMNS)
    rest = urls.select(F.col("url").alias("link"), text.title_from_slug(F.col("url")).alias("title"), F.col("lastmod").alias("date"), F.lit(None).cast("string").alias("author"), text.title_from_slug(F.col("url")).alias("extract"), F.lit(source).alias("source"))
    keys = feed.select(incremental.link_key(F.col("link")).alias("_k")).distinct()
    rest = rest.join(keys, incremental.link_key(rest["link"]) == keys["_k"], "left_anti")
    rows = incremental.new_rows(feed.unionByName(rest), stored, "link", ["date", "title"])
    return rows if most is None else rows.orderBy(F.desc_nulls_last("date"), "link").limit(most)


def feed_metadata(items: DataFrame, stored: DataFrame, **words: list[str]) -> DataFrame:
    """New feed items with score, priority and status; see pipelines.scored_metadata."""
    return pipelines.scored_metadata(incremental.new_rows(items, stored, "link", ["date", "title"]), **words)


def drain_queue(scored: DataFrame, pages: DataFrame, n: int = 50, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """Articles of the best queued rows whose page has enough text, and all rows with their new status."""
    best = incremental.top_queue(scored, n)
    rows = best.withColumn("_key", incremental.link_key(F.col("link")))
    rows = rows.join(_by_link(pages, rows), "_key")
    done = rows.where(F.length("_page.extract") >= least).select("link", "_page.title", "_page.date", "_page.author", "_page.extract")
    return done, incremental.set_status(scored, done, "link", "queued", "scraped")


def run_totals(rows: DataFrame, saved: Column, by: str = "source") -> DataFrame:
    """Rows saved and failed by source."""
    return rows.groupBy(by).agg(F.count_if(saved).alias("saved"), F.count_if(~F.coalesce(saved, F.lit(False))).alias("failed"), F.count("*").alias("total"))


def without_output(sources: DataFrame, done: DataFrame, column: str = "source") -> DataFrame:
    """Sources that have no output yet."""
    return sources.join(done.select(column).distinct(), column, "left_anti")


def importable(articles: DataFrame, longer_than: int = 10) -> DataFrame:
    """Rows fit for import: with a link, and more than so many characters of text."""
    return articles.where((F.coalesce(F.trim("link"), F.lit("")) != "") & (F.length("extract") > longer_than))


def merged_rows(articles: DataFrame) -> DataFrame:
    """Articles in the merged layout; ids are given later, the title is kept as headline."""
    return articles.select(F.lit("").alias("Amethos Id"), F.col("date").alias("Date"), F.col("source").alias("Source"), F.col("link").alias("News link"), F.coalesce("title", F.lit("")).alias("Headline"), F.col("extract").alias("Body/abstract/extract"))
