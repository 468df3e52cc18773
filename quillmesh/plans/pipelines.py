"""Chains of operators: articles to the whole star, feeds to stored articles."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import html, score, text
from quillmesh.functions.dates import parse_date
from quillmesh.functions.entities import entity_type, likely_company
from quillmesh.operators import entity, incremental, known, match, star
from quillmesh.session import durable
from quillmesh.sources import readers, sinks


class Tables(Mapping[str, DataFrame]):
    """Tables by name, each made when it is first asked for: keys are checkpointed only for tables that somebody reads."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]) -> None:
        self._makers = {name: cache(make) for name, make in makers.items()}

    def __getitem__(self, name: str) -> DataFrame:
        return self._makers[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def build_star(articles: DataFrame, tags: list[tuple[str, str, str, list[str]]], medical: list[str], strict_compat: bool = False, companies: DataFrame | None = None, manual: DataFrame | None = None) -> Mapping[str, DataFrame]:
    """All tables from articles (id, date, source, headline, body, link, sentiment, matched_keywords).

    Names in matched_keywords that look like companies become entities, the
    others rejected_entities; known companies (name) are looked for in the text
    too, and manual names (norm, name) override. Articles are numbered once, by
    id; rows that share an id are told apart by a row number that is checkpointed.
    Entities are looked for when one of their tables is asked for.
    """
    spark = articles.sparkSession
    rows = durable(articles.withColumn("_at_row", F.monotonically_increasing_id()))
    sources = star.dim_source(rows, "source")
    keys = star.numbered(rows.select("id", "_at_row"), "Fact_ID", ["id", "_at_row"], star.FIRST_FACT)
    rows = rows.join(keys.select("_at_row", "Fact_ID"), "_at_row")
    fact = star.fact_columns(rows, sources, strict_compat)
    docs = rows.select("Fact_ID", text.normalize_text(text.combined_text(F.col("headline"), F.col("body"), F.lit(""))).alias("text"), F.concat_ws(" ", "headline", "body").alias("whole"), "matched_keywords")
    vocab = [(name, k) for name, _, _, keywords in tags for k in dict.fromkeys([*keywords, name])]
    by_text = match.tag_confidence(match.keyword_hits(docs, vocab, "Fact_ID"), docs, {t[0]: t[1] for t in tags}, medical, "Fact_ID")
    merged = match.merge_tags(match.column_tags(docs, vocab, "Fact_ID"), by_text, "Fact_ID")
    dim_tag = star.dim_tag([t[:3] for t in tags], spark)
    bridge = star.bridge_tag(merged, dim_tag)

    names = docs.select("Fact_ID", F.explode(text.split_multi(F.col("matched_keywords"))).alias("name"))

    @cache
    def entities() -> tuple[DataFrame, DataFrame]:
        good = names.where(likely_company(F.col("name"))).withColumn("confidence", F.lit(0.9))
        found = known.with_mentions(good, docs, "Fact_ID", "whole")
        seen = found.limit(0) if companies is None else known.with_mentions(known.known_companies(docs, companies, "Fact_ID"), docs, "Fact_ID", "whole")
        best = known.merge_entities(found, seen, manual, "Fact_ID")
        canonical = best.groupBy("norm").agg(F.min_by("name", F.struct(-F.length("name"), "name")).alias("Entity_Name"))
        dim = star.dim_entity(canonical.select("Entity_Name", entity_type(F.col("Entity_Name")).alias("Entity_Type"), F.lit("Healthcare").alias("Entity_Domain")))
        links = entity.resolve(best.select("Fact_ID", "name", "mentions"), dim).where("Entity_Key is not null")
        return dim, links.select("Fact_ID", "Entity_Key", F.col("mentions").cast("int").alias("Mention_Count"))

    return Tables({
        "Fact_Document": lambda: star.with_tag_counts(fact, bridge),
        "Dim_Time": lambda: star.dim_time(articles.select(parse_date(F.col("date")).alias("d")), "d"),
        "Dim_Source": lambda: sources,
        "Dim_Tag": lambda: dim_tag,
        "Dim_Entity": lambda: entities()[0],
        "Bridge_Fact_Tag": lambda: bridge,
        "Bridge_Fact_Entity": lambda: entities()[1],
        "rejected_entities": lambda: entity.rejected(names.where(~likely_company(F.col("name"))), "name"),
    })


CLEANED = "id long, date string, source string, headline string, body string, link string, sentiment string, matched_keywords string"


def csv_to_star(spark: SparkSession, path: str, tags: list[tuple[str, str, str, list[str]]], medical: list[str], out: str | None = None, fmt: str = "parquet", **options) -> Mapping[str, DataFrame]:
    """A file of cleaned articles to all star tables, written under `out` if it is given."""
    tables = build_star(readers.read_csv(spark, path, CLEANED), tags, medical, **options)
    if out is not None:
        sinks.write_star(tables, out, fmt)
    return tables


def feed_articles(items: DataFrame, source: str, least: int = 50) -> DataFrame:
    """Feed items as articles: the long content without tags, else the description, else the title; `least` characters or more."""
    content, description = text.strip_tags(F.coalesce("content", F.lit(""))), text.strip_tags(F.coalesce("description", F.lit("")))
    body = F.when(F.length(content) > 100, content).when(F.length(description) > 50, description).otherwise(F.coalesce("title", F.lit("")))
    footer = F.concat_ws("\n", body, F.concat(F.lit("Source: "), F.lit(source)), F.when(F.size("categories") > 0, F.concat(F.lit("Categories: "), F.array_join("categories", ", "))))
    rows = items.where(html.valid_url(html.clean_url(F.col("link")))).select(html.clean_url(F.col("link")).alias("link"), "title", F.col("date"), text.strip_author_prefix(F.col("author")).alias("author"), footer.alias("extract"), F.lit(source).alias("source"))
    return rows.where(F.length("extract") >= least)


def collect(items: DataFrame, stored: DataFrame, source: str) -> DataFrame:
    """Feed articles whose link isn't stored yet, each link once."""
    return incremental.new_rows(feed_articles(items, source), stored, "link", ["date", "title"])


def scored_metadata(items: DataFrame, high: list[str], medium: list[str], low: list[str], include: list[str], exclude: list[str], categories: list[str]) -> DataFrame:
    """Feed items with score, priority and status 'pending'."""
    t = F.lower(F.concat_ws(" ", "title", "description", "link", F.array_join("categories", " ")))
    value = score.relevance(score.keyword_score(t, high, medium, low), score.url_score(F.col("link"), include, exclude), score.category_score(F.col("categories"), categories))
    return items.withColumn("score", value).withColumn("priority", score.priority(F.col("score"))).withColumn("status", F.lit("pending"))


def route(scored: DataFrame, scraped: DataFrame) -> DataFrame:
    """Status after one round: high scraped (if the page was), medium queued, low ignored."""
    done = incremental.set_status(scored, scraped, "link", "pending", "scraped")
    rest: Column = F.when(F.col("priority") == "medium", "queued").when(F.col("priority") == "low", "ignored").otherwise("pending")
    return done.withColumn("status", F.when(F.col("status") == "pending", rest).otherwise(F.col("status")))
