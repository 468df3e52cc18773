"""Links of news sources: the rule table of the sources, topics, validation, keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions import fixed
from quillmesh.functions.html import clean_url, valid_url
from quillmesh.functions.text import quoted


def holds_any(text: Column, parts: list[str]) -> Column:
    """Whether one of some strings occurs; true without any."""
    return text.rlike("|".join(map(quoted, parts))) if parts else F.lit(True)


def on_host(link: Column, host: str) -> Column:
    """Whether a link is of a host or one of its subdomains."""
    return F.coalesce(link.rlike(rf"^https?://([^/?#]*\.)?{quoted(host)}([/:?#]|$)"), F.lit(False))


def article_link(link: Column, rule: tuple) -> Column:
    """Whether a link is an article by one row of the source table."""
    _, host, required, parts, patterns, excluded, _, _ = rule
    tests = [on_host(link, host), *[F.contains(link, F.lit(p)) for p in required], *[~F.contains(link, F.lit(p)) for p in excluded]]
    if parts or patterns:
        tests.append(reduce(lambda a, b: a | b, [F.contains(link, F.lit(p)) for p in parts] + [link.rlike(p) for p in patterns]))
    return reduce(lambda a, b: a & b, tests)


def source_of(link: Column, sources: list[tuple] | None = None) -> Column:
    """struct(source, least, author) of the source whose article a link is, null if of none; one pass over the table."""
    out = F.lit(None)
    for rule in reversed(sources or fixed.SOURCES):
        out = F.when(article_link(link, rule), F.struct(F.lit(rule[0]).alias("source"), F.lit(rule[6]).alias("least"), F.lit(rule[7]).alias("author"))).otherwise(out)
    return out


def article_links(links: DataFrame, column: str = "link") -> DataFrame:
    """The rows whose link is an article of a known source, with source, least and author."""
    found = links.withColumn("_source", source_of(F.col(column))).where("_source is not null")
    return found.select(*links.columns, "_source.source", "_source.least", "_source.author")


def about(words: list[str], *texts: Column) -> Column:
    """Whether some texts together hold one of some words, whatever their case."""
    return holds_any(F.lower(F.concat_ws(" ", *texts)), words)


def validated(links: DataFrame, column: str = "url") -> DataFrame:
    """original, cleaned, valid: each link made complete and tested."""
    cleaned = clean_url(F.col(column))
    return links.select(F.col(column).alias("original"), cleaned.alias("cleaned"), valid_url(cleaned).alias("valid"))


def by_access(links: DataFrame, statuses: DataFrame | None = None, column: str = "url") -> DataFrame:
    """original, cleaned, kind: 'invalid', 'inaccessible' or 'valid'.

    statuses: url, status of links that a job has asked for; below 400 is accessible,
    and so is a link with any such answer. Without them every well-formed link is
    valid; with them a link that was never asked for is inaccessible.
    """
    rows = validated(links, column)
    if statuses is None:
        return rows.select("original", "cleaned", F.when(F.col("valid"), "valid").otherwise("invalid").alias("kind"))
    answered = statuses.groupBy(F.col("url").alias("cleaned")).agg(F.max(F.col("status").between(200, 399)).alias("_open"))
    kind = F.when(~F.col("valid"), "invalid").when(F.coalesce("_open", F.lit(False)), "valid").otherwise("inaccessible")
    return rows.join(answered, "cleaned", "left").select("original", "cleaned", kind.alias("kind"))


def link_hash(link: Column) -> Column:
    """A link's id: h = 31 * h + c over its UTF-16 units in 32 bits, without the sign; nothing for nothing."""
    two = F.lit(1 << 32)
    units = F.split(F.hex(F.encode(link, "UTF-16BE")), "(?<=\\G.{4})")

    def step(h: Column, unit: Column) -> Column:
        return F.pmod(h * 31 + F.conv(unit, 16, 10).cast("long"), two)

    total = F.aggregate(F.filter(units, lambda u: u != ""), F.lit(0).cast("long"), step)
    signed = F.when(total >= (1 << 31), total - two).otherwise(total)
    return F.when(F.coalesce(link, F.lit("")) == "", "").otherwise(F.abs(signed).cast("string"))


def recent(lastmod: Column, since: int = 2000) -> Column:
    """Whether a sitemap entry is of a year from `since` on, or of none."""
    year = F.nullif(F.regexp_extract(lastmod, r"^(\d{4})", 1), F.lit(""))
    return F.coalesce(year.cast("int") >= since, F.lit(True))
