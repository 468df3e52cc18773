"""JSON and XML payloads of market, filing and literature services as rows.

Payloads are landed as text (one per row); fetching is left to the job that
lands them. Each function turns a column of payloads into article-like rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.text import strip, strip_tags


def compact_time(ts: Column, end: bool = False) -> Column:
    """yyyyMMddHHmmss; the day's first or last second for a date."""
    return F.concat(F.date_format(ts, "yyyyMMdd"), F.lit("235959" if end else "000000"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def default_range(today: Column, days: int = 30) -> tuple[Column, Column]:
    """First and last day of the last `days` days; today is an argument so that runs repeat."""
    return F.date_sub(today, days), today


def literature(payloads: DataFrame, column: str) -> DataFrame:
    """title, author, date, extract, link of work items; missing months and days are 1."""
    schema = "message struct<items: array<struct<title: array<string>, author: array<struct<given: string, family: string>>, published: struct<`date-parts`: array<array<int>>>, abstract: string, URL: string, DOI: string>>>"
    items = payloads.select(F.inline(F.from_json(column, schema)["message"]["items"]))
    day = F.col("published.date-parts")[0]
    return items.select(
        F.get("title", 0).alias("title"),
        F.array_join(F.transform("author", lambda a: F.trim(F.concat_ws(" ", a["given"], a["family"]))), ", ").alias("author"),
        F.make_date(F.get(day, 0), F.coalesce(F.get(day, 1), F.lit(1)), F.coalesce(F.get(day, 2), F.lit(1))).alias("date"),
        strip_tags(F.coalesce("abstract", F.lit(""))).alias("extract"),
        F.coalesce("URL", F.concat(F.lit("https://doi.org/"), "DOI")).alias("link"),
    )


def bars(payloads: DataFrame, column: str) -> DataFrame:
    """day, open, high, low, close, volume of aggregate bars with millisecond times."""
    rows = payloads.select(F.inline(F.from_json(column, "results array<struct<t: bigint, o: double, h: double, l: double, c: double, v: double>>")["results"]))
    return rows.select(F.to_date(F.timestamp_millis("t")).alias("day"), F.col("o").alias("open"), F.col("h").alias("high"), F.col("l").alias("low"), F.col("c").alias("close"), F.col("v").alias("volume"))


def bar_text(symbol: Column) -> Column:
    """A line of text for a bar row."""
    return F.concat(symbol, F.lit(" closed at "), F.format_string("%.2f", "close"), F.lit(" on "), F.date_format("day", "yyyy-MM-dd"), F.lit(", change "), F.format_string("%.2f", 100 * (F.col("close") - F.col("open")) / F.col("open")), F.lit("%, volume "), F.col("volume").cast("long"))


def latest(days: Column) -> Column:
    """Entry of the last key of a date-keyed map."""
    return F.try_element_at(days, F.array_max(F.map_keys(days)))


def headline_items(xml: Column) -> Column:
    """array<struct<title,link,date>> of the items of a feed given as text, CDATA marks removed."""
    def part(item: Column, tag: str) -> Column:
        return strip(F.regexp_replace(F.regexp_extract(item, rf"(?s)<{tag}>(.*?)</{tag}>", 1), r"<!\[CDATA\[|\]\]>", ""))

    return F.transform(F.regexp_extract_all(xml, F.lit(r"(?s)<item>(.*?)</item>"), F.lit(1)), lambda i: F.struct(part(i, "title").alias("title"), part(i, "link").alias("link"), part(i, "pubDate").alias("date")))


def filings(rows: DataFrame, kinds: list[str], names: list[str], first: str, last: str, offset: int = 0, size: int = 100) -> DataFrame:
    """Filings of some kinds and companies in a date range, newest first; columns kind, company, filed, accession."""
    match = F.col("kind").isin(kinds) & F.col("filed").between(first, last)
    if names:
        match = match & F.lower("company").rlike("|".join(n.lower() for n in names))
    return rows.where(match).orderBy(F.desc("filed"), "accession").offset(offset).limit(size)


def registry(payloads: DataFrame, column: str, source: str) -> DataFrame:
    """key, name, ticker, cik, source from either registry layout: numbered objects, or a table of rows."""
    numbered = F.map_values(F.from_json(column, "map<string, struct<cik_str: string, ticker: string, title: string>>"))
    table = F.coalesce(F.from_json(column, "data struct<table: struct<rows: array<struct<symbol: string, name: string>>>>")["data"]["table"]["rows"], F.from_json(column, "data struct<rows: array<struct<symbol: string, name: string>>>")["data"]["rows"])
    rows = F.when(table.isNotNull(), F.transform(table, lambda r: F.struct(r["name"].alias("name"), r["symbol"].alias("ticker"), F.lit(None).cast("string").alias("cik")))).otherwise(F.transform(numbered, lambda r: F.struct(r["title"].alias("name"), r["ticker"].alias("ticker"), F.lpad(r["cik_str"], 10, "0").alias("cik"))))
    out = payloads.select(F.inline(rows)).where("name is not null and name != ''")
    return out.select(F.lower("name").alias("key"), "name", "ticker", "cik", F.lit(source).alias("source"))


def save_registry(rows: DataFrame, path: str, today: str) -> None:
    """Registry rows with the day they were fetched."""
    rows.withColumn("fetched", F.lit(today)).write.mode("overwrite").json(path)


def load_registry(spark, path: str, today: str, days: int = 7) -> tuple[DataFrame, bool]:
    """Saved registry rows, and whether they are older than so many days."""
    rows = spark.read.schema("key string, name string, ticker string, cik string, source string, fetched string").json(path)
    last = rows.agg(F.max(F.to_date("fetched"))).first()[0]
    stale = last is None or spark.range(1).select(F.datediff(F.lit(today).cast("date"), F.lit(last)) > days).first()[0]
    return rows.drop("fetched"), bool(stale)


def with_custom(registry_rows: DataFrame, custom: DataFrame) -> DataFrame:
    """Registry rows and companies of one's own (name, ticker); a registered name stays as it is."""
    own = custom.select(F.lower(F.trim("name")).alias("key"), F.trim("name").alias("name"), "ticker", F.lit(None).cast("string").alias("cik"), F.lit("custom").alias("source"))
    return registry_rows.unionByName(own.where("key != ''").dropDuplicates(["key"]).join(registry_rows.select("key"), "key", "left_anti"))


def company_filings(rows: DataFrame, name_or_ticker: str, first: str, last: str) -> DataFrame:
    """Filings of one company found by a part of its name or by its ticker, newest first."""
    same = F.contains(F.lower("company"), F.lit(name_or_ticker.lower())) | (F.upper("ticker") == name_or_ticker.upper())
    return rows.where(same & F.col("filed").between(first, last)).orderBy(F.desc("filed"), "accession")


def embedded_posts(html: Column, marker: str = "__NEXT_DATA__") -> Column:
    """URLs of posts inside a page's embedded framework JSON."""
    payload = F.regexp_extract(html, rf'(?s)<script[^>]*id="{marker}"[^>]*>(.*?)</script>', 1)
    return F.regexp_extract_all(payload, F.lit(r'"(?:url|link)"\s*:\s*"([^"]+)"'), F.lit(1))
