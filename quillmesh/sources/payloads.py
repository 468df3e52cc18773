"""Payloads of market, filing and news services as articles.

Each function takes a column of JSON payloads, one answer of a service a row, and
returns source, title, name, date, author, link, extract. `today` stands for a
missing date, so that runs repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARTICLE = ("source", "title", "name", "date", "author", "link", "extract")


def _rows(payloads: DataFrame, column: str, schema: str, path: str, *more: str) -> DataFrame:
    parsed = F.from_json(column, schema)
    for part in path.split(".") if path else []:
        parsed = parsed[part]
    return payloads.select(*more, F.explode(parsed).alias("a"))


def _or(*values: Column | str) -> Column:
    """The first value that is not blank."""
    *tried, last = values
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in tried], F.lit(last) if isinstance(last, str) else last)


def _article(rows: DataFrame, **columns: Column | str) -> DataFrame:
    return rows.select(*[(F.lit(v) if isinstance(v, str) else v).alias(n) for n, v in ((n, columns[n]) for n in ARTICLE)])


def world_news(payloads: DataFrame, column: str, today: Column) -> DataFrame:
    """Articles of a news search: seen dates as yyyyMMdd..., the host as author."""
    rows = _rows(payloads, column, "articles array<struct<title: string, url: string, seendate: string, domain: string, sourcecountry: string>>", "articles")
    a = F.col("a")
    day = F.coalesce(F.try_to_timestamp(F.substring(a["seendate"], 1, 8), F.lit("yyyyMMdd")).cast("date"), today)
    title = _or(a["title"], "")
    return _article(rows, source="GDELT", title=title, name=title, date=day.cast("string"), author=_or(a["domain"], a["sourcecountry"], ""), link=_or(a["url"], ""), extract=title)


def medicines(payloads: DataFrame, column: str, today: Column) -> DataFrame:
    """Authorised medicines; a missing link is made from the name."""
    fields = "productName: string, name: string, activeSubstance: string, authDate: string, url: string, status: string, therapeuticArea: string, atc_code: string"
    rows = _rows(payloads, column, f"array<struct<{fields}>>", "")
    a = F.col("a")
    name = _or(a["productName"], a["name"], "Unknown")
    link = F.concat(F.lit("https://www.ema.europa.eu/en/medicines/human/EPAR/"), F.regexp_replace(F.lower(name), r"\s+", "-"))
    text = F.concat(name, F.lit(": Active substance: "), _or(a["activeSubstance"], "N/A"), F.lit(". Status: "), _or(a["status"], "Authorized"), F.lit(". Therapeutic area: "), _or(a["therapeuticArea"], a["atc_code"], "N/A"))
    return _article(rows, source="EMA", title=name, name=name, date=_or(a["authDate"], today.cast("string")), author="European Medicines Agency", link=_or(a["url"], link), extract=text)


def market_news(payloads: DataFrame, column: str, today: Column) -> DataFrame:
    """News of a ticker: the teaser, else the first 500 characters of the body, else the title."""
    rows = _rows(payloads, column, "array<struct<title: string, created: string, updated: string, author: string, url: string, teaser: string, body: string>>", "")
    a = F.col("a")
    title = _or(a["title"], "")
    text = _or(a["teaser"], F.substring(a["body"], 1, 500), title)
    return _article(rows, source="Benzinga", title=title, name=title, date=_or(a["created"], a["updated"], today.cast("string")), author=_or(a["author"], "Benzinga"), link=_or(a["url"], ""), extract=text)


def filing_news(payloads: DataFrame, column: str) -> DataFrame:
    """Filings with their kind, company and number."""
    fields = "companyName: string, formType: string, description: string, filedAt: string, linkToFilingDetails: string, linkToHtml: string, ticker: string, cik: string"
    rows = _rows(payloads, column, f"filings array<struct<{fields}>>", "filings")
    a = F.col("a")
    text = F.concat(a["formType"], F.lit(" filing by "), a["companyName"], F.lit(" ("), _or(a["ticker"], "N/A"), F.lit("). CIK: "), a["cik"], F.lit(". Filed on "), a["filedAt"], F.lit(". "), F.coalesce(a["description"], F.lit("")))
    return _article(rows, source="SEC EDGAR", title=F.concat(a["companyName"], F.lit(" - "), a["formType"]), name=F.concat(a["formType"], F.lit(": "), _or(a["description"], a["companyName"])), date=a["filedAt"], author=a["companyName"], link=_or(a["linkToFilingDetails"], a["linkToHtml"]), extract=text)


def ticker_news(payloads: DataFrame, column: str) -> DataFrame:
    """News items of a ticker."""
    rows = _rows(payloads, column, "results array<struct<title: string, publisher: struct<name: string>, published_utc: string, author: string, article_url: string, description: string>>", "results")
    a = F.col("a")
    return _article(rows, source="Polygon.io", title=a["title"], name=_or(a["publisher"]["name"], "Unknown"), date=a["published_utc"], author=_or(a["author"], "Polygon.io"), link=a["article_url"], extract=_or(a["description"], a["title"]))


def _billions(value: Column) -> Column:
    return F.when(F.coalesce(value, F.lit(0.0)) != 0, F.concat(F.format_string("%.2f", value / 1e9), F.lit("B"))).otherwise("N/A")


def quotes(payloads: DataFrame, column: str, symbol: str, today: Column) -> DataFrame:
    """A quote a row: price, change, market value and yearly range as text."""
    fields = "shortName string, regularMarketPrice string, regularMarketChangePercent double, marketCap double, fiftyTwoWeekHigh string, fiftyTwoWeekLow string"
    rows = payloads.select(F.col(symbol).alias("s"), F.from_json(column, fields).alias("a"))
    a, s = F.col("a"), F.col("s")
    text = F.concat(
        s, F.lit(" ("), _or(a["shortName"], "N/A"), F.lit("): Price: $"), _or(a["regularMarketPrice"], "N/A"), F.lit(", Change: "), F.coalesce(F.format_string("%.2f", a["regularMarketChangePercent"]), F.lit("N/A")),
        F.lit("%, Market Cap: $"), _billions(a["marketCap"]), F.lit(", 52W High: $"), _or(a["fiftyTwoWeekHigh"], "N/A"), F.lit(", 52W Low: $"), _or(a["fiftyTwoWeekLow"], "N/A"),
    )
    link = F.concat(F.lit("https://finance.yahoo.com/quote/"), s)
    return _article(rows, source="Yahoo Finance", title=F.concat(s, F.lit(" Stock Update")), name=F.concat(_or(a["shortName"], s), F.lit(" Market Data")), date=today.cast("string"), author="Yahoo Finance", link=link, extract=text)


def overviews(payloads: DataFrame, column: str, symbol: str, last: str, today: Column) -> DataFrame:
    """A company overview a row, with `last`: struct(day, close, volume) of its latest bar."""
    rows = payloads.select(F.col(symbol).alias("s"), F.from_json(column, "Name string, Sector string, Industry string, MarketCapitalization double, PERatio string, DividendYield string").alias("a"), F.col(last).alias("l"))
    a, s, bar = F.col("a"), F.col("s"), F.col("l")
    text = F.concat(
        s, F.lit(" ("), _or(a["Name"], "N/A"), F.lit("): Sector: "), _or(a["Sector"], "N/A"), F.lit(", Industry: "), _or(a["Industry"], "N/A"), F.lit(", Close: $"), _or(bar["close"].cast("string"), "N/A"), F.lit(", Volume: "), _or(bar["volume"].cast("string"), "N/A"),
        F.lit(", Market Cap: $"), _billions(a["MarketCapitalization"]), F.lit(", PE Ratio: "), _or(a["PERatio"], "N/A"), F.lit(", Dividend Yield: "), _or(a["DividendYield"], "N/A"),
    )
    link = F.concat(F.lit("https://www.alphavantage.co/query?function=OVERVIEW&symbol="), s)
    return _article(rows, source="Alpha Vantage", title=F.concat(s, F.lit(" - "), _or(a["Name"], s)), name=F.concat(s, F.lit(" Stock Data")), date=F.coalesce(bar["day"].cast("string"), today.cast("string")), author="Alpha Vantage", link=link, extract=text)


def in_range(articles: DataFrame, first: str, last: str) -> DataFrame:
    """Articles of a range of days, each link and title once, the earliest of them."""
    rows = articles.where(F.substring("date", 1, 10).between(first, last))
    best = F.min_by(F.struct(*[n for n in ARTICLE if n not in ("link", "title")]), F.struct("date", "extract"))
    return rows.groupBy("link", "title").agg(best.alias("b")).select("b.source", "title", "b.name", "b.date", "b.author", "link", "b.extract")
