"""Readers: CSV layouts, rule and index files, feeds, sitemaps, price series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.text import clean_value, strip, unescape

MERGED = "`Amethos Id` string, Date string, Source string, `News link` string, Headline string, `Body/abstract/extract` string"
SOURCE = "NewsSite string, Name string, `Date of publishing the Article` string, Author string, Weblink string, Summary string"
STOCK = "Source string, Title string, Date string, Author string, Link string, Extract string"
MONGO = "_id string, author string, date string, extract string, link string, source string, scrapedAt string, __v string"
_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "DROPMALFORMED", "encoding": "UTF-8"}


def read_csv(spark: SparkSession, path, schema: str) -> DataFrame:
    """A quoted, possibly multi-line CSV; rows of another width, blank rows and repeated headers go."""
    df = spark.read.options(**_OPTIONS).schema(schema).csv(path)
    some = F.lit(False)
    for c in df.columns:
        some = some | (F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")) != "")
    first = df.columns[0]
    return df.where(some).where(F.coalesce(F.col(f"`{first}`").cast("string") != first, F.lit(True)) | F.coalesce(F.col(f"`{df.columns[1]}`").cast("string") != df.columns[1], F.lit(True)))


def articles(spark: SparkSession, path, layout: str) -> DataFrame:
    """date, source, link, title, extract from a file of a named layout (merged, source, stock, mongo)."""
    pick = {
        "merged": (MERGED, "Date", "Source", "`News link`", "Headline", "`Body/abstract/extract`"),
        "source": (SOURCE, "`Date of publishing the Article`", "NewsSite", "Weblink", "Name", "Summary"),
        "stock": (STOCK, "Date", "Source", "Link", "Title", "Extract"),
        "mongo": (MONGO, "date", "source", "link", "NULL", "extract"),
    }[layout]
    return read_csv(spark, path, pick[0]).select(*[clean_value(F.expr(c)).alias(n) for c, n in zip(pick[1:], ("date", "source", "link", "title", "extract"), strict=True)]).where("link != ''")


def rules(spark: SparkSession, path: str) -> DataFrame:
    """key, synonyms from lines 'Key: a, b'; comments and other lines go."""
    lines = spark.read.text(path).select(strip(F.col("value")).alias("line")).where("line != '' and not startswith(line, '#') and contains(line, ':')")
    parts = F.split("line", ":", 2)
    return lines.select(strip(parts[0]).alias("key"), F.filter(F.transform(F.split(parts[1], ","), strip), lambda s: s != "").alias("synonyms"))


def index_file(spark: SparkSession, path: str, id_part: str = "index", keyword_part: str = "keyword") -> DataFrame:
    """id, keywords by id from a CSV whose columns are found by a part of their name."""
    df = spark.read.options(**_OPTIONS).csv(path)
    ids = next(c for c in df.columns if id_part in c.lower())
    words = next(c for c in df.columns if keyword_part in c.lower())
    rows = df.select(clean_value(F.col(f"`{ids}`")).alias("id"), F.lower(clean_value(F.col(f"`{words}`"))).alias("keyword")).where("id != '' and keyword != ''")
    return rows.groupBy("id").agg(F.array_sort(F.collect_set("keyword")).alias("keywords"))


def entity_variants(spark: SparkSession, path: str) -> DataFrame:
    """variant (lower-cased), id, canonical, type, domain."""
    df = spark.read.options(**_OPTIONS).csv(path)
    return df.select(F.lower(F.trim("Entity_Variant")).alias("variant"), F.trim("Entity_ID").alias("id"), F.trim("Entity_Canonical").alias("canonical"), F.trim("Entity_Type").alias("type"), F.trim("Entity_Domain").alias("domain"))


def _xml_text(item: Column, tags: str) -> Column:
    """Text of the first of some elements of an item, CDATA marks and entities resolved, null if blank."""
    found = F.regexp_extract(item, rf"(?s)<(?:\w+:)?(?:{tags})(?:\s[^>]*[^/>])?>(.*?)</(?:\w+:)?(?:{tags})>", 1)
    return F.nullif(strip(unescape(found)), F.lit(""))


def _xml_list(item: Column, tags: str) -> Column:
    """Texts of all elements of some tags, or their `term` attributes, blanks dropped."""
    texts = F.regexp_extract_all(item, F.lit(rf"(?s)<(?:\w+:)?(?:{tags})(?:\s[^>]*[^/>])?>(.*?)</(?:\w+:)?(?:{tags})>"), F.lit(1))
    terms = F.regexp_extract_all(item, F.lit(rf"""<(?:\w+:)?(?:{tags})\s[^>]*term=["']([^"']*)["']"""), F.lit(1))
    return F.filter(F.transform(F.concat(texts, terms), lambda t: strip(unescape(t))), lambda t: t != "")


def longest(texts: list[Column]) -> Column:
    """The longest of some texts, the first among equals; blank if there is none."""
    return reduce(lambda a, b: F.when(F.length(b) > F.length(a), b).otherwise(a), [F.coalesce(t, F.lit("")) for t in texts])


def first_time(texts: list[Column]) -> Column:
    """The first of some texts that is a time in a feed's format."""
    formats = ["d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]
    return F.coalesce(*[F.try_to_timestamp(F.regexp_replace(t, r"^[A-Za-z]{3},\s*", ""), F.lit(f)) for t in texts for f in formats])


def parse_feed(feeds: DataFrame, column: str, *more: str) -> DataFrame:
    """Items of RSS and Atom feeds given as text; items without link go.

    title, link, guid, description, content (the longest candidate), author,
    date (as written), published, categories (in order, each once), enclosures.
    """
    items = feeds.select(*more, F.explode(F.regexp_extract_all(column, F.lit(r"(?s)<(?:item|entry)[\s>].*?</(?:item|entry)>"), F.lit(0))).alias("_i"))
    i = F.col("_i")
    guid = _xml_text(i, "guid|id")
    href = F.nullif(F.regexp_extract(i, r"""<link\s[^>]*href=["']([^"']+)["']""", 1), F.lit(""))
    link = F.coalesce(_xml_text(i, "link"), href, F.when(guid.startswith("http"), guid))
    dates = [_xml_text(i, t) for t in ("published", "pubDate", "date", "updated")]
    author = F.coalesce(_xml_text(i, "creator"), _xml_text(i, "name"), _xml_text(i, "author"))
    enclosures = F.regexp_extract_all(i, F.lit(r"""<(?:enclosure|media:content)\s[^>]*url=["']([^"']+)["']"""), F.lit(1))
    return items.select(
        *more,
        F.coalesce(_xml_text(i, "title"), F.lit("")).alias("title"),
        link.alias("link"),
        guid.alias("guid"),
        F.coalesce(_xml_text(i, "description"), _xml_text(i, "summary"), F.lit("")).alias("description"),
        longest([_xml_text(i, t) for t in ("encoded", "content", "description", "summary")]).alias("content"),
        author.alias("author"),
        F.coalesce(*dates).alias("date"),
        first_time(dates).alias("published"),
        F.array_distinct(F.concat(_xml_list(i, "category"), _xml_list(i, "subject"))).alias("categories"),
        enclosures.alias("enclosures"),
    ).where("link is not null")


def feed_items(spark: SparkSession, path) -> DataFrame:
    """Items of RSS and Atom files, of one path or several; a file that is no feed has none."""
    return parse_feed(spark.read.text(path, wholetext=True), "value")


def layout_of(columns: list[str]) -> str:
    """The name of a file's layout, told from its header."""
    header = ",".join(c.lower().strip() for c in columns)
    if "_id" in header and "source" in header:
        return "mongo"
    if "amethos" in header:
        return "merged"
    return "source" if "newssite" in header or "news site" in header else "stock"


def detected_articles(spark: SparkSession, path) -> DataFrame:
    """articles() of a file whose layout is told from its header."""
    return articles(spark, path, layout_of(spark.read.options(header="true", quote='"', escape='"').csv(path).columns))


def last_variants(spark: SparkSession, path: str) -> DataFrame:
    """variant, canonical of an entity file: the last row of a variant counts."""
    rows = entity_variants(spark, path).withColumn("_n", F.monotonically_increasing_id())
    return rows.groupBy("variant").agg(F.max_by("canonical", "_n").alias("canonical"))


def sitemap_urls(spark: SparkSession, path, tag: str = "url") -> DataFrame:
    """url, lastmod, priority, changefreq of sitemap files, gzipped ones too (tag 'sitemap': of an index)."""
    df = spark.read.format("xml").options(rowTag=tag).schema("loc string, lastmod string, priority double, changefreq string").load(path)
    return df.select(F.trim("loc").alias("url"), "lastmod", "priority", "changefreq").where("url != ''")


def daily_series(json_text: DataFrame, column: str) -> DataFrame:
    """day, open, high, low, close, volume rows of date-keyed JSON maps."""
    days = F.from_json(column, "map<string, map<string, string>>")
    rows = json_text.select(F.explode(days).alias("day", "bar"))

    def at(i: int, name: str):
        return F.expr(f"try_cast(bar['{i}. {name}'] as double)").alias(name)

    return rows.select(F.expr("try_cast(day as date)").alias("day"), *[at(i + 1, n) for i, n in enumerate(("open", "high", "low", "close", "volume"))])


def listing(df: DataFrame) -> DataFrame:
    """File, size, time of change and number of rows behind a file-based DataFrame."""
    return df.groupBy("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").agg(F.count("*").alias("rows"))
