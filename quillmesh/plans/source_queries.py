"""Queries over tag definitions, known companies, indexes, feeds, links, payloads and chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmesh.functions import fixed, html, text
from quillmesh.operators import elements, entity, known, links, match, star, tags
from quillmesh.plans import collectors, pipelines
from quillmesh.plans import common as c
from quillmesh.plans.text_queries import _CONF_SQL
from quillmesh.plans.entity_queries import _NAMES, _REG, _REGISTRY, _names, _registry
from quillmesh.session import work_folder
from quillmesh.sources import payloads, readers

def _tag_rows(spark, sf):
    """Rows of a tag index made of documents: their first words as names and keywords, every hundredth row general keywords."""
    words = text.tokens(F.coalesce("text", F.lit("")), 3)
    # a generated row, so that a text is split once and not for every use of its words
    d = _docs(spark, sf).select("doc_id", F.explode(F.array(words)).alias("w")).select("doc_id", *[F.coalesce(F.get("w", i), F.lit("none")).alias(f"w{i}") for i in range(3)])
    name = F.element_at(F.array(F.lit("acquisition "), F.concat("w0", F.lit(" series")), F.concat("w0", F.lit(" therapy")), F.lit("merger"), F.lit("CAR-T"), F.concat(F.lit(" "), "w0")), (F.col("doc_id") % 6 + 1).cast("int"))
    rest = [F.lit("").alias(f"k{i}") for i in range(3, 7)]
    general = F.col("doc_id") % 100 == 0
    return d.select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("doc_id") % 2 == 0, "Individually").otherwise("").alias("flag"), F.when(general, "").otherwise(name).alias("name"), F.concat(F.lit(" "), "w1").alias("k1"), F.when(F.col("doc_id") % 3 == 0, "nan").otherwise(F.concat(F.lit(" "), "w2")).alias("k2"), *rest)


def tag_definitions(spark, sf):
    return tags.define_tags(tags.tag_rows(_tag_rows(spark, sf)), joined="|").drop("row")


COMPANIES = ["attion", "thing", "of the", "que", "ering co", "O'Neil"]


def _docs(spark, sf):
    return c.table(spark, sf, "documents")


def _companies(spark):
    return spark.createDataFrame([(n,) for n in COMPANIES], "name string")


def known_companies(spark, sf):
    return known.known_companies(_docs(spark, sf), _companies(spark))


def _entities(spark, sf):
    docs = _docs(spark, sf)
    column = docs.where("doc_id % 3 = 0").select("doc_id", F.lit("Attion Inc.").alias("name"), F.lit(0.9).alias("confidence"))
    column = column.unionByName(docs.where("doc_id % 5 = 0").select("doc_id", F.lit("Gamma Corp").alias("name"), F.lit(0.9).alias("confidence")))
    manual = spark.createDataFrame([("gamma", "Gamma Group")], "norm string, name string")
    return known.merge_entities(known.with_mentions(column, docs), known.with_mentions(known.known_companies(docs, _companies(spark).where("name in ('attion', 'thing')")), docs), manual)


def article_entities(spark, sf):
    return _entities(spark, sf).select("doc_id", "norm", "name", "confidence")


def entity_frequency(spark, sf):
    return known.entity_frequency(_entities(spark, sf))


#: six indexes of (id, canonical name, keyword)
INDEXES = {
    "entity": [("E1", "Attion", "attion"), ("E1", "Attion", "antion"), ("E2", "Thing", "thing")],
    "ailment": [("A1", "Que", "que"), ("A2", "Die", "die")],
    "drug": [("D1", "Ering", "ering"), ("D1", "Ering", "oning")],
    "finevent": [("F1", "The", "the"), ("F2", "And", "and")],
    "regulatory": [("R1", "Und", "und")],
    "therapy": [("T1", "Los", "los"), ("T2", "Las", "las"), ("T3", "None", "zzzz")],
}


def _index_hits(spark, sf):
    """Every document's hits in all six indexes by one pass over its words."""
    vocab = [(f"{index}:{i}", k) for index, rows in INDEXES.items() for i, _, k in rows]
    hits = match.keyword_hits(_docs(spark, sf), vocab)
    return hits.select("doc_id", F.split("tag", ":")[0].alias("index"), F.split("tag", ":")[1].alias("id")).distinct()


def vocab_indexes(spark, sf):
    found = _index_hits(spark, sf).groupBy("doc_id").pivot("index", list(INDEXES)).agg(F.array_join(F.array_sort(F.collect_set("id")), "; "))
    blank = [F.coalesce(n, F.lit("")).alias(n) for n in INDEXES]
    return _docs(spark, sf).select("doc_id").join(found, "doc_id", "left").select("doc_id", *blank)


def vocab_counters(spark, sf):
    return _index_hits(spark, sf).groupBy("index").agg(F.count_distinct("doc_id").alias("documents"))


def vocab_canonical(spark, sf):
    names = spark.createDataFrame([(index, i, n) for index, rows in INDEXES.items() for i, n, _ in rows], "index string, id string, canonical string").distinct()
    found = _index_hits(spark, sf).join(F.broadcast(names), ["index", "id"])
    return found.groupBy("doc_id", "index").agg(F.array_join(F.array_sort(F.collect_set("canonical")), "; ").alias("names"))


def tags_by_confidence(spark, sf):
    docs = _docs(spark, sf).select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    conf = match.tag_confidence(match.keyword_hits(docs, c.VOCAB), docs, c.CATEGORIES, c.MEDICAL)
    order = F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("c"), "tag")))
    return conf.groupBy("doc_id").agg(F.array_join(F.transform(order, lambda t: t["tag"]), "; ").alias("tags"))


def _feeds(spark, sf):
    """Each page as a feed of two items, of RSS for even page ids and of Atom for odd ones; the second has no link."""
    p = c.table(spark, sf, "pages").select("page_id", F.regexp_replace("url", r"[?#].*$", "").alias("url"))
    n, day = F.col("page_id").cast("string"), F.date_format(F.date_add(F.lit("2024-03-01").cast("date"), (F.col("page_id") % 28).cast("int")), "yyyy-MM-dd")
    body = F.concat(F.lit("&lt;p&gt;Long text of page "), n, F.lit("&lt;/p&gt; "), F.repeat(F.lit("word "), (F.col("page_id") % 40).cast("int")))
    rss = F.concat(F.lit("<rss><channel><title>x</title><item><title><![CDATA[Page "), n, F.lit(" & more]]></title><link>"), F.col("url"), F.lit("</link><description>Short "), n, F.lit("</description><content:encoded>"), body, F.lit("</content:encoded><dc:creator>By Ann "), n, F.lit("</dc:creator><pubDate>"), day, F.lit("T08:00:00+00:00</pubDate><category>a</category><category>b</category><category>a</category><enclosure url=\"http://e/1.png\" type=\"image/png\"/></item><item><title>none</title></item></channel></rss>"))
    atom = F.concat(F.lit("<feed><entry><title>Page "), n, F.lit("</title><link rel=\"alternate\" href=\""), F.col("url"), F.lit("\"/><id>urn:"), n, F.lit("</id><summary>Short "), n, F.lit("</summary><content type=\"html\">"), body, F.lit("</content><author><name>Bob</name></author><updated>"), day, F.lit("T08:00:00Z</updated><category term=\"c\"/></entry></feed>"))
    return p.select("page_id", F.when(F.col("page_id") % 2 == 0, rss).otherwise(atom).alias("xml"))


def feed_fields(spark, sf):
    i = readers.parse_feed(_feeds(spark, sf), "xml", "page_id")
    return i.select("page_id", "title", "link", "description", "content", "author", F.date_format("published", "yyyy-MM-dd HH:mm").alias("published"), F.array_join("categories", ",").alias("categories"), F.array_join("enclosures", ",").alias("enclosures"))


def _stored(spark, sf):
    return c.table(spark, sf, "pages").where("page_id % 4 = 0").select(F.regexp_replace("url", r"[?#].*$", "").alias("link"))


def feed_collect(spark, sf):
    items = readers.parse_feed(_feeds(spark, sf), "xml")
    return pipelines.collect(items, _stored(spark, sf), "Feed").select("link", "title", "author", "extract", "source")


def _fetched(spark, sf):
    return c.table(spark, sf, "pages").select(F.regexp_replace("url", r"[?#].*$", "").alias("link"), "html")


def feed_scrape(spark, sf):
    items = readers.parse_feed(_feeds(spark, sf), "xml")
    return collectors.scraped_feed(items, _fetched(spark, sf), _stored(spark, sf), "Feed", least=9).select("link", "title", "extract", "author")


def sitemap_collect(spark, sf):
    rule = ("Example", "example.com", [], ["/en/", "/fr/"], [r"/de/\d+$"], ["/fr/1"], 100, "")
    p = c.table(spark, sf, "pages")
    urls = p.select(F.regexp_replace("url", r"[?#].*$", "").alias("url"), F.when(F.col("page_id") % 3 == 0, "1999-01-01").when(F.col("page_id") % 3 == 1, "2024-01-01").alias("lastmod"))
    return collectors.sitemap_articles(urls, _fetched(spark, sf), _stored(spark, sf), rule).select("link", "title", "extract", "source")


#: path beginnings under which pages are put on the hosts of the 24 sources
_PATHS = ["/news/", "/article/", "/biotech/", "/2024/05/", "/tag/news/", "/articles/12-", "/nbt/articles/", "/content/cen/news/", "/news-releases/health/", "/about/"]


def source_links(spark, sf):
    """Pages put on the hosts of the 24 sources under ten path beginnings each."""
    domains, paths = (F.array(*map(F.lit, x)) for x in ([s[1] for s in fixed.SOURCES], _PATHS))
    k = F.col("page_id")
    link = F.concat(F.lit("https://www."), F.element_at(domains, (k % len(fixed.SOURCES) + 1).cast("int")), "path", F.regexp_replace("url", "^https?://[^/]*/", ""))
    urls = c.table(spark, sf, "pages").select("page_id", "url", F.explode(paths).alias("path")).select("page_id", link.alias("link"))
    return urls.select("page_id", "link", links.source_of(F.col("link"))["source"].alias("source"))


def _source_sql() -> str:
    """Sources by rule: any of the parts or patterns (if there are some), all of the needed ones, none of the excluded."""
    rules = []
    for name, domain, all_of, any_of, patterns, none_of, _, _ in fixed.SOURCES:
        tests = [f"regexp_matches(link, '^https?://([^/?#]*\\.)?{domain.replace('.', chr(92) + '.')}([/:?#]|$)')"]
        tests += [f"contains(link, {c.quote(x)})" for x in all_of] + [f"NOT contains(link, {c.quote(x)})" for x in none_of]
        some = [f"contains(link, {c.quote(x)})" for x in any_of] + [f"regexp_matches(link, {c.quote(x)})" for x in patterns]
        rules.append(f"WHEN {' AND '.join(tests + ['(' + ' OR '.join(some) + ')'] * bool(some))} THEN {c.quote(name)}")
    return f"""SELECT page_id, link, CASE {' '.join(rules)} END AS source FROM (
      SELECT page_id, 'https://www.' || [{', '.join(c.quote(s[1]) for s in fixed.SOURCES)}][page_id % {len(fixed.SOURCES)} + 1] || unnest([{', '.join(map(c.quote, _PATHS))}]) || regexp_replace(url, '^https?://[^/]*/', '') AS link FROM pages)"""


def source_bodies(spark, sf):
    """Pages of the 24 sources: their paragraphs inside nested containers of the source, with advertisements and more around and between."""
    p = c.table(spark, sf, "pages").select("page_id", F.concat_ws(" ", F.regexp_extract_all("html", F.lit(r"(?is)<p\b[^>]*>.*?</p>"), F.lit(0))).alias("ps"))
    names = sorted(fixed.BODIES)
    source = F.element_at(F.array(*map(F.lit, names)), (F.col("page_id") % len(names) + 1).cast("int"))
    openings = {n: _opening(fixed.BODIES[n][0][-1]) if fixed.BODIES[n][0] else ("<article>", "</article>") for n in names}
    first, last = (F.element_at(F.array(*[F.lit(openings[n][i]) for n in names]), (F.col("page_id") % len(names) + 1).cast("int")) for i in (0, 1))
    noise = F.lit('<nav>menu <nav>inner</nav> menu</nav><div class="x ad">advert <div>in <div>it</div></div> more</div><script>if (a<b) "</div>"</script>')
    page = F.concat(F.lit("<html><body><div>before<div>nested</div></div>"), first, noise, F.lit("<div><div>"), "ps", F.lit("</div>"), noise, F.lit("</div>"), last, F.lit("<div>after</div></body></html>"))
    return elements.bodies(p.select("page_id", source.alias("source"), page.alias("html")), elements.rule_rows(spark)).select("page_id", "source", "body")


def _opening(rule: str) -> tuple[str, str]:
    """Tags that open and close what a rule names."""
    under, tag, name, kind, attribute = elements.selector(rule)
    own = "".join([f' id="{name}"' * bool(name), f' class="a {kind} b"' * bool(kind), f" {attribute}" * bool(attribute)])
    return f"<{under}>" * bool(under) + f"<{tag or 'div'}{own}>", f"</{tag or 'div'}>" + f"</{under}>" * bool(under)


def _bodies_sql() -> str:
    """The text of the paragraphs where the source has containers; the long paragraphs where it has none; none below 100 characters."""
    from quillmesh.plans.page_queries import _STRIPTAGS

    names = sorted(fixed.BODIES)
    held, longer = ([f(fixed.BODIES[n]) for n in names] for f in (lambda r: str(bool(r[0])).lower(), lambda r: str(r[2])))
    parts = f"list_filter(list_transform(regexp_extract_all(ps, '(?is)<p\\b[^>]*>(.*?)</p>', 1), lambda q: {_STRIPTAGS.replace('{x}', 'q')}), lambda q: length(q) > more)"
    return f"""SELECT page_id, source, CASE WHEN length(body) >= 100 THEN body END AS body FROM (
      SELECT page_id, source, CASE WHEN held AND length(whole) > 200 THEN whole WHEN held THEN CASE WHEN under THEN parts END ELSE parts END AS body FROM (
        SELECT *, {_STRIPTAGS.replace('{x}', 'ps')} AS whole, nullif(array_to_string({parts}, chr(10) || chr(10)), '') AS parts FROM (
          SELECT page_id, array_to_string(regexp_extract_all(html, '(?is)<p\\b[^>]*>.*?</p>'), ' ') AS ps, [{', '.join(map(c.quote, names))}][page_id % {len(names)} + 1] AS source, [{', '.join(held)}][page_id % {len(names)} + 1] AS held,
            [{', '.join(longer)}][page_id % {len(names)} + 1] AS more, [{', '.join(str(bool(fixed.BODIES[n][0] and elements.selector(fixed.BODIES[n][0][-1])[0] in ('article', 'main'))).lower() for n in names)}][page_id % {len(names)} + 1] AS under FROM pages)))"""


def topic_filter(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", links.about(["attion", "the que", "ß"], F.col("source"), F.col("text")).alias("about"))


def url_validation(spark, sf):
    p = c.table(spark, sf, "pages")
    u = F.when(F.col("page_id") % 4 == 0, F.regexp_replace("url", "^https?:", "")).when(F.col("page_id") % 4 == 1, F.regexp_replace("url", "^https?://", "")).when(F.col("page_id") % 4 == 2, F.lit("https:// broken")).otherwise(F.col("url"))
    out = links.validated(p.select("page_id", u.alias("url")), "url")
    return out.groupBy("original", "cleaned", "valid").agg(F.count("*").alias("n"))


def url_access(spark, sf):
    """Pages' links with the answers that a job got: 200, 302, 404, 503, or none; some links are broken."""
    p = c.table(spark, sf, "pages")
    k = F.col("page_id") % 6
    answers = p.where("page_id % 6 < 4").select("url", F.element_at(F.array(*map(F.lit, (200, 302, 404, 503))), (k + 1).cast("int")).alias("status"))
    shown = p.select(F.when(k == 5, F.concat(F.lit("https:// "), "page_id")).otherwise(F.regexp_replace("url", "^https?:", "")).alias("url"))
    secure = answers.select(F.regexp_replace("url", "^https?:", "https:").alias("url"), "status")
    return links.by_access(shown, secure)


def link_hash(spark, sf):
    return c.table(spark, sf, "pages").select("page_id", links.link_hash(F.col("url")).alias("id"))


def company_fuzzy(spark, sf):
    n = _names(spark, sf).select("id", F.when(F.col("id") % 2 == 0, F.substring("name", 1, 6)).otherwise(F.col("name")).alias("name"))
    return entity.fuzzy_valid(n, _registry(spark, sf)).select("id", "valid")


def entity_list(spark, sf):
    rows = c.table(spark, sf, "customer").select(F.array(F.struct(F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, "Company").otherwise("").alias("type")), F.struct(F.col("c_mktsegment").alias("name"), F.lit("Segment").alias("type"))).alias("found"))
    return star.entity_list(rows, "found")


def run_totals(spark, sf):
    d = _docs(spark, sf)
    return collectors.run_totals(d, F.length(F.coalesce("text", F.lit(""))) >= 500)


def import_rows(spark, sf):
    d = _docs(spark, sf).select(F.when(F.col("doc_id") % 7 == 0, " ").otherwise(F.concat(F.lit("https://example.org/"), "doc_id")).alias("link"), F.coalesce("text", F.lit("")).alias("extract"), F.lit("2024-01-01").alias("date"), "source", F.lit(None).cast("string").alias("title"))
    return collectors.merged_rows(collectors.importable(d)).select("Source", F.col("News link").alias("link"), "Headline", F.col("Body/abstract/extract").alias("body"))


def title_texts(spark, sf):
    t = html.title(F.col("html"))
    sited, long = F.concat(t, F.lit(" - PharmaTimes ")), F.concat(t, F.lit(". Unlock this article by subscribing"))
    first, last = text.edge_words(t)
    return c.table(spark, sf, "pages").select("page_id", html.without_site(sited, "PharmaTimes").alias("title"), html.without_marketing(long).alias("body"), text.title_case(F.concat(F.lit("beam-on o'neil "), F.col("page_id"))).alias("cased"), first.alias("first"), last.alias("last"))


def market_articles(spark, sf):
    """Payloads of seven services made from orders, read back as articles; no value lies halfway between two cents, where roundings differ."""
    o = c.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), F.col("o_totalprice").alias("v"), F.col("o_orderstatus").alias("s"))
    k, d = F.col("k").cast("string"), F.col("d")
    today = F.lit("2024-01-01").cast("date")

    def payload(value):
        return o.select("k", "d", "v", F.to_json(value).alias("json"))

    def item(**fields):
        return F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(n) for n, v in fields.items()])

    url = F.concat(F.lit("https://example.org/"), k)
    news = payload(F.struct(F.array(item(title=F.concat(F.lit("News "), k), url=url, seendate=F.concat(F.replace(d, F.lit("-"), F.lit("")), F.lit("T000000Z")), domain="example.org")).alias("articles")))
    drugs = payload(F.array(item(name=F.concat(F.lit("Drug "), k), authDate=d, status=F.when(F.col("s") == "O", "Open").otherwise(""))))
    market = payload(F.array(item(title=F.concat(F.lit("Market "), k), created=d, url=url, body=F.repeat(F.concat(k, F.lit(" ")), 200))))
    filed = payload(F.struct(F.array(item(companyName=F.concat(F.lit("Company "), k), formType="8-K", filedAt=d, linkToHtml=url, cik=k)).alias("filings")))
    ticker = payload(F.struct(F.array(item(title=F.concat(F.lit("Ticker "), k), published_utc=d, article_url=url)).alias("results")))
    quote = payload(item(shortName=F.concat(F.lit("Name "), k), regularMarketChangePercent=F.col("v") / 1000 + 1e-6, marketCap=F.col("v") * 1e6 + 1234)).withColumn("sym", F.concat(F.lit("S"), "k"))
    view = payload(item(Name=F.concat(F.lit("Name "), k), Sector="Health", MarketCapitalization=F.col("v") * 1e6 + 1234)).withColumn("sym", F.concat(F.lit("S"), "k")).withColumn("bar", F.struct(F.col("d").alias("day"), F.lit("9.5").alias("close"), F.lit("100").alias("volume")))
    out = [payloads.world_news(news, "json", today), payloads.medicines(drugs, "json", today), payloads.market_news(market, "json", today), payloads.filing_news(filed, "json"), payloads.ticker_news(ticker, "json"), payloads.quotes(quote, "json", "sym", today), payloads.overviews(view, "json", "sym", "bar", today)]
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return payloads.in_range(every, "1990-01-01", "2030-01-01").select("source", "title", "name", "date", "author", "link", "extract")


TAGS = [t for t in c.TAGS if t[0] != "idle"]


def _csv_star(spark, sf):
    """Documents written as a file of cleaned articles and read back into the star tables."""
    path = work_folder(spark, "articles")
    names = F.array(*map(F.lit, ["BioSpace", "STAT News", "12345", "Genome Post"]))
    rows = _docs(spark, sf).select(
        "doc_id", F.lit("2024-02-03").alias("date"), F.element_at(names, (F.col("doc_id") % 4 + 1).cast("int")).alias("source"), F.lit("head").alias("headline"), F.concat(F.lit("body "), F.coalesce("text", F.lit(""))).alias("body"),
        F.concat(F.lit("https://example.org/"), "doc_id").alias("link"), F.lit("0.5").alias("sentiment"), F.when(F.col("doc_id") % 2 == 0, "que platform; Gamma Corp").otherwise("some long words that are none").alias("matched_keywords"),
    )
    rows.write.options(header="true", quote='"', escape='"', quoteAll="true").csv(path)
    return pipelines.csv_to_star(spark, path, TAGS, c.MEDICAL, companies=_companies(spark).where("name = 'attion'"))


def csv_star_fact(spark, sf):
    return _csv_star(spark, sf)["Fact_Document"].select("Fact_ID", "Date_Key", "Source_Key", "Source_Name", "News_Link", "Sentiment_Score", "Body_Text")


def csv_star_entities(spark, sf):
    t = _csv_star(spark, sf)
    return t["Bridge_Fact_Entity"].join(t["Dim_Entity"], "Entity_Key").select("Fact_ID", "Entity_Key", "Entity_Name", "Entity_Type", "Mention_Count")


QUERIES = {f.__name__: f for f in (tag_definitions, known_companies, article_entities, entity_frequency, vocab_indexes, vocab_counters, vocab_canonical, tags_by_confidence, feed_fields, feed_collect, feed_scrape, sitemap_collect, source_links, source_bodies, topic_filter, url_validation, url_access, link_hash, company_fuzzy, entity_list, run_totals, import_rows, title_texts, market_articles, csv_star_fact, csv_star_entities)}

_TITLE_CASE = r"array_to_string([CASE WHEN i > 1 AND regexp_matches({n}[i-1:i-1], '\p{{L}}') THEN lower({n}[i:i]) ELSE upper({n}[i:i]) END FOR i IN range(1, length({n}) + 1)], '')"


def _known_sql(names: list[str]) -> str:
    """Known companies by scanning every text for every name."""
    return rf"""
hit AS (
  SELECT doc_id, t, k, length(regexp_extract(lower(t), '^((?s).*?)(?:^|[^\p{{L}}\p{{N}}_])' || k || '(?:$|[^\p{{L}}\p{{N}}_])', 0)) AS e
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents), (VALUES {', '.join('(' + c.quote(n.lower()) + ')' for n in names)}) AS v(k)
  WHERE regexp_matches(lower(t), '(^|[^\p{{L}}\p{{N}}_])' || k || '($|[^\p{{L}}\p{{N}}_])')
), spot AS (
  SELECT doc_id, t, k, strpos(lower(t)[greatest(1, e - length(k) - 1):], k) + greatest(1, e - length(k) - 1) - 1 AS a FROM hit
), near AS (
  SELECT doc_id, k, t[greatest(1, a - 20):a + length(k) - 1 + 20] AS ctx FROM spot
), shown AS (
  SELECT doc_id, regexp_extract(ctx, '(?:^|[^\p{{L}}\p{{N}}_])(' || k || '[^\s' || chr(11) || ',.;:]*)', 1) AS n FROM near
), known AS (
  SELECT DISTINCT doc_id, {_TITLE_CASE.format(n='n')} AS name FROM shown WHERE n <> ''
)"""


_ENTITIES_SQL = rf"""WITH {_known_sql(['attion', 'thing'])}, e AS (
  SELECT doc_id, 'Attion Inc.' AS name, 0.9 AS confidence, 0 AS f FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT doc_id, 'Gamma Corp', 0.9, 0 FROM documents WHERE doc_id % 5 = 0
  UNION ALL SELECT doc_id, name, 0.7, 1 FROM known
), n AS (
  SELECT *, CASE name WHEN 'Attion Inc.' THEN 'attion' WHEN 'Gamma Corp' THEN 'gamma' ELSE regexp_replace(regexp_replace(lower(name), '[\s\-.,;:+''"]+', '', 'g'), '^[^a-z0-9]+|[^a-z0-9]+$', '', 'g') END AS norm FROM e
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, norm ORDER BY confidence DESC, f, length(name) DESC, name) AS p FROM n WHERE norm <> ''
), merged AS (
  SELECT doc_id, norm, CASE norm WHEN 'gamma' THEN 'Gamma Group' ELSE name END AS name, CASE norm WHEN 'gamma' THEN 1.0 ELSE confidence END::DOUBLE AS confidence FROM best WHERE p = 1
)"""

_INDEX_SQL = f"""ix AS (SELECT DISTINCT doc_id, ix, id, name FROM (SELECT doc_id, unnest({c.sql_tokens("lower(coalesce(text, ''))")}) AS keyword FROM documents)
  JOIN {c.sql_values([(ix, i, n, k) for ix, rows in INDEXES.items() for i, n, k in rows], 'ix, id, name, keyword')} USING (keyword))"""

_LINK = "regexp_replace(url, '[?#].*$', '')"
_FEED_SQL = f"""f AS (
  SELECT page_id, {_LINK} AS link, page_id::VARCHAR AS n, page_id % 2 = 0 AS rss,
    'Page ' || page_id || CASE WHEN page_id % 2 = 0 THEN ' & more' ELSE '' END AS title,
    rtrim('<p>Long text of page ' || page_id || '</p> ' || repeat('word ', (page_id % 40)::INT)) AS content,
    rtrim('Long text of page ' || page_id || ' ' || repeat('word ', (page_id % 40)::INT)) AS bare,
    strftime(DATE '2024-03-01' + (page_id % 28)::INT, '%Y-%m-%d') AS d
  FROM pages
), fresh AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY regexp_replace(link, '/$', '') ORDER BY d || CASE WHEN rss THEN 'T08:00:00+00:00' ELSE 'T08:00:00Z' END, title) AS p FROM f) WHERE p = 1
    AND regexp_replace(link, '/$', '') NOT IN (SELECT regexp_replace({_LINK}, '/$', '') FROM pages WHERE page_id % 4 = 0)
)"""


def _pages_sql() -> str:
    """Body and title of pages by link, the first by link for each key."""
    from quillmesh.plans.page_queries import _BODY, _EL

    body = f"CASE WHEN length({_BODY}) >= 100 THEN {_BODY} END"
    return f"""pg AS (SELECT * FROM (SELECT {_LINK} AS link, regexp_replace({_LINK}, '/$', '') AS key, {body} AS body, coalesce({_EL.replace('{tag}', 'h1')}, {_EL.replace('{tag}', 'title')}) AS ptitle, row_number() OVER (PARTITION BY regexp_replace({_LINK}, '/$', '') ORDER BY {_LINK}) AS p FROM pages) WHERE p = 1)"""


def _market_sql() -> str:
    o = "(SELECT o_orderkey::VARCHAR AS k, strftime(o_orderdate, '%Y-%m-%d') AS d, o_totalprice AS v, o_orderstatus AS s, 'https://example.org/' || o_orderkey AS u FROM orders)"
    cap = "printf('%.2f', (v * 1e6 + 1234) / 1e9) || 'B'"
    parts = [
        ("'GDELT'", "'News ' || k", "'News ' || k", "d", "'example.org'", "u", "'News ' || k"),
        ("'EMA'", "'Drug ' || k", "'Drug ' || k", "d", "'European Medicines Agency'", "'https://www.ema.europa.eu/en/medicines/human/EPAR/drug-' || k", "'Drug ' || k || ': Active substance: N/A. Status: ' || CASE WHEN s = 'O' THEN 'Open' ELSE 'Authorized' END || '. Therapeutic area: N/A'"),
        ("'Benzinga'", "'Market ' || k", "'Market ' || k", "d", "'Benzinga'", "u", "left(repeat(k || ' ', 200), 500)"),
        ("'SEC EDGAR'", "'Company ' || k || ' - 8-K'", "'8-K: Company ' || k", "d", "'Company ' || k", "u", "'8-K filing by Company ' || k || ' (N/A). CIK: ' || k || '. Filed on ' || d || '. '"),
        ("'Polygon.io'", "'Ticker ' || k", "'Unknown'", "d", "'Polygon.io'", "u", "'Ticker ' || k"),
        ("'Yahoo Finance'", "'S' || k || ' Stock Update'", "'Name ' || k || ' Market Data'", "'2024-01-01'", "'Yahoo Finance'", "'https://finance.yahoo.com/quote/S' || k", f"'S' || k || ' (Name ' || k || '): Price: $N/A, Change: ' || printf('%.2f', v / 1000 + 1e-6) || '%, Market Cap: $' || {cap} || ', 52W High: $N/A, 52W Low: $N/A'"),
        ("'Alpha Vantage'", "'S' || k || ' - Name ' || k", "'S' || k || ' Stock Data'", "d", "'Alpha Vantage'", "'https://www.alphavantage.co/query?function=OVERVIEW&symbol=S' || k", f"'S' || k || ' (Name ' || k || '): Sector: Health, Industry: N/A, Close: $9.5, Volume: 100, Market Cap: $' || {cap} || ', PE Ratio: N/A, Dividend Yield: N/A'"),
    ]
    names = ("source", "title", "name", "date", "author", "link", "extract")
    return " UNION ALL ".join("SELECT " + ", ".join(f"{e} AS {n}" for e, n in zip(p, names, strict=True)) + f" FROM {o}" for p in parts)


def _title_sql() -> str:
    from quillmesh.plans.page_queries import _EL

    t = f"coalesce({_EL.replace('{tag}', 'h1')}, {_EL.replace('{tag}', 'title')})"
    return rf"""SELECT page_id, t AS title, t || '.' AS body, 'Beam-On O''Neil ' || page_id AS cased, string_split_regex(t, '\s+')[1] AS first, string_split_regex(t, '\s+')[-1] AS last FROM (SELECT page_id, {t} AS t FROM pages)"""


_TAGS_SQL = f"""
WITH w AS (SELECT doc_id, [coalesce(x, 'none') FOR x IN [ws[1], ws[2], ws[3]]] AS w FROM (SELECT doc_id, {c.sql_tokens("coalesce(text, '')")} AS ws FROM documents)
), named AS (
  SELECT doc_id, CASE WHEN doc_id % 100 = 0 THEN '' ELSE trim(['acquisition ', w[1] || ' series', w[1] || ' therapy', 'merger', 'CAR-T', ' ' || w[1]][(doc_id % 6 + 1)::INT]) END AS tag,
    list_filter([CASE WHEN lower(x) IN ('nan', 'none', '') THEN '' ELSE lower(x) END FOR x IN [w[2], CASE WHEN doc_id % 3 = 0 THEN '' ELSE w[3] END]], lambda x: x <> '') AS own
  FROM w
), general AS (SELECT coalesce(list(DISTINCT k), []) AS g FROM (SELECT unnest(own) AS k FROM named WHERE tag = '')
), tagged AS (
  SELECT doc_id, tag, list_sort(list_distinct([lower(tag)] || own || CASE WHEN regexp_matches(lower(tag), '{'|'.join(fixed.THERAPY_TERMS)}') THEN (SELECT g FROM general) ELSE [] END || VARIED)) AS ks, doc_id % 2 = 0 AS individual
  FROM named WHERE tag <> '' AND lower(tag) NOT IN ('nan', 'none')
) SELECT tag, array_to_string(ks, '|') AS keywords, individual, CATEGORY AS category, DOMAIN AS domain FROM (SELECT *, lower(tag || ' ' || array_to_string(ks, ' ')) AS t FROM tagged)"""
for _name, _sql in {
    "VARIED": """CASE WHEN tag = 'acquisition' THEN ['acquire', 'acquired', 'acquires', 'buy', 'purchase', 'purchased'] WHEN tag = 'merger' THEN ['combine', 'combined', 'merge', 'merged', 'merges']
    WHEN ends_with(tag, ' series') THEN ['series series', 'seriesseries', 'series round'] ELSE [] END""",
    "CATEGORY": "CASE " + " ".join("WHEN " + " OR ".join(f"contains(t, {c.quote(m)})" for m in r[2]) + f" THEN {c.quote(r[0])}" for r in fixed.TAG_CATEGORIES) + " ELSE 'Other' END",
    "DOMAIN": "CASE " + " ".join("WHEN " + " OR ".join(f"contains(t, {c.quote(m)})" for m in r[2]) + f" THEN {c.quote(r[1])}" for r in fixed.TAG_CATEGORIES) + " ELSE 'General' END",
}.items():
    _TAGS_SQL = _TAGS_SQL.replace(_name, _sql)
_HASH = "list_reduce([0::BIGINT] || [unicode(x)::BIGINT FOR x IN string_split(url, '')], lambda h, x: (h * 31 + x) % 4294967296)"
ORACLES = {
    "tag_definitions": _TAGS_SQL,
    "known_companies": f"WITH {_known_sql(COMPANIES)} SELECT doc_id, name, 0.7::DOUBLE AS confidence FROM known",
    "article_entities": f"{_ENTITIES_SQL} SELECT doc_id, norm, name, confidence FROM merged",
    "entity_frequency": f"{_ENTITIES_SQL} SELECT norm, count(*)::BIGINT AS documents FROM merged GROUP BY norm",
    "vocab_indexes": f"WITH {_INDEX_SQL} SELECT d.doc_id, {', '.join(f'''coalesce((SELECT string_agg(id, '; ' ORDER BY id) FROM (SELECT DISTINCT id FROM ix WHERE ix.doc_id = d.doc_id AND ix.ix = '{n}')), '') AS {n}''' for n in INDEXES)} FROM documents d",
    "vocab_counters": f'WITH {_INDEX_SQL} SELECT ix AS "index", count(DISTINCT doc_id)::BIGINT AS documents FROM ix GROUP BY ix',
    "vocab_canonical": f"""WITH {_INDEX_SQL} SELECT doc_id, ix AS "index", string_agg(name, '; ' ORDER BY name) AS names FROM (SELECT DISTINCT doc_id, ix, name FROM ix) GROUP BY doc_id, ix""",
    "tags_by_confidence": f"WITH {c.HITS_SQL}, {_CONF_SQL} SELECT doc_id, string_agg(tag, '; ' ORDER BY round(confidence * 100)::INT DESC, tag) AS tags FROM conf GROUP BY doc_id",
    "feed_fields": f"""WITH {_FEED_SQL} SELECT page_id, title, link, 'Short ' || n AS description, content, CASE WHEN rss THEN 'By Ann ' || n ELSE 'Bob' END AS author, d || ' 08:00' AS published,
      CASE WHEN rss THEN 'a,b' ELSE 'c' END AS categories, CASE WHEN rss THEN 'http://e/1.png' ELSE '' END AS enclosures FROM f""",
    "feed_collect": f"""WITH {_FEED_SQL}, sized AS (SELECT *, CASE WHEN length(bare) > 100 THEN bare ELSE title END || chr(10) || 'Source: Feed' || chr(10) || CASE WHEN rss THEN 'Categories: a, b' ELSE 'Categories: c' END AS extract FROM f),
      firsts AS (SELECT *, row_number() OVER (PARTITION BY regexp_replace(link, '/$', '') ORDER BY d || CASE WHEN rss THEN 'T08:00:00+00:00' ELSE 'T08:00:00Z' END, title) AS p FROM sized WHERE length(extract) >= 50)
      SELECT link, title, CASE WHEN rss THEN 'Ann ' || n ELSE 'Bob' END AS author, extract, 'Feed' AS source FROM firsts WHERE p = 1 AND regexp_replace(link, '/$', '') NOT IN (SELECT regexp_replace({_LINK}, '/$', '') FROM pages WHERE page_id % 4 = 0)""",
    "feed_scrape": f"""WITH {_FEED_SQL}, {_pages_sql()}, j AS (SELECT fresh.*, coalesce(body, 'Short ' || n) AS extract FROM fresh LEFT JOIN pg ON regexp_replace(fresh.link, '/$', '') = pg.key)
      SELECT link, title, extract, CASE WHEN rss THEN 'Ann ' || n ELSE 'Bob' END AS author FROM j WHERE length(extract) >= 9""",
    "sitemap_collect": rf"""WITH {_pages_sql()}, u AS (SELECT DISTINCT {_LINK} AS link, CASE page_id % 3 WHEN 0 THEN '1999-01-01' WHEN 1 THEN '2024-01-01' END AS d FROM pages), ok AS (
        SELECT * FROM u WHERE regexp_matches(link, '^https?://([^/?#]*\.)?example\.com([/:?#]|$)') AND (contains(link, '/en/') OR contains(link, '/fr/') OR regexp_matches(link, '/de/[0-9]+$')) AND NOT contains(link, '/fr/1') AND coalesce(d, '2024') >= '2000'
      ), fresh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY regexp_replace(link, '/$', '') ORDER BY d NULLS FIRST, link) AS p FROM ok) WHERE p = 1 AND regexp_replace(link, '/$', '') NOT IN (SELECT regexp_replace({_LINK}, '/$', '') FROM pages WHERE page_id % 4 = 0))
      SELECT fresh.link, ptitle AS title, body AS extract, 'Example' AS source FROM fresh JOIN pg ON regexp_replace(fresh.link, '/$', '') = pg.key WHERE length(body) >= 100""",
    "source_links": _source_sql(),
    "source_bodies": _bodies_sql(),
    "topic_filter": "SELECT doc_id, contains(t, 'attion') OR contains(t, 'the que') OR contains(t, 'ß') AS about FROM (SELECT doc_id, lower(concat_ws(' ', source, text)) AS t FROM documents)",
    "url_validation": rf"""SELECT original, cleaned, regexp_matches(cleaned, '^https?://[^/\s]+') AS valid, count(*)::BIGINT AS n FROM (SELECT original, CASE WHEN starts_with(original, '//') THEN 'https:' || original WHEN regexp_matches(original, '^https?://') THEN original ELSE 'https://' || original END AS cleaned
      FROM (SELECT CASE page_id % 4 WHEN 0 THEN regexp_replace(url, '^https?:', '') WHEN 1 THEN regexp_replace(url, '^https?://', '') WHEN 2 THEN 'https:// broken' ELSE url END AS original FROM pages)) GROUP BY original, cleaned""",
    "url_access": """WITH p AS (SELECT page_id % 6 AS k, page_id, 'https:' || regexp_replace(url, '^https?:', '') AS u FROM pages), a AS (SELECT DISTINCT u FROM p WHERE k < 2)
      SELECT CASE WHEN k = 5 THEN 'https:// ' || page_id ELSE regexp_replace(u, '^https:', '') END AS original, CASE WHEN k = 5 THEN 'https:// ' || page_id ELSE u END AS cleaned,
        CASE WHEN k = 5 THEN 'invalid' WHEN u IN (SELECT u FROM a) THEN 'valid' ELSE 'inaccessible' END AS kind FROM p""",
    "link_hash": f"SELECT page_id, abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END)::VARCHAR AS id FROM (SELECT page_id, {_HASH} AS h FROM pages)",
    "company_fuzzy": f"WITH {_NAMES}, {_REGISTRY}, r AS (SELECT * FROM registry), n AS (SELECT id, {_REG} AS norm FROM (SELECT id, CASE WHEN id % 2 = 0 THEN left(name, 6) ELSE name END AS name FROM names)) SELECT id, norm <> '' AND EXISTS (SELECT 1 FROM r WHERE r.norm <> '' AND (contains(r.norm, n.norm) OR contains(n.norm, r.norm) OR lower(r.ticker) = n.norm)) AS valid FROM n",
    "entity_list": "SELECT (199 + row_number() OVER (ORDER BY Entity_Name, Entity_Type))::INT AS Entity_Key, *, 'Healthcare' AS Entity_Domain FROM (SELECT DISTINCT c_name AS Entity_Name, 'Company' AS Entity_Type FROM customer UNION SELECT c_mktsegment, 'Segment' FROM customer)",
    "run_totals": "SELECT source, count(*) FILTER (length(coalesce(text, '')) >= 500)::BIGINT AS saved, count(*) FILTER (length(coalesce(text, '')) < 500)::BIGINT AS failed, count(*)::BIGINT AS total FROM documents GROUP BY source",
    "import_rows": "SELECT source AS Source, 'https://example.org/' || doc_id AS link, '' AS Headline, text AS body FROM documents WHERE doc_id % 7 <> 0 AND length(text) > 10",
    "title_texts": _title_sql(),
    "market_articles": _market_sql(),
    "csv_star_fact": "SELECT (999 + row_number() OVER (ORDER BY doc_id))::BIGINT AS Fact_ID, 20240203 AS Date_Key, [1, 3, -1, 2][(doc_id % 4 + 1)::INT]::INT AS Source_Key, ['BioSpace', 'STAT News', 'Unknown', 'Genome Post'][(doc_id % 4 + 1)::INT] AS Source_Name, 'https://example.org/' || doc_id AS News_Link, 0.5::DOUBLE AS Sentiment_Score, rtrim('body ' || coalesce(text, ''), ' ') AS Body_Text FROM documents",
    "csv_star_entities": f"""WITH facts AS (SELECT *, (999 + row_number() OVER (ORDER BY doc_id))::BIGINT AS Fact_ID FROM documents)
      SELECT Fact_ID, 200 AS Entity_Key, 'Attion' AS Entity_Name, 'Company' AS Entity_Type, count(*)::INT AS Mention_Count FROM (SELECT Fact_ID, unnest({c.sql_tokens("lower(coalesce(text, ''))")}) AS w FROM facts) WHERE w = 'attion' GROUP BY Fact_ID
      UNION ALL SELECT Fact_ID, 201, 'Gamma Corp', 'Company', 0 FROM facts WHERE doc_id % 2 = 0""",
}
