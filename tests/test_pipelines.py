from pyspark.sql import functions as F

from quillmesh.operators import links, ner, tags
from quillmesh.plans import collectors, pipelines
from quillmesh.session import ship
from quillmesh.sources.snapshots import Table
from quillmesh.sources import market, readers, sinks

ARTICLES = "id long, date string, source string, headline string, body string, link string, sentiment string, matched_keywords string"


def test_whole_star(spark):
    rows = [
        (1, "2024-01-15", "BioSpace", "Pfizer acquisition of a small firm", "Eli Lilly and Pfizer said the acquisition is done. Eli Lilly paid.", "l1", "0.5", "acquisition; Eli Lilly; Oncology; Pfizer"),
        (2, "2024-02-20", "FierceBiotech", "Merger news", "A merger between two firms in cancer therapy with many more words here", "l2", None, "GSK"),
        (3, None, None, None, None, None, None, None),
    ]
    t = pipelines.build_star(spark.createDataFrame(rows, ARTICLES), [("acquisition", "Event", "Business", []), ("merger", "Event", "Business", ["merge"])], ["cancer"])
    facts = {r.Fact_ID: r for r in t["Fact_Document"].collect()}
    assert {k: r.Tag_Count for k, r in facts.items()} == {1000: 1, 1001: 1, 1002: 0}
    assert {(r.Fact_ID, r.Tag_Key) for r in t["Bridge_Fact_Tag"].collect()} == {(1000, 10), (1001, 11)}
    assert {r.Entity_Name: r.Entity_Key for r in t["Dim_Entity"].collect()} == {"Eli Lilly": 200, "GSK": 201}
    assert {tuple(r) for r in t["Bridge_Fact_Entity"].collect()} == {(1000, 200, 2), (1001, 201, 0)}
    assert {r.Rejected_Entity for r in t["rejected_entities"].collect()} == {"acquisition", "Oncology", "Pfizer"}
    assert t["Dim_Time"].count() == 3


def test_feeds(spark):
    items = spark.createDataFrame([("t1", "https://a.org/1", "d" * 60, None, None, "By A", ["x"]), ("t1", "https://a.org/1/", "d" * 60, None, "2024", None, []), ("short", "ftp", None, None, None, None, []), ("t3", "//a.org/3", "", "<p>" + "c " * 80 + "</p>", None, None, [])], "title string, link string, description string, content string, date string, author string, categories array<string>")
    got = {r.link: r for r in pipelines.collect(items, spark.createDataFrame([("https://a.org/9",)], "link string"), "S").collect()}
    assert set(got) >= {"https://a.org/3"} and len([k for k in got if "/1" in k]) == 1 and got["https://a.org/3"].extract.startswith("c c")
    scored = pipelines.scored_metadata(items, ["t1"], [], [], ["https://"], [], ["x"])
    best = {r.link: (r.score, r.priority) for r in scored.collect()}
    assert best["https://a.org/1"] == (0.4, "low")
    routed = pipelines.route(scored.withColumn("priority", F.lit("medium")), scored.where("link like '%1/'"))
    assert {r.link: r.status for r in routed.collect()}["https://a.org/1/"] == "scraped"


def test_payloads(spark):
    def frame(s):
        return spark.createDataFrame([(s,)], "j string")

    work = market.literature(frame('{"message": {"items": [{"title": ["T"], "author": [{"given": "A", "family": "B"}, {"family": "C"}], "published": {"date-parts": [[2024, 3]]}, "abstract": "<p>x</p>", "DOI": "10.1/2"}]}}'), "j").first()
    assert (work.title, work.author, str(work.date), work.extract, work.link) == ("T", "A B, C", "2024-03-01", "x", "https://doi.org/10.1/2")
    bar = market.bars(frame('{"results": [{"t": 1704153600000, "o": 10, "h": 12, "l": 9, "c": 11, "v": 100}]}'), "j")
    assert bar.select(market.bar_text(F.lit("X"))).first()[0] == "X closed at 11.00 on 2024-01-02, change 10.00%, volume 100"
    items = frame("<item><title><![CDATA[A & B]]></title><link>l</link></item>").select(market.headline_items(F.col("j")).alias("i")).first().i
    assert (items[0].title, items[0].link) == ("A & B", "l")
    one = market.registry(frame('{"0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple Inc."}}'), "j", "SEC").first()
    two = market.registry(frame('{"data": {"table": {"rows": [{"symbol": "X", "name": "X Co"}]}}}'), "j", "NYSE").first()
    assert (one.ticker, one.cik, two.name, two.cik) == ("AAPL", "0000320193", "X Co", None)
    rows = spark.createDataFrame([("8-K", "Apple", "2024-01-02", "1"), ("8-K", "Apple", "2024-01-03", "2"), ("10-Q", "Apple", "2024-01-03", "3")], "kind string, company string, filed string, accession string")
    assert [r.accession for r in market.filings(rows, ["8-K"], ["apple"], "2024-01-01", "2024-02-01").collect()] == ["2", "1"]
    page = frame('<script id="__NEXT_DATA__">{"posts": [{"url": "/a"}, {"link": "/b"}]}</script>')
    assert page.select(market.embedded_posts(F.col("j"))).first()[0] == ["/a", "/b"]


def test_ner(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "Eli Lilly met Pfizer and eli lilly."), (2, None)], "id long, text string")
    spans = docs.select("id", ner.extractor()("text").alias("s"))
    assert {(r.id, r.name) for r in ner.best_spans(spans, "id", "s").collect()} == {(1, "eli lilly"), (1, "pfizer")}
    kept = spans.select("id", ner.ordered_names(ner.sure(F.col("s")), F.col("s")).alias("n"))
    assert {r.id: r.n for r in kept.collect()} == {1: ["Eli Lilly", "Pfizer"], 2: []}
    assert tuple(ner.coverage(kept, "n", "n").first()) == (2, 1, 1, 50.0, 50.0)
    assert docs.select(ner.title_case()(F.lit("beam-on o'neil"))).first()[0] == "Beam-On O'Neil"


RSS = """<?xml version="1.0"?><rss><channel><title>c</title>
<item><title>One</title><link>https://a.org/1</link><description>%s</description><pubDate>Tue, 05 Mar 2024 08:00:00 +0000</pubDate><category>x</category></item>
<item><title>No link</title></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Two</title><link href="https://a.org/2"/><summary>s</summary><updated>2024-03-06T08:00:00Z</updated></entry></feed>"""


def test_feed_files_to_articles(spark, tmp_path):
    """Files of both formats, and one that is no feed, through the whole chain."""
    for name, content in (("a.xml", RSS % ("long words " * 12)), ("b.xml", ATOM), ("c.xml", '{"error": 404}')):
        (tmp_path / name).write_text(content)
    items = readers.feed_items(spark, [str(tmp_path / n) for n in ("a.xml", "b.xml", "c.xml")])
    assert {(r.title, r.link, str(r.published)) for r in items.collect()} == {("One", "https://a.org/1", "2024-03-05 08:00:00"), ("Two", "https://a.org/2", "2024-03-06 08:00:00")}
    stored = spark.createDataFrame([("https://a.org/2/",)], "link string")
    (got,) = pipelines.collect(items, stored, "S").collect()
    assert got.link == "https://a.org/1" and got.extract.startswith("long words") and got.extract.endswith("Categories: x")
    page = "<html><h1>Page one</h1><article>" + "words of the page " * 20 + "</article></html>"
    pages = spark.createDataFrame([("https://a.org/1", page)], "link string, html string")
    (got,) = collectors.hybrid_feed(items, pages, stored, "S").collect()
    assert got.extract.startswith("long words") and "words of the page" in got.extract and got.title == "One"
    sites = spark.createDataFrame([("https://a.org/1", "2024-01-01"), ("https://a.org/new-thing", "2024-02-01")], "url string, lastmod string")
    assert {r.title for r in collectors.collect_hybrid(items, sites, stored, "S").collect()} == {"One", "New Thing"}


def test_queue_and_totals(spark):
    text = "<article>" + "words of the page " * 20 + "</article>"
    scored = spark.createDataFrame([("https://a.org/1", 0.7, "queued"), ("https://a.org/2", 0.9, "queued"), ("https://a.org/3", 0.2, "ignored")], "link string, score double, status string")
    pages = spark.createDataFrame([("https://a.org/2/", text), ("https://a.org/1", "short")], "link string, html string")
    done, after = collectors.drain_queue(scored, pages)
    assert [r.link for r in done.collect()] == ["https://a.org/2"]
    assert {r.link: r.status for r in after.collect()} == {"https://a.org/1": "queued", "https://a.org/2": "scraped", "https://a.org/3": "ignored"}
    left = collectors.without_output(spark.createDataFrame([("A",), ("B",)], "source string"), spark.createDataFrame([("B",)], "source string"))
    assert [r.source for r in left.collect()] == ["A"]


def test_layouts_and_tag_files(spark, tmp_path):
    assert readers.layout_of(["_id", "author", "source"]) == "mongo" and readers.layout_of(["NewsSite", "Name"]) == "source"
    assert readers.layout_of(["Amethos Id", "Date"]) == "merged" and readers.layout_of(["Source", "Title"]) == "stock"
    stock = tmp_path / "stock.csv"
    stock.write_text('Source,Title,Date,Author,Link,Extract\nS,T,2024-01-01,A,https://a.org/1,"two\nlines"\nSource,Title,Date,Author,Link,Extract\n')
    (row,) = readers.detected_articles(spark, str(stock)).collect()
    assert (row.source, row.link, row.extract) == ("S", "https://a.org/1", "two\nlines")
    index = tmp_path / "index.csv"
    index.write_text("\ufeffIndex,,Keyword, cancer , tumor,,,,\nD_01,,merger ,,,,,,\nD_02,individually,Gene therapy,vector,,,,,\n")
    got = {r.tag: r for r in tags.define_tags(tags.read_tag_rows(spark, str(index))).collect()}
    assert set(got) == {"merger", "Gene therapy"} and set(got["Gene therapy"].keywords) >= {"cancer", "tumor", "vector", "gene therapy"} and got["Gene therapy"].individual
    assert "cancer" not in got["merger"].keywords
    urls = spark.createDataFrame([("https://www.biospace.com/news/a",), ("https://x.org/",)], "link string")
    assert [(r.source, r.least) for r in links.article_links(urls).collect()] == [("BioSpace", 50)]


def test_tag_keywords_keep_their_digits(spark):
    rows = spark.createDataFrame([("1", "", "merger", "168", "2031", "", "", "", ""), ("2", "", "7 up ", " 0 ", "", "", "", "", "")], tags.LAYOUT)
    got = {r.tag: r.keywords for r in tags.define_tags(tags.tag_rows(rows)).collect()}
    assert {"168", "2031"} <= set(got["merger"]) and got["7 up"] == ["0", "7 up"]


def test_star_finds_known_companies_in_text(spark):
    rows = [(1, "2024-01-15", "BioSpace", "news", "a deal of orionex and others", "l1", None, ""), (1, "2024-01-16", "BioSpace", "news", "nothing", "l2", None, "Orionex Inc")]
    known = spark.createDataFrame([("Orionex",)], "name string")
    t = pipelines.build_star(spark.createDataFrame(rows, ARTICLES), [("merger", "Event", "Business", [])], [], companies=known)
    assert [r.Entity_Name for r in t["Dim_Entity"].collect()] == ["Orionex Inc"]
    assert {(r.Fact_ID, r.Mention_Count) for r in t["Bridge_Fact_Entity"].collect()} == {(1000, 1), (1001, 0)}
    assert {r.Fact_ID: r.News_Link for r in t["Fact_Document"].collect()} in ({1000: "l1", 1001: "l2"},)


def test_replaced_and_upserted_tables(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = spark.createDataFrame([("https://a.org/1/", "long enough text", "A", 1), (" ", "long enough text", "A", 1), ("https://a.org/2", "short", "B", 1)], "link string, extract string, source string, at int")
    assert {tuple(r) for r in sinks.migrate(rows, path, ["at"]).collect()} == {("A", 1, 1), ("B", 0, 1)}
    later = rows.limit(1).withColumn("extract", F.lit("another long text")).union(rows.where("source = 'B'").withColumn("extract", F.lit("now long enough"))).withColumn("at", F.lit(2))
    sinks.migrate(later.unionByName(rows.limit(1).withColumn("at", F.lit(0)).withColumn("extract", F.lit("an older long text"))), path, ["at"])
    assert {(r.link, r.extract) for r in Table(spark, path).read().collect()} == {("https://a.org/1", "another long text"), ("https://a.org/2", "now long enough")}
    ids = sinks.with_ids(spark.createDataFrame([(1, ""), (2, "old")], "k int, id string"), spark.createDataFrame([(1, "N1")], "k int, id string"), "k", "id")
    assert {tuple(r) for r in ids.collect()} == {(1, "N1"), (2, "old")}
    sinks.write_csv(spark.createDataFrame([("S", "T", "d", "a", "l", 'two\nlines, "quoted"')], readers.STOCK), f"{path}.csv")
    assert readers.read_csv(spark, f"{path}.csv", readers.STOCK).first().Extract == 'two\nlines, "quoted"'


def test_registry_cache(spark, tmp_path):
    path = f"file://{tmp_path}/registry"
    rows = spark.createDataFrame([("x co", "X Co", "X", "1", "SEC")], "key string, name string, ticker string, cik string, source string")
    market.save_registry(rows, path, "2024-01-01")
    again, stale = market.load_registry(spark, path, "2024-01-05")
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in rows.collect()] and not stale
    assert market.load_registry(spark, path, "2024-01-09")[1]
    both = market.with_custom(again, spark.createDataFrame([("X Co", None), ("Mine", "M")], "name string, ticker string"))
    assert {(r.name, r.source) for r in both.collect()} == {("X Co", "SEC"), ("Mine", "custom")}
    filed = spark.createDataFrame([("8-K", "X Co", "X", "2024-01-02", "1"), ("8-K", "Y", "YY", "2024-01-03", "2")], "kind string, company string, ticker string, filed string, accession string")
    assert [r.accession for r in market.company_filings(filed, "yy", "2024-01-01", "2024-02-01").collect()] == ["2"]
