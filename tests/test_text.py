from pyspark.sql import functions as F

from quillmesh.functions import dates, entities, fixed, html, text
from quillmesh.operators import rewrite
from quillmesh.sources import readers


def one(spark, fn, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first()["r"]


def rules():
    return [
        ("Northwind & Sons", ["N&S", "Northwind", "Northwind Labs"]),
        ("Harbor", ["Harbor & Co", "Harbor Quay & Dock", "HQD"]),
        ("TWS", ["TallWoodSmith", "Tallwood", "Vetch Care"]),
        ("Lake Nordin", ["Lake", "LND"]),
        ("Brightol", ["luminamab"]),
        ("Calmex", ["serenatide", "Quietal"]),
    ]


def test_normalised_texts(spark):
    assert one(spark, text.normalize_text, "Harbor Buys Rival for $9M Cash") == "harbor buys rival for 9m cash"
    body = "Harbor said on Monday that it bought a rival. The $7 million price covers two B-12 plants."
    assert one(spark, text.normalize_text, body) == "harbor said on monday that it bought  rival the  million price covers two -12 plants"
    assert one(spark, text.normalize_text, None) is None


def test_boilerplate(spark):
    assert one(spark, text.remove_boilerplate, "News here. Subscribe to our newsletter today.") == "News here."
    assert one(spark, text.remove_boilerplate, "Good text. To submit a correction write us") == "Good text."
    assert one(spark, text.late_clean, "a text click here to go on") == "a text"


def test_rules(spark):
    cases = [
        ("Harbor Quay & Dock found that luminamab helps.", "[Harbor] found that [Brightol] helps.", "Harbor; Brightol"),
        ("Lake Nordin says serenatide and Quietal do well.", None, "Lake Nordin; Calmex"),
        ("They compare Tallwood with Northwind Labs.", "They compare [TWS] with [Northwind & Sons].", "Northwind & Sons; TWS"),
        ("The new Harborside is open.", "The new Harborside is open.", ""),
        ("TWS and Lakes work together.", "TWS and Lakes work together.", "TWS"),
    ]
    change = rewrite.rewriter(rewrite.rule_rows(spark, rules()))
    for body, consolidated, keys in cases:
        got = one(spark, change, body)
        assert got["keys"] == keys
        if consolidated:
            assert got["out"] == consolidated
    assert one(spark, change, None)["out"] is None


def test_small_parts(spark):
    assert one(spark, text.split_multi, " a ;b, ,c|") == ["a", "b", "c"]
    assert one(spark, text.strip_author_prefix, "By Jane Roe") == "Jane Roe"
    assert one(spark, text.slug, "Business Wire!") == "business_wire_"
    assert one(spark, text.clean_value, " NaN ") == ""
    assert one(spark, text.title_from_slug, "https://x.org/a/new-drug-works/?q=1") == "New Drug Works"
    assert one(spark, text.drop_single_chars, "a b cd e") == "  cd "
    assert one(spark, text.clean_text, "Abstract: See https://x.org now! I don't") == "see now don'"


def test_dates(spark):
    for raw, want in [("2024-01-15", "150124"), ("2024/01/15", "150124"), ("2024-01-15T10:00:00Z", "150124"), ("date", "000000"), ("", "000000"), (None, "000000")]:
        assert one(spark, dates.ddmmyy, raw) == want, raw
    row = spark.createDataFrame([("2021-01-03",)], "d string").select(F.to_date("d").alias("d")).select(*dates.calendar(F.col("d"))).first()
    assert (row.Date_Key, row.Quarter, row.Day_of_Week, row.Week_of_Year) == (20210103, "Q1", "Sunday", 53)


def test_entity_names(spark):
    for raw, want in [("AstraZeneca", "astrazeneca"), ("Astra Zeneca", "astrazeneca"), ("Johnson & Johnson", "johnsonandjohnson"), ("Johnson and Johnson", "johnsonandjohnson"), ("Pfizer Inc.", "pfizer"), ("Xenon Pharmaceuticals", "xenon"), ("Beam-101", "beam101"), (None, "")]:
        assert one(spark, entities.normalize_entity, raw) == want
    for raw, want in [("Pfizer", False), ("Eli Lilly", True), ("Oncology", False), ("COVID-19", False), ("GSK", True), ("Merck", True), ("Beam Therapeutics", False), ("", False), (None, False)]:
        assert one(spark, entities.likely_company, raw) is want, raw
    for raw, want in [("Microsoft Corporation", "microsoft"), ("Johnson & Johnson", "johnson johnson"), ("Reata Pharmaceuticals, Inc.", "reata pharmaceuticals")]:
        assert one(spark, entities.registry_name, raw) == want
    assert one(spark, entities.display_name, "Acme Holdings Inc.") == "Acme"
    assert one(spark, entities.bridge_name, "Foo Pharma'. ") == "foo"
    row = spark.createDataFrame([("pfizer inc said pfizer and c.o (x)", "Pfizer", "c.o (x")], "t string, a string, b string").select(entities.mention_count(F.col("t"), F.col("a")).alias("a"), entities.mention_count(F.col("t"), F.col("b")).alias("b")).first()
    assert (row.a, row.b) == (2, 1)


def test_source_types(spark):
    for raw, want in [("STAT News", "News"), ("FDA", "Government"), ("State University", "Academic"), ("FierceBiotech", "Industry"), ("BioSpace", "Other")]:
        assert one(spark, entities.source_type, raw) == want


def test_tag_categories(spark):
    for raw, want in [("capital raise", ("Other", "General")), ("clinical-stage", ("Entity", "Healthcare")), ("therapeutic", ("Entity", "Healthcare")), ("merger", ("Event", "Business"))]:
        assert tuple(one(spark, entities.tag_category, raw)) == want


def test_html(spark):
    page = '<html lang="en"><head><title>T</title><meta name="author" content="A B"></head><body><script>var t="</p>";</script><nav><p>navigation navigation navigation navigation nav</p></nav><h1> Big  <b>news</b></h1><time datetime="2024-01-02">x</time><p>short</p><p>' + "word " * 30 + '</p><a href="/x">x</a><a href="https://o.org/y">y</a></body></html>'
    assert one(spark, html.title, page) == "Big news"
    assert one(spark, html.author, page) == "A B"
    assert one(spark, html.published, page) == "2024-01-02"
    assert one(spark, html.paragraphs, page) == [("word " * 30).strip()]
    assert one(spark, html.body, page) == ("word " * 30).strip()
    assert one(spark, lambda c: html.links(c, F.lit("https://h.org")), page) == ["https://h.org/x", "https://o.org/y"]
    assert one(spark, html.clean_url, "//a.org/b") == "https://a.org/b"
    assert one(spark, html.robots_delay, "User-agent: *\nCrawl-delay: 2.5\nSitemap: https://a/s.xml") == 2.5
    assert one(spark, html.robots_sitemaps, "Sitemap: https://a/s.xml\nsitemap: https://a/t.xml") == ["https://a/s.xml", "https://a/t.xml"]


def test_readers(spark, tmp_path):
    csv = tmp_path / "m.csv"
    csv.write_text('﻿Amethos Id,Date,Source,News link,Headline,Body/abstract/extract\n,2024-01-15,BioSpace,https://a/1,,"two\nlines, ""quoted"""\nx,y\n,,,,,\nAmethos Id,Date,Source,News link,Headline,Body/abstract/extract\n,2024/01/16,nan,https://a/2,h,b\n')
    got = {r.link: r for r in readers.articles(spark, str(csv), "merged").collect()}
    assert set(got) == {"https://a/1", "https://a/2"}
    assert got["https://a/1"].extract == 'two\nlines, "quoted"' and got["https://a/2"].source == ""
    path = tmp_path / "rules.csv"
    path.write_text("# comment\n\nPfizer: Pfizer Inc, , Pfizer Limited\nno colon\nA: b: c\n")
    assert {r.key: r.synonyms for r in readers.rules(spark, str(path)).collect()} == {"Pfizer": ["Pfizer Inc", "Pfizer Limited"], "A": ["b: c"]}
    path = tmp_path / "feed.xml"
    path.write_text("<rss><channel><item><title>t</title><link> https://a/1 </link><category>x</category><category>y</category></item><item><title>no link</title></item></channel></rss>")
    (item,) = readers.feed_items(spark, str(path)).collect()
    assert (item.link, item.categories) == ("https://a/1", ["x", "y"])
    path = tmp_path / "map.xml"
    path.write_text("<urlset><url><loc>https://a/1</loc><priority>0.5</priority></url><url><loc>https://a/2</loc></url></urlset>")
    assert readers.sitemap_urls(spark, str(path)).count() == 2
    series = spark.createDataFrame([('{"2024-01-02": {"1. open": "1.5", "4. close": "2", "5. volume": "10"}}',)], "j string")
    assert tuple(readers.daily_series(series, "j").select("open", "close", "volume").first()) == (1.5, 2.0, 10.0)
    path = tmp_path / "index.csv"
    path.write_text("DrugIndex,,DrugKeyword\nD1,,Keytruda\nD1,, pembrolizumab \nnan,,x\n")
    assert {r.id: r.keywords for r in readers.index_file(spark, str(path)).collect()} == {"D1": ["keytruda", "pembrolizumab"]}
