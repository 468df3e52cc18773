"""Sitemap trees, rejects of files, landed pages, status transitions, links of sources, long names."""

import gzip
import json
import random

import pytest
from link_cases import LINK_CASES
from pyspark.sql import Observation
from pyspark.sql import functions as F

from quillmesh.operators import known, links, star
from quillmesh.sources import paged, rejects, sitemaps
from quillmesh.streaming import ingest, status

BASE = "https://m.org/"


def test_sitemap_tree(spark, tmp_path):
    def index(*names):
        return "<sitemapindex>" + "".join(f"<sitemap><loc>\n{BASE}{n}\n</loc></sitemap>" for n in names) + "</sitemapindex>"

    files = {"root.xml": index("a.xml", "b.xml.gz", "gone.xml"), "a.xml": index("root.xml", "c.xml"), "c.xml": index("d.xml"), "alone.xml": "<urlset><url><loc>https://x/alone</loc></url></urlset>"}
    files["d.xml"] = "<urlset><url><loc>https://x/1?a=1&amp;b=2</loc><lastmod>2024-01-01</lastmod></url><url><loc> </loc></url></urlset>"
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "b.xml.gz").write_bytes(gzip.compress(b"<urlset><url><loc><![CDATA[https://x/2]]></loc></url></urlset>"))
    landed = sitemaps.landed_files(spark, str(tmp_path), BASE)
    assert {tuple(r) for r in sitemaps.walk(landed, BASE + "root.xml").collect()} == {(BASE + "d.xml", 3, "https://x/1?a=1&b=2", "2024-01-01"), (BASE + "b.xml.gz", 1, "https://x/2", None)}
    assert sitemaps.walk(landed, BASE + "nowhere.xml").count() == 0


def test_rejects_and_counts(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('a,b,c\n1,"two\nlines",3\n1,2\n1,2,3,4\n,,\na,b,c\n4,"x ""y""",6\n')
    seen = Observation()
    rows = rejects.read_checked(spark, str(path), "a string, b string, c string", observed=seen)
    good, bad = rejects.split_rows(rows.cache())
    assert {tuple(r) for r in good.collect()} == {("1", "two\nlines", "3"), ("4", 'x "y"', "6")}
    assert sorted(tuple(r) for r in bad.collect()) == [(",,", "blank"), ("1,2", "width"), ("1,2,3,4", "width"), ("a,b,c", "header")]
    assert seen.get == {"good": 2, "rejected": 4, "width": 2, "blank": 1, "header": 1}


def test_landed_pages(spark, tmp_path):
    paged.register(spark)

    def land(n, items):
        (tmp_path / f"page-{n:06d}.json").write_text(items if isinstance(items, str) else json.dumps(items))

    def ids(**options):
        return sorted(int(r.id) for r in spark.read.format("landed_pages").schema("id string, more string").options(**options).load(str(tmp_path)).collect())

    assert ids() == []
    for n in range(1, 8):
        land(n, [{"id": str(10 * n + k), "more": {"k": k}} for k in range(2)])
    assert ids(range=3) == sorted(10 * n + k for n in range(1, 8) for k in range(2))
    land(5, [])
    assert ids(range=10) == sorted(10 * n + k for n in range(1, 5) for k in range(2))  # nothing behind an empty page
    assert ids(range=10, stop="false") == sorted(10 * n + k for n in (1, 2, 3, 4, 6, 7) for k in range(2))
    land(5, "not json")
    assert ids(range=10, errors=1) == sorted(10 * n + k for n in (1, 2, 3, 4, 6, 7) for k in range(2))
    with pytest.raises(Exception, match="cannot be read"):
        ids(range=10)
    assert spark.read.format("landed_pages").load(str(tmp_path)).schema.fieldNames() == ["id", "payload"]


def test_landed_pages_as_a_stream(spark, tmp_path):
    paged.register(spark)
    folder, out, state = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/state"
    folder.mkdir()
    for first in (1, 3):
        for n in (first, first + 1):
            (folder / f"page-{n:06d}.json").write_text(json.dumps([{"id": str(n)}]))
        ingest.run_available(spark.readStream.format("landed_pages").schema("id string").load(str(folder)), out, state)
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == [str(n) for n in range(1, first + 2)]


def test_status_machine():
    """Whatever the batches, transitions follow from the order of events."""
    def run(events, patience=100):
        now, since, out = None, 0, []
        for at, kind, detail in events:
            made = status.advance(now, since, at, kind, detail, patience)
            out += made
            if made:
                since, _, now = made[-1]
        return out

    assert run([(1, "read", "enough"), (5, "found", "high"), (9, "read", "short"), (50, "read", "enough"), (60, "found", "low")]) == [(5, None, "pending"), (50, "pending", "scraped")]
    assert run([(5, "found", "high"), (106, "read", "enough"), (107, "found", "high")]) == [(5, None, "pending"), (105, "pending", "expired")]
    assert run([(5, "found", "high"), (105, "read", "enough")]) == [(5, None, "pending"), (105, "pending", "scraped")]
    assert run([(5, "found", "medium"), (500, "read", "enough")]) == [(5, None, "queued"), (500, "queued", "scraped")]
    assert run([(5, "found", "low"), (6, "read", "enough")]) == [(5, None, "ignored")] and run([(1, "found", "odd")]) == []


def test_links_of_sources(spark):
    df = spark.createDataFrame([(u,) for u, _ in LINK_CASES], "link string")
    assert {r.link: r.source for r in df.select("link", links.source_of(F.col("link"))["source"].alias("source")).collect()} == dict(LINK_CASES)


def test_names_of_many_words(spark):
    name = "the old house by the quiet river bend company"
    docs = spark.createDataFrame([(1, f"about {name.upper()}, and more"), (2, "the old house by the quiet river"), (3, None)], "doc_id long, text string")
    low = docs.withColumn("text", F.lower("text"))
    found = known.known_companies(low, spark.createDataFrame([(name,), (" ",), (None,)], "name string"))
    assert [(r.doc_id, r.name) for r in found.collect()] == [(1, name.title())]


def test_document_ids_of_one_busy_day(spark):
    rng = random.Random(3)
    rows = [(i, "2024-01-15" if i % 7 else "2024-01-16", rng.choice(["BioSpace", "biospace ", "GEN", "x"])) for i in range(3000)]
    got = {r.id: r.Document_ID for r in star.document_ids(spark.createDataFrame(rows, "id long, date string, source string"), "source", "date", ["id"]).collect()}
    assert len(got) == len(rows)
    seen = {}
    for i, day, source in rows:
        code = {"biospace": "N02", "gen": "N01"}.get(source.strip().lower())
        if code is None:
            assert got[i] == ""
        else:
            seen[code, day] = seen.get((code, day), 0) + 1
            assert got[i].startswith(code[0]) and got[i].endswith(f"{seen[code, day]:03d}")
