from pyspark.sql import functions as F

from quillmesh.operators import entity, incremental, match, star
from quillmesh.sources import sinks


def articles(spark, rows):
    return spark.createDataFrame(rows, "id long, date string, source string, headline string, body string, link string, sentiment string")


def test_star_schema(spark, tmp_path):
    a = articles(spark, [(1, "2024-01-15", "BioSpace", "h", "b", "l1", "0.5"), (2, "2024-02-20", "FierceBiotech", "nan", "b", "l2", "x"), (3, "bad", "12345", None, None, None, None)])
    sources = star.dim_source(a, "source")
    assert [tuple(r) for r in sources.orderBy("Source_Key").collect()] == [(1, "BioSpace", "Other"), (2, "FierceBiotech", "Industry")]
    fact = star.fact_rows(a, sources, ["id"]).orderBy("Fact_ID").collect()
    assert [(r.Fact_ID, r.Date_Key, r.Source_Key, r.Sentiment_Score) for r in fact] == [(1000, 20240115, 1, 0.5), (1001, 20240220, 2, None), (1002, 19000101, -1, None)]
    assert fact[1].Headline == "" and fact[2].Source_Name == "Unknown"
    strict = star.fact_rows(a, sources, ["id"], strict_compat=True).where("Fact_ID = 1002").first()
    assert (strict.Source_Key, strict.Source_Name) == (1, "BioSpace")
    dim = star.dim_tag([("acquisition", "Event", "Business"), ("merger", "Event", "Business"), ("merger", "Event", "Business")], spark)
    tags = spark.createDataFrame([(1000, "acquisition", 0.9), (1001, "merger", 0.8)], "Fact_ID long, tag string, confidence double")
    bridge = star.bridge_tag(tags, dim)
    assert {tuple(r) for r in bridge.collect()} == {(1000, 10, 0.9), (1001, 12, 0.8)}
    counts = {r.Fact_ID: (r.Tag_Count, r.Has_Key_Event) for r in star.with_tag_counts(star.fact_rows(a, sources, ["id"]), bridge).collect()}
    assert counts == {1000: (1, "Yes"), 1001: (1, "Yes"), 1002: (0, "No")}
    sinks.write_star({"Fact_Document": star.fact_rows(a, sources, ["id"]), "Dim_Source": sources}, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/Fact_Document").count() == 3


def test_time_and_numbers(spark):
    days = spark.createDataFrame([("2024-01-15",), ("2024-02-20",), (None,)], "d string").select(F.to_date("d").alias("d"))
    got = {r.Date_Key: (r.Quarter, r.Day_of_Week, r.Week_of_Year) for r in star.dim_time(days, "d").collect()}
    assert got[20240115] == ("Q1", "Monday", 3) and got[20240220] == ("Q1", "Tuesday", 8) and 19000101 in got
    keyed = star.numbered(spark.range(1000).select((999 - F.col("id")).alias("v")), "k", ["v"], 5).collect()
    assert sorted((r.k, r.v) for r in keyed) == [(v + 5, v) for v in range(1000)]
    assert star.numbered(spark.range(0), "k", ["id"], 1).count() == 0


def test_document_ids(spark):
    rows = [(i, "2024-01-15", "BioSpace", "", "", "", "") for i in range(1001)] + [(5000, "x", "GEN", "", "", "", ""), (5001, "2024-01-15", "99", "", "", "", ""), (5002, "2024-01-15", None, "", "", "", "")]
    got = {r.id: r.Document_ID for r in star.document_ids(articles(spark, rows), "source", "date", ["id"]).collect()}
    assert got[0] == "N02150124001" and got[1000] == "N021501241001" and got[5000] == "N01000000001" and got[5001] == "" and got[5002] == ""


def test_matching(spark):
    docs = spark.createDataFrame([(1, "FDA approval of a phase 3 trial, approval!"), (2, "nothing"), (3, None)], "doc_id long, text string")
    vocab = [("fda approval", "fda approval"), ("phase", "phase 3"), ("approval", "approval")]
    assert {tuple(r) for r in match.keyword_hits(docs, vocab).collect()} == {(1, "fda approval", "fda approval"), (1, "phase", "phase 3"), (1, "approval", "approval")}
    literal = spark.createDataFrame([("m&a", "m&a"), ("phase", "Phase 3"), ("mark", "trial, approval"), ("part", "rial")], "tag string, keyword string")
    assert {tuple(r) for r in match.literal_hits(docs, literal).collect()} == {(1, "phase", "phase 3"), (1, "mark", "trial, approval")}
    assert {r.doc_id: r.ids for r in match.matched_ids(docs, vocab).collect()} == {1: "approval; fda approval; phase", 2: "", 3: ""}
    columns = spark.createDataFrame([(1, "acquisition; Cancer"), (2, " "), (3, None)], "doc_id long, matched_keywords string")
    by_column = match.column_tags(columns, [("acquisition", "acquire"), ("cancer", "tumor")])
    assert {tuple(r) for r in by_column.collect()} == {(1, "acquisition"), (1, "cancer")}
    body = "acquisition news about cancer therapy for many more people in the world today ok"
    one = spark.createDataFrame([(1, body)], "doc_id long, text string")
    hits = match.keyword_hits(one, [("acquisition", "acquisition"), ("cancer", "cancer")])
    conf = match.tag_confidence(hits, one, {"acquisition": "Event", "cancer": "Therapy"}, ["cancer", "therapy"])
    assert {r.tag: r.confidence for r in conf.collect()} == {"acquisition": 0.7, "cancer": 0.8}
    assert {r.tag: r.confidence for r in match.merge_tags(by_column, conf).collect()} == {"acquisition": 0.9, "cancer": 0.9}


def test_entities(spark):
    dim = spark.createDataFrame([(200, "Merck"), (201, "Reata Pharmaceuticals"), (202, "Beam Bio"), (203, "Beam Therapeutics Long")], "Entity_Key int, Entity_Name string")
    names = spark.createDataFrame([("Merck",), ("merck inc.",), ("Reata",), ("Beam",), ("Beam other words",), ("Nobody",)], "name string")
    assert {r.name: r.Entity_Key for r in entity.resolve(names, dim).collect()} == {"Merck": 200, "merck inc.": 200, "Reata": 201, "Beam": 202, "Beam other words": 202, "Nobody": None}
    registry = spark.createDataFrame([("Apple Inc.", "AAPL", "SEC")], "name string, ticker string, source string")
    got = {r.input: r.validated for r in entity.enrich(spark.createDataFrame([("apple",), ("aapl",), ("zzz",)], "name string"), registry).collect()}
    assert got == {"apple": True, "aapl": True, "zzz": False}
    found = spark.createDataFrame([(1, "Pfizer", 0.8, 3), (1, "Pfizer Inc", 0.8, 1), (1, "Merck", 0.9, 0)], "doc long, name string, confidence double, mentions long")
    assert {(r.name, r.mentions) for r in entity.best_entities(found, "doc").collect()} == {("Pfizer Inc", 3), ("Merck", 0)}
    assert entity.canonical_names(spark.createDataFrame([("AstraZeneca",), ("Astra Zeneca",)], "n string"), "n").first().canonical == "Astra Zeneca"


def test_increments(spark):
    rows = spark.createDataFrame([(1, "a/", 0), (2, "a", 1), (3, "b", 0), (4, "c", 0)], "id long, link string, at int")
    stored = spark.createDataFrame([("b/",)], "link string")
    assert {r.id for r in incremental.new_rows(rows, stored, "link", ["at", "id"]).collect()} == {1, 4}
    target = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    assert {tuple(r) for r in incremental.upsert(target, spark.createDataFrame([(2, "z"), (3, "w")], "k long, v string"), "k").collect()} == {(1, "x"), (2, "z"), (3, "w")}
    queue = spark.createDataFrame([(f"l{i}", float(i % 3), "queued") for i in range(100)], "link string, score double, status string")
    assert incremental.top_queue(queue, 5).count() == 5
