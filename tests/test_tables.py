"""Snapshot tables and the star that grows by loads."""

import pytest
from pyspark.sql import functions as F

from quillmesh.plans.increments import GrowingStar
from quillmesh.sources.snapshots import Conflict, Table
from quillmesh.streaming import ingest

ROWS = "k long, at int, v string"


def rows_of(table, version=None):
    return sorted(map(tuple, table.read(version).collect()))


def test_upserts_and_versions(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", ["k"], 4)
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()
    first = [(k, 1, f"a{k}") for k in range(40)]
    t.upsert(spark.createDataFrame([*first, (None, 1, "no key")], ROWS), ["at"])
    assert rows_of(t) == first
    before = {p["bucket"]: p["path"] for p in t.manifest()["parts"]}
    t.upsert(spark.createDataFrame([(3, 2, "b"), (3, 5, "d"), (3, 5, "c"), (4, 0, "late"), (99, None, "new")], ROWS), ["at"])
    want = sorted([r for r in first if r[0] != 3] + [(3, 5, "d"), (99, None, "new")], key=lambda r: r[0])
    assert rows_of(t) == want and rows_of(t, 1) == first
    after = {p["bucket"]: p["path"] for p in t.manifest()["parts"]}
    assert any(after[b] == before[b] for b in before)  # untouched buckets keep their files
    t.upsert(spark.createDataFrame([], ROWS), ["at"], ("feed", 7))
    assert rows_of(t) == want and t.manifest()["batches"] == {"feed": 7}
    assert t.vacuum(1) >= 1 and rows_of(t) == want and t.versions() == [3]
    with pytest.raises(ValueError, match="the table has"):
        t.upsert(spark.createDataFrame([(1, "x")], "k long, v string"), ["k"])


def test_nothing_is_seen_before_it_is_published(spark, tmp_path, monkeypatch):
    t = Table(spark, f"file://{tmp_path}/t", ["k"], 2)
    t.upsert(spark.createDataFrame([(1, 1, "old")], ROWS), ["at"])

    def fails(*_):
        raise OSError("lost between writing and publishing")

    for change in (lambda: t.upsert(spark.createDataFrame([(1, 2, "new")], ROWS), ["at"]), lambda: t.replace(spark.createDataFrame([(2, 2, "new")], ROWS))):
        with monkeypatch.context() as m, pytest.raises(OSError, match="lost"):
            m.setattr(t, "_publish", fails)
            change()
        assert rows_of(t) == [(1, 1, "old")] and t.versions() == [1]
    assert t.vacuum() == 2 and rows_of(t) == [(1, 1, "old")]


def test_second_writer_of_a_version_fails(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    t.replace(spark.createDataFrame([(1, 1, "a")], ROWS))
    write = t._write

    def overtaken(df, key=None):
        parts = write(df, key)
        if df.first().v == "slow":
            t.append(spark.createDataFrame([(2, 1, "quick")], ROWS))
        return parts

    t._write = overtaken
    with pytest.raises(Conflict):
        t.append(spark.createDataFrame([(3, 1, "slow")], ROWS))
    assert rows_of(t) == [(1, 1, "a"), (2, 1, "quick")]


def test_replace_from_itself_and_append(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    t.append(spark.createDataFrame([(1, 1, "a")], ROWS), ("load", 0))
    assert not t.append(spark.createDataFrame([(9, 9, "again")], ROWS), ("load", 0))
    t.append(spark.createDataFrame([(2, 1, "b")], ROWS), ("load", 1))
    t.replace(t.read().where("k = 2"))
    assert rows_of(t) == [(2, 1, "b")]


def test_replayed_stream(spark, tmp_path):
    source = f"{tmp_path}/in"
    for n in range(3):
        spark.createDataFrame([(k, n, f"{n}") for k in range(n, 6)], ROWS).coalesce(1).write.mode("append").parquet(source)
    t = Table(spark, f"file://{tmp_path}/t", ["k"], 2)
    for run in range(2):
        shown = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(source).withColumn("v", F.concat("v", F.lit("" if run == 0 else "!")))
        ingest.upsert_stream(shown, t, ["at"], "in", f"file://{tmp_path}/state{run}")
        assert rows_of(t) == [(0, 0, "0"), (1, 1, "1"), *[(k, 2, "2") for k in range(2, 6)]]
    assert t.manifest()["batches"] == {"in": 2}


ARTICLES = "date string, source string, headline string, body string, link string, sentiment string"


def test_load_that_failed_midway(spark, tmp_path, monkeypatch):
    one = spark.createDataFrame([("2024-01-15", "STAT News", "h", "b", "https://a.org/1", "0.5"), ("2024-01-16", "BioSpace", "h", "b", "https://a.org/2/", None), ("2024-01-16", "BioSpace", "h2", "b", "https://a.org/2", "1"), ("x", "12345", "h", "b", " ", "1")], ARTICLES)
    two = one.unionByName(spark.createDataFrame([("2024-02-01", "AAA Post", "h", "b", "https://a.org/3", "-0.5")], ARTICLES))
    star = GrowingStar(spark, f"file://{tmp_path}/s")
    star.load(one, 0)
    assert {(r.Source_Key, r.Source_Name) for r in star.sources.read().collect()} == {(1, "BioSpace"), (2, "STAT News")}
    assert {(r.Fact_ID, r.News_Link, r.Source_Key) for r in star.facts.read().collect()} == {(1000, "https://a.org/1", 2), (1001, "https://a.org/2", 1)}
    with monkeypatch.context() as m, pytest.raises(OSError, match="lost"):
        m.setattr(star.rollup, "replace", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        star.load(two, 1)
    for _ in range(2):
        star.load(two, 1)
        assert {(r.Source_Key, r.Source_Name) for r in star.sources.read().collect()} == {(1, "BioSpace"), (2, "STAT News"), (3, "AAA Post")}
        assert {(r.Fact_ID, r.News_Link, r.Load_Number) for r in star.facts.read().collect()} == {(1000, "https://a.org/1", 0), (1001, "https://a.org/2", 0), (1002, "https://a.org/3", 1)}
        assert {tuple(r) for r in star.totals(["Year"]).collect()} == {(2024, 3, 0.0, 20240115, 20240201)}
