"""What queries do per row, so that they stay in proportion to large tables."""

import pandas as pd
from helpers import SF
from pyspark.sql import functions as F

from quillmesh.functions import fixed, sentiment, text
from quillmesh.operators import known, match, rewrite, star, tags
from quillmesh.plans import entity_queries, pipelines, source_queries


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_names_of_one_small_file_are_spread(spark):
    assert entity_queries.entity_normalize(spark, SF).rdd.getNumPartitions() > 1


def test_boilerplate_is_searched_by_few_strings(spark):
    assert text.covering(("subscribe to", "subscribe now", "jats")) == ["subscribe ", "jats"]
    marks = {text.needed(p).lower() for p in [*fixed.LONG_BOILERPLATE, *fixed.LONG_MARKERS]}
    few = text.covering(tuple(sorted(marks)))
    assert len(few) < 30 and all(any(f in m for f in few) for m in marks)


def test_mails_are_searched_where_a_text_has_their_mark(spark):
    df = spark.createDataFrame([("write to a@b.c now",), ("see www.x.y or https://z",), ("none here",)], "v string")
    cleaned = df.select(text.normalize_core(F.col("v")).alias("r"))
    assert "contains" in plan(cleaned).lower()
    assert [r.r for r in cleaned.collect()] == ["write to now", "see or", "none here"]


def test_only_runs_that_can_be_keywords_are_exploded(spark):
    df = spark.createDataFrame([(1, "one of the other of words")], "doc_id int, text string")
    runs = df.select(match.candidates(text.tokens(F.col("text")), ["of the", "words"], 2).alias("r")).first()["r"]
    assert sorted(runs) == ["of the", "of words", "words"]
    assert [tuple(r) for r in match.keyword_hits(df, [("t", "Of the"), ("t", "absent")]).collect()] == [(1, "t", "of the")]


def test_rewritten_texts_come_in_slices(spark):
    change = rewrite.rewriter(rewrite.rule_rows(spark, [("K", ["word"])]))
    batches = list(change.func(iter([pd.Series(["a word", None] * 400)])))
    assert len(batches) > 1 and max(map(len, batches)) <= rewrite.SLICE and sum(map(len, batches)) == 800
    df = spark.range(2000, numPartitions=2).select("id", change(F.concat(F.lit("word "), "id")).alias("c"))
    assert {r.id: r.c.out for r in df.collect()} == {i: f"[K] {i}" for i in range(2000)}


def test_sentiment_makes_its_text_once(spark):
    """A text that is itself an expression stands once in the score, however many rules ask for it."""
    df = spark.createDataFrame([(1, "a (good) day!! why??")], "i int, t string")
    made = F.replace("t", F.lit("day"), F.lit("night"))
    scored = df.select(sentiment.compound(made, {"good": 1.9}).alias("s"))
    assert plan(scored).count("night") == 1
    assert scored.first()["s"] == df.select(sentiment.compound(F.lit("a (good) night!! why??"), {"good": 1.9}).alias("s")).first()["s"] > 0


def test_facts_are_read_without_looking_for_entities(spark, monkeypatch):
    """The articles are read once for rows and sources, and texts are searched for companies only for the tables of entities."""
    asked = []
    for module, name in ((known, "known_companies"), (star, "dim_entity")):
        monkeypatch.setattr(module, name, lambda *a, f=getattr(module, name), n=name, **b: asked.append(n) or f(*a, **b))
    rows = [(5, "2024-02-03", "BioSpace", "head", "a merger of alpha", "https://x.y/1", "0.5", "Gamma Corp")]
    articles = spark.createDataFrame(rows, "id long, date string, source string, headline string, body string, link string, sentiment string, matched_keywords string")
    tables = pipelines.build_star(articles, [("merger", "Event", "Business", [])], [], companies=spark.createDataFrame([("alpha",)], "name string"))
    assert [(r.Fact_ID, r.Source_Name, r.Tag_Count) for r in tables["Fact_Document"].collect()] == [(1000, "BioSpace", 1)] and asked == []
    assert sorted(r.Entity_Name for r in tables["Dim_Entity"].collect()) == ["Alpha", "Gamma Corp"] and tables["Bridge_Fact_Entity"].count() == 2
    assert sorted(asked) == ["dim_entity", "known_companies"] and len(tables) == 8


def test_general_keywords_are_sorted_and_searched_once(spark):
    """A tag about therapies gets all general keywords in order, and a category by a mark that spans two of them unless its own word comes between."""
    general = [f"aa{i:02}" for i in range(tags.BLOCK - 1)] + ["Aled", "by"] + [f"c{i:03}" for i in range(2 * tags.BLOCK)]
    own = {"x therapy": ["zzz", "by"], "y therapy": ["b"], "z cancer": ["b", "aa", "c0005"], "adc led": ["a0"], "called": ["by x"], "merger": []}
    rows = [(i, "", "", general[i : i + 6]) for i in range(0, len(general), 6)] + [(1000 + i, "", n, ws) for i, (n, ws) in enumerate(own.items())]
    shape = "row long, flag string, name string, words array<string>"
    with_general, without = spark.createDataFrame(rows, shape), spark.createDataFrame([r for r in rows if r[2]], shape)
    for df, more in ((with_general, [g.lower() for g in general]), (without, [])):
        defined = tags.define_tags(df)
        assert "LeftOuter" in plan(defined) and "array_sort" not in plan(defined)
        got, texts = {r.tag: r for r in defined.collect()}, {r.tag: r for r in tags.define_tags(df, joined="|").collect()}
        assert set(got) == set(own)
        for name, words in own.items():
            therapy = any(t in name for t in fixed.THERAPY_TERMS)
            want = sorted({name, *words, *(more if therapy else []), *fixed.VARIATIONS.get(name, [])})
            text = " ".join([name, *want])
            kind = next((rule[:2] for rule in fixed.TAG_CATEGORIES if any(m in text for m in rule[2])), ("Other", "General"))
            assert got[name].keywords == want and texts[name].keywords == "|".join(want)
            assert (got[name].category, got[name].domain) == (texts[name].category, texts[name].domain) == kind, name
    assert {n: tags.define_tags(with_general).where(F.col("tag") == n).first().category for n in ("x therapy", "y therapy", "called")} == {"x therapy": "Event", "y therapy": "Other", "called": "Event"}


def test_first_words_are_split_once(spark):
    assert plan(source_queries._tag_rows(spark, SF)).count("split(") == 1
    df = spark.createDataFrame([(t,) for t in ("", "one", ", one; two", "a b c d e", " a b c d e ", "a,b c")], "t string")
    got = [r.w for r in df.select(text.tokens(F.col("t"), 3).alias("w")).collect()]
    assert got == [r.w[:3] for r in df.select(text.tokens(F.col("t")).alias("w")).collect()]
