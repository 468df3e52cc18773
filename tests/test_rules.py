"""Sentiment, rewriting and lemmas against plain Python that follows the rules one by one."""

import math
import random
import re

from pyspark.sql import functions as F

from quillmesh.functions import fixed, sentiment
from quillmesh.operators import lemmas, rewrite
from quillmesh.plans import text_queries

LEXICON = {"good": 1.9, "bad": -2.5, "great": 3.1, "no": -1.2, "fine": 0.8, ":)": 2.0, "kind": 2.4, "sick": -2.3, "heart": 1.0}


def compound(text, lexicon):
    """The published rules, word by word."""
    words = []
    for token in (text or "").split():
        bare = token.strip(sentiment.PUNCTUATION)
        words.append(token if len(bare) <= 2 else bare)
    low = [w.lower() for w in words]
    loud = sum(w.isupper() for w in words)
    mixed = 0 < loud < len(words)

    def negative(w):
        return w in fixed.NEGATIONS or "n't" in w

    def boost(w, v):
        if w.lower() not in fixed.BOOSTERS:
            return 0.0
        s = fixed.BOOSTERS[w.lower()] * (-1 if v < 0 else 1)
        if w.isupper() and mixed:
            s += 0.733 if v > 0 else -0.733
        return s

    values = []
    for i, w in enumerate(words):
        if low[i] in fixed.BOOSTERS or (low[i] == "kind" and i + 1 < len(words) and low[i + 1] == "of") or low[i] not in lexicon:
            values.append(0.0)
            continue
        v = lexicon[low[i]]
        if low[i] == "no" and i + 1 < len(words) and low[i + 1] in lexicon:
            v = 0.0
        elif (i > 0 and low[i - 1] == "no") or (i > 1 and low[i - 2] == "no") or (i > 2 and low[i - 3] == "no" and low[i - 1] in ("or", "nor")):
            v = lexicon[low[i]] * -0.74
        if w.isupper() and mixed:
            v += 0.733 if v > 0 else -0.733
        for back in (1, 2, 3):
            if i < back or low[i - back] in lexicon:
                continue
            v += boost(words[i - back], v) * (1, 0.95, 0.9)[back - 1]
            if back == 1:
                v *= -0.74 if negative(low[i - 1]) else 1
            elif back == 2:
                if low[i - 2] == "never" and low[i - 1] in ("so", "this"):
                    v *= 1.25
                elif not (low[i - 2] == "without" and low[i - 1] == "doubt") and negative(low[i - 2]):
                    v *= -0.74
            else:
                if (low[i - 3] == "never" and low[i - 2] in ("so", "this")) or low[i - 1] in ("so", "this"):
                    v *= 1.25
                elif not (low[i - 3] == "without" and "doubt" in (low[i - 2], low[i - 1])) and negative(low[i - 3]):
                    v *= -0.74
                back_phrases = [low[i - 1 : i + 1], low[i - 2 : i + 1], low[i - 2 : i], low[i - 3 : i], low[i - 3 : i - 1]]
                for p in map(" ".join, back_phrases):
                    if p in fixed.IDIOMS:
                        v = fixed.IDIOMS[p]
                        break
                for n in (2, 3):
                    if i + n <= len(words) and (p := " ".join(low[i : i + n])) in fixed.IDIOMS:
                        v = fixed.IDIOMS[p]
                for p in (low[i - 3 : i], low[i - 3 : i - 1], low[i - 2 : i]):
                    v += fixed.BOOSTERS.get(" ".join(p), 0.0)
        if i > 0 and low[i - 1] == "least" and "least" not in lexicon and (i == 1 or low[i - 2] not in ("at", "very")):
            v *= -0.74
        values.append(v)
    if "but" in low:
        at = low.index("but")
        values = [v * (0.5 if i < at else 1.5 if i > at else 1) for i, v in enumerate(values)]
    s = sum(values)
    if not s:
        return 0.0
    marks, questions = min(4, (text or "").count("!")) * 0.292, (text or "").count("?")
    marks += 0 if questions <= 1 else questions * 0.18 if questions <= 3 else 0.96
    s += math.copysign(marks, s)
    return round(max(-1.0, min(1.0, s / math.sqrt(s * s + 15))), 4)


RULES = [
    None, "", "  \n", "nothing here", "good", "not good", "isn't good", "very good", "VERY good", "good GOOD news", "GOOD", "slightly bad", "it was so very good", "never so good", "never been this good",
    "without a doubt good", "without doubt a good", "no good", "no bad or good", "say no to it", "the least good", "at the least good", "very least good", "least good", "at least good", "good but bad",
    "bad but good!!", "good!!!!!!", "bad? bad?", "bad ????", "that is so not a good thing", "what a broken heart today is good", "it will be to die for good", "some kind of good thing", "kind of bad", "he is sort of good",
    ":) :)", "(good)", "'bad'", "a breakthrough", "the trial failed", "hardly any good", "just enough of good", "not very good at all", "never a so good", "was never in this good",
]


def test_sentiment_rules(spark):
    rng = random.Random(6)
    parts = [*LEXICON, "GOOD", "BAD", "not", "never", "so", "this", "very", "VERY", "slightly", "without", "doubt", "least", "at", "but", "or", "nor", "broken", "sort", "of", "just", "enough", "isn't", "x", "y!", "z?", "die", "to", "for"]
    texts = RULES + [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    lexicon = LEXICON | fixed.VALENCES
    got = {r.i: r.s for r in df.select("i", sentiment.compound(F.col("t"), LEXICON).alias("s")).collect()}
    wrong = [(texts[i], s, compound(texts[i], lexicon)) for i, s in got.items() if abs(s - compound(texts[i], lexicon)) > 1e-4]
    assert not wrong, wrong[:5]
    assert got[3] == 0 and got[4] > 0 > got[5] and got[7] > got[4] > got[11]


def test_sentiment_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("good",)], "t string").select(sentiment.compound(F.col("t"), LEXICON))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def in_order(text, rules):
    """Rule after rule by regular expressions, keys put in at the end."""
    for i, (_, synonyms) in enumerate(rules):
        if synonyms:
            text = re.sub(r"\b(" + "|".join(map(re.escape, sorted(synonyms, key=len, reverse=True))) + r")\b", f"__KEY_{i}__", text, flags=re.IGNORECASE)
    for i, (key, _) in enumerate(rules):
        text = text.replace(f"__KEY_{i}__", f"[{key}]")
    return text


def test_rewriting_goes_in_order(spark):
    rng = random.Random(8)
    words = ["ab", "b", "ab b", "b ab", "é", "ab-b", "x", "b b b", "Ab", "İx"]
    for _ in range(3):
        rules = [(f"K{i}", rng.sample(words, rng.randrange(4))) for i in range(6)]
        texts = ["".join(rng.choice(["ab", "b", "é", "x", " ", " ", "-", "B", "_", "İ", "."]) for _ in range(rng.randrange(25))) for _ in range(300)]
        change = rewrite.rewriter(rewrite.rule_rows(spark, rules))
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", change(F.col("t")).alias("c")).collect()
        for r in rows:
            if "İ" not in texts[r.i]:
                assert r.c.out == in_order(texts[r.i], rules), (texts[r.i], rules)
                found = [k for k, s in rules if any(re.search(rf"\b{re.escape(x)}\b", texts[r.i], re.I) for x in [*s, k])]
                assert r.c["keys"] == "; ".join(found)


def test_many_rules_and_first_substring(spark):
    rules = spark.range(5000).selectExpr("cast(id as int) AS rule", "concat('Key ', id) AS key", "concat('w', id) AS synonym", "true AS rewrites")
    change = rewrite.rewriter(rules)
    text = " ".join(f"W{i}" for i in range(0, 6000, 7))
    out = spark.createDataFrame([(text,)], "t string").select(change(F.col("t")).alias("c")).first().c
    assert out.out == " ".join(f"[Key {i}]" if i < 5000 else f"W{i}" for i in range(0, 6000, 7))
    index = spark.createDataFrame([(2, "second", "bc"), (1, "first", "cd"), (3, "none", ""), (4, "null", None)], "position int, id string, keyword string")
    first = rewrite.first_substring(index)
    got = spark.createDataFrame([("aBCd",), ("xbc",), ("",), (None,)], "t string").select(first(F.col("t")).alias("f")).collect()
    assert [r.f for r in got] == ["first", "second", None, None]
    none = rewrite.rewriter(rules.limit(0))
    assert spark.createDataFrame([("a b",)], "t string").select(none(F.col("t")).alias("c")).first().c.out == "a b"


def lemma(word, known, exceptions, pos):
    """Detached level by level until the dictionary has something."""
    def fit(forms):
        forms = list(dict.fromkeys(f for f in forms if f in known))
        return min(forms, key=len) if forms else None

    def apply(forms):
        return [f[: len(f) - len(old)] + new for f in forms for old, new in fixed.DETACHMENT[pos] if f.endswith(old) and f != old or (f == old and new)]

    if word in exceptions:
        return fit([word, *sorted(exceptions[word])]) or word
    forms = apply([word])
    found = fit([word, *forms])
    while not found and forms:
        forms = apply(forms)
        found = fit(forms)
    return found or word


def test_lemmas(spark):
    rng = random.Random(9)
    known = {"dog", "box", "wolf", "man", "berry", "bus", "glass", "church", "quiz", "bu", "run", "runn", "hope", "hop", "be", "tall", "late"}
    texts = ["dogs boxes wolves men berries buses glasses churches quizes", "mice geese  dogs\n x", None, "", "busses dogss glassess sss s men womenmen", "running hoped hopes taller latest being"]
    texts += [" ".join("".join(rng.choice(["s", "es", "men", "ies", "dog", "bus", "ves", "ing", "ed"]) for _ in range(rng.randrange(1, 5))) for _ in range(6)) for _ in range(60)]
    exceptions = {"mice": ["mouse"], "geese": ["goose", "bus"], "dogs": ["dog", "bu"]}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for pos in fixed.DETACHMENT:
        words = docs.select(F.explode(F.split("text", r"\s+")).alias("word"))
        table = lemmas.lemma_table(words, spark.createDataFrame([(w, pos) for w in known], "word string, pos string"), spark.createDataFrame([(f, pos, x) for f, v in exceptions.items() for x in v], "form string, pos string, lemma string"), pos)
        want = {i: " ".join(lemma(w, known, exceptions, pos) for w in (t or "").split()) for i, t in enumerate(texts)}
        for most in (1000, 0):  # by a table in the expression, and by a join
            assert {r.doc_id: r.text for r in lemmas.lemmatise(docs, table, most=most).collect()} == want


def test_lemmas_read_the_dictionary_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    known = spark.createDataFrame([("plant", "n"), ("class", "n"), ("die", "v")], "word string, pos string").mapInPandas(counted, "word string, pos string")
    words = spark.createDataFrame([("plants",), ("classes",), ("plant",), ("dies",), ("",)], "word string")
    got = {r.word: r.lemma for r in lemmas.lemma_table(words, known).collect()}
    assert got == {"plants": "plant", "classes": "class", "plant": "plant"} and read.value == 3


def test_words_that_several_keys_hold(spark):
    rows = [("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", None), ("c", None), ("d", None), ("d", 3)]
    got = spark.createDataFrame(rows, "word string, k long").groupBy("word").agg(text_queries._several("k").alias("several"))
    assert {r.word: r.several for r in got.collect()} == {"a": False, "b": True, "c": False, "d": True}
