"""Matching text against keyword vocabularies.

The default strategy is an equi-join: word n-grams of the text are made
distinct and joined with the vocabulary, which is broadcast only while it has at
most MAX_BROADCAST rows. Keywords that hold punctuation are found by one
automaton over the whole vocabulary (see `rewrite`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.text import cases, quoted, split_multi, tokens
from quillmesh.operators.rewrite import keyword_finder

MAX_BROADCAST = 100_000
#: vocabularies up to so many keywords sort out a text's words before they are exploded
MAX_TESTED = 10_000


def vocabulary(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """(tag, keyword) rows; keywords lower-cased."""
    frame = spark.createDataFrame([(t, k.lower()) for t, k in rows], "tag string, keyword string").distinct()
    return F.broadcast(frame) if len(rows) <= MAX_BROADCAST else frame


def ngrams(words: Column, longest: int) -> Column:
    """All runs of 1 to `longest` words, joined by a space, once each."""
    out = words
    for n in range(2, longest + 1):  # runs at the end are shorter ones, met before
        out = F.concat(out, F.transform(words, _run(words, n)))
    return F.array_distinct(out)


def _run(words: Column, n: int):
    return lambda word, i: F.concat_ws(" ", word, *[F.get(words, i + k) for k in range(1, n)])


def candidates(words: Column, keywords: list[str], longest: int) -> Column:
    """Those runs of 1 to `longest` words that can be one of the keywords, once each: their first word begins one of that many words."""
    def of(n: int, firsts: list[str]) -> Column:
        run = _run(words, n) if n > 1 else lambda word, i: word
        return F.array_compact(F.transform(words, lambda word, i: F.when(word.isin(firsts), run(word, i))))

    firsts = {n: sorted({k.split()[0] for k in keywords if len(k.split()) == n}) for n in range(1, longest + 1)}
    runs = [of(n, found) for n, found in firsts.items() if found]
    return F.array_distinct(F.concat(*runs)) if runs else F.array().cast("array<string>")


def keyword_hits(docs: DataFrame, vocab: list[tuple[str, str]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, tag, keyword for each vocabulary keyword that occurs as whole words."""
    longest = max((len(k.split()) for _, k in vocab), default=1)
    words = docs.select(key, tokens(F.lower(F.coalesce(F.col(text), F.lit("")))).alias("_words"))
    if len(vocab) <= MAX_TESTED:
        grams = candidates(F.col("_words"), sorted({k.lower() for _, k in vocab}), longest)
    else:
        grams = F.array_distinct("_words") if longest == 1 else ngrams(F.col("_words"), longest)
    hits = words.select(key, F.explode(grams).alias("keyword"))
    return hits.join(vocabulary(docs.sparkSession, vocab), "keyword").select(key, "tag", "keyword")


def literal_hits(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As keyword_hits for a vocabulary (tag, keyword) whose keywords may hold punctuation: each is looked for as it is written."""
    return docs.select(key, F.inline(keyword_finder(vocab)(F.col(text)))).select(key, "tag", "keyword")


def column_tags(docs: DataFrame, vocab: list[tuple[str, str]], key: str = "doc_id", column: str = "matched_keywords") -> DataFrame:
    """key, tag from a delimited keyword column; tag names count as keywords of their own."""
    named = vocab + [(t, t) for t in dict.fromkeys(t for t, _ in vocab)]
    parts = docs.select(key, F.explode(F.transform(split_multi(F.col(column)), F.lower)).alias("keyword"))
    return parts.join(vocabulary(docs.sparkSession, named), "keyword").select(key, "tag").distinct()


def tag_confidence(hits: DataFrame, docs: DataFrame, categories: dict[str, str], medical: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, tag, confidence of text matches.

    0.4 and 0.1 for each different keyword, at most 0.8; 0.2 more if a one-word
    keyword is among the first 20 words of a text of more than ten; 0.1 more
    for events with several keywords; 0.1 more for therapies in medical text.
    """
    parts = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != "")
    facts = docs.select(key, F.when(F.size(parts) > 10, tokens(F.array_join(F.slice(parts, 1, 20), " "))).alias("head"), F.col(text).rlike("|".join(map(quoted, medical))).alias("medical"))
    found = hits.groupBy(key, "tag").agg(F.collect_set("keyword").alias("found"))
    category = F.create_map(*[F.lit(x) for pair in categories.items() for x in pair])[F.col("tag")] if categories else F.lit(None)
    many = F.size("found")
    value = F.least(F.lit(0.8), 0.4 + 0.1 * many)
    value = F.when(F.coalesce(F.arrays_overlap("found", "head"), F.lit(False)), F.least(F.lit(1.0), value + 0.2)).otherwise(value)
    value = F.when((category == "Event") & (many > 1), F.least(F.lit(1.0), value + 0.1)).otherwise(value)
    value = F.when((category == "Therapy") & F.col("medical"), F.least(F.lit(1.0), value + 0.1)).otherwise(value)
    return found.join(facts, key).select(key, "tag", F.round(value, 2).alias("confidence"))


def merge_tags(by_column: DataFrame, by_text: DataFrame, key: str = "doc_id") -> DataFrame:
    """Column matches weigh 0.9; the higher confidence of a tag counts."""
    return by_column.select(key, "tag", F.lit(0.9).alias("confidence")).unionByName(by_text.select(key, "tag", "confidence")).groupBy(key, "tag").agg(F.max("confidence").alias("confidence"))


def matched_ids(docs: DataFrame, vocab: list[tuple[str, str]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of docs with its sorted matched tags joined by '; '."""
    hits = keyword_hits(docs, vocab, key, text).groupBy(key).agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    return docs.select(key).join(hits, key, "left").select(key, F.coalesce(F.array_join("tags", "; "), F.lit("")).alias("ids"))


def expand_tags(tags: DataFrame) -> DataFrame:
    """Tags flagged individual with several keywords become one tag a keyword; (tag, keywords, individual)."""
    split = F.col("individual") & (F.size("keywords") > 1)
    each = F.when(split, F.transform("keywords", lambda k: F.struct(k.alias("tag"), F.array(k).alias("keywords")))).otherwise(F.array(F.struct("tag", "keywords")))
    return tags.select(F.inline(each))


def keyword_rows(tags: DataFrame) -> DataFrame:
    """(keyword, tag) rows of tag keywords and names, lower-cased."""
    return tags.select("tag", F.explode(F.array_union(F.transform("keywords", F.lower), F.array(F.lower("tag")))).alias("keyword"))


def variations(tag: Column) -> Column:
    """Keyword variations of a tag name by the fixed rules, first rule that fits."""
    from quillmesh.functions import fixed

    def strings(values: list[str]) -> Column:
        return F.array(*map(F.lit, values))

    low = F.lower(tag)
    last = F.element_at(F.split(low, r"\s+"), -1)
    series = F.array(F.concat(F.lit("series "), last), F.concat(F.lit("series"), last), F.concat(last, F.lit(" round")))
    names = list(fixed.VARIATIONS)
    rules: list[tuple[Column, Column]] = [(low == n, strings(fixed.VARIATIONS[n])) for n in names]
    rules.insert(names.index("takeover") + 1, (F.contains(low, F.lit("deal")), strings(fixed.DEAL_VARIATIONS)))
    rules.insert(names.index("raises") + 2, (F.contains(low, F.lit("series")), series))
    rules.insert(names.index("pipe") + 3, (F.contains(low, F.lit("dilutive")), strings(fixed.DILUTIVE_VARIATIONS)))
    return cases(rules, F.array().cast("array<string>"))
