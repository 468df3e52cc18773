"""Queries over text: cleaning, matching, tags."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillmesh.functions import fixed, text
from quillmesh.functions.entities import tag_category
from quillmesh.operators import lemmas, match, rewrite
from quillmesh.plans import common as c
from quillmesh.session import durable

SQL_DOC = "coalesce(text, '')"


def doc():
    return F.coalesce(F.col("text"), F.lit(""))


def _map(fn):
    return lambda spark, sf: c.table(spark, sf, "documents").select("doc_id", fn(doc()).alias("out"))


def _sql(expr: str) -> str:
    return f"SELECT doc_id, {expr} AS out FROM documents"


def _tag_frame(spark, sf):
    """Hosts as tags: the first words of their documents as keywords; hosts of even numbers are individual."""
    first = F.get(text.tokens(F.coalesce("text", F.lit(""))), 0)
    rows = _docs(spark, sf).where(first.isNotNull()).groupBy(F.col("source").alias("tag")).agg(F.array_sort(F.collect_set(first)).alias("keywords"))
    return rows.withColumn("individual", F.regexp_extract("tag", "[0-9]+", 0).cast("int") % 2 == 0)


TAG_ROWS = f"(SELECT source AS tag, list(DISTINCT w ORDER BY w) AS keywords, regexp_extract(source, '[0-9]+')::INT % 2 = 0 AS individual FROM (SELECT source, {c.sql_tokens(SQL_DOC)}[1] AS w FROM documents) WHERE w IS NOT NULL GROUP BY source)"
RULES, SYNONYMS = 1000, 3000


def _docs(spark, sf):
    return c.table(spark, sf, "documents")


def match_keywords(spark, sf):
    return match.keyword_hits(_docs(spark, sf), c.VOCAB)


def literal_keywords(spark, sf):
    """Keywords with punctuation: the 200 pairs of words with a comma or full stop between that most documents hold."""
    pairs = F.array_distinct(F.regexp_extract_all(F.lower(doc()), F.lit(r"(?<!\p{L})\p{L}++[.,] \p{L}+"), F.lit(0)))
    common = _docs(spark, sf).select(F.explode(pairs).alias("keyword")).groupBy("keyword").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "keyword").limit(200)
    return match.literal_hits(_docs(spark, sf), common.select(F.substring_index("keyword", " ", 1).alias("tag"), "keyword"))


def tag_confidence(spark, sf):
    docs = _docs(spark, sf).select("doc_id", F.lower(doc()).alias("text"))
    return match.tag_confidence(match.keyword_hits(docs, c.VOCAB), docs, c.CATEGORIES, c.MEDICAL)


def tag_frequency(spark, sf):
    return match.keyword_hits(_docs(spark, sf), c.VOCAB).select("doc_id", "tag").distinct().groupBy("tag").agg(F.count("*").alias("documents"))


def column_tags(spark, sf):
    docs = _docs(spark, sf).select("doc_id", F.concat_ws("; ", F.when(doc().contains("thing"), "Thing"), F.when(doc().contains("que"), " que "), F.lit(""), F.when(doc().contains("und"), "und approval | der")).alias("matched_keywords"))
    return match.column_tags(docs, c.VOCAB)


def merged_tags(spark, sf):
    by_column = column_tags(spark, sf)
    return match.merge_tags(by_column, tag_confidence(spark, sf))


def vocab_index_ids(spark, sf):
    return match.matched_ids(_docs(spark, sf), c.VOCAB)


def _ranked(spark, sf, most, longer=3):
    """The words of more than so many letters that most documents hold: word, r from 0."""
    words = F.array_distinct(text.tokens(F.lower(doc())))
    counts = _docs(spark, sf).select(F.explode(words).alias("word")).where(F.length("word") > longer).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(most)
    return counts.select("word", (F.row_number().over(Window.orderBy(F.desc("n"), "word")) - 1).alias("r"))


def _ranked_sql(most, longer=3):
    return f"SELECT w, row_number() OVER (ORDER BY n DESC, w) - 1 AS r FROM (SELECT w, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest({c.sql_tokens(f'lower({SQL_DOC})')}) AS w FROM documents) WHERE length(w) > {longer} GROUP BY w) QUALIFY r < {most}"


def first_index_substring(spark, sf):
    """The first of 1,000 keywords that a text holds anywhere."""
    index = _ranked(spark, sf, 2 * RULES, 6).where(f"r >= {RULES}")
    first = rewrite.first_substring(index.select(F.col("r").alias("position"), F.concat(F.lit("I"), "r").alias("id"), F.col("word").alias("keyword")))
    return _docs(spark, sf).select("doc_id", first(doc()).alias("out"))


def consolidate_text(spark, sf):
    """1,000 rules of three synonyms each over whole texts."""
    rule = F.col("r") % RULES
    rules = _ranked(spark, sf, SYNONYMS).select(rule.alias("rule"), F.concat(F.lit("Rule "), rule).alias("key"), F.col("word").alias("synonym"), F.lit(True).alias("rewrites"))
    change = rewrite.rewriter(rules)
    return _docs(spark, sf).select("doc_id", change(doc()).alias("c")).select("doc_id", "c.out", "c.keys")


_CONSOLIDATE = rf"""
WITH ranked AS ({_ranked_sql(SYNONYMS)}), pieces AS (
  SELECT doc_id, generate_subscripts(ps, 1) AS pos, unnest(ps) AS p FROM (SELECT doc_id, regexp_extract_all({SQL_DOC}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+') AS ps FROM documents)
), marked AS (SELECT doc_id, pos, p, r % {RULES} AS rule FROM pieces LEFT JOIN ranked ON lower(p) = w
), outs AS (SELECT doc_id, string_agg(CASE WHEN rule IS NULL THEN p ELSE '[Rule ' || rule || ']' END, '' ORDER BY pos) AS out FROM marked GROUP BY doc_id
), found AS (SELECT doc_id, string_agg('Rule ' || rule, '; ' ORDER BY rule) AS keys FROM (SELECT DISTINCT doc_id, rule FROM marked WHERE rule IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, coalesce(out, '') AS out, coalesce(keys, '') AS keys FROM documents LEFT JOIN outs USING (doc_id) LEFT JOIN found USING (doc_id)"""
_LITERAL = rf"""
WITH common AS (SELECT k, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower({SQL_DOC}), '\p{{L}}+[.,] \p{{L}}+')) AS k FROM documents) GROUP BY k ORDER BY n DESC, k LIMIT 200), held AS MATERIALIZED (SELECT doc_id, k, string_split(t, k) AS parts FROM (SELECT doc_id, lower({SQL_DOC}) AS t FROM documents) JOIN common ON contains(t, k))
SELECT doc_id, split_part(k, ' ', 1) AS tag, k AS keyword FROM held
WHERE len([i FOR i IN range(1, len(parts)) IF NOT regexp_matches(parts[i], '[\p{{L}}\p{{N}}_]$') AND NOT regexp_matches(parts[i + 1], '^[\p{{L}}\p{{N}}_]')]) > 0"""


def _several(key: str):
    """Whether a group holds two different keys, null among them, without gathering them."""
    return F.coalesce(F.min(key) < F.max(key), F.lit(False)) | F.count(key).between(1, F.count(F.lit(1)) - 1)


_EXCEPTIONS = [("men", "n", "man"), ("thes", "n", "the"), ("des", "n", "die")]


def lemmatised_text(spark, sf):
    """Nouns of a dictionary made from the table: words of three letters or more that two documents hold."""
    each = F.array_distinct(F.filter(F.split(F.lower(doc()), r"\s+"), lambda w: w != ""))
    held = _docs(spark, sf).select("doc_id", F.explode(each).alias("word")).groupBy("word").agg(_several("doc_id").alias("several"))
    words = durable(held)  # read again for every round of rules
    known = words.where("several and length(word) >= 3").select("word", F.lit("n").alias("pos"))
    table = lemmas.lemma_table(words, known, spark.createDataFrame(_EXCEPTIONS, "form string, pos string, lemma string"))
    return lemmas.lemmatise(_docs(spark, sf).select("doc_id", F.lower(doc()).alias("text")), table)


_RULE_SQL = " UNION ALL ".join(f"SELECT word, level + 1, left(form, length(form) - {len(old)}) || '{new}', place * 10 + {i} FROM forms WHERE ends_with(form, '{old}') AND level < 12 AND length(form) > {len(old)}" for i, (old, new) in enumerate(fixed.DETACHMENT["n"]))
_LEMMA_SQL = rf"""
WITH RECURSIVE toks AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM (SELECT doc_id, list_filter(string_split_regex(lower({SQL_DOC}), '[\s\x0B]+'), lambda w: w <> '') AS ws FROM documents)
), known AS (SELECT word FROM (SELECT DISTINCT doc_id, word FROM toks) WHERE length(word) >= 3 GROUP BY word HAVING count(*) >= 2
), special AS (SELECT * FROM {c.sql_values([(f, l) for f, _, l in _EXCEPTIONS], 'form, lemma')}
), forms(word, level, form, place) AS (
  SELECT DISTINCT word, 0, word, 0::HUGEINT FROM toks WHERE word NOT IN (SELECT form FROM special)
  UNION ALL (SELECT * FROM ({_RULE_SQL}) AS made(word, level, form, place))
), hits AS (
  SELECT word, greatest(level, 1) AS level, form, CASE WHEN level = 0 THEN -1 ELSE place END AS place FROM forms WHERE form IN (SELECT word FROM known)
  UNION ALL SELECT form, 1, form, -1 FROM special WHERE form IN (SELECT word FROM known)
  UNION ALL SELECT form, 1, lemma, 0 FROM special WHERE lemma IN (SELECT word FROM known)
), best AS (SELECT word, form AS lemma FROM hits QUALIFY row_number() OVER (PARTITION BY word ORDER BY level, length(form), place) = 1)
SELECT d.doc_id, coalesce(t.text, '') AS text FROM documents d LEFT JOIN (SELECT doc_id, string_agg(coalesce(lemma, toks.word), ' ' ORDER BY pos) AS text FROM toks LEFT JOIN best ON toks.word = best.word GROUP BY doc_id) t ON d.doc_id = t.doc_id"""


def individual_tag_split(spark, sf):
    return match.expand_tags(_tag_frame(spark, sf)).select("tag", F.array_join("keywords", ",").alias("keywords"))


def tag_keyword_explode(spark, sf):
    return match.keyword_rows(_tag_frame(spark, sf))


_MARKED = [*fixed.VARIATIONS, "car-t", "contract manufacturing", "series b", "biotech deal", "capital raise", "idle"]


def tag_categories(spark, sf):
    """Tags of a fixed name and the document's language and number."""
    name = F.concat_ws(" ", F.element_at(F.array(*map(F.lit, _MARKED)), (F.col("doc_id") % len(_MARKED) + 1).cast("int")), "lang", "doc_id")
    got = tag_category(F.lower(name))
    return _docs(spark, sf).select(name.alias("tag"), got["category"].alias("category"), got["domain"].alias("domain"))


def _categories_sql() -> str:
    def case(i: int) -> str:
        return "CASE " + " ".join("WHEN " + " OR ".join(f"contains(tag, {c.quote(m)})" for m in r[2]) + f" THEN {c.quote(r[0:2][i])}" for r in fixed.TAG_CATEGORIES) + f" ELSE {c.quote(('Other', 'General')[i])} END"

    return f"SELECT tag, {case(0)} AS category, {case(1)} AS domain FROM (SELECT concat_ws(' ', [{', '.join(map(c.quote, _MARKED))}][doc_id % {len(_MARKED)} + 1], lang, doc_id) AS tag FROM documents)"


_VARIED = ["Acquisition", "merger", "{w} deal", "Series {w}", "{w} dilutive financing", "phase 3", "{w}"]


def keyword_variations(spark, sf):
    """Tags made of each document's first word by seven patterns."""
    w = F.coalesce(F.get(text.tokens(F.lower(doc())), 0), F.lit("none"))
    tag = F.element_at(F.array(*[F.replace(F.lit(v), F.lit("{w}"), w) for v in _VARIED]), (F.col("doc_id") % len(_VARIED) + 1).cast("int"))
    return _docs(spark, sf).select("doc_id", tag.alias("tag")).select("doc_id", "tag", F.explode_outer(match.variations(F.col("tag"))).alias("keyword"))


def _variations_sql() -> str:
    def strings(values: list[str]) -> str:
        return "[" + ", ".join(map(c.quote, values)) + "]"

    made = "[" + ", ".join(f"replace({c.quote(v)}, '{{w}}', w)" for v in _VARIED) + "]"
    kinds = [strings(fixed.VARIATIONS["acquisition"]), strings(fixed.VARIATIONS["merger"]), strings(fixed.DEAL_VARIATIONS), "['series ' || w, 'series' || w, w || ' round']", strings(fixed.DILUTIVE_VARIATIONS), strings(fixed.VARIATIONS["phase 3"]) if "phase 3" in fixed.VARIATIONS else "[NULL]", "[NULL]"]
    return f"""SELECT doc_id, tag, unnest(CASE k {' '.join(f'WHEN {i} THEN {v}' for i, v in enumerate(kinds))} END) AS keyword FROM (
      SELECT doc_id, doc_id % {len(_VARIED)} AS k, w, {made}[doc_id % {len(_VARIED)} + 1] AS tag FROM (SELECT doc_id, coalesce({c.sql_tokens(f"lower({SQL_DOC})")}[1], 'none') AS w FROM documents))"""


def ngram_phrases(spark, sf):
    phrases = [("p", "of the"), ("q", "and the"), ("r", "to the and"), ("s", "de la")]
    return match.keyword_hits(_docs(spark, sf), phrases).select("doc_id", "keyword")


_NGRAM_SQL = f"""
WITH d AS (SELECT doc_id, ' ' || array_to_string({c.sql_tokens("lower(coalesce(text, ''))")}, ' ') || ' ' AS line FROM documents)
SELECT doc_id, keyword FROM d, (VALUES ('of the'), ('and the'), ('to the and'), ('de la')) AS v(keyword) WHERE contains(line, ' ' || keyword || ' ')
"""


def split_columns(spark, sf):
    return _docs(spark, sf).select("doc_id", F.array_join(text.split_multi(F.regexp_replace(doc(), r"[.\n]", ";")), "|").alias("parts"), text.slug(F.col("source")).alias("slug"), text.clean_value(F.col("lang")).alias("lang"), text.strip_author_prefix(F.concat(F.lit("By "), F.col("source"))).alias("author"))


def combined_text(spark, sf):
    head = F.substring_index(doc(), "\n", 1)
    return _docs(spark, sf).select("doc_id", text.combined_text(head, doc(), F.when(F.col("doc_id") % 2 == 0, doc()).otherwise(F.concat(head, F.lit("!")))).alias("combined"))


_HEAD = "split_part(coalesce(text, ''), chr(10), 1)"
_CONF_SQL = f"""
conf AS (
  SELECT f.doc_id, f.tag, round(
    CASE WHEN f.tag IN ({', '.join(c.quote(t) for t, k in c.CATEGORIES.items() if k == 'Event')}) AND n > 1 THEN least(1.0, b + 0.1)
         WHEN f.tag IN ({', '.join(c.quote(t) for t, k in c.CATEGORIES.items() if k == 'Therapy')}) AND regexp_matches(t, '{'|'.join(c.MEDICAL)}') THEN least(1.0, b + 0.1) ELSE b END, 2)::DOUBLE AS confidence
  FROM (SELECT h.doc_id, h.tag, h.n, d.t, CASE WHEN len(d.parts) > 10 AND len(list_intersect(h.found, {c.sql_tokens("array_to_string(d.parts[1:20], ' ')")})) > 0 THEN least(1.0, least(0.8, 0.4 + 0.1 * h.n) + 0.2) ELSE least(0.8, 0.4 + 0.1 * h.n) END AS b
        FROM (SELECT doc_id, tag, list(DISTINCT keyword) AS found, count(DISTINCT keyword) AS n FROM hits GROUP BY doc_id, tag) h
        JOIN (SELECT doc_id, lower(coalesce(text, '')) AS t, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\s' || chr(11) || ']+'), lambda w: w <> '') AS parts FROM documents) d ON h.doc_id = d.doc_id) f
)"""
_COLUMN_SQL = """
bycol AS (
  SELECT DISTINCT doc_id, tag FROM (
    SELECT doc_id, unnest(CASE WHEN contains(t, 'thing') THEN ['thing series'] ELSE [] END || CASE WHEN contains(t, 'que') THEN ['que platform'] ELSE [] END || CASE WHEN contains(t, 'und') THEN ['und approval'] ELSE [] END) AS tag
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
)"""

QUERIES = {
    "norm_text": _map(text.normalize_text),
    "strip_urls_emails": _map(lambda x: text.strip_emails(text.strip_urls(x))),
    "drop_single_chars": _map(text.drop_single_chars),
    "clean_boilerplate": _map(text.remove_long_boilerplate),
    "clean_text": _map(text.clean_text),
    "late_clean": _map(lambda x: text.late_clean(F.lower(x))),
    "consolidate_text": consolidate_text,
    "combined_text": combined_text,
    "split_columns": split_columns,
    "match_keywords": match_keywords,
    "literal_keywords": literal_keywords,
    "lemmatised_text": lemmatised_text,
    "ngram_phrases": ngram_phrases,
    "column_tags": column_tags,
    "tag_confidence": tag_confidence,
    "merged_tags": merged_tags,
    "tag_frequency": tag_frequency,
    "vocab_index_ids": vocab_index_ids,
    "first_index_substring": first_index_substring,
    "individual_tag_split": individual_tag_split,
    "tag_keyword_explode": tag_keyword_explode,
    "tag_categories": tag_categories,
    "keyword_variations": keyword_variations,
}

_LONG = c.sql_tidy(c.sql_fold(c.sql_fold(c.sql_strip(SQL_DOC), fixed.LONG_BOILERPLATE), fixed.LONG_MARKERS, "."))
_CLEAN = c.sql_strip(c.sql_collapse(c.sql_single(c.sql_collapse(rf"regexp_replace(lower({c.sql_fold(c.sql_emails(c.sql_urls(_LONG)), fixed.EXPORT_AFFIXES)}), '[^\p{{L}}\p{{N}}_\s'']', '', 'g')"))))
ORACLES = {
    "norm_text": _sql(c.sql_core(c.sql_boilerplate(SQL_DOC))),
    "strip_urls_emails": _sql(c.sql_emails(c.sql_urls(SQL_DOC))),
    "drop_single_chars": _sql(c.sql_single(SQL_DOC)),
    "clean_boilerplate": _sql(_LONG),
    "clean_text": _sql(_CLEAN),
    "late_clean": _sql(c.sql_strip(c.sql_fold(f"lower({SQL_DOC})", fixed.LATE_MARKERS))),
    "consolidate_text": _CONSOLIDATE,
    "combined_text": f"SELECT doc_id, concat_ws(' ', nullif({c.sql_strip(_HEAD)}, ''), nullif({c.sql_strip(SQL_DOC)}, ''), CASE WHEN doc_id % 2 <> 0 AND {_HEAD} || '!' <> {SQL_DOC} THEN nullif({c.sql_strip(_HEAD + " || '!'")}, '') END) AS combined FROM documents",
    "split_columns": rf"SELECT doc_id, array_to_string(list_filter(list_transform(string_split_regex({SQL_DOC}, '[.\n;,|]'), lambda w: trim(w, ' ' || chr(9) || chr(11) || chr(12) || chr(13))), lambda w: w <> ''), '|') AS parts, lower(regexp_replace(source, '[^a-zA-Z0-9]', '_', 'g')) AS slug, lang, source AS author FROM documents",
    "match_keywords": f"WITH {c.HITS_SQL} SELECT * FROM hits",
    "literal_keywords": _LITERAL,
    "lemmatised_text": _LEMMA_SQL,
    "ngram_phrases": _NGRAM_SQL,
    "column_tags": f"WITH {_COLUMN_SQL} SELECT * FROM bycol",
    "tag_confidence": f"WITH {c.HITS_SQL}, {_CONF_SQL} SELECT * FROM conf",
    "merged_tags": f"WITH {c.HITS_SQL}, {_CONF_SQL}, {_COLUMN_SQL} SELECT doc_id, tag, max(confidence) AS confidence FROM (SELECT * FROM conf UNION ALL SELECT doc_id, tag, 0.9::DOUBLE FROM bycol) GROUP BY doc_id, tag",
    "tag_frequency": f"WITH {c.HITS_SQL} SELECT tag, count(DISTINCT doc_id)::BIGINT AS documents FROM hits GROUP BY tag",
    "vocab_index_ids": f"WITH {c.HITS_SQL} SELECT d.doc_id, coalesce(ids, '') AS ids FROM documents d LEFT JOIN (SELECT doc_id, string_agg(tag, '; ' ORDER BY tag) AS ids FROM (SELECT DISTINCT doc_id, tag FROM hits) GROUP BY doc_id) h ON d.doc_id = h.doc_id",
    "first_index_substring": f"WITH ranked AS ({_ranked_sql(2 * RULES, 6)}) SELECT doc_id, 'I' || min(r) AS out FROM documents LEFT JOIN ranked ON r >= {RULES} AND contains(lower({SQL_DOC}), w) GROUP BY doc_id",
    "individual_tag_split": f"SELECT unnest(CASE WHEN individual AND len(keywords) > 1 THEN keywords ELSE [tag] END) AS tag, unnest(CASE WHEN individual AND len(keywords) > 1 THEN keywords ELSE [array_to_string(keywords, ',')] END) AS keywords FROM {TAG_ROWS}",
    "tag_keyword_explode": f"SELECT tag, unnest(list_distinct(list_append([lower(k) FOR k IN keywords], lower(tag)))) AS keyword FROM {TAG_ROWS}",
    "tag_categories": _categories_sql(),
    "keyword_variations": _variations_sql(),
}
