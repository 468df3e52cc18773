"""Queries over entities, scores, sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmesh.functions import entities, fixed, score, sentiment, text
from quillmesh.operators import entity, incremental, match, star
from quillmesh.plans import common as c

_ENDINGS = ["Inc.", "Corp", "& Sons Ltd", "Holdings", "Pharma", "", "and Co", "Therapeutics", "GmbH", "University"]


def _names(spark, sf):
    """Company-like names from customers and suppliers: two words of the key and an ending."""
    parts = ["Alpha", "Beta", "astra Zeneca", "Gen-X", "O'Neil", "Delta", "Echo", "Fox trot", "Golf", "Hotel", "India"]
    words, ends = F.array(*map(F.lit, parts)), F.array(*map(F.lit, _ENDINGS))
    k = F.col("c_custkey")
    keys = c.table(spark, sf, "customer").select("c_custkey").repartition(4 * spark.sparkContext.defaultParallelism, "c_custkey")  # a small file is one task
    return keys.select(k.alias("id"), F.trim(F.concat_ws(" ", F.element_at(words, (k % 11 + 1).cast("int")), F.element_at(words, (k % 7 + 1).cast("int")), F.element_at(ends, (k % 10 + 1).cast("int")))).alias("name"), F.round(F.pmod(k * 7, F.lit(100)) / 100, 2).alias("confidence"), (k % 5).cast("long").alias("mentions"))


_NAMES = """names AS (SELECT c_custkey AS id, trim(concat_ws(' ', w[(c_custkey % 11 + 1)::INT], w[(c_custkey % 7 + 1)::INT], e[(c_custkey % 10 + 1)::INT])) AS name, round((c_custkey * 7 % 100) / 100.0, 2)::DOUBLE AS confidence, (c_custkey % 5)::BIGINT AS mentions
  FROM customer, (SELECT ['Alpha', 'Beta', 'astra Zeneca', 'Gen-X', 'O''Neil', 'Delta', 'Echo', 'Fox trot', 'Golf', 'Hotel', 'India'] AS w, ['Inc.', 'Corp', '& Sons Ltd', 'Holdings', 'Pharma', '', 'and Co', 'Therapeutics', 'GmbH', 'University'] AS e))"""
_LOWER = r"regexp_replace(regexp_replace(lower(trim(name)), '\s*&\s*', ' and ', 'g'), '\s+and\s+', 'and', 'g')"
_NORM = r"regexp_replace(regexp_replace(" + c.sql_fold(_LOWER, [rf"\s+{s}[\s.,;:]*$" for s in sorted(fixed.COMPANY_SUFFIXES, key=lambda s: (-len(s), s))], flags="g") + r""", '[\s\-.,;:+''"]+', '', 'g'), '^[^a-z0-9]+|[^a-z0-9]+$', '', 'g')"""
_REG = c.sql_strip(rf"regexp_replace(regexp_replace({c.sql_fold('lower(trim(name))', fixed.REGISTRY_PATTERNS)}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g')")


def entity_normalize(spark, sf):
    return _names(spark, sf).select("id", entities.normalize_entity(F.col("name")).alias("norm"), entities.registry_name(F.col("name")).alias("registry"), entities.display_name(F.col("name")).alias("display"), entities.entity_type(F.col("name")).alias("type"))


def entity_dedup_best(spark, sf):
    return entity.best_entities(_names(spark, sf).withColumn("doc", F.col("id") % 40), "doc")


def canonical_company(spark, sf):
    return entity.canonical_names(_names(spark, sf), "name")


def manual_override(spark, sf):
    o = spark.createDataFrame([("alpha alpha inc.", "Alpha"), ("beta beta corp", "Beta Group")], "variant string, canonical string")
    return entity.with_override(_names(spark, sf), o).select("id", "name", "confidence")


def likely_company(spark, sf):
    n = _names(spark, sf).withColumn("short", F.element_at(F.split("name", " "), 1))
    return n.select("id", entities.likely_company(F.col("name")).alias("long"), entities.likely_company(F.col("short")).alias("short"))


def rejected_summary(spark, sf):
    n = _names(spark, sf).withColumn("short", F.element_at(F.split("name", " "), 1))
    return entity.rejected(n.where(~entities.likely_company(F.col("short"))), "short")


def _registry(spark, sf):
    return c.table(spark, sf, "supplier").join(_names(spark, sf), F.col("s_suppkey") == F.col("id")).select("name", F.concat(F.lit("TK"), "s_suppkey").alias("ticker"), F.lit("SEC").alias("source"), F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("cik"))


def company_enrich(spark, sf):
    n = _names(spark, sf).select("id", F.when(F.col("id") % 9 == 0, F.concat(F.lit("tk"), F.col("id") % 200)).otherwise(F.col("name")).alias("name"))
    return entity.enrich(n, _registry(spark, sf))


def company_validate(spark, sf):
    good, bad = entity.split_valid(_names(spark, sf).select("id", "name"), _registry(spark, sf))
    return good.select("id", F.lit(True).alias("valid")).union(bad.select("id", F.lit(False)))


def entity_cascade(spark, sf):
    dim = _names(spark, sf).where("id % 3 = 0").select(F.col("name").alias("Entity_Name")).distinct()
    dim = star.numbered(dim, "Entity_Key", ["Entity_Name"], star.FIRST_ENTITY)
    n = _names(spark, sf).select("id", F.when(F.col("id") % 4 == 0, F.element_at(F.split("name", " "), 1)).otherwise(F.col("name")).alias("name"))
    return entity.resolve(n, dim).select("id", F.col("Entity_Key").cast("int").alias("Entity_Key"))


_BRIDGE = "CASE " + " ".join(f"WHEN ends_with({{low}}, {c.quote(s)}) THEN trim(left({{low}}, length({{low}}) - {len(s)}))" for s in fixed.BRIDGE_SUFFIXES) + " ELSE {low} END"
_LOW = "rtrim(lower(trim({n})), '''\".,;: ')"


_MENTIONED = ["attion", "thing", "que"]


def mention_count(spark, sf):
    """Mentions in whole texts, counted where the words of the text hold the name."""
    docs = c.table(spark, sf, "documents").select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    pairs = match.keyword_hits(docs, [(n, n) for n in _MENTIONED]).select("doc_id", F.col("tag").alias("name"))
    found = pairs.join(docs, "doc_id").select("doc_id", "name", entities.mention_count(F.col("text"), F.col("name")).cast("long").alias("n"))
    return found.where("n > 0")


_HIGH, _MEDIUM, _LOWW = ["attion", "thing"], ["que", "die"], ["the", "la"]


def _scored(spark, sf):
    pages = c.table(spark, sf, "pages")
    t = F.lower(F.concat_ws(" ", text.strip_tags(F.col("html")), F.col("url")))
    cats = F.split(F.regexp_extract("url", "^https?://[^/]*/([^/]+)/", 1), ",")
    k = score.keyword_score(t, _HIGH, _MEDIUM, _LOWW)
    u = score.url_score(F.col("url"), ["/en/", "https://"], ["page="])
    g = score.category_score(cats, ["en", "fr"])
    return pages.select("page_id", "url", score.relevance(k, u, g).alias("score")).withColumn("priority", score.priority(F.col("score")))


def relevance_score(spark, sf):
    return _scored(spark, sf).drop("url")


def priority_routing(spark, sf):
    return _scored(spark, sf).groupBy("priority").agg(F.count("*").alias("n"))


def queue_topk(spark, sf):
    q = _scored(spark, sf).select("page_id", F.col("url").alias("link"), "score", F.when(F.col("priority") == "low", "ignored").otherwise("queued").alias("status"))
    return incremental.top_queue(q, 50).select("page_id", "score")


def status_update(spark, sf):
    rows = _scored(spark, sf).select("page_id", F.lit("pending").alias("status"))
    done = rows.where("page_id % 3 = 0").select("page_id")
    return incremental.set_status(rows, done, "page_id", "pending", "scraped")


_LEX = {"attion": 2.0, "thing": 1.5, "que": -1.0, "die": -2.5, "ering": 0.5}


def sentiment_overlay(spark, sf):
    """The industry overlay over whole texts, each given two of its words."""
    words = F.array(*map(F.lit, fixed.VALENCES))
    n = len(fixed.VALENCES)
    more = [F.element_at(words, (F.col("doc_id") * k % n + 1).cast("int")) for k in (1, 7)]
    docs = c.table(spark, sf, "documents").select("doc_id", text.tokens(F.lower(F.concat_ws(" ", "text", *more))).alias("words"))
    value = F.round(sentiment.overlay_sum(F.col("words")), 4)
    return docs.select("doc_id", value.alias("valence"), score.sentiment_label(value).alias("label"))


def sentiment_stats(spark, sf):
    s = F.col("value") / 100 - 0.25
    e = c.table(spark, sf, "events").select(s.alias("s"))
    return e.agg(F.count("s").alias("n"), F.round(F.sum("s"), 6).alias("total"), F.round(F.avg("s"), 6).alias("mean"), F.min("s").alias("least"), F.max("s").alias("most"), F.count_if(F.col("s") > 0.05).alias("positive"), F.count_if(F.col("s") < -0.05).alias("negative"), F.count_if(F.col("s").between(-0.05, 0.05)).alias("neutral"))


#: words of the documents put in place of others, so that every rule has something to do
_SWAPS = {"the": "not", "and": "VERY", "of": "good", "in": "bad", "que": "never", "la": "so", "und": "but", "die": "least", "to": "GOOD", "de": "slightly", "der": "without", "el": "doubt"}
_VALUED = _LEX | {"good": 1.9, "bad": -2.5}


def vader_like_sentiment(spark, sf):
    t = F.coalesce("text", F.lit(""))
    for word, other in _SWAPS.items():
        t = F.replace(t, F.lit(f" {word} "), F.lit(f" {other} "))
    t = F.concat(t, F.repeat(F.lit("!"), (F.col("doc_id") % 7).cast("int")), F.repeat(F.lit("?"), (F.col("doc_id") % 6).cast("int")))
    return c.table(spark, sf, "documents").select("doc_id", sentiment.compound(t, _VALUED).alias("sentiment_score"))


def _sentiment_sql() -> str:
    """The rules over rows of words, with windows over their neighbours."""
    t = "coalesce(text, '')"
    for word, other in _SWAPS.items():
        t = f"replace({t}, ' {word} ', ' {other} ')"
    negative = f"({{w}} IN ({', '.join(map(c.quote, fixed.NEGATIONS))}) OR contains({{w}}, 'n''t'))"
    marks = "".join(sentiment.PUNCTUATION)
    back = ", ".join(f"lag({x}, {k}) OVER d AS {x}{k}" for x in ("low", "known", "boost", "loud") for k in (1, 2, 3))

    def near(k: int, turn: str) -> str:
        scaled = f"(CASE WHEN v < 0 THEN -boost{k} ELSE boost{k} END + CASE WHEN loud{k} AND mixed THEN CASE WHEN v > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END)"
        return f"CASE WHEN low{k} IS NOT NULL AND known{k} IS NULL THEN (v + coalesce({scaled} * {(1.0, 0.95, 0.9)[k - 1]}, 0)) * ({turn}) ELSE v END"

    turns = [
        f"CASE WHEN {negative.format(w='low1')} THEN -0.74 ELSE 1 END",
        f"CASE WHEN low2 = 'never' AND low1 IN ('so', 'this') THEN 1.25 WHEN low2 = 'without' AND low1 = 'doubt' THEN 1 WHEN {negative.format(w='low2')} THEN -0.74 ELSE 1 END",
        f"CASE WHEN (low3 = 'never' AND low2 IN ('so', 'this')) OR low1 IN ('so', 'this') THEN 1.25 WHEN low3 = 'without' AND (low2 = 'doubt' OR low1 = 'doubt') THEN 1 WHEN {negative.format(w='low3')} THEN -0.74 ELSE 1 END",
    ]
    steps = [
        "CASE WHEN low1 = 'no' OR low2 = 'no' OR (low3 = 'no' AND low1 IN ('or', 'nor')) THEN known * -0.74 ELSE known END",
        "CASE WHEN loud AND mixed THEN v + CASE WHEN v > 0 THEN 0.733 ELSE -0.733 END ELSE v END",
        *[near(k, turn) for k, turn in enumerate(turns, 1)],
        "CASE WHEN low1 = 'least' AND known1 IS NULL AND (i = 1 OR low2 NOT IN ('at', 'very')) THEN v * -0.74 ELSE v END",
    ]
    rows = "(SELECT *, 0.0::DOUBLE AS v FROM seen)"
    for step in steps:
        rows = f"(SELECT * EXCLUDE (v), ({step})::DOUBLE AS v FROM {rows})"
    return f"""
WITH t AS (SELECT doc_id, {t} || repeat('!', (doc_id % 7)::INT) || repeat('?', (doc_id % 6)::INT) AS t FROM documents
), tok AS (SELECT doc_id, generate_subscripts(ws, 1) - 1 AS i, unnest(ws) AS tok FROM (SELECT doc_id, list_filter(string_split_regex(t, '[\\s' || chr(11) || ']+'), lambda w: w <> '') AS ws FROM t)
), word AS (SELECT doc_id, i, CASE WHEN length(trim(tok, {c.quote(marks)})) <= 2 THEN tok ELSE trim(tok, {c.quote(marks)}) END AS raw FROM tok
), known AS (SELECT word.*, lower(raw) AS low, upper(raw) = raw AND lower(raw) <> raw AS loud, x AS known, boost FROM word
  LEFT JOIN {c.sql_values(list((_VALUED | fixed.VALENCES).items()), 'lw, x')} ON lower(raw) = lw LEFT JOIN (SELECT * FROM {c.sql_values(list(fixed.BOOSTERS.items()), 'bw, boost')}) b ON lower(raw) = bw
), seen AS (SELECT doc_id, i, low, known::DOUBLE AS known, boost, loud, {back}, count(*) FILTER (loud) OVER p > 0 AND count(*) FILTER (loud) OVER p < count(*) OVER p AS mixed, min(i) FILTER (low = 'but') OVER p AS but
  FROM known WINDOW d AS (PARTITION BY doc_id ORDER BY i), p AS (PARTITION BY doc_id)
), sums AS (SELECT doc_id, sum(CASE WHEN known IS NULL OR boost IS NOT NULL THEN 0 ELSE v * CASE WHEN i < but THEN 0.5 WHEN i > but THEN 1.5 ELSE 1 END END) AS s FROM {rows} GROUP BY doc_id
), raised AS (SELECT doc_id, s, s + sign(s) * (least(length(t) - length(replace(t, '!', '')), 4) * 0.292 + CASE WHEN q <= 1 THEN 0 WHEN q <= 3 THEN q * 0.18 ELSE 0.96 END) AS x FROM (SELECT t.doc_id, t, coalesce(s, 0) AS s, length(t) - length(replace(t, '?', '')) AS q FROM t LEFT JOIN sums USING (doc_id)))
SELECT doc_id, CASE WHEN s = 0 THEN 0.0 ELSE round(greatest(-1.0, least(1.0, x / sqrt(x * x + 15))), 4) END::DOUBLE AS sentiment_score FROM raised"""


_T = "lower(concat_ws(' ', trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')), url))"
_KW = "least(" + " + ".join(f"least(len(list_filter({c.sql_tokens(_T)}, lambda w: w = '{w}')) * {wt}, {cap})" for ws, wt, cap in ((_HIGH, 0.3, 0.2), (_MEDIUM, 0.1, 0.2), (_LOWW, 0.05, 0.1)) for w in ws) + ", 0.6)"
_URL = "greatest(0, least(CASE WHEN contains(url, '/en/') THEN 0.1 ELSE 0 END + CASE WHEN contains(url, 'https://') THEN 0.1 ELSE 0 END - CASE WHEN contains(url, 'page=') THEN 0.3 ELSE 0 END, 0.2))"
_CAT = "least(0.1 * (contains(lower(regexp_extract(url, '^https?://[^/]*/([^/]+)/', 1)), 'en')::INT + contains(lower(regexp_extract(url, '^https?://[^/]*/([^/]+)/', 1)), 'fr')::INT), 0.2)"
_SCORED = f"scored AS (SELECT page_id, url, round(least({_KW} + {_URL} + {_CAT}, 1.0), 2)::DOUBLE AS score FROM pages), routed AS (SELECT *, CASE WHEN score >= 0.8 THEN 'high' WHEN score >= 0.5 THEN 'medium' ELSE 'low' END AS priority FROM scored)"

QUERIES = {
    "entity_normalize": entity_normalize, "entity_dedup_best": entity_dedup_best, "canonical_company": canonical_company, "manual_override": manual_override, "likely_company": likely_company,
    "rejected_summary": rejected_summary, "company_enrich": company_enrich, "company_validate": company_validate, "entity_cascade": entity_cascade, "mention_count": mention_count,
    "relevance_score": relevance_score, "priority_routing": priority_routing, "queue_topk": queue_topk, "status_update": status_update,
    "sentiment_overlay": sentiment_overlay, "sentiment_stats": sentiment_stats, "vader_like_sentiment": vader_like_sentiment,
}
_LIKELY = "(length({n}) BETWEEN 2 AND 50 AND NOT regexp_matches(lower({n}), '" + "|".join(fixed.NOT_COMPANY) + "') AND (regexp_matches(lower({n}), '(" + "|".join(fixed.COMPANY_SUFFIXES) + ")$| (" + "|".join(fixed.COMPANY_SUFFIXES) + ")') OR (len(string_split({n}, ' ')) = 1 AND regexp_matches({n}, '^\\p{{Lu}}') AND length({n}) <= 5) OR (len(string_split({n}, ' ')) BETWEEN 2 AND 5 AND regexp_matches({n}, '^\\p{{Lu}}'))))"
_REGISTRY = f"registry AS (SELECT name, 'TK' || s_suppkey AS ticker, 'SEC' AS source, lpad(s_suppkey::VARCHAR, 10, '0') AS cik, {_REG} AS norm FROM supplier JOIN names ON s_suppkey = id)"
ORACLES = {
    "entity_normalize": f"WITH {_NAMES} SELECT id, {_NORM} AS norm, {_REG} AS registry, nullif({c.sql_strip(c.sql_fold(c.sql_strip('name'), fixed.DISPLAY_PATTERNS))}, '') AS display, CASE WHEN regexp_matches(lower(name), '{'|'.join(fixed.ORGANIZATION_MARKS)}') THEN 'Organization' ELSE 'Company' END AS type FROM names",
    "entity_dedup_best": f"WITH {_NAMES}, n AS (SELECT *, id % 40 AS doc, {_NORM} AS norm FROM names), r AS (SELECT *, row_number() OVER (PARTITION BY doc, norm ORDER BY confidence DESC, length(name) DESC, name) AS p, max(mentions) OVER (PARTITION BY doc, norm) AS m FROM n WHERE norm <> '') SELECT doc, norm, name, confidence, m AS mentions FROM r WHERE p = 1",
    "canonical_company": f"WITH {_NAMES}, n AS (SELECT DISTINCT trim(name) AS name FROM names), k AS (SELECT name, {_NORM} AS norm FROM n) SELECT norm, name AS canonical FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY length(name) DESC, contains(name, ' ') DESC, name) AS p FROM k WHERE norm <> '') WHERE p = 1",
    "manual_override": f"WITH {_NAMES} SELECT id, CASE lower(name) WHEN 'alpha alpha inc.' THEN 'Alpha' WHEN 'beta beta corp' THEN 'Beta Group' ELSE name END AS name, CASE WHEN lower(name) IN ('alpha alpha inc.', 'beta beta corp') THEN 1.0 ELSE confidence END AS confidence FROM names",
    "likely_company": f"WITH {_NAMES}, n AS (SELECT *, split_part(name, ' ', 1) AS short FROM names) SELECT id, {_LIKELY.replace('{n}', 'name').replace('{{', '{').replace('}}', '}')} AS long, {_LIKELY.replace('{n}', 'short').replace('{{', '{').replace('}}', '}')} AS short FROM n",
    "rejected_summary": f"WITH {_NAMES}, n AS (SELECT split_part(name, ' ', 1) AS short FROM names) SELECT short AS Rejected_Entity, count(*)::BIGINT AS Occurrence_Count, 'Not in company list' AS Reason FROM n WHERE NOT {_LIKELY.replace('{n}', 'short').replace('{{', '{').replace('}}', '}')} GROUP BY short",
    "company_enrich": f"WITH {_NAMES}, {_REGISTRY}, n AS (SELECT id, CASE WHEN id % 9 = 0 THEN 'tk' || (id % 200) ELSE name END AS name FROM names), byname AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY source, name, ticker) AS p FROM registry WHERE norm <> '') WHERE p = 1) SELECT n.name AS input, coalesce(b.name, t.name) IS NOT NULL AS validated, coalesce(b.name, t.name) AS canonical_name, CASE WHEN b.name IS NOT NULL THEN b.cik ELSE t.cik END AS cik, CASE WHEN b.name IS NOT NULL THEN b.ticker ELSE t.ticker END AS ticker, CASE WHEN b.name IS NOT NULL THEN b.source ELSE t.source END AS source FROM (SELECT id, name, {_REG} AS norm FROM n) n LEFT JOIN byname b ON n.norm = b.norm LEFT JOIN registry t ON upper(n.name) = t.ticker",
    "company_validate": f"WITH {_NAMES}, {_REGISTRY}, keys AS (SELECT DISTINCT norm FROM registry UNION SELECT lower(ticker) FROM registry) SELECT id, {_REG} IN (SELECT norm FROM keys) AS valid FROM names",
    "entity_cascade": f"WITH {_NAMES}, dim AS (SELECT name AS en, (199 + row_number() OVER (ORDER BY name)) AS k FROM (SELECT DISTINCT name FROM names WHERE id % 3 = 0)), d AS (SELECT en, k, {_BRIDGE.replace('{low}', _LOW.replace('{n}', 'en'))} AS norm FROM dim), e AS (SELECT *, split_part(norm, ' ', 1) AS core FROM d), n AS (SELECT id, CASE WHEN id % 4 = 0 THEN split_part(name, ' ', 1) ELSE name END AS name FROM names), m AS (SELECT id, name, {_BRIDGE.replace('{low}', _LOW.replace('{n}', 'name'))} AS norm, string_split({_LOW.replace('{n}', 'name')}, ' ') AS words FROM n) SELECT id, coalesce((SELECT max(k) FROM e WHERE en = m.name), (SELECT max(k) FROM e WHERE e.norm = m.norm), CASE WHEN len(words) = 1 THEN (SELECT arg_min(k, length(en) * 1000000 + k) FROM e WHERE core = words[1]) ELSE (SELECT min(k) FROM e WHERE core = words[1]) END)::INT AS Entity_Key FROM m",
    "mention_count": f"SELECT doc_id, name, count(*)::BIGINT AS n FROM (SELECT doc_id, unnest({c.sql_tokens("lower(coalesce(text, ''))")}) AS name FROM documents) WHERE name IN ('attion', 'thing', 'que') GROUP BY doc_id, name",
    "relevance_score": f"WITH {_SCORED} SELECT page_id, score, priority FROM routed",
    "priority_routing": f"WITH {_SCORED} SELECT priority, count(*)::BIGINT AS n FROM routed GROUP BY priority",
    "queue_topk": f"WITH {_SCORED} SELECT page_id, score FROM routed WHERE priority <> 'low' ORDER BY score DESC, url LIMIT 50",
    "status_update": "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'scraped' ELSE 'pending' END AS status FROM pages",
    "sentiment_overlay": f"""WITH v AS (SELECT * FROM {c.sql_values(list(fixed.VALENCES.items()), 'w, x')}), o AS (SELECT list(w ORDER BY k) AS ws FROM {c.sql_values(list(enumerate(fixed.VALENCES)), 'k, w')}), d AS (
      SELECT doc_id, {c.sql_tokens("lower(concat_ws(' ', text, ws[(doc_id % len(ws) + 1)::INT], ws[(doc_id * 7 % len(ws) + 1)::INT]))")} AS t FROM documents, o), s AS (
      SELECT d.doc_id, round(coalesce(sum(x), 0)::DOUBLE, 4) AS valence FROM d LEFT JOIN (SELECT doc_id, unnest(t) AS w FROM d) u ON d.doc_id = u.doc_id LEFT JOIN v ON u.w = v.w GROUP BY d.doc_id)
      SELECT doc_id, valence, CASE WHEN valence > 0.05 THEN 'positive' WHEN valence < -0.05 THEN 'negative' ELSE 'neutral' END AS label FROM s""",
    "vader_like_sentiment": _sentiment_sql(),
    "sentiment_stats": "SELECT count(s)::BIGINT AS n, round(sum(s), 6) AS total, round(avg(s), 6) AS mean, min(s) AS least, max(s) AS most, count(*) FILTER (s > 0.05)::BIGINT AS positive, count(*) FILTER (s < -0.05)::BIGINT AS negative, count(*) FILTER (s BETWEEN -0.05 AND 0.05)::BIGINT AS neutral FROM (SELECT value / 100 - 0.25 AS s FROM events)",
}
