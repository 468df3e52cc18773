"""Quality rules: fixed rules of a text, then line frequency across documents.

Base rules look at one text: too few words, or too many words inside 8-word
windows that recur in the same text. The method then counts, for each host
(`source`), how many different documents hold each normalised line, takes away
lines above `max_docs_per_host`, and rejects documents that are left with fewer
than `min_words` words or less than `min_share` of their words. `removed_lines`
tells the places of the lines taken away; `remaining` makes the text that is
left, and `keep_quality` puts it in place of the text of the documents it keeps.

Copies of one document must not make its lines look like boilerplate (dedup
comes later), so the holders of a line are told apart by a hash of their whole
set of normalised lines: copies share it, pages with any line of their own don't.

Lines are hashed to 64 bits in the scan; (host, line, document class) triples
are made distinct before they are counted, so a hot host or a very common line
spreads over all tasks.

Edge cases: null or empty text has no words and fails the base rules; a null
host is a host of its own; repeated rows are judged one by one and count as one
document; null doc_ids are returned; an empty table gives no rows; extra
columns don't matter and `keep_quality` keeps them (its n_chars follows the text
where lines went).
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import FOLD_ASCII, SPACES, Words, columns_of, gram_hashes, keep, scan, texts, whole_rows

SYMBOLS = b"#*$%&|<>"
_WS = SPACES.encode()

METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, copy long, lines array<struct<h:long,n:int,at:array<int>>>"


def repeat_words(hashes: np.ndarray, width: int) -> int:
    """Words covered by windows of `width` words that occur twice or more."""
    grams = gram_hashes(hashes, width)
    if len(grams) < 2:
        return 0
    order = np.sort(grams)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(grams, twice))
    edge = np.zeros(len(hashes) + 1, np.int32)
    edge[starts] += 1
    edge[starts + width] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _lines(text: bytes) -> tuple[int, int, list[dict]]:
    """Repeated lines, a hash of the set of normalised lines, and these with their words and places."""
    dup, seen, found = 0, set(), {}
    for at, line in enumerate(text.split(b"\n")):
        key = line.strip(_WS)
        if key:
            if line in seen:
                dup += 1
            else:
                seen.add(line)
            h = xxhash.xxh3_64_intdigest(key.translate(FOLD_ASCII)) - (1 << 63)
            if h in found:
                found[h][0] += len(key.split())
                found[h][1].append(at)
            else:
                found[h] = [len(key.split()), [at]]
    copy = xxhash.xxh3_64_intdigest(np.array(sorted(found), np.int64).tobytes()) - (1 << 63)
    return dup, copy, [{"h": h, "n": n, "at": at} for h, (n, at) in found.items()]


def _measurer(width: int = 8):
    def work(c: dict[str, list]) -> dict[str, list]:
        texts = [t or b"" for t in c["text"]]
        words = Words(texts)
        hashes, ends = words.hashes(), words.bounds.tolist()
        bare = [t.translate(None, _WS) for t in texts]
        lines = [_lines(t) for t in texts]
        return {
            "n_words": [b - a for a, b in zip(ends, ends[1:], strict=False)],
            "word_chars": [len(t.decode("utf-8", "replace")) for t in bare],
            "n_symbols": [len(t) - len(t.translate(None, SYMBOLS)) for t in bare],
            "n_repeat_words": [repeat_words(hashes[a:b], width) for a, b in zip(ends, ends[1:], strict=False)],
            "n_dup_lines": [x[0] for x in lines], "copy": [x[1] for x in lines], "lines": [x[2] for x in lines],
        }

    return work


def _judged(docs: DataFrame, carry: list[Column], max_docs_per_host: int = 100, min_words: int = 20, min_share: float = 0.2, max_repeat_percent: int = 30) -> DataFrame:
    """The carried columns, the metrics and the verdict per row of docs."""
    host = F.col("row.source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = whole_rows(docs).select(*carry, host.alias("host"), F.col("row.text").cast("binary").alias("text"))
    kept = tuple(c for c in rows.columns if c != "text")
    rows = keep(scan(rows, _measurer, METRICS, carry=kept).withColumn("at", F.monotonically_increasing_id()), "quality")
    held = rows.select("at", F.coalesce("host", F.lit("")).alias("host"), "copy", F.inline("lines").alias("h", "n", "places"))
    common = keep(held.groupBy("host", "h").agg(F.count_distinct("copy").alias("docs")).where(F.col("docs") > max_docs_per_host).drop("docs"), "common_lines")
    lost = held.join(common, ["host", "h"]).groupBy("at").agg(F.sum("n").alias("n_common_words"), F.sort_array(F.flatten(F.collect_list("places"))).alias("removed_lines"))
    lost = keep(lost, "lines_to_remove", [common])
    left = F.col("n_words") - F.col("n_common_words")
    return (
        rows.drop("lines", "copy", "host")
        .join(lost, "at", "left")
        .withColumn("n_common_words", F.coalesce("n_common_words", F.lit(0)).cast("long"))
        .withColumn("removed_lines", F.coalesce("removed_lines", F.expr("cast(array() as array<int>)")))
        .withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & ((F.col("n_common_words") == 0) | ((left >= min_words) & (left >= min_share * F.col("n_words")))))
        .drop("at")
    )


def quality(docs: DataFrame, **params) -> DataFrame:
    """Per row: doc_id, the metrics, n_common_words (in lines above the limit), removed_lines (their places from 0), base_failed, kept.

    Parameters and their defaults: max_docs_per_host 100, min_words 20, min_share 0.2, max_repeat_percent 30.
    """
    return _judged(docs, [F.col("row.doc_id").cast("long").alias("doc_id")], **params)


def remaining(text: Column, removed_lines: Column) -> Column:
    """The text without its removed lines, given quality()'s column for the same row."""
    kept = F.filter(F.split(text, "\n", -1), lambda line, at: ~F.array_contains(removed_lines, at))
    return F.when(F.size(removed_lines) > 0, F.array_join(kept, "\n")).otherwise(text)


def keep_quality(docs: DataFrame, **params) -> DataFrame:
    """docs without the rejected rows and without the lines above the limit; the verdict travels beside the row."""
    rows = _judged(docs, [F.col("row")], **params).where("kept")
    text = F.col("row.text")
    changed = {"text": remaining(text, F.col("removed_lines"))}
    if "n_chars" in docs.columns:
        now = F.length(changed["text"]).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.size("removed_lines") > 0, now).otherwise(F.col("row.n_chars"))
    return rows.select(*columns_of("row", docs, **changed))


def op8(spark, sf_dir: str) -> DataFrame:
    out = quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM w, unnest(range(1, len(w) - 7 + 1)) AS r(i) WHERE len(w) >= 8
), twice AS (
  SELECT doc_id, g FROM win GROUP BY ALL HAVING count(*) > 1
), reps AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win JOIN twice USING (doc_id, g)) GROUP BY doc_id
), lines AS (
  SELECT doc_id, host, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS line FROM d)
), full_lines AS (
  SELECT * FROM lines WHERE n > 0
), copies AS (
  SELECT doc_id, list_sort(list(DISTINCT k)) AS copy FROM full_lines GROUP BY doc_id
), common AS (
  SELECT host, k FROM full_lines JOIN copies USING (doc_id) GROUP BY ALL HAVING count(DISTINCT copy) > 100
), lost AS (
  SELECT doc_id, sum(n) AS n FROM full_lines JOIN common USING (host, k) GROUP BY doc_id
), dup AS (
  SELECT doc_id, sum(c - 1) AS n FROM (SELECT doc_id, line, count(*) AS c FROM full_lines GROUP BY ALL) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(reps.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0) AS gone
  FROM w LEFT JOIN reps ON w.doc_id = reps.doc_id LEFT JOIN lost ON w.doc_id = lost.doc_id LEFT JOIN dup ON w.doc_id = dup.doc_id
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (gone = 0 OR (n_words - gone >= 20 AND n_words - gone >= 0.2 * n_words)) AS kept
FROM b
"""
