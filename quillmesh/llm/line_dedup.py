"""Line dedup: lines that many documents hold stay in one of them only.

Lines are normalised (white space stripped at both ends, A-Z lower-cased) and
hashed to 128 bits; what repeats within a document is settled there. The hashes
are written once. A hash held by `min_docs` documents or more is dropped
everywhere but in the largest doc_id that holds it. Holders are counted in two
aggregations (per document and hash, then per hash), so one very common line
spreads over all tasks. The common hashes are a written table: Spark broadcasts
it while it is small and else joins by sorting, splitting what is skewed.

Edge cases: a null or empty text is one empty line; keys shorter than
`min_chars` are never dropped; repeated rows of one doc_id count as one
document and each returns its own row; rows without doc_id hold no document,
lose nothing and are returned; an empty table gives no rows; extra columns are
kept by `dedup_lines`, whatever their names, and don't matter to `line_decisions`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import SPACES, ascii_lower, columns_of, keep, whole_rows


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(SPACES)))


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(77), key).alias("b"))


def dropped_keys(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, keys: the line hashes that each document loses."""
    hashes = F.transform(F.filter(F.transform(_lines(F.col("text")), _key), lambda k: F.length(k) >= min_chars), _hash)
    held = docs.where("doc_id is not null and text is not null").select("doc_id", F.array_distinct(hashes).alias("hs"))
    held = keep(held.where(F.size("hs") > 0), "line_hashes").select("doc_id", F.inline("hs").alias("a", "b"))
    common = held.groupBy("a", "b").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs).drop("n")
    lost = held.join(keep(common, "common_lines"), ["a", "b"]).where("doc_id != keeper")
    return lost.groupBy("doc_id").agg(F.collect_set(F.struct("a", "b")).alias("keys"))


def _kept_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """row (the whole row of docs), lines, and kept: the lines that stay."""
    keys = dropped_keys(docs.select("doc_id", "text"), min_chars, min_docs)
    rows = whole_rows(docs)

    def stays(line: Column) -> Column:
        key = _key(line)
        return (F.length(key) < min_chars) | ~F.array_contains(F.col("keys"), _hash(key))

    rows = rows.join(keys, F.col("row.doc_id") == keys["doc_id"], "left").select("row", _lines(F.col("row.text")).alias("lines"), "keys")
    return rows.select("row", "lines", F.when(F.col("keys").isNull(), F.col("lines")).otherwise(F.filter("lines", stays)).alias("kept"))


def line_decisions(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text per row."""
    out = _kept_lines(docs.select("doc_id", "text"), min_chars, min_docs)
    n_lines = F.size("lines").cast("long")
    return out.select("row.doc_id", n_lines.alias("n_lines"), (n_lines - F.size("kept")).alias("n_dropped"), F.concat_ws("\n", "kept").alias("kept_text"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """docs with the text that stays; n_chars follows it. Columns as they came."""
    changed = {"text": F.when(F.col("row.text").isNotNull(), F.concat_ws("\n", "kept"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(changed["text"]).cast(docs.schema["n_chars"].dataType)
    return _kept_lines(docs, min_chars, min_docs).select(*columns_of("row", docs, **changed))


def op10(spark, sf_dir: str) -> DataFrame:
    out = line_decisions(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH line AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line
), common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.*, common.keeper IS NOT NULL AND keyed.doc_id <> common.keeper AS gone
  FROM keyed LEFT JOIN common ON keyed.k = common.k
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
