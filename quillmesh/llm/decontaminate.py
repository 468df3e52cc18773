"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts are normalised (A-Z lower-cased, words are runs of digits,
letters and everything above ASCII), cut into windows of `width` words and
compiled into one automaton. Each document is normalised the same way, scanned
once, and hits are mapped back to words and to code-point offsets of the
original text.

The benchmark is collected only in shards whose windows have at most
`SHARD_CHARS` characters. With several shards each pass over the texts returns
its hits only; they are gathered by document and reported in a last pass.

Edge cases: null or empty texts have no words; a benchmark text of fewer than
`width` words is one window; without words it is none; a benchmark row without
item_id marks words but is not counted as an item; repeated items count once;
repeated or null doc_ids give a row each; empty tables give no rows or no hits;
extra columns don't matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import filter_scan, keep, scan, state, texts

#: most characters of window text in one automaton (about 25 bytes of it a character)
SHARD_CHARS = 4_000_000
_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


def windows(words: list[bytes], width: int) -> list[bytes]:
    if not words:
        return []
    return [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]


def build(items: list[tuple[str | None, bytes | None]], width: int) -> ahocorasick.Automaton:
    """Windows to (number of words, item ids); bytes stand as Latin-1 characters."""
    at: dict[bytes, set] = {}
    for item, text in items:
        for w in windows(normal_words(text), width):
            at.setdefault(w, set()).add(item)
    automaton = ahocorasick.Automaton()
    for w, ids in at.items():
        automaton.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, tuple(i for i in ids if i is not None)))
    if at:
        automaton.make_automaton()
    return automaton


def find(automaton: ahocorasick.Automaton, text: bytes | None) -> tuple[int, np.ndarray, set]:
    """Number of words, ids of the hit words, items found."""
    words, items = normal_words(text), set()
    if not words or not len(automaton):
        return len(words), np.empty(0, np.int64), items
    line = f" {b' '.join(words).decode('latin-1')} "
    edge = starts = None
    for end, (n, ids) in automaton.iter(line):
        if edge is None:
            edge = np.zeros(len(words) + 1, np.int64)
            starts = np.cumsum([1] + [len(w) + 1 for w in words])  # of each word in line
        last = int(np.searchsorted(starts, end, "left"))  # words that begin before the closing space
        edge[last - n] += 1
        edge[last] -= 1
        items.update(ids)
    return len(words), np.empty(0, np.int64) if edge is None else np.flatnonzero(np.cumsum(edge)[:-1] > 0), items


def spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code-point offsets of the original text, end exclusive."""
    if not len(hit):
        return []
    at = [m.span() for m in _WORD.finditer(text.decode("utf-8", "replace"))]
    cut = np.flatnonzero(np.diff(hit) > 1) + 1
    return [{"start": at[run[0]][0], "end": at[run[-1]][1]} for run in np.split(hit, cut)]


FOUND = "doc_id long, th long, hit array<int>, items array<string>"
REPORT = "doc_id long, n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, spans array<struct<start:int,end:int>>"


def _automaton(items: list, width: int):
    """Makes the automaton of some benchmark rows once in each worker."""
    name = hashlib.sha256(repr((width, items)).encode()).hexdigest()
    return lambda: state(("decontaminate", name), lambda: build(items, width))


def _report(doc, text: bytes | None, n: int, hit: np.ndarray, items: set) -> tuple:
    ids = sorted(items)
    return doc, n, len(hit), len(ids), ids, hashlib.sha256(",".join(ids).encode()).hexdigest(), spans(text, hit) if len(hit) else []


def _columns(rows: list[tuple], ddl: str) -> dict[str, list]:
    names = [f.split()[0] for f in ddl.split(", ")]
    return dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {n: [] for n in names}


def _reporter(items: list, width: int):
    automaton = _automaton(items, width)

    def make():
        machine = automaton()
        return lambda c: _columns([_report(d, t, *find(machine, t)) for d, t in zip(c["doc_id"], c["text"], strict=True)], REPORT)

    return make


def _finder(items: list, width: int):
    """One pass of several: the hits of one shard."""
    automaton = _automaton(items, width)

    def make():
        machine = automaton()

        def work(c: dict[str, list]) -> dict[str, list]:
            got = [(d, th, *find(machine, t)[1:]) for d, th, t in zip(c["doc_id"], c["th"], c["text"], strict=True)]
            return _columns([(d, th, hit.tolist(), sorted(ids)) for d, th, hit, ids in got if len(hit)], FOUND)

        return work

    return make


def _gatherer():
    """The report of hits that several passes found."""

    def work(c: dict[str, list]) -> dict[str, list]:
        rows = []
        for d, t, hits, items in zip(c["doc_id"], c["text"], c["hits"], c["items"], strict=True):
            hit = np.unique(np.array([h for part in hits or () for h in part], np.int64))
            rows.append(_report(d, t, len(normal_words(t)), hit, {i for part in items or () for i in part}))
        return _columns(rows, REPORT)

    return work


def _shards(benchmark: DataFrame, width: int, shard_chars: int) -> Iterator[list]:
    """The benchmark's rows in shards; only a shard's bounded text is collected at once."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-chars * width // shard_chars))
    if n > 1:
        rows = keep(rows.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(n))).repartition("shard").sortWithinPartitions("shard"), "benchmark")
    for k in range(n):
        part = rows.where(F.col("shard") == k) if n > 1 else rows
        yield [(r["item"], bytes(r["text"] or b"")) for r in part.select("item", "text").collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, items_sha256, spans per row of docs."""
    rows, shards = texts(docs), _shards(benchmark, width, shard_chars)
    first, second = next(shards), next(shards, None)
    if second is None:
        return scan(rows, _reporter(first, width), REPORT)
    rows = rows.withColumn("th", F.xxhash64("text"))
    # a shard's hits are written before the next shard is collected
    found = reduce(DataFrame.union, [keep(scan(rows, _finder(items, width), FOUND), "hits") for items in chain([first, second], shards)])
    found = found.groupBy("doc_id", "th").agg(F.collect_list("hit").alias("hits"), F.collect_list("items").alias("items")).select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "hits", "items")
    same = rows["doc_id"].eqNullSafe(found["d"]) & (rows["th"] == found["t"])
    return scan(rows.join(found, same, "left").select("doc_id", "text", "hits", "items"), _gatherer, REPORT)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """docs without contaminated rows; columns as they came. Rows are judged in place, no text is shuffled."""
    for items in _shards(benchmark, width, shard_chars):
        automaton = _automaton(items, width)

        def make(automaton=automaton):
            machine = automaton()
            return lambda texts: [not len(find(machine, t)[1]) for t in texts]

        docs = filter_scan(docs, make)
    return docs


def op1(spark, sf_dir: str) -> DataFrame:
    out = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS r(i) WHERE len(w) > 0
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), dw AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM d, (SELECT DISTINCT k FROM bw), unnest(range(1, len(w) - k + 2)) AS r(i) WHERE len(w) >= k
), hits AS (
  SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k
), marked AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked ON d.doc_id = marked.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""
