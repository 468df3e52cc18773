"""Substring dedup with suffix automata of reference shards.

A word goes if a window of `WINDOW` words that covers it also starts in a
document with a smaller doc_id. Every document is reference and stream at once,
so sending each shard's automaton to all documents would cost the square of the
corpus. Instead the shards are cut by content, so that a passage meets only the
automaton that can hold it:

1. Anchors: of the 5-word runs in each window the one with the least hash is
   the window's anchor. Equal windows have equal anchors, and about a fifth of
   the runs are anchors. Anchors are dealt by hash into buckets of bounded size
   to see which occur in more than one document; what an input block settles
   itself is sent once for the block, so a very common anchor stays small.
2. Segments: neighbouring windows with one shared anchor are cut out. Equal
   segments of an input block travel as one, with the list of their places.
3. Shards: the segments of an anchor come sorted by their smallest doc_id; each
   different one is streamed through the suffix automaton of the earlier ones for
   its matching statistics (the longest match that ends at each word) and then
   added, unless all of it was known. Windows whose match has WINDOW words are
   repeats. An anchor with more than `max_segments` different segments is split by
   content again: its windows are dealt by the next least 5-word run as well, then
   by the one after that, until each shard's automaton is small.
4. Verdicts go back to the segments by a join on their hash (Spark splits a hot
   one): documents after the first holder of a segment lose all its windows, the
   first holder loses those found in earlier segments.
5. Maximal runs of covered words are removed.

Edge cases: null, empty and short texts lose nothing; rows that repeat a doc_id
are judged one by one and never against each other; rows without doc_id are no
reference and lose nothing; an empty table gives no rows; a very long word is a
word as any other; extra columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import Words, arrow_schema, gram_hashes, keep, mix, prepare, scan, texts, word_hashes

WINDOW, GRAM = 13, 5
PLACES = WINDOW - GRAM + 1  # of an anchor in a window, and most windows in a segment
BUCKET_BYTES = 32_000_000
MAX_SEGMENTS = 2_000  # different ones in one automaton, of at most 2 * 21 states each


class SuffixAutomaton:
    """All substrings of the sequences added so far."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.size = [-1], [0]

    def _node(self, size: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, p: int, c, q: int) -> int:
        """The state for p's longest string followed by c, apart from q."""
        clone = self._node(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, items: list) -> None:
        last = 0
        for c in items:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.size[q] == self.size[last] + 1 else self._split(last, c, q)
                continue
            new, p = self._node(self.size[last] + 1, {}, 0), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, c, q)
            last = new

    def matches(self, items: list) -> list[int]:
        """Length of the longest known substring that ends at each item."""
        state = length = 0
        out = []
        for c in items:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            to = self.next[state].get(c)
            if to is None:
                length = 0
            else:
                state, length = to, length + 1
            out.append(length)
        return out


def anchors(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window: place and hash of its anchor, given the hashes of 5-word runs."""
    if len(grams) < PLACES:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    near = np.lib.stride_tricks.sliding_window_view(grams, PLACES)
    at = near.argmin(axis=1) + np.arange(len(near))
    return at, grams[at]


def _anchored(words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First word, and place and hash of each window's anchor, by text."""
    hashes = words.hashes()
    for a, b in zip(words.bounds.tolist(), words.bounds[1:].tolist(), strict=False):
        yield a, *anchors(gram_hashes(hashes[a:b], GRAM))


def _blocks(buckets: int):
    """Anchors of a block of documents, dealt to buckets; known: to be shared."""

    def work(c: dict[str, list]) -> dict[str, list] | None:
        found = []
        for _, at, keys in _anchored(Words(c["text"])):
            new = np.flatnonzero(np.diff(at, prepend=-1))
            found.append(np.unique(keys[new]))
        keys = np.concatenate(found)
        if not len(keys):
            return None
        owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
        ids, hashes = np.array(c["doc_id"], np.int64), np.array(c["th"], np.int64)
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        first = np.concatenate(([True], keys[1:] != keys[:-1]))
        run = np.cumsum(first) - 1
        many = np.bincount(run)[run] > 1
        out: dict[str, list] = {n: [] for n in ("bucket", "doc_id", "th", "anchors", "docs", "known")}

        def put(bucket, doc, th, a, docs, known):
            for n, v in zip(out, (bucket, doc, th, a, docs, known), strict=True):
                out[n].append(v)

        held = np.flatnonzero(many)
        held = held[np.argsort(owner[held], kind="stable")]
        for part in np.split(held, np.flatnonzero(np.diff(owner[held])) + 1):
            if len(part):
                k = owner[part[0]]
                put(int(k) % buckets, ids[k], hashes[k], keys[part].tobytes(), None, None)
        sent = np.flatnonzero(first)
        bucket = (keys[sent] % np.uint64(buckets)).astype(np.int64)
        by = np.lexsort((owner[sent], bucket))  # runs of one document compress well
        for part in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
            at = sent[part]
            put(int(bucket[part[0]]), None, None, keys[at].tobytes(), np.stack((ids[owner[at]], hashes[owner[at]])).T.tobytes(), many[at].tobytes())
        return out

    return lambda: work


SHARED = "doc_id long, th long, anchors binary"
_SHARED = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("anchors", pa.binary())])


def _settle(table: pa.Table) -> pa.Table:
    """One bucket: anchors that several blocks sent, for the documents that don't know yet."""
    direct = table.filter(pa.compute.is_valid(table["doc_id"])).select(["doc_id", "th", "anchors"])
    sent = table.filter(pa.compute.is_null(table["doc_id"]))
    if not sent.num_rows:
        return direct.cast(_SHARED)
    keys = np.concatenate([np.frombuffer(b, np.uint64) for b in sent["anchors"].to_pylist()])
    docs = np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 2) for b in sent["docs"].to_pylist()])
    known = np.concatenate([np.frombuffer(b, np.bool_) for b in sent["known"].to_pylist()])
    _, run, size = np.unique(keys, return_inverse=True, return_counts=True)
    news = np.flatnonzero((size[run] > 1) & ~known)
    if not len(news):
        return direct.cast(_SHARED)
    news = news[np.lexsort((docs[news, 1], docs[news, 0]))]
    who = docs[news]
    starts = np.concatenate(([0], np.flatnonzero((np.diff(who, axis=0) != 0).any(axis=1)) + 1))
    blobs = [p.tobytes() for p in np.split(keys[news], starts[1:])]
    told = pa.table([pa.array(who[starts, 0]), pa.array(who[starts, 1]), pa.array(blobs, pa.binary())], schema=_SHARED)
    return pa.concat_tables([direct.cast(_SHARED), told])


#: least: smallest doc_id of the members; members: doc_id, th and start of each as 64-bit numbers
SEGMENT = "key long, sh long, words binary, windows int, least long, many boolean, members binary"


def _cutter():
    """Segments around shared anchors, equal ones of a block as one row."""

    def work(c: dict[str, list]) -> dict[str, list] | None:
        words = Words(c["text"])
        starts, ends, keys_, docs = [], [], [], []
        for k, (first, at, keys) in enumerate(_anchored(words)):
            edges = np.flatnonzero(np.diff(at)) + 1
            lo, hi = np.concatenate(([0], edges)), np.concatenate((edges, [len(at)]))
            mine = np.sort(np.concatenate([np.frombuffer(b, np.uint64) for b in c["blobs"][k]]))
            place = np.searchsorted(mine, keys[lo])
            shared = mine[np.minimum(place, len(mine) - 1)] == keys[lo]
            starts.append(lo[shared] + first)
            ends.append(hi[shared] + first + (WINDOW - 1))
            keys_.append(keys[lo[shared]])
            docs.append(np.full(int(shared.sum()), k))
        start, end, key, doc = (np.concatenate(x) for x in (starts, ends, keys_, docs))
        if not len(start):
            return None
        runs = words.runs(start, end)
        ids, hashes, firsts = np.array(c["doc_id"], np.int64), np.array(c["th"], np.int64), words.bounds[doc]
        members = np.stack((ids[doc], hashes[doc], start - firsts), axis=1)
        blob, groups = members.tobytes(), {}
        for i, run in enumerate(runs):
            groups.setdefault(run, []).append(i)  # equal words, equal anchor
        heads = [g[0] for g in groups.values()]
        return {
            "key": pa.array(key[heads].view(np.int64)), "sh": [xxhash.xxh3_64_intdigest(r) - (1 << 63) for r in groups], "words": list(groups), "windows": (end - start)[heads] - (WINDOW - 1),
            "least": np.minimum.reduceat(members[[i for g in groups.values() for i in g], 0], np.cumsum([0, *map(len, groups.values())])[:-1]), "many": [len(g) > 1 for g in groups.values()],
            "members": [blob[24 * g[0] : 24 * g[0] + 24] if len(g) == 1 else members[g].tobytes() for g in groups.values()],
        }

    return work


#: of segment (key, sh): its first holder, its repeated windows, whether several rows or members have it
VERDICT = "key long, sh long, least long, mask int, many boolean"


def _streamer():
    """Segments sorted by shard, smallest doc_id first; the state of one shard at a time.

    `parent` is the segment asked about and `place` the window of it at which this
    part begins (0 and itself for whole segments).
    """

    schema = arrow_schema(VERDICT)[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = last = None
        machine: SuffixAutomaton | None = None
        seen: dict[bytes, list] = {}
        waiting: list[list[bytes]] = []

        def told() -> list[tuple]:
            return [tuple(v) for v in seen.values() if v[3] or v[4]]

        rows: list[tuple] = []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("shard", "least", "words", "key", "sh", "place", "many")]
            for at, least, text, key, sh, place, many in zip(*columns, strict=True):
                if at != shard:
                    rows.extend(told())
                    shard, last, machine, seen, waiting = at, least, None, {}, []
                same = (key, sh, text)
                if same in seen:
                    seen[same][4] = True
                    continue
                if least != last:
                    if waiting and machine is None:
                        machine = SuffixAutomaton()
                    for earlier in waiting:
                        machine.add(earlier)
                    last, waiting = least, []
                items, mask = text.split(b" "), 0
                if machine is not None:
                    for k, length in enumerate(machine.matches(items)[WINDOW - 1 :]):
                        mask |= (length >= WINDOW) << k
                if mask + 1 < 1 << len(items) - WINDOW + 1:
                    waiting.append(items)
                seen[same] = [key, sh, least, mask << place, many]
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows = []
        rows.extend(told())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _streamed(parts: DataFrame) -> DataFrame:
    """VERDICT rows of parts (shard, words, least, key, sh, place, many)."""
    prepare(parts.sparkSession)
    parts = parts.select("shard", "words", "least", "key", "sh", "place", "many")
    return parts.repartition("shard").sortWithinPartitions("shard", "least").mapInArrow(_streamer(), arrow_schema(VERDICT)[0])


PART = "shard long, words binary, least long, key long, sh long, place int, windows int"


def _splitter(level: int):
    """Parts of segments whose windows share the `level` least runs of five words."""

    def work(c: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in ("shard", "words", "least", "key", "sh", "place", "windows")}
        for k, text in enumerate(c["words"]):
            items = text.split(b" ")
            grams = np.lib.stride_tricks.sliding_window_view(gram_hashes(word_hashes(items), GRAM), PLACES)
            least = np.sort(grams, axis=1)[:, : level + 1]
            shard = least[:, 0].copy()
            for i in range(1, level + 1):
                shard = mix(shard + least[:, i])
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                row = (int(shard[a].view(np.int64)), b" ".join(items[a : b + WINDOW - 1]), c["least"][k], c["key"][k], c["sh"][k], c["place"][k] + a, b - a)
                for n, v in zip(out, row, strict=True):
                    out[n].append(v)
        return out

    return lambda: work


def _crowded(parts: DataFrame, most: int) -> DataFrame:
    """Shards of more than `most` different parts."""
    different = parts.select("shard", F.xxhash64("words").alias("h")).distinct()
    return keep(different.groupBy("shard").count().where(F.col("count") > most).select("shard"), "crowded")


def _split_verdicts(parts: DataFrame) -> DataFrame:
    """VERDICT rows for the segments (key, sh, least) that parts came from.

    Equal parts of a shard are streamed once, with their smallest doc_id; what is
    found goes back to the segments by a join that Spark can split.
    """
    parts = parts.withColumn("h", F.xxhash64("words"))
    different = parts.groupBy("shard", "h", "words").agg(F.min("least").alias("least"), (F.count("*") > 1).alias("many"))
    found = _streamed(different.select("shard", "words", "least", F.col("shard").alias("key"), F.col("h").alias("sh"), F.lit(0).alias("place"), "many"))
    found = keep(found, "part_verdicts").select(F.col("key").alias("shard"), F.col("sh").alias("h"), F.col("least").alias("holder"), "mask")
    told = parts.select("shard", "h", "least", "key", "sh", "place", "windows").join(found, ["shard", "h"])
    mine = F.when(F.col("least") > F.col("holder"), F.expr("shiftleft(1, windows) - 1")).otherwise(F.col("mask"))
    return told.select("key", "sh", "least", mine.alias("mask"), "place").where("mask != 0").select("key", "sh", "least", F.expr("shiftleft(mask, place)").alias("mask"), F.lit(False).alias("many"))


def _verdicts(segments: DataFrame, max_segments: int) -> DataFrame:
    parts = segments.select(F.col("key").alias("shard"), "words", "least", "key", "sh", F.lit(0).alias("place"), "windows", "many")
    crowded = _crowded(parts, max_segments)
    out = [keep(_streamed(parts.join(crowded, "shard", "left_anti")), "verdicts")]
    if crowded.isEmpty():
        return out[0]
    # one row for each different segment; its first holder is known from now on
    hot = parts.join(crowded, "shard", "left_semi").groupBy("key", "sh", "words").agg(F.min("least").alias("least"), (F.max("many") | (F.count("*") > 1)).alias("many"), F.lit(0).alias("place"))
    hot = keep(hot, "crowded_segments")
    out.append(hot.where("many").select("key", "sh", "least", F.lit(0).alias("mask"), "many"))
    for level in range(1, PLACES):
        parts = keep(scan(hot.select("words", "least", "key", "sh", "place"), _splitter(level), PART), "parts")
        crowded = _crowded(parts, max_segments if level < PLACES - 1 else 1 << 62)
        out.append(keep(_split_verdicts(parts.join(crowded, "shard", "left_anti")), "verdicts"))
        if crowded.isEmpty():
            break
        hot = keep(parts.join(crowded, "shard", "left_semi"), "crowded_parts", [parts])
    every = reduce(DataFrame.unionByName, out).groupBy("key", "sh").agg(F.min("least").alias("least"), F.bit_or("mask").alias("mask"), F.max("many").alias("many"))
    return keep(every, "all_verdicts", out[:1] + out[2:])


HIT = "doc_id long, th long, start int, mask int"


def _deliver():
    """Verdicts of segments to the documents that hold them."""

    def work(c: dict[str, list]) -> dict[str, list]:
        times = np.array([len(m) // 24 for m in c["members"]])
        rows = np.frombuffer(b"".join(c["members"]), np.int64).reshape(-1, 3)
        windows, first, mask = (np.repeat(np.array(c[n], np.int64), times) for n in ("windows", "holder", "mask"))
        mask = np.where(rows[:, 0] > first, (1 << windows) - 1, mask)
        rows, mask = rows[mask != 0], mask[mask != 0]
        return {"doc_id": pa.array(rows[:, 0]), "th": pa.array(rows[:, 1]), "start": pa.array(rows[:, 2].astype(np.int32)), "mask": pa.array(mask.astype(np.int32))}

    return work


REPORT = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string, spans array<struct<first:int,last:int>>"


def _remover():
    def work(c: dict[str, list]) -> dict[str, list]:
        words = Words(c["text"])
        first, last, owner, out_spans = [], [], [], []
        for k, hits in enumerate(c["hits"]):
            a, b = int(words.bounds[k]), int(words.bounds[k + 1])
            turns = []
            if hits:
                edge = np.zeros(b - a + 1, np.int32)
                start, mask = (np.array([h[n] for h in hits], np.int64) for n in ("start", "mask"))
                for i in range(PLACES):
                    at = start[mask >> i & 1 == 1] + i
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + WINDOW, -1)
                gone = np.cumsum(edge)[:-1] > 0
                turns = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).tolist()
            out_spans.append([{"first": x, "last": y - 1} for x, y in zip(turns[::2], turns[1::2], strict=True)])
            bounds = [a, *(a + t for t in turns), b]
            for x, y in zip(bounds[::2], bounds[1::2], strict=True):
                if y > x:
                    first.append(x)
                    last.append(y)
                    owner.append(k)
        parts: list[list[bytes]] = [[] for _ in c["text"]]
        for k, run in zip(owner, words.runs(np.array(first, np.int64), np.array(last, np.int64)), strict=True):
            parts[k].append(run)
        rest = [b" ".join(p) for p in parts]
        return {
            "doc_id": c["doc_id"],
            "n_words": np.diff(words.bounds),
            "n_removed": [sum(s["last"] - s["first"] + 1 for s in x) for x in out_spans],
            "kept_text": [r.decode("utf-8", "replace") for r in rest],
            "kept_sha256": [hashlib.sha256(r).hexdigest() for r in rest],
            "spans": out_spans,
        }

    return work


def repeats(docs: DataFrame, max_segments: int = MAX_SEGMENTS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, th (hash of the text), hits: repeated windows as (start, mask) lists."""
    rows = texts(docs).where("doc_id is not null and text is not null").withColumn("th", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-size // bucket_bytes))

    dealt = scan(rows, _blocks(buckets), "bucket int, doc_id long, th long, anchors binary, docs binary, known binary", rows=4096, size=4_000_000)
    shared = keep(dealt.groupBy("bucket").applyInArrow(_settle, SHARED), "anchors")
    mine = shared.groupBy("doc_id", "th").agg(F.collect_list("anchors").alias("blobs"))
    segments = scan(rows.join(mine, ["doc_id", "th"]).select("doc_id", "th", "text", "blobs"), _cutter, SEGMENT, rows=4096, size=4_000_000)
    segments = keep(segments, "segments", [shared])
    verdicts = _verdicts(segments, max_segments).select("key", "sh", F.col("least").alias("holder"), "mask")
    mine = segments.select("key", "sh", "windows", "members").join(verdicts, ["key", "sh"])
    hits = scan(mine.select("windows", "members", "holder", "mask"), _deliver, HIT, rows=4096)
    return hits.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "mask")).alias("hits"))


def dedup_substrings(docs: DataFrame, **params) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, kept_sha256, spans (removed words, first and last) per row."""
    hits = repeats(docs, **params)
    rows = texts(docs).withColumn("th", F.xxhash64("text"))
    return scan(rows.join(hits, ["doc_id", "th"], "left").select("doc_id", "text", "hits"), _remover, REPORT)


def op6(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t FROM d, unnest(range(1, len(w) - 12 + 1)) AS r(i) WHERE len(w) >= 13
), firsts AS (
  SELECT t, min(doc_id) AS f FROM win GROUP BY t
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN firsts USING (t) WHERE f < doc_id
), words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS x FROM d
), kept AS (
  SELECT words.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY words.p) AS t FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p WHERE gone.p IS NULL GROUP BY words.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
