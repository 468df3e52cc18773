"""MinHash near-dedup with odd sketches.

A document's set is its distinct runs of five words. 128 MinHash samples give 32
band keys of four samples each (a pair of similarity 0.75 shares no key once in
200,000 times) and an odd sketch: each sample toggles one of 512 bits, and the
number of bits in which two sketches differ estimates high similarities
closely. Pairs that share a key and whose sketches agree well enough (five
standard deviations below the threshold) are confirmed on the full sets.

No group of copies is expanded into pairs:
1. documents with equal sets are one class, represented by the smallest doc_id;
2. in each bucket every class is compared with the smallest one only, and the
   confirmed links give first components. A smallest class with many partners is
   copied once for about every `SALT` of them, so that no task gets them all;
3. where the other classes of a bucket still lie in several components, those
   outside its main component are compared with those of other components, which
   covers every pair that could still join two components, so no link is lost.
   Buckets are cut into blocks of at most about `BLOCK` members and `BLOCK`
   outsiders, each block is compared in place and returns confirmed links only.
Each step is an aggregation or an equi-join on bucket keys or doc_ids that
Spark can split; components come from components.py.

Edge cases: texts without words have an empty set and are linked with nothing;
fewer than five words are one shingle; rows are judged one by one, and rows that
repeat a doc_id share its component when their sets are equal; rows without
doc_id are linked with nothing, have a null component and are kept; an empty
table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import Words, columns_of, gram_hashes, group_scan, keep, mix, scan, texts, whole_rows
from quillmesh.llm.components import components

WIDTH, SAMPLES, BANDS, SKETCH_BITS = 5, 128, 32, 512
PERCENT = 75
SALT, BLOCK = 256, 512
_ODD = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
_STEP = mix(np.arange(1001, 1001 + SAMPLES, dtype=np.uint64))
_BAND = mix(np.arange(5001, 5001 + BANDS, dtype=np.uint64))

SIGNATURE = "doc_id long, n_shingles long, fa long, fb long, bands array<long>, sketch array<long>"


def shingles(texts: list[bytes | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of `width` words, or of all its words if fewer."""
    words = Words(texts, fold=True)
    hashes = words.hashes()
    for a, b in zip(words.bounds.tolist(), words.bounds[1:].tolist(), strict=False):
        yield np.unique(gram_hashes(hashes[a:b], min(width, b - a))) if b > a else hashes[:0]


def min_hash(items: np.ndarray) -> np.ndarray:
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 1024):
        np.minimum(least, (items[None, at : at + 1024] * _ODD[:, None]).min(axis=1), out=least)
    return least


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """The samples folded into a parity bitmap, as 64-bit words."""
    odd = np.bincount((mix(samples + _STEP) % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(BANDS, -1)
    total = _BAND.copy()
    for k in range(rows.shape[1]):
        total = mix(total + rows[:, k])
    return total.view(np.int64)


def most_bits(similarity: float) -> int:
    """Differing sketch bits expected at a similarity."""
    return int(SKETCH_BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - similarity) / SKETCH_BITS)))


def _signer():
    def work(c: dict[str, list]) -> dict[str, list]:
        out = {"doc_id": c["doc_id"], "n_shingles": [], "fa": [], "fb": [], "bands": [], "sketch": []}
        for items in shingles(c["text"]):
            out["n_shingles"].append(len(items))
            if len(items):
                samples, print_ = min_hash(items), xxhash.xxh3_128_digest(items.tobytes())
                fa, fb = np.frombuffer(print_, np.int64).tolist()
                row = (fa, fb, band_keys(samples), odd_sketch(samples))
            else:
                row = (None, None, None, None)
            for name, value in zip(("fa", "fb", "bands", "sketch"), row, strict=True):
                out[name].append(value)
        return out

    return work


def _set_maker():
    return lambda c: {"node": c["doc_id"], "items": [s.tobytes() for s in shingles(c["text"])]}


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share enough: 100 * common >= percent * union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate((x, y))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _confirmer(percent: int):
    def make():
        def work(c: dict[str, list]) -> dict[str, list]:
            a_out, b_out = [], []
            for a, b, x, y in zip(c["a"], c["b"], c["x"], c["y"], strict=True):
                if similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent):
                    a_out.append(a)
                    b_out.append(b)
            return {"a": a_out, "b": b_out}

        return work

    return make


def _blocks(percent: int, good: int):
    """Links of one block of a bucket: outsiders (role 1) against members (role 0) of other components.

    Pairs that meet in an earlier band belong to that bucket. Components that
    the block has joined already are not compared again.
    """

    def rows(table: pa.Table) -> tuple:
        def lists(name: str) -> np.ndarray:
            return table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)

        items = [np.frombuffer(b, np.uint64) for b in table["items"].to_pylist()]
        return table["node"].to_numpy(), table["part"].to_numpy(), lists("sketch"), lists("bands"), items, np.array(table["outside"].to_pylist(), bool)

    def work(table: pa.Table) -> pa.Table:
        a_out, b_out, root = [], [], {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        members, outs = (table.filter(pa.compute.equal(table["role"], r)) for r in (0, 1))
        if members.num_rows and outs.num_rows:
            key = table["key"][0].as_py()
            m_node, m_part, m_sketch, m_bands, m_items, m_out = rows(members)
            for node, part, sketch, bands, x in zip(*rows(outs)[:5], strict=True):
                bits = np.bitwise_count((m_sketch ^ sketch).view(np.uint64)).sum(axis=1)
                near = np.flatnonzero((bits <= good) & (m_part != part) & (~m_out | (node < m_node)))
                first = (m_bands[near] == bands).argmax(axis=1)
                near = near[bands[first] == key]
                for j in near[np.argsort(bits[near], kind="stable")].tolist():
                    p, q = find(int(part)), find(int(m_part[j]))
                    if p != q and similar(x, m_items[j], percent):
                        root[p] = q
                        a_out.append(min(int(node), int(m_node[j])))
                        b_out.append(max(int(node), int(m_node[j])))
        return pa.table({"a": pa.array(a_out, pa.int64()), "b": pa.array(b_out, pa.int64())})

    return lambda: work


def _dealt(wide: DataFrame, block: int) -> DataFrame:
    """Members and outsiders of buckets, dealt to every block in which they meet."""
    blocks, out_blocks = F.ceil(F.col("size") / block).cast("int"), F.ceil(F.col("n_out") / block).cast("int")
    members = wide.withColumn("m", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), out_blocks - 1))).withColumn("role", F.lit(0))
    outs = wide.where("outside").withColumn("o", F.pmod(F.xxhash64("node", F.lit(5)), out_blocks).cast("int")).withColumn("m", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("role", F.lit(1))
    return members.unionByName(outs)


def _differ(x: str, y: str) -> Column:
    """Bits in which two odd sketches differ."""
    return sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))


def _with_both(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b, salt) with the column of a as x and that of b as y; a is fetched once for each salt."""
    centres = pairs.select("a", "salt").distinct().join(values.select(F.col("node").alias("a"), F.col(column).alias("x")), "a")
    return pairs.join(centres, ["a", "salt"]).join(values.select(F.col("node").alias("b"), F.col(column).alias("y")), "b")


def near_dups(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of docs."""
    rows = texts(docs)
    signed = keep(scan(rows, _signer, SIGNATURE), "signatures")
    good = most_bits(percent / 100 - 0.25)

    # 1. one class for equal sets
    classes = signed.where("doc_id is not null and n_shingles > 0").groupBy("fa", "fb").agg(F.min("doc_id").alias("node"), F.min_by(F.struct("bands", "sketch"), "doc_id").alias("s"))
    classes = keep(classes.select("fa", "fb", "node", "s.bands", "s.sketch"), "classes")
    members = classes.select("node", F.explode("bands").alias("key"))

    # 2. stars of buckets
    buckets = keep(members.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1"), "buckets")
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / SALT)).cast("int")
    tried = members.join(buckets, "key").where("node != a").select("a", F.col("node").alias("b"), salt.alias("salt")).groupBy("a", "b").agg(F.max("salt").alias("salt"))
    close = _with_both(tried, classes, "sketch").where(_differ("x", "y") <= good).select("a", "b", "salt")
    close = keep(close, "star_pairs")
    wanted = members.join(buckets.select("key"), "key", "left_semi").select("node").distinct()
    sets = keep(scan(rows.join(wanted, rows["doc_id"] == wanted["node"], "left_semi"), _set_maker, "node long, items binary"), "sets")
    links = keep(scan(_with_both(close, sets, "items").select("a", "b", "x", "y"), _confirmer(percent), "a long, b long"), "star_links", [close])
    roots = components(links)

    # 3. what the rest of a bucket holds outside its main component
    placed = members.join(buckets.where("n > 2").select("key", "a"), "key").where("node != a").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("part"))
    placed = keep(placed, "placed", [buckets])
    parts = placed.groupBy("key", "part").agg(F.count("*").alias("n"))
    split = parts.groupBy("key").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count("*").alias("parts"), F.sum("n").alias("size"), F.max("n").alias("in_main")).where("parts > 1")
    split = keep(split.select("key", "main", "size", (F.col("size") - F.col("in_main")).alias("n_out")), "split_buckets")
    open_ = placed.join(split, "key").select("key", "node", "part", "size", "n_out", (F.col("part") != F.col("main")).alias("outside"))
    wide = keep(open_, "open_buckets", [placed, split]).join(classes.select("node", "sketch", "bands"), "node").join(sets, "node")
    late = keep(group_scan(_dealt(wide, block), ["key", "m", "o"], _blocks(percent, good), "a long, b long"), "late_links", [sets])
    roots = components(late.union(roots.select("node", "root")), [late, roots])

    found = classes.select("fa", "fb", "node").join(roots, "node", "left").select("fa", "fb", F.coalesce("root", "node").alias("component"))
    out = signed.select("doc_id", "n_shingles", "fa", "fb").join(found, ["fa", "fb"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_dups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with one document of each component; columns as they came."""
    gone = near_dups(docs, percent).where("not kept").select("doc_id").distinct()
    rows = whole_rows(docs)
    left = rows.join(gone, F.col("row.doc_id").cast("long") == gone["doc_id"], "left_anti")
    return left.select(*columns_of("row", docs))


def op4(spark, sf_dir: str) -> DataFrame:
    return near_dups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS r(i) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least ON d.doc_id = least.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
"""
