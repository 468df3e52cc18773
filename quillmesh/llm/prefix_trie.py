"""Prefix trie of conversations, summed from the leaves to the root.

`ordered` numbers each conversation's turns, `rebuild` gives every conversation
the first turns of another one, and `prefix_trie` turns the sequences into
nodes: one for each distinct beginning, with its members, children, leaves below
and the words that storing each node once would save.

A beginning is known by 128 bits: the running XOR over its turns of a hash of
depth, role and text. So a node's key and its parent's key stand in every row and
nodes come from one aggregation, no text being shuffled; running values are
taken in blocks of BLOCK turns and then over the blocks' totals, so that one very
long conversation spreads over tasks.

Totals pass from leaves to the root: every node holds a counter of children that
have not finished; nodes at zero finish and send their leaves and savings to
their parents, round after round, until only the root finishes. Messages to one
parent are summed before they are shuffled. Nodes that one another's members
share (a run without branch or end) are one node in this: such a run has one
smallest member and one number of members, so it is one group, and a
conversation of a million turns costs no more rounds than a short one. The
rounds are the most branches that lie on one path, not its length.

The ids that end at a node are hashed as a stream: range-partitioned tasks write
them as runs of text, and one task hashes a node's runs in order, holding one
Arrow batch; a third of all conversations may end at one node.

Edge cases: turns of one number are ordered by the first 64 characters of role
and text, then by a hash of both, so equal rows count as turns of their own;
null turn numbers come first; null role or text is empty; rows without conv_id
belong to no conversation and are left out; an empty table has no nodes, not
even a root; extra columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.llm.common import arrow_schema, drop, keep, prepare

BLOCK = 1024
#: conversations whose beginning one of them gives, and the bound of the turns it gives
FAMILY, HEADS = 20, 4
KEY = ["depth", "k1", "k2"]
CHAIN = ["rep", "n_convs"]


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest, n_words of each turn, in a written table.

    Rows are range-partitioned by all that orders them, so a long conversation is
    spread over tasks; places come from one count a partition.
    """
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    order = ["conv_id", "turn", "role_64", "text_64", "digest"]
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.left(role, F.lit(64)).alias("role_64"),
        F.left(text, F.lit(64)).alias("text_64"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"),
    )
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = keep(rows.select("conv_id", "digest", "n_words", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).alias("at")), "turns")
    counts = sorted((r.part, r["count"]) for r in rows.groupBy("part").count().collect())  # one row a partition
    offsets = [(part, int(n)) for (part, _), n in zip(counts, np.cumsum([0] + [n for _, n in counts]), strict=False)]
    numbered = rows.join(F.broadcast(spark.createDataFrame(offsets, "part int, offset long")), "part").withColumn("g", F.col("at") + F.col("offset"))
    first = numbered.groupBy("conv_id").agg(F.min("g").alias("first"))
    out = keep(numbered.join(first, "conv_id").select("conv_id", (F.col("g") - F.col("first") + 1).alias("pos"), "digest", "n_words"), "ordered")
    drop(rows)
    return out


def rebuild(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations (conv_id, length) after the exchange of beginnings, as written tables.

    Conversation c gets the first h turns of conversation c - c % family, all if it
    has fewer and none if there is none, and then its own turns after its first h;
    h is the unsigned crc32 of c in decimal, modulo `heads`.
    """
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = keep(convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h")), "convs")
    given = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    got = F.least("h", F.coalesce("n_base", F.lit(0)))
    lengths = keep(convs.join(given, "base", "left").select("conv_id", "base", "h", got.alias("got"), (got + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "lengths")
    tails = turns.join(lengths, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("got")).alias("depth"), "length", "digest", "n_words")
    beginnings = turns.where((F.col("pos") < heads) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    beginnings = beginnings.join(lengths, "base").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "length", "digest", "n_words")
    rows = keep(tails.unionByName(beginnings), "rebuilt")
    drop(convs)
    return rows, lengths


def running(df: DataFrame, group: list[str], at: str, length: Column, into: dict[str, tuple], combine) -> DataFrame:
    """df with running values along `at` (from 0) in each group, the row's own included.

    `into` maps a new column's name to (aggregate function, column); `combine` joins
    the values of two parts. Only groups longer than a block need the second level.
    """
    block = F.floor(F.col(at) / BLOCK).alias("block")
    inside = Window.partitionBy(*group, "block").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.select("*", block).withColumns({name: f(c).over(inside) for name, (f, c) in into.items()})
    totals = df.where(length > BLOCK).select("*", block).groupBy(*group, "block").agg(*[f(c).alias(f"{name}_before") for name, (f, c) in into.items()])
    earlier = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*group, "block", *[f(f"{name}_before").over(earlier).alias(f"{name}_before") for name, (f, _) in into.items()])
    rows = rows.join(before, [*group, "block"], "left")
    return rows.withColumns({name: combine(F.col(name), F.coalesce(F.col(f"{name}_before"), F.lit(0))) for name in into}).drop("block", *[f"{name}_before" for name in into])


def ends_hashed(ends: DataFrame) -> DataFrame:
    """The key columns, ends_sha256: the SHA-256 of each node's conv_ids, ascending, comma-joined."""
    prepare(ends.sparkSession)
    runs_type, runs_schema = arrow_schema("depth long, k1 long, k2 long, first long, run binary")
    out_type, out_schema = arrow_schema("depth long, k1 long, k2 long, ends_sha256 string")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(c).to_numpy() for c in KEY]
            ids = b.column("conv_id").to_pylist()
            turns = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            cuts = [0, *turns.tolist(), len(ids)]
            runs = [b",".join([b"%d" % i for i in ids[x:y]]) for x, y in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*(pa.array(k[cuts[:-1]]) for k in keys), pa.array([ids[x] for x in cuts[:-1]]), pa.array(runs, pa.binary())], schema=runs_schema)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for b in batches:
            done = []
            for *key, run in zip(*(b.column(c).to_pylist() for c in [*KEY, "run"]), strict=True):
                if key == last:
                    state.update(b",")
                else:
                    if last is not None:
                        done.append((*last, state.hexdigest()))
                    last, state = key, hashlib.sha256()
                state.update(run)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done, strict=True), out_schema, strict=True)], schema=out_schema)
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*last, state.hexdigest()), out_schema, strict=True)], schema=out_schema)

    ends = ends.select(*[F.col(c).cast("long").alias(c) for c in [*KEY, "conv_id"]])
    runs = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInArrow(write, runs_type)
    return runs.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, out_type)


def peel(chains: DataFrame) -> DataFrame:
    """rep, n_convs, leaves, below of each chain: messages go from finished chains to parents until the root has finished.

    `chains` has parent (null for the root), remaining (children that have not
    finished), leaves and below (so far), own, in a written table.
    """
    finished, now = [], chains
    while True:
        done, rest = now.where("remaining = 0"), now.where("remaining > 0")
        finished.append(done.select(*CHAIN, "leaves", "below"))
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, finished)
        sent = done.groupBy("parent").agg(F.count("*").alias("n"), F.sum("leaves").alias("more_leaves"), F.sum(F.col("below") + F.col("own")).alias("more_below"))
        sent = sent.select(F.col("parent.rep").alias("rep"), F.col("parent.n_convs").alias("n_convs"), "n", "more_leaves", "more_below")
        plus = {a: F.col(a) + F.coalesce(b, F.lit(0)) for a, b in (("leaves", "more_leaves"), ("below", "more_below"))}
        rest = rest.join(sent, CHAIN, "left").withColumns({"remaining": F.col("remaining") - F.coalesce("n", F.lit(0)), **plus})
        now = keep(rest.select(*chains.columns), "peeled")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node.

    turns: conv_id, depth (from 1), length (of the conversation), digest, n_words;
    convs: conv_id, length, those without turns included. Both are read more than once.
    """
    xor = lambda a, b: a.bitwiseXOR(b)
    hashes = turns.select("*", (F.col("depth") - 1).alias("at"), F.xxhash64("depth", "digest").alias("x1"), F.xxhash64(F.lit(77), "depth", "digest").alias("x2")).drop("digest")
    rows = running(hashes, ["conv_id"], "at", F.col("length"), {"k1": (F.bit_xor, "x1"), "k2": (F.bit_xor, "x2")}, xor)
    rows = keep(rows.select("conv_id", *KEY, xor(F.col("k1"), F.col("x1")).alias("p1"), xor(F.col("k2"), F.col("x2")).alias("p2"), "n_words", (F.col("depth") == F.col("length")).alias("last")), "prefixes")

    top = convs.agg(F.min("conv_id").alias("rep"), F.count("*").alias("n")).first()  # the root's members: two numbers
    nodes = rows.groupBy(*KEY).agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("n_words").alias("n_words"))
    nodes = keep(nodes.select(*KEY, "p1", "p2", *CHAIN, ((F.col("n_convs") - 1) * F.col("n_words")).alias("own")), "nodes")
    is_child_of = [F.col("depth") - 1, F.col("p1"), F.col("p2")]
    kids = nodes.groupBy(*[c.alias(k) for c, k in zip(is_child_of, KEY, strict=True)]).agg(F.count("*").alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.struct(*CHAIN).alias("parent"))
    root = F.struct(F.lit(top.rep).cast("long").alias("rep"), F.lit(top.n).cast("long").alias("n_convs"))
    linked = nodes.where("depth = 1").select(*nodes.columns, root.alias("parent"))
    linked = linked.unionByName(nodes.where("depth > 1").join(above, ["depth", "p1", "p2"]).select(*nodes.columns, "parent")).drop("p1", "p2")
    zero = F.lit(0).cast("long")
    start = convs.limit(1).select(*[zero.alias(k) for k in KEY], root.rep.alias("rep"), root.n_convs.alias("n_convs"), zero.alias("own"), F.when(F.lit(False), root).alias("parent"))
    linked = keep(linked.unionByName(start).join(kids, KEY, "left").withColumn("n_children", F.coalesce("n_children", zero)), "linked")

    chains = linked.groupBy(*CHAIN).agg(F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.sum("own").alias("own"), F.max_by("n_children", "depth").alias("remaining"), F.min_by("parent", "depth").alias("parent"))
    chains = keep(chains.select("*", F.when(F.col("remaining") == 0, 1).otherwise(0).cast("long").alias("leaves"), zero.alias("below")), "chains")
    totals = peel(chains.drop("top", "bottom")).join(chains.select(*CHAIN, "top", "bottom"), CHAIN)

    alone = linked.where("n_convs = 1").select(*KEY, *CHAIN, "parent", "n_children", F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"))
    shared = linked.where("n_convs > 1").join(totals, CHAIN).withColumn("at", F.col("bottom") - F.col("depth"))
    shared = running(shared, CHAIN, "at", F.col("bottom") - F.col("top") + 1, {"since": (F.sum, "own")}, lambda a, b: a + b)
    shared = shared.select(*KEY, *CHAIN, "parent", "n_children", F.col("leaves").alias("n_leaves"), (F.col("below") + F.col("since")).alias("saved_tokens"))
    ends = rows.where("last").select(*KEY, "conv_id").unionByName(convs.where("length = 0").select(*[zero.alias(k) for k in KEY], "conv_id"))
    out = alone.unionByName(shared).join(ends_hashed(ends), KEY, "left")
    names = {"conv_id": F.col("rep"), "depth": F.col("depth"), "parent_conv_id": F.col("parent.rep"), "n_convs": F.col("n_convs"), "n_children": F.col("n_children"), "n_leaves": F.col("n_leaves"), "saved_tokens": F.col("saved_tokens")}
    return out.select(*[c.cast("long").alias(n) for n, c in names.items()], F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op13(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuild(ordered(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


ORACLE = r"""
WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
  SELECT conv_id, length(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words, sha256(length(r) || ':' || r || t) AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(r, 64), left(t, 64), sha256(length(r) || ':' || r || t)) AS pos
  FROM plain
), crc AS (
  SELECT DISTINCT conv_id, conv_id::VARCHAR AS s, 0 AS i, 4294967295::UBIGINT AS c FROM plain
  UNION ALL
  SELECT conv_id, s, i + 1,
         CASE WHEN i % 9 = 0 THEN xor(c, ascii(s[i // 9 + 1])::UBIGINT) ELSE xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END) END
  FROM crc WHERE i < 9 * length(s)
), counted AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, ((4294967295::UBIGINT - c) % 4)::BIGINT AS h, (SELECT count(*) FROM turns WHERE turns.conv_id = crc.conv_id) AS n
  FROM crc WHERE i = 9 * length(s)
), convs AS (
  SELECT a.conv_id, a.base, a.h, least(a.h, coalesce(b.n, 0)) AS got FROM counted a LEFT JOIN counted b ON a.base = b.conv_id
), rebuilt AS (
  SELECT conv_id, pos - h + got AS depth, x, words FROM convs JOIN turns USING (conv_id) WHERE pos > h
  UNION ALL
  SELECT convs.conv_id, pos, x, words FROM convs JOIN turns ON turns.conv_id = base WHERE pos <= h
), members AS (
  SELECT conv_id, depth, words, string_agg(x, ',') OVER (PARTITION BY conv_id ORDER BY depth) AS k, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM convs
), nodes AS (
  SELECT k, depth, min(conv_id) AS rep, count(*) AS n, max(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends
  FROM members GROUP BY k, depth
), above AS (
  SELECT w.k, w.rep, w.depth, w.n, w.words, m.k AS upper, m.depth AS upper_depth
  FROM nodes w JOIN members m ON m.conv_id = w.rep AND m.depth <= w.depth
), children AS (
  SELECT upper AS k, upper_depth AS depth, count(*) AS kids FROM above WHERE depth = upper_depth + 1 GROUP BY ALL
), sums AS (
  SELECT upper AS k, upper_depth AS depth, count(*) FILTER (kids IS NULL) AS leaves, sum((n - 1) * words) AS saved
  FROM above LEFT JOIN children ON children.k = above.k AND children.depth = above.depth GROUP BY ALL
)
SELECT a.rep AS conv_id, a.depth::BIGINT AS depth, p.rep AS parent_conv_id, a.n AS n_convs, coalesce(kids, 0)::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, a.ends AS ends_sha256
FROM nodes a JOIN sums USING (k, depth) LEFT JOIN children USING (k, depth)
LEFT JOIN (SELECT above.k, above.depth, nodes.rep FROM above JOIN nodes ON nodes.k = upper AND nodes.depth = upper_depth WHERE above.depth = upper_depth + 1) p
  ON p.k = a.k AND p.depth = a.depth
"""
