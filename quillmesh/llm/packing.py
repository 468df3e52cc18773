"""Token-ID output: documents tokenised and packed into rows of fixed length.

Each task tokenises its documents (byte-level BPE, an end token after each) and
packs them in blocks of about `block_tokens` tokens. Documents longer than a row
are split without loss: full pieces fill rows of their own, the rest is packed.
Packing is best-fit-decreasing: pieces by falling length, each into the row
with the least free space that still fits, found in a segment tree over free
spaces. A row of the result is one line of the packed matrix: ids (little-endian
unsigned 16-bit, padded), cumulative segment lengths, positions at which the
position ids start again, and which document tokens each segment holds.

A block depends on the order of rows in an input split only, so a task that
runs again gives the same rows. Memory holds one block at a time.

Edge cases: a null text has no tokens; an empty text is one end token; repeated
and null doc_ids are packed as they are; an empty table gives no rows; extra
columns don't matter.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quillmesh.llm.common import Memo, arrow_schema, prepare, state, texts

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value: the public byte-level BPE pattern that splits text before merges
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MAX_RANK_BYTES = 64_000_000
MEMO_BYTES = 96_000_000
PACKED = "pack_id long, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>, segments array<struct<doc_id:long,piece:int,first:int,length:int>>"


class CapacityTree:
    """Rows by free space; finds the least free space of at least n that some row has."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        node = free + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, n: int) -> tuple[int, int] | None:
        """(free, row) of the tightest row with at least n free, taken out."""
        count, node = self.count, n + self.leaves
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        free = node - self.leaves
        row = self.rows[free].pop()
        while node:
            count[node] -= 1
            node >>= 1
        return free, row


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indexes of lengths by row; every length is from 1 to capacity."""
    tree, rows = CapacityTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        free, row = tree.take(n) or (capacity, len(rows))
        if row == len(rows):
            rows.append([])
        rows[row].append(i)
        if free > n:
            tree.add(free - n, row)
    return rows


class Tokens:
    """Byte-level BPE ids of texts, with a bounded memory of words."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import tiktoken

        self.end = max(ranks.values()) + 1
        if self.end >= 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.coder = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.word = Memo(lambda w: self.ids(w[1:] if w[1] == "\n" else w), MEMO_BYTES)
        self.last = np.array([self.end], "<u2").tobytes()

    def ids(self, text: str) -> bytes:
        return np.array(self.coder.encode_ordinary(text), "<u2").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 16-bit numbers, the end token last; nothing for null.

        If all white space is single spaces and line ends between words, no token
        crosses from one word to the next, so words are looked up one by one.
        """
        if text is None:
            return b""
        if "\0" not in text and " ".join(text.split()) == text.replace("\n", " "):
            first, *rest = text.replace("\n", " \n").split(" ")
            return self.ids(first) + b"".join(map(self.word.__getitem__, [f" {w}" for w in rest])) + self.last
        return self.ids(text) + self.last


def pack_block(block: list[tuple[int | None, bytes]], capacity: int, pad: int) -> Iterator[tuple]:
    """Rows (n_tokens, ids, cu_seqlens, resets, segments) of (doc_id, ids) pairs."""
    whole, rest = [], []
    for doc, ids in block:
        n = len(ids) // 2
        for piece, first in enumerate(range(0, n, capacity)):
            length = min(capacity, n - first)
            (whole if length == capacity else rest).append(({"doc_id": doc, "piece": piece, "first": first, "length": length}, ids[2 * first : 2 * (first + length)]))
    rows = [[x] for x in whole] + [[rest[i] for i in row] for row in best_fit_decreasing([x[0]["length"] for x in rest], capacity)]
    fill = np.array([pad], "<u2").tobytes()
    for row in rows:
        ends = np.cumsum([0] + [s["length"] for s, _ in row]).tolist()
        yield ends[-1], b"".join([b for _, b in row]) + fill * (capacity - ends[-1]), ends, ends[:-1], [s for s, _ in row]


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    if (size := os.path.getsize(path)) > MAX_RANK_BYTES:
        raise ValueError(f"{path} has {size} bytes; at most {MAX_RANK_BYTES} are broadcast")
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def pack(docs: DataFrame, seq_len: int = 2048, block_tokens: int = 1_000_000, ranks_path: str = RANKS) -> DataFrame:
    """Packed rows; see the module's text. `matrix` makes arrays of them."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    spark_type, schema = arrow_schema(PACKED)

    def run(batches):
        tokens = state(("packing", ranks_path), lambda: Tokens(shared.value))
        number = TaskContext.get().partitionId() << 36

        def emit(block: list) -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = list(pack_block(block, seq_len, tokens.end))
            for at in range(0, len(rows), 512):
                part = rows[at : at + 512]
                columns = [range(number, number + len(part)), *zip(*part, strict=True)]
                number += len(part)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        block, size = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                ids = tokens.encode(None if text is None else text.decode("utf-8", "replace"))
                if ids:
                    block.append((doc.as_py(), ids))
                    size += len(ids) // 2
                if size >= block_tokens:
                    yield from emit(block)
                    block, size = [], 0
        if block:
            yield from emit(block)

    return texts(docs).mapInArrow(run, spark_type)


def write_packed(packed: DataFrame, path: str) -> None:
    """Packed rows as Parquet; a reader needs no tokenizer, `matrix` gives arrays."""
    packed.write.option("compression", "zstd").parquet(path)


def matrix(rows: list, seq_len: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """The id matrix of some packed rows, and position ids that restart in each segment."""
    ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in rows), "<u2").reshape(len(rows), seq_len)
    positions = np.zeros((len(rows), seq_len), np.int32)
    for k, r in enumerate(rows):
        for a, b in zip(r["cu_seqlens"], r["cu_seqlens"][1:], strict=False):
            positions[k, a:b] = np.arange(b - a)
    return ids, positions


def op3(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
