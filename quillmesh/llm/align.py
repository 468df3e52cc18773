"""Alignment of two tokenizers: where their tokens end together, and which ids meet there.

Vocabulary A is byte-level BPE (read from a tokenizer file and encoded by
`byte_bpe`), vocabulary B a SentencePiece model (encoded by its library). A gets a space and the text, B the text, before which it
puts the space itself; both then spell the same bytes. All documents of an Arrow
slice are laid end to end: the ends of A's and of B's tokens are counted once by
byte offset, a cut is where both counts are set, and prefix sums over the offsets
give each document its tokens, groups and links, and each token its group and
its place in the written groups.

A link is a pair of an A and a B token that end at the same byte, so the shorter
one's bytes end the longer one's. The pairs of ids for which that holds follow
from the two vocabularies alone (some hundred thousand, `link_pairs`), however
large the corpus: links are kept as numbers of such pairs, corpus-wide counts are
sums by number, and the table of counts that goes to the driver and back to the
tasks has at most that many rows.

Edge cases: null and empty texts, and texts that a vocabulary doesn't spell (B
writes the sign U+2581 as a space; bytes that are no UTF-8), have no tokens: zeros and an
empty `groups`. Strings of special tokens are plain text. Repeated and null
doc_ids give a row each and all count; an empty table gives no rows; extra
columns don't matter.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.byte_bpe import Coder, class_table
from quillmesh.llm.common import keep, scan, state, texts
from quillmesh.llm.pieces import BYTE, MODEL, SPACE, Pieces, parse_model, read_bytes

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
MAX_TOKENIZER_BYTES = 64_000_000
MAX_PAIRS = 20_000_000


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones stand for themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def read_tokenizer(path: str = TOKENIZER) -> dict[bytes, int]:
    """Ids by bytes of a byte-level BPE tokenizer file without its special tokens; its merges must stand in the order of their ids."""
    if (size := os.path.getsize(path)) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} has {size} bytes; at most {MAX_TOKENIZER_BYTES} are broadcast")
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special, model, byte = {t["content"] for t in model["added_tokens"]}, model["model"], byte_letters()
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(a >= b for a, b in zip(made, made[1:], strict=False)):
        raise ValueError("merges must stand in the order of the ids they make")
    return {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}


def piece_bytes(model: Pieces) -> list[bytes]:
    """The bytes that each piece stands for."""
    return [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() for p, _, kind in model.pieces]


def link_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted keys (A id << 32 | B id) of all tokens of which one ends with the other."""
    places: tuple[dict[bytes, list[int]], ...] = ({}, {})
    for side, tokens in zip(places, (a, b), strict=True):
        for i, token in enumerate(tokens):
            if token:
                side.setdefault(token, []).append(i)
    of_a, of_b = places
    found = [(i, j) for token, ids in of_a.items() for k in range(len(token)) for j in of_b.get(token[k:], ()) for i in ids]
    found += [(i, j) for token, ids in of_b.items() for k in range(1, len(token)) for i in of_a.get(token[k:], ()) for j in ids]
    if len(found) > MAX_PAIRS:
        raise ValueError(f"{len(found)} pairs of ids can meet; at most {MAX_PAIRS} are broadcast")
    x, y = np.array(found, np.int64).reshape(-1, 2).T
    return np.unique(x << 32 | y)


@dataclass
class Vocabularies:
    a: dict[bytes, int]
    classes: np.ndarray
    model: bytes
    b: list[bytes]
    pairs: np.ndarray


def read_vocabularies(a_path: str, b_path: str) -> Vocabularies:
    a, data = read_tokenizer(a_path), read_bytes(b_path)
    tokens = [b""] * (max(a.values()) + 1)
    for token, i in a.items():
        tokens[i] = token
    b = piece_bytes(parse_model(data))
    return Vocabularies(a, class_table(), data, b, link_pairs(tokens, b))


class Aligner:
    """Both encoders, and the alignment of many documents at once."""

    def __init__(self, v: Vocabularies) -> None:
        from sentencepiece import SentencePieceProcessor

        self.a, self.b, self.spelled, self.pairs = Coder(v.a, v.classes), SentencePieceProcessor(model_proto=v.model), v.b, v.pairs
        self.length = np.array([len(t) for t in v.b], np.int64)
        n_a, n_b = len(self.a.tokens), len(v.b)
        self.shift = np.array([0, n_a, 2 * n_a, 2 * n_a + n_b])
        #: an id with the sign after it: A in a group, A at its end, B in a group, B at its end
        self.written = [f"{i}{sign}" for n, sign in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";")) for i in range(n)]

    def spells(self, ids: list[int], text: bytes) -> bool:
        return b"".join(map(self.spelled.__getitem__, ids)) == b" " + text

    def align(self, raw: list[bytes | None]) -> dict[str, list]:
        n = len(raw)
        strings = [(t or b"").decode("utf-8", "replace") for t in raw]
        b_ids = self.b.encode(strings, num_threads=1)
        good = [k for k in range(n) if raw[k] and strings[k].encode() == raw[k] and self.spells(b_ids[k], raw[k])]
        out = {"n_a": [0] * n, "n_b": [0] * n, "n_groups": [0] * n, "groups": [""] * n, "links": [b""] * n}
        if not good:
            return out
        a, _ = self.a.batch([" " + strings[k] for k in good])
        a, b = a.astype(np.int64), np.array([i for k in good for i in b_ids[k]], np.int64)
        stops = np.cumsum([len(raw[k]) + 1 for k in good])
        a_ends, b_ends = np.cumsum(self.a.length[a]), np.cumsum(self.length[b])
        a_at, b_at = (np.bincount(e, minlength=stops[-1] + 1) for e in (a_ends, b_ends))
        both = (a_at > 0) & (b_at > 0)
        cuts = np.flatnonzero(both)
        a_sum, b_sum, cut_sum = np.cumsum(a_at), np.cumsum(b_at), np.cumsum(both)
        # the place of each token among all of its slice: groups in order, A before B in each
        b_before = np.concatenate(([0], b_sum[cuts[:-1]]))
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + b_before[cut_sum[a_ends - 1]]] = a + self.shift[both[a_ends].astype(np.intp)]
        codes[np.arange(len(b)) + a_sum[cuts][cut_sum[b_ends - 1]]] = b + self.shift[2 + both[b_ends].astype(np.intp)]
        keys = a[a_sum[cuts] - 1] << 32 | b[b_sum[cuts] - 1]
        links = np.searchsorted(self.pairs, keys).astype("<i4").tobytes()
        ends = [np.concatenate(([0], x[stops])).tolist() for x in (a_sum, b_sum, cut_sum)]
        for k, a0, a1, b0, b1, c0, c1 in zip(good, *(x for e in ends for x in (e, e[1:])), strict=False):
            out["n_a"][k], out["n_b"][k], out["n_groups"][k] = a1 - a0, b1 - b0, c1 - c0
            out["groups"][k] = "".join(map(self.written.__getitem__, codes[a0 + b0 : a1 + b1].tolist()))[:-1]
            out["links"][k] = links[4 * c0 : 4 * c1]
        return out


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups string, links binary"


def align(docs: DataFrame, a_path: str = TOKENIZER, b_path: str = MODEL, vocabularies: Vocabularies | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups (`a1,a2|b1;a3|b2,b3`), links (numbers of `link_pairs`, little-endian, 4 bytes each)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies or read_vocabularies(a_path, b_path))

    def make():
        aligner = state(("align", a_path, b_path), lambda: Aligner(shared.value))
        return lambda c: {"doc_id": c["doc_id"], **aligner.align(c["text"])}

    return scan(texts(docs), make, ALIGNED)


def link_counts(aligned: DataFrame) -> DataFrame:
    """pair, n: how many links of the corpus hold each pair of ids; at most a row for each of `link_pairs`."""

    def make():
        def work(c: dict[str, list]) -> dict[str, list]:
            pair, n = np.unique(np.frombuffer(b"".join(c["links"]), "<i4"), return_counts=True)
            return {"pair": pair.tolist(), "n": n.tolist()}

        return work

    return scan(aligned.select("links"), make, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def best_counts(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each pair has the highest count of its B id."""
    _, b = np.unique(pairs & 0xFFFFFFFF, return_inverse=True)
    most = np.zeros(b.max(initial=-1) + 1, np.int64)
    np.maximum.at(most, b, counts)
    return counts == most[b]


def score_links(aligned: DataFrame, pairs: np.ndarray, columns: list[str]) -> DataFrame:
    """The named columns of `aligned`, with n_best and count_sum over each document's links.

    `aligned` should be a written table: it is read twice.
    """
    spark: SparkSession = aligned.sparkSession
    found = link_counts(aligned).toArrow()  # bounded by the vocabularies
    counts = np.zeros(len(pairs), np.int64)
    counts[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    shared = spark.sparkContext.broadcast((counts, best_counts(pairs, counts)))

    def make():
        counts, best = shared.value

        def work(c: dict[str, list]) -> dict[str, list]:
            links = np.frombuffer(b"".join(c["links"]), "<i4")
            ends = np.cumsum([0] + [len(x) // 4 for x in c["links"]])
            sums = [np.concatenate(([0], np.cumsum(x[links], dtype=np.int64)))[ends] for x in (best, counts)]
            return {name: np.diff(s).tolist() for name, s in zip(("n_best", "count_sum"), sums, strict=True)}

        return work

    return scan(aligned.select(*columns, "links"), make, "n_best long, count_sum long", carry=tuple(columns))


def op12(spark, sf_dir: str) -> DataFrame:
    v = read_vocabularies(TOKENIZER, MODEL)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    n = F.col("n_groups").alias("n_links")  # one pair of tokens ends at each cut
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    aligned = keep(align(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabularies=v).select(*columns[:4], n, digest, "links"), "links")
    return score_links(aligned, v.pairs, columns).select(*columns[:5], "n_best", "count_sum", "groups_sha256")
