"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from the model on the driver, as arrays of arcs
(state, input, next state) with outputs and weights, and broadcast:
- normaliser: a trie of the model's rewriting rules; an arc that ends a rule
  writes its replacement, any other character is copied; spaces become the
  mark, a mark is put first, runs of spaces are squeezed (each if the model asks);
- pieces: a trie of the vocabulary whose final states write the piece; any
  character that is no piece has an arc that writes its UTF-8 bytes as byte pieces;
- grammar: weights of one piece after another. A unigram model has one state and
  an arc weighs minus the piece's log probability (byte fallback: the least
  probability less `UNKNOWN_COST`). In a merge model (BPE) the state is the piece
  read last, and the arc from u to v weighs 0 if merging leaves u and v side by
  side, else infinity. Merging u+v is undone from the last merge on: if the
  pieces that touch at some moment could have been joined before the merge that
  came next, the border would not have survived. Merges on both sides of a
  surviving border don't depend on each other, so just one segmentation of each
  prefix has a path of finite weight, the one that merging gives.

Each input is composed with these lazily, and the shortest path in the tropical
semiring (sums along a path, minimum over paths) is found best-first (Dijkstra):
of the arcs that leave settled places the one with the least weight is taken, of
equals the one that leads furthest, and only then is its grammar weight worked
out. Either kind of model has one grammar state of finite weight at each place,
so a place is settled once, with that state. (All weights of a merge model are 0,
so there the heap is a stack.) No piece has a mark after
another character and pieces don't hold line ends (checked when compiling), so
the shortest path of a text is the concatenation of its words' paths; likewise
for letters and other characters of a word, if no piece holds both. These paths
are remembered up to a bound. `round_trip` is measured: the ids of every document
are decoded and compared with its text.

Edge cases: null and empty texts have no ids and round-trip; a text that holds
the mark itself, or that the normaliser changes, decodes to another text and is
reported as not round-tripping; very long words take memory in proportion;
repeated and null doc_ids give a row each; an empty table gives no rows; extra
columns don't matter.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
from pyspark.sql import DataFrame

from quillmesh.llm.common import Memo, scan, state, texts
from quillmesh.llm.pieces import BYTE, MODEL, NORMAL, SPACE, Pieces, read_model

NEVER = float("inf")
UNKNOWN_COST = 10.0
MEMO_BYTES = 120_000_000, 60_000_000  # of words, of parts of words
MEMO_BORDERS = 200_000
_RUNS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
_ODD = "".join(c for c in map(chr, range(0x80, 0x10000)) if c.isalnum() and not c.isalpha() and not c.isdecimal())  # such as raised digits
_LETTERS = re.compile(rf"[^\W\d_{_ODD}]+|[\W\d_{_ODD}]+")


@dataclass
class Machine:
    """A trie as arcs (state, input character, next state); writes[s] is what final state s writes, or -1."""

    state: np.ndarray
    reads: np.ndarray
    next: np.ndarray
    writes: np.ndarray

    def arcs(self) -> dict:
        """The arcs of state 0 by character, each as (arcs of the next state, what that writes)."""
        none: dict = {}
        inner = set(self.state.tolist())
        out = [{} if s in inner else none for s in range(len(self.writes))]
        writes = self.writes.tolist()
        for s, c, to in zip(self.state.tolist(), self.reads.tolist(), self.next.tolist(), strict=True):
            out[s][chr(c)] = out[to], writes[to]
        return out[0]


def trie(strings: dict[str, int]) -> Machine:
    arcs: dict[tuple[int, str], int] = {}
    writes = [-1]
    for text, out in strings.items():
        s = 0
        for c in text:
            to = arcs.setdefault((s, c), len(writes))
            if to == len(writes):
                writes.append(-1)
            s = to
        writes[s] = out
    state_, reads = zip(*arcs, strict=True) if arcs else ((), ())
    return Machine(np.array(state_, np.int32), np.array([ord(c) for c in reads], np.int32), np.array(list(arcs.values()), np.int32), np.array(writes, np.int32))


def merge(text: str, cost: dict[str, float]) -> tuple[list[str], int]:
    """Pieces after merging (least cost first, leftmost of equals), and the length of the left part of the last merge."""
    parts, left = list(text), 0
    costs = [cost.get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
    while costs and (best := min(costs)) < NEVER:
        i = costs.index(best)
        left = len(parts[i])
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del costs[i]
        if i:
            costs[i - 1] = cost.get(parts[i - 1] + parts[i], NEVER)
        if i < len(costs):
            costs[i] = cost.get(parts[i] + parts[i + 1], NEVER)
    return parts, left


@dataclass
class Compiled:
    """What is broadcast: the machines and, by id, the piece and its weight.

    Merge models also have by id the parts of its last merge (-1: none), by pair
    of ids (first * 2**32 + second) the weight of what both make together, and
    `odd`: pieces with a part whose rank isn't earlier, whose borders are tried by
    merging. Characters that occur inside pieces only have ids beyond the pieces.
    """

    strings: list[str]
    byte_ids: list[int]
    prefix: bool
    squeeze: bool
    rules: Machine
    written: list[str]
    pieces: Machine
    merges: bool
    weight: list[float]
    parts: list[tuple[int, int]]
    pairs: dict[int, float]
    odd: set[int]
    apart: bool  # no piece holds a letter and another character, marks in front left aside


def compile_model(model: Pieces) -> Compiled:
    strings = [p for p, _, _ in model.pieces]
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind == NORMAL}
    byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte fallback")
    if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in ids):
        raise ValueError("a piece joins two words; words can't be encoded one by one")
    weight, parts, pairs, odd = [-s for _, s, _ in model.pieces], [], {}, set()
    symbols = written = dict(ids)
    if model.merges:
        for c in sorted({c for p in ids for c in p} - set(ids)):
            symbols[c] = len(strings) + len(symbols) - len(ids)
        parts = [(-1, -1)] * (len(strings) + len(symbols) - len(ids))
        cost, written = {p: weight[i] for p, i in ids.items()}, dict(symbols)
        for p in sorted(ids, key=len):  # parts before wholes
            i = ids[p]
            for k in range(1, len(p)):
                if p[:k] in symbols and p[k:] in symbols:
                    pairs[symbols[p[:k]] << 32 | symbols[p[k:]]] = weight[i]
            merged, left = merge(p, cost)
            if len(merged) > 1:
                del written[p]  # merging never makes it
            elif len(p) > 1:
                parts[i] = symbols[p[:left]], symbols[p[left:]]
                if any(len(x) > 1 and (ids[x] in odd or cost[x] >= weight[i]) for x in (p[:left], p[left:])):
                    odd.add(i)
    rules = trie({k: n for n, k in enumerate(model.rules)})
    return Compiled(strings, [byte_ids[b] for b in range(256)], model.prefix, model.squeeze, rules, list(model.rules.values()), trie(written), model.merges, weight, parts, pairs, odd, all(len(_LETTERS.findall(p.lstrip(SPACE))) < 2 for p in ids))


class Normaliser:
    def __init__(self, c: Compiled) -> None:
        self.rules, self.written = c.rules.arcs(), c.written
        self.prefix, self.squeeze = c.prefix, c.squeeze

    def _rewrite(self, text: str) -> str:
        """Leftmost rules, the longest first; other characters are copied."""
        out, at, n = [], 0, len(text)
        while at < n:
            arcs, end, rule = self.rules, at, -1
            for j in range(at, n):
                step = arcs.get(text[j])
                if step is None:
                    break
                arcs, write = step
                if write >= 0:
                    end, rule = j + 1, write
            out.append(self.written[rule] if rule >= 0 else text[at])
            at = end if rule >= 0 else at + 1
        return "".join(out)

    def __call__(self, text: str) -> str:
        """Characters after the normaliser, marks in place of spaces; nothing for nothing."""
        if self.written:
            text = self._rewrite(text)
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE) if text else ""


class Transducer:
    def __init__(self, c: Compiled) -> None:
        self.normalise = Normaliser(c)
        self.strings, self.merges, self.weight, self.prefix = c.strings, c.merges, c.weight, c.prefix
        self.pieces = c.pieces.arcs()
        self.byte_ids = c.byte_ids
        self.spelled = [p.encode() for p in c.strings]
        for b, i in enumerate(c.byte_ids):
            self.spelled[i] = bytes([b])
        self.dtype = np.dtype("<u2" if len(c.strings) <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"  # executors are little-endian
        used = [i for i in c.pieces.writes.tolist() if 0 <= i < len(c.strings)]
        self.unknown = max((c.weight[i] for i in used), default=0.0) + UNKNOWN_COST
        self.left, self.right = [a for a, _ in c.parts], [b for _, b in c.parts]
        self.pairs, self.odd = c.pairs, c.odd
        self.cost = {c.strings[i]: c.weight[i] for i in used} if c.odd else {}
        self.apart = c.apart
        self.borders: dict[int, float] = {}
        self.part = Memo(self._part, MEMO_BYTES[1])
        self.unit = Memo(self._unit, MEMO_BYTES[0])

    def border(self, u: int, v: int) -> float:
        """The grammar's weight for piece v after piece u; see the module's text."""
        pairs, left, right, weight = self.pairs, self.left, self.right, self.weight
        if u in self.odd or v in self.odd:
            both = [self.strings[u], self.strings[v]] if max(u, v) < len(self.strings) else []
            return 0.0 if not both or merge("".join(both), self.cost)[0] == both else NEVER
        after, u_last = NEVER, True  # weight of the merge that came next, and whether it was u's (it goes first among equals)
        while True:
            now = pairs.get(u << 32 | v)
            if now is not None and (now < after or (now == after and not u_last)):
                return NEVER
            a, b = right[u], left[v]
            if b < 0:
                if a < 0:
                    return 0.0
                u_last = True
            else:
                u_last = a >= 0 and weight[u] > weight[v]
            if u_last:
                after, u = weight[u], a
            else:
                after, v = weight[v], b

    def path(self, unit: str) -> list[tuple[int, int, int]]:
        """(start, end, piece id; -1: byte fallback) along the tropical shortest path over one word."""
        came, ids = self._settle_merges(unit) if self.merges else self._settle(unit)
        out, end, known = [], len(unit), len(self.strings)
        while end:
            out.append((came[end], end, ids[end] if ids[end] < known else -1))
            end = came[end]
        return out[::-1]

    def _settle(self, unit: str) -> tuple[list[int], list[int]]:
        """For each place settled: where its best arc began, and the piece it wrote."""
        n, weight = len(unit), self.weight
        came, ids = [-1] * (n + 1), [-1] * (n + 1)
        came[0] = at = 0
        so_far = 0.0
        heap: list[tuple] = []  # (weight, -end, start, piece)
        while at < n:
            arcs, end, lone = self.pieces, at, True
            while end < n and (step := arcs.get(unit[end])) is not None:
                arcs, piece = step
                end += 1
                if piece >= 0:
                    lone = lone and end > at + 1
                    heappush(heap, (so_far + weight[piece], -end, at, piece))
            if lone:
                heappush(heap, (so_far + self.unknown, -at - 1, at, -1))
            while came[-heap[0][1]] >= 0:
                heappop(heap)
            so_far, end, start, piece = heappop(heap)
            at = -end
            came[at], ids[at] = start, piece
        return came, ids

    def _settle_merges(self, unit: str) -> tuple[list[int], list[int]]:
        """As `_settle` where all finite weights are 0: of the arcs found last the longest is next, so the heap is a stack."""
        n, border, borders, pieces = len(unit), self.border, self.borders, self.pieces
        came, ids = [-1] * (n + 1), [-1] * (n + 1)
        came[0] = at = 0
        stack: list[tuple[int, int, int]] = []  # (end, start, piece)
        put, take = stack.append, stack.pop
        while at < n:
            end = at + 1
            step = pieces.get(unit[at])
            if step is None:
                put((end, at, -1))
            else:
                arcs, piece = step
                if came[end] < 0:
                    put((end, at, piece))
                while end < n and (step := arcs.get(unit[end])) is not None:
                    arcs, piece = step
                    end += 1
                    if piece >= 0 and came[end] < 0:
                        put((end, at, piece))
            while True:
                end, start, piece = take()
                if came[end] >= 0:
                    continue
                before = ids[start]
                if before < 0 or piece < 0:
                    break
                both = before << 32 | piece
                if (more := borders.get(both)) is None:
                    if len(borders) >= MEMO_BORDERS:
                        borders.clear()
                    more = borders[both] = border(before, piece)
                if more == 0.0:
                    break
            at = end
            came[at], ids[at] = start, piece
        return came, ids

    def _part(self, part: str) -> bytes:
        """The ids along the path of one word or part of it, as bytes."""
        ids: list[int] = []
        for start, end, piece in self.path(part):
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend([self.byte_ids[b] for b in part[start:end].encode("utf-8", "replace")])
        return array(self.code, ids).tobytes()

    def _unit(self, unit: str) -> bytes:
        if not self.apart:
            return self._part(unit)
        bare = unit.lstrip(SPACE)
        first, *rest = _LETTERS.findall(bare) or [""]
        return b"".join(map(self.part.__getitem__, [unit[: len(unit) - len(bare)] + first, *rest]))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian bytes."""
        marked = self.normalise(text) if text else ""
        if not marked:
            return b""
        if SPACE + SPACE in marked or SPACE + "\n" in marked or marked[-1] in f"{SPACE}\n" or "\0" in marked:
            units = _RUNS.findall(marked)
        else:
            units = [u for u in marked.replace(SPACE, "\0" + SPACE).replace("\n", "\0\n\0").split("\0") if u]
        return b"".join(map(self.unit.__getitem__, units))

    def decode(self, ids: bytes) -> str:
        """The text of ids as `encode` gives them."""
        text = b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, self.dtype).tolist())).decode("utf-8", "replace")
        if self.prefix and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")


ENCODED = "doc_id long, n_tokens long, ids binary, round_trip boolean"


def _shared(spark, path: str):
    """Makes the transducer of a model once in each worker."""
    shared = spark.sparkContext.broadcast(compile_model(read_model(path)))
    return lambda: state(("sentencepiece", path), lambda: Transducer(shared.value))


def encode(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian, 2 bytes each up to 65,536 pieces), round_trip."""
    transducer = _shared(docs.sparkSession, model_path)

    def make():
        fst = transducer()

        def work(c: dict[str, list]) -> dict[str, list]:
            text = [(t or b"").decode("utf-8", "replace") for t in c["text"]]
            ids = [fst.encode(t) for t in text]
            back = [fst.decode(i) == t for i, t in zip(ids, text, strict=True)]
            return {"doc_id": c["doc_id"], "n_tokens": [len(i) // fst.dtype.itemsize for i in ids], "ids": ids, "round_trip": back}

        return work

    return scan(texts(docs), make, ENCODED)


def decode(encoded: DataFrame, model_path: str = MODEL) -> DataFrame:
    """doc_id, text from doc_id, ids; null ids give null."""
    transducer = _shared(encoded.sparkSession, model_path)

    def make():
        fst = transducer()
        return lambda c: {"doc_id": c["doc_id"], "text": [None if i is None else fst.decode(i) for i in c["ids"]]}

    return scan(encoded.select("doc_id", "ids"), make, "doc_id long, text string")


def op7(spark, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
