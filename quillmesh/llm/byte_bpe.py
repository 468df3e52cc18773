"""Byte-level BPE: pre-tokenisation by an associative scan, cached merging, decoding by offsets.

Text is cut before merging at the places where the public pattern's matches
begin. No regular expression runs over the text: each code point gets a class
from an array, class and next class give one of nine symbols, and every symbol
is a transition function of an eight-state automaton. The functions that these
nine generate under composition are few, so each is one byte and composing two
is one table look-up; the state before every character comes from an associative
scan over those bytes (within columns of equal blocks, then over the blocks'
totals), for all texts of an Arrow slice at once. An end symbol, which sends
every state to the start, stands between texts.

The class arrays are asked from the tokenizer library's own expression engine
once on the driver (which code points does a class match), so they follow its
version of Unicode. They and the ranks are broadcast: 1.1 MB, and at most
MAX_RANK_BYTES of file.

Equal slices of an Arrow slice are found by hash (and compared), and each
different one goes through a memory of merge results. Merging takes the pair of
least rank, the leftmost of equal ones: for all new slices of up to SHORT bytes
at once, one pair of each in a round, and for longer ones from a heap, so a
word of a million letters costs n log n. `ends` keeps the byte offset at which each token ends:
decoding gathers the tokens' bytes by it, and `decode_span` gives the tokens and
text around any byte range without decoding what lies before.

Edge cases: null and empty texts have no tokens and decode to an empty text;
bytes that are no UTF-8 count as replacement characters; repeated and null
doc_ids give a row each; an empty table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

import hashlib
from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import DataFrame

from quillmesh.llm.common import mix, scan, state, texts
from quillmesh.llm.packing import RANKS, read_ranks

MEMO_BYTES = 64_000_000
SHORT, NONE = 64, 1 << 62
OTHER, LETTER, NUMBER, WHITE, BLANK, END = range(6)
#: symbols: the end of a text, a letter, a number, another sign, an apostrophe that a contraction of one or two letters
#: follows, white space before white space or the end, a blank before something else, other white space before something else
SYMBOLS = S_END, S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_INNER, S_BLANK, S_WHITE = range(9)
#: states: nothing open, a run of letters, numbers or signs, a blank that the next run joins, white space, a contraction with one or two letters to come
STATES = FRESH, IN_LETTERS, IN_NUMBERS, IN_SIGNS, AFTER_BLANK, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)
#: for each symbol: the state that follows (the rest goes to the first), and the states in which no slice begins
MOVES = {
    S_END: (FRESH, {}, set()),
    S_LETTER: (IN_LETTERS, {ONE_LEFT: FRESH, TWO_LEFT: ONE_LEFT}, {IN_LETTERS, AFTER_BLANK, ONE_LEFT, TWO_LEFT}),
    S_NUMBER: (IN_NUMBERS, {}, {IN_NUMBERS, AFTER_BLANK}),
    S_OTHER: (IN_SIGNS, {}, {IN_SIGNS, AFTER_BLANK}),
    S_SHORT: (ONE_LEFT, {IN_SIGNS: IN_SIGNS, AFTER_BLANK: IN_SIGNS}, {IN_SIGNS, AFTER_BLANK}),
    S_LONG: (TWO_LEFT, {IN_SIGNS: IN_SIGNS, AFTER_BLANK: IN_SIGNS}, {IN_SIGNS, AFTER_BLANK}),
    S_INNER: (IN_WHITE, {}, {IN_WHITE}),
    S_BLANK: (AFTER_BLANK, {}, set()),
    S_WHITE: (FRESH, {}, set()),
}
BLOCK = 256
LONGEST = 4096
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_POWER = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(LONGEST, 0x9E3779B97F4A7C15, np.uint64))), dtype=np.uint64)


def class_table() -> np.ndarray:
    """The class of each code point, as the tokenizer library's expressions have it."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", WHITE)):
        found = bytes(tiktoken.Encoding(f"class {kind}", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={}).encode_ordinary(every))
        out[np.frombuffer(found.decode().encode("utf-32-le"), "<u4")] = kind
    out[0x20] = BLANK
    return out


class Scanner:
    """The states of the automaton along a sequence of symbols, by an associative scan."""

    def __init__(self) -> None:
        moves = [tuple(special.get(s, usual) for s in STATES) for usual, special, _ in (MOVES[k] for k in SYMBOLS)]
        functions = [STATES_IDENTITY, *dict.fromkeys(moves)]
        known = {f: i for i, f in enumerate(functions)}
        for f in functions:  # grows while it is walked, until composing with a symbol gives nothing new
            for g in moves:
                if (h := tuple(g[s] for s in f)) not in known:
                    known[h] = len(functions)
                    functions.append(h)
        if len(functions) > 256:
            raise ValueError("a transition function must fit into one byte")
        self.of_symbol = np.array([known[f] for f in moves], np.uint8)
        self.apply = np.array(functions, np.uint8)
        self.then = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint8)
        self.begins = np.array([[s not in MOVES[k][2] for s in STATES] for k in SYMBOLS])

    def before(self, symbols: np.ndarray) -> np.ndarray:
        """The state before each symbol."""
        n = len(symbols)
        rows = -(-n // BLOCK)
        padded = np.zeros(rows * BLOCK, np.uint8)  # 0 is the identity
        padded[:n] = self.of_symbol[symbols]
        along = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
        size = len(self.apply)
        then = self.then.ravel()
        for j in range(1, BLOCK):
            along[j] = then[along[j - 1].astype(np.intp) * size + along[j]]
        total, step = along[-1].copy(), 1
        while step < rows:
            total[step:] = then[total[:-step].astype(np.intp) * size + total[step:]]
            step *= 2
        first = np.zeros(rows, np.intp)
        first[1:] = self.apply[total[:-1], FRESH]
        after = self.apply.ravel()[along.astype(np.intp) * len(STATES) + first]
        out = np.empty(n, np.uint8)
        out[0] = FRESH
        out[1:] = after.T.ravel()[: n - 1]
        return out


STATES_IDENTITY = tuple(STATES)


class Splitter:
    """Cuts texts where the pattern's matches begin."""

    def __init__(self, classes: np.ndarray) -> None:
        self.classes, self.scanner = classes, Scanner()

    def cut(self, strings: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """One buffer of all texts, the slices' first bytes in it (with the end), and how many slices came before each text.

        A slice that begins at a text's end (the sign between texts) is none; see `slices`.
        """
        joined = "\n".join([*strings, ""])
        buffer = joined.encode("utf-8")
        wide = len(buffer) != len(joined)
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4") if wide else np.frombuffer(buffer, np.uint8)
        ends = np.cumsum([len(s) + 1 for s in strings]) - 1
        kinds = self.classes[codes]
        kinds[ends] = END
        symbols = np.array([S_OTHER, S_LETTER, S_NUMBER, S_WHITE, S_BLANK, S_END], np.uint8)[kinds]
        white = kinds >= WHITE
        inner = white[:-1] & white[1:] & (kinds[:-1] != END)
        symbols[:-1][inner] = S_INNER
        at = np.flatnonzero(codes == 0x27)
        one, two = codes[np.minimum(at + 1, len(codes) - 1)], codes[np.minimum(at + 2, len(codes) - 1)]
        symbols[at[np.isin(one, [ord(c) for c in "stmd"])]] = S_SHORT
        for a, b in ("re", "ve", "ll"):
            symbols[at[(one == ord(a)) & (two == ord(b))]] = S_LONG
        begins = self.scanner.begins[symbols, self.scanner.before(symbols)]
        starts = np.flatnonzero(begins)
        bounds = np.searchsorted(starts, np.concatenate(([0], ends + 1)))
        if wide:
            width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
            places = np.cumsum(width, dtype=np.int64) - width
            starts = places[starts]
        return buffer, np.concatenate((starts, [len(buffer)])), bounds

    def slices(self, strings: list[str]) -> list[list[bytes]]:
        """For each text its slices, which joined give the text again."""
        if not strings:
            return []
        buffer, starts, bounds = self.cut(strings)
        places = starts.tolist()
        parts = [buffer[a:b] for a, b in zip(places, places[1:], strict=False)]
        return [parts[a : b - 1] for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]


class Slices(dict):
    """Merge results of about `bound` bytes; the older half goes when it is full."""

    def __init__(self, bound: int) -> None:
        super().__init__()
        self.bound, self.held, self.old = bound // 2, 0, {}

    def get(self, piece: bytes) -> bytes | None:
        value = super().get(piece)
        if value is None and (value := self.old.get(piece)) is not None:
            self.put(piece, value)
        return value

    def put(self, piece: bytes, value: bytes) -> None:
        self.held += 200 + len(piece) + len(value)
        if self.held > self.bound:
            self.old, self.held = dict(self), 0
            self.clear()
        self[piece] = value


class Coder:
    """Ids of slices by rank, with a bounded memory, and the way back."""

    def __init__(self, ranks: dict[bytes, int], classes: np.ndarray) -> None:
        self.ranks, self.splitter = ranks, Splitter(classes)
        size = max(ranks.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        tokens = [b""] * size
        for token, i in ranks.items():
            tokens[i] = token
        self.tokens = tokens
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.place = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.packed = [np.array([i], self.dtype).tobytes() for i in range(size)]
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:k]] << 32 | ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.pairs, self.joined = np.array(sorted(pairs), np.int64).T.copy()
        self.slice = Slices(MEMO_BYTES)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one slice: the pair of least rank first, the leftmost of equals, from a heap."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # where the part after starts; where the part before starts
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapify(heap)
        gone = bytearray(n)
        while heap:
            _, a, end = heappop(heap)
            if gone[a] or (b := after[a]) >= n or after[b] != end:
                continue
            gone[b] = 1
            after[a] = end
            if end < n:
                before[end] = a
                if (r := ranks.get(piece[a : after[end]])) is not None:
                    heappush(heap, (r, a, after[end]))
            if (p := before[a]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
                heappush(heap, (r, p, end))
        out, at = [], 0
        while at < n:
            out.append(ranks[piece[at : after[at]]])
            at = after[at]
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, NONE for a pair that is no token."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.joined[at], NONE)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of many slices at once, each as bytes: every round merges one pair in each slice that still has one."""
        out: list[bytes] = [b""] * len(pieces)
        short = []
        for k, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[k] = self.packed[whole]
            elif len(piece) <= SHORT:
                short.append(k)
            else:
                out[k] = np.array(self.merge(piece), self.dtype).tobytes()
        ids = self.of_byte[np.frombuffer(b"".join([pieces[k] for k in short]), np.uint8)]
        sizes = np.array([len(pieces[k]) for k in short], np.int64)
        names = np.array(short, np.int64)
        while len(names):
            first = np.cumsum(sizes) - sizes
            if ids.dtype != np.int64:
                ids = ids.astype(np.int64)
                rank = np.full(len(ids), NONE, np.int64)
                rank[:-1] = self._rank(ids[:-1], ids[1:])
            rank[first + sizes - 1] = NONE  # a slice's last part has no pair
            least = np.minimum.reduceat(rank, first)
            live = least < NONE
            if not live.all():
                done = np.flatnonzero(~live)
                packed, width = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
                for k, a, n in zip(names[done].tolist(), (first[done] * width).tolist(), (sizes[done] * width).tolist(), strict=True):
                    out[k] = packed[a : a + n]
                stay = np.repeat(live, sizes)
                ids, rank, names, sizes, least = ids[stay], rank[stay], names[live], sizes[live], least[live]
                if not len(names):
                    break
                first = np.cumsum(sizes) - sizes
            word = np.repeat(np.arange(len(sizes)), sizes)
            found = np.flatnonzero(rank == least[word])
            found = found[np.concatenate(([True], word[found[1:]] != word[found[:-1]]))]
            ids[found] = least
            kept = np.ones(len(ids), bool)
            kept[found + 1] = False
            ids, rank, sizes = ids[kept], rank[kept], sizes - 1
            at = found - np.arange(len(found))
            first = np.cumsum(sizes) - sizes
            last = first + sizes - 1
            for place in (at[at < last], at[at > first] - 1):
                rank[place] = self._rank(ids[place], ids[place + 1])
        return out

    def batch(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's ids begin (with the end).

        Equal slices are found by a hash and compared byte by byte with the first
        of them, so each different one is looked up once.
        """
        if not strings:
            return np.empty(0, self.dtype), np.zeros(1, np.int64)
        buffer, starts, bounds = self.splitter.cut(strings)
        data = np.frombuffer(buffer, np.uint8)
        sizes = np.diff(starts)
        starts = starts[:-1]
        inside = np.arange(len(data)) - np.repeat(starts, sizes)
        keys = mix(np.add.reduceat(_BYTE[data] * _POWER[np.minimum(inside, LONGEST)], starts) + sizes.astype(np.uint64))
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        if not (sizes == sizes[first][which]).all() or not (data == data[np.repeat(starts[first][which], sizes) + inside]).all():
            first = which = np.arange(len(starts))  # two different slices have one hash
        pieces = [buffer[a : a + n] for a, n in zip(starts[first].tolist(), sizes[first].tolist(), strict=True)]
        known = self.slice
        values = [known.get(p) for p in pieces]
        if missing := [k for k, v in enumerate(values) if v is None]:
            for k, v in zip(missing, self.merge_all([pieces[k] for k in missing]), strict=True):
                values[k] = v
                known.put(pieces[k], v)
        flat = np.frombuffer(b"".join(values), self.dtype)
        many = np.array([len(v) for v in values], np.int64) // self.dtype.itemsize
        place = np.cumsum(many) - many
        count = many[which]
        count[bounds[1:] - 1] = 0  # the signs between texts
        total = np.cumsum(count)
        ids = flat[np.repeat(place[which] - total + count, count) + np.arange(total[-1])]
        return ids, np.concatenate(([0], total[bounds[1:] - 1]))

    def encode(self, strings: list[str]) -> list[bytes]:
        """Ids of each text as little-endian bytes."""
        ids, bounds = self.batch(strings)
        packed, width = ids.tobytes(), self.dtype.itemsize
        return [packed[a * width : b * width] for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]

    def ends(self, ids: bytes) -> np.ndarray:
        """The byte offset at which each token ends."""
        return np.cumsum(self.length[np.frombuffer(ids, self.dtype)])

    def decode(self, ids: bytes, ends: np.ndarray) -> bytes:
        """The bytes of tokens that end at these offsets, gathered at once."""
        which = np.frombuffer(ids, self.dtype)
        if not len(which):
            return b""
        sizes = np.diff(ends.astype(np.int64), prepend=0)
        return self.flat[np.repeat(self.place[which] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()


ENCODED = "doc_id long, n_tokens long, ids binary, ends binary"


def _coder(spark, path: str):
    """Makes the coder of a rank file once in each worker."""
    shared = spark.sparkContext.broadcast((read_ranks(path), class_table()))
    return lambda: state(("byte_bpe", path), lambda: Coder(*shared.value))


def encode(docs: DataFrame, ranks_path: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian, 2 bytes each up to 65,536 ids), ends (little-endian, 8 bytes each)."""
    coder = _coder(docs.sparkSession, ranks_path)

    def make():
        bpe = coder()

        def work(c: dict[str, list]) -> dict[str, list]:
            ids = bpe.encode([(t or b"").decode("utf-8", "replace") for t in c["text"]])
            return {"doc_id": c["doc_id"], "n_tokens": [len(i) // bpe.dtype.itemsize for i in ids], "ids": ids, "ends": [bpe.ends(i).astype("<i8").tobytes() for i in ids]}

        return work

    return scan(texts(docs), make, ENCODED)


def decode(encoded: DataFrame, ranks_path: str = RANKS) -> DataFrame:
    """doc_id, text (bytes) from doc_id, ids, ends; null ids give null."""
    coder = _coder(encoded.sparkSession, ranks_path)

    def make():
        bpe = coder()
        return lambda c: {"doc_id": c["doc_id"], "text": [None if i is None else bpe.decode(i, np.frombuffer(e, "<i8")) for i, e in zip(c["ids"], c["ends"], strict=True)]}

    return scan(encoded.select("doc_id", "ids", "ends"), make, "doc_id long, text binary")


def decode_span(encoded: DataFrame, first: int, last: int, ranks_path: str = RANKS) -> DataFrame:
    """doc_id, start, text: the tokens that touch the bytes from first up to last, without it, and where they start."""
    coder = _coder(encoded.sparkSession, ranks_path)

    def make():
        bpe = coder()

        def one(ids: bytes | None, ends: bytes | None) -> tuple[int | None, bytes | None]:
            if ids is None:
                return None, None
            stops = np.frombuffer(ends, "<i8")
            a, b = np.searchsorted(stops, first, "right"), np.searchsorted(stops, last, "left") + 1
            start = int(stops[a - 1]) if a else 0
            b = min(b, len(stops)) if last > first else a
            width = bpe.dtype.itemsize
            return start, bpe.decode(ids[a * width : b * width], stops[a:b] - start)

        def work(c: dict[str, list]) -> dict[str, list]:
            got = [one(i, e) for i, e in zip(c["ids"], c["ends"], strict=True)]
            return {"doc_id": c["doc_id"], "start": [g[0] for g in got], "text": [g[1] for g in got]}

        return work

    return scan(encoded.select("doc_id", "ids", "ends"), make, "doc_id long, start long, text binary")


def digests(encoded: DataFrame, ranks_path: str = RANKS) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the decimal ids and of the decoded bytes."""
    coder = _coder(encoded.sparkSession, ranks_path)

    def make():
        bpe = coder()
        spelled = [b"%d" % i for i in range(len(bpe.tokens))]

        def work(c: dict[str, list]) -> dict[str, list]:
            ids = [hashlib.sha256(b" ".join(map(spelled.__getitem__, np.frombuffer(i, bpe.dtype).tolist()))).hexdigest() for i in c["ids"]]
            back = [hashlib.sha256(bpe.decode(i, np.frombuffer(e, "<i8"))).hexdigest() for i, e in zip(c["ids"], c["ends"], strict=True)]
            return {"doc_id": c["doc_id"], "n_tokens": c["n_tokens"], "ids_sha256": ids, "decoded_sha256": back}

        return work

    return scan(encoded, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11(spark, sf_dir: str) -> DataFrame:
    return digests(encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
