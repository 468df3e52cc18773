"""Operators 11 and 12 against the tokenizer libraries and a plain alignment."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest

from quillmesh.llm import align, byte_bpe
from quillmesh.llm.packing import PATTERN, RANKS, read_ranks
from quillmesh.llm.pieces import MODEL

SIGNS = ["a", "'", "s", "t", "r", "e", "v", "l", "d", "m", " ", "\n", "1", "²", "é", "日", "😀", " ", "́", "-", "!", "S", " ", "\x1c", "\x85", "\r", "  ", "'ll", "'re", "'s", "'ve", "\x00"]
ODD = [(1, None), (2, ""), (3, " "), (4, "  two  spaces \n\n x"), (5, "a <|endoftext|> b</s><s>"), (5, "same id"), (None, "no id"), (6, "▁ mark"), (7, "w" * 150_000), (8, " " * 3000), (9, "it's they'll 'S 's"), (10, "😀 日本語 ²³ ١٢"), (11, "\n"), (12, "a\x00b")]


def hashed(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


@pytest.fixture(scope="module")
def plain():
    import tiktoken

    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=read_ranks(), special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Coder(read_ranks(), byte_bpe.class_table())


def ids_of(coder, strings):
    return [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(strings)]


def test_slices_and_ids(coder, plain):
    import regex

    rng = random.Random(1)
    for _ in range(300):
        strings = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(14))) for _ in range(rng.randrange(1, 30))]
        assert [[p.decode() for p in parts] for parts in coder.splitter.slices(strings)] == [regex.findall(PATTERN, s) for s in strings]
        assert ids_of(coder, strings) == [plain.encode_ordinary(s) for s in strings]
    assert coder.encode([]) == [] and ids_of(coder, ["", ""]) == [[], []]


def test_scan_over_blocks(coder):
    """The states of the scan are those of a walk, whatever the number of blocks."""
    rng = np.random.default_rng(2)
    moves = {k: [special.get(s, usual) for s in byte_bpe.STATES] for k, (usual, special, _) in byte_bpe.MOVES.items()}
    for n in (1, 255, 256, 257, 5 * 256 + 3, 70_000):
        symbols = rng.integers(0, 9, n).astype(np.uint8)
        want, now = [], 0
        for s in symbols.tolist():
            want.append(now)
            now = moves[s][now]
        assert coder.splitter.scanner.before(symbols).tolist() == want


def test_both_ways_of_merging_agree(coder, plain):
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abcdethé日") for _ in range(rng.randrange(1, 30))).encode() for _ in range(400)] + [b"ab" * 500]
    got = [np.frombuffer(x, coder.dtype).tolist() for x in coder.merge_all(pieces)]
    assert got == [coder.merge(p) for p in pieces] == [plain.encode_ordinary(p.decode()) for p in pieces]


def test_equal_hashes_are_told_apart(coder, plain, monkeypatch):
    monkeypatch.setattr(byte_bpe, "mix", lambda x: np.zeros_like(x))
    strings = ["one two two three", "two one"]
    assert ids_of(coder, strings) == [plain.encode_ordinary(s) for s in strings]


def test_memory_is_bounded():
    memory = byte_bpe.Slices(2000)
    for i in range(100):
        memory.put(b"%d" % i, b"v")
        assert memory.held <= 1000 and len(memory.old) < 10
    assert memory.get(b"99") == b"v" and memory.get(b"1") is None


def test_encode_and_decode(sample, make, plain):
    docs, texts = sample
    for df, rows in ((docs, list(texts.items())), (make(ODD), ODD)):
        encoded = byte_bpe.encode(df)
        want = sorted((i or 0, len(ids := plain.encode_ordinary(t or "")), hashed(" ".join(map(str, ids))), hashed(t or "")) for i, t in rows)
        assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.digests(encoded).collect()) == want
        assert sorted((r.doc_id or 0, bytes(r.text)) for r in byte_bpe.decode(encoded).collect()) == sorted((i or 0, (t or "").encode()) for i, t in rows)
        for first, last in ((0, 10), (3, 4), (7, 7), (10**6, 10**7)):
            for r in byte_bpe.decode_span(encoded, first, last).collect():
                whole = next((t or "").encode() for i, t in rows if i == r.doc_id and (t or "").encode()[r.start : r.start + len(r.text)] == bytes(r.text))
                assert last <= first or whole[first:last] in bytes(r.text)
    assert byte_bpe.encode(make([])).count() == 0
    assert byte_bpe.decode(encoded.selectExpr("doc_id", "cast(null as binary) ids", "ends")).where("text is not null").count() == 0


def test_bytes_that_are_no_text(spark, plain):
    df = spark.sql("SELECT 1L AS doc_id, cast(X'6162ff63' AS string) AS text")
    assert byte_bpe.encode(df).first().n_tokens == len(plain.encode_ordinary("ab�c"))
    assert tuple(align.align(df).first())[1:5] == (0, 0, 0, "")


def test_vocabularies():
    from tokenizers import Tokenizer

    ranks = align.read_tokenizer()
    assert ranks == read_ranks(RANKS) and Tokenizer.from_file(align.TOKENIZER).get_vocab_size() == len(ranks) + 1
    v = align.read_vocabularies(align.TOKENIZER, MODEL)
    assert 10**5 < len(v.pairs) < 10**6
    assert align.link_pairs([b"ab", b"b", b""], [b"b", b"cab", b"x"]).tolist() == sorted(a << 32 | b for a, b in ((0, 0), (0, 1), (1, 0), (1, 1)))


def test_tokenizer_out_of_order(tmp_path):
    path = tmp_path / "t.json"
    path.write_text(json.dumps({"added_tokens": [], "model": {"vocab": {"a": 0, "ab": 2, "b": 1, "ba": 3}, "merges": [["b", "a"], ["a", "b"]]}}))
    with pytest.raises(ValueError, match="order"):
        align.read_tokenizer(str(path))


def brute(rows):
    """The rows of the contract, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_coder, b_coder = Tokenizer.from_file(align.TOKENIZER), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a_coder.encode_special_tokens = True
    letters = align.byte_letters()

    def b_bytes(i):
        return bytes([int(b_coder.id_to_piece(i)[3:5], 16)]) if b_coder.is_byte(i) else b_coder.id_to_piece(i).replace("▁", " ").encode()

    done, counts = [], Counter()
    for i, text in rows:
        a = [(x.ids, x.tokens) for x in [a_coder.encode(" " + (text or ""), add_special_tokens=False)]][0]
        a = [(x, len(y)) for x, y in zip(*a, strict=True)] if text else []
        b = [(x, len(b_bytes(x))) for x in b_coder.encode(text)] if text else []
        if not text or b"".join(b_bytes(x) for x, _ in b) != f" {text}".encode():
            done.append((i, [], [], []))
            continue
        assert bytes(letters[c] for x, _ in a for c in a_coder.id_to_token(x)) == f" {text}".encode()
        groups, links, ga, gb = [], [], [], []
        b_left, b_at, a_at = list(b), 0, 0
        for x, n in a:
            ga.append(x)
            a_at += n
            while b_left and b_at + b_left[0][1] <= a_at:
                y, m = b_left.pop(0)
                gb.append(y)
                b_at += m
            if a_at == b_at:
                groups.append((ga, gb))
                links.append((x, gb[-1]))
                ga, gb = [], []
        done.append((i, a, b, [groups, links]))
        counts.update(links)
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for i, a, b, more in done:
        groups, links = more or ([], [])
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((i or 0, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), hashed(text) if text else ""))
    return sorted(out)


def test_alignment(spark, sample, make, tmp_path):
    docs, texts = sample
    rows = [(i, t) for i, t in ODD if t is None or len(t) < 10_000]
    for df, rows in ((docs, list(texts.items())), (make(rows), rows), (make([]), [])):
        folder = str(tmp_path / f"{len(rows)}")
        df.write.parquet(f"{folder}/documents.parquet")
        got = align.op12(spark, folder)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted((r[0] or 0, *r[1:]) for r in got.collect()) == brute(rows)


def test_groups_are_the_text(make):
    row = align.align(make([(1, "an unfamiliar wordling")])).first()
    v = align.read_vocabularies(align.TOKENIZER, MODEL)
    tokens = {i: t for t, i in v.a.items()}
    for group in row.groups.split(";"):
        a, b = ([int(x) for x in side.split(",")] for side in group.split("|"))
        assert b"".join(tokens[x] for x in a) == b"".join(v.b[x] for x in b)
    assert len(row.links) == 4 * row.n_groups == 4 * len(row.groups.split(";"))
