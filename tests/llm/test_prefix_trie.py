"""Operator 13 against a trie of plain dictionaries and its SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from quillmesh.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string, rep string"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def nodes_of(rows):
    """The contract's rows, node by node."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    length = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        seq = turns.get(base, [])[:h] + turns[c][h:]
        length[c] = len(seq)
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        saved[k] = sum(saved[x] for x in kids[k]) + (len(members[k]) - 1) * (len(WORD.findall(k[-1][1])) if k else 0)
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k], hashlib.sha256(",".join(str(c) for c in sorted(m) if length[c] == len(k)).encode()).hexdigest())
        for k, m in members.items()
    )


def run(spark, rows, folder):
    full = [(*r, 7, "clash", "clash") for r in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    got = trie.op13(spark, str(folder))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted(map(tuple, got.collect()))


@pytest.fixture(scope="module")
def talk():
    """Shared beginnings, copies, short ones, ties and nulls, ids of either sign, absent bases."""
    rng = random.Random(4)
    lines = ["hello there", "", None, "one  two\tthree", "a b", "Ä  ö"]
    rows = []
    for c in [*range(-25, 45), 61, 62, 63, 64, 105, 106, 1007, 10**12 + 3]:
        n = rng.choice([1, 1, 2, 3, 3, 5, 8])
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(lines[:3] if t < 2 else lines)) for t in range(n)]
    rows += [(c, t, "user", f"copy {t}") for c in range(200, 230) for t in range(6)]
    rows += [(70, None, "user", "first"), (70, None, None, None), (70, 3, "b", "x"), (70, 3, "a", "y"), (70, 3, "a", "y"), (None, 1, "user", "nobody"), (71, 0, "user", "x " * 20_000)]
    rng.shuffle(rows)
    return rows


def test_trie_equals_brute_force(spark, talk, tmp_path):
    assert run(spark, talk, tmp_path) == nodes_of(talk)


def test_long_copies_in_small_blocks(spark, tmp_path, monkeypatch):
    """Values that run over several blocks, and beginnings that end inside others."""
    monkeypatch.setattr(trie, "BLOCK", 4)
    rows = [(c, t, "user", f"turn {t} of all") for c in range(1, 9) for t in range(30 + 2 * (c % 4))]
    rows += [(c, t, "user", f"turn {t} of all" if t < 11 else f"{c}") for c in (9, 10) for t in range(15)]
    assert run(spark, rows, tmp_path) == nodes_of(rows)


def test_empty_and_single(spark, tmp_path):
    assert run(spark, [], tmp_path / "a") == []
    assert run(spark, [(None, 1, "user", "x")], tmp_path / "b") == []
    assert run(spark, [(21, 0, "user", "x")], tmp_path / "c") == nodes_of([(21, 0, "user", "x")])


def test_rounds_follow_branches(spark, monkeypatch):
    """Copies of a long conversation finish in as many rounds as short ones."""
    rounds = []
    keep = trie.keep
    monkeypatch.setattr(trie, "keep", lambda df, name, *more: (rounds.append(name), keep(df, name, *more))[1])
    rows = [(c, t, "user", f"{t}", 0, "", "") for c in (1, 2, 4) for t in range(200 if c < 4 else 100)]
    out = trie.prefix_trie(*trie.rebuild(trie.ordered(spark.createDataFrame(rows, SCHEMA))))
    assert out.count() == len(nodes_of([r[:4] for r in rows])) and rounds.count("peeled") <= 4


def test_sql(spark, talk, tmp_path):
    run(spark, talk, tmp_path)
    con = duckdb.connect()
    for path, want in ((f"{tmp_path}/conversations.parquet/*.parquet", nodes_of(talk)), ("/root/testdata/sf0.001/conversations.parquet", None)):
        con.execute(f"create or replace view conversations as select * from '{path}'")
        got = sorted(con.execute(trie.ORACLE).fetchall())
        assert got == (want or sorted(map(tuple, trie.op13(spark, "/root/testdata/sf0.001").collect())))
        assert want is not None or got == nodes_of(con.execute("select conv_id, turn, role, text from conversations").fetchall())
