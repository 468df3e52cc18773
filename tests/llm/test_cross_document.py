"""Operators that compare documents: 4 and 6."""

import hashlib
import random
import re

import pytest

from quillmesh.llm import near_dups, substring_dedup
from quillmesh.llm.components import components

SPACED = re.compile(r"[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = SPACED.findall(lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def family(rng, base, n, edits):
    """Copies of a text with random words changed."""
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def families():
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    other = [f"v{rng.randrange(400)}" for _ in range(90)]
    texts = family(rng, base, 70, 9) + family(rng, other, 12, 5) + [" ".join(other)] * 5 + ["Short one", "short ONE", "short two", "", None, " \n", "a b c d e"]
    rng.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


def results(df, *names):
    return {r.doc_id: tuple(r[n] for n in names) for r in df.collect() if r.doc_id is not None}


@pytest.mark.parametrize("block", [512, 3])
def test_near_dups(make, families, block):
    rows = [*families, (None, families[0][1]), families[3], (9001, "x " * 100_000), (9002, "y" * 300_000), (9003, "Y" * 300_000 + " \t")]
    df = near_dups.near_dups(make(rows), block=block)
    got = df.collect()
    assert len(got) == len(rows)
    assert results(df, "n_shingles", "component_id", "kept") == brute_components(rows)
    (lost,) = [r for r in got if r.doc_id is None]
    assert lost.component_id is None and lost.kept
    if block == 3:
        kept = near_dups.drop_near_dups(make(rows))
        assert kept.columns == make([]).columns
        want = sum(1 for i, _ in rows if i is None or brute_components(rows)[i][2])
        assert kept.count() == want


def test_near_dups_on_the_table(spark, sample):
    docs, texts = sample
    assert results(near_dups.near_dups(docs), "n_shingles", "component_id", "kept") == brute_components(texts.items())


def test_near_dups_of_nothing(make):
    assert near_dups.near_dups(make([])).count() == 0
    assert results(near_dups.near_dups(make([(5, None), (6, "")])), "component_id", "kept") == {5: (5, True), 6: (6, True)}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_odd_sketch_estimates(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    for share in (0.95, 0.8, 0.6):
        n = 4000
        both = rng.integers(0, 2**63, n, dtype=np.uint64)
        extra = int(n * (1 - share) / share / 2)
        x, y = (np.concatenate((both, rng.integers(0, 2**63, extra, dtype=np.uint64))) for _ in range(2))
        bits = int(np.bitwise_count((near_dups.odd_sketch(near_dups.min_hash(x)) ^ near_dups.odd_sketch(near_dups.min_hash(y))).view(np.uint64)).sum())
        assert abs(bits - near_dups.most_bits(share)) < 40


def brute_substrings(rows, width=13):
    first = {}
    for doc, text in rows:
        if doc is not None:
            w = SPACED.findall(text or "")
            for i in range(len(w) - width + 1):
                key = tuple(w[i : i + width])
                first[key] = min(doc, first.get(key, doc))
    out = {}
    for doc, text in rows:
        w, gone = SPACED.findall(text or ""), set()
        for i in range(len(w) - width + 1 if doc is not None else 0):
            if first[tuple(w[i : i + width])] < doc:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("bound", [2000, 2])
def test_substrings(make, families, bound):
    rng = random.Random(2)
    passage = [f"p{k}" for k in range(60)]
    rows = [(i, " ".join([f"u{rng.randrange(9999)}" for _ in range(30)] + passage[rng.randrange(20) : 60 - rng.randrange(20)] + [f"t{rng.randrange(9999)}" for _ in range(30)])) for i in range(500, 560)]
    rows += [*families, (2, " ".join(passage[:13])), (700, "a b " * 40), (701, "a b " * 20 + "c"), (None, " ".join(passage)), (702, None), (703, ""), (704, "ä b " * 30), (705, " ".join(passage[:12]))]
    rows += [(706, rows[0][1]), (706, rows[0][1])]
    df = substring_dedup.dedup_substrings(make(rows), max_segments=bound, bucket_bytes=2000)
    assert df.count() == len(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}
    assert got == brute_substrings(rows)
    assert sum(v[1] for v in got.values()) > 3000


def test_substrings_on_the_table(spark, sample, make):
    docs, texts = sample
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup_substrings(docs).collect()}
    assert got == brute_substrings(texts.items())
    assert substring_dedup.dedup_substrings(make([])).count() == 0


def test_suffix_automaton():
    rng = random.Random(4)
    machine, texts = substring_dedup.SuffixAutomaton(), []
    for _ in range(60):
        query = [rng.choice("ab") for _ in range(rng.randrange(1, 14))]
        want = []
        for end in range(len(query)):
            want.append(max((end - s + 1 for s in range(end + 1) if any("".join(query[s : end + 1]) in t for t in texts)), default=0))
        assert machine.matches(query) == want
        machine.add(query)
        texts.append("".join(query))
