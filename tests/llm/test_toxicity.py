"""Operator 9: folding, lexicon, exceptions, scores and held-out labels."""

import math
import random
import zlib

import pytest

from quillmesh.llm import toxicity


@pytest.fixture(scope="module")
def scored(spark, make):
    """Rows, labels, model and scores of a small table of random words."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        words = [f"{''.join(rng.choice('abcdefgh') for _ in range(6))}" for _ in range(rng.randrange(5, 200))]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["zorkuse", "Zorkish", "z0rkling", "хylophat"])
        elif i % 7 == 0:
            words += ["museum", "of", "xylophat"]
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(toxic)))
    labels += [(10_000, None), (None, 1), (4, 0), (4, 0)]
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows += [(7000, None), (7001, ""), (7002, "zorkuse"), (None, "zorkuse"), (7002, "zorkuse"), (7003, "q" * 300_000), (7004, "zorkuse " * 50_000)]
    model = toxicity.learn(make(rows), frame, exceptions=("Museum of",))
    df = toxicity.score(make(rows), model)
    return rows, frame, model, df.collect()


def test_folding():
    assert toxicity.fold("Ｌ0ser! іdіоt dо​nt".encode()) == " loser idiot dont "
    assert toxicity.fold(None) == toxicity.fold(b"") == " "


def test_edges(make, scored):
    rows, frame, _, got = scored
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[7000].score == by_id[7001].score == by_id[7003].score == 0.0
    assert by_id[7002].predicted == by_id[7004].predicted == 1
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    empty = toxicity.learn(make([]), frame.limit(0))
    assert toxicity.score(make([(1, "x")]), empty).first().score == 0.0 and toxicity.score(make([]), empty).count() == 0


def test_exceptions():
    lexicon = toxicity.Lexicon({" idiot ": 5.0, " zork": 4.0}, ["the idiot"])
    assert lexicon.hits(toxicity.fold(b"the idiot zorking")) == {10: 4.0}
    assert lexicon.hits(toxicity.fold(b"an idiot")) == {3: 5.0}


def plain_hits(weights, spared, line):
    found, covered = {}, []
    for phrase in spared:
        at = line.find(f" {phrase} ")
        while at >= 0:
            covered.append((at, at + len(phrase) + 1))
            at = line.find(f" {phrase} ", at + 1)
    for entry, weight in weights.items():
        at = line.find(entry)
        while at >= 0:
            if not any(a <= at < b for a, b in covered):
                found[at] = max(found.get(at, 0.0), weight)
            at = line.find(entry, at + 1)
    return found


def test_hits_equal_plain_search():
    rng = random.Random(9)
    words = ["ab", "abc", "abcd", "b", "cd", "dab"]
    for _ in range(300):
        weights = {f" {w} " if rng.random() < 0.5 else f" {w}": float(k + 1) for k, w in enumerate(rng.sample(words, 3))}
        spared = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3))]
        line = f" {' '.join(rng.choice(words) for _ in range(12))} "
        assert toxicity.Lexicon(weights, spared).hits(line) == plain_hits(weights, spared, line)


def test_scores_equal_plain_search(scored):
    rows, _, (weights, spared, scale), got = scored
    assert weights and "museum of" in spared
    texts = dict(rows)
    for r in got[:600]:
        line = toxicity.fold((texts[r.doc_id] or "").encode())
        strength = sum(plain_hits(weights, spared, line).values()) / (1 + math.log1p(line.count(" ") / 100))
        assert r.score == pytest.approx(1 - math.exp(-scale * strength), abs=1e-8) and r.predicted == (r.score >= 0.3)


def test_held_out_labels(spark):
    """F1 on the labelled documents that no training saw, on a table of 10,000."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    hit = sum(p and t for p, t in held)
    assert len(held) > 500 and 2 * hit / (sum(p for p, _ in held) + sum(t for _, t in held)) > 0.9
