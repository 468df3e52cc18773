"""Toxicity by a weighted lexicon and one Aho-Corasick automaton.

Text is folded first: lower case, look-alike letters of other scripts and
full-width forms to Latin, digits and signs that stand for letters to those
letters, invisible characters out, everything but letters to one space.

The lexicon is learned from labelled documents: whole words and word beginnings
of 4 to 9 letters, weighted by the log of how much likelier toxic documents hold
them. An entry needs `min_support` toxic documents that are not copies of one
another (told apart by two least hashes of their words), and its weight less
`doubt` standard errors must be `min_weight`. Phrases of an entry and a
neighbouring word that occur in clean documents `min_exceptions` times and in no
toxic one become exceptions, as do given ones; a hit inside an exception doesn't
count. The score is 1 - exp(-a * weight / length norm), where the norm grows with
the logarithm of the length, and `a` is set so that the best threshold on the
training rows becomes `threshold`.

Bounds (documented parameters): training takes a sample of at most about
`max_train` labelled rows and `max_train_bytes` of their text, chosen by a hash of
doc_id. All its candidates are counted and every entry that passes is used: the
sample bounds what reaches the driver (8 bytes for each candidate, the entries
and phrases themselves) and so the automaton. Scoring covers every row and whole
texts.

Edge cases: null and empty texts score 0; labels without text or without a
label are not used; without any toxic training row all scores are 0; repeated and
null doc_ids give a row each; an empty table gives no rows; a very long word is a
word as any other; extra columns don't matter.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter

import ahocorasick
import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import keep, mix, scan, texts

# Look-alike letters (Cyrillic, Greek) and their Latin forms, signs read as letters, invisible characters.
ALIKE = ("аеорсухіјѕһкмтвнԁԛԝɡαεορυιкτνβ", "aeopcyxijshkmtbhdqwgaeopyiktvb")
LEET = ("0134578@$", "oieastbas")
INVISIBLE = "­​‌‍⁠﻿"
_FOLD = str.maketrans(ALIKE[0] + LEET[0], ALIKE[1] + LEET[1], INVISIBLE) | {0xFF01 + k: chr(0x21 + k).lower() for k in range(94)}
_NOT_LETTERS = re.compile(r"[\W_]+")
STEMS = range(4, 10)


def fold(text: bytes | None) -> str:
    """Folded words, one space before, between and after them."""
    if not text:
        return " "
    return f" {_NOT_LETTERS.sub(' ', text.decode('utf-8', 'replace').lower().translate(_FOLD)).strip()} "


def features(words: list[str]) -> set[str]:
    """Words as ' word ' and their beginnings as ' stem'."""
    out = {f" {w} " for w in words if len(w) > 2}
    for n in STEMS:
        out.update(f" {w[:n]}" for w in words if len(w) > n)
    return out


def held_out(doc_id: Column) -> Column:
    """Rows that no training may see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _key(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature) - (1 << 63)


def _toxic_features():
    """Hashes of the features of each text, with a mark that copies of a text share."""

    def work(c: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"feature": [], "sig": []}
        for text in c["text"]:
            words = set(fold(text).split())
            if words:
                hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
                sig = int((hashes.min(keepdims=True) ^ mix(mix(hashes + np.uint64(1)).min(keepdims=True))).view(np.int64)[0])
                found = [_key(f) for f in features(list(words))]
                out["feature"].extend(found)
                out["sig"].extend([sig] * len(found))
        return out

    return work


def _count(wanted):
    """How many texts of either label hold each wanted feature."""

    def make():
        known = wanted.value  # sorted hashes

        def work(c: dict[str, list]) -> dict[str, list]:
            seen: list[Counter] = [Counter(), Counter()]
            for text, toxic in zip(c["text"], c["toxic"], strict=True):
                found = list(features(list(set(fold(text).split()))))
                keys = np.array([_key(f) for f in found], np.int64)
                at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
                if len(known):
                    seen[toxic].update([found[i] for i in np.flatnonzero(known[at] == keys).tolist()])
            rows = [(f, t, n) for t in (0, 1) for f, n in seen[t].items()]
            return {"feature": [r[0] for r in rows], "toxic": [r[1] for r in rows], "n": [r[2] for r in rows]}

        return work

    return make


class Lexicon:
    """Weighted entries and exception phrases in one automaton."""

    def __init__(self, weights: dict[str, float], exceptions: list[str]) -> None:
        self.machine = ahocorasick.Automaton()
        for entry, weight in weights.items():
            self.machine.add_word(entry, (len(entry), weight))
        for phrase in exceptions:
            self.machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
        self.empty = not len(self.machine)
        if not self.empty:
            self.machine.make_automaton()

    def hits(self, line: str) -> dict[int, float]:
        """Weight by the place of each hit word; the heaviest entry counts, exceptions don't."""
        if self.empty:
            return {}
        found: dict[int, float] = {}
        begin: list[int] = []  # of exceptions, in the order of their ends
        stop: list[int] = []
        for end, (size, weight) in self.machine.iter(line):
            start = end - size + 1
            if weight is None:
                begin.append(start)
                stop.append(end)
            else:
                found[start] = max(found.get(start, 0.0), weight)
        if not stop:
            return found
        for k in range(len(stop) - 2, -1, -1):  # the least start among exceptions that end here or later
            begin[k] = min(begin[k], begin[k + 1])
        kept = {}
        for s, w in found.items():
            k = bisect_right(stop, s)  # the first exception that ends after s
            if k == len(stop) or begin[k] > s:
                kept[s] = w
        return kept

    def strength(self, line: str) -> tuple[float, int]:
        """Weight over the length norm, and number of hits."""
        found = self.hits(line)
        return (sum(found.values()) / (1 + math.log1p(line.count(" ") / 100)) if found else 0.0), len(found)


def _phrases(shared):
    def make():
        lexicon = Lexicon(*shared.value)

        def work(c: dict[str, list]) -> dict[str, list]:
            seen: list[Counter] = [Counter(), Counter()]
            for text, toxic in zip(c["text"], c["toxic"], strict=True):
                line, here = fold(text), set()
                for at in lexicon.hits(line):
                    after = line.index(" ", at + 1)
                    before = line.rfind(" ", 0, at) if at else -1
                    later = line.find(" ", after + 1)
                    if before >= 0:
                        here.add(line[before + 1 : after])
                    if later >= 0:
                        here.add(line[at + 1 : later])
                seen[toxic].update(here)
            rows = [(p, t, n) for t in (0, 1) for p, n in seen[t].items()]
            return {"phrase": [r[0] for r in rows], "toxic": [r[1] for r in rows], "n": [r[2] for r in rows]}

        return work

    return make


def _strengths(shared, passed: str):
    def make():
        lexicon = Lexicon(*shared.value)

        def work(c: dict[str, list]) -> dict[str, list]:
            got = [lexicon.strength(fold(t)) for t in c["text"]]
            return {passed: c[passed], "strength": [g[0] for g in got], "n_hits": [g[1] for g in got]}

        return work

    return make


def _best_cut(rows: DataFrame) -> float:
    """The strength at which F1 on the training rows is best; at most 1,000 bins reach the driver."""
    bins = rows.select("toxic", F.least(F.floor(F.col("strength") * 20), F.lit(999)).alias("bin")).groupBy("bin", "toxic").count().collect()
    toxic, total = Counter(), Counter()
    for b, t, n in bins:
        toxic[b] += n * t
        total[b] += n
    hit = flagged = 0
    best, cut, positives = -1.0, 0.05, sum(toxic.values())
    for b in sorted(total, reverse=True):
        hit, flagged = hit + toxic[b], flagged + total[b]
        f1 = 2 * hit / max(1, positives + flagged)
        if b > 0 and f1 >= best:
            best, cut = f1, b / 20
    return cut


def learn(
    docs: DataFrame,
    labels: DataFrame,
    exceptions: tuple[str, ...] = (),
    threshold: float = 0.3,
    max_train: int = 60_000,
    max_train_bytes: int = 500_000_000,
    min_support: int = 3,
    min_weight: float = 2.5,
    doubt: float = 0.5,
    min_exceptions: int = 3,
) -> tuple[dict[str, float], list[str], float]:
    """Entries with weights, exception phrases, and the scale of the score."""
    spark = docs.sparkSession
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, size = usable.count(), texts(docs).agg(F.avg(F.octet_length("text"))).first()[0] or 0.0
    share = min(1.0, max_train / max(1, n), max_train_bytes / max(1.0, n * size))
    usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    train = keep(texts(docs).where("text is not null").join(F.broadcast(usable), "doc_id"), "labelled")  # at most about max_train pairs of numbers

    seen = scan(train.where("toxic = 1").select("text"), _toxic_features, "feature long, sig long")
    support = seen.groupBy("feature").agg(F.count_distinct("sig").alias("n")).where(F.col("n") >= min_support).select("feature")
    wanted = np.sort(support.toArrow()["feature"].to_numpy())
    found = {t: n for t, n in train.groupBy("toxic").count().collect()}
    toxic_docs, clean_docs = found.get(1, 0), found.get(0, 0)
    counts = scan(train.select("text", "toxic"), _count(spark.sparkContext.broadcast(wanted)), "feature string, toxic int, n long")
    counts = counts.groupBy("feature").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    weight = F.log((F.col("t") + 0.5) / (toxic_docs + 1)) - F.log((F.col("c") + 0.5) / (clean_docs + 1))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    heavy = counts.select("feature", weight.alias("w"), error.alias("e")).where(F.col("w") - doubt * F.col("e") >= min_weight).collect()
    weights = {r["feature"]: r["w"] for r in heavy}
    shorter = {f: [f[: n + 1] for n in STEMS if n + 1 < len(f.rstrip())] for f in weights}
    weights = {f: w for f, w in sorted(weights.items()) if not any(weights.get(s, 0.0) >= w - 1 for s in shorter[f])}

    shared = spark.sparkContext.broadcast((weights, []))
    phrases = scan(train.select("text", "toxic"), _phrases(shared), "phrase string, toxic int, n long").groupBy("phrase").agg(F.sum("n").alias("n"), F.max("toxic").alias("toxic"))
    learned = phrases.where((F.col("toxic") == 0) & (F.col("n") >= min_exceptions)).collect()
    spared = sorted({fold(e.encode()).strip() for e in exceptions} | {r["phrase"] for r in learned})
    shared = spark.sparkContext.broadcast((weights, spared))
    cut = _best_cut(scan(train.select("text", "toxic"), _strengths(shared, "toxic"), "toxic int, strength double, n_hits long"))
    return weights, spared, -math.log(1 - threshold) / cut


def score(docs: DataFrame, model: tuple[dict[str, float], list[str], float], threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits per row of docs."""
    weights, spared, scale = model
    shared = docs.sparkSession.sparkContext.broadcast((weights, spared))
    rows = scan(texts(docs), _strengths(shared, "doc_id"), "doc_id long, strength double, n_hits long")
    value = F.round(1 - F.exp(-F.lit(scale) * F.col("strength")), 9)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score"), (value >= threshold).cast("int").alias("predicted"), "n_hits")


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).drop("n_hits")
