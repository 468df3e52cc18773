"""Ordered rules over text by one automaton: whole-word rewriting, detection, first substring.

The rules are a DataFrame; all their strings become one Aho-Corasick automaton,
so a text is read once however many rules there are. The automaton is built once
in each worker from broadcast rows, whose number of characters is checked first.

Rewriting gives what replacing rule after rule would: a match of an earlier rule
keeps later rules off its characters, and within a rule the leftmost match wins,
of those the longest. A match begins and ends at a word's edge; word characters
are letters, numbers and the underscore of any script. Upper and lower case are
the same.

Edge cases: null text gives null; a blank synonym never matches; a synonym that
several rules have belongs to the first of them when it is rewritten and counts
for each when it is detected; without rules texts stay as they are.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.session import ship

MAX_CHARACTERS = 64_000_000
#: rewritten texts that a worker holds at once
SLICE = 256
_built: dict[str, object] = {}


def folded(text: str) -> str:
    """Lower case, place by place: letters whose lower case is longer stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


class Automaton:
    """All strings of some rules; strings: (order, payload, string), order tells which goes first."""

    def __init__(self, strings: list[tuple[int, object, str]]) -> None:
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        found: dict[str, list] = {}
        for order, payload, string in strings:
            if string and string.strip():
                found.setdefault(folded(string), []).append((order, payload))
        for string, owners in found.items():
            self.machine.add_word(string, (len(string), sorted(owners, key=lambda o: o[0])))
        if found:
            self.machine.make_automaton()
        self.empty = not found

    def substrings(self, low: str):
        """(order, payload) of everything that occurs."""
        if not self.empty:
            for _, (_, owners) in self.machine.iter(low):
                yield owners[0]

    def words(self, low: str):
        """(start, end, owners) of all whole-word matches, overlapping ones included."""
        if self.empty:
            return
        last = len(low)
        for end, (n, owners) in self.machine.iter(low):
            start, end = end - n + 1, end + 1
            before, after = start > 0 and is_word(low[start - 1]), end < last and is_word(low[end])
            if before != is_word(low[start]) and after != is_word(low[end - 1]):
                yield start, end, owners


def settle(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (order, start, end) those that stay when rules go in order, each leftmost and longest; by start."""
    starts: list[int] = []
    kept: list[tuple[int, int, int]] = []
    for order, start, end in sorted(matches, key=lambda m: (m[0], m[1], -m[2])):
        at = bisect_left(starts, start)
        if (at and kept[at - 1][2] > start) or (at < len(kept) and kept[at][1] < end):
            continue
        starts.insert(at, start)
        kept.insert(at, (order, start, end))
    return kept


class Rewriter:
    """Rules (rule, key, synonym, rewrites): synonyms that are rewritten as [key], and strings that are only detected."""

    def __init__(self, rows: list[tuple[int, str, str, bool]]) -> None:
        self.keys = {rule: key for rule, key, _, _ in rows}
        self.automaton = Automaton([(rule, rewrites, synonym) for rule, _, synonym, rewrites in rows])

    def __call__(self, text: str) -> tuple[str, str]:
        """The rewritten text, and the keys that occur, in the order of rules, joined by '; '."""
        matches, seen = [], set()
        for start, end, owners in self.automaton.words(folded(text)):
            seen.update(rule for rule, _ in owners)
            matches += [(rule, start, end) for rule, rewrites in owners if rewrites]
        keys = "; ".join(self.keys[rule] for rule in sorted(seen))
        if not matches:
            return text, keys
        out, at = [], 0
        for rule, start, end in settle(matches):
            out += text[at:start], f"[{self.keys[rule]}]"
            at = end
        return "".join([*out, text[at:]]), keys


def _shared(rows: DataFrame, build: Callable[[list], object]) -> Callable[[], object]:
    """Sends the rows to the workers; what `build` makes of them is kept there."""
    spark = rows.sparkSession
    size = rows.agg(*[F.coalesce(F.sum(F.length(c)), F.lit(0)) for c, kind in rows.dtypes if kind == "string"]).first()
    if sum(size) > MAX_CHARACTERS:
        raise ValueError(f"the rules have {sum(size)} characters; at most {MAX_CHARACTERS} are broadcast")
    ship(spark)
    sent = spark.sparkContext.broadcast([tuple(r) for r in rows.collect()])
    name = uuid.uuid4().hex

    def get():
        if name not in _built:
            _built.clear()
            _built[name] = build(sent.value)
        return _built[name]

    return get


def rule_rows(spark, rules: list[tuple[str, list[str]]]) -> DataFrame:
    """A table of rules from (key, synonyms) pairs; keys are detected too."""
    rows = [(i, key, s, s in synonyms) for i, (key, synonyms) in enumerate(rules) for s in dict.fromkeys([*synonyms, key])]
    return spark.createDataFrame(rows, "rule int, key string, synonym string, rewrites boolean")


def rewriter(rules: DataFrame) -> Callable[[Column], Column]:
    """A function from a text column to a struct (out, keys). rules: rule (their order), key, synonym, rewrites."""
    get = _shared(rules.select("rule", "key", "synonym", "rewrites"), Rewriter)

    @F.pandas_udf("out string, keys string")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        change = get()
        for texts in batches:
            for at in range(0, len(texts), SLICE):
                yield pd.DataFrame([(None, None) if t is None else change(t) for t in texts.iloc[at : at + SLICE]], columns=["out", "keys"])

    return apply


def first_substring(index: DataFrame) -> Callable[[Column], Column]:
    """A function from a text column to the id of the first row (position, id, keyword) whose keyword is a substring; null if none is."""
    get = _shared(index.select("position", "id", "keyword"), Automaton)

    @F.pandas_udf("string")
    def apply(texts: pd.Series) -> pd.Series:
        automaton = get()
        return pd.Series([None if t is None else min(automaton.substrings(folded(t)), default=(0, None), key=lambda o: o[0])[1] for t in texts], dtype=object)

    return apply


def keyword_finder(vocab: DataFrame) -> Callable[[Column], Column]:
    """A function from a text column to the (tag, keyword) rows of a vocabulary whose keyword occurs as whole words, each once."""
    get = _shared(vocab.selectExpr("0 AS position", "struct(tag, lower(keyword) AS keyword) AS found", "keyword"), Automaton)

    @F.pandas_udf("array<struct<tag:string,keyword:string>>")
    def apply(texts: pd.Series) -> pd.Series:
        automaton = get()

        def hits(text: str | None) -> list[dict]:
            found = dict.fromkeys(tuple(f) for _, _, owners in automaton.words(folded(text or "")) for _, f in owners)
            return [{"tag": tag, "keyword": keyword} for tag, keyword in found]

        return pd.Series([hits(t) for t in texts], dtype=object)

    return apply
