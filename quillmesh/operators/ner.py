"""Model entities: a plug-in turns texts into spans, the rest are DataFrame operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<type:string,text:string,score:double,start:int,end:int>>"
_RUN = re.compile(r"\b[A-Z][\w&'-]+(?:\s+(?:&\s+)?[A-Z][\w&'-]+)*")


def capital_runs(text: str) -> list[dict]:
    """The default extractor: runs of capitalised words as organizations."""
    return [{"type": "ORG", "text": m[0], "score": 0.5 + 0.1 * min(4, m[0].count(" ") + 1), "start": m.start(), "end": m.end()} for m in _RUN.finditer(text)]


def extractor(make: Callable[[], Callable[[str], list[dict]]] = lambda: capital_runs):
    """A pandas UDF; make() loads a model once a task. Call session.ship first on a cluster."""

    @F.pandas_udf(SPANS)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = make()
        for texts in batches:
            yield texts.map(lambda t: find(t) if t else [])

    return spans


def sure(spans: Column, kind: str = "ORG", least: float = 0.7) -> Column:
    return F.filter(spans, lambda s: (s["type"] == kind) & (s["score"] >= least))


def best_spans(docs: DataFrame, key: str, column: str) -> DataFrame:
    """Of spans with one lower-cased text the one of the highest score, the first of equals."""
    rows = docs.select(key, F.explode(column).alias("s")).withColumn("name", F.lower("s.text"))
    return rows.groupBy(key, "name").agg(F.max_by("s", F.struct("s.score", -F.col("s.start"))).alias("s")).select(key, "name", "s.text", "s.score", "s.start", "s.end")


def ordered_names(*spans: Column) -> Column:
    """Names of several extractors in order, once each, word-piece marks removed."""
    return F.array_distinct(F.concat(*[F.transform(s, lambda x: F.trim(F.regexp_replace(x["text"], "##", ""))) for s in spans]))


def title_case():
    """Python's title(): letters after any non-letter are upper, others lower."""

    @F.pandas_udf("string")
    def title(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else t.title())

    return title


def coverage(rows: DataFrame, found: str, valid: str) -> DataFrame:
    """Rows, rows with names, rows with validated names, and their percentages."""
    some, good = F.count_if(F.size(found) > 0), F.count_if(F.size(valid) > 0)
    return rows.agg(F.count("*").alias("n"), some.alias("found"), good.alias("valid"), F.round(100 * some / F.count("*"), 2).alias("found_percent"), F.round(100 * good / F.count("*"), 2).alias("valid_percent"))
