"""Relevance scores, priorities and sentiment labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.functions.text import quoted


def _hits(text: Column, word: str) -> Column:
    return F.regexp_count(text, F.lit(rf"\b{quoted(word.lower())}\b"))


def keyword_score(text: Column, high: list[str], medium: list[str], low: list[str], weights: tuple[float, float, float] = (0.3, 0.1, 0.05)) -> Column:
    """Capped sums of keyword hits in lower-cased text, at most 0.6."""
    total = F.lit(0.0)
    for words, weight, cap in ((high, weights[0], 0.2), (medium, weights[1], 0.2), (low, weights[2], 0.1)):
        for w in words:
            total = total + F.least(_hits(text, w) * weight, F.lit(cap))
    return F.least(total, F.lit(0.6))


def url_score(url: Column, include: list[str], exclude: list[str]) -> Column:
    total = F.lit(0.0)
    for p in include:
        total = total + F.when(F.contains(url, F.lit(p)), 0.1).otherwise(0.0)
    for p in exclude:
        total = total - F.when(F.contains(url, F.lit(p)), 0.3).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(total, F.lit(0.2)))


def category_score(categories: Column, include: list[str]) -> Column:
    total = F.lit(0)
    for c in include:
        total = total + F.exists(categories, _holds(c)).cast("int")
    return F.least(total * 0.1, F.lit(0.2))


def _holds(part: str):
    return lambda x: F.contains(F.lower(x), F.lit(part.lower()))


def relevance(keyword: Column, url: Column, category: Column) -> Column:
    return F.round(F.least(keyword + url + category, F.lit(1.0)), 2)


def priority(score: Column, high: float = 0.8, medium: float = 0.5) -> Column:
    return F.when(score >= high, "high").when(score >= medium, "medium").otherwise("low")


def sentiment_label(score: Column) -> Column:
    return F.when(score > 0.05, "positive").when(score < -0.05, "negative").otherwise("neutral")
