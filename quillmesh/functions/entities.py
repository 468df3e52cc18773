"""Names of companies and organizations: normal forms, classes, tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.functions import fixed
from quillmesh.functions.text import cases, fold, quoted, strip

#: equal lengths in alphabetical order, so that the order is total
_SUFFIXES = sorted(fixed.COMPANY_SUFFIXES, key=lambda s: (-len(s), s))


def normalize_entity(c: Column) -> Column:
    """Lower case without company words, spaces and punctuation; '&' and 'and' agree."""
    n = F.lower(strip(F.coalesce(c, F.lit(""))))
    n = F.regexp_replace(F.regexp_replace(n, r"\s*&\s*", " and "), r"\s+and\s+", "and")
    n = fold(n, [rf"\s+{s}[\s.,;:]*$" for s in _SUFFIXES], flags="")
    n = F.regexp_replace(n, r"""[\s\-.,;:+'"]+""", "")
    return F.regexp_replace(n, "^[^a-z0-9]+|[^a-z0-9]+$", "")


def _holds(c: Column, marks: list[str]) -> Column:
    return c.rlike("|".join(quoted(m) for m in marks))


def entity_type(c: Column) -> Column:
    return F.when(_holds(F.lower(c), fixed.ORGANIZATION_MARKS), "Organization").otherwise("Company")


def source_type(c: Column) -> Column:
    return cases([(_holds(F.lower(c), marks), name) for name, marks in fixed.SOURCE_TYPES], "Other")


def tag_place(text: Column) -> Column:
    """The place of the first category one of whose marks is in a text, from 0; of several texts the least counts."""
    return cases([(_holds(text, marks), F.lit(i)) for i, (_, _, marks) in enumerate(fixed.TAG_CATEGORIES)], F.lit(len(fixed.TAG_CATEGORIES)))


def tag_kind(place: Column) -> Column:
    """struct(category, domain) of a place."""
    kinds = [*(rule[:2] for rule in fixed.TAG_CATEGORIES), ("Other", "General")]
    return F.element_at(F.array(*[F.struct(F.lit(category).alias("category"), F.lit(domain).alias("domain")) for category, domain in kinds]), place + 1)


def tag_category(text: Column) -> Column:
    """struct(category, domain) of a lower-cased tag name with its keywords."""
    return tag_kind(tag_place(text))


def likely_company(c: Column, known: Column | None = None) -> Column:
    """Whether a string looks like a company name; known: it holds a known company."""
    low, words = F.lower(strip(c)), F.split(strip(c), r"\s+")
    suffix = low.rlike("(" + "|".join(fixed.COMPANY_SUFFIXES) + ")$| (" + "|".join(fixed.COMPANY_SUFFIXES) + ")")
    capital = c.rlike(r"^\p{Lu}")
    one = (F.size(words) == 1) & capital & (F.length(c) <= 5)
    more = F.size(words).between(2, 5) & words[0].rlike(r"^\p{Lu}")
    sure = F.lit(False) if known is None else F.coalesce(known, F.lit(False))
    fits = F.length(low).between(2, 50) & ~_holds(low, fixed.NOT_COMPANY) & (sure | suffix | one | more)
    return F.coalesce(fits, F.lit(False))


def bridge_name(c: Column) -> Column:
    """Lower case, end punctuation and the first fitting company ending dropped."""
    low = F.rtrim(F.lower(F.trim(c)), F.lit("'\".,;: "))
    return cases([(F.endswith(low, F.lit(s)), F.trim(F.regexp_replace(low, quoted(s) + "$", ""))) for s in fixed.BRIDGE_SUFFIXES], low)


def registry_name(c: Column) -> Column:
    n = fold(F.lower(strip(F.coalesce(c, F.lit("")))), fixed.REGISTRY_PATTERNS, flags="(?i)")
    return strip(F.regexp_replace(F.regexp_replace(n, r"[^\p{L}\p{N}_\s]", " "), r"\s+", " "))


def display_name(c: Column) -> Column:
    cleaned = strip(fold(strip(c), fixed.DISPLAY_PATTERNS, flags="(?i)"))
    return F.when(cleaned != "", cleaned)


def mention_count(text: Column, name: Column) -> Column:
    """Whole-word mentions of a name, an optional company word after it; text is lower-cased."""
    safe = F.regexp_replace(F.lower(F.trim(name)), r"([\\.^$|?*+()\[\]{}])", r"\\$1")
    return F.when(F.trim(name) != "", F.regexp_count(text, F.concat(F.lit(r"\b"), safe, F.lit(r"(?:\s+(?:" + "|".join(fixed.MENTION_SUFFIXES) + r"))?\b")))).otherwise(0)
