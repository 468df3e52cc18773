"""Text functions: Column in, Column out, JVM regular expressions only.

Word characters are letters, numbers and the underscore of any script, written
as classes so that Spark and other engines agree.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.functions import fixed

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"


def fold(c: Column, patterns: list[str], to: str = "", flags: str = "(?id)") -> Column:
    """The patterns replaced in turn; (?d) keeps `.` and `$` to \\n as the only line end."""
    for p in patterns:
        c = F.regexp_replace(c, flags + p, to)
    return c


def needed(pattern: str) -> str:
    """The longest plain string that every match of a pattern holds; blank if there is none."""
    bare = re.sub(r"\((?:[^()]|\([^()]*\))*\)[*+?]?|\[[^\]]*\][*+?]?|\\.[*+?]?|[^\\][*?]|[\^$.+|]", "\0", pattern)
    return max(bare.split("\0"), key=len)


@cache
def covering(words: tuple[str, ...], least: int = 6, most: int = 12) -> list[str]:
    """A few strings of which each word holds one: parts of `least` to `most` characters, or shorter words as they are."""
    parts = {w: {w[i : i + n] for n in range(min(least, len(w)), most + 1) for i in range(len(w) - n + 1)} for w in words}
    out = []
    while parts:
        held = Counter(p for own in parts.values() for p in own)
        out.append(min(held, key=lambda p: (-held[p], -len(p), p)))
        parts = {w: own for w, own in parts.items() if out[-1] not in own}
    return out


def fold_if_needed(c: Column, *steps: tuple[list[str], str]) -> Column:
    """Folds by several lists of patterns in turn; a text that holds none of their plain strings is left as it is.

    Most texts hold none, and plain search is far cheaper than dozens of regular
    expressions. If no pattern matches at first, none matches later.
    """
    low, words = F.lower(c), dict.fromkeys(needed(p).lower() for patterns, _ in steps for p in patterns)
    if "" in words:
        need = F.lit(True)
    else:
        need = reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in covering(tuple(words))])
    out = c
    for patterns, to in steps:
        out = fold(out, patterns, to)
    return F.when(need, out).otherwise(c)


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(" \t\n\x0b\f\r"))


def collapse(c: Column) -> Column:
    """White space as one blank; blanks that stand alone are not touched."""
    return F.regexp_replace(c, r"\s{2,}|[\t\n\x0B\f\r]", " ")


def strip_urls(c: Column) -> Column:
    """Texts without their plain marks are left as they are: searching those is far cheaper."""
    return F.when(F.contains(c, F.lit("://")) | F.contains(c, F.lit("www.")), F.regexp_replace(c, r"https?://\S+|www\.\S+", "")).otherwise(c)


def strip_emails(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("@")), F.regexp_replace(c, r"\S+@\S+", "")).otherwise(c)


def drop_single_chars(c: Column) -> Column:
    """Words of one character go, in one pass that looks at their neighbours and leaves them."""
    return F.regexp_replace(c, rf"(?<!{WORD}){WORD}(?!{WORD})", "")


def _tidy(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, r"\.{2,}", "."), r"\s{3,}", " "))


def remove_boilerplate(c: Column) -> Column:
    return _tidy(fold_if_needed(strip(c), (fixed.SHORT_BOILERPLATE, ""), (fixed.SHORT_MARKERS, ".")))


def remove_long_boilerplate(c: Column) -> Column:
    return _tidy(fold_if_needed(strip(c), (fixed.LONG_BOILERPLATE, ""), (fixed.LONG_MARKERS, ".")))


def normalize_core(c: Column) -> Column:
    """Lower case without links, addresses, punctuation and single characters."""
    c = strip_emails(strip_urls(F.lower(c)))
    c = collapse(F.regexp_replace(c, r"[^\p{L}\p{N}_\s'\-]+", " "))
    return strip(drop_single_chars(c))


def normalize_text(c: Column) -> Column:
    return normalize_core(remove_boilerplate(c))


def clean_text(c: Column) -> Column:
    """The cleaned text column: punctuation goes without a space in its place."""
    c = F.when(c == "nan", "").otherwise(c)
    c = strip_emails(strip_urls(remove_long_boilerplate(c)))
    c = F.lower(fold_if_needed(c, (fixed.EXPORT_AFFIXES, "")))
    c = collapse(F.regexp_replace(c, r"[^\p{L}\p{N}_\s']+", ""))
    return strip(collapse(drop_single_chars(c)))


def late_clean(c: Column) -> Column:
    return strip(fold(c, fixed.LATE_MARKERS))


def combined_text(headline: Column, body: Column, consolidated: Column) -> Column:
    """The texts that are not blank, the consolidated one only if it differs from the body."""
    def some(c: Column) -> Column:
        return F.when(strip(c) != "", strip(c))

    return F.concat_ws(" ", some(headline), some(body), F.when(~consolidated.eqNullSafe(body), some(consolidated)))


def tokens(c: Column, first: int | None = None) -> Column:
    """Word-character runs in order; with `first` only so many, and the text is not split behind them."""
    if first is None:
        return F.filter(F.split(c, rf"{NOT_WORD}+"), lambda w: w != "")
    # a blank may come before the words and the unsplit rest after them
    return F.slice(F.filter(F.split(c, rf"{NOT_WORD}+", first + 2), lambda w: w != ""), 1, first)


def split_multi(c: Column) -> Column:
    """Parts between ; , or |, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(c, r"[;,|]"), strip), lambda w: w != "")


def strip_tags(c: Column) -> Column:
    return strip(collapse(F.regexp_replace(c, r"<[^>]*>", " ")))


def strip_author_prefix(c: Column) -> Column:
    return F.regexp_replace(c, r"(?i)^(by|written by|posted by|author:)\s+", "")


def slug(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "[^a-zA-Z0-9]", "_"))


def title_from_slug(url: Column) -> Column:
    """Last path part with dashes as spaces and words capitalised."""
    return F.initcap(F.regexp_replace(F.element_at(F.split(F.regexp_replace(url, r"/*[?#].*$|/+$", ""), "/"), -1), "-", " "))


def unescape(c: Column) -> Column:
    """XML text without CDATA marks and with its entities resolved."""
    c = F.regexp_replace(c, r"<!\[CDATA\[|\]\]>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def title_case(c: Column) -> Column:
    """Letters after anything but a letter in upper case, the others in lower case."""
    step = F.aggregate(
        F.filter(F.split(F.lower(c), ""), lambda x: x != ""),
        F.struct(F.lit("").alias("out"), F.lit(False).alias("inside")),
        lambda done, x: F.struct(F.concat(done["out"], F.when(done["inside"], x).otherwise(F.upper(x))).alias("out"), x.rlike(r"\p{L}").alias("inside")),
    )
    return step["out"]


def edge_words(c: Column) -> tuple[Column, Column]:
    """First and last word of a text, null if it has none."""
    words = F.filter(F.split(c, r"\s+"), lambda w: w != "")
    return F.get(words, 0), F.get(words, F.size(words) - 1)


def clean_value(c: Column) -> Column:
    """Trimmed; 'nan', 'none' and null are blank."""
    t = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(F.lower(t).isin("nan", "none", ""), "").otherwise(t)


def quoted(s: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}\-&~#])", r"\\\1", s)


def cases(rules: list[tuple[Column, object]], otherwise) -> Column:
    """The value of the first rule that holds."""
    out = F.when(rules[0][0], rules[0][1])
    for test, value in rules[1:]:
        out = out.when(test, value)
    return out.otherwise(otherwise)
