"""Elements of HTML pages cut at their own end, by rules that are rows of a table.

A page is split at its opening angle brackets into an array of tags with the
text behind each. Folds over that array, with a counter of open elements of the
same name, find where an element begins and ends, so containers of one name
inside one another are told apart; elements that are left out are found the same
way inside it. Scripts, styles and comments, which cannot hold one another, go
first. All of it is expressions over arrays in the row: no shuffle, no Python.

A rule names elements by `tag`, `#id`, `.class`, `[attribute="value"]` or several of
these together, and may ask for an ancestor tag before a space.

Edge cases: null pages have no text; an element that is never closed runs to the
end of the page; upper and lower case of tag names are the same, of classes not.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import fixed
from quillmesh.functions.lookup import let
from quillmesh.functions.text import strip_tags

SELECTOR = "struct<under:string,tag:string,id:string,class:string,attribute:string>"
PAIR = "array<struct<a:int,b:int>>"


def selector(text: str) -> tuple:
    """(under, tag, id, class, attribute) of one selector; parts that it doesn't name are null."""
    *under, last = text.split()
    m = re.fullmatch(r"([a-z][a-z0-9]*)?(?:#([\w-]+))?(?:\.([\w-]+))?(?:\[([\w-]+=\"[^\"]*\")\])?", last)
    if m is None or len(under) > 1 or not all(re.fullmatch("[a-z][a-z0-9]*", u) for u in under):
        raise ValueError(f"{text!r} is no selector of this kind")
    return (under[0] if under else None, *m.groups())


def rule_rows(spark: SparkSession, rules: dict[str, tuple[list[str], list[str], int]] | None = None) -> DataFrame:
    """source, containers, noise, longer_than."""
    rows = [(s, [selector(x) for x in c], [selector(x) for x in n], longer) for s, (c, n, longer) in (rules or fixed.BODIES).items()]
    return spark.createDataFrame(rows, f"source string, containers array<{SELECTOR}>, noise array<{SELECTOR}>, longer_than int")


def tags_of(html: Column) -> Column:
    """Array of (name, with a slash if it closes; open, the tag's own text; id; classes, each between blanks; rest, what stands behind the bracket)."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")

    def attribute(text: Column, name: str) -> Column:
        return F.when(F.contains(text, F.lit(f"{name}")), F.regexp_extract(text, rf"""\s{name}\s*=\s*["']([^"']*)["']""", 1)).otherwise("")

    def tag(s: Column) -> Column:
        own = F.substring_index(s, ">", 1)
        name = F.lower(F.regexp_extract(s, r"^(/?[a-zA-Z][a-zA-Z0-9]*)", 1))
        classes = F.concat(F.lit(" "), F.regexp_replace(attribute(own, "class"), r"\s+", " "), F.lit(" "))
        return F.struct(name.alias("name"), own.alias("open"), attribute(own, "id").alias("id"), classes.alias("classes"), s.alias("rest"))

    return F.transform(F.split(F.concat(F.lit(" >"), bare), "<"), tag)


def fits(tag: Column, s: Column) -> Column:
    """Whether an opening tag is what a selector names, its ancestors aside."""

    def either(part: Column, test: Column) -> Column:
        return part.isNull() | test

    return (
        ((tag["name"] != "") & ~F.startswith(tag["name"], F.lit("/")))
        & either(s["tag"], tag["name"] == s["tag"])
        & either(s["id"], tag["id"] == s["id"])
        & either(s["class"], F.contains(tag["classes"], F.concat(F.lit(" "), s["class"], F.lit(" "))))
        & either(s["attribute"], F.contains(tag["open"], s["attribute"]))
    )


def _step(name: Column, of: Column) -> Column:
    """+1 for a tag that opens an element of a name, -1 for one that closes it."""
    return F.when(name == of, 1).when(name == F.concat(F.lit("/"), of), -1).otherwise(0)


def first_of(tags: Column, s: Column) -> Column:
    """The place of the first tag that fits a selector, null if none does."""
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("inside"), F.lit(-1).alias("found"))

    def step(a: Column, t: Column) -> Column:
        now = F.when(s["under"].isNull(), 1).when(a["inside"] == 0, F.when(t["name"] == s["under"], 1).otherwise(0)).otherwise(a["inside"] + _step(t["name"], s["under"]))
        found = F.when((a["found"] < 0) & (s["under"].isNull() | (a["inside"] > 0)) & fits(t, s), a["i"]).otherwise(a["found"])
        return F.struct((a["i"] + 1).alias("i"), now.alias("inside"), found.alias("found"))

    return F.nullif(F.aggregate(tags, start, step)["found"], F.lit(-1))


def end_of(tags: Column, at: Column) -> Column:
    """The place of the tag that closes the element at a place; the number of tags if none does."""
    name = F.get(tags, at)["name"]
    start = F.struct(at.alias("i"), F.lit(0).alias("depth"), F.lit(-1).alias("end"))

    def step(a: Column, t: Column) -> Column:
        depth = a["depth"] + _step(t["name"], name)
        return F.struct((a["i"] + 1).alias("i"), depth.alias("depth"), F.when((a["end"] < 0) & (depth == 0), a["i"]).otherwise(a["end"]).alias("end"))

    end = F.aggregate(F.slice(tags, at + 1, F.size(tags)), start, step)["end"]
    return F.when(end < 0, F.size(tags)).otherwise(end)


def noise_in(tags: Column, noise: Column) -> Column:
    """Pairs of places, first and last, of the outermost elements that fit one of the selectors."""
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("depth"), F.lit("").alias("name"), F.lit(0).alias("since"), F.array().cast(PAIR).alias("cuts"))

    def step(a: Column, t: Column) -> Column:
        begins = (a["depth"] == 0) & F.exists(noise, lambda s: fits(t, s))
        depth = F.when(begins, 1).when(a["depth"] > 0, a["depth"] + _step(t["name"], a["name"])).otherwise(0)
        ends = (a["depth"] > 0) & (depth == 0)
        cuts = F.when(ends, F.array_append(a["cuts"], F.struct(a["since"].alias("a"), a["i"].alias("b")))).otherwise(a["cuts"])
        return F.struct((a["i"] + 1).alias("i"), depth.alias("depth"), F.when(begins, t["name"]).otherwise(a["name"]).alias("name"), F.when(begins, a["i"]).otherwise(a["since"]).alias("since"), cuts.alias("cuts"))

    def finish(a: Column) -> Column:
        return F.when(a["depth"] > 0, F.array_append(a["cuts"], F.struct(a["since"].alias("a"), a["i"].alias("b")))).otherwise(a["cuts"])

    return F.aggregate(tags, start, step, finish)


def without(tags: Column, noise: Column) -> Column:
    """HTML of some tags without the elements that fit one of the selectors."""

    def text(cuts: Column) -> Column:
        kept = F.transform(
            tags,
            lambda t, i: F.when(F.exists(cuts, lambda c: (c["a"] <= i) & (i < c["b"])), "")
            .when(F.exists(cuts, lambda c: c["b"] == i), F.regexp_replace(t["rest"], r"^[^>]*>?", " "))
            .otherwise(F.concat(F.lit("<"), t["rest"])),
        )
        return F.array_join(kept, "")

    return let(noise_in(tags, noise), text)


def inner(tags: Column, s: Column, noise: Column) -> Column:
    """HTML inside the first element that fits a selector, without noise; null if there is none."""

    def cut(at: Column) -> Column:
        return F.when(at.isNotNull(), without(F.slice(tags, at + 1, end_of(tags, at) - at), noise))

    return let(first_of(tags, s), cut)


def _constant(text: str) -> Column:
    names = ("under", "tag", "id", "class", "attribute")
    return F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, selector(text), strict=True)])


def _paragraphs(html: Column, longer_than: Column) -> Column:
    found = F.regexp_extract_all(html, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), F.lit(1))
    return F.array_join(F.filter(F.transform(found, strip_tags), lambda p: F.length(p) > longer_than), "\n\n")


def bodies(pages: DataFrame, rules: DataFrame, container: int = 200, least: int = 100) -> DataFrame:
    """pages (source, html) with body: the first container of the source's rules with more than `container` characters.

    Else the paragraphs of the article, of an element of class article, or of the
    main element. Below `least` characters there is no body; nor for a source
    without rules.
    """
    rows = pages.join(F.broadcast(rules), "source", "left")

    def body(tags: Column) -> Column:
        texts = F.transform(F.col("containers"), lambda s: strip_tags(inner(tags, s, F.col("noise"))))
        parts = [_paragraphs(inner(tags, _constant(s), F.col("noise")), F.col("longer_than")) for s in ("article", ".article", "main")]
        usual = F.coalesce(*[F.nullif(p, F.lit("")) for p in parts])
        return F.coalesce(F.get(F.filter(texts, lambda t: F.length(t) > container), 0), usual)

    found = F.when(F.col("containers").isNotNull(), let(tags_of(F.col("html")), body))
    return rows.select(*pages.columns, found.alias("body")).withColumn("body", F.when(F.length("body") >= least, F.col("body")))
