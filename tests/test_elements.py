"""Elements cut at their own end."""

import pytest
from pyspark.sql import functions as F

from quillmesh.functions import fixed
from quillmesh.functions.lookup import let
from quillmesh.operators import elements


def inside(spark, html, rule, noise=()):
    rules = elements.rule_rows(spark, {"s": ([rule], list(noise), 0)})
    df = spark.createDataFrame([("s", html)], "source string, html string").join(rules, "source")
    cut = let(elements.tags_of(F.col("html")), lambda t: elements.inner(t, F.get("containers", 0), F.col("noise")))
    return df.select(elements.strip_tags(cut).alias("t")).first().t


NESTED = '<div>x<div class="a body b"><div>one<div>two</div></div><nav>n<nav>m</nav>o</nav>three<DIV class="ad">p<div>q</div>r</DIV></div>four</div>five'


def test_own_ends(spark):
    assert inside(spark, NESTED, ".body") == "one two n m o three p q r"
    assert inside(spark, NESTED, ".body", ["nav", ".ad"]) == "one two three"
    assert inside(spark, NESTED, "div.ad") == "p q r"
    assert inside(spark, NESTED, "div") == "x one two n m o three p q r four"
    assert inside(spark, NESTED, ".bod") is None and inside(spark, None, ".body") is None
    assert inside(spark, "<article><div>a</div><div class='content'>b</div></article><div class='content'>c</div>", "article .content") == "b"
    assert inside(spark, "<div class='content'>c</div><article><article></article><div class='content'>b</div></article>", "article .content") == "b"
    assert inside(spark, "<article></article><div class='content'>c</div>", "article .content") is None
    assert inside(spark, '<main><div role="main" id="x">a<p>b', 'div[role="main"]') == "a b"
    assert inside(spark, '<main><div role="main" id="x">a<p>b', "div#x") == "a b"
    assert inside(spark, "<div class='body'><script>if (a<b) '<div>'</script>x<!-- </div> --><br/>y<style></div></style></div>z", ".body") == "x y"
    assert inside(spark, "<div class='body'>x<aside>never closed", ".body", ["aside"]) == "x"
    assert inside(spark, "", ".body") is None


def test_selectors():
    assert elements.selector('article div#a.b[c="d"]') == ("article", "div", "a", "b", 'c="d"')
    for wrong in ("a > b", "a b c", ".a .b", "*"):
        with pytest.raises(ValueError, match="no selector"):
            elements.selector(wrong)
    assert all(elements.selector(s) for c, n, _ in fixed.BODIES.values() for s in [*c, *n]) and set(fixed.BODIES) == {s[0] for s in fixed.SOURCES}


def test_bodies_by_rule(spark):
    long = "word " * 60
    pages = [
        ("PMLive", f"<div class='article-content'>short</div><div class='article-body'><div>{long}</div><div class='ad'>no</div></div>", long.strip()),
        ("PMLive", f"<article><p>{long}</p><p>short</p><p>{long}</p><div class='ad'><p>{long}</p></div></article>", f"{long.strip()}\n\n{long.strip()}"),
        ("BioSpace", f"<main><p>{long}</p></main>", long.strip()),
        ("FDA", "<main><p>too short in all</p></main>", None),
        ("Nobody", f"<article><p>{long}</p></article>", None),
        ("FDA", None, None),
    ]
    df = spark.createDataFrame([(i, s, h) for i, (s, h, _) in enumerate(pages)], "i int, source string, html string")
    got = {r.i: r.body for r in elements.bodies(df, elements.rule_rows(spark)).collect()}
    assert got == {i: b for i, (_, _, b) in enumerate(pages)}
