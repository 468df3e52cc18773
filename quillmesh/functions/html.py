"""Field extraction from HTML with JVM regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.functions import fixed
from quillmesh.functions.text import fold, quoted, strip, strip_tags

#: elements whose content is never article text
NOISE = ["script", "style", "nav", "footer"]
#: containers of article text, the first of enough length counts
CONTAINERS = ["article", "main"]


def without_noise(html: Column) -> Column:
    for tag in NOISE:
        html = F.regexp_replace(html, rf"(?is)<{tag}[^>]*>.*?</{tag}>", " ")
    return html


def element(html: Column, tag: str) -> Column:
    """Text of the first element of a tag, null if it is blank or missing."""
    return F.nullif(strip_tags(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)), F.lit(""))


def meta(html: Column, name: str) -> Column:
    """Content of a meta element by name or property."""
    return F.nullif(F.regexp_extract(html, rf"""(?is)<meta[^>]+(?:name|property)=["']{name}["'][^>]*content=["']([^"']*)["']""", 1), F.lit(""))


def title(html: Column) -> Column:
    return F.coalesce(element(html, "h1"), meta(html, "og:title"), element(html, "title"))


def json_ld(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, r"""(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>""", 1), F.lit(""))


def author(html: Column) -> Column:
    ld = json_ld(html)
    return F.coalesce(meta(html, "author"), meta(html, "citation_author"), F.get_json_object(ld, "$.author.name"), F.get_json_object(ld, "$.author[0].name"), F.get_json_object(ld, "$.author"))


def published(html: Column) -> Column:
    time = F.nullif(F.regexp_extract(html, r"""(?is)<time[^>]*datetime=["']([^"']*)["']""", 1), F.lit(""))
    return F.coalesce(meta(html, "article:published_time"), meta(html, "citation_publication_date"), time, F.get_json_object(json_ld(html), "$.datePublished"))


def language(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, r"""(?i)<html[^>]*lang=["']([^"']+)""", 1), F.lit(""))


def paragraphs(html: Column, longer_than: int = 40) -> Column:
    """Texts of paragraphs with more than so many characters."""
    found = F.regexp_extract_all(without_noise(html), F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), F.lit(1))
    return F.filter(F.transform(found, strip_tags), lambda p: F.length(p) > longer_than)


def body(html: Column, container: int = 200, longer_than: int = 40, least: int = 100) -> Column:
    """The first container that is long enough, else the paragraphs, else the text that the page's metadata holds; null below `least`."""
    bare = without_noise(html)
    found = [strip_tags(F.regexp_extract(bare, rf"(?is)<{tag}\b[^>]*>(.*)</{tag}>", 1)) for tag in CONTAINERS]
    whole = F.coalesce(*[F.when(F.length(t) > container, t) for t in found])
    parts = F.array_join(F.filter(paragraphs(html, longer_than), lambda p: ~is_navigation(p)), "\n\n")
    text = F.coalesce(whole, F.when(parts != "", parts), F.get_json_object(json_ld(html), "$.articleBody"), F.lit(""))
    return F.when(F.length(text) >= least, text)


def is_navigation(paragraph: Column) -> Column:
    """Whether a paragraph begins like a button or a menu."""
    return paragraph.rlike("(?i)^(" + "|".join(fixed.NAVIGATION) + ")")


def without_marketing(text: Column) -> Column:
    """A text without the fixed marketing sentences."""
    return strip(fold(text, fixed.MARKETING, flags="(?i)"))


def without_site(title: Column, site: str) -> Column:
    """A title without the name of its site at the end."""
    return F.regexp_replace(title, rf"(?i)\s*-\s*{quoted(site)}\s*$", "")


def links(html: Column, host: Column) -> Column:
    """href targets in order, once each; those from the root get the host."""
    found = F.regexp_extract_all(html, F.lit(r'href="([^"]+)"'), F.lit(1))
    return F.array_distinct(F.transform(found, lambda u: F.when(F.startswith(u, F.lit("/")), F.concat(host, u)).otherwise(u)))


def paywalled(html: Column) -> Column:
    return F.lower(strip_tags(html)).rlike("|".join(fixed.PAYWALL))


def valid_url(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^https?://[^/\s]+"), F.lit(False))


def clean_url(url: Column) -> Column:
    u = F.trim(url)
    return F.when(F.startswith(u, F.lit("//")), F.concat(F.lit("https:"), u)).when(u.rlike("^https?://"), u).otherwise(F.concat(F.lit("https://"), u))


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)


def robots_delay(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(?im)^crawl-delay:\s*([0-9.]+)", 1), F.lit("")).cast("double")


def robots_sitemaps(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?im)^sitemap:\s*(\S+)"), F.lit(1))
