"""What a page's html holds: links with labels, social links, pictures, headings and names of lists, and where its links lead."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions import lexicons as lex
from waymark.functions.names import host, joined_url, relevant, useful_link
from waymark.functions.text import clean, meta, unescaped

ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a\s*>"
IMAGE = r"(?is)<img\b[^>]*>"


def bare(html: Column) -> Column:
    return clean(unescaped(F.regexp_replace(html, r"(?s)<[^>]*>", " ")))


def attribute(tag: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit(""))


def links(html: Column, base: Column) -> Column:
    """Links in page order: href as it resolves, and the label without tags."""
    tags = F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0))
    return F.transform(tags, lambda t: F.struct(joined_url(base, unescaped(F.regexp_extract(t, ANCHOR, 1))).alias("href"), bare(F.regexp_extract(t, ANCHOR, 2)).alias("label")))


def followed(links_: Column, base: Column, most: int = 20) -> Column:
    """The links worth following, the first `most`: over http, to the same host or of the city, useful and not blocked."""
    def fit(link):
        near = (host(link.href) == host(base)) | relevant(F.concat_ws(" ", link.label, link.href))
        return link.href.rlike("(?i)^https?:") & near & useful_link(F.concat_ws(" ", link.label, link.href))

    return F.slice(F.filter(links_, fit), 1, most)


def social_links(links_: Column) -> Column:
    """site=href of each social site, the last link of each, in the sites' order."""

    def last(site: str) -> Column:
        own = F.filter(links_, lambda link: F.contains(host(link.href), F.lit(site)))
        return F.when(F.size(own) > 0, F.concat(F.lit(site.replace(".com", "") + "="), F.element_at(own, -1).href))

    return F.array_compact(F.array(*map(last, lex.SOCIAL)))


def pictures(html: Column, base: Column) -> Column:
    """Pictures in page order: src as it resolves, alt and title."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(IMAGE), F.lit(0)), lambda t: attribute(t, "src").isNotNull())
    return F.transform(tags, lambda t: F.struct(joined_url(base, attribute(t, "src")).alias("src"), clean(attribute(t, "alt")).alias("alt"), clean(attribute(t, "title")).alias("title")))


def image_urls(html: Column, base: Column, most: int = 20) -> Column:
    """The page's own picture before the first `most` others, each once."""
    own = meta(html, "og:image")
    first = F.when(own.isNotNull(), F.array(joined_url(base, own))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(first, F.slice(F.transform(pictures(html, base), lambda p: p.src), 1, most)))


def list_names(html: Column, longest: int = 100) -> Column:
    """Texts of headings of the second to fourth order and of list items, in page order, up to `longest` characters."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(h2|h3|h4|li)\b[^>]*>(?:.*?)</\1\s*>"), F.lit(0))
    return F.filter(F.transform(tags, bare), lambda n: (F.length(n) <= longest) & (n != ""))
