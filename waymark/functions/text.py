"""Text, identity, extraction and HTML expressions: Columns in, Columns out, all inside the JVM unless said."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions import lexicons as lex


def is_blank(x: Column) -> Column:
    """Null and empty are one class."""
    return x.isNull() | (x == "")


def clean(x: Column) -> Column:
    """Runs of Unicode white space as one blank, trimmed."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def folded(x: Column) -> Column:
    """ASCII form of accented text."""
    from waymark.functions import names  # which reads this module

    return names.folded(x)


def plain(x: Column) -> Column:
    """Lower-case words of letters and digits, accents and other marks folded."""
    return F.trim(F.lower(F.regexp_replace(folded(F.coalesce(x, F.lit(""))), "[^a-zA-Z0-9]+", " ")))


def fingerprint(x: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(x), "[^a-z0-9]+", ""), F.lit(""))


def slug(x: Column, joint: str = "_") -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", joint), f"^{joint}+|{joint}+$", "")


def grid(lat: Column, lon: Column, digits: int = 4) -> Column:
    return F.concat(F.round(lat, digits).cast("string"), F.lit(":"), F.round(lon, digits).cast("string"))


def entity_id(name: Column, locality: Column, lat: Column, lon: Column, padded: bool = False) -> Column:
    """Slug of the name and 12 digits of a hash of name, place and rounded position; padded: positions always with four digits."""
    where = F.when(lat.isNotNull() & lon.isNotNull(), F.format_string("%.4f:%.4f", F.round(lat, 4), F.round(lon, 4)) if padded else grid(lat, lon))
    seed = F.concat_ws("|", F.nullif(plain(name), F.lit("")), F.nullif(plain(locality), F.lit("")), where)
    head = F.substring(F.replace(plain(name), F.lit(" "), F.lit("-")), 1, 48)
    return F.concat(F.coalesce(F.nullif(head, F.lit("")), F.lit("entity")), F.lit("-"), F.substring(F.sha1(seed), 1, 12))


def signal_id(source: Column, text: Column, url: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", source, F.coalesce(url, F.lit("")), F.substring(plain(text), 1, 400))), 1, 16)


def bounded(term: str) -> str:
    """Pattern of a term with no letter or digit on either side."""
    import re

    return rf"(?<![a-z0-9]){re.escape(term)}(?![a-z0-9])"


def has_term(x: Column, terms: list[str]) -> Column:
    return F.lower(x).rlike("|".join(bounded(t) for t in terms))


def _parts(term: str) -> list[str]:
    import re

    return re.findall("[a-z0-9]+", term)


def matched(x: Column, terms: list[str], told: Callable[[Callable[[str], Column]], Column]) -> Column:
    """told(count), where count(term) is the number of non-overlapping hits of a term at word boundaries, in one pass over the text.

    The text becomes its runs of letters and digits once, of which those that stand in a term are kept. A term of one run is counted among
    these; the text is searched only for a term of several, all of whose runs are there.
    """
    words = sorted({w for t in terms for w in _parts(t)})
    bound = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))  # noqa: E731  the value is computed once

    def body(low: Column, some: Column) -> Column:
        def count(term: str) -> Column:
            parts = _parts(term)
            if parts == [term]:
                return F.size(F.filter(some, lambda w: w == term))
            there = F.size(F.array_except(F.array(*map(F.lit, parts)), some)) == 0 if parts else F.lit(True)
            return F.when(there, F.when(F.contains(low, F.lit(term)), F.regexp_count(low, F.lit(bounded(term)))).otherwise(0)).otherwise(0)

        return told(count)

    return bound(F.lower(x), lambda low: bound(F.filter(F.split(low, "[^a-z0-9]+"), lambda w: w.isin(words)), lambda some: body(low, some)))


def term_count(x: Column, terms: list[str]) -> Column:
    """Non-overlapping hits of all terms, each counted alone."""
    return matched(x, terms, lambda count: reduce(lambda a, b: a + b, map(count, terms)))


def tag_sets(x: Column, sets: dict[str, dict[str, list[str]]]) -> Column:
    """A struct with the tags of each set of rules, all found in one pass over the text."""

    def told(count: Callable[[str], Column]) -> Column:
        there = lambda terms: reduce(lambda a, b: a | b, [count(t) > 0 for t in terms])
        return F.struct(*[F.array_compact(F.array(*[F.when(there(terms), F.lit(tag)) for tag, terms in rules.items()])).alias(name) for name, rules in sets.items()])

    return matched(x, [t for rules in sets.values() for terms in rules.values() for t in terms], told)


def tags(x: Column, rules: dict[str, list[str]]) -> Column:
    """Keys of the rules of which a term is found, in the rules' order."""
    return tag_sets(x, {"tags": rules})["tags"]


def keyword_score(x: Column, terms: list[str]) -> Column:
    hits = sum((has_term(x, [t]).cast("int") for t in terms), F.lit(0))
    return F.round(F.least(F.lit(1.0), F.lit(0.35) + F.lit(0.15) * hits), 3)


def substring_sentiment(x: Column, positive: list[str], negative: list[str]) -> Column:
    """(p - n) / (p + n) of substring counts, 0 without any."""
    count = lambda terms: sum(((F.length(F.lower(x)) - F.length(F.replace(F.lower(x), F.lit(t), F.lit("")))) / F.lit(len(t)) for t in terms), F.lit(0.0))
    p, n = count(positive), count(negative)
    return F.when(p + n == 0, F.lit(0.0)).otherwise(F.round((p - n) / (p + n), 3))


def sentences(x: Column, least: int = 40) -> Column:
    """Parts after . ! or ? and white space that are longer than `least`, trimmed."""
    parts = F.split(F.regexp_replace(x, r"([.!?])\s+", "$1\u0001"), "\u0001")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: F.length(s) > least)


def keywords(x: Column, most: int = 16) -> Column:
    """First distinct words of three characters or more that are no stop words."""
    found_ = F.regexp_extract_all(F.lower(x), F.lit(r"[a-z][a-z0-9_-]{2,}"), F.lit(0))
    return F.slice(F.array_distinct(F.filter(found_, lambda w: ~w.isin(lex.KEYWORD_STOPS))), 1, most)


def review_signals(entity: Column, x: Column, most: int = 12) -> Column:
    """id, idx and text of the first sentences longer than 40 characters that hold a cue; idx counts all such sentences, as the id does."""
    parts = F.filter(F.split(x, r"(?U)(?<=[.!?])\s+"), lambda s: F.length(F.regexp_replace(s, r"(?U)^\s+|\s+$", "")) > 40)
    each = F.transform(parts, lambda s, i: F.struct(i.alias("idx"), clean(s).alias("text")))
    cued = F.slice(F.filter(each, lambda r: F.lower(r.text).rlike("|".join(lex.SIGNAL_CUES))), 1, most)
    named = lambda r: F.substring(F.sha2(F.concat_ws(":", entity.cast("string"), r.idx.cast("string"), r.text), 256), 1, 16)
    return F.transform(cued, lambda r: F.struct(named(r).alias("id"), r.idx.alias("idx"), r.text.alias("text")))


def source_page(title_: Column, text: Column, url: Column) -> Column:
    """Whether a page is a list or an article: one of the terms anywhere in title, text and url, a top or best number, or three numbered items."""
    some = lambda c: F.coalesce(c, F.lit(""))
    hay = F.lower(clean(F.concat_ws(" ", some(title_), F.substring(some(text), 1, 3000), some(url))))
    items = F.regexp_count(F.substring(some(text), 1, 8000), F.lit(r"(?U)\b\d{1,2}\.\s+[A-Z]"))
    return (hay != "") & (hay.rlike("|".join(lex.ARTICLE_TERMS)) | hay.rlike(r"(?U)\b(?:top|best)\s+\d{1,3}\b") | (items >= 3))


def found(x: Column, pattern: str) -> Column:
    """Sorted distinct matches."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit(pattern), F.lit(0))))


def prices(x: Column) -> Column:
    amounts = F.regexp_extract_all(F.lower(x), F.lit(r"(?:₹|rs\.?)\s*([0-9][0-9,]{1,6})"), F.lit(1))
    return F.transform(amounts, lambda a: F.replace(a, F.lit(","), F.lit("")).try_cast("int"))


def price_level(amount: Column) -> Column:
    return F.when(amount == 0, "free").when(amount <= 300, "budget").when(amount <= 1200, "mid").when(amount <= 3000, "premium").when(amount.isNotNull(), "luxury")


def date_hint(x: Column) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(F.lower(x), p, 0), F.lit("")) for p in lex.DATE_PATTERNS])


def rating(x: Column) -> Column:
    return F.regexp_extract(F.lower(x), r"\b([1-5](?:\.\d)?)\s*(?:/|out of)\s*5\b", 1).try_cast("double")


def coordinates(x: Column) -> Column:
    """First of @lat,lon and !3dlat!4dlon as a struct; swapped pairs are turned when only that falls into the box."""
    at = F.regexp_extract(x, r"@(-?\d+\.\d+),(-?\d+\.\d+)", 1), F.regexp_extract(x, r"@(-?\d+\.\d+),(-?\d+\.\d+)", 2)
    bang = F.regexp_extract(x, r"!3d(-?\d+\.\d+)!4d(-?\d+\.\d+)", 1), F.regexp_extract(x, r"!3d(-?\d+\.\d+)!4d(-?\d+\.\d+)", 2)
    lat, lon = (F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit(""))).try_cast("double") for a, b in zip(at, bang))
    inside = lambda a, b: a.between(17, 18) & b.between(78, 79)
    return F.when(inside(lat, lon), F.struct(lat.alias("lat"), lon.alias("lon"))).when(inside(lon, lat), F.struct(lon.alias("lat"), lat.alias("lon")))


def evidence_window(x: Column, name: Column, most: int = 1000, before: int = 350, after: int = 650) -> Column:
    """First line that holds the name and more than white space, at most `most` characters; else the text around the name's first place; else empty."""
    lines = F.transform(F.split(x, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), clean)
    line = F.get(F.filter(lines, lambda s: F.contains(F.lower(s), F.lower(name)) & (s != "")), F.lit(0))
    at = F.instr(F.lower(x), F.lower(name))
    start = F.greatest(F.lit(1), at - before)
    around = F.when(at > 0, clean(F.substring(x, start, at + F.length(name) + after - start)))
    return F.coalesce(F.substring(line, 1, most), around, F.lit(""))


def unescaped(x: Column) -> Column:
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(sign))
    return x


def visible_text(html: Column) -> Column:
    """Text without scripts, styles and tags, white space collapsed."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|noscript|svg)[^>]*>.*?</(script|style|noscript|svg)>", " ")
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(bare, r"(?s)<[^>]*>", " ")), r"[ \t\r\n\f]+", " "))


def title(html: Column) -> Column:
    """og:title, else title, else first h1."""
    inside = lambda p: F.nullif(F.trim(F.regexp_replace(unescaped(F.regexp_extract(html, p, 1)), r"[ \t\r\n\f]+", " ")), F.lit(""))
    return F.coalesce(inside(r'(?is)<meta[^>]*property="og:title"[^>]*content="([^"]*)"'), inside(r"(?is)<title[^>]*>(.*?)</title>"), inside(r"(?is)<h1[^>]*>(.*?)</h1>"))


def meta(html: Column, name: str) -> Column:
    return F.coalesce(*[F.nullif(clean(unescaped(F.regexp_extract(html, rf'(?is)<meta[^>]*{a}="{name}"[^>]*content="([^"]*)"', 1))), F.lit("")) for a in ("property", "name")])


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'(?i)<a[^>]*href="([^"]*)"'), F.lit(1))


def headings(html: Column, most: int = 30) -> Column:
    found_ = F.regexp_extract_all(html, F.lit(r"(?is)<h[1-3][^>]*>(.*?)</h[1-3]>"), F.lit(1))
    return F.slice(F.transform(found_, lambda h: clean(F.regexp_replace(h, "<[^>]*>", ""))), 1, most)


def images(html: Column, most: int = 20) -> Column:
    return F.slice(F.array_distinct(F.regexp_extract_all(html, F.lit(r'(?i)<img[^>]*src="([^"]*)"'), F.lit(1))), 1, most)


def domain(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/:?#]+)", 1))


def json_ld(html: Column) -> Column:
    """Objects of ld+json scripts, with @graph members beside them, as variants; bad JSON is skipped."""
    blocks = F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))
    return F.filter(F.transform(blocks, lambda b: F.try_parse_json(b)), lambda v: v.isNotNull())


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6_371_000.0) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * radius) * F.atan2(F.sqrt(a), F.sqrt(1 - a))
