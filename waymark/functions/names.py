"""Names: folding and cleaning them, what their shape says, and the categories, places and sites that words tell. Columns in, Columns out."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions import lexicons as lex
from waymark.functions.text import clean, has_term, is_blank


@cache
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility form holds one ASCII character, these characters, and those whose form holds several."""
    one, several = {}, {}
    for code in chain(range(0x80, 0xD800), range(0xF900, 0x10000), range(0x1D400, 0x1D800), range(0x1F100, 0x1FC00)):
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one[chr(code)] = plain
        elif plain:
            several[chr(code)] = plain
    return "".join(one), "".join(one.values()), several


def folded(x: Column) -> Column:
    """ASCII form of a text: compatibility decomposition, all else dropped. Characters are translated by tables, in the JVM."""
    old, new, several = fold_tables()
    table = F.from_json(F.lit(json.dumps(several)), "map<string,string>")
    wide = F.array_join(F.transform(F.split(x, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    spread = F.when(x.rlike("[" + "".join(map(re.escape, several)) + "]"), wide).otherwise(x)
    return F.regexp_replace(F.translate(spread, old, new), r"[^\x00-\x7f]", "")


def tokens(x: Column) -> Column:
    """Runs of a-z and 0-9 of the lower-case text."""
    return F.regexp_extract_all(F.lower(x), F.lit("[a-z0-9]+"), F.lit(0))


def words(x: list[str]) -> Column:
    return F.array(*map(F.lit, x))


def meets(x: Column, some: list[str]) -> Column:
    """Whether one of the words is among the tokens x."""
    return F.arrays_overlap(x, words(some))


def holds(x: Column, some: list[str]) -> Column:
    """Whether one of the terms stands anywhere in the lower-case text x."""
    return x.rlike("|".join(re.escape(s) for s in some)) if some else F.lit(False)


def matches(x: Column, patterns: list[str]) -> Column:
    return x.rlike("|".join(f"(?:{p})" for p in patterns))


def stripped(x: Column, signs: str) -> Column:
    return F.regexp_replace(x, f"^[{signs}]+|[{signs}]+$", "")


def cut(x: Column, patterns: list[str], by: str = "") -> Column:
    for p in patterns:
        x = F.regexp_replace(x, p, by)
    return x


def card_name(x: Column) -> Column:
    """Name without a number before it and a site or review behind it."""
    return stripped(cut(clean(F.coalesce(x, F.lit(""))), lex.CARD_CUTS), lex.CARD_STRIP)


def mention_name(x: Column) -> Column:
    """Name as it stands in a list: without a number, an explanation or a year."""
    return stripped(cut(clean(F.coalesce(x, F.lit(""))), lex.MENTION_CUTS), lex.MENTION_STRIP)


def query_name(x: Column) -> Column:
    """Name to ask maps for."""
    return clean(cut(x, lex.QUERY_CUTS))


def search_name(x: Column) -> Column:
    """Name to ask the web for."""
    return stripped(F.regexp_replace(cut(x, lex.SEARCH_CUTS, " "), r"\s+", " "), lex.CARD_STRIP)


def with_city(query: Column, city: str = "Hyderabad") -> Column:
    return F.when(F.contains(F.lower(query), F.lit(city.lower())), query).otherwise(F.concat(query, F.lit(f" {city}")))


# Shapes of lower-case names ------------------------------------------------------------------------------------------


def place_hint(low: Column) -> Column:
    return meets(tokens(low), lex.PLACE_HINTS)


def instruction(low: Column) -> Column:
    """Orders, questions, furniture of pages, and roads."""
    return F.trim(low).isin(lex.INSTRUCTION_NAMES) | matches(low, lex.INSTRUCTIONS)


def collection(low: Column) -> Column:
    """Headings of lists rather than things."""
    ends = low.rlike("(?:" + "|".join(lex.COLLECTION_ENDS) + ")$")
    return matches(low, lex.COLLECTIONS) | (meets(tokens(low), lex.WEAK_HINTS) & F.array_contains(tokens(low), "hyderabad")) | ends


def fragment(low: Column) -> Column:
    """Words of pages without a word of places, and instructions."""
    starts = low.rlike("^(?:" + "|".join(lex.PAGE_STARTS) + ")")
    return (meets(tokens(low), lex.PAGE_TERMS) & ~place_hint(low)) | starts | instruction(low)


def abstract(low: Column, category: Column) -> Column:
    """Topics rather than things, in the categories where they turn up."""
    t = tokens(low)
    topic = meets(t, lex.TOPICS) & (F.size(F.array_distinct(t)) <= 4) & ~place_hint(low)
    return category.isin(lex.TOPIC_CATEGORIES) & (topic | meets(t, lex.ABSTRACT))


def generic_event(low: Column) -> Column:
    return low.rlike(lex.EVENT_NAME) | low.isin(lex.EVENT_NAMES)


def valid_name(x: Column) -> Column:
    """Whether a cleaned name found in a text can be a thing's name."""
    low = F.lower(x)
    w = F.regexp_extract_all(x, F.lit("[A-Za-z0-9]+"), F.lit(0))
    tour = meets(F.transform(w, F.lower), lex.TOUR_WORDS) & ~holds(low, lex.TOUR_HINTS)
    bad = low.rlike(lex.MENTION_LABEL) | low.isin(lex.BAD_MENTIONS) | holds(low, lex.MENTION_NOISE) | low.rlike(lex.MENTION_FILE) | holds(low, lex.ARTICLE_TERMS)
    shape = F.length(x).between(3, 80) & (F.size(w) <= 8) & ((F.size(w) != 1) | low.isin(lex.ONE_WORD_NAMES)) & x.rlike(r"\p{L}") & ~(x.rlike(r"\p{Ll}") & ~x.rlike(r"[\p{Lu}\p{Lt}]"))
    return F.coalesce(shape & ~bad & ~tour, F.lit(False))


# What words tell -----------------------------------------------------------------------------------------------------


def first_of(low: Column, rules: list[tuple[str, list[str]]], otherwise: str) -> Column:
    """The key of the first rule of which a term stands anywhere in the lower-case text."""
    return F.coalesce(*[F.when(holds(low, terms), F.lit(key)) for key, terms in rules], F.lit(otherwise))


def named_category(name: Column, evidence: Column) -> Column:
    return first_of(F.lower(F.concat_ws(" ", name, F.coalesce(evidence, F.lit("")))), lex.NAME_CATEGORIES, "place")


def page_category(title: Column, description: Column, text: Column) -> Column:
    some = [F.coalesce(c, F.lit("")) for c in (title, description, F.substring(text, 1, 2000))]
    hay = F.lower(F.concat_ws(" ", *some))
    return F.coalesce(*[F.when(has_term(hay, terms), F.lit(key)) for key, terms in lex.PAGE_CATEGORIES.items()], F.lit("web_entity"))


def entity_type(category: Column) -> Column:
    return F.when(category.isin("event", "community"), category).otherwise("place")


def named_locality(text: Column, places: list[str], city: str | None = "hyderabad") -> Column:
    """The first of the places that the text names, in title case, else the city."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = [F.when(F.contains(low, F.lit(p)), F.lit(p.title())) for p in places]
    return F.coalesce(*found, *([F.when(F.contains(low, F.lit(city)), F.lit(city.title()))] if city else []))


def title_case(x: Column) -> Column:
    """First letters upper-case, also behind hyphens and other signs."""
    parts = F.regexp_extract_all(F.lower(x), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")


def host(url: Column) -> Column:
    """Host with its port, lower-case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def source_name(url: Column) -> Column:
    """The brand that a url's host holds, else its first label, else web."""
    h = F.replace(host(url), F.lit("www."), F.lit(""))
    brand = F.coalesce(*[F.when(F.contains(h, F.lit(b)), F.lit(b)) for b in lex.BRANDS])
    return F.coalesce(brand, F.nullif(F.substring_index(h, ".", 1), F.lit("")), F.when(h == "", F.lit("web")).otherwise(F.lit("")))


def evidence_tokens(name: Column) -> Column:
    """Distinct tokens of a name that tell it apart."""
    return F.array_distinct(F.filter(tokens(name), lambda t: (F.length(t) > 2) & ~t.isin(lex.EVIDENCE_STOPS)))


def relevant(text: Column) -> Column:
    return holds(F.lower(text), lex.RELEVANT)


def useful_link(text: Column) -> Column:
    """Label and url of a link worth following."""
    low = F.lower(text)
    return holds(low, lex.USEFUL_LINKS) & ~holds(low, lex.BLOCKED_LINKS)


def mentioned_queries(text: Column, most: int = 8, reach: int = 12_000) -> Column:
    """Capitalised phrases that end in a place's name, distinct whatever their case, the first `most` of the first `reach` characters."""
    found = F.transform(F.regexp_extract_all(F.substring(text, 1, reach), F.lit(lex.CITY_QUERY), F.lit(1)), clean)
    first = F.filter(found, lambda v, i: F.array_position(F.transform(found, F.lower), F.lower(v)) == i + 1)
    return F.slice(first, 1, most)


def mention_names(text: Column, reach: int = 30_000) -> Column:
    """Names in list items, bold text, links and before a word of places, in the first `reach` characters."""
    x = F.substring(text, 1, reach)
    return F.concat(*[F.regexp_extract_all(x, F.lit(p), F.lit(1)) for p in lex.MENTIONS])


# Addresses and positions ---------------------------------------------------------------------------------------------


def bad_address(x: Column) -> Column:
    """Too long, full of page furniture, or without city and postal code."""
    low = F.lower(x)
    local = F.contains(low, F.lit("hyderabad")) | F.contains(low, F.lit("telangana")) | low.rlike(r"\b500\d{3}\b")
    return (F.length(x) > 220) | holds(low, lex.ADDRESS_NOISE) | ~local


def valid_address(x: Column) -> Column:
    """No bad address, long enough, and with a word of addresses."""
    return F.coalesce((F.length(x) >= 12) & ~bad_address(x) & F.lower(x).rlike(lex.ADDRESS_SHAPE), F.lit(False))


def address_in(text: Column) -> Column:
    """The address behind a label, else from a word of addresses on; null if what is found first is not valid."""
    found = [F.nullif(stripped(clean(F.regexp_extract(text, p, 1)), " ,;\\-"), F.lit("")) for p in lex.ADDRESSES]
    first = F.coalesce(*found)
    return F.when(valid_address(first), first)


def turned(lat: Column, lon: Column) -> Column:
    """A struct of position in the city's box, turned if only that falls into it; else null."""
    inside = lambda a, b: a.between(17.0, 18.0) & b.between(78.0, 79.0)
    pair = lambda a, b: F.struct(a.alias("lat"), b.alias("lon"))
    return F.when(inside(lat, lon), pair(lat, lon)).when(inside(lon, lat), pair(lon, lat))


def pair_in(x: Column, pattern: str) -> Column:
    at = [F.regexp_extract(x, pattern, i).try_cast("double") for i in (1, 2)]
    return turned(*at)


def position_in_text(x: Column) -> Column:
    return pair_in(x, lex.TEXT_COORDINATES)


def position_in_url(url: Column) -> Column:
    """The first of a url's position parameters, else the first of its position forms, whether that is in the box or not."""
    u = F.url_decode(F.regexp_replace(F.coalesce(url, F.lit("")), r"%(?![0-9A-Fa-f]{2})|\+", ""))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    named = [position_in_text(F.regexp_extract(query, rf"(?:^|&){k}=([^&]*)", 1)) for k in lex.COORDINATE_KEYS]
    formed = F.lit(None).cast("struct<lat: double, lon: double>")
    for p in reversed(lex.URL_COORDINATES):
        formed = F.when(u.rlike(p), pair_in(u, p)).otherwise(formed)
    return F.coalesce(*named, formed)


def number(x: Column) -> Column:
    """A number that may hold commas; null for anything else."""
    return F.replace(F.trim(x), F.lit(","), F.lit("")).try_cast("double")


def whole(x: Column) -> Column:
    return F.when(F.trim(x).rlike(r"^[+-]?[0-9,]+$"), F.replace(F.trim(x), F.lit(","), F.lit("")).try_cast("bigint"))


def known(x: Column) -> Column:
    """Neither null nor empty."""
    return ~is_blank(x)


def joined_url(base: Column, href: Column) -> Column:
    """href against base: absolute ones stay, others take the base's scheme, host or folder; dot segments go; a fragment or query alone keeps the page."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    path = F.regexp_extract(page, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*(/.*)?$", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    h = F.trim(F.coalesce(href, F.lit("")))
    tail = F.regexp_extract(h, r"([?#].*)$", 1)
    target = F.regexp_replace(h, r"[?#].*$", "")
    full = F.when(target.startswith("/"), target).otherwise(F.concat(folder, target))
    parts = F.split(F.regexp_replace(F.regexp_replace(full, r"/\.(?=/)", ""), r"/\.{1,2}$", "$0/"), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, p: F.when(p == ".", a).when(p == "..", F.slice(a, 1, F.greatest(F.lit(1), F.size(a) - 1))).otherwise(F.concat(a, F.array(p))))
    resolved = F.concat(root, F.array_join(kept, "/"), tail)
    return (
        F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), h).when(h == "", base).when(h.startswith("//"), F.concat(scheme, h))
        .when(h.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), h)).when(h.startswith("?"), F.concat(page, h)).otherwise(resolved)
    )
