"""Queries of the remaining operators, each by the library's function over a whole table, with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.functions import documents as dc
from waymark.functions import lexicons as lex
from waymark.functions import names as nm
from waymark.functions import pages as pg
from waymark.functions import text as tx
from waymark.operators import quality as ql
from waymark.operators import refine as rf
from waymark.operators import tables as tb
from waymark.plans.fixtures import CANDIDATES, MAP_ELEMENTS, NAMES, PHRASES, SITES, TEXTS, WEB_PAGES, any_in, any_match, bounded_any, candidates, chain, doubled, first_case, keys_where, map_elements, pick, quoted, served, sidecars, sql_list, sql_pick, texts, web_pages
from waymark.plans.registry import query
from waymark.plans.views import ENTITIES, FRONTIER, entities, frontier, metres, table

CLEAN = "trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def strip_sql(x: str, signs: str) -> str:
    return chain(x, [(f"^[{signs}]+|[{signs}]+$", "", "g")])


# Names ---------------------------------------------------------------------------------------------------------------

_FOLD = "trim(lower(regexp_replace(regexp_replace(strip_accents({x}), '[^\\x00-\\x7f]', '', 'g'), '[^a-zA-Z0-9]+', ' ', 'g')))"
#: DuckDB has no compatibility folding: the wide, ligature and numeral characters of the names are spelled out.
_WIDE = "replace(replace(replace(replace(replace(replace(replace(replace(name, 'Ｆ', 'F'), 'ｕ', 'u'), 'ｌ', 'l'), 'Ⅳ', 'IV'), '½', '12'), 'ﬁ', 'fi'), 'ü', 'u'), 'É', 'E')"


@query(CANDIDATES + f""", n as (select id, {_FOLD.format(x=_WIDE)} as normalized, {_FOLD.format(x="coalesce(locality, '')")} as place, latitude as a, longitude as o, name, website from p)
select id, normalized, case when normalized = '' then 'entity' else substr(replace(normalized, ' ', '-'), 1, 48) end || '-' || substr(sha1(concat_ws('|', nullif(normalized, ''), nullif(place, ''), case when a is not null then round(a, 4)::varchar || ':' || round(o, 4)::varchar end)), 1, 12) as entity_key,
 substr(sha1('web|' || coalesce(website, '') || '|' || substr(normalized, 1, 400)), 1, 16) as signal_key from n""")
def normalized_names(spark, sf):
    """N1 with accents, wide letters, ligatures and numerals; N2 and N3 over it."""
    c, col = candidates(spark, sf), F.col
    return c.select("id", tx.plain(col("name")).alias("normalized"), tx.entity_id(col("name"), col("locality"), col("latitude"), col("longitude")).alias("entity_key"), tx.signal_id(F.lit("web"), col("name"), col("website")).alias("signal_key"))


_CARD = strip_sql(chain(CLEAN.format(x="name"), [(p, "", "") for p in lex.CARD_CUTS]), lex.CARD_STRIP)
_MENTION = strip_sql(chain(CLEAN.format(x="name"), [(p, "", "") for p in lex.MENTION_CUTS]), lex.MENTION_STRIP)
_ASKED = CLEAN.format(x=chain("name", [(p, "", "") for p in lex.QUERY_CUTS]))
_SEARCHED = strip_sql(chain("name", [(p, " ", "g") for p in lex.SEARCH_CUTS] + [(r"\s+", " ", "g")]), lex.CARD_STRIP)


@query(CANDIDATES + f"select id, {_CARD} as card_name, {_MENTION} as mention_name, {_ASKED} as query_name, {_SEARCHED} as search_name, case when contains(lower(name), 'hyderabad') then name else name || ' Hyderabad' end as city_query from p")
def cleaned_names(spark, sf):
    n = F.col("name")
    return candidates(spark, sf).select("id", nm.card_name(n).alias("card_name"), nm.mention_name(n).alias("mention_name"), nm.query_name(n).alias("query_name"), nm.search_name(n).alias("search_name"), nm.with_city(n).alias("city_query"))


def _has(x: str, words: list[str]) -> str:
    return f"list_has_any({x}, {sql_list(words)})"


_INSTRUCTION = f"(trim(low) in ({', '.join(map(quoted, lex.INSTRUCTION_NAMES))}) or {any_match('low', lex.INSTRUCTIONS)})"
_SHAPES = CANDIDATES + f""", w as (select *, lower(trim(name)) as low, regexp_extract_all(lower(trim(name)), '[a-z0-9]+') as t, lower(trim(coalesce(nullif(primary_category, ''), category, ''))) as cat, list_distinct(source_names) as src from p),
s as (select *, len(t) as n_words, {_has("t", lex.PLACE_HINTS)} as hint, {_INSTRUCTION} as instruction,
  ({any_match("low", lex.COLLECTIONS)} or ({_has("t", lex.WEAK_HINTS)} and list_contains(t, 'hyderabad')) or {" or ".join(f"suffix(low, {quoted(e)})" for e in lex.COLLECTION_ENDS)}) as collection,
  (regexp_matches(low, {quoted(lex.EVENT_NAME)}) or low in ({", ".join(map(quoted, lex.EVENT_NAMES))})) as event_name,
  coalesce(website, '') <> '' or has_contact or has_social as reachable, list_contains(source_types, 'source_page_mention') and len(list_distinct(source_names)) = 1 as single,
  latitude is not null and longitude is not null as placed, coalesce(address, '') <> '' as addressed, coalesce(locality, '') <> '' as local_, {_has("src", lex.OPEN_SOURCES)} as open_ from w),
f as (select *, (({_has("t", lex.PAGE_TERMS)} and not hint) or {" or ".join(f"starts_with(low, {quoted(p)})" for p in lex.PAGE_STARTS)} or instruction) as fragment,
  (cat in ({", ".join(map(quoted, lex.TOPIC_CATEGORIES))}) and (({_has("t", lex.TOPICS)} and len(list_distinct(t)) <= 4 and not hint) or {_has("t", lex.ABSTRACT)})) as abstract,
  single and coalesce(geo_precision = 'geocoded', false) and not reachable and not hint and not event_known as geo_only from s)
"""
_WORDS = "regexp_extract_all({x}, '[A-Za-z0-9]+')"
_VALID = f"""(length(n) between 3 and 80 and len({_WORDS.format(x="n")}) <= 8 and (len({_WORDS.format(x="n")}) <> 1 or lower(n) in ({", ".join(map(quoted, lex.ONE_WORD_NAMES))})) and regexp_matches(n, '\\p{{L}}') and lower(n) <> n
 and not regexp_matches(lower(n), {quoted(lex.MENTION_LABEL)}) and lower(n) not in ({", ".join(map(quoted, lex.BAD_MENTIONS))}) and not {any_in("lower(n)", lex.MENTION_NOISE)} and not regexp_matches(lower(n), {quoted(lex.MENTION_FILE)})
 and not {any_in("lower(n)", lex.ARTICLE_TERMS)} and not (list_has_any(list_transform({_WORDS.format(x="n")}, lambda v: lower(v)), {sql_list(lex.TOUR_WORDS)}) and not {any_in("lower(n)", lex.TOUR_HINTS)}))"""


@query(_SHAPES + f", v as (select *, {_MENTION} as n from f) select id, hint, instruction, collection, fragment, abstract, event_name, {_VALID} as valid_name from v")
def name_shapes(spark, sf):
    low = rf.low_name()
    rows = candidates(spark, sf).withColumn("n", nm.mention_name(F.col("name")))
    return rows.select("id", nm.place_hint(low).alias("hint"), nm.instruction(low).alias("instruction"), nm.collection(low).alias("collection"), nm.fragment(low).alias("fragment"), nm.abstract(low, rf.own_category()).alias("abstract"),
                       nm.generic_event(low).alias("event_name"), nm.valid_name(F.col("n")).alias("valid_name"))


_NO_CARD = f"cat in ({', '.join(map(quoted, lex.NO_CARDS))})"
_STRONG = f"""case when geo_only or (single and latitude is null and not addressed and not reachable and not event_known) then false when placed and addressed then true when open_ and not {_NO_CARD} then true
 when coalesce(website, '') <> '' and not collection then true when has_contact or has_social then true when event_known or community_known then not collection else hint and (local_ or addressed or has_media) end"""
_REJECT = {
    "empty_or_short_name": "length(low) < 3", "non_card_map_infrastructure": _NO_CARD, "instruction_article_or_page_furniture": "instruction", "bad_fragment_geocoded_from_page_text": "geo_only and (n_words <= 3 or abstract or collection)",
    "sentence_like_page_mention_without_location": "single and n_words > 6 and not addressed and latitude is null", "collection_or_search_result_heading": "collection and not strong", "abstract_topic_not_entity": "abstract and not strong",
    "generic_event_or_topic_name": "event_name and not strong",
}
_WEIGH = {
    "long_phrase_name": "n_words > 8", "page_or_navigation_phrase": "fragment", "field_label_extracted_as_name": "regexp_matches(low, '^(?:address:|timings:|entry fee)')", "question_title": "contains(low, '?')",
    "real_entity_name_hint": "hint", "strong_identity_evidence": "strong", "specific_category": "coalesce(category, '') <> '' and category not in ('place', 'web_entity')", "has_locality": "local_", "has_address": "addressed",
    "has_coordinates": "placed", "has_media": "has_media", "has_website": "coalesce(website, '') <> ''", "trusted_structured_source": "open_", "single_source_page_mention": "single", "single_generic_token": "n_words = 1 and not hint",
    "generic_collection_heading": "collection",
}
_SUM = " + ".join(["0.0::double"] + [f"case when {c} then {lex.DECISION_WEIGHTS[k]}::double else 0.0::double end" for k, c in _WEIGH.items()])
_DECIDED = _SHAPES + f""", g as (select *, {_STRONG} as strong from f),
d as (select *, case {" ".join(f"when {c} then {quoted(k)}" for k, c in _REJECT.items())} end as reject, greatest(0.0::double, least(1.0::double, 0.45::double + ({_SUM}))) as raw, single and not strong and not hint as thin from g),
e as (select *, case when thin then least(raw, 0.59::double) else raw end as score from d),
decided as (select *, case when reject is not null or score < 0.42::double then 'reject_page_fragment' when score < 0.72::double or not strong then 'needs_enrichment' else 'serve' end as decision,
  round(coalesce(map {{{", ".join(f"{quoted(k)}: {v}::double" for k, v in lex.REJECT_SCORES.items())}}}[reject], score), 3) as decision_score,
  case when reject is not null then [reject] else {keys_where(_WEIGH | {"insufficient_identity_for_single_page_mention": "thin"})} end as decision_reasons from e)
"""


@query(_DECIDED + "select id, decision, decision_score, decision_reasons, strong as strong_identity from decided")
def entity_decisions(spark, sf):
    """Every rejection, weight and rule of identity."""
    return rf.decided(candidates(spark, sf)).select("id", "decision", "decision_score", "decision_reasons", "strong_identity")


_GATED = f"""not {_NO_CARD} and not collection and not instruction"""


@query(_DECIDED + f"""select id, case when decision <> 'reject_page_fragment' and {_GATED} and (strong or (hint and local_)) and not (placed and addressed) and not fragment
   then array_to_string(list_filter([trim(name), nullif(locality, ''), case when trim(name) <> 'Hyderabad' and coalesce(locality, '') <> 'Hyderabad' then 'Hyderabad' end, 'Telangana', 'India'], lambda x: x is not null), ', ') end as geocode_query,
  {_GATED} and status <> 'REJECTED_PAGE_FRAGMENT' and placed and addressed and (strong or hint) as wants_image from decided""")
def geocode_gates(spark, sf):
    return rf.geocode_gate(rf.decided(candidates(spark, sf))).select("id", "geocode_query", "wants_image")


@query()
def refined_entities(spark, sf):
    """P32 with geocoder answers for every third candidate; tests hold it against plain Python."""
    c = candidates(spark, sf)
    answers = c.where("id % 3 = 0").selectExpr("id", "17.4D as latitude", "78.4D as longitude", "if(id % 2 = 0, 'Uppal', null) as locality", "concat(cast(id as string), ' Main Road, Hyderabad') as address")
    return rf.refined(c, answers).select("id", "name", "address", "latitude", "longitude", "locality", "geo_precision", "decision", "decision_score", "status", "needs_human_review", "review_reason")


_TITLES = ["Lotus Pond", "Golconda Fort, Telangana", "Charminar", "Blue", "Old Fort", None, "Café"]
_EXTRACTS = ["a place in hyderabad", "a lake far off", None]


def _own(stops: list[str], least: int = 2) -> str:
    return f"list_distinct(list_filter(regexp_extract_all(lower(name), '[a-z0-9]+'), lambda v: length(v) > {least} and not list_contains({sql_list(stops)}, v)))"


@query(CANDIDATES + f""", a as (select id, {_own(lex.IMAGE_STOPS)} as own, coalesce(regexp_extract_all(lower({sql_pick(_TITLES, "id")}), '[a-z0-9]+'), []) as title, coalesce(regexp_extract_all(lower({sql_pick(_EXTRACTS, "id")}), '[a-z0-9]+'), []) as said from p),
h as (select *, len(list_intersect(own, title)) as hits from a)
select id, len(own) > 0 and (hits >= least(2, len(own)) or (hits > 0 and list_has_any(said, ['hyderabad', 'telangana', 'india']))) as matches from h""")
def image_page_matches(spark, sf):
    some = lambda x: F.coalesce(x, F.lit(""))
    return candidates(spark, sf).select("id", rf.image_page_matches(F.col("name"), some(pick(_TITLES, "id")), some(pick(_EXTRACTS, "id"))).alias("matches"))


_SOURCE_LIKE = f"""case when lower(trim(name)) in ({", ".join(map(quoted, lex.BAD_NAMES))}) then true when extraction_mode = 'mentioned_entity' then false when latitude is not null and longitude is not null then false
 else {any_match("lower(trim(name))", lex.SOURCE_LIKE)} end"""
_RECOMMENDABLE = f"""(status <> 'REJECTED_PAGE_FRAGMENT' and lower(trim(name)) <> '' and cat <> '' and cat not in ({", ".join(map(quoted, lex.NON_SERVING))})
 and not (contains(cat, ' hyderabad') and cat not in ('hyderabad', 'secunderabad')) and not {any_match("lower(trim(name))", lex.NON_SERVING_NAMES)} and lower(trim(name)) not in ({", ".join(map(quoted, lex.STRAY_NAMES))}))"""


@query(_SHAPES + f"select id, {_SOURCE_LIKE} as source_like, {_RECOMMENDABLE} as recommendable from f")
def title_rules(spark, sf):
    """P7 and P8 with mentions, status, categories and stray names."""
    c, col = candidates(spark, sf), F.col
    like = ql.source_like(col("name"), col("latitude"), col("longitude"), col("extraction_mode"))
    return c.select("id", like.alias("source_like"), ql.recommendable(col("name"), rf.own_category(), col("status")).alias("recommendable"))


_BASE = f"({_ASKED} || ' ' || coalesce(nullif(locality, ''), 'Hyderabad'))"
_MISSING = keys_where({"address": "not addressed", "image": "not has_media", "latitude": "latitude is null", "locality": "not local_", "longitude": "longitude is null"})
_QUERIES = f"""case when {_SOURCE_LIKE} or not {_RECOMMENDABLE} then []::varchar[] else list_filter([case when latitude is null then {_BASE} || ' exact location' end, case when latitude is null then {_BASE} || ' address' end,
 case when not addressed then {_BASE} || ' address timings' end, case when not has_media then {_BASE} || ' photos' end, case when not has_media then {_BASE} || ' images' end], lambda x: x is not null) end"""


@query(_SHAPES + f", q as (select id, unnest({_QUERIES}) as query from f) select id, query, source, priority from q, (values ('openstreetmap', 0.9::double), ('firecrawl_search', 0.7::double)) s(source, priority)")
def gap_candidates(spark, sf):
    """The queries for each gap of what may be enriched, for each source that is asked."""
    c, col = candidates(spark, sf), F.col
    missing = dc.listed({"address": ~rf.has("address"), "image": ~F.col("has_media"), "latitude": col("latitude").isNull(), "longitude": col("longitude").isNull()})
    like = ql.source_like(col("name"), col("latitude"), col("longitude"), col("extraction_mode"))
    blocked = dc.listed({"source_or_article_title": like, "not_recommendation_entity": ~ql.recommendable(col("name"), rf.own_category(), col("status"))})
    rows = c.withColumns({"missing": missing, "blockers": blocked})
    return ql.gap_candidates(rows.withColumn("queries", rf.gap_queries(col("name"), col("locality"), col("missing"), col("blockers"), col("address"))))


_CORE = f"concat_ws(' ', nullif({_SEARCHED}, ''), case when lower(locality) <> 'hyderabad' then nullif(locality, '') end, 'Hyderabad')"


@query(CANDIDATES + f"select id, list_filter([{_CORE} || ' address latitude longitude', case when category = 'restaurant' then {_CORE} || ' restaurant address menu' end, {_CORE} || ' Zomato', {_CORE} || ' Google Maps', {_CORE} || ' photos'], lambda x: x is not null) as queries from p")
def web_search_queries(spark, sf):
    return candidates(spark, sf).select("id", rf.web_queries(F.col("name"), F.col("locality"), F.col("category")).alias("queries"))


_NAMED = f"lower(name || ' ' || {sql_pick(PHRASES, 'id')})"


@query(CANDIDATES + f"""select id, {first_case([(k, any_in(_NAMED, t)) for k, t in lex.NAME_CATEGORIES], "place")} as named_category,
 coalesce({", ".join(f"case when contains(lower({sql_pick(PHRASES, 'id')}), {quoted(x)}) then {quoted(x.title())} end" for x in lex.LOCALITIES)}) as named_locality,
 list_sort(list_distinct(list_filter(regexp_extract_all(lower(name), '[a-z0-9]+'), lambda v: length(v) > 2 and not list_contains({sql_list(lex.EVIDENCE_STOPS)}, v)))) as own_tokens,
 list_sort(list_distinct(list_filter(regexp_extract_all(lower(name), '[a-z][a-z0-9_-]{{2,}}'), lambda v: not list_contains({sql_list(lex.KEYWORD_STOPS)}, v)))) as keywords from p""")
def named_things(spark, sf):
    """Words are compared as sorted sets; no name has more than sixteen."""
    n, said = F.col("name"), pick(PHRASES, "id")
    return candidates(spark, sf).select("id", nm.named_category(n, said).alias("named_category"), nm.named_locality(said, lex.LOCALITIES, None).alias("named_locality"), F.array_sort(nm.evidence_tokens(n)).alias("own_tokens"), F.array_sort(tx.keywords(n)).alias("keywords"))


_HOST = "replace(lower(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1)), 'www.', '')"


@query(f"""with u as (select c_custkey as id, {sql_pick(SITES, "c_custkey")} as url from customer), h as (select *, {_HOST} as h from u)
select id, case {" ".join(f"when contains(h, {quoted(b)}) then {quoted(b)}" for b in lex.BRANDS)} when h = '' then 'web' else coalesce(split_part(h, '.', 1), '') end as source_name, coalesce({any_in("lower(url)", lex.BLOCKED_URLS)}, false) as blocked from h""")
def source_names(spark, sf):
    u = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), pick(SITES, "c_custkey").alias("url"))
    return u.select("id", nm.source_name(F.col("url")).alias("source_name"), F.coalesce(nm.holds(F.lower("url"), lex.BLOCKED_URLS), F.lit(False)).alias("blocked"))


# Documents -----------------------------------------------------------------------------------------------------------


def _one(x: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({x}, {quoted(pattern)}, {group}), '')"


def _number(x: str) -> str:
    return f"try_cast(replace({x}, ',', '') as bigint)"


_EMAILS, _PHONES = (f"list_sort(list_distinct(regexp_extract_all(text, {quoted(p)})))" for p in (r"[0-9A-Za-z_.+-]+@[0-9A-Za-z_-]+\.[0-9A-Za-z_.-]+", r"(?:\+91[-\s]?)?[6-9][0-9]{9}"))
_PLACE = "coalesce(" + ", ".join(f"case when contains(low, {quoted(x)}) then {quoted(x.title())} end" for x in lex.LOCALITIES) + ")"


def documents_with(spark, sf, *blocks):
    """The texts' collapsed form, and the blocks' columns over it."""
    t = texts(spark, sf).select("doc_id", tx.clean(F.col("text")).alias("text"))
    return plainly(t.select("doc_id", *[c.alias(k) for b in blocks for k, c in b(F.col("text")).items()]), "doc_id")


def plainly(df, *keys: str):
    """Booleans as text and whole numbers as doubles, but for the keys: both may be null, and then engines return them differently."""
    kinds = {"boolean": "string", "int": "double", "bigint": "double"}
    return df.select(*[F.col(c).cast(kinds[t]).alias(c) if t in kinds and c not in keys else F.col(c) for c, t in df.dtypes])


@query(TEXTS + f"select doc_id, {_EMAILS} as emails, {_PHONES} as phone_numbers, {_PLACE} as locality, {_one('text', lex.POSTAL)} as postal_code from c")
def document_contact(spark, sf):
    return documents_with(spark, sf, dc.contact, dc.location)


_ALWAYS, _LINE, _LATE = any_in("low", lex.ALWAYS_OPEN), _one("low", lex.HOURS), any_in("low", lex.LATE)


@query(TEXTS + f"""select doc_id, case when {_ALWAYS} then 'true' end as open_24_hours, coalesce(case when {_ALWAYS} then '24 hours' end, {_LINE}) as opening_hours_raw, {_LINE} as hours_line, case when {_LATE} then 'true' end as late_night,
 case when {_LATE} then {any_in("low", lex.AFTER_MIDNIGHT)}::varchar end as after_midnight, {keys_where({"morning": any_in("low", ["morning"]), "evening": any_in("low", ["evening", "sunset"])})} as best_time_to_visit,
 {keys_where({"mentioned as less crowded": any_in("low", ["quiet hours", "less crowded"])})} as quiet_hours from c""")
def document_hours(spark, sf):
    return documents_with(spark, sf, dc.timings)


_LEVEL = "case when price_max = 0 then 'free' when price_max <= 300 then 'budget' when price_max <= 1200 then 'mid' when price_max <= 3000 then 'premium' when price_max is not null then 'luxury' end"


@query(TEXTS + f""", a as (select *, list_transform(regexp_extract_all(low, {quoted(lex.PRICE)}, 1), lambda v: replace(v, ',', '')::int) as amounts, {any_in("low", lex.FREE_ENTRY)} as free from c),
b as (select *, list_min(amounts) as price_min, list_max(amounts) as price_max from a)
select doc_id, amounts[1:10] as observed_prices, price_min::double as price_min, price_max::double as price_max, case when free then 'false' when len(amounts) > 0 then 'true' end as paid, case when free then 'true' end as free_entry, coalesce({_LEVEL}, case when free then 'free' end) as price_level,
 case when contains(low, 'membership') then 'true' end as membership_required, try_cast({_one("low", lex.RATING)} as double) as rating, {_number(_one("low", lex.RATING_COUNT))}::double as rating_count from b""")
def document_prices(spark, sf):
    return documents_with(spark, sf, dc.pricing, dc.rating)


def _tagged(rules: dict[str, list[str]]) -> str:
    return f"list_sort({keys_where({k: bounded_any(t) for k, t in rules.items()})})"


_HITS = {k: " + ".join(f"case when {bounded_any([t])} then 1 else 0 end" for t in terms) for k, terms in lex.SIGNAL_INTENTS.items()}
_SCORED = "list_filter([" + ", ".join(f"case when ({h}) > 0 then {quoted(k)} || '=' || round(least(1.0::double, 0.35::double + ({h}) * 0.15::double), 3)::varchar end" for k, h in _HITS.items()) + "], lambda x: x is not null)"


@query(TEXTS + f"select doc_id, {_tagged(lex.CONTEXTS)} as context_keys, {_tagged(lex.TEXT_BRANCHES)} as branch_ids, {_tagged(lex.SIGNAL_INTENTS)} as intent_tags, {_tagged(lex.NEGATIVE_TAGS)} as negative_intent_tags from c")
def document_tags(spark, sf):
    """J10 and E13 with their own rules."""
    t = texts(spark, sf).select("doc_id", dc.intent_sets(tx.clean(F.col("text"))).alias("found"))
    return t.select("doc_id", *[c.alias(k) for k, c in dc.intents(F.col("found")).items()])


@query(TEXTS + f"select doc_id, {_SCORED} as scores from c")
def document_scores(spark, sf):
    pairs = lambda t: {"scores": F.transform(F.map_entries(dc.suitability_scores(t)), lambda e: F.concat(e.key, F.lit("="), e.value.cast("string")))}
    return documents_with(spark, sf, pairs)


def _tri(terms: tuple[list[str], list[str]]) -> str:
    return f"case when {any_in('low', terms[1])} then 'false' when {any_in('low', terms[0])} then 'true' end"


@query(TEXTS + f"""select doc_id, list_sort({keys_where({m: any_in("low", [m]) for m in lex.MOODS})}) as atmosphere, case when {any_in("low", lex.LOUD)} then 'loud' when {any_in("low", lex.SILENT)} then 'quiet' end as noise_level,
 list_sort({keys_where({k: any_in("low", [stem]) for k, stem in lex.CROWDS.items()})}) as crowd_type, {", ".join(f"{_tri(t)} as {k}_friendly" for k, t in lex.FRIENDLY.items())},
 {keys_where({k: any_in("low", t) for k, t in lex.AMENITIES.items()})} as amenities from c""")
def document_mood(spark, sf):
    return documents_with(spark, sf, dc.mood, dc.amenities)


_EVENT, _CLUB = any_in("low", lex.EVENT_TERMS), any_in("low", lex.COMMUNITY_TERMS)
_DATES = "coalesce(" + ", ".join(_one("low", p, 0) for p in lex.DATE_PATTERNS) + ")"


@query(TEXTS + f"""select doc_id, {_EVENT}::varchar as is_event, case when {_EVENT} then case when contains(low, 'cancelled') then 'cancelled' when contains(low, 'postponed') then 'postponed' else 'scheduled' end end as event_status,
 case when {_EVENT} then {_DATES} end as event_date_text, {_CLUB}::varchar as is_community, case when {_CLUB} then {first_case([(k, any_in("low", t)) for k, t in lex.COMMUNITY_TYPES], "club")} end as community_type,
 case when {_CLUB} then {_number(_one("low", lex.MEMBERS))}::double end as member_count from c""")
def document_events(spark, sf):
    return documents_with(spark, sf, dc.events)


_ADDRESS = "coalesce(" + ", ".join(f"nullif({strip_sql(CLEAN.format(x=f'regexp_extract(text, {quoted(p)}, 1)'), ' ,;' + chr(92) + '-')}, '')" for p in lex.ADDRESSES) + ")"
_BAD_ADDRESS = f"(length(x) > 220 or {any_in('lower(x)', lex.ADDRESS_NOISE)} or not (contains(lower(x), 'hyderabad') or contains(lower(x), 'telangana') or regexp_matches(lower(x), '\\b500\\d{{3}}\\b')))"
_GOOD_ADDRESS = f"coalesce(length(x) >= 12 and not {_BAD_ADDRESS} and regexp_matches(lower(x), {quoted(lex.ADDRESS_SHAPE)}), false)"
_LAT, _LON = (f"try_cast(regexp_extract(text, {quoted(lex.TEXT_COORDINATES)}, {i}) as double)" for i in (1, 2))


@query(TEXTS + f""", e as (select *, {_ADDRESS} as x from c)
select doc_id, case when {_GOOD_ADDRESS} then x end as address, case when {_LAT} between 17 and 18 and {_LON} between 78 and 79 then {_LAT} end as latitude, case when {_LAT} between 17 and 18 and {_LON} between 78 and 79 then {_LON} end as longitude,
 {_one("text", r"(?:" + chr(92) + r"+91[-" + chr(92) + r"s]?)?[6-9][0-9]{9}", 0)} as phone, try_cast({_one("low", lex.EVIDENCE_RATING)} as double) as rating, {_number(_one("low", lex.RATING_COUNT))}::double as rating_count,
 {_one("low", lex.EVIDENCE_HOURS)} as opening_hours, '₹' || {_one("low", lex.EVIDENCE_PRICE)} as price, {keys_where({t: any_in("low", [t]) for t in lex.EVIDENCE_AMENITIES})} as amenities, {keys_where({t: any_in("low", [t]) for t in lex.CUISINES})} as cuisines from e""")
def evidence_fields(spark, sf):
    """E15 to E17 over whole texts."""
    t = texts(spark, sf).select("doc_id", *[c.alias(k) for k, c in rf.evidence_fields(F.col("text")).items()])
    return plainly(t.select("doc_id", "address", F.col("position.lat").alias("latitude"), F.col("position.lon").alias("longitude"), "phone", "rating", "rating_count", "opening_hours", "price", "amenities", "cuisines"), "doc_id")


@query(CANDIDATES + f", a as (select id, address as x from p) select id, coalesce({_BAD_ADDRESS}, false) as bad, {_GOOD_ADDRESS} as valid from a")
def address_rules(spark, sf):
    """P27 in both forms."""
    a = F.col("address")
    return candidates(spark, sf).select("id", F.coalesce(nm.bad_address(a), F.lit(False)).alias("bad"), nm.valid_address(a).alias("valid"))


_POSITIONS = [("https://maps.google.com/maps?q=17.44470,78.46650", 17.4447, 78.4665), ("https://www.google.com/maps/place/@17.4447,78.4665,15z", 17.4447, 78.4665), ("https://x.example/!3d17.4447!4d78.4665", 17.4447, 78.4665), ("https://x.example/!2d78.46!3d17.44", 17.44, 78.46)]


@query(f"with u as (select c_custkey as id, {sql_pick(SITES, 'c_custkey')} as url from customer) select id, lat as latitude, lon as longitude from u left join (values {', '.join(f'({quoted(u)}, {a}::double, {b}::double)' for u, a, b in _POSITIONS)}) w(url, lat, lon) using (url)")
def url_positions(spark, sf):
    """The SQL lists the positions of the urls that have one."""
    u = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), nm.position_in_url(pick(SITES, "c_custkey")).alias("p"))
    return u.select("id", F.col("p.lat").alias("latitude"), F.col("p.lon").alias("longitude"))


@query(TEXTS + f""", m as (select doc_id, list_transform(regexp_extract_all(substr(text, 1, 12000), {quoted(lex.CITY_QUERY)}, 1), lambda v: trim(regexp_replace(v, '\\s+', ' ', 'g'))) as found from t),
k as (select doc_id, found, list_transform(found, lambda v: lower(v)) as keys from m)
select doc_id, list_filter(found, lambda v, i: list_position(keys, lower(v)) = i)[1:8] as queries from k""")
def mentioned_queries(spark, sf):
    return texts(spark, sf).select("doc_id", nm.mentioned_queries(F.col("text")).alias("queries"))


@query(TEXTS + f"select doc_id, {any_in('low', lex.RELEVANT)} as relevant, length(text) < 500 as too_short, {first_case([(k, bounded_any(t)) for k, t in lex.PAGE_CATEGORIES.items()], 'web_entity')} as category from (select doc_id, text, lower(text) as low, ' ' || regexp_replace(lower('  ' || substr(text, 1, 2000)), '([^a-z0-9])', '\\1\\1', 'g') || ' ' as hay from c)")
def page_filters(spark, sf):
    """P10, P13, N23 over whole texts."""
    t = texts(spark, sf).select("doc_id", tx.clean(F.col("text")).alias("text"))
    return t.select("doc_id", nm.relevant(F.col("text")).alias("relevant"), (F.length("text") < 500).alias("too_short"), nm.page_category(F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("text")).alias("category"))


# Pages ---------------------------------------------------------------------------------------------------------------

_A = quoted(pg.ANCHOR)
_TEXT_OF = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g'))"
_ROOT = "regexp_extract(url, '^[A-Za-z]+://[^/?#]*')"
#: The hrefs of the pages are absolute, from the root, from the folder, one folder up, a query or a fragment.
_FOLDER = f"({_ROOT} || coalesce(nullif(regexp_extract(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z]+://[^/]*(/.*)?$', 1), '^(.*/)', 1), ''), '/'))"
_UP = f"({_ROOT} || coalesce(nullif(regexp_extract(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z]+://[^/]*(/.*)?$', 1), '^(.*/)[^/]+/[^/]*$', 1), ''), '/'))"


def _joined(h: str) -> str:
    return f"""case when regexp_matches({h}, '^[A-Za-z][A-Za-z0-9+.-]*:') then {h} when {h} = '' then url when starts_with({h}, '//') then regexp_extract(url, '^[A-Za-z]+:') || {h} when starts_with({h}, '#') then regexp_replace(url, '#.*$', '') || {h}
     when starts_with({h}, '?') then regexp_replace(url, '[?#].*$', '') || {h} when starts_with({h}, '/') then {_ROOT} || {h} when starts_with({h}, '../') then {_UP} || substr({h}, 4) else {_FOLDER} || {h} end"""


_LINKS = WEB_PAGES + f""", a as (select page_id, url, html, unnest(regexp_extract_all(html, {_A}, 0)) as tag, unnest(range(len(regexp_extract_all(html, {_A}, 0))))::int as pos from w),
h as (select *, regexp_extract(tag, {_A}, 1) as raw, {_TEXT_OF.format(x=f"regexp_extract(tag, {_A}, 2)")} as label from a), l as (select *, {_joined("raw")} as href from h)
"""
_SITE = "lower(regexp_extract(href, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1))"


@query(_LINKS + "select page_id, pos, href, label from l")
def labelled_links(spark, sf):
    """Every link as it resolves."""
    p = web_pages(spark, sf)
    return p.select("page_id", F.posexplode(pg.links(F.col("html"), F.col("url"))).alias("pos", "l")).select("page_id", "pos", "l.*")


@query(_LINKS + f""", g as (select *, row_number() over (partition by page_id order by pos) as n from l where regexp_matches(lower(href), '^https?:') and ({_SITE} = lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) or {any_in("lower(label || ' ' || href)", lex.RELEVANT)})
  and {any_in("lower(label || ' ' || href)", lex.USEFUL_LINKS)} and not {any_in("lower(label || ' ' || href)", lex.BLOCKED_LINKS)})
select page_id, href, substr(label, 1, 160) as anchor, greatest(0.05::double, 0.6::double - 0.15::double) as priority, 1 as depth from g where n <= 20""")
def link_candidates(spark, sf):
    """The candidates that a page's links bring."""
    p = web_pages(spark, sf)
    own = p.select("page_id", F.explode(pg.followed(pg.links(F.col("html"), F.col("url")), F.col("url"))).alias("l"))
    return own.select("page_id", F.col("l.href").alias("href"), F.substring("l.label", 1, 160).alias("anchor"), F.greatest(F.lit(0.05), F.lit(0.6) - F.lit(0.15)).alias("priority"), F.lit(1).alias("depth"))


_FIRST = {"booking_url": any_in("lower(label)", ["book", "reserve"]), "menu_url": any_in("lower(label)", ["menu"]), "ticket_url": any_in("lower(label)", ["ticket", "register"]), "google_maps_url": f"(contains({_SITE}, 'maps.google') or contains(href, 'google.com/maps'))", "whatsapp_url": any_in(_SITE, ["wa.me", "whatsapp"])}


@query(_LINKS + "select page_id, " + ", ".join(f"arg_min(href, pos) filter (where {c}) as {k}" for k, c in _FIRST.items()) + ", list_filter([" + ", ".join(f"{quoted(s.replace('.com', '') + '=')} || arg_max(href, pos) filter (where contains({_SITE}, {quoted(s)}))" for s in lex.SOCIAL) + "], lambda x: x is not null) as social from l group by page_id")
def page_contacts(spark, sf):
    """E2 and social links of the pages that have links."""
    p = web_pages(spark, sf).select("page_id", pg.links(F.col("html"), F.col("url")).alias("l")).where(F.size("l") > 0)
    return p.select("page_id", *[c.alias(k) for k, c in dc.link_urls(F.col("l")).items()], pg.social_links(F.col("l")).alias("social"))


_IMG = "regexp_extract_all(html, '(?is)<img\\b[^>]*\\bsrc=\"[^\"]*\"[^>]*>')"


@query(WEB_PAGES + f""", i as (select page_id, url, unnest({_IMG}) as tag, unnest(range(len({_IMG})))::int as pos from w), s as (select *, regexp_extract(tag, 'src="([^"]*)"', 1) as raw from i), r as (select page_id, {_joined("raw")} as src, pos from s where raw <> '' and pos < 20),
o as (select page_id, url, regexp_extract(html, '<meta property="og:image" content="([^"]*)"', 1) as raw from w), b as (select page_id, src, pos from r union all select page_id, {_joined("raw")}, -1 from o where raw <> ''),
u as (select page_id, src, min(pos) as pos from b group by 1, 2) select page_id, list(src order by pos) as image_urls from u group by 1""")
def page_images(spark, sf):
    """H5: the page's own picture first."""
    return web_pages(spark, sf).select("page_id", pg.image_urls(F.col("html"), F.col("url")).alias("image_urls")).where(F.size("image_urls") > 0)


_NAMES_OF = ["Blue Cup", "Old Fort Gate", "AB cd", "Interior", None]


@query(WEB_PAGES + f""", i as (select page_id, url, unnest({_IMG}) as tag, unnest(range(len({_IMG})))::int as pos from w),
s as (select page_id, pos, {_joined("regexp_extract(tag, 'src=" + chr(34) + "([^" + chr(34) + "]*)" + chr(34) + "', 1)")} as src, regexp_extract(tag, '\\balt="([^"]*)"', 1) as alt, regexp_extract(tag, '\\btitle="([^"]*)"', 1) as title, {sql_pick(_NAMES_OF, "page_id")} as name from i),
f as (select *, list_filter(regexp_extract_all(lower(name), '[a-z0-9]+'), lambda v: length(v) > 3) as own, lower(alt || ' ' || title || ' ' || src) as hay from s where regexp_matches(src, '^https?://')),
m as (select page_id, src, min(pos) as pos, arg_min(coalesce(nullif(title, ''), nullif(alt, '')), pos) as caption from f where len(list_filter(own, lambda v: contains(hay, v))) > 0 group by 1, 2),
n as (select *, row_number() over (partition by page_id order by pos) as place from m) select page_id, src as url, caption, place = 1 as is_primary from n where place <= 4""")
def mention_pictures(spark, sf):
    """Pictures of a page that belong to a name."""
    p = web_pages(spark, sf).select("page_id", F.explode(rf.mention_media(pick(_NAMES_OF, "page_id"), pg.pictures(F.col("html"), F.col("url")))).alias("m"))
    return p.select("page_id", "m.url", "m.caption", "m.is_primary")


_HEAD = r"(?is)<h2\b[^>]*>.*?</h2\s*>|<h3\b[^>]*>.*?</h3\s*>|<h4\b[^>]*>.*?</h4\s*>|<li\b[^>]*>.*?</li\s*>"


@query(WEB_PAGES + f", n as (select page_id, list_filter(list_transform(regexp_extract_all(html, {quoted(_HEAD)}), lambda v: {_TEXT_OF.format(x='v')}), lambda v: length(v) <= 100 and v <> '') as names from w) select page_id, names from n where len(names) > 0")
def list_names(spark, sf):
    """H4: names that headings and list items give."""
    return web_pages(spark, sf).select("page_id", pg.list_names(F.col("html")).alias("names")).where(F.size("names") > 0)


# Map elements --------------------------------------------------------------------------------------------------------


def _map_value(column: str) -> str:
    return f"map {{{', '.join(f'{quoted(k)}: {quoted(v)}' for k, v in lex.MAP_CATEGORIES.items())}}}[{column}]"


_NEAR = ", ".join(f"struct_pack(d := {metres('lat', 'lon', f'{a}::double', f'{b}::double')}, i := {i}, n := {quoted(n)})" for i, (n, a, b) in enumerate(lex.SEEDS))
_MAPPED = MAP_ELEMENTS + f""", n as (select *, case when untagged then null else coalesce(case when length(trim(name)) >= 3 then trim(regexp_replace(trim(name), '\\s+', ' ', 'g')) end, case when length(trim(brand)) >= 3 then trim(regexp_replace(trim(brand), '\\s+', ' ', 'g')) end) end as title,
  coalesce(case when not untagged then coalesce({_map_value("amenity")}, {_map_value("tourism")}, case when historic is not null then 'historic' end, {_map_value("natural_")}, case when sport is not null then 'sports_venue' end) end, 'place') as category,
  case when lat is not null and lon is not null then coalesce(case when not untagged and suburb <> 'Hyderabad' then suburb end, list_aggregate([{_NEAR}], 'min').n) end as locality from m),
r as (select *, case when untagged then 'missing_tags' when title is null then 'missing_name' when amenity in ({", ".join(map(quoted, lex.UNSERVED_TAGS))}) then 'non_serving_category' when lat is null or lon is null then 'missing_coordinates'
  when category not in ({", ".join(map(quoted, sorted({*lex.MAP_CATEGORIES.values(), *lex.MAP_EXTRA})))}) then 'unmapped_category' end as reject_reason from n)
"""


@query(_MAPPED + "select id as element_id, title as name, category, locality, lat as latitude, lon as longitude, reject_reason from r")
def map_decisions(spark, sf):
    """The element's own place before the nearest one, and the first reason that rejects it."""
    from waymark.sources.landed import map_entities

    return map_entities(map_elements(spark, sf)).select("element_id", "name", "category", "locality", "latitude", "longitude", "reject_reason")


@query(_MAPPED + "select coalesce(reject_reason, 'accepted') as outcome, count(*) as n, round(100 * count(*) / 5000::double, 2) as percent_of_target from r group by 1")
def bulk_counters(spark, sf):
    """A5 over map elements."""
    from waymark.operators.tables import share_of_target
    from waymark.sources.landed import map_entities

    return share_of_target(map_entities(map_elements(spark, sf)), F.coalesce("reject_reason", F.lit("accepted")).alias("outcome"), 5000)


_CROWD = " , ".join(f"case when category in ({', '.join(map(quoted, kinds))}) then {sql_list(people)} else []::varchar[] end" for kinds, people in lex.MAP_AUDIENCE)
_BASE_TAGS = f"case {' '.join(f'when category = {quoted(c)} then {sql_list(t)}' for c, t in lex.MAP_TAGS.items())} else ['explore', 'local'] end"
_DISTINCT = "list_sort(list_distinct({x}))"
_MAP_TAGS = _DISTINCT.format(x=f"flatten([{_BASE_TAGS}, case when wifi then ['wifi', 'work'] else []::varchar[] end, case when always then ['late_night', 'after_midnight'] else []::varchar[] end])")


@query(_MAPPED + f"""select id as element_id, list_sort(case when aliased then ['One', 'Two'] else []::varchar[] end) as aliases,
 concat_ws(', ', house, street, suburb, 'Hyderabad') as address,
 list_filter([case when amenity is not null then 'amenity:' || amenity end, case when tourism is not null then 'tourism:' || tourism end, case when historic is not null then 'historic:' || historic end, case when sport is not null then 'sport:' || sport end, case when thai then 'cuisine:thai; indian,thai' end], lambda x: x is not null) as subcategories,
 list_sort(flatten([case when wifi then ['wifi:yes'] else []::varchar[] end, case when limited then ['wheelchair:Limited'] else []::varchar[] end, case when thai then ['cuisine:indian', 'cuisine:thai'] else []::varchar[] end])) as amenities,
 {_DISTINCT.format(x=f"flatten([{_CROWD}, case when limited then ['accessibility'] else []::varchar[] end])")} as audience, case when phoned then '123' end as phone, case when sited then 'https://w.example' end as website,
 case when wiki = 0 then 'https://te.wikipedia.org/wiki/Old_Fort' when wiki = 1 then 'https://en.wikipedia.org/wiki/Old_Fort' end as wikipedia_url,
 list_filter([case when pictured = 0 then 'http://i.example/1.png' end, case when commons then 'https://commons.wikimedia.org/wiki/Special:FilePath/Old%20fort.jpg?width=1280' end], lambda x: x is not null) as media_urls,
 case when fb then ['facebook=fb'] else []::varchar[] end as social, case when fee then ['fee=no'] else []::varchar[] end as pricing, always as open_24_hours, {_MAP_TAGS} as intent_tags,
 {_DISTINCT.format(x=f"list_concat([category, locality], {_MAP_TAGS})")} as context_keys, {_DISTINCT.format(x="[category, 'places', 'hyderabad']")} as branch_ids from r where reject_reason is null""")
def map_fields(spark, sf):
    """Every field that tags give an accepted element."""
    from waymark.sources.landed import map_entities

    e = map_entities(map_elements(spark, sf)).where("reject_reason is null")
    return e.drop("name", "category", "locality", "latitude", "longitude", "reject_reason")


# Publication ---------------------------------------------------------------------------------------------------------

_STOPS = lex.SERVING_STOPS
_SERVED = ENTITIES + f""", b as (select id, 'Place ' || (id % 200)::varchar || case when id % 2 = 0 then ' near the Golkonda' else '' end as name, category, locality, address, latitude, longitude, case when id % 53 = 0 then 'REJECTED_PAGE_FRAGMENT' else 'ACTIVE' end as status,
  confidence, rating, rating_count, timings, intent_tags, image_id, n_sources, description from e),
r as (select *, list_sort(list_filter([case when locality is null then 'locality' end, case when address is null then 'address' end, case when latitude is null then 'latitude' end, case when longitude is null then 'longitude' end, case when image_id is null then 'image' end, case when n_sources = 0 then 'source' end], lambda x: x is not null)) as missing,
  list_sort(list_filter([case when latitude is null then 'missing_coordinates' end, case when image_id is null then 'missing_image' end, case when locality is null then 'missing_locality' end, case when address is null then 'missing_address' end, case when n_sources = 0 then 'missing_source_provenance' end, case when confidence < 0.35 then 'low_confidence' end, case when status <> 'ACTIVE' then 'not_recommendation_entity' end], lambda x: x is not null)) as blockers,
  list_sort(list_filter([case when rating is null then 'missing_rating' end, case when timings is null then 'missing_timings' end, case when len(intent_tags) = 0 then 'missing_intent_tags' end], lambda x: x is not null)) as warnings from b),
q as (select *, round(least(1.0::double, greatest(0.0::double, 1 - 0.18::double * len(missing) - 0.25::double * len(blockers) - 0.04::double * len(warnings) + case when address is null then 0 else 0.05::double end + case when image_id is null then 0 else 0.05::double end
  + case when rating is null then 0 else 0.05::double end + case when len(intent_tags) = 0 then 0 else 0.05::double end)), 3) as quality_score, len(blockers) = 0 and len(missing) = 0 as ready from r),
g as (select *, trim(regexp_replace(regexp_replace(regexp_replace(replace(lower(name), 'golkonda', 'golconda'), '[^a-z0-9]+', ' ', 'g'), {quoted(_STOPS)}, ' ', 'g'), ' +', ' ', 'g')) || '|' || round(latitude, 4)::varchar || ':' || round(longitude, 4)::varchar as key from q where ready and status = 'ACTIVE'),
k as (select * from g qualify row_number() over (partition by key order by id::varchar) = 1),
i as (select c_custkey as id, j, case when c_custkey % 4 = 0 then 'same' else 'h' || c_custkey::varchar || '-' || j::varchar end as hash from customer, (values (0), (1)) v(j) where (c_custkey + j) % 7 <> 0),
a as (select k.id, k.name, k.image_id, pos, pos % 2 as j from k, (select unnest(range(3)) as pos) where pos <= k.id % 3),
m as (select a.id, a.name, a.image_id, pos, a.j, hash from a join i using (id, j) qualify row_number() over (partition by a.id, hash order by pos) = 1),
s as (select k.* from k where id in (select id from m))
"""


def published(spark, sf, name: str):
    from waymark.operators.publish import served_tables

    return served_tables(served(spark, sf), *sidecars(spark, sf))[name]


@query(_SERVED + "select id::varchar as id, name as canonical_name, 'place' as entity_type, category as primary_category, locality, address, latitude, longitude, 'http://w' || id::varchar as website, image_id is not null as has_media, ready as production_ready, quality_score, blockers as quality_blockers, missing as quality_missing_fields from q")
def served_raw(spark, sf):
    """K10."""
    return published(spark, sf, "entities_raw")


_AT = "name || ' ' || coalesce(nullif(locality, ''), 'Hyderabad')"


@query(_SERVED + f"select id::varchar as entity_id, name, ready as production_ready, quality_score as score, missing as missing_fields, blockers, warnings, list_filter(case when status <> 'ACTIVE' then []::varchar[] else [case when latitude is null then {_AT} || ' exact location' end, case when latitude is null then {_AT} || ' address' end, case when address is null then {_AT} || ' address timings' end, case when image_id is null then {_AT} || ' photos' end, case when image_id is null then {_AT} || ' images' end] end, lambda x: x is not null) as enrichment_queries from q")
def served_quality(spark, sf):
    """K11, J7."""
    return published(spark, sf, "entity_quality")


_ID_OF = "case when pos = 0 then id::varchar || ':' || image_id else id::varchar || ':' || substr(hash, 1, 20) end"


@query(_SERVED + f"select s.id::varchar as id, name as canonical_name, 'place' as entity_type, category as primary_category, [category] as secondary_categories, list_sort(list_distinct(list_append(intent_tags, category))) as context_keys, ['places'] as branch_ids, intent_tags, description, locality, address, latitude, longitude, 'http://w' || s.id::varchar as website, rating, rating_count, confidence as confidence_score, n_sources as source_count, 'PRODUCTION_READY' as status, (select arg_min({_ID_OF}, pos) from m where m.id = s.id) as primary_image_id from s")
def served_entities(spark, sf):
    """Gated, one for each name and position, with a landed picture."""
    kept = "id canonical_name entity_type primary_category secondary_categories context_keys branch_ids intent_tags description locality address latitude longitude website rating rating_count confidence_score source_count status primary_image_id"
    return published(spark, sf, "city_entities").select(*kept.split())


def shown(spark, sf):
    """Served places with what texts and reviews have told of them."""
    seen = "timestamp'2020-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 1000 as int))"
    more = {
        "display_name": "if(id % 4 = 0, '', if(id % 4 = 1, null, concat('The ', name)))", "negative_intent_tags": "if(id % 3 = 0, array('crowded'), null)", "summary": "if(id % 2 = 0, concat('About ', name), null)", "geo_precision": "if(id % 5 = 0, 'exact', null)",
        "phone_numbers": "array(concat('+91-', id))", "emails": "if(id % 6 = 0, array(concat('a', id, '@b.example')), null)", "price_level": "if(id % 7 = 0, 'budget', null)", "review_count": "if(id % 8 = 0, null, id % 40)", "popularity": "id % 100 / 100D", "hidden_gem": "if(id % 9 = 0, null, 0.5D)",
        "card": "named_struct('title', name, 'place', locality)", "first_seen_at": seen, "last_seen_at": seen + " + interval 1 hour",
    }
    return served(spark, sf).withColumns({k: F.expr(x) for k, x in more.items()})


_SEEN = "timestamp '2020-01-01 00:00:00' + to_days((s.id % 1000)::int)"


@query(_SERVED + f"""select s.id::varchar as id, name as canonical_name, case when s.id % 4 > 1 then 'The ' || name else name end as display_name, 'place' as entity_type, category as primary_category, [category] as secondary_categories, list_sort(list_distinct(list_append(intent_tags, category))) as context_keys, ['places'] as branch_ids, intent_tags,
 case when s.id % 3 = 0 then ['crowded'] else []::varchar[] end as negative_intent_tags, description, case when s.id % 2 = 0 then 'About ' || name end as summary, locality, address, latitude, longitude, case when s.id % 5 = 0 then 'exact' end as geo_precision, 'http://w' || s.id::varchar as website, ['+91-' || s.id::varchar] as phone_numbers,
 case when s.id % 6 = 0 then ['a' || s.id::varchar || '@b.example'] else []::varchar[] end as emails, case when s.id % 7 = 0 then 'budget' end as price_level, rating, rating_count, case when s.id % 8 = 0 then 0 else s.id % 40 end::int as review_count, s.id % 100 / 100::double as popularity_score, (case when s.id % 9 = 0 then null else 0.5 end)::double as hidden_gem_score,
 confidence as confidence_score, n_sources as source_count, 'PRODUCTION_READY' as status, null::varchar as primary_image_url, (select arg_min({_ID_OF}, pos) from m where m.id = s.id) as primary_image_id, '{{"title":"' || name || '","place":"' || locality || '"}}' as card,
 epoch({_SEEN})::double as first_seen, epoch({_SEEN} + interval 1 hour)::double as last_seen, epoch({_SEEN} + interval 1 hour)::double as updated from s""")
def served_entities_whole(spark, sf):
    """All columns of a served entity but the raw one; times as seconds."""
    from waymark.operators.publish import served_tables

    t = served_tables(shown(spark, sf), *sidecars(spark, sf))["city_entities"]
    return t.withColumns({k: F.unix_micros(f"{k}_at") / 1e6 for k in ("first_seen", "last_seen", "updated")}).drop("first_seen_at", "last_seen_at", "updated_at")


@query(_SERVED + "select id::varchar as entity_id, 'solo' as intent_tag, 0.25::double + (id % 4) / 10::double as score, 'suitability score' as evidence from s where len(intent_tags) > 0 union all select id::varchar, unnest(list_filter(intent_tags, lambda x: x <> 'solo')), 0.5::double, 'intent tag' from s")
def served_intents(spark, sf):
    return published(spark, sf, "entity_intents")


@query(_SERVED + "select id::varchar || ':src' || j::varchar || ':' || case when j = 1 then '' else 'http://s' || (id % 50)::varchar || '.example' end || ':' as source_key, id::varchar as entity_id, 'src' || j::varchar as source, case when j = 1 then null else 'http://s' || (id % 50)::varchar || '.example' end as source_url, 'webpage' as source_type, null::varchar as raw_path, 0.5::double as extraction_confidence from s, (select unnest(range(4)) as j) where j < n_sources")
def served_sources(spark, sf):
    return published(spark, sf, "entity_sources")


@query(_SERVED + f"select {_ID_OF} as id, id::varchar as entity_id, 'http://img' || id::varchar || '/' || j::varchar as source_url, 'image/png' as mime_type, (1000 + j)::bigint as byte_size, hash as content_hash, 'front' as caption, ['a'] as labels, 'web_page' as source, pos <= 1 as is_primary from m")
def served_media(spark, sf):
    return published(spark, sf, "entity_media")


@query(_SERVED + "select id::varchar as from_entity_id, case when id % 2 = 1 and n = 1 then 'in' else 'near' end as relation_type, (id + 1)::varchar as to_entity_id, 'next' as target_name, case when id % 2 = 0 or n = 1 then 0.4::double else 0.35::double end as weight, case when id % 2 = 0 or n = 1 then 'second' else 'first' end as evidence, null::varchar as source_url from s, (values (0), (1)) v(n) where id % 2 = 1 or n = 0")
def served_relationships(spark, sf):
    return published(spark, sf, "entity_relationships")


@query(_SERVED + "select 'r' || conv_id::varchar || '-' || turn::varchar as id, (conv_id * 3)::varchar as entity_id, arg_max(role, text) as source, arg_max((turn % 6)::double, text) as rating, max(text) as text, 'mixed' as sentiment, 0::double as sentiment_score, [arg_max(role, text)] as topics from conversations where turn % 5 <> 4 and conv_id * 3 in (select id from s) group by conv_id, turn")
def served_reviews(spark, sf):
    return published(spark, sf, "entity_reviews")


@query("with p as (select url, 't' || page_id::varchar as title, null::varchar as description, 'web_page' as source, 'source_page' as source_type, lpad(page_id::varchar, 9, '0') as raw_path, page_id % 3 <> 2 as is_source_page, 'q' as search_query, (page_id % 10)::int as search_rank from pages where coalesce(url, '') <> '') select * from p qualify row_number() over (partition by url order by raw_path desc) = 1")
def served_pages(spark, sf):
    """K12, S3."""
    return published(spark, sf, "source_pages")


@query(ENTITIES + """, t as (select conv_id * 3 as id, case when turn % 2 = 0 then 0 else 1 end as kind, lpad(turn::varchar, 6, '0') as n, coalesce(text, '') as text from conversations),
g as (select id, list(text order by kind, n, text) as texts from t group by 1)
select e.id, coalesce(len(texts), 0)::int as review_count, sha256(coalesce(array_to_string(texts, ' '), '')) as text_hash, coalesce(list_transform(list_filter(texts[1:3], lambda x: trim(x) <> ''), lambda x: substr(trim(regexp_replace(x, '[\\s\\x0b\\x{85}\\p{Z}]+', ' ', 'g')), 1, 220)), []) as review_snippets from e left join g using (id)""")
def review_joins(spark, sf):
    """Reviews before comments."""
    from waymark.operators.publish import with_reviews

    t = table(spark, sf, "conversations").selectExpr("conv_id * 3 as entity_id", "turn", "lpad(cast(turn as string), 6, '0') as id", "text")
    rows = with_reviews(entities(spark, sf), t.where("turn % 2 = 0").drop("turn"), t.where("turn % 2 <> 0").drop("turn"))
    return rows.select("id", "review_count", F.sha2("review_text", 256).alias("text_hash"), "review_snippets")


@query("select o_custkey as id, round((sum(case when o_orderkey % 4 <> 0 then o_orderkey % 20 / 4::double end) / count(case when o_orderkey % 4 <> 0 then 1 end))::decimal(18, 9), 2)::double as rating, sum(case when o_orderkey % 3 <> 0 then o_orderkey % 900 end)::double as rating_count from orders group by 1")
def rating_means(spark, sf):
    """Mean of the scores there are, sum of the counts there are."""
    from waymark.operators.publish import rating_of

    r = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.sort_array(F.collect_list(F.expr("named_struct('key', o_orderkey, 'score', if(o_orderkey % 4 = 0, null, o_orderkey % 20 / 4D), 'count', if(o_orderkey % 3 = 0, null, o_orderkey % 900))"))).alias("ratings"))
    return plainly(r.select("id", *[c.alias(k) for k, c in rating_of(F.col("ratings")).items()]), "id")


# Enrichment and evidence ---------------------------------------------------------------------------------------------


def described(spark, sf):
    """Candidates with a text and a description of their own."""
    c = candidates(spark, sf)
    return c.withColumns({"text": F.concat_ws(" ", "name", pick(PHRASES, "id")), "description": F.when(F.col("id") % 3 != 0, F.lit("a place"))})


_DESCRIBED = CANDIDATES + f""", x as (select *, trim(regexp_replace(name || ' ' || {sql_pick(PHRASES, "id")}, '[\\s\\p{{Z}}]+', ' ', 'g')) as text, case when id % 3 <> 0 then 'a place' end as description from p),
c as (select *, lower(text) as low, ' ' || regexp_replace(lower(text), '([^a-z0-9])', '\\1\\1', 'g') || ' ' as hay from x),
d as (select *, {_PLACE} as named, {_tagged(lex.CONTEXTS)} as context_keys, {_tagged(lex.TEXT_BRANCHES)} as branch_ids, {_tagged(lex.SIGNAL_INTENTS)} as intent_tags, list_sort({keys_where({m: any_in("low", [m]) for m in lex.MOODS})}) as atmosphere,
  list_sort({keys_where({k: any_in("low", [stem]) for k, stem in lex.CROWDS.items()})}) as crowd, {_LINE} as hours, {_ALWAYS} as always, {_LATE} as late, len(regexp_extract_all(low, {quoted(lex.PRICE)}, 1)) > 0 as priced, {any_in("low", lex.FREE_ENTRY)} as free,
  {_one("low", lex.RATING)} as rated, {_one("low", lex.RATING_COUNT)} as counted, {_EMAILS} as emails, {_PHONES} as phones, {_one("text", lex.POSTAL)} as postal, {_EVENT} as is_event, {_CLUB} as is_club, {_DATES} as dated from c),
f as (select *, coalesce(nullif(locality, ''), named) as place, list_sort(list_distinct(list_filter([
  case when name <> '' then 'name' end, case when coalesce(category, '') <> '' then 'category' end, case when description is not null then 'description' end, case when coalesce(nullif(locality, ''), named) is not null then 'locality' end, case when coalesce(address, '') <> '' then 'address' end,
  case when latitude is not null then 'latitude' end, case when longitude is not null then 'longitude' end, case when website is not null then 'website' end, case when always or hours is not null then 'opening_hours_raw' end, case when priced then 'pricing' end,
  case when len(emails) > 0 then 'emails' end, case when len(phones) > 0 then 'phone_numbers' end, case when named is not null then 'locality' end, case when postal is not null then 'postal_code' end, case when always then 'open_24_hours' end, case when late then 'late_night' end,
  case when free then 'free_entry' end, case when rated is not null then 'rating' end, case when counted is not null then 'rating_count' end, case when len(context_keys) > 0 then 'context_keys' end, case when len(branch_ids) > 0 then 'branch_ids' end, case when len(intent_tags) > 0 then 'intent_tags' end,
  case when is_event and dated is not null then 'event_date_text' end, case when is_event then 'event_details' end, case when is_club then 'community_details' end], lambda v: v is not null))) as fields from d)
"""


@query(_DESCRIBED + f"select id, fields as fields_extracted, list_sort(list_filter({sql_list(dc.IMPORTANT)}, lambda v: not list_contains(fields, v))) as fields_missing, nullif(regexp_replace(lower(name), '[^a-z0-9]+', '', 'g'), '') as name_fingerprint, case when latitude is not null then printf('%.4f,%.4f', latitude, longitude) end as geo_hash, sha256(substr(text, 1, 2000)) as content_fingerprint, nullif(substr(text, 1, 2000), '') as full_text_excerpt from f")
def enriched_audit(spark, sf):
    """The enrichment of whole entities, what it found and their fingerprints."""
    return dc.enriched(described(spark, sf)).select("id", "fields_extracted", "fields_missing", "name_fingerprint", "geo_hash", "content_fingerprint", "full_text_excerpt")


_WHY = "list_filter([case when len(context_keys) > 0 then 'Matches ' || replace(lower(array_to_string(context_keys[1:2], ', ')), '_', ' ') end, case when len(crowd) > 0 then 'Popular with ' || array_to_string(crowd[1:2], ', ') end, case when place is not null then 'Located in ' || place end], lambda v: v is not null)"


@query(_DESCRIBED + f"select id, name as title, concat_ws(' · ', nullif(category, ''), place) as subtitle, coalesce(place, address) as address_short, coalesce(case when always then '24 hours' end, hours) as timing_label, list_sort(list_distinct(list_concat(intent_tags, atmosphere)))[1:8] as mood_tags, {_WHY} as why_match from f")
def enriched_cards(spark, sf):
    e = dc.enriched(described(spark, sf))
    return e.select("id", *[F.col(f"card.{c}").alias(c) for c in ("title", "subtitle", "address_short", "timing_label", "mood_tags", "why_match")])


_BRANCH_OF = f"coalesce(map {{{', '.join(f'{quoted(k)}: {quoted(v)}' for k, v in lex.BRANCH_BY_CATEGORY.items())}}}[lower(coalesce(category, ''))], {first_case([(b, bounded_any(t)) for b, t in lex.BRANCH_TERMS], 'explore')})"
_ENGINE = keys_where({k: bounded_any(t) for k, t in lex.INTENT_TERMS.items()})


@query(_DESCRIBED + f""", b as (select *, {_BRANCH_OF} as branch, {_ENGINE} as own from c), g as (select *, case when len(own) > 0 then own else ['explore'] end as tags from b)
select id, branch, tags as intent_tags, {keys_where({k: any_in("low", [stem]) for k, stem in lex.ENGINE_CROWDS.items()})} as crowd_type, {keys_where({m: bounded_any([m]) for m in lex.ENGINE_MOODS})} as atmosphere, list_sort(list_distinct(['old', branch, 'places'])) as branch_ids,
 list_sort(list_distinct(list_concat(list_concat(['old'], tags), [branch, coalesce(nullif(locality, ''), 'Hyderabad')]))) as context_keys from g""")
def engine_metadata(spark, sf):
    """J10, J12, E19 with the engine's own rules."""
    d, old = described(spark, sf), F.array(F.lit("old"))
    m = dc.engine_metadata(F.col("category"), F.col("locality"), tx.clean(F.col("text")), old, old)
    return d.select("id", *[c.alias(k) for k, c in m.items()])


_CARD_BRANCH = f"coalesce(map {{{', '.join(f'{quoted(k)}: {quoted(v)}' for k, v in lex.APP_BRANCHES.items())}}}[lower(coalesce(category, ''))], {first_case([(b, f'regexp_matches(low, {quoted(p)})') for b, p in lex.APP_BRANCH_WORDS], 'explore')})"
_EXTRA = "case branch " + " ".join(f"when {quoted(b)} then {sql_list(t)}" for b, t in lex.BRANCH_TAGS.items()) + " end"


@query(_DESCRIBED + f", b as (select id, {_CARD_BRANCH} as branch, case when id % 2 = 0 then ['explore'] else ['date', 'friends'] end as old from c), t as (select *, list_sort(list_distinct(list_concat(old, {_EXTRA}))) as tags from b), k as (select *, list_sort(list_distinct(list_append(tags, branch))) as keys from t) select id, branch, tags as intent_tags, keys as context_keys, list_sort(list_distinct([branch, 'places'])) as branch_ids, not (old = tags and old = keys and [branch, 'places'] = list_sort(list_distinct([branch, 'places']))) as changed from k")
def branch_normalisation(spark, sf):
    """Branches of served entities and the tags that they bring."""
    d = described(spark, sf).withColumn("branch", dc.card_branch(F.col("category"), F.lower(tx.clean(F.col("text")))))
    old = F.when(F.col("id") % 2 == 0, F.array(F.lit("explore"))).otherwise(F.array(F.lit("date"), F.lit("friends")))
    return d.select("id", "branch", *[c.alias(k) for k, c in dc.branch_normalised(F.col("branch"), old, old, F.array("branch", F.lit("places"))).items()])


def evidence(spark, sf):
    """Events as pages that a search found for candidates: text, url and place in the search, with the fields that the text gives."""
    e = table(spark, sf, "events").select((F.col("event_id") % 97).cast("bigint").alias("id"), F.col("event_id").alias("position_in_search"), pick(PHRASES, "event_id").alias("phrase"), pick(NAMES, "user_id").alias("said"), pick(SITES, "event_id").alias("url"))
    e = e.where("url is not null").withColumn("text", F.concat_ws(" ", "said", "phrase", F.when(F.col("position_in_search") % 3 != 0, F.lit("in Hyderabad"))))
    e = e.withColumns(rf.evidence_fields(F.col("text")))
    e = e.withColumns({"latitude": F.col("position.lat"), "longitude": F.col("position.lon"), "source": nm.source_name(F.col("url"))}).drop("position")
    named = e.join(candidates(spark, sf).select("id", F.col("name").alias("entity_name")), "id")
    filled = F.col("address").isNotNull().cast("int") + (F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).cast("int") + F.col("phone").isNotNull().cast("int") + F.coalesce(F.col("rating") != 0, F.lit(False)).cast("int")
    hay = F.concat_ws(" ", "text", F.coalesce("address", F.lit("")), "url")
    return named.withColumn("confidence", F.round(rf.evidence_confidence(F.col("entity_name"), hay, F.col("source"), filled), 6)).drop("entity_name", "said", "phrase")


_EVIDENCE = CANDIDATES + f""", v as (select (event_id % 97)::bigint as id, event_id as pos, {sql_pick(NAMES, "user_id")} || ' ' || {sql_pick(PHRASES, "event_id")} || case when event_id % 3 <> 0 then ' in Hyderabad' else '' end as raw, {sql_pick(SITES, "event_id")} as url from events),
t as (select id, pos, url, trim(regexp_replace(raw, '\\s+', ' ', 'g')) as text, lower(trim(regexp_replace(raw, '\\s+', ' ', 'g'))) as low, raw, {_HOST} as h from v where url is not null),
x as (select *, {_ADDRESS} as x from t),
y as (select *, case when {_GOOD_ADDRESS} then x end as address, case when {_LAT} between 17 and 18 and {_LON} between 78 and 79 then {_LAT} end as lat, case when {_LAT} between 17 and 18 and {_LON} between 78 and 79 then {_LON} end as lon, try_cast({_one("low", lex.EVIDENCE_RATING)} as double) as rating,
  {_one("text", chr(40) + "?:" + chr(92) + "+91[-" + chr(92) + "s]?)?[6-9][0-9]{9}", 0)} as phone, {_number(_one("low", lex.RATING_COUNT))} as rating_count, {_one("low", lex.EVIDENCE_HOURS)} as hours, '₹' || {_one("low", lex.EVIDENCE_PRICE)} as price, {keys_where({a: any_in("low", [a]) for a in lex.EVIDENCE_AMENITIES})} as amenities,
  {keys_where({a: any_in("low", [a]) for a in lex.CUISINES})} as cuisines, case {" ".join(f"when contains(h, {quoted(b)}) then {quoted(b)}" for b in lex.BRANDS)} when h = '' then 'web' else split_part(h, '.', 1) end as source from x),
n as (select y.*, p.name, {_own(lex.EVIDENCE_STOPS)} as own, lower(raw || ' ' || coalesce(y.address, '') || ' ' || url) as hay from y join p using (id)),
z as (select *, least(1.0::double, len(list_filter(own, lambda w: contains(hay, w))) / greatest(1, len(own))::double * 0.55::double + ((address is not null)::int + (lat is not null)::int + (phone is not null)::int + (coalesce(rating, 0) <> 0)::int) * 0.12::double + case when source in ({", ".join(map(quoted, lex.TRUSTED_SITES))}) then 0.1::double else 0.0::double end) as score from n),
w as (select *, case when (contains(hay, 'hyderabad') or contains(hay, 'telangana')) and len(own) > 0 and not (regexp_matches(lower(trim(name)), {quoted(lex.EVENT_NAME)}) or lower(trim(name)) in ({", ".join(map(quoted, lex.EVENT_NAMES))})) and score >= 0.45::double then round(score, 6) end as confidence from z)
"""


@query(_EVIDENCE + "select pos as position_in_search, id, source, confidence from w")
def evidence_matches(spark, sf):
    """P25 over the fields of E17."""
    return evidence(spark, sf).select("position_in_search", "id", "source", "confidence")


_BEST = _EVIDENCE + f""", four as (select * from w where confidence is not null qualify row_number() over (partition by id order by pos, url) <= 4), ranked as (select *, row_number() over (partition by id order by confidence desc, pos, url) as rank from four),
m as (select p.*, b.text as said, b.address as b_address, b.lat as b_lat, b.lon as b_lon, b.rating as b_rating, b.rating_count as b_count, b.hours, b.price, b.phone, coalesce(b.amenities, []) as b_amenities, list_transform(coalesce(b.cuisines, []), lambda c: regexp_replace(c, '[^a-z0-9]+', '_', 'g')) as slugs, b.id is not null as touched,
  (select count(*) from four f where f.id = p.id) as n from p left join (select * from ranked where rank = 1) b on b.id = p.id),
u as (select *, coalesce(nullif(address, ''), b_address) as addr from m)
"""
_TOLD = "coalesce(" + ", ".join(f"case when contains(lower(coalesce(addr, said, '')), {quoted(x)}) then {quoted(x.title())} end" for x in lex.EVIDENCE_LOCALITIES) + ", case when contains(lower(coalesce(addr, said, '')), 'hyderabad') then 'Hyderabad' end)"


@query(_BEST + f"""select id, addr as address, case when latitude is null and b_lat is not null then b_lat else latitude end as latitude, case when latitude is null and b_lat is not null then b_lon else longitude end as longitude,
 case when latitude is null and b_lat is not null then 'source_page_coordinates' else geo_precision end as geo_precision, case when touched then coalesce(case when lower(locality) <> 'hyderabad' then nullif(locality, '') end, {_TOLD}, 'Hyderabad') else locality end as locality,
 list_filter([phone], lambda v: v is not null) as phone_numbers, hours as opening_hours_raw, price as price_level, b_rating as rating, case when b_rating is not null then b_count end::double as rating_count, list_sort(b_amenities) as amenities, list_sort(slugs) as subcategories, n as evidence_count from u""")
def evidence_merges(spark, sf):
    """The best evidence fills what candidates lack."""
    none = F.array().cast("array<string>")
    c = candidates(spark, sf).withColumns({"phone_numbers": none, "opening_hours_raw": F.lit(None).cast("string"), "price_level": F.lit(None).cast("string"), "rating": F.lit(None).cast("double"), "rating_count": F.lit(None).cast("bigint"), "amenities": none, "subcategories": none, "intent_tags": none})
    rows = rf.merged_evidence(c, rf.best_evidence(evidence(spark, sf)))
    return plainly(rows.select("id", "address", "latitude", "longitude", "geo_precision", "locality", "phone_numbers", "opening_hours_raw", "price_level", "rating", "rating_count", "amenities", "subcategories", "evidence_count"), "id", "evidence_count")


_IMAGES = ["http://i.example/blue-cup-%20cafe.jpg", "http://i.example/logo.png", "data:x", "https://i.example/old%20fort.png", "http://i.example/icon-fort.gif", "http://i.example/plain.jpg", "http://i.example/temple.jpg"]


@query(CANDIDATES + f""", i as (select (o_orderkey % 211)::bigint as id, {sql_pick(_IMAGES, "o_orderkey")} || case when o_orderkey % 5 = 0 then '' else '?' || (o_orderkey % 5)::varchar end as url, max(o_orderkey % 11 / 10::double) as confidence from orders group by 1, 2),
s as (select i.*, {_own(lex.EVIDENCE_STOPS)} as own, replace(lower(url), '%20', ' ') as low from i join p using (id) where regexp_matches(url, '^https?://') and not (id % 4 = 0 and url = {quoted(_IMAGES[0])})),
r as (select id, url, id % 4 = 0 as had, 0.35::double + confidence * 0.4::double + case when len(list_filter(own, lambda w: contains(low, w))) > 0 then 0.25::double else 0.0::double end - case when {any_in("low", lex.POOR_IMAGES)} then 0.4::double else 0.0::double end as score from s),
k as (select *, row_number() over (partition by id order by score desc, url desc) as place from r)
select id, place::int as rank, url, round(least(1.0::double, score), 3) as score, place = 1 and not had as is_primary from k where place <= 4 and score >= 0.45::double""")
def evidence_images(spark, sf):
    """The best pictures of each entity."""
    c = candidates(spark, sf).select("id", "name", F.when(F.col("id") % 4 == 0, F.array(F.lit(_IMAGES[0]))).otherwise(F.array().cast("array<string>")).alias("media_urls"))
    o = table(spark, sf, "orders").select((F.col("o_orderkey") % 211).cast("bigint").alias("id"), F.concat(pick(_IMAGES, "o_orderkey"), F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.concat(F.lit("?"), (F.col("o_orderkey") % 5).cast("string")))).alias("url"), (F.col("o_orderkey") % 11 / F.lit(10.0)).alias("confidence"))
    return rf.best_images(c, o.groupBy("id", "url").agg(F.max("confidence").alias("confidence")))


# Requests ------------------------------------------------------------------------------------------------------------

#: Robots files that hosts may have, with their status; what the query's agent is forbidden by each.
ROBOTS = [(200, "User-agent: *\nDisallow: /p\n"), (200, "User-agent: *\nAllow: /page\nDisallow: /\n\nUser-agent: other\nDisallow: /\n"), (404, None), (403, None), (None, None), (503, None), (200, "User-agent: waymark\nDisallow:\n\nUser-agent: *\nDisallow: /\n"), (200, "# nothing\n")]
_ORIGIN = "nullif(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1), '')"
_FILE = f"(length({_ORIGIN}) + ascii(right({_ORIGIN}, 5))) % {len(ROBOTS)}"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^#]*)', 1)"


@query(f"""with u as (select page_id, url, {_ORIGIN} as origin, {_FILE} as file, case when {_PATH} = '' then '/' else {_PATH} end as path from pages)
select page_id, case when file is null then true when file = 0 then not starts_with(path, '/p') when file = 1 then starts_with(path, '/page') or not starts_with(path, '/') when file in (3, 5) then false else true end::varchar as may_fetch from u""")
def robots_allowed(spark, sf):
    """pages' urls by the robots files of their hosts."""
    from waymark.operators.fetching import allowed

    p = table(spark, sf, "pages").select("page_id", "url")
    origin = F.expr(_ORIGIN)
    files = F.array(*[F.struct(F.lit(s).cast("int").alias("status"), F.lit(b).cast("string").alias("body")) for s, b in ROBOTS])
    robots = p.select(origin.alias("origin")).where("origin is not null").distinct().withColumn("f", F.element_at(files, ((F.length("origin") + F.ascii(F.expr("right(origin, 5)"))) % len(ROBOTS) + 1).cast("int"))).select("origin", "f.status", "f.body")
    return plainly(allowed(p, robots, "waymark/1.0"), "page_id").drop("url")


@query("""with recursive r as (select event_id as id, 'h' || (user_id % 40)::varchar as host, (event_id % 5000)::double as arrival, case when event_id % 11 = 0 then 20.0::double when event_id % 7 = 0 then 0.5::double end as hold from events),
n as (select *, row_number() over (partition by host order by arrival, id) as i, greatest(1.25::double, coalesce(hold, 0)) as gap from r),
g as (select *, coalesce(sum(gap) over (partition by host order by i rows between unbounded preceding and 1 preceding), 0) as before from n)
select id, host, before + max(arrival - before) over (partition by host order by i) as start from g""")
def request_schedule(spark, sf):
    """The earliest start of each request, with its host's spacing and the times that hosts are closed for."""
    from waymark.operators.fetching import request_starts

    r = table(spark, sf, "events").selectExpr("event_id as id", "concat('h', cast(user_id % 40 as string)) as host", "cast(event_id % 5000 as double) as arrival", "case when event_id % 11 = 0 then 20D when event_id % 7 = 0 then 0.5D end as hold")
    return request_starts(r, 1.25).select("id", "host", "start")


_STATUS = "case event_id % 6 when 0 then 429 when 1 then 500 when 2 then 404 when 3 then 503 when 4 then 200 end"
_SAID = "case event_id % 5 when 0 then '7' when 1 then '0' when 2 then '900' when 3 then 'soon' end"


@query(f"""with r as (select event_id, {_STATUS} as status, (event_id // 7 % 5)::int as attempt, {_SAID} as said from events)
select event_id, case when attempt < 3 and (status is null or status in (429, 500, 503)) then case when status = 429 then case said when '7' then 7 when '0' then 1 when '900' then 120 else 30 end else least(120, pow(2, attempt) + 0.25) end end::double as delay from r""")
def retry_delays(spark, sf):
    """S22."""
    from waymark.operators.fetching import retry_delay

    r = table(spark, sf, "events").selectExpr("event_id", f"{_STATUS} as status", "cast(event_id div 7 % 5 as int) as attempt", f"{_SAID} as said")
    return r.select("event_id", retry_delay(F.col("status"), F.col("attempt"), F.col("said"), F.lit(0.0), F.lit(0.25)).alias("delay"))


# Frontier, mentions and merges ---------------------------------------------------------------------------------------

_SEEDS = [("query", "openstreetmap", c, 1.0) for c in lex.SEED_CATEGORIES] + [("query", x, "Hyderabad", 0.9) for x in ("wikipedia", "wikidata")] + [("query", "google_search", q, 0.85) for q in lex.SEED_QUERIES]


_OWN = f"case when seq % 7 = 0 then upper({sql_pick(lex.SEED_CATEGORIES, 'seq')}) else value end"


@query(FRONTIER + f""", g as (select case when seq % 7 = 0 then 'query' else kind end as kind, case when seq % 7 = 0 then 'openstreetmap' else source end as source, {_OWN} as value, priority, depth, retry_count, seq from f),
s as (select kind, source, value, priority, 0 as depth, 0 as retry_count, (select coalesce(max(seq), 0) from g) + seq as seq from (values """ + ", ".join(f"({quoted(k)}, {quoted(x)}, {quoted(v)}, {p}::double, {i + 1})" for i, (k, x, v, p) in enumerate(_SEEDS)) + """) s(kind, source, value, priority, seq)),
u as (select * from g union all select * from s) select kind, source, value, priority, depth, retry_count, seq::bigint as seq from u qualify row_number() over (partition by kind, source, lower(value) order by priority desc, seq) = 1""")
def seed_frontier(spark, sf):
    """The seeds joined to the frontier of events, of which some are the seeds' own in capitals; the better ones stay."""
    from waymark.streaming.batches import first_frontier, seeded

    own = F.col("seq") % 7 == 0
    g = frontier(spark, sf).withColumns({"kind": F.when(own, "query").otherwise(F.col("kind")), "source": F.when(own, "openstreetmap").otherwise(F.col("source")), "value": F.when(own, F.upper(pick(lex.SEED_CATEGORIES, "seq"))).otherwise(F.col("value"))})
    return seeded(g, first_frontier(spark))


def visited_places(spark, sf, name: str, key: str):
    """Rows of a table as things that are found at a thousand places: names alike or not, some without a position, a site or an address."""
    t, k = table(spark, sf, name), f"({key} % 1000)"
    return t.select(
        F.lit(1).cast("bigint").alias("turn"), F.col(key).cast("bigint").alias("place"), F.concat(F.lit(f"{name}-"), F.col(key).cast("string")).alias("id"), F.concat(F.element_at(F.array(*map(F.lit, NAMES)), F.expr(f"cast({k} % {len(NAMES)} + 1 as int)")), F.expr(f"if({key} % 7 = 3, ' Gate', '')")).alias("name"),
        F.expr(f"if({key} % 13 = 0, null, 17.2D + ({k} * 37 % 1000) / 2000D + {key} % 3 / 5000D)").alias("latitude"), F.expr(f"if({key} % 13 = 0, null, 78.2D + ({k} * 53 % 1000) / 2500D)").alias("longitude"), F.expr(f"if({key} % 4 = 0, concat('https://site', cast({k} as string), '.example'), null)").alias("website"),
        F.expr(f"if({key} % 5 = 0, null, concat(cast({k} as string), ' lake road'))").alias("address"),
    )


@query()
def resolved_places(spark, sf):
    """J1, J5, X-S4: all customers, found in turn, against all suppliers and each other: the place that each has entered, and as which one."""
    from waymark.operators import resolution as rs
    from waymark.operators.scratch import kept

    known, found = visited_places(spark, sf, "supplier", "s_suppkey"), visited_places(spark, sf, "customer", "c_custkey").withColumn("turn", F.lit(2).cast("bigint"))
    members = rs.resolved(rs.facts(found, False), rs.facts(known, True), kept)
    return members.select("node", "root", F.col("seq").cast("bigint").alias("seq"))


_FROM = ["openstreetmap", "web_page", "firecrawl_page", "reddit", "google_search", "wikipedia", "firecrawl_search", None]


@query(f"with f as (select event_id as seq, case when event_type = 'click' then 'source_url' else 'query' end as kind, {sql_pick(_FROM, 'event_id')} as source from events) select seq, case when (kind = 'source_url') = (source in ('web_page', 'firecrawl_page')) and source in ({', '.join(map(quoted, tb.ADAPTERS))}) then source end as adapter from f")
def adapters_dispatched(spark, sf):
    """P29 with the adapters that there are."""
    f = table(spark, sf, "events").select(F.col("event_id").alias("seq"), F.expr("if(event_type = 'click', 'source_url', 'query')").alias("kind"), pick(_FROM, "event_id").alias("source"))
    return tb.dispatched(f).select("seq", "adapter")


@query(CANDIDATES + "select value, count(*) as n from (select array_to_string(list_filter(regexp_extract_all(lower(v), '[a-z0-9]+'), lambda w: length(w) > 2)[1:3], ' ') as value from (select unnest([locality, address, name]) as v from p) where v is not null) where value <> '' group by 1")
def name_histogram(spark, sf):
    """A8, N10."""
    return tb.name_histogram(candidates(spark, sf))


@query("""with r as (select o_custkey as id, (o_orderkey % 5)::int as query_no, o_orderkey as pos, case when o_orderkey % 7 = 0 then '' else 'http://U' || (o_orderkey % 9)::varchar end as url, case when o_orderkey % 21 = 0 then '' else 'T' || (o_orderkey % 4)::varchar end as title from orders),
k as (select *, lower(coalesce(nullif(url, ''), title)) as key from r), f as (select * from k where key <> '' qualify row_number() over (partition by id, key order by query_no, pos) = 1),
n as (select id, query_no, count(*) as n from f group by 1, 2), b as (select id, query_no, coalesce(sum(n) over (partition by id order by query_no rows between unbounded preceding and 1 preceding), 0) as before from n)
select id, query_no, pos, url, title from f join b using (id, query_no) where before < 6""")
def search_results_union(spark, sf):
    """First by url or title over queries, until enough are there."""
    r = table(spark, sf, "orders").selectExpr("o_custkey as id", "cast(o_orderkey % 5 as int) as query_no", "o_orderkey as pos", "if(o_orderkey % 7 = 0, '', concat('http://U', cast(o_orderkey % 9 as string))) as url", "if(o_orderkey % 21 = 0, '', concat('T', cast(o_orderkey % 4 as string))) as title")
    return tb.first_results(r, 6)


@query(CANDIDATES + "select id, kind, n from (select id, case when id % 3 = 0 then 2 else 0 end as n, 'queries' as kind from p), (select 300 as most) where n > 0 qualify coalesce(sum(n) over (order by id rows between unbounded preceding and 1 preceding), 0) < 300")
def capped_enqueue(spark, sf):
    """Whole rows in the order of ids until the cap is reached."""
    rows = candidates(spark, sf).select("id", F.lit("queries").alias("kind"), F.when(F.col("id") % 3 == 0, 2).otherwise(0).alias("n"))
    return tb.capped(rows, F.col("n"), 300).select("id", "kind", "n")


_LIST = ["1. Hidden Leaf Cafe\n- Old Fort Museum - a walk\n", "See **Blue Cup** and [Green Lake Park](https://x.example/a) today\n", "3) read more\n* Top Cafes\n- Trip Policy\n", "From Salar Jung Museum to Necklace Road\n", "- Hidden Leaf Cafe\n- hidden leaf cafe\n- Hidden Leaf CAFE\n", ""]
_MNAME = strip_sql(chain(CLEAN.format(x="raw"), [(p, "", "") for p in lex.MENTION_CUTS]), lex.MENTION_STRIP)
_FOUND = "flatten([" + ", ".join(f"regexp_extract_all(text, {quoted(p)}, 1)" for p in lex.MENTIONS) + "])"


@query(f"""with t as (select doc_id, substr({sql_pick(_LIST, "doc_id")} || coalesce(text, ''), 1, 30000) as text from documents), f as (select doc_id, unnest({_FOUND}) as raw, unnest(range(len({_FOUND}))) as pos from t),
n as (select doc_id, pos, {_MNAME} as n from f), v as (select * from n where {_VALID}), g as (select doc_id, arg_min(n, pos) as name, min(pos) as pos from v group by doc_id, lower(n)), r as (select *, row_number() over (partition by doc_id order by pos) as rank from g)
select doc_id, name, rank::int as rank from r where rank <= 40""")
def mentioned_names(spark, sf):
    """The names that texts mention."""
    from waymark.operators.extract import mentions

    d = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.concat(pick(_LIST, "doc_id"), F.coalesce("text", F.lit(""))).alias("text"))
    return mentions(d).select(F.col("page_id").alias("doc_id"), "name", "rank")


_TOWNS = ["in Begumpet, by Hitec City", "nowhere", "Abids and Kukatpally", "madhapur", None]


@query(CANDIDATES + f""", t as (select id, lower(coalesce({sql_pick(_TOWNS, "id")}, '')) as low, lower(nullif(locality, '')) as own, case when id % 3 = 0 then [] else ['quiet', 'date'] end as tags from p)
select id, 'near' as predicate, replace(x, ' ', '_') as object, 0.35::double as confidence, 'mentions ' || x as evidence from t, (select unnest({sql_list(lex.LOCALITIES)}) as x) where contains(low, x) and own is not null and own <> x
union all select id, 'recommended_for', tag, 0.5::double, 'matched intent tag ' || tag from (select id, unnest(tags) as tag from t)""")
def relations(spark, sf):
    """E10, J9."""
    from waymark.operators.extract import relations as edges

    c = candidates(spark, sf).select("id", "locality", pick(_TOWNS, "id").alias("text"), F.when(F.col("id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("quiet"), F.lit("date"))).alias("intent_tags"))
    return edges(c)


@query(CANDIDATES + """, e as (select id, name, case when id % 4 = 0 then null else ['x' || (id % 3)::varchar, name] end as aliases, address, latitude, longitude, [category] as subcategories, case when id % 3 = 0 then null else id::double / 10 end as confidence_score, ['img' || (id % 2)::varchar] as media, id % 5 as fee, id % 7 as seen from p)
select a.id, a.name, coalesce(nullif(a.address, ''), b.address) as address, coalesce(a.latitude, b.latitude) as latitude, coalesce(a.longitude, b.longitude) as longitude, list_sort(list_distinct(list_filter(list_concat(coalesce(a.aliases, []), coalesce(b.aliases, []), [b.name]), lambda x: x <> a.name))) as aliases,
 list_sort(list_distinct(list_filter(list_concat(a.subcategories, b.subcategories), lambda x: x is not null))) as subcategories, greatest(a.confidence_score, b.confidence_score) as confidence_score, case when a.media = b.media then a.media else list_concat(a.media, b.media) end as media_ids, b.fee::varchar as fee, b.seen as last_seen_at from e a join e b on b.id = a.id + 1 where a.id % 2 = 0""")
def merged_entities(spark, sf):
    """Matched entities, field by field."""
    e = candidates(spark, sf).select(
        "id", "name", F.when(F.col("id") % 4 != 0, F.array(F.concat(F.lit("x"), (F.col("id") % 3).cast("string")), "name")).alias("aliases"), "address", "latitude", "longitude", F.array_compact(F.array("category")).alias("subcategories"),
        F.when(F.col("id") % 3 != 0, F.col("id").cast("double") / 10).alias("confidence_score"), F.array(F.struct(F.concat(F.lit("img"), (F.col("id") % 2).cast("string")).alias("id"), F.lit("u").alias("url"))).alias("media"),
        F.create_map(F.lit("fee"), (F.col("id") % 5).cast("string")).alias("pricing"), (F.col("id") % 7).alias("last_seen_at"),
    )
    whole = F.struct(*e.columns)
    a, b = e.where("id % 2 = 0").select(whole.alias("a"), "id"), e.select(whole.alias("b"), (F.col("id") - 1).alias("id"))
    m = tb.merged_entities(a.join(b, "id"))
    return m.select("id", "name", "address", "latitude", "longitude", "aliases", "subcategories", "confidence_score", F.transform("media", lambda x: x.id).alias("media_ids"), F.col("pricing")["fee"].alias("fee"), "last_seen_at")


def _counted(terms: list[str]) -> str:
    return "(" + " + ".join(f"len(regexp_extract_all(hay, '[^a-z0-9]{doubled(t)}[^a-z0-9]'))" for t in terms) + ")"


def _inside(terms: list[str]) -> str:
    return "(" + " + ".join(f"(length(low) - length(replace(low, {quoted(t)}, ''))) / {len(t)}::double" for t in terms) + ")"


@query(TEXTS + f""", n as (select doc_id, {_counted(lex.POSITIVE)} as p, {_counted(lex.NEGATIVE)} as n, {_inside(lex.SIGNAL_POSITIVE)} as sp, {_inside(lex.SIGNAL_NEGATIVE)} as sn from c)
select doc_id, case when p > n * 1.3::double then 'positive' when n > p * 1.3::double then 'negative' else 'mixed' end as sentiment, case when sp + sn = 0 then 0 else round((sp - sn) / (sp + sn), 3) end as score from n""")
def document_sentiment(spark, sf):
    """A18 in both forms, with their own lists."""
    t = texts(spark, sf).select("doc_id", tx.clean(F.col("text")).alias("text"))
    return t.select("doc_id", dc.polarity(F.col("text")).alias("sentiment"), tx.substring_sentiment(F.col("text"), lex.SIGNAL_POSITIVE, lex.SIGNAL_NEGATIVE).alias("score"))


_SUITED_BY = "list_filter([" + ", ".join(f"case when {_counted(t)} > 0 then {quoted(k)} || '=' || (round(least(1.0::double, 0.25::double + 0.12::double * {_counted(t)} + 0.35::double * (id % 5 / 5::double) + least(id % 30, 20) / 100::double)::decimal(18, 9), 3)::double)::varchar end" for k, t in lex.INTENT_TERMS.items()) + "], lambda x: x is not null)"


@query(_DESCRIBED + f"select id, {_SUITED_BY} as scores from c")
def engine_suitability(spark, sf):
    """A15, A16 with the engine's terms."""
    d = described(spark, sf)
    m = dc.engine_scores(tx.clean(F.col("text")), F.col("id") % 5 / F.lit(5.0), F.col("id") % 30)
    return d.select("id", F.transform(F.map_entries(m), lambda e: F.concat(e.key, F.lit("="), e.value.cast("string"))).alias("scores"))
