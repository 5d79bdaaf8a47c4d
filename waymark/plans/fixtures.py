"""Views that give the star-schema tables texts in which the operators' words, names and addresses occur, in both dialects.

A column of a view takes its value from a list by the row's key: lists of coprime lengths meet in every combination.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.plans.views import table

NAMES = [
    "Lotus Pond Park", "Café Nirvana", "Golconda Fort", "Address: 12 Lake Road, Hyderabad 500016", "Timings: 9 am", "Events in Hyderabad", "Top 10 cafes", "What to do this weekend", "AI Labs",
    "Startup Events", "Hackathon", "Data Analytics", "Team Leadership", "Is this a place?", "Road No 12", "Charminar", "The quick brown fox jumps over the lazy dog again", "Privacy Policy",
    "Hyderabad Startup Summit", "Blue Cup | Hyderabad", "1. Green Garden", "2) Old Fort - Timings and Entry Fee", "Weekend workshops", "go to", "ab", "", "logo.png", "Booking Guide", "Bar", "Sunday Market Collection",
    "about the lake", "Contact Club", "Near Charminar", "Read more", "home", "LinkedIn", "Trips to Fort", "Naïve Restaurant (2021)", "places to visit", "Blue Cup: Review of it", "Photos Image Blue Lounge", "MORE",
    "Palace – History", "museum", "Old city walk", "check post", "10 best rooftop bars", "Summer Music Festival", "Ｆｕｌｌ Ⅳ ½ ﬁne Temple", "Blue Cup Cafe", "Open Mic Night", "Kids & Family Zone", "Photo review Old Fort",
]
CATEGORIES = ["restaurant", "cafe", "park", "event", "community", "place", "web_entity", "business", "police", "startup", "hotels hyderabad", "lake", None]
PLACES = ["Begumpet", "Hyderabad", None, "Madhapur", "", "Banjara Hills", "hyderabad"]
ADDRESSES = [
    "12 Lake Road, Begumpet, Hyderabad 500016", None, "Plot 4, Madhapur, Telangana", "somewhere", "", "Shop 2, 500081", "github pull request, Hyderabad road", "Near the old fort, Charminar, Hyderabad",
    "Road", "Street 9, Warangal", "Floor 3, Jubilee Hills, Hyderabad",
]
SOURCES = ["web_page", "openstreetmap,web_page", "web_page,web_page", "wikipedia", ""]
TYPES = ["source_page_mention", "webpage", "source_page_mention,webpage"]
PRECISIONS = ["geocoded", "unresolved", None, "source_page_coordinates"]
PHRASES = [
    "Open daily 9 am to 11 pm, late night after midnight.", "Free entry for all; 1,200 members; a workshop on Mar 3, 2024 was cancelled.", "Rs. 1,200 for two, tickets ₹300 and ₹ 50 each.", "Rated 4.5/5 by 2,310 reviews.",
    "A quiet peaceful lake walk for couples and families, less crowded in the morning.", "Startup founder meetup with investors; wifi, laptop friendly, 350 followers.", "A temple for darshan, spiritual and serene at sunset.",
    "Address: 8-2-12 Road No 2, Banjara Hills, Hyderabad 500034.", "Write to a.b@example.org or +91 9876543210 today.", "Find us at 17.44470, 78.46650 near the gate.", "We are open 24 hours, with valet parking.",
    "Too loud, crowded, overpriced; no parking and unsafe at night.", "Membership needed for the badminton club, NGO volunteers welcome.", "The concert is postponed to 5 may 2025, register for a ticket.", "Blue Cup Hyderabad and Old Fort Hyderabad are near. Blue cup Hyderabad again.",
    "", "Rooftop bar with a dj, live music and cocktails; not for families.", "Beginner friendly yoga, safe for women, no entry fee.", "Best hidden gem: cheap street food, people say it is good.",
]
SITES = [
    "https://www.zomato.com/blue-cup", "http://Example.org:8080/a/b", None, "https://maps.google.com/maps?q=17.44470,78.46650", "https://www.google.com/maps/place/@17.4447,78.4665,15z", "https://lbb.in/login", "mailto:a@b.org",
    "https://x.example/?ll=78.46650,17.44470", "https://x.example/!3d17.4447!4d78.4665", "https://x.example/!2d78.46!3d17.44", "not a url",
]


def quoted(x: str | None) -> str:
    return "null" if x is None else "'" + x.replace("'", "''") + "'"


def sql_list(xs: list) -> str:
    return "[" + ", ".join(map(quoted, xs)) + "]"


def sql_pick(xs: list, key: str) -> str:
    return f"({sql_list(xs)})[1 + ({key}) % {len(xs)}]"


def pick(xs: list, key: str) -> Column:
    return F.element_at(F.array(*[F.lit(x).cast("string") for x in xs]), (F.col(key) % len(xs) + 1).cast("int"))


def pieces(x: Column) -> Column:
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, ","))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw candidates of the refinement."""
    k = "c_custkey"
    c = table(spark, sf_dir, "customer").select(k)
    return c.select(
        F.col(k).cast("bigint").alias("id"), pick(NAMES, k).alias("name"), pick(CATEGORIES, k).alias("category"), F.expr(f"if({k} % 17 = 0, 'park', null)").alias("primary_category"), pick(PLACES, k).alias("locality"),
        pick(ADDRESSES, k).alias("address"), F.expr(f"if({k} % 2 = 0, 17.2D + ({k} * 37 % 1000) / 2000D, null)").alias("latitude"), F.expr(f"if({k} % 2 = 0, 78.2D + ({k} * 53 % 1000) / 2500D, null)").alias("longitude"),
        F.expr(f"if({k} % 9 = 0, concat('https://site', cast({k} as string), '.example'), null)").alias("website"), F.expr(f"{k} % 19 = 0").alias("has_contact"), F.expr(f"{k} % 23 = 0").alias("has_social"),
        F.expr(f"{k} % 4 < 2").alias("has_media"), F.expr(f"{k} % 29 = 0").alias("event_known"), F.expr(f"{k} % 31 = 0").alias("community_known"), pieces(pick(SOURCES, k)).alias("source_names"), pieces(pick(TYPES, k)).alias("source_types"),
        pick(PRECISIONS, k).alias("geo_precision"), F.expr(f"if({k} % 37 = 0, 'REJECTED_PAGE_FRAGMENT', 'ACTIVE')").alias("status"), F.expr(f"if({k} % 8 = 0, 'mentioned_entity', 'page')").alias("extraction_mode"),
    )


def _pieces(xs: list, key: str) -> str:
    return f"case when {sql_pick(xs, key)} = '' then []::varchar[] else string_split({sql_pick(xs, key)}, ',') end"


_K = "c_custkey"
CANDIDATES = f"""
with p as (
  select {_K}::bigint as id, {sql_pick(NAMES, _K)} as name, {sql_pick(CATEGORIES, _K)} as category, case when {_K} % 17 = 0 then 'park' end as primary_category, {sql_pick(PLACES, _K)} as locality,
    {sql_pick(ADDRESSES, _K)} as address, case when {_K} % 2 = 0 then 17.2::double + ({_K} * 37 % 1000) / 2000::double end as latitude, case when {_K} % 2 = 0 then 78.2::double + ({_K} * 53 % 1000) / 2500::double end as longitude,
    case when {_K} % 9 = 0 then 'https://site' || {_K}::varchar || '.example' end as website, {_K} % 19 = 0 as has_contact, {_K} % 23 = 0 as has_social, {_K} % 4 < 2 as has_media, {_K} % 29 = 0 as event_known,
    {_K} % 31 = 0 as community_known, {_pieces(SOURCES, _K)} as source_names, {_pieces(TYPES, _K)} as source_types, {sql_pick(PRECISIONS, _K)} as geo_precision,
    case when {_K} % 37 = 0 then 'REJECTED_PAGE_FRAGMENT' else 'ACTIVE' end as status, case when {_K} % 8 = 0 then 'mentioned_entity' else 'page' end as extraction_mode
  from customer)
"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a phrase of an entity behind each whole text."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), pick(PHRASES, "doc_id")).alias("text"))


#: t: texts; c: collapsed and lower-case ones, and hay, the lower-case text between blanks with every sign doubled, for terms at boundaries.
TEXTS = rf"""
with t as (select doc_id, coalesce(text, '') || chr(10) || {sql_pick(PHRASES, "doc_id")} as text from documents),
x as (select doc_id, trim(regexp_replace(text, '[\s\x0b\x{{85}}\p{{Z}}]+', ' ', 'g')) as text from t),
c as (select doc_id, text, lower(text) as low, ' ' || regexp_replace(lower(text), '([^a-z0-9])', '\1\1', 'g') || ' ' as hay from x)
"""


def any_in(x: str, terms: list[str]) -> str:
    """SQL: one of the terms stands anywhere in x."""
    return "(" + " or ".join(f"contains({x}, {quoted(t)})" for t in terms) + ")" if terms else "false"


def any_match(x: str, patterns: list[str]) -> str:
    return "(" + " or ".join(f"regexp_matches({x}, {quoted(p)})" for p in patterns) + ")"


def doubled(term: str) -> str:
    import re

    return re.sub(r"([^a-z0-9])", lambda m: re.escape(m[1]) * 2, term)


def bounded_any(terms: list[str], hay: str = "hay") -> str:
    """SQL: one of the terms stands between signs of hay."""
    return f"regexp_matches({hay}, '[^a-z0-9](?:{'|'.join(map(doubled, terms))})[^a-z0-9]')"


def keys_where(rules: dict[str, str]) -> str:
    """SQL: the list of keys whose conditions hold."""
    return "list_filter([" + ", ".join(f"case when {c} then {quoted(k)} end" for k, c in rules.items()) + "], lambda x: x is not null)"


def first_case(rules: list[tuple[str, str]], otherwise: str) -> str:
    return "case " + " ".join(f"when {c} then {quoted(k)}" for k, c in rules) + f" else {quoted(otherwise)} end"


def chain(x: str, steps: list[tuple[str, str, str]]) -> str:
    """SQL: regexp_replace after regexp_replace; steps of pattern, replacement, flags."""
    for p, by, flags in steps:
        x = f"regexp_replace({x}, {quoted(p)}, {quoted(by)}{', ' + quoted(flags) if flags else ''})"
    return x


LINKS = [
    '<a href="https://www.instagram.com/x">Follow us</a><a href="/book-now">Reserve a table</a><img src="/img/a.png" alt="Blue Cup interior by night"><img src="//cdn.example/b.png" title="Old fort">',
    '<a href="https://events.example/hyderabad-cafe?x=1#y">Buy tickets</a><a href="menu.html">Our Menu</a><meta property="og:image" content="/og.png"><img src="data:image/png;base64,AA"><h2>Places to eat</h2><h4>Blue Cup Cafe</h4>',
    '<a href="https://maps.google.com/maps?q=17.44470,78.46650">Find us</a><a href="https://wa.me/123">Chat</a><a href="../up/venue">Venue</a><a href="?page=2">Calendar</a><a href="#top">places</a><li>Old Fort Museum</li>',
    '<a href="mailto:a@b.org">events mail</a><a href="javascript:void(0)">cafe</a><a href="/login?next=cafe">cafe login</a><a href="https://x.com/abc">x</a>',
    "",
]


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with links, pictures and headings of an entity behind each whole html."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url", F.concat(F.coalesce("html", F.lit("")), pick(LINKS, "page_id")).alias("html"))


WEB_PAGES = f"with w as (select page_id, url, coalesce(html, '') || {sql_pick(LINKS, 'page_id')} as html from pages)\n"

_AMENITY = ["cafe", "bank", "place_of_worship", None, "college", "fuel", "nightclub"]
_TOURISM = [None, "museum", None, "viewpoint", None]
_SPORT = [None, None, "cricket"]
_NATURAL = [None, "water", None, None, None, None, None, None, None, None, "tree"]


def map_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as map elements with tags, of which some lack a name, a position or a category."""
    k = "p_partkey"
    t = table(spark, sf_dir, "part").select(k, "p_name")
    entries = {
        "name": F.expr(f"if({k} % 10 = 0, null, if({k} % 10 = 1, 'ab', concat('  ', p_name)))"), "brand": F.expr(f"if({k} % 10 < 2 and {k} % 3 = 0, 'Blue  Brand', null)"), "amenity": pick(_AMENITY, k), "tourism": pick(_TOURISM, k),
        "sport": pick(_SPORT, k), "natural": pick(_NATURAL, k), "historic": F.expr(f"if({k} % 41 = 0, 'yes', null)"), "addr:suburb": F.expr(f"if({k} % 6 = 0, 'Alwal', if({k} % 6 = 1, 'Hyderabad', null))"),
        "addr:street": F.expr(f"if({k} % 5 = 0, 'Lake Road', null)"), "addr:housenumber": F.expr(f"if({k} % 5 = 0, cast({k} as string), null)"), "alt_name": F.expr(f"if({k} % 8 = 0, 'Two; One |Two', null)"),
        "cuisine": F.expr(f"if({k} % 9 = 0, 'thai; indian,thai', null)"), "wifi": F.expr(f"if({k} % 12 = 0, 'yes', null)"), "wheelchair": F.expr(f"if({k} % 14 = 0, 'Limited', null)"), "opening_hours": F.expr(f"if({k} % 15 = 0, '24/7', null)"),
        "phone": F.expr(f"if({k} % 16 = 0, '123', null)"), "website": F.expr(f"if({k} % 17 = 0, 'https://w.example', null)"), "wikipedia": F.expr(f"if({k} % 18 = 0, 'te:Old Fort', if({k} % 18 = 1, 'Old Fort', null))"), "fee": F.expr(f"if({k} % 20 = 0, 'no', null)"),
        "contact:facebook": F.expr(f"if({k} % 22 = 0, 'fb', null)"), "image": F.expr(f"if({k} % 26 = 0, 'http://i.example/1.png', if({k} % 26 = 1, 'x.png', null))"), "wikimedia_commons": F.expr(f"if({k} % 28 = 0, 'File:Old fort.jpg', null)"),
    }
    pairs = F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(n).alias("key"), v.alias("value"))) for n, v in entries.items()]))
    return t.select(
        F.lit("node").alias("type"), F.col(k).cast("bigint").alias("id"), F.expr(f"if({k} % 11 = 0, null, 17.3D + ({k} % 300) / 1000D)").alias("lat"), F.expr(f"if({k} % 13 = 0, null, 78.3D + ({k} % 200) / 1000D)").alias("lon"),
        F.expr(f"if({k} % 22 = 0, named_struct('lat', 17.4D, 'lon', 78.4D), null)").alias("center"), F.map_from_entries(F.when(F.col(k) % 97 != 0, pairs).otherwise(F.slice(pairs, 1, 0))).alias("tags"),
    )


_P = "p_partkey"
MAP_ELEMENTS = f"""
with m as (select p_partkey::bigint as id, p_partkey % 97 = 0 as untagged, case when {_P} % 10 = 0 then null when {_P} % 10 = 1 then 'ab' else '  ' || p_name end as name, case when {_P} % 10 < 2 and {_P} % 3 = 0 then 'Blue  Brand' end as brand,
  {sql_pick(_AMENITY, _P)} as amenity, {sql_pick(_TOURISM, _P)} as tourism, {sql_pick(_SPORT, _P)} as sport, {sql_pick(_NATURAL, _P)} as natural_, case when {_P} % 41 = 0 then 'yes' end as historic,
  case when {_P} % 6 = 0 then 'Alwal' when {_P} % 6 = 1 then 'Hyderabad' end as suburb, case when {_P} % 5 = 0 then 'Lake Road' end as street, case when {_P} % 5 = 0 then {_P}::varchar end as house, {_P} % 8 = 0 as aliased,
  {_P} % 9 = 0 as thai, {_P} % 12 = 0 as wifi, {_P} % 14 = 0 as limited, {_P} % 15 = 0 as always, {_P} % 16 = 0 as phoned, {_P} % 17 = 0 as sited, {_P} % 18 as wiki, {_P} % 20 = 0 as fee, {_P} % 22 = 0 as fb, {_P} % 26 as pictured, {_P} % 28 = 0 as commons,
  coalesce(case when {_P} % 11 = 0 then null else 17.3::double + ({_P} % 300) / 1000::double end, case when {_P} % 22 = 0 then 17.4::double end) as lat,
  coalesce(case when {_P} % 13 = 0 then null else 78.3::double + ({_P} % 200) / 1000::double end, case when {_P} % 22 = 0 then 78.4::double end) as lon from part)
"""


def served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star schema's places as whole entities, with sources, pictures, relations and scores; some repeat others' names and positions."""
    from waymark.plans.views import entities

    e = entities(spark, sf_dir)
    arr = lambda n, row: f"if({n} <= 0, array(), transform(sequence(0, greatest({n}, 1) - 1), j -> {row}))"
    source = "named_struct('source', concat('src', cast(j as string)), 'url', if(j = 1, null, concat('http://s', cast(id % 50 as string), '.example')), 'source_type', 'webpage', 'raw_path', cast(null as string), 'extraction_confidence', 0.5D)"
    picture = "named_struct('id', if(j = 0, image_id, cast(null as string)), 'url', concat('http://img', cast(id as string), '/', cast(j % 2 as string)), 'source', 'web_page', 'caption', 'front', 'labels', array('a'), 'is_primary', j = 1)"
    return e.selectExpr(
        "id", "concat('Place ', cast(id % 200 as string), if(id % 2 = 0, ' near the Golkonda', '')) as name", "'place' as entity_type", "category", "cast(null as string) as primary_category", "array(category) as subcategories", "description", "locality", "address", "latitude", "longitude",
        "concat('http://w', cast(id as string)) as website", "if(id % 53 = 0, 'REJECTED_PAGE_FRAGMENT', 'ACTIVE') as status", "confidence", "rating", "rating_count", "timings", "intent_tags", "array_sort(array_union(intent_tags, array(category))) as context_keys", "array('places') as branch_ids",
        "if(size(intent_tags) = 0, map(), map('solo', 0.25D + (id % 4) / 10D)) as suitability_scores", f"{arr('n_sources', source)} as sources", f"if(image_id is null, array(), {arr('(id % 3) + 1', picture)}) as media",
        "array(named_struct('predicate', 'near', 'object_id', cast(id + 1 as string), 'object_name', 'next', 'confidence', 0.35D, 'evidence', 'first', 'source_url', cast(null as string)), named_struct('predicate', if(id % 2 = 0, 'near', 'in'), 'object_id', cast(id + 1 as string), 'object_name', 'next', 'confidence', 0.4D, 'evidence', 'second', 'source_url', cast(null as string))) as relationships",
    )


def sidecars(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reviews (conversations), source pages (pages) and landed pictures of the served places."""
    r = table(spark, sf_dir, "conversations").selectExpr(
        "if(turn % 5 = 4, null, concat('r', cast(conv_id as string), '-', cast(turn as string))) as id", "cast(conv_id * 3 as string) as entity_id", "role as source", "cast(turn % 6 as double) as rating", "text", "'mixed' as sentiment", "0D as sentiment_score", "array(role) as topics"
    )
    p = table(spark, sf_dir, "pages").selectExpr("url", "concat('t', cast(page_id as string)) as title", "cast(null as string) as description", "'web_page' as source", "'source_page' as source_type", "lpad(cast(page_id as string), 9, '0') as raw_path", "if(page_id % 3 = 0, null, page_id % 3 = 1) as is_source_page", "'q' as search_query", "cast(page_id % 10 as int) as search_rank")
    i = table(spark, sf_dir, "customer").selectExpr("c_custkey", "explode(array(0, 1)) as j").where("(c_custkey + j) % 7 <> 0").selectExpr("concat('http://img', cast(c_custkey as string), '/', cast(j as string)) as url", "'image/png' as mime_type", "cast(1000 + j as bigint) as byte_size", "if(c_custkey % 4 = 0, 'same', concat('h', cast(c_custkey as string), '-', cast(j as string))) as content_hash")
    return r, p, i
