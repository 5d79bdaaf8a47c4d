"""From raw candidates to entities that can be served: identity, decisions, geocode and picture gates, and web evidence.

Candidates are rows with name, category, primary_category, locality, address, latitude, longitude, website, has_contact, has_social, has_media,
event_known, community_known, source_names, source_types (arrays), geo_precision and status; others pass through. Nulls count as absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.functions import lexicons as lex
from waymark.functions import names as nm
from waymark.functions.documents import listed, united
from waymark.functions.text import clean

REJECTED = "REJECTED_PAGE_FRAGMENT"


def yes(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def has(c: str) -> Column:
    return nm.known(F.col(c))


def placed() -> Column:
    return F.col("latitude").isNotNull() & F.col("longitude").isNotNull()


def low_name() -> Column:
    return F.lower(F.trim(F.coalesce("name", F.lit(""))))


def own_category() -> Column:
    return F.lower(F.trim(F.coalesce(F.nullif("primary_category", F.lit("")), "category", F.lit(""))))


def shapes() -> dict[str, Column]:
    """What decisions need of a row, as columns of their own."""
    low, category = low_name(), own_category()
    sources = F.array_distinct(F.coalesce("source_names", F.array().cast("array<string>")))
    return {
        "__low": low, "__category": category, "__words": F.size(nm.tokens(low)), "__hint": nm.place_hint(low), "__collection": nm.collection(low), "__instruction": nm.instruction(low),
        "__fragment": nm.fragment(low), "__abstract": nm.abstract(low, category), "__event_name": nm.generic_event(low), "__open_source": F.arrays_overlap(sources, nm.words(lex.OPEN_SOURCES)),
        "__single": F.coalesce(F.array_contains("source_types", "source_page_mention"), F.lit(False)) & (F.size(sources) == 1),
        "__reachable": has("website") | yes("has_contact") | yes("has_social"),
    }


def geocode_only() -> Column:
    """Named by a single page, with a position that only a geocoder gave, and nothing that tells it is a place."""
    return F.col("__single") & F.coalesce(F.col("geo_precision") == "geocoded", F.lit(False)) & ~F.col("__reachable") & ~F.col("__hint") & ~yes("event_known")


def bad_geocoded() -> Column:
    return geocode_only() & ((F.col("__words") <= 3) | F.col("__abstract") | F.col("__collection"))


def strong_identity() -> Column:
    """The first rule that applies tells whether the evidence for a thing is strong; rules read the shapes' columns."""
    bare = F.col("__single") & F.col("latitude").isNull() & ~has("address") & ~F.col("__reachable") & ~yes("event_known")
    return (
        F.when(geocode_only() | bare, False).when(placed() & has("address"), True).when(F.col("__open_source") & ~F.col("__category").isin(lex.NO_CARDS), True)
        .when(has("website") & ~F.col("__collection"), True).when(yes("has_contact") | yes("has_social"), True).when(yes("event_known") | yes("community_known"), ~F.col("__collection"))
        .otherwise(F.col("__hint") & (has("locality") | has("address") | yes("has_media")))
    )


def rejections() -> dict[str, Column]:
    """Reasons that reject a candidate outright; the first one counts."""
    c, weak = F.col, ~F.col("__strong")
    return {
        "empty_or_short_name": F.length("__low") < 3, "non_card_map_infrastructure": c("__category").isin(lex.NO_CARDS), "instruction_article_or_page_furniture": c("__instruction"),
        "bad_fragment_geocoded_from_page_text": bad_geocoded(), "sentence_like_page_mention_without_location": c("__single") & (c("__words") > 6) & ~has("address") & c("latitude").isNull(),
        "collection_or_search_result_heading": c("__collection") & weak, "abstract_topic_not_entity": c("__abstract") & weak, "generic_event_or_topic_name": c("__event_name") & weak,
    }


def weighed() -> dict[str, Column]:
    """Reasons that count for or against a candidate, each with its weight."""
    c = F.col
    return {
        "long_phrase_name": c("__words") > 8, "page_or_navigation_phrase": c("__fragment"), "field_label_extracted_as_name": c("__low").rlike("^(?:address:|timings:|entry fee)"),
        "question_title": F.contains(c("__low"), F.lit("?")), "real_entity_name_hint": c("__hint"), "strong_identity_evidence": c("__strong"),
        "specific_category": has("category") & ~c("category").isin("place", "web_entity"), "has_locality": has("locality"), "has_address": has("address"), "has_coordinates": placed(),
        "has_media": yes("has_media"), "has_website": has("website"), "trusted_structured_source": c("__open_source"), "single_source_page_mention": c("__single"),
        "single_generic_token": (c("__words") == 1) & ~c("__hint"), "generic_collection_heading": c("__collection"),
    }


def decided(candidates: DataFrame) -> DataFrame:
    """Candidates with decision (reject_page_fragment, needs_enrichment, serve), decision_score and decision_reasons."""
    rows = candidates.withColumns(shapes())
    rows = rows.withColumn("__strong", strong_identity())
    hard = rejections()
    reject = F.coalesce(*[F.when(F.coalesce(v, F.lit(False)), F.lit(k)) for k, v in hard.items()])
    rules = {k: F.coalesce(v, F.lit(False)) for k, v in weighed().items()}
    total = F.lit(0.0)
    for k, v in rules.items():
        total = total + F.when(v, F.lit(float(lex.DECISION_WEIGHTS[k]))).otherwise(F.lit(0.0))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.45 + total))
    thin = F.col("__single") & ~F.col("__strong") & ~F.col("__hint")
    rows = rows.withColumns({"__reject": reject, "__score": F.when(thin, F.least(score, F.lit(0.59))).otherwise(score), "__thin": thin})
    rejected = F.coalesce(*[F.when(F.col("__reject") == k, F.lit(float(v))) for k, v in lex.REJECT_SCORES.items()])
    decision = F.when(F.col("__reject").isNotNull() | (F.col("__score") < 0.42), "reject_page_fragment").when((F.col("__score") < 0.72) | ~F.col("__strong"), "needs_enrichment").otherwise("serve")
    reasons = F.when(F.col("__reject").isNotNull(), F.array("__reject")).otherwise(listed(rules | {"insufficient_identity_for_single_page_mention": F.col("__thin")}))
    out = rows.withColumns({"decision": decision, "decision_score": F.round(F.coalesce(rejected, "__score"), 3), "decision_reasons": reasons, "strong_identity": F.col("__strong")})
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def geocode_gate(decided_: DataFrame) -> DataFrame:
    """Decided candidates with geocode_query (null where none is to be asked) and wants_image (whether a free picture is to be looked for)."""
    rows = decided_.withColumns(shapes())
    open_ = ~F.col("__category").isin(lex.NO_CARDS)
    named = ~F.col("__collection") & ~F.col("__instruction")
    wanted = (F.col("decision") != "reject_page_fragment") & open_ & named & (F.col("strong_identity") | (F.col("__hint") & has("locality")))
    missing = ~placed() | ~has("address")
    parts = F.array_distinct(F.array_compact(F.array(F.trim("name"), F.nullif("locality", F.lit("")), F.lit("Hyderabad"), F.lit("Telangana"), F.lit("India"))))
    query = F.when(wanted & missing & ~F.col("__fragment"), F.array_join(parts, ", "))
    image = open_ & F.coalesce(F.col("status") != REJECTED, F.lit(True)) & placed() & has("address") & named & (F.col("strong_identity") | F.col("__hint"))
    out = rows.withColumns({"geocode_query": query, "wants_image": image})
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def refined(candidates: DataFrame, geocodes: DataFrame | None = None) -> DataFrame:
    """Clean names, take an address out of a name, drop bad addresses and the positions made from them, decide, fill from geocoder
    answers (id, latitude, longitude, locality, address: one row for each id), decide again, and set the status."""
    named = candidates.withColumn("name", nm.card_name(F.col("name")))
    promoted = F.nullif(F.trim(F.regexp_extract("name", r"(?i)^address\s*:\s*(.+)$", 1)), F.lit(""))
    rows = named.withColumn("address", F.coalesce(F.nullif("address", F.lit("")), promoted))
    rows = rows.withColumn("__bad", F.coalesce(nm.bad_address(F.col("address")), F.lit(False)))
    derived = F.col("__bad") & F.coalesce(F.col("geo_precision").isin("source_page_coordinates", "verified_address_geocoded"), F.lit(False))
    rows = rows.withColumn("__derived", derived)
    rows = rows.withColumns({
        "address": F.when(~F.col("__bad"), F.col("address")), **{c: F.when(~F.col("__derived"), F.col(c)) for c in ("latitude", "longitude")},
        "geo_precision": F.when(F.col("__derived"), F.lit("unresolved")).otherwise(F.col("geo_precision")),
    }).drop("__bad", "__derived")
    once = decided(rows)
    if geocodes is not None:
        asked = geocode_gate(once)
        answers = geocodes.select("id", *[F.col(c).alias(f"__{c}") for c in ("latitude", "longitude", "locality", "address")])
        both = asked.join(answers, "id", "left")
        use = F.col("geocode_query").isNotNull() & F.col("__latitude").isNotNull() & F.col("__longitude").isNotNull()
        filled = both.withColumn("__use", use).withColumns({
            **{c: F.when(F.col("__use"), F.col(f"__{c}")).otherwise(F.col(c)) for c in ("latitude", "longitude")},
            "address": F.when(F.col("__use"), F.coalesce("address", "__address")).otherwise(F.col("address")),
            "locality": F.when(F.col("__use"), F.coalesce(F.nullif("locality", F.lit("")), "__locality", F.lit("Hyderabad"))).otherwise(F.col("locality")),
            "geo_precision": F.when(F.col("__use"), F.lit("geocoded")).otherwise(F.col("geo_precision")),
        })
        # A candidate that was rejected before the geocoder was asked stays so.
        final = F.col("decision") == "reject_page_fragment"
        first = filled.withColumn("__first", F.when(final, F.struct("decision", "decision_score", "decision_reasons", "strong_identity")))
        first = first.drop("geocode_query", "wants_image", "__use", "__latitude", "__longitude", "__locality", "__address", "decision", "decision_score", "decision_reasons", "strong_identity")
        again = decided(first.withColumnRenamed("__first", "first_decision"))
        once = again.withColumns({c: F.coalesce(F.col(f"first_decision.{c}"), F.col(c)) for c in ("decision", "decision_score", "decision_reasons", "strong_identity")}).drop("first_decision")
    status = F.when(F.col("decision") == "reject_page_fragment", REJECTED).when(F.col("decision") == "serve", "ACTIVE").otherwise("NEEDS_ENRICHMENT")
    return once.withColumns({"status": status, "needs_human_review": F.col("decision") != "serve", "review_reason": F.nullif(F.array_join(F.slice("decision_reasons", 1, 4), ", "), F.lit(""))})


def image_page_matches(name: Column, title: Column, extract: Column) -> Column:
    """Whether a page that a free picture comes from is of the entity: two of its name's words in the title, or one and the city in the text."""
    own = F.array_distinct(F.filter(nm.tokens(name), lambda t: (F.length(t) > 2) & ~t.isin(lex.IMAGE_STOPS)))
    hits = F.size(F.array_intersect(own, nm.tokens(title)))
    city = nm.meets(nm.tokens(extract), ["hyderabad", "telangana", "india"])
    return F.coalesce((F.size(own) > 0) & ((hits >= F.least(F.lit(2), F.size(own))) | ((hits > 0) & city)), F.lit(False))


# Web evidence --------------------------------------------------------------------------------------------------------


def web_queries(name: Column, locality: Column, category: Column) -> Column:
    """Queries that ask the web for an entity, distinct in order."""
    place = F.when(F.lower(locality) != "hyderabad", F.nullif(locality, F.lit("")))
    core = F.concat_ws(" ", F.nullif(nm.search_name(name), F.lit("")), place, F.lit("Hyderabad"))
    asked = [F.concat(core, F.lit(f" {t}")) for t in ("address latitude longitude", "Zomato", "Google Maps", "photos")]
    menu = F.when(F.coalesce(category == "restaurant", F.lit(False)), F.concat(core, F.lit(" restaurant address menu")))
    return F.array_distinct(F.array_compact(F.array(asked[0], menu, *asked[1:])))


def gap_queries(name: Column, locality: Column, missing: Column, blocked: Column, address: Column) -> Column:
    """Queries that may fill an entity's gaps, distinct whatever their case; none for what is no entity."""
    base = F.concat(nm.query_name(name), F.lit(" "), F.coalesce(F.nullif(locality, F.lit("")), F.lit("Hyderabad")))
    said = lambda t: F.concat(base, F.lit(f" {t}"))
    lost = nm.meets(missing, ["latitude", "longitude"])
    unaddressed = F.array_contains(missing, "address") | ~nm.known(address)
    shown = F.array_contains(missing, "image")
    rules = [(lost, "exact location"), (lost, "address"), (unaddressed, "address timings"), (shown, "photos"), (shown, "images")]
    queries = F.array_compact(F.array(*[F.when(c, said(t)) for c, t in rules]))
    return F.when(nm.meets(blocked, ["source_or_article_title", "not_recommendation_entity"]), F.array().cast("array<string>")).otherwise(queries)


def evidence_fields(text: Column) -> dict[str, Column]:
    """What a page's text says of an entity's fields."""
    x = clean(F.coalesce(text, F.lit("")))
    low = F.lower(x)
    one = lambda p, g=1, c=low: F.nullif(F.regexp_extract(c, p, g), F.lit(""))
    return {
        "address": nm.address_in(x), "position": nm.position_in_text(x), "phone": one(lex.PHONE, 0, x), "rating": one(lex.EVIDENCE_RATING).try_cast("double"), "rating_count": nm.whole(one(lex.RATING_COUNT)),
        "opening_hours": one(lex.EVIDENCE_HOURS), "price": F.concat(F.lit("₹"), one(lex.EVIDENCE_PRICE)), "amenities": listed({t: F.contains(low, F.lit(t)) for t in lex.EVIDENCE_AMENITIES}),
        "cuisines": listed({t: F.contains(low, F.lit(t)) for t in lex.CUISINES}),
    }


def evidence_confidence(name: Column, hay: Column, source: Column, filled: Column) -> Column:
    """Confidence that a page is of the entity; null where it is not: neither city nor name, a generic name, or below 0.45.

    hay: the page's title, text, address and url; filled: how many of address, position, pictures, phone and rating it has.
    """
    low, own = F.lower(hay), nm.evidence_tokens(name)
    hits = F.size(F.filter(own, lambda t: F.contains(low, t)))
    bonus = F.when(source.isin(lex.TRUSTED_SITES), 0.1).otherwise(0.0)
    score = F.least(F.lit(1.0), hits / F.greatest(F.lit(1), F.size(own)) * 0.55 + filled * 0.12 + bonus)
    local = F.contains(low, F.lit("hyderabad")) | F.contains(low, F.lit("telangana"))
    return F.when(local & (F.size(own) > 0) & ~nm.generic_event(F.lower(F.trim(name))) & (score >= 0.45), score)


def best_evidence(evidence: DataFrame, most: int = 4) -> DataFrame:
    """evidence (id, position_in_search, url, confidence, ...): of each entity the first `most` matching ones, best first (rank from 1)."""
    first = Window.partitionBy("id").orderBy("position_in_search", "url")
    rank = Window.partitionBy("id").orderBy(F.desc("confidence"), "position_in_search", "url")
    taken = evidence.where(F.col("confidence").isNotNull()).withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= most).drop("__n")
    return taken.withColumn("rank", F.row_number().over(rank))


def merged_evidence(entities: DataFrame, evidence: DataFrame) -> DataFrame:
    """Entities with the gaps that their best evidence (rank 1 of best_evidence) fills, and the number of pieces of evidence.

    Values that an entity has stay; a position comes from the evidence only as a pair; amenities, subcategories and tags are united.
    """
    best = evidence.where("rank = 1").select("id", F.struct(*[c for c in evidence.columns if c != "id"]).alias("__e"))
    count = evidence.groupBy("id").agg(F.count("*").alias("evidence_count"))
    rows = entities.join(best, "id", "left").join(count, "id", "left")
    e = lambda c: F.col(f"__e.{c}")
    pair = ~placed() & e("latitude").isNotNull() & e("longitude").isNotNull()
    address = F.coalesce(F.nullif("address", F.lit("")), F.when(nm.valid_address(e("address")), e("address")))
    slugs = F.transform(F.coalesce(e("cuisines"), F.array().cast("array<string>")), lambda c: F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", ""))
    rows = rows.withColumns({"__pair": pair, "__address": address, "__slugs": slugs, "__touched": F.col("__e").isNotNull()})
    told = nm.named_locality(F.coalesce("__address", e("text")), lex.EVIDENCE_LOCALITIES)
    locality = F.coalesce(F.when(F.lower("locality") != "hyderabad", F.nullif("locality", F.lit(""))), told, F.lit("Hyderabad"))
    out = rows.withColumns({
        "address": F.col("__address"), "latitude": F.when(F.col("__pair"), e("latitude")).otherwise(F.col("latitude")), "longitude": F.when(F.col("__pair"), e("longitude")).otherwise(F.col("longitude")),
        "geo_precision": F.when(F.col("__pair"), F.lit("source_page_coordinates")).otherwise(F.col("geo_precision")), "locality": F.when(F.col("__touched"), locality).otherwise(F.col("locality")),
        "phone_numbers": united(F.col("phone_numbers"), F.array_compact(F.array(e("phone")))), "opening_hours_raw": F.coalesce("opening_hours_raw", e("opening_hours")), "price_level": F.coalesce("price_level", e("price")),
        "rating": F.coalesce("rating", e("rating")), "rating_count": F.coalesce("rating_count", F.when(e("rating").isNotNull(), e("rating_count"))), "amenities": united(F.col("amenities"), e("amenities")),
        "subcategories": united(F.col("subcategories"), F.col("__slugs")), "intent_tags": united(F.col("intent_tags"), F.col("__slugs")), "evidence_count": F.coalesce("evidence_count", F.lit(0)),
    })
    return out.drop("__e", "__pair", "__address", "__slugs", "__touched")


def best_images(entities: DataFrame, images: DataFrame, most: int = 4, least: float = 0.45) -> DataFrame:
    """images (id, url, confidence): the best `most` of each entity (id, name, media_urls) that it does not have yet and that score `least` or more.

    The score is from the evidence's confidence, whether a word of the name stands in the url, and marks of logos. Ties go to the larger url.
    """
    rows = images.join(entities.select("id", "name", "media_urls"), "id")
    new = F.col("url").rlike("^https?://") & ~F.coalesce(F.array_contains("media_urls", F.col("url")), F.lit(False))
    low = F.lower(F.url_decode(F.regexp_replace("url", r"%(?![0-9A-Fa-f]{2})|\+", "")))
    named = F.exists(nm.evidence_tokens(F.col("name")), lambda t: F.contains(low, t))
    score = 0.35 + F.col("confidence") * 0.4 + F.when(named, 0.25).otherwise(0.0) - F.when(nm.holds(low, lex.POOR_IMAGES), 0.4).otherwise(0.0)
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), F.desc("url")))
    ranked = rows.where(new).withColumn("score", score).withColumn("rank", rank).where(F.col("rank") <= most).where(F.col("score") >= least)
    first = (F.col("rank") == 1) & (F.coalesce(F.size("media_urls"), F.lit(0)) <= 0)
    return ranked.select("id", "rank", "url", F.round(F.least(F.lit(1.0), F.col("score")), 3).alias("score"), first.alias("is_primary"))


def mention_media(name: Column, images: Column, most: int = 4) -> Column:
    """Pictures of a page (src, alt, title) whose texts hold a long word of the name, each url once; the first is primary."""
    own = F.array_distinct(F.filter(nm.tokens(name), lambda t: F.length(t) > 3))
    said = lambda i: F.lower(F.concat_ws(" ", F.coalesce(i.alt, F.lit("")), F.coalesce(i.title, F.lit("")), i.src))
    fit = F.filter(images, lambda i: i.src.rlike("^https?://") & F.exists(own, lambda t: F.contains(said(i), t)))
    once = F.filter(fit, lambda i, n: F.array_position(F.transform(fit, lambda j: j.src), i.src) == n + 1)
    return F.transform(F.slice(once, 1, most), lambda i, n: F.struct(i.src.alias("url"), i.alt.alias("alt_text"), F.coalesce(F.nullif(i.title, F.lit("")), i.alt).alias("caption"), (n == 0).alias("is_primary")))
