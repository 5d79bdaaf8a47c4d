"""What a document's text says of its entity: contact, place, hours, prices, ratings, tags, mood, events and communities, and what is derived from these.

Each function takes Columns and gives named Columns; enriched() applies them all to a table. Values that an entity has already stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import lexicons as lex
from waymark.functions.names import holds, host, known, named_locality, whole
from waymark.functions.text import clean, date_hint, fingerprint, found, has_term, keywords, matched, price_level, sentences, tag_sets, tags
from waymark.operators.quality import suitability

Named = dict[str, Column]


def none() -> Column:
    return F.array().cast("array<string>")


def first_match(x: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def listed(rules: dict[str, Column]) -> Column:
    """The keys whose conditions hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))


def united(*sets: Column) -> Column:
    """Sorted distinct members of all sets."""
    out = none()
    for s in sets:
        out = F.array_union(out, F.coalesce(s, none()))
    return F.array_sort(out)


def contact(text: Column) -> Named:
    return {"emails": found(text, lex.EMAIL), "phone_numbers": found(text, lex.PHONE)}


def link_urls(links: Column) -> Named:
    """The first link for booking, menu, tickets, maps and messages; links are structs of resolved href and label in page order."""
    low = lambda l: F.lower(l.label)
    rules = {
        "booking_url": lambda l: holds(low(l), ["book", "reserve"]), "menu_url": lambda l: holds(low(l), ["menu"]), "ticket_url": lambda l: holds(low(l), ["ticket", "register"]),
        "google_maps_url": lambda l: F.contains(host(l.href), F.lit("maps.google")) | F.contains(l.href, F.lit("google.com/maps")), "whatsapp_url": lambda l: holds(host(l.href), ["wa.me", "whatsapp"]),
    }
    return {name: F.get(F.filter(links, rule), F.lit(0)).href for name, rule in rules.items()}


def location(text: Column) -> Named:
    return {"locality": named_locality(text, lex.LOCALITIES, None), "postal_code": first_match(text, lex.POSTAL)}


def timings(text: Column) -> Named:
    low = F.lower(text)
    always, line = holds(low, lex.ALWAYS_OPEN), first_match(low, lex.HOURS)
    late = holds(low, lex.LATE)
    return {
        "open_24_hours": F.when(always, True), "opening_hours_raw": F.coalesce(F.when(always, F.lit("24 hours")), line), "hours_line": line, "late_night": F.when(late, True),
        "after_midnight": F.when(late, holds(low, lex.AFTER_MIDNIGHT)), "best_time_to_visit": listed({"morning": holds(low, ["morning"]), "evening": holds(low, ["evening", "sunset"])}),
        "quiet_hours": listed({"mentioned as less crowded": holds(low, ["quiet hours", "less crowded"])}),
    }


def pricing(text: Column) -> Named:
    low = F.lower(text)
    amounts = F.transform(F.regexp_extract_all(low, F.lit(lex.PRICE), F.lit(1)), lambda a: F.replace(a, F.lit(","), F.lit("")).try_cast("int"))
    some, free = F.size(amounts) > 0, holds(low, lex.FREE_ENTRY)
    return {
        "observed_prices": F.slice(amounts, 1, 10), "price_min": F.array_min(amounts), "price_max": F.array_max(amounts), "paid": F.when(free, False).when(some, True),
        "free_entry": F.when(free, True), "price_level": F.coalesce(F.when(some, price_level(F.array_max(amounts))), F.when(free, F.lit("free"))), "membership_required": F.when(holds(low, ["membership"]), True),
    }


def rating(text: Column) -> Named:
    low = F.lower(text)
    return {"rating": first_match(low, lex.RATING).try_cast("double"), "rating_count": whole(first_match(low, lex.RATING_COUNT))}


INTENTS = {"context_keys": lex.CONTEXTS, "branch_ids": lex.TEXT_BRANCHES, "intent_tags": lex.SIGNAL_INTENTS, "negative_intent_tags": lex.NEGATIVE_TAGS}


def intent_sets(text: Column) -> Column:
    """A struct of the tags that intents() sorts; as a column of its own it is computed once for all of them."""
    return tag_sets(text, INTENTS)


def intents(found: Column) -> Named:
    return {name: F.array_sort(found[name]) for name in INTENTS}


def scored_tags(text: Column, rules: dict[str, list[str]], score: Callable[[list[Column]], tuple[Column, Column]]) -> Column:
    """Tag -> score of the tags with hits; score gives hits and score from the numbers of hits of a tag's terms. One pass over the text."""

    def told(count: Callable[[str], Column]) -> Column:
        found = [(tag, *score([count(t) for t in terms])) for tag, terms in rules.items()]
        return F.map_from_entries(F.array_compact(F.array(*[F.when(hits > 0, F.struct(F.lit(tag).alias("key"), value.alias("value"))) for tag, hits, value in found])))

    return matched(text, [t for terms in rules.values() for t in terms], told)


def suitability_scores(text: Column) -> Column:
    """Tag -> score of every intent tag of the text."""

    def score(counts: list[Column]) -> tuple[Column, Column]:
        hits = sum(((c > 0).cast("int") for c in counts), F.lit(0))
        return hits, F.round(F.least(F.lit(1.0), 0.35 + hits * 0.15), 3)

    return scored_tags(text, lex.SIGNAL_INTENTS, score)


def tri_state(low: Column, positive: list[str], negative: list[str]) -> Column:
    """False by a negative term, true by a positive one, else null."""
    return F.when(holds(low, negative), False).when(holds(low, positive), True)


def mood(text: Column) -> Named:
    low = F.lower(text)
    crowd = F.array_sort(listed({k: F.contains(low, F.lit(stem)) for k, stem in lex.CROWDS.items()}))
    return {
        "atmosphere": F.array_sort(listed({m: F.contains(low, F.lit(m)) for m in lex.MOODS})), "noise_level": F.when(holds(low, lex.LOUD), "loud").when(holds(low, lex.SILENT), "quiet"), "crowd_type": crowd,
        **{f"{k}_friendly": tri_state(low, *terms) for k, terms in lex.FRIENDLY.items()},
    }


def amenities(text: Column) -> Named:
    low = F.lower(text)
    return {"amenities": listed({k: holds(low, terms) for k, terms in lex.AMENITIES.items()})}


def events(text: Column) -> Named:
    """Whether the text is of an event, its status and date; whether it is of a community, its kind and size."""
    low = F.lower(text)
    event, community = holds(low, lex.EVENT_TERMS), holds(low, lex.COMMUNITY_TERMS)
    status = F.when(F.contains(low, F.lit("cancelled")), "cancelled").when(F.contains(low, F.lit("postponed")), "postponed").otherwise("scheduled")
    kind = F.coalesce(*[F.when(holds(low, terms), F.lit(k)) for k, terms in lex.COMMUNITY_TYPES], F.lit("club"))
    return {
        "is_event": event, "event_status": F.when(event, status), "event_date_text": F.when(event, date_hint(text)), "is_community": community, "community_type": F.when(community, kind),
        "member_count": F.when(community, whole(first_match(low, lex.MEMBERS))),
    }


def media_asset(url: Column, alt: Column, caption: Column, primary: Column, page_labels: int = 8) -> Column:
    """A picture of a page: id, labels from its url and texts, and what these say of it."""
    some = lambda c: F.coalesce(c, F.lit(""))
    labels = F.slice(keywords(F.concat_ws(" ", url, some(alt), some(caption))), 1, page_labels)
    low = F.lower(F.concat_ws(" ", F.array_join(labels, " "), some(alt), some(caption)))
    sees = {"people": ["people", "crowd", "person"], "food": ["food", "coffee", "biryani", "restaurant"], "interior": ["interior", "inside"], "exterior": ["exterior", "outside"], "night": ["night", "midnight", "evening"]}
    return F.struct(
        F.substring(F.sha2(url, 256), 1, 20).alias("id"), url.alias("url"), alt.alias("alt_text"), caption.alias("caption"), labels.alias("labels"),
        *[F.when(holds(low, t), True).alias(f"sees_{k}") for k, t in sees.items()], F.lit(0.5).alias("quality_score"), primary.alias("is_primary"),
    )


def card(e: Named) -> Column:
    """What a list of results shows of an entity; e has its columns."""
    some = lambda c: F.nullif(c, F.lit(""))
    moods = F.slice(united(e["intent_tags"], e["atmosphere"]), 1, 8)
    why = F.array_compact(F.array(
        F.when(F.size(e["context_keys"]) > 0, F.concat(F.lit("Matches "), F.replace(F.lower(F.array_join(F.slice(e["context_keys"], 1, 2), ", ")), F.lit("_"), F.lit(" ")))),
        F.when(F.size(e["crowd_type"]) > 0, F.concat(F.lit("Popular with "), F.array_join(F.slice(e["crowd_type"], 1, 2), ", "))), F.when(known(e["locality"]), F.concat(F.lit("Located in "), e["locality"])),
    ))
    return F.struct(
        e["name"].alias("title"), F.concat_ws(" · ", some(e["category"]), some(e["locality"])).alias("subtitle"), F.coalesce(some(e["locality"]), e["address"]).alias("address_short"),
        F.coalesce(e["opening_hours_raw"], F.when(e["open_24_hours"], F.lit("Open 24 hours"))).alias("timing_label"),
        F.when(e["rating"] != 0, F.concat(e["rating"].cast("string"), F.lit(" ("), F.coalesce(e["rating_count"].cast("string"), F.lit("None")), F.lit(")"))).alias("rating_label"), e["price_level"].alias("price_label"), moods.alias("mood_tags"), why.alias("why_match"),
    )


IMPORTANT = ["name", "category", "description", "locality", "address", "latitude", "longitude", "website", "context_keys", "intent_tags", "opening_hours_raw", "pricing", "media"]


def audit(present: dict[str, Column], extracted: dict[str, Column]) -> Named:
    """Sorted fields that the entity has or the text gave, and the important ones that are missing."""
    fields = united(listed(present), listed(extracted))
    return {"fields_extracted": fields, "fields_missing": F.array_sort(F.array_except(F.array(*map(F.lit, IMPORTANT)), fields))}


def fingerprints(name: Column, address: Column, website: Column, phones: Column, lat: Column, lon: Column, text: Column) -> Named:
    return {
        "name_fingerprint": fingerprint(name), "address_fingerprint": fingerprint(address), "website_fingerprint": fingerprint(website), "phone_fingerprint": fingerprint(F.array_join(phones, " ")),
        "geo_hash": F.when(lat.isNotNull() & lon.isNotNull(), F.format_string("%.4f,%.4f", lat, lon)), "content_fingerprint": F.sha2(F.substring(text, 1, 2000), 256),
    }


#: Columns whose values are united with those that an entity has; columns that the text alone tells.
UNITED = ("context_keys", "branch_ids", "intent_tags", "negative_intent_tags", "atmosphere", "crowd_type", "amenities")
ALONE = ("hours_line", "is_event", "is_community", "noise_level", *[f"{k}_friendly" for k in lex.FRIENDLY])


def beside(entities: DataFrame, out: Named) -> Named:
    """New values where the entities have none of these columns' values yet, united sets, and the larger of two scores."""
    kinds, mixed = dict(entities.dtypes), {}
    for k, v in out.items():
        if k not in kinds or k in ALONE:
            mixed[k] = v
        elif k in UNITED:
            mixed[k] = united(F.col(k), v)
        elif kinds[k].startswith("array"):
            mixed[k] = F.when(F.size(F.coalesce(k, none())) > 0, F.col(k)).otherwise(v)
        elif kinds[k].startswith("map"):
            had = F.coalesce(k, F.create_map().cast("map<string,double>"))
            mixed[k] = F.map_zip_with(had, v, lambda _, a, b: F.greatest(a, b))
        else:
            mixed[k] = F.coalesce(F.nullif(k, F.lit("")) if kinds[k] == "string" else F.col(k), v)
    return mixed


def enriched(entities: DataFrame) -> DataFrame:
    """Entities with what their text column says. Fixed order: contact, place, hours, prices, rating, tags, mood, amenities, events, then
    what is derived. name, category, description, locality, address, latitude, longitude and website are read; where locality is null it is filled.

    Null text: as an empty one. Values that an entity has in columns of the results' names stay, sets are united, and what tells of
    the text alone is replaced; other columns stay.
    """
    text = clean(F.coalesce("text", F.lit("")))
    given = {c: F.col(c) for c in ("name", "category", "description", "locality", "address", "latitude", "longitude", "website")}
    out: Named = {}
    for block in (contact, location, timings, pricing, rating, mood, amenities, events):
        out |= block(text)
    out |= intents(F.col("__intents"))
    named = out["locality"]
    out["locality"] = F.coalesce(F.nullif(given["locality"], F.lit("")), named)
    first = F.get(sentences(text), F.lit(0))
    out["summary"] = F.coalesce(F.substring(clean(first), 1, 500), F.nullif(F.substring(text, 1, 500), F.lit("")))
    out["full_text_excerpt"] = F.nullif(F.substring(text, 1, 2000), F.lit(""))
    out["suitability_scores"] = suitability_scores(text)
    out = beside(entities, out)
    # The longer expressions read the shorter ones as columns of the table before, so each is computed once.
    step = entities.withColumn("__intents", intent_sets(text)).withColumns({**out, "named_locality": named, "text": text}).drop("__intents")  # locality reads the column of before
    e = {**{c: F.col(c) for c in step.columns}}
    derived = fingerprints(e["name"], e["address"], e["website"], e["phone_numbers"], e["latitude"], e["longitude"], e["text"])
    derived |= {"card": card(e), "event_topics": F.when(e["is_event"], united(e["intent_tags"], e["branch_ids"])), "event_audience": F.when(e["is_event"], e["crowd_type"]), "community_topics": F.when(e["is_community"], e["intent_tags"])}
    there = {k: known(e[k].cast("string")) for k in ("name", "category", "description", "locality", "address", "latitude", "longitude", "website", "opening_hours_raw")} | {"pricing": e["price_min"].isNotNull()}
    there["latitude"], there["longitude"] = F.coalesce(e["latitude"] != 0, F.lit(False)), F.coalesce(e["longitude"] != 0, F.lit(False))
    got = {
        "emails": F.size("emails") > 0, "phone_numbers": F.size("phone_numbers") > 0, "locality": e["named_locality"].isNotNull(), "postal_code": e["postal_code"].isNotNull(), "open_24_hours": e["open_24_hours"],
        "opening_hours_raw": e["hours_line"].isNotNull(), "late_night": e["late_night"], "pricing": e["price_min"].isNotNull(), "free_entry": e["free_entry"], "rating": e["rating"].isNotNull(),
        "rating_count": e["rating_count"].isNotNull(), "context_keys": F.size("context_keys") > 0, "branch_ids": F.size("branch_ids") > 0, "intent_tags": F.size("intent_tags") > 0,
        "event_date_text": e["event_date_text"].isNotNull(), "event_details": e["is_event"], "community_details": e["is_community"],
    }
    return step.withColumns(derived | audit(there, got)).drop("named_locality")


# Entity metadata of the engine ---------------------------------------------------------------------------------------


def app_branch(category: Column, text: Column) -> Column:
    """Branch by category, else by words at boundaries."""
    table = F.create_map(*[F.lit(x) for pair in lex.BRANCH_BY_CATEGORY.items() for x in pair])
    by_words = F.coalesce(*[F.when(has_term(text, terms), F.lit(b)) for b, terms in lex.BRANCH_TERMS], F.lit("explore"))
    return F.coalesce(F.try_element_at(table, F.lower(F.coalesce(category, F.lit("")))), by_words)


def card_branch(category: Column, text: Column) -> Column:
    """Branch of a served entity: its own table of categories, then whole words."""
    table = F.create_map(*[F.lit(x) for pair in lex.APP_BRANCHES.items() for x in pair])
    by_words = F.coalesce(*[F.when(F.lower(text).rlike(p), F.lit(b)) for b, p in lex.APP_BRANCH_WORDS], F.lit("explore"))
    return F.coalesce(F.try_element_at(table, F.lower(F.coalesce(category, F.lit("")))), by_words)


def engine_tags(text: Column) -> Column:
    """Intent tags in the rules' order, explore if there are none."""
    t = tags(text, lex.INTENT_TERMS)
    return F.when(F.size(t) > 0, t).otherwise(F.array(F.lit("explore")))


def polarity(text: Column) -> Column:
    """positive or negative where the hits of one list are more than 1.3 times the other's, else mixed."""
    both = matched(text, [*lex.POSITIVE, *lex.NEGATIVE], lambda count: F.struct(*[sum(map(count, terms), F.lit(0)).alias(name) for name, terms in (("p", lex.POSITIVE), ("n", lex.NEGATIVE))]))
    p, n = both["p"], both["n"]
    return F.when(p > n * 1.3, "positive").when(n > p * 1.3, "negative").otherwise("mixed")


def engine_scores(text: Column, rating_share: Column, reviews: Column) -> Column:
    """Tag -> suitability of the engine's tags that the text has: hits of their terms, mean share of the best rating, number of reviews."""

    def score(counts: list[Column]) -> tuple[Column, Column]:
        hits = sum(counts, F.lit(0))
        return hits, suitability(hits, rating_share, reviews)

    return scored_tags(text, lex.INTENT_TERMS, score)


def engine_metadata(category: Column, locality: Column, text: Column, branches: Column, contexts: Column) -> Named:
    """Tags, crowd, atmosphere, branch and context keys from an entity's text; branches and contexts are those it has."""
    low = F.lower(text)
    branch, own = app_branch(category, low), engine_tags(low)
    return {
        "intent_tags": own, "crowd_type": listed({k: F.contains(low, F.lit(stem)) for k, stem in lex.ENGINE_CROWDS.items()}), "atmosphere": tags(low, {m: [m] for m in lex.ENGINE_MOODS}),
        "branch": branch, "branch_ids": united(branches, F.array(branch, F.lit("places"))), "context_keys": united(contexts, own, F.array(branch, F.coalesce(F.nullif(locality, F.lit("")), F.lit("Hyderabad")))),
    }


def branch_normalised(branch: Column, intent_tags: Column, context_keys: Column, branch_ids: Column) -> Named:
    """The tags that a branch brings, and whether anything has changed."""
    extra = F.coalesce(*[F.when(branch == b, F.array(*map(F.lit, t))) for b, t in lex.BRANCH_TAGS.items()])
    tags_ = united(intent_tags, extra)
    keys, ids = united(context_keys, tags_, F.array(branch)), united(branch_ids, F.array(branch, F.lit("places")))
    same = intent_tags.eqNullSafe(tags_) & context_keys.eqNullSafe(keys) & branch_ids.eqNullSafe(ids)
    return {"intent_tags": tags_, "context_keys": keys, "branch_ids": ids, "changed": ~same}
