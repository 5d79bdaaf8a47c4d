"""Ranked text and place search: the query is compiled to literals, and one plan filters, scores and takes the top."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import lexicons as lex
from waymark.functions.text import bounded, haversine_m, tags


@dataclass(frozen=True)
class Query:
    """Terms, moods, locality hint and centre of a query string."""

    terms: tuple[str, ...]
    moods: tuple[str, ...]
    hint: str | None
    centre: tuple[float, float] | None


def moods_of(terms: tuple[str, ...]) -> tuple[str, ...]:
    """Moods that terms ask for: by name, or by a word or the start of one of the mood's terms."""
    return tuple(sorted(m for m, words in lex.MOOD_TERMS.items() if any(t == m or any(t in k.split() or k.startswith(t) for k in words) for t in terms)))


def compiled(text: str, lat: float | None = None, lon: float | None = None) -> Query:
    raw = re.findall("[a-z0-9]+", text.lower())
    terms = tuple(t for t in (lex.QUERY_ALIASES.get(w, w) for w in raw) if len(t) > 2 and t not in lex.QUERY_STOPS)
    moods = moods_of(terms)
    hint = None
    if near := re.search(r"\bnear\s+([a-z][a-z\s-]{2,40})", text.lower()):
        words = [w for w in re.findall("[a-z0-9]+", re.split(r"\b(?:for|with|and|that|which|where)\b", near[1])[0]) if w not in ("place", "places")]
        if words:
            hint = " ".join(words[:2]) if " ".join(words[:2]) in lex.CENTRES else words[0]
    centre = (lat, lon) if lat is not None and lon is not None else lex.CENTRES.get(hint or "")
    return Query(terms, moods, hint, centre)


def hinted(query: Query, entities: DataFrame) -> Query:
    """The query with the first of its terms that is a locality, an address or a name of the entities as its hint, if it has none yet."""
    if query.hint or not query.terms:
        return query
    words = F.filter(F.regexp_extract_all(F.lower("value"), F.lit("[a-z0-9]+"), F.lit(0)), lambda w: F.length(w) > 2)
    values = entities.select(F.explode(F.array("locality", "address", "name")).alias("value")).select(F.array_join(F.slice(words, 1, 3), " ").alias("value"))
    known = {r.value for r in values.where(F.col("value").isin(*query.terms)).distinct().collect()}  # no more than the query has terms
    hint = next((t for t in query.terms if t in known), None)
    return replace(query, hint=hint, centre=query.centre or lex.CENTRES.get(hint or ""))


SEARCHED = ("name", "category", "subcategories", "locality", "address", "description", "amenities", "intent_tags", "atmosphere", "topics", "review_text")
RADIUS_M = 6_371_008.8
WALKS = ["park", "garden", "water", "viewpoint", "fitness_station"]


def with_words(entities: DataFrame) -> DataFrame:
    """Entities with __hay, all that they say in lower case, and mood_tags: their own tags, the moods of their words and those of their category."""
    kinds = dict(entities.dtypes)
    hay = F.lower(F.concat_ws(" ", *[F.array_join(c, " ") if kinds[c].startswith("array") else F.col(c) for c in SEARCHED if c in kinds]))
    none = F.array().cast("array<string>")
    own = F.concat(*[F.coalesce(c, none) for c in ("intent_tags", "atmosphere") if c in kinds], none)
    told = tags(hay, lex.MOOD_TERMS)
    walks = F.when(F.col("category").isin(WALKS), F.array(F.lit("outdoor"), F.lit("good_for_walking"))).otherwise(none)
    return entities.withColumns({"__hay": hay, "mood_tags": F.array_sort(F.array_distinct(F.concat(own, told, walks)))})


def asked_moods(term: str) -> list[str]:
    """Moods by which a term is matched: those that it asks for, and itself if it is one's name."""
    return sorted({*moods_of((term,)), term})


def whole_terms(entities: DataFrame, query: Query) -> DataFrame:
    """matched_terms and moods by all that entities say: all searched columns that they have, their own tags and their category.

    A term is matched by the text, or by a mood that it asks for or names and that the entity has.
    """
    out, none = with_words(entities), F.array().cast("array<string>")

    def met(term: str):
        return F.col("__hay").rlike(bounded(term)) | F.arrays_overlap("mood_tags", F.array(*map(F.lit, asked_moods(term))))

    terms = sorted(set(query.terms))
    matched = F.array_compact(F.array(*[F.when(met(t), F.lit(t)) for t in terms])) if terms else none
    asked = F.array(*map(F.lit, query.moods)) if query.moods else none
    return out.withColumns({"matched_terms": matched, "moods": F.array_sort(F.array_intersect("mood_tags", asked))}).drop("__hay")


def standing(entities: DataFrame) -> dict[str, Column]:
    """What a card is worth whatever is asked: beside a question, and where nothing is asked."""
    flag = lambda x, w: F.when(x, w).otherwise(0.0)
    asked = flag(F.col("latitude").isNotNull(), 0.5) + flag(F.col("address").isNotNull(), 0.25) + flag(F.col("image_id").isNotNull(), 0.25)
    suited = F.lit(0.0)
    if "suitability_scores" in entities.columns:
        each = F.transform("intent_tags", lambda t: F.coalesce(F.try_element_at("suitability_scores", t).cast("double"), F.lit(0.0)))
        suited = F.coalesce(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))
    popular = F.coalesce(F.col("popularity").cast("double"), F.lit(0.0)) if "popularity" in entities.columns else F.lit(0.0)
    return {"suited": suited, "shown": asked, "unasked": popular + 0.03 * F.col("n_sources")}


def cards(entities: DataFrame, query: Query, whole: bool = False) -> DataFrame:
    """Entities that match the query, with matched terms, distance and relevance. A query without terms is met by all: with a hint they are
    ranked by it and their distance, else by popularity (where entities have it) and sources.

    suitability_scores, a map that entities may have, counts with the sum over the intent tags; a tag without a score counts 0.
    whole: terms, moods and the hint by all that entities say (whole_terms); else by six columns and the text alone.
    """
    hay = F.lower(F.concat_ws(" ", "name", "category", "locality", "address", "description", F.array_join("intent_tags", " ")))
    terms = F.array(*map(F.lit, query.terms)) if query.terms else F.array().cast("array<string>")
    out = entities.withColumn("matched_terms", F.array_compact(F.array(*[F.when(hay.rlike(bounded(t)), F.lit(t)) for t in dict.fromkeys(query.terms)])) if query.terms else terms)
    mood = lambda m: hay.rlike("|".join(bounded(k) for k in lex.MOOD_TERMS[m]))
    out = out.withColumn("moods", F.array_compact(F.array(*[F.when(mood(m), F.lit(m)) for m in query.moods])) if query.moods else F.array().cast("array<string>"))
    out = whole_terms(entities, query) if whole else out
    d = F.lit(None).cast("double")
    if query.centre:
        d = F.round(haversine_m(F.lit(query.centre[0]), F.lit(query.centre[1]), F.col("latitude"), F.col("longitude"), RADIUS_M) / 1000, 2)
    out = out.withColumn("distance_km", d)
    where = F.lower(F.concat_ws(" ", "name", "locality", "address"))
    at_hint = (where.rlike(bounded(query.hint)) if whole else where.contains(query.hint)) if query.hint else F.lit(False)
    worth = standing(entities)
    if query.terms or query.moods:
        out = out.where((F.size("matched_terms") > 0) | (F.size("moods") > 0) | (F.lit(bool(query.hint)) & F.coalesce(F.col("distance_km") <= 8, F.lit(False))))
    if query.terms or query.moods or query.hint:
        near = F.coalesce(F.greatest(F.lit(0.0), 2.5 - 0.25 * F.least(F.col("distance_km"), F.lit(10.0))), F.lit(0.0))
        score = 0.9 * F.size("matched_terms") + 1.4 * F.size("moods") + worth["suited"] + F.when(at_hint, 3.0).otherwise(0.0) + near + worth["shown"]
    else:
        score = worth["unasked"]
    return out.withColumn("relevance_score", F.round(score, 3))


def top(found: DataFrame, limit: int) -> DataFrame:
    """Best first; ties to the nearer, then to the smaller id."""
    return found.orderBy(F.desc("relevance_score"), F.coalesce("distance_km", F.lit(9999.0)), "id").limit(limit)


def nearest_seed(points: DataFrame, seeds: list[tuple[str, float, float]]) -> DataFrame:
    """The nearest of a few fixed places, first one on ties; no join: the places are literals."""
    each = [F.struct(haversine_m(F.col("latitude"), F.col("longitude"), F.lit(a), F.lit(b)).alias("d"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, a, b) in enumerate(seeds)]
    return points.withColumn("seed", F.least(*each))
