"""Quality rules, serving gates, enrichment scores and gap queries of entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import lexicons as lex
from waymark.functions.text import is_blank


def source_like(name: Column, lat: Column, lon: Column, mode: Column | None = None) -> Column:
    """Titles of lists and articles. A bad exact name is one; what a page mentions or what has a position is none."""
    low = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    mentioned = F.coalesce(mode == "mentioned_entity", F.lit(False)) if mode is not None else F.lit(False)
    return F.when(low.isin(lex.BAD_NAMES), True).when(mentioned | (lat.isNotNull() & lon.isNotNull()), False).otherwise(low.rlike("|".join(lex.SOURCE_LIKE)))


def recommendable(name: Column, category: Column, status: Column | None = None) -> Column:
    """Named things of a category that is served: no rejected ones, no other city's lists, no words of pages, roads and posts, no strays."""
    low, kind = F.lower(F.trim(F.coalesce(name, F.lit("")))), F.lower(F.trim(F.coalesce(category, F.lit(""))))
    listy = F.contains(kind, F.lit(" hyderabad")) & ~kind.isin("hyderabad", "secunderabad")
    fit = (low != "") & (kind != "") & ~kind.isin(lex.NON_SERVING) & ~listy & ~low.rlike("|".join(lex.NON_SERVING_NAMES)) & ~low.isin(lex.STRAY_NAMES)
    return fit if status is None else fit & F.coalesce(status != "REJECTED_PAGE_FRAGMENT", F.lit(True))


def with_quality(entities: DataFrame) -> DataFrame:
    """missing, blockers, warnings, quality_score and production_ready of each entity.

    status, primary_category and extraction_mode count where entities have them: a rejected page fragment is never ready, the primary
    category goes before the category, and what a page mentions is no title of a list.
    """
    c, there = F.col, entities.columns
    own = F.coalesce(F.nullif("primary_category", F.lit("")), "category") if "primary_category" in there else c("category")
    status, mode = (c(x) if x in there else None for x in ("status", "extraction_mode"))
    no_place = c("latitude").isNull() | c("longitude").isNull()
    flags = {"name": is_blank(c("name")), "category": is_blank(c("category")), "locality": is_blank(c("locality")), "address": is_blank(c("address")),
             "latitude": c("latitude").isNull(), "longitude": c("longitude").isNull(), "image": is_blank(c("image_id")), "source": c("n_sources") == 0}
    listy = source_like(c("name"), c("latitude"), c("longitude"), mode)
    blocks = {"source_or_article_title": listy, "not_recommendation_entity": ~recommendable(c("name"), own, status), "missing_coordinates": no_place, "missing_image": flags["image"],
              "missing_locality": flags["locality"], "missing_address": flags["address"], "missing_source_provenance": flags["source"], "low_confidence": c("confidence") < 0.35}
    warns = {"missing_rating": c("rating").isNull(), "missing_timings": is_blank(c("timings")), "missing_intent_tags": F.size("intent_tags") == 0}
    listed = lambda rules: F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(v, F.lit(False)), F.lit(k)) for k, v in rules.items()])))
    out = entities.withColumn("missing", listed(flags)).withColumn("blockers", listed(blocks)).withColumn("warnings", listed(warns))
    bonus = lambda x: F.when(x, 0.05).otherwise(0.0)
    score = 1 - 0.18 * F.size("missing") - 0.25 * F.size("blockers") - 0.04 * F.size("warnings")
    score = score + bonus(~flags["address"]) + bonus(~flags["image"]) + bonus(~warns["missing_rating"]) + bonus(~warns["missing_intent_tags"])
    return out.withColumn("quality_score", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 3)).withColumn("production_ready", (F.size("blockers") == 0) & (F.size("missing") == 0))


def serving_ready(rated: DataFrame) -> Column:
    """Everything required but an image is there."""
    return (F.size(F.array_except("missing", F.array(F.lit("image")))) == 0) & (F.size(F.array_except("blockers", F.array(F.lit("missing_image")))) == 0)


def gap_queries(rated: DataFrame) -> DataFrame:
    """A search query for each missing field of an entity, at most five, for each source."""
    ask = {"address": "address", "image": "photos", "latitude": "location map", "locality": "area", "source": "official website"}
    wanted = F.slice(F.array_compact(F.array(*[F.when(F.array_contains("missing", k), F.concat("name", F.lit(f" {v}"))) for k, v in ask.items()])), 1, 5)
    each = rated.select("id", F.explode(wanted).alias("query"))
    return each.select("id", "query", F.explode(F.array(F.lit("google_search"), F.lit("firecrawl_search"))).alias("source"))


def popularity(count: Column, reviews: Column, sources: Column) -> Column:
    return F.round(F.least(F.lit(1.0), count / F.lit(1500) + reviews / F.lit(300) + sources * 0.05), 3)


def hidden_gem(count: Column, sources: Column) -> Column:
    """The 1e-9 settles ties of decimal rounding alike in every engine."""
    return F.round(F.when(count == 0, 0.5).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.85 - count / F.lit(2000) + 0.03 * sources))) + 1e-9, 3)


def suitability(hits: Column, rating_share: Column, reviews: Column) -> Column:
    return F.round(F.least(F.lit(1.0), 0.25 + 0.12 * hits + 0.35 * F.coalesce(rating_share, F.lit(0.0)) + F.least(reviews, F.lit(20)) / F.lit(100)), 3)


def data_confidence(fields: list[Column], lat: Column, lon: Column, text: Column) -> Column:
    score = F.lit(0.2)
    for f in fields:
        score = score + F.when(~is_blank(f), 0.08).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), score + F.when(lat.isNotNull() & lon.isNotNull(), 0.15).otherwise(0.0) + F.when(F.length(text) > 500, 0.1).otherwise(0.0)), 3)


def gap_candidates(rows: DataFrame, sources: tuple[tuple[str, float], ...] = (("openstreetmap", 0.9), ("firecrawl_search", 0.7))) -> DataFrame:
    """id, query, source and priority: each of the rows' queries for each source that is asked."""
    asked = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(p).alias("priority")) for s, p in sources])
    return rows.select("id", F.explode("queries").alias("query")).select("id", "query", F.explode(asked).alias("s")).select("id", "query", "s.*")
