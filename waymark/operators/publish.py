"""Publication: the nine tables that serve, made from entities, reviews, pages and landed pictures in one job, and put out as one version.

Entities have id, name, entity_type, category, primary_category, subcategories, description, locality, address, latitude, longitude, website,
status, confidence, rating, rating_count, timings, intent_tags, context_keys, branch_ids, suitability_scores (map), sources (array of
struct<source, url, source_type, raw_path, extraction_confidence>), media (array of struct<id, url, source, caption, labels, is_primary>)
and relationships (array of struct<predicate, object_id, object_name, confidence, evidence, source_url>).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import lexicons as lex
from waymark.functions import names as nm
from waymark.operators import quality as ql
from waymark.operators import refine as rf
from waymark.operators.tables import keep_first

#: Columns of the served tables: keys first.
SCHEMAS = {
    "entities_raw": "id string, canonical_name string, entity_type string, primary_category string, locality string, address string, latitude double, longitude double, website string, has_media boolean, production_ready boolean, quality_score double, quality_blockers array<string>, quality_missing_fields array<string>",
    "entity_quality": "entity_id string, name string, production_ready boolean, score double, missing_fields array<string>, blockers array<string>, warnings array<string>, enrichment_queries array<string>",
    "city_entities": "id string, canonical_name string, display_name string, entity_type string, primary_category string, secondary_categories array<string>, context_keys array<string>, branch_ids array<string>, intent_tags array<string>, negative_intent_tags array<string>, description string, summary string, locality string, address string, latitude double, longitude double, geo_precision string, website string, phone_numbers array<string>, emails array<string>, price_level string, rating double, rating_count int, review_count int, popularity_score double, hidden_gem_score double, confidence_score double, source_count int, status string, primary_image_url string, primary_image_id string, card string, first_seen_at timestamp, last_seen_at timestamp, updated_at timestamp",
    "entity_intents": "entity_id string, intent_tag string, score double, evidence string",
    "entity_sources": "source_key string, entity_id string, source string, source_url string, source_type string, raw_path string, extraction_confidence double",
    "entity_reviews": "id string, entity_id string, source string, rating double, text string, sentiment string, sentiment_score double, topics array<string>",
    "entity_media": "id string, entity_id string, source_url string, mime_type string, byte_size bigint, content_hash string, caption string, labels array<string>, source string, is_primary boolean",
    "entity_relationships": "from_entity_id string, relation_type string, to_entity_id string, target_name string, weight double, evidence string, source_url string",
    "source_pages": "url string, title string, description string, source string, source_type string, raw_path string, is_source_page boolean, search_query string, search_rank int",
}


def ensure_schema(spark: SparkSession, database: str) -> None:
    """Create the database and its nine tables where they are missing. Arrays stay arrays; there are no indexes: scans prune by columns and statistics."""
    spark.sql(f"create database if not exists {database}")
    for name, columns in SCHEMAS.items():
        spark.sql(f"create table if not exists {database}.{name} ({columns}) using parquet")


def shaped(df: DataFrame, table: str) -> DataFrame:
    """The columns of a served table, in its types."""
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in (c.split(" ", 1) for c in SCHEMAS[table].split(", "))])


def serving_key(name: Column, lat: Column, lon: Column) -> Column:
    """What two served entities must not share: the name without filler words, and the rounded position."""
    words = F.regexp_replace(F.replace(F.lower(F.coalesce(name, F.lit(""))), F.lit("golkonda"), F.lit("golconda")), "[^a-z0-9]+", " ")
    bare = F.trim(F.regexp_replace(F.regexp_replace(words, lex.SERVING_STOPS, " "), " +", " "))
    where = F.concat(F.lit("|"), F.round(lat, 4).cast("string"), F.lit(":"), F.round(lon, 4).cast("string"))
    return F.concat(bare, F.coalesce(where, F.lit("")))


def validated(entities: DataFrame) -> DataFrame:
    """Entities with missing, blockers, warnings, quality_score, production_ready and the queries that may fill their gaps."""
    c = F.col
    known = entities.withColumns({"image_id": F.get("media", F.lit(0)).url, "n_sources": F.size("sources"), "own_category": F.coalesce(F.nullif("primary_category", F.lit("")), "category")})
    rated = ql.with_quality(known)
    return rated.withColumn("enrichment_queries", rf.gap_queries(c("name"), c("locality"), c("missing"), c("blockers"), c("address"))).drop("image_id", "n_sources")


def gated(rated: DataFrame) -> DataFrame:
    """Those of validated entities that may be served, one for each serving key: the one with the smallest id."""
    c = F.col
    ready = c("production_ready") & ql.serving_ready(None) & ql.recommendable(c("name"), c("own_category"), c("status")) & ~ql.source_like(c("name"), c("latitude"), c("longitude"))
    key = serving_key(c("name"), c("latitude"), c("longitude"))
    return keep_first(rated.where(ready).withColumn("__key", key), [c("__key")], [c("id")]).drop("__key")


def pictures(served: DataFrame, images: DataFrame, most: int = 8) -> DataFrame:
    """Rows of entity_media: of each entity's first `most` pictures those that were landed, each content once."""
    each = served.select(F.col("id").alias("entity_id"), F.posexplode(F.slice("media", 1, most)).alias("pos", "m"))
    found = each.join(images.select(F.col("url").alias("source_url"), "mime_type", "byte_size", "content_hash"), F.col("m.url") == F.col("source_url"))
    once = keep_first(found, [F.col("entity_id"), F.col("content_hash")], [F.col("pos")])
    own = F.coalesce("m.id", F.substring("content_hash", 1, 20))
    own = F.when(F.startswith(own, F.concat("entity_id", F.lit(":"))), own).otherwise(F.concat("entity_id", F.lit(":"), own))
    return once.select(own.alias("id"), "entity_id", "source_url", "mime_type", "byte_size", "content_hash", F.col("m.caption").alias("caption"), F.col("m.labels").alias("labels"), F.col("m.source").alias("source"), (F.coalesce("m.is_primary", F.lit(False)) | (F.col("pos") == 0)).alias("is_primary"), "pos")


def served_tables(entities: DataFrame, reviews: DataFrame, pages: DataFrame, images: DataFrame) -> dict[str, DataFrame]:
    """The nine tables. An entity without a landed picture is not served; children are those of served entities alone.

    reviews: id, entity_id, source, rating, text, sentiment, sentiment_score, topics; rows without id are left out, of equal ids the largest text stays.
    pages: url and the columns of source_pages, raw_path deciding between rows of one url. images: url, mime_type, byte_size, content_hash.
    """
    c = F.col
    e = entities.withColumn("id", c("id").cast("string"))
    rated = validated(e)
    chosen = gated(rated)
    media = pictures(chosen, images)
    first = media.groupBy("entity_id").agg(F.min_by("id", "pos").alias("primary_image_id"))
    served = chosen.join(first, chosen.id == first.entity_id).drop("entity_id")
    kind = F.coalesce("own_category", F.lit(""))
    raw = rated.select("id", c("name").alias("canonical_name"), "entity_type", c("own_category").alias("primary_category"), "locality", "address", "latitude", "longitude", "website", (F.size("media") > 0).alias("has_media"), "production_ready", "quality_score", c("blockers").alias("quality_blockers"), c("missing").alias("quality_missing_fields"))
    quality = rated.select(c("id").alias("entity_id"), "name", "production_ready", c("quality_score").alias("score"), c("missing").alias("missing_fields"), "blockers", "warnings", "enrichment_queries")
    had = lambda name, kind: c(name) if name in served.columns else F.lit(None).cast(kind)
    lists = lambda name: F.coalesce(had(name, "array<string>"), F.array().cast("array<string>")).alias(name)
    text = lambda name: had(name, "string").alias(name)
    more = [
        F.coalesce(F.nullif(had("display_name", "string"), F.lit("")), c("name")).alias("display_name"), lists("negative_intent_tags"), text("summary"), text("geo_precision"), lists("phone_numbers"), lists("emails"), text("price_level"), F.coalesce(had("review_count", "int"), F.lit(0)).alias("review_count"),
        had("popularity", "double").alias("popularity_score"), had("hidden_gem", "double").alias("hidden_gem_score"), F.lit(None).cast("string").alias("primary_image_url"), (F.to_json("card") if "card" in served.columns else F.lit("{}")).alias("card"), had("first_seen_at", "timestamp").alias("first_seen_at"),
        had("last_seen_at", "timestamp").alias("last_seen_at"), F.coalesce(had("last_seen_at", "timestamp"), F.current_timestamp()).alias("updated_at"),
    ]
    city = served.select("id", *more, c("name").alias("canonical_name"), "entity_type", kind.alias("primary_category"), c("subcategories").alias("secondary_categories"), "context_keys", "branch_ids", "intent_tags", "description", "locality", "address", "latitude", "longitude", "website", "rating", "rating_count", c("confidence").alias("confidence_score"), F.size("sources").alias("source_count"), F.when(c("production_ready"), "PRODUCTION_READY").otherwise("NEEDS_ENRICHMENT").alias("status"), "primary_image_id")
    scored = served.select(c("id").alias("entity_id"), F.explode("suitability_scores").alias("intent_tag", "score"), F.lit("suitability score").alias("evidence"))
    unscored = F.array_except(F.array_distinct("intent_tags"), F.coalesce(F.map_keys("suitability_scores"), F.array().cast("array<string>")))
    plain = served.select(c("id").alias("entity_id"), F.explode(unscored).alias("intent_tag"), F.lit(0.5).alias("score"), F.lit("intent tag").alias("evidence"))
    sources = served.select(c("id").alias("entity_id"), F.posexplode("sources").alias("pos", "s"))
    some = lambda x: F.coalesce(x, F.lit(""))
    sources = sources.withColumn("source_key", F.concat_ws(":", "entity_id", "s.source", some(c("s.url")), some(c("s.raw_path"))))
    sources = keep_first(sources, [c("source_key")], [F.desc("pos")]).select("source_key", "entity_id", "s.source", c("s.url").alias("source_url"), "s.source_type", "s.raw_path", "s.extraction_confidence")
    edges = served.select(c("id").alias("from_entity_id"), F.posexplode("relationships").alias("pos", "r"))
    edges = keep_first(edges, [c("from_entity_id"), c("r.predicate"), c("r.object_id")], [F.desc("pos")]).select("from_entity_id", c("r.predicate").alias("relation_type"), c("r.object_id").alias("to_entity_id"), c("r.object_name").alias("target_name"), c("r.confidence").alias("weight"), "r.evidence", "r.source_url")
    own = reviews.withColumn("entity_id", c("entity_id").cast("string")).where("id is not null and id <> ''").join(served.select(c("id").alias("entity_id")), "entity_id", "left_semi")
    latest = keep_first(pages.where("url is not null and url <> ''"), [c("url")], [F.desc_nulls_last("raw_path")]).withColumn("is_source_page", F.coalesce("is_source_page", F.lit(True)))
    out = {
        "entities_raw": raw, "entity_quality": quality, "city_entities": city, "entity_intents": scored.unionByName(plain), "entity_sources": sources, "entity_reviews": keep_first(own, [c("id")], [F.desc("text")]),
        "entity_media": media, "entity_relationships": edges, "source_pages": latest,
    }
    return {name: shaped(df, name) for name, df in out.items()}


# Cards with reviews --------------------------------------------------------------------------------------------------


def with_reviews(entities: DataFrame, reviews: DataFrame, comments: DataFrame, most: int = 3, longest: int = 220) -> DataFrame:
    """Entities with review_count, review_text (all texts, reviews before comments, each by id) and the first `most` snippets.

    reviews, comments: entity_id, id, text. Entities without any have 0, an empty text and no snippets.
    """
    both = reviews.select("entity_id", F.lit(0).alias("kind"), "id", F.coalesce("text", F.lit("")).alias("text")).unionByName(comments.select("entity_id", F.lit(1).alias("kind"), "id", F.coalesce("text", F.lit("")).alias("text")))
    grouped = both.groupBy("entity_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("kind", "id", "text"))), lambda r: r.text).alias("__texts"))
    none = F.array().cast("array<string>")
    rows = entities.join(grouped, entities.id == grouped.entity_id, "left").drop("entity_id").withColumn("__texts", F.coalesce("__texts", none))
    from waymark.functions.text import clean

    snippets = F.transform(F.filter(F.slice("__texts", 1, most), lambda t: F.trim(t) != ""), lambda t: F.substring(clean(t), 1, longest))
    return rows.withColumns({"review_count": F.size("__texts"), "review_text": F.array_join("__texts", " "), "review_snippets": snippets}).drop("__texts")


def rating_of(ratings: Column) -> dict[str, Column]:
    """Mean score to two digits and sum of counts over an array of ratings (score, count); null where none has one."""
    scores = F.filter(F.transform(ratings, lambda r: r.score), lambda s: s.isNotNull())
    counts = F.filter(F.transform(ratings, lambda r: r["count"]), lambda n: n.isNotNull())
    total = F.aggregate(scores, F.lit(0.0), lambda a, s: a + s)
    return {"rating": F.when(F.size(scores) > 0, F.round(total / F.size(scores), 2)), "rating_count": F.when(F.size(counts) > 0, F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, n: a + n))}
