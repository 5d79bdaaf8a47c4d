"""Pages to entities: linked data, mentions, relations, and the route that a page takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.functions import lexicons as lex
from waymark.functions import names as nm
from waymark.functions import pages as pg
from waymark.functions.text import clean, entity_id, evidence_window, json_ld, source_page, title, visible_text

#: Characters of a page's text that mentions are looked for in, and mentions of a page, as the operator is defined.
REACH, MENTIONS = 30_000, 40


def got(v: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def text_or_list(v: str, path: str) -> Column:
    """A variant's text, or the texts of its list; objects of a list give their url."""
    items = F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
    each = F.transform(items, lambda x: F.coalesce(F.try_variant_get(x, "$.url", "string"), F.try_variant_get(x, "$", "string")))
    one = got(v, path)
    return F.when(F.try_variant_get(v, path, "array<variant>").isNotNull(), F.array_compact(each)).when(one.isNotNull(), F.array(one)).otherwise(F.array().cast("array<string>"))


def linked_nodes(pages: DataFrame) -> DataFrame:
    """(page_id, url, v): objects of ld+json scripts, of their lists and @graphs; read before scripts are stripped."""
    none = F.array().cast("array<variant>")
    some = lambda v, path: F.coalesce(F.try_variant_get(v, path, "array<variant>"), none)
    nodes = pages.select("page_id", "url", F.explode(json_ld(F.col("html"))).alias("v"))
    flat = nodes.select("page_id", "url", F.explode(F.when(F.size(some("v", "$")) > 0, some("v", "$")).otherwise(F.array("v"))).alias("v"))
    return flat.select("page_id", "url", F.explode(F.concat(F.array("v"), some("v", "$['@graph']"))).alias("v"))


def linked_entities(pages: DataFrame) -> DataFrame:
    """Entities of ld+json scripts with a name: type, address, position, links, phone, hours, pictures, ratings, prices and cuisines.

    Fields that the format allows as text, list or object are read in each form. pages: page_id, html and, for the default website, url.
    """
    with_url = pages if "url" in pages.columns else pages.withColumn("url", F.lit(None).cast("string"))
    v = linked_nodes(with_url)
    parts = F.concat_ws(", ", *[F.nullif(got("v", f"$.address.{p}"), F.lit("")) for p in ("streetAddress", "addressLocality", "addressRegion", "postalCode", "addressCountry")])
    address = F.coalesce(F.nullif(clean(parts), F.lit("")), F.when(F.schema_of_variant(F.try_variant_get("v", "$.address", "variant")) == "STRING", got("v", "$.address")))
    same = F.transform(text_or_list("v", "$.sameAs"), lambda u: F.concat(F.substring_index(F.replace(nm.host(u), F.lit("www."), F.lit("")), ".", 1), F.lit("="), u))
    picture = F.when(got("v", "$.image.url").isNotNull() | got("v", "$.image.contentUrl").isNotNull(), F.array(F.coalesce(got("v", "$.image.url"), got("v", "$.image.contentUrl")))).otherwise(text_or_list("v", "$.image"))
    hours = F.coalesce(F.nullif(F.array_join(F.slice(text_or_list("v", "$.openingHours"), 1, 7), "; "), F.lit("")), got("v", "$.openingHoursSpecification"))
    rows = v.select(
        "page_id", clean(got("v", "$.name")).alias("name"), F.coalesce(got("v", "$['@type'][0]"), got("v", "$['@type']"), F.lit("web_entity")).alias("category"), address.alias("address"), nm.number(got("v", "$.geo.latitude")).alias("latitude"),
        nm.number(got("v", "$.geo.longitude")).alias("longitude"), F.coalesce(got("v", "$.url"), "url").alias("url"), got("v", "$.description").alias("description"), F.filter(same, lambda s: ~s.startswith("=")).alias("social"), got("v", "$.telephone").alias("phone"),
        hours.alias("opening_hours"), picture.alias("image_urls"), nm.number(got("v", "$.aggregateRating.ratingValue")).alias("rating"), nm.whole(F.coalesce(got("v", "$.aggregateRating.reviewCount"), got("v", "$.aggregateRating.ratingCount"))).alias("rating_count"),
        got("v", "$.priceRange").alias("price"), text_or_list("v", "$.servesCuisine").alias("cuisines"),
    )
    return rows.where("name is not null and name <> ''").withColumn("locality", nm.named_locality(F.concat_ws(" ", "address", "description"), [t for t in lex.RELEVANT if t != "hyderabad"]))


def mentions(pages: DataFrame, most: int = MENTIONS, reach: int = REACH) -> DataFrame:
    """Entities that a page's text names in list items, bold text, links and by a word of places, and, where there is html, its headings
    and list items: each name once a page, the first `most`, with the evidence, the place and the category that it tells.

    pages: page_id, text and optionally html. Null text: no mentions.
    """
    extra = pg.list_names(F.coalesce("html", F.lit(""))) if "html" in pages.columns else F.array().cast("array<string>")
    found = pages.select("page_id", "text", F.posexplode(F.concat(nm.mention_names(F.coalesce("text", F.lit("")), reach), extra)).alias("place", "name"))
    named = found.withColumn("name", nm.mention_name(F.col("name"))).where(nm.valid_name(F.col("name")))
    first = named.groupBy("page_id", F.lower("name").alias("key")).agg(F.min_by(F.struct("name", "text"), "place").alias("r"), F.min("place").alias("place"))
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy("place"))
    few = first.withColumn("rank", rank).where(F.col("rank") <= most).select("page_id", F.col("r.name").alias("name"), evidence_window(F.coalesce("r.text", F.lit("")), F.col("r.name")).alias("evidence"), "rank")
    kind = nm.named_category(F.col("name"), F.col("evidence"))
    out = few.withColumns({"category": kind, "locality": F.coalesce(nm.named_locality(F.col("evidence"), lex.LOCALITIES), F.lit("Hyderabad"))})
    return out.withColumns({"entity_type": nm.entity_type(F.col("category")), "id": entity_id(F.col("name"), F.col("locality"), F.lit(None).cast("double"), F.lit(None).cast("double"))})


def relations(entities: DataFrame, localities: list[str] | None = None, most: int = 8) -> DataFrame:
    """Edges (id, predicate, object, confidence, evidence): near for each other place that the text names, recommended_for for the first intent tags.

    entities: id, text, locality, intent_tags and optionally suitability_scores. An entity without a locality is near nothing. Each edge once.
    """
    places = [p.lower() for p in localities or lex.LOCALITIES]
    low, own = F.lower(F.coalesce("text", F.lit(""))), F.lower(F.nullif("locality", F.lit("")))
    others = F.filter(nm.words(places), lambda t: F.contains(low, t) & F.coalesce(t != own, F.lit(False)))
    near = entities.select("id", F.lit("near").alias("predicate"), F.explode(others).alias("p")).select("id", "predicate", F.replace("p", F.lit(" "), F.lit("_")).alias("object"), F.lit(0.35).alias("confidence"), F.concat(F.lit("mentions "), "p").alias("evidence"))
    score = F.coalesce(F.try_element_at("suitability_scores", F.col("t")), F.lit(0.5)) if "suitability_scores" in entities.columns else F.lit(0.5)
    tagged = entities.withColumn("t", F.explode(F.array_distinct(F.slice("intent_tags", 1, most)))).select("id", F.lit("recommended_for").alias("predicate"), F.col("t").alias("object"), score.alias("confidence"), F.concat(F.lit("matched intent tag "), "t").alias("evidence"))
    return near.unionByName(tagged)


def media_unique(media: Column) -> Column:
    """Keep-first unique media by url whatever its case, the first of them primary."""
    low = F.transform(media, lambda m: F.lower(m))
    once = F.filter(media, lambda m, i: F.array_position(low, F.lower(m)) == i + 1)
    return F.transform(once, lambda m, i: F.struct(m.alias("url"), (i == 0).alias("is_primary")))


def routed(pages: DataFrame, least: int = 500, most: int = 12_000) -> DataFrame:
    """Pages (page_id, url, html) with title, text, description, is_source_page and the route that they take.

    rerender: less than `least` characters of text; skip: not of the city; linked: linked data and no list; none: no title; mentions: a
    list, or a title that is no name; page: the page itself is an entity.
    """
    p = pages.withColumns({"title": title(F.col("html")), "text": F.coalesce(visible_text(F.col("html")), F.lit(""))})
    p = p.withColumn("is_source_page", source_page(F.col("title"), F.col("text"), F.col("url")))
    names = F.filter(json_ld(F.col("html")), lambda v: F.coalesce(F.try_variant_get(v, "$.name", "string"), F.try_variant_get(v, "$['@graph'][0].name", "string"), F.try_variant_get(v, "$[0].name", "string")).isNotNull())
    route = (
        F.when(F.length("text") < least, "rerender").when(~nm.relevant(F.concat_ws(" ", "text", F.coalesce("url", F.lit("")))), "skip").when((F.size(names) > 0) & ~F.col("is_source_page"), "linked")
        .when(F.col("title").isNull(), "none").when(F.col("is_source_page") | ~nm.valid_name(F.col("title")), "mentions").otherwise("page")
    )
    from waymark.functions.text import meta

    described = F.coalesce(meta(F.col("html"), "description"), F.substring("text", 1, 500))
    return p.withColumns({"route": route, "description": described, "raw_text": F.substring("text", 1, most)})


def page_entities(pages: DataFrame) -> DataFrame:
    """Entities of all pages, each by its route: id, page_id, name, category, description, locality, address, latitude, longitude, website, mode."""
    r = routed(pages)
    nowhere = F.lit(None).cast("double")
    columns = ("page_id", "name", "category", "description", "locality", "address", "latitude", "longitude", "website", "mode")
    linked = linked_entities(r.where("route = 'linked'")).withColumns({"website": F.col("url"), "mode": F.lit("linked")}).select(*columns)
    said = mentions(r.where("route = 'mentions'").select("page_id", "text", "html")).withColumns({
        "description": F.coalesce(F.nullif(F.substring("evidence", 1, 500), F.lit("")), F.lit(None)), "address": F.lit(None).cast("string"), "latitude": nowhere, "longitude": nowhere, "website": F.lit(None).cast("string"), "mode": F.lit("mentioned_entity"),
    }).select(*columns)
    own = r.where("route = 'page'").withColumns({
        "name": F.col("title"), "category": nm.page_category(F.col("title"), F.col("description"), F.col("text")), "locality": nm.named_locality(F.col("text"), [t for t in lex.RELEVANT if t != "hyderabad"]),
        "address": F.lit(None).cast("string"), "latitude": nowhere, "longitude": nowhere, "website": F.col("url"), "mode": F.lit("page"),
    }).select(*columns)
    every = linked.unionByName(said).unionByName(own)
    return every.withColumn("id", entity_id(F.col("name"), F.col("locality"), F.col("latitude"), F.col("longitude")))


def lookups(entities: DataFrame, priority: float = 0.6, most: int = 20) -> DataFrame:
    """Map queries for a page's entities without a position: of its first `most` entities by name."""
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy("name"))
    few = entities.withColumn("__n", rank).where(F.col("__n") <= most).where("latitude is null or longitude is null")
    return few.select("page_id", F.lit("query").alias("kind"), F.lit("openstreetmap").alias("source"), F.concat("name", F.lit(" Hyderabad")).alias("value"), F.lit(max(0.2, priority - 0.05)).alias("priority"))
