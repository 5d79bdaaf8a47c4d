"""Readers of landed payloads and small fixed dimensions, and the sinks beside them. Fetching stays outside the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import lexicons as lex
from waymark.functions.text import clean
from waymark.operators.search import nearest_seed
from waymark.operators.tables import keep_first

PAGE = "description string, raw_path string, search_query string, search_rank int, source string, source_type string, title string, url string, is_source_page boolean, metadata map<string,string>"
FRONTIER = "kind string, value string, source string, priority double, depth int, metadata map<string,string>, discovered_at timestamp"
ELEMENT = "type string, id bigint, lat double, lon double, center struct<lat: double, lon: double>, tags map<string,string>"
HIT = "title string, snippet string, description string, url string, link string, markdown string"
# Policy classes and switches of known sources.
REGISTRY = [
    ("openstreetmap", "open_data", True), ("wikidata", "open_data", True), ("wikipedia", "public_api", True), ("google_search", "official_api_required", True),
    ("web_page", "html_allowed", True), ("firecrawl_search", "html_allowed", True), ("firecrawl_page", "html_allowed", True), ("reddit", "official_api_required", False),
    ("youtube", "official_api_required", False), ("facebook", "official_api_required", False), ("instagram", "official_api_required", False), ("google_maps", "official_api_required", False),
    ("tripadvisor", "official_api_required", False), ("zomato", "official_api_required", False), ("swiggy", "official_api_required", False), ("bookmyshow", "official_api_required", False),
    ("district", "official_api_required", False), ("paytm_insider", "official_api_required", False), ("meetup", "official_api_required", False), ("eventbrite", "official_api_required", False),
    ("news_blogs_tourism_government", "html_allowed", False),
]


def scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files, one record or array each; records that don't fit the schema are dropped."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)


def source_pages(spark: SparkSession, path: str) -> DataFrame:
    """Search results and pages in one schema; of rows with one url the last file wins in the published table."""
    return scan(spark, path, PAGE).where("url is not null")


def latest_pages(pages: DataFrame) -> DataFrame:
    return keep_first(pages, [F.col("url")], [F.desc("raw_path")])


def lookup(rows: DataFrame, key: str, value) -> DataFrame:
    return rows.where(F.col(key) == value)


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGISTRY, "source string, policy string, enabled boolean")


def query_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: trimmed, without blank ones and comments, the first of equal ones whatever the case."""
    lines = spark.read.text(path).select(F.trim("value").alias("query"), F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"))
    return keep_first(lines.where("query <> '' and not startswith(query, '#')"), [F.lower("query")], [F.col("file"), F.col("line")]).select("query")


def payload_items(raw: Column) -> Column:
    """The list of hits of a search payload: an array, or under data, results or items, or data.web, images and news together."""
    kind = f"array<struct<{', '.join(c.replace(' ', ': ') for c in HIT.split(', ')) }>>"
    direct = [F.from_json(raw, kind)] + [F.from_json(F.get_json_object(raw, f"$.{k}"), kind) for k in ("data", "results", "items")]
    nested = F.concat(*[F.coalesce(F.from_json(F.get_json_object(raw, f"$.data.{k}"), kind), F.array().cast(kind)) for k in ("web", "images", "news")])
    some = lambda x: F.when(F.exists(x, lambda h: h.url.isNotNull() | h.link.isNotNull() | h.title.isNotNull()), x)
    return F.coalesce(*map(some, direct), some(nested), F.array().cast(kind))


def search_hits(payloads: DataFrame, priority: float = 0.8) -> DataFrame:
    """Candidates of a search payload in rank order, their priority decaying with the rank."""
    each = payloads.select("query", F.posexplode(payload_items(F.col("payload"))).alias("rank", "hit"))
    decayed = F.greatest(F.lit(0.1), F.lit(priority) - 0.03 * F.col("rank"))
    return each.select("query", F.coalesce("hit.url", "hit.link").alias("url"), clean(F.coalesce("hit.title", F.lit(""))).alias("title"), "rank", F.round(decayed, 4).alias("priority")).where("url is not null")


def map_category(tags: Column, group: Column) -> Column:
    """Category by the first key with a known value; any historic or sport value has one too; else the group's."""
    table = F.create_map(*[F.lit(x) for pair in lex.MAP_CATEGORIES.items() for x in pair])
    rules = []
    for key in lex.MAP_KEYS:
        value = F.nullif(F.lower(tags[key]), F.lit(""))
        rules.append(F.try_element_at(table, value))
        if key in ("historic", "sport"):
            rules.append(F.when(value.isNotNull(), {"historic": "historic", "sport": "sports_venue"}[key]))
    return F.coalesce(*rules, F.when(group == "community_ngo", "community_space"), group)


def map_name(tags: Column) -> Column:
    """The first of name, brand, official name and operator with three characters or more."""
    trimmed = [F.trim(tags[k]) for k in ("name", "brand", "official_name", "operator")]
    return F.coalesce(*[F.when(F.length(v) >= 3, clean(v)) for v in trimmed])


def map_reject(tags: Column, lat: Column, lon: Column, category: Column) -> Column:
    """The first reason that rejects a map element, or null."""
    kinds = F.transform(F.array_compact(F.array(*[tags[k] for k in ("amenity", "highway", "shop", "healthcare")])), F.lower)
    served = sorted({*lex.MAP_CATEGORIES.values(), *lex.MAP_EXTRA})
    return (
        F.when(tags.isNull() | (F.size(tags) == 0), "missing_tags").when(map_name(tags).isNull(), "missing_name").when(F.arrays_overlap(kinds, F.array(*map(F.lit, lex.UNSERVED_TAGS))), "non_serving_category")
        .when(lat.isNull() | lon.isNull(), "missing_coordinates").when(F.isnan(lat) | F.isnan(lon), "invalid_coordinates").when(~category.isin(served), "unmapped_category")
    )


def split_values(value: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), pattern), lambda v: F.trim(v)), lambda v: v != "")


def map_fields(tags: Column, name: Column, category: Column, locality: Column) -> dict[str, Column]:
    """The fields that tags give an entity."""
    some = lambda k: F.nullif(F.trim(tags[k]), F.lit(""))
    listed = lambda keys: F.array_compact(F.array(*[F.when(some(k).isNotNull(), F.concat(F.lit(f"{k}:"), tags[k])) for k in keys]))
    parts = F.concat_ws(", ", some("addr:housenumber"), some("addr:street"), some("addr:neighbourhood"), some("addr:suburb"), F.coalesce(some("addr:city"), F.lit("Hyderabad")), some("addr:postcode"))
    aliases = F.array_sort(F.array_distinct(F.flatten(F.array(*[split_values(tags[k], r"[;|]") for k in lex.MAP_ALIASES]))))
    cuisines = F.transform(split_values(tags["cuisine"], "[;,]"), lambda c: F.concat(F.lit("cuisine:"), c))
    crowd = [F.when(category.isin(kinds), F.array(*map(F.lit, people))).otherwise(F.array().cast("array<string>")) for kinds, people in lex.MAP_AUDIENCE]
    reach = F.when(F.lower(tags["wheelchair"]).isin("yes", "limited"), F.array(F.lit("accessibility"))).otherwise(F.array().cast("array<string>"))
    amenities = F.array_sort(F.array_distinct(F.concat(listed(lex.MAP_AMENITIES), cuisines)))
    base = F.coalesce(*[F.when(category == c, F.array(*map(F.lit, t))) for c, t in lex.MAP_TAGS.items()], F.array(F.lit("explore"), F.lit("local")))
    online = F.lower(F.array_join(amenities, " ")).rlike("internet_access|wifi")
    always = F.contains(F.coalesce(tags["opening_hours"], F.lit("")), F.lit("24/7"))
    extra = lambda c, t: F.when(c, F.array(*map(F.lit, t))).otherwise(F.array().cast("array<string>"))
    own = F.array_sort(F.array_distinct(F.concat(base, extra(online, ["wifi", "work"]), extra(always, ["late_night", "after_midnight"]))))
    wiki, title = some("wikipedia"), lambda t: F.replace(F.url_encode(F.replace(t, F.lit(" "), F.lit("_"))), F.lit("+"), F.lit("%20"))
    language = F.when(F.contains(wiki, F.lit(":")), F.substring_index(wiki, ":", 1)).otherwise("en")
    page = F.when(F.contains(wiki, F.lit(":")), F.expr("null").cast("string")).otherwise(wiki)
    page = F.coalesce(page, F.regexp_extract(wiki, r"^[^:]*:(.*)$", 1))
    commons = some("wikimedia_commons")
    file = F.when(F.lower(commons).startswith("file:"), F.concat(F.lit("https://commons.wikimedia.org/wiki/Special:FilePath/"), F.replace(F.url_encode(F.trim(F.regexp_extract(commons, r"^[^:]*:(.*)$", 1))), F.lit("+"), F.lit("%20")), F.lit("?width=1280")))
    image = F.when(some("image").rlike("^https?://"), some("image"))
    phone = F.coalesce(some("contact:phone"), some("phone"))
    return {
        "address": F.coalesce(F.trim(some("addr:full")), F.nullif(parts, F.lit("")), F.concat_ws(", ", name, locality, F.lit("Hyderabad"), F.lit("Telangana"))), "aliases": aliases, "subcategories": listed(lex.MAP_SUBCATEGORIES), "amenities": amenities,
        "audience": F.array_sort(F.array_distinct(F.concat(*crowd, reach))), "phone": phone, "website": F.coalesce(some("website"), some("contact:website")), "wikipedia_url": F.concat(F.lit("https://"), language, F.lit(".wikipedia.org/wiki/"), title(page)),
        "media_urls": F.array_distinct(F.array_compact(F.array(image, F.coalesce(F.when(commons.rlike("^https?://"), commons), file)))), "social": F.array_compact(F.array(*[F.when(some(k).isNotNull(), F.concat(F.lit(k.replace("contact:", "") + "="), tags[k])) for k in ("facebook", "instagram", "twitter", "contact:facebook", "contact:instagram")])),
        "pricing": F.array_compact(F.array(*[F.when(some(k).isNotNull(), F.concat(F.lit(f"{n}="), tags[k])) for k, n in (("fee", "fee"), ("payment:cash", "cash"), ("payment:cards", "cards"))])),
        "open_24_hours": F.coalesce(F.trim(tags["opening_hours"]) == "24/7", F.lit(False)), "intent_tags": own, "context_keys": F.array_sort(F.array_distinct(F.concat(F.array(category, locality), own))),
        "branch_ids": F.array_sort(F.array_distinct(F.array(category, F.lit("places"), F.lit("hyderabad")))),
    }


def map_entities(elements: DataFrame, group: str = "place", seeds: list[tuple[str, float, float]] | None = None) -> DataFrame:
    """Map elements as entities, or with the first reason that rejects them. group: the category of elements whose tags have none."""
    tags = F.col("tags")
    e = elements.withColumns({"lat": F.coalesce("lat", "center.lat"), "lon": F.coalesce("lon", "center.lon")})
    told = [F.nullif(F.trim(tags[k]), F.lit("")) for k in ("addr:suburb", "addr:neighbourhood", "addr:quarter", "addr:city", "is_in:suburb")]
    own = F.coalesce(*[F.when(~F.lower(t).isin("hyderabad", "secunderabad"), t) for t in told])
    near = nearest_seed(e.withColumnsRenamed({"lat": "latitude", "lon": "longitude"}), seeds or lex.SEEDS)
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    rows = near.withColumns({"name": map_name(tags), "category": map_category(tags, F.lit(group)), "locality": F.when(placed, F.coalesce(own, "seed.n"))}).drop("seed")
    rows = rows.withColumn("reject_reason", map_reject(tags, F.col("latitude"), F.col("longitude"), F.col("category")))
    fields = map_fields(tags, F.col("name"), F.col("category"), F.col("locality"))
    return rows.select(F.col("id").alias("element_id"), "name", "category", "latitude", "longitude", "locality", *[c.alias(k) for k, c in fields.items()], "reject_reason")


def geocoded(payloads: DataFrame, accepted: list[str]) -> DataFrame:
    """First geocoder hit whose display name holds an accepted place term, with the finest locality of its address."""
    kind = "array<struct<display_name: string, lat: string, lon: string, address: map<string,string>>>"
    hit = F.get(F.filter(F.from_json("payload", kind), lambda h: F.lower(h.display_name).rlike("|".join(accepted))), F.lit(0))
    a = F.col("hit.address")
    return payloads.withColumn("hit", hit).where("hit is not null").select("id", F.col("hit.lat").try_cast("double").alias("latitude"), F.col("hit.lon").try_cast("double").alias("longitude"), F.coalesce(a["suburb"], a["neighbourhood"], a["city_district"], a["city"], a["town"]).alias("locality"))


def claims(payloads: DataFrame) -> DataFrame:
    """First image and website claim of knowledge-base records."""
    first = lambda p: F.get_json_object("payload", f"$.claims.{p}[0].mainsnak.datavalue.value")
    return payloads.select("qid", first("P18").alias("image"), first("P856").alias("website"), F.get_json_object("payload", "$.sitelinks.enwiki.title").alias("article"))


def claim_values(payload: Column, qid: Column, prop: str) -> Column:
    """All main values of a property of a knowledge-base record, as texts: plain ones, or the id of another record."""
    at = F.concat(F.lit("$.entities['"), qid, F.lit(f"'].claims.{prop}"))
    items = F.from_json(F.call_function("get_json_object", payload, at), "array<string>")
    value = lambda c: F.coalesce(F.get_json_object(c, "$.mainsnak.datavalue.value.id"), F.get_json_object(c, "$.mainsnak.datavalue.value"))
    return F.array_compact(F.transform(F.coalesce(items, F.array().cast("array<string>")), value))


def page_summaries(payloads: DataFrame) -> DataFrame:
    """Title, extract and thumbnail of each page of an encyclopedia answer (query.pages, a list or a map by id)."""
    kind = "struct<title: string, extract: string, thumbnail: struct<source: string>, missing: string>"
    pages = F.get_json_object("payload", "$.query.pages")
    each = F.coalesce(F.when(pages.startswith("["), F.from_json(pages, f"array<{kind}>")), F.map_values(F.from_json(pages, f"map<string,{kind}>")))
    rows = payloads.select("id", F.explode(each).alias("p")).where("p.title is not null and p.missing is null")
    return rows.select("id", "p.title", F.nullif(F.trim("p.extract"), F.lit("")).alias("extract"), F.col("p.thumbnail.source").alias("image_url"))


def summary_images(payloads: DataFrame) -> DataFrame:
    """The picture of each page summary (id, name, payload) that is of the entity: the original before the thumbnail, none of disambiguations."""
    from waymark.operators.refine import image_page_matches

    at = lambda p: F.get_json_object("payload", p)
    url = F.coalesce(F.nullif(at("$.originalimage.source"), F.lit("")), F.nullif(at("$.thumbnail.source"), F.lit("")))
    fit = image_page_matches(F.col("name"), F.coalesce(at("$.title"), F.lit("")), F.lower(F.coalesce(at("$.extract"), F.lit(""))))
    rows = payloads.where(F.lower(F.coalesce(at("$.type"), F.lit(""))) != "disambiguation").where(fit).withColumn("image_url", url)
    return rows.where("image_url is not null").select("id", "image_url", at("$.title").alias("page_title"), at("$.content_urls.desktop.page").alias("page_url"))


def image_files(spark: SparkSession, path: str, most_bytes: int = 5_000_000) -> DataFrame:
    """Image files up to a size, with their checksum and type by suffix."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.col("length") <= most_bytes)
    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    mime = F.concat(F.lit("image/"), F.when(kind == "jpg", "jpeg").otherwise(kind))
    return files.where(kind.isin("jpg", "jpeg", "png", "webp", "gif")).select("path", "length", mime.alias("content_type"), F.sha2("content", 256).alias("sha256"), "content")


def raw_key(key: Column) -> Column:
    """Storage key: safe characters, at most 100 of them, and 12 digits of a hash."""
    return F.concat(F.substring(F.regexp_replace(key, "[^A-Za-z0-9_-]", "_"), 1, 100), F.lit("-"), F.substring(F.sha2(key, 256), 1, 12))


def write_raw(rows: DataFrame, path: str) -> None:
    rows.withColumn("raw_key", raw_key(F.col("key"))).write.mode("append").partitionBy("source").parquet(path)


