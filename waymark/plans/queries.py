"""Every operator as a named query over the star-schema tables, with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.functions import lexicons as lex
from waymark.functions import text as tx
from waymark.operators import quality as ql
from waymark.operators import search as se
from waymark.operators import tables as tb
from waymark.plans.registry import QUERIES, SQL, query
from waymark.plans.views import ENTITIES, FRONTIER, entities, frontier, metres, resolvable, table

def boundary(term: str) -> str:
    """SQL for the hits of a term between characters that are no letters or digits; separators are doubled first."""
    return f"len(regexp_extract_all(' ' || regexp_replace(lower(text), '([^a-z0-9])', '\\1\\1', 'g') || ' ', '[^a-z0-9]{term}[^a-z0-9]'))"


LINE_TAGS = {"articles": ["the", "der", "la"], "links": ["and", "und", "est"], "places": ["in", "im", "en"]}


# Coverage and reports ------------------------------------------------------------------------------------------------


@query(ENTITIES + "select coalesce(nullif(category, ''), 'unknown') as category, count(*) as n from e group by 1")
def coverage_by_category(spark, sf):
    return entities(spark, sf).groupBy(F.coalesce(F.nullif("category", F.lit("")), F.lit("unknown")).alias("category")).agg(F.count("*").alias("n"))


@query(ENTITIES + "select coalesce(nullif(locality, ''), 'unknown') as locality, count(*) as n from e group by 1")
def coverage_by_locality(spark, sf):
    return entities(spark, sf).groupBy(F.coalesce(F.nullif("locality", F.lit("")), F.lit("unknown")).alias("locality")).agg(F.count("*").alias("n"))


@query(ENTITIES + "select 'source' || s::varchar as source, count(*) as n from (select unnest(range(0, n_sources)) as s from e) group by 1")
def coverage_by_source(spark, sf):
    records = entities(spark, sf).where("n_sources > 0").select(F.explode(F.expr("transform(sequence(0, n_sources - 1), i -> concat('source', cast(i as string)))")).alias("source"))
    return records.groupBy("source").agg(F.count("*").alias("n"))


@query("select n as entities_total, f as frontier_total, case when n = 0 then 0 else round(greatest(0, 1 - least(f, n) / n::double), 3) end as plateau from (select count(*) as n from customer), (select count(*) as f from events where event_type = 'view')")
def plateau_signal(spark, sf):
    f = table(spark, sf, "events").where("event_type = 'view'").agg(F.count("*").alias("f"))
    n = table(spark, sf, "customer").agg(F.count("*").alias("n"))
    value = F.when(F.col("n") == 0, 0.0).otherwise(F.round(F.greatest(F.lit(0.0), 1 - F.least("f", "n") / F.col("n")), 3))
    return n.join(f).select(F.col("n").alias("entities_total"), F.col("f").alias("frontier_total"), value.alias("plateau"))  # one row each


# Frontier ------------------------------------------------------------------------------------------------------------


@query(FRONTIER + "select kind, source, value, priority, seq from f qualify row_number() over (partition by kind, source, lower(value) order by priority desc, seq) = 1")
def frontier_dedupe(spark, sf):
    return tb.dedupe_frontier(frontier(spark, sf)).select("kind", "source", "value", "priority", "seq")


@query(FRONTIER + "select kind, source, value, priority, depth, seq from (select * from f qualify row_number() over (partition by kind, source, lower(value) order by priority desc, seq) = 1) where depth <= 3 order by priority desc, seq limit 50")
def frontier_batch(spark, sf):
    return tb.next_batch(tb.dedupe_frontier(frontier(spark, sf)), 50).select("kind", "source", "value", "priority", "depth", "seq")


@query(FRONTIER + "select seq, kind, priority * 0.5::double as priority, (retry_count + 1)::int as retry_count from f where retry_count < case when kind = 'source_url' then 1 else 3 end")
def retry_decay(spark, sf):
    return tb.retried(frontier(spark, sf)).select("seq", "kind", "priority", F.col("retry_count").cast("int").alias("retry_count"))


@query(FRONTIER + "select seq, round(greatest(0.1::double, 0.9::double - 0.03::double * depth), 4) as decayed from f")
def rank_decay(spark, sf):
    return frontier(spark, sf).select("seq", F.round(tb.rank_decayed(F.lit(0.9), F.col("depth")), 4).alias("decayed"))


@query(FRONTIER + "select f.seq, coalesce(d.adapter, 'none') as adapter from f left join (values ('source_url', 'src0', 'page'), ('source_url', 'src1', 'page'), ('view', 'src0', 'map'), ('purchase', 'src2', 'search')) d(kind, source, adapter) using (kind, source)")
def adapter_dispatch(spark, sf):
    rows = [("source_url", "src0", "page"), ("source_url", "src1", "page"), ("view", "src0", "map"), ("purchase", "src2", "search")]
    adapters = spark.createDataFrame(rows, "kind string, source string, adapter string")  # a fixed dimension
    return frontier(spark, sf).join(F.broadcast(adapters), ["kind", "source"], "left").select("seq", F.coalesce("adapter", F.lit("none")).alias("adapter"))


# Text ----------------------------------------------------------------------------------------------------------------


@query(r"select doc_id, list_sort(list_distinct(regexp_extract_all(text, '[0-9A-Za-z_.+-]+@[0-9A-Za-z_-]+\.[0-9A-Za-z_.-]+'))) as emails, list_sort(list_distinct(regexp_extract_all(text, '(?:\+91[-\s]?)?[6-9][0-9]{9}'))) as phones from documents where regexp_matches(text, '@|[6-9][0-9]{9}')")
def contacts_extract(spark, sf):
    d = table(spark, sf, "documents").where(F.col("text").rlike("@|[6-9][0-9]{9}"))
    return d.select("doc_id", tx.found(F.col("text"), lex.EMAIL).alias("emails"), tx.found(F.col("text"), lex.PHONE).alias("phones"))


@query("select doc_id, list_filter([" + ", ".join(f"case when {' + '.join(boundary(t) for t in terms)} > 0 then '{tag}' end" for tag, terms in LINE_TAGS.items()) + "], lambda x: x is not null) as tags from documents")
def tag_match(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.tags(F.col("text"), LINE_TAGS).alias("tags"))


@query("select doc_id, round(least(1.0::double, 0.35::double + 0.15::double * (" + " + ".join(f"case when {boundary(t)} > 0 then 1 else 0 end" for t in LINE_TAGS["articles"]) + ")), 3) as score from documents")
def tag_scores(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.keyword_score(F.col("text"), LINE_TAGS["articles"]).alias("score"))


@query("select doc_id, (" + " + ".join(boundary(t) for t in ("the", "and", "of")) + ")::int as hits from documents")
def term_counts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.term_count(F.col("text"), ["the", "and", "of"]).cast("int").alias("hits"))


@query("with c as (select doc_id, " + " + ".join(boundary(t) for t in ("the", "that", "this")) + " as p, " + " + ".join(boundary(t) for t in ("of", "in", "on")) + " as n from documents) select doc_id, case when p > 1.3::double * n then 'positive' when n > 1.3::double * p then 'negative' else 'mixed' end as sentiment from c")
def sentiment(spark, sf):
    c = table(spark, sf, "documents").select("doc_id", tx.term_count(F.col("text"), ["the", "that", "this"]).alias("p"), tx.term_count(F.col("text"), ["of", "in", "on"]).alias("n"))
    return c.select("doc_id", F.when(F.col("p") > 1.3 * F.col("n"), "positive").when(F.col("n") > 1.3 * F.col("p"), "negative").otherwise("mixed").alias("sentiment"))


def _count(t: str) -> str:
    return f"(length(lower(text)) - length(replace(lower(text), '{t}', ''))) / {len(t)}::double"


@query("with c as (select doc_id, " + " + ".join(map(_count, ["the", "and"])) + " as p, " + " + ".join(map(_count, ["er", "in"])) + " as n from documents) select doc_id, case when p + n = 0 then 0 else round((p - n) / (p + n), 3) end as score from c")
def sentiment_substring(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.substring_sentiment(F.col("text"), ["the", "and"], ["er", "in"]).alias("score"))


@query(r"with t as (select doc_id, unnest(string_split_regex(lower(text), '[ \t\r\n\f]+')) as token, unnest(range(len(string_split_regex(lower(text), '[ \t\r\n\f]+')))) as pos from documents), c as (select doc_id, token, count(*) as n, min(pos) as first from t where length(token) > 4 group by 1, 2), p as (select *, row_number() over (partition by doc_id order by n desc, first) as place from c) select doc_id, token, n, place::int as place from p where place <= 12")
def topics_top12(spark, sf):
    return tb.top_tokens(table(spark, sf, "documents"), "doc_id", "text")


@query(r"select doc_id, len(s)::int as n_sentences, s[1] as first_sentence from (select doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) > 40) as s from documents)")
def review_signals(spark, sf):
    s = table(spark, sf, "documents").select("doc_id", tx.sentences(F.col("text")).alias("s"))
    return s.select("doc_id", F.size("s").alias("n_sentences"), F.get("s", F.lit(0)).alias("first_sentence"))


@query()
def review_signal_rows(spark, sf):
    """One row for each of a document's signals, at most 12; no SQL form, tests hold it against brute force."""
    d = table(spark, sf, "documents")
    s = d.select("doc_id", F.explode(tx.review_signals(F.col("doc_id"), F.col("text"))).alias("s")).select("doc_id", "s.*")
    low, text = F.lower("text"), F.col("text")
    hits = lambda terms: sum(((F.length(low) - F.length(F.replace(low, F.lit(t), F.lit("")))) / F.lit(len(t)) for t in terms), F.lit(0.0))
    p, n = hits(lex.SIGNAL_POSITIVE), hits(lex.SIGNAL_NEGATIVE)
    s = s.withColumn("sentiment_score", F.when(p + n == 0, F.lit(0.0)).otherwise(F.bround((p - n) / (p + n), 3)))
    label = F.when(F.col("sentiment_score") > 0.2, "positive").when(F.col("sentiment_score") < -0.2, "negative").otherwise("mixed")
    return s.select(
        "id", "doc_id", "idx", F.lit("web_page_extracted").alias("source"), F.substring("text", 1, 1000).alias("text"), label.alias("sentiment"), "sentiment_score", tx.keywords(text).alias("topics"),
        tx.tags(text, lex.SIGNAL_INTENTS).alias("mentioned_intents"), tx.tags(text, lex.SIGNAL_SAFETY).alias("mentioned_safety_signals"), tx.tags(text, lex.SIGNAL_PRICE).alias("mentioned_price_signals"), F.lit(0.35).alias("confidence"),
    )


@query("select c_custkey, nullif(regexp_replace(lower(c_name), '[^a-z0-9]+', '', 'g'), '') as fingerprint, regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as slug from customer")
def fingerprints(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", tx.fingerprint(F.col("c_name")).alias("fingerprint"), tx.slug(F.col("c_name")).alias("slug"))


@query(ENTITIES + r""", p as (select id, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) as n, trim(regexp_replace(lower(coalesce(locality, '')), '[^a-z0-9]+', ' ', 'g')) as l, latitude as a, longitude as o from e)
select id, regexp_replace(substr(replace(n, ' ', '-'), 1, 48), '-+$', '') || '-' || substr(sha1(concat_ws('|', nullif(n, ''), nullif(l, ''), case when a is not null then printf('%.4f', round(a, 4)) || ':' || printf('%.4f', round(o, 4)) end)), 1, 12) as entity_id from p""")
def entity_ids(spark, sf):
    return entities(spark, sf).select("id", tx.entity_id(F.col("name"), F.col("locality"), F.col("latitude"), F.col("longitude"), padded=True).alias("entity_id"))


@query("select event_id, (props->>'$.k')::bigint as k from events")
def event_props_json(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


# Places --------------------------------------------------------------------------------------------------------------

@query(ENTITIES + ", s(i, n, a, o) as (values " + ", ".join(f"({i}, '{n}', {a}::double, {o}::double)" for i, (n, a, o) in enumerate(lex.SEEDS)) + f"), p as (select id, n, i, {metres('latitude', 'longitude', 'a', 'o')} as d from e, s where latitude is not null) select id, n as seed, round(d, 1) as metres from p qualify row_number() over (partition by id order by d, i) = 1")
def nearest_seed(spark, sf):
    return se.nearest_seed(entities(spark, sf).where("latitude is not null"), lex.SEEDS).select("id", F.col("seed.n").alias("seed"), F.round("seed.d", 1).alias("metres"))


@query(ENTITIES + f"select id, round({metres('latitude', 'longitude', '17.4447::double', '78.4665::double')} / 1000, 2) as km from e where {metres('latitude', 'longitude', '17.4447::double', '78.4665::double')} <= 8000")
def within_radius(spark, sf):
    d = tx.haversine_m(F.col("latitude"), F.col("longitude"), F.lit(17.4447), F.lit(78.4665))
    return entities(spark, sf).where(d <= 8000).select("id", F.round(d / 1000, 2).alias("km"))


@query(ENTITIES + f"select a.id as id, count(*) as n_near from e a join e b on a.id <> b.id and a.c_nationkey = b.c_nationkey and {metres('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} <= 1000 group by 1")
def geo_pairs_banded(spark, sf):
    """Range join by grid: each place meets the nine cells around it."""
    cell = 1000 / 111_000 * 1.05
    e = entities(spark, sf).where("latitude is not null").select("id", "c_nationkey", "latitude", "longitude", F.floor(F.col("latitude") / cell).alias("y"), F.floor(F.col("longitude") / (1.1 * cell)).alias("x"))
    around = F.array(*[F.struct(F.lit(i).alias("dy"), F.lit(j).alias("dx")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    b = e.withColumn("d", F.explode(around)).select(F.col("id").alias("other"), "c_nationkey", F.col("latitude").alias("lat2"), F.col("longitude").alias("lon2"), (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x"))
    near = e.join(b, ["c_nationkey", "y", "x"]).where("id <> other").where(tx.haversine_m(F.col("latitude"), F.col("longitude"), F.col("lat2"), F.col("lon2")) <= 1000)
    return near.groupBy("id").agg(F.count("*").alias("n_near"))


@query(ENTITIES + "select locality, round(avg(latitude) + 1e-9::double, 4) as latitude, round(avg(longitude) + 1e-9::double, 4) as longitude from e where latitude is not null and locality is not null group by 1")
def locality_centroids(spark, sf):
    e = entities(spark, sf).where("latitude is not null and locality is not null")
    return e.groupBy("locality").agg(F.round(F.avg("latitude") + 1e-9, 4).alias("latitude"), F.round(F.avg("longitude") + 1e-9, 4).alias("longitude"))


# Quality -------------------------------------------------------------------------------------------------------------

_RATED = ENTITIES + """, r as (select *, list_sort(list_filter([
  case when locality is null then 'locality' end, case when address is null then 'address' end, case when latitude is null then 'latitude' end, case when longitude is null then 'longitude' end,
  case when image_id is null then 'image' end, case when n_sources = 0 then 'source' end], lambda x: x is not null)) as missing,
 list_sort(list_filter([case when latitude is null then 'missing_coordinates' end, case when image_id is null then 'missing_image' end, case when locality is null then 'missing_locality' end,
  case when address is null then 'missing_address' end, case when n_sources = 0 then 'missing_source_provenance' end, case when confidence < 0.35 then 'low_confidence' end], lambda x: x is not null)) as blockers,
 list_sort(list_filter([case when rating is null then 'missing_rating' end, case when timings is null then 'missing_timings' end, case when len(intent_tags) = 0 then 'missing_intent_tags' end], lambda x: x is not null)) as warnings from e),
q as (select *, round(least(1.0::double, greatest(0.0::double, 1 - 0.18::double * len(missing) - 0.25::double * len(blockers) - 0.04::double * len(warnings)
  + case when address is null then 0 else 0.05::double end + case when image_id is null then 0 else 0.05::double end + case when rating is null then 0 else 0.05::double end
  + case when len(intent_tags) = 0 then 0 else 0.05::double end)), 3) as quality_score, len(blockers) = 0 and len(missing) = 0 as production_ready from r)
"""


@query(_RATED + "select id, missing, blockers, warnings, quality_score, production_ready from q")
def quality_rows(spark, sf):
    return ql.with_quality(entities(spark, sf)).select("id", "missing", "blockers", "warnings", "quality_score", "production_ready")


@query(_RATED + "select count(*) as total, count_if(production_ready)::bigint as ready, count_if(not production_ready)::bigint as blocked from q")
def quality_summary(spark, sf):
    return ql.with_quality(entities(spark, sf)).agg(F.count("*").alias("total"), F.count_if("production_ready").alias("ready"), F.count_if(~F.col("production_ready")).alias("blocked"))


@query(_RATED + "select id from q where len(list_filter(missing, lambda x: x <> 'image')) = 0 and len(list_filter(blockers, lambda x: x <> 'missing_image')) = 0")
def serving_gate(spark, sf):
    return ql.with_quality(entities(spark, sf)).where(ql.serving_ready(None)).select("id")


@query(_RATED + "select unnest(blockers) as reason, count(*) as n from q group by 1")
def skip_reasons(spark, sf):
    return ql.with_quality(entities(spark, sf)).select(F.explode("blockers").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(_RATED + "select id from q where list_contains(missing, 'image') and len(missing) = 1 and len(list_filter(blockers, lambda x: x <> 'missing_image')) = 0")
def image_only_missing(spark, sf):
    only = (F.size(F.array_except("missing", F.array(F.lit("image")))) == 0) & F.array_contains("missing", "image")
    return ql.with_quality(entities(spark, sf)).where(only & (F.size(F.array_except("blockers", F.array(F.lit("missing_image")))) == 0)).select("id")


@query(_RATED + """, w as (select id, list_filter([case when list_contains(missing, 'address') then name || ' address' end, case when list_contains(missing, 'image') then name || ' photos' end,
 case when list_contains(missing, 'latitude') then name || ' location map' end, case when list_contains(missing, 'locality') then name || ' area' end,
 case when list_contains(missing, 'source') then name || ' official website' end], lambda x: x is not null) as qs from q), u as (select id, unnest(qs) as query from w)
select id, query, source from u, (values ('google_search'), ('firecrawl_search')) s(source)""")
def enrichment_queries(spark, sf):
    return ql.gap_queries(ql.with_quality(entities(spark, sf)))


@query(ENTITIES + "select id, round(least(1.0::double, rating_count / 1500::double + n_reviews / 300::double + n_sources * 0.05::double), 3) as popularity, round(case when rating_count = 0 then 0.5::double else least(1.0::double, greatest(0.0::double, 0.85::double - rating_count / 2000::double + 0.03::double * n_sources)) end + 1e-9::double, 3) as hidden_gem from e")
def popularity(spark, sf):
    c = F.col
    return entities(spark, sf).select("id", ql.popularity(c("rating_count"), c("n_reviews"), c("n_sources")).alias("popularity"), ql.hidden_gem(c("rating_count"), c("n_sources")).alias("hidden_gem"))


@query(ENTITIES + "select id, round(least(1.0::double, 0.25::double + 0.12::double * len(intent_tags) + 0.35::double * coalesce(rating / 5, 0) + least(n_reviews, 20) / 100::double), 3) as suitability from e")
def suitability(spark, sf):
    return entities(spark, sf).select("id", ql.suitability(F.size("intent_tags"), F.col("rating") / 5, F.col("n_reviews")).alias("suitability"))


@query(ENTITIES + "select id, round(least(1.0::double, 0.2::double + " + " + ".join(f"case when coalesce({c}, '') <> '' then 0.08::double else 0 end" for c in ("name", "category", "description", "locality", "address")) + " + case when latitude is not null then 0.15::double else 0 end + case when length(description) > 500 then 0.1::double else 0 end), 3) as confidence from e")
def data_confidence(spark, sf):
    c = F.col
    return entities(spark, sf).select("id", ql.data_confidence([c(x) for x in ("name", "category", "description", "locality", "address")], c("latitude"), c("longitude"), c("description")).alias("confidence"))


# Search --------------------------------------------------------------------------------------------------------------

ASKED = se.compiled("quiet places to walk near Begumpet")
_HAY = "lower(concat_ws(' ', name, category, locality, address, description, array_to_string(intent_tags, ' ')))"
_HIT = lambda words: " + ".join(f"""len(regexp_extract_all(' ' || regexp_replace({_HAY}, '([^a-z0-9])', '\\1\\1', 'g') || ' ', '[^a-z0-9]{w.replace(" ", "  ")}[^a-z0-9]'))""" for w in words)
_CARDS = ENTITIES + f""", c as (select *, list_filter([{", ".join(f"case when {_HIT([t])} > 0 then '{t}' end" for t in dict.fromkeys(ASKED.terms))}], lambda x: x is not null) as matched_terms,
 list_filter([{", ".join(f"case when {_HIT(lex.MOOD_TERMS[m])} > 0 then '{m}' end" for m in ASKED.moods)}], lambda x: x is not null) as moods,
 round({metres('17.4447::double', '78.4665::double', 'latitude', 'longitude').replace('6371000.0', '6371008.8')} / 1000, 2) as distance_km,
 contains(lower(concat_ws(' ', name, locality, address)), 'begumpet') as hinted from e),
s as (select *, round(0.9::double * len(matched_terms) + 1.4::double * len(moods) + case when hinted then 3 else 0 end + coalesce(greatest(0, 2.5::double - 0.25::double * least(distance_km, 10)), 0)
 + case when latitude is null then 0 else 0.5::double end + case when address is null then 0 else 0.25::double end + case when image_id is null then 0 else 0.25::double end, 3) as relevance_score
 from c where len(matched_terms) > 0 or len(moods) > 0 or coalesce(distance_km <= 8, false))
"""


@query(_CARDS + "select id, name, matched_terms, moods, distance_km, relevance_score from s order by relevance_score desc, coalesce(distance_km, 9999), id limit 10")
def search_cards(spark, sf):
    return se.top(se.cards(entities(spark, sf), ASKED), 10).select("id", "name", "matched_terms", "moods", "distance_km", "relevance_score")


_SUITED = ("solo", "quiet", "nightlife")
_SUM = " + ".join(f"""case when list_contains(intent_tags, '{tag}') then round(least(1.0::double, 0.35::double + 0.15::double * ({" + ".join(f"regexp_matches(lower(description), '(^|[^a-z0-9]){t}($|[^a-z0-9])')::int" for t in lex.INTENT_TERMS[tag])})), 3) else 0.0::double end""" for tag in _SUITED)


# Ties of the third digit go up in decimal, as Spark rounds; a double's product with 1000 may fall below them.
@query(_CARDS + f""", w as (select *, round((0.9::double * len(matched_terms) + 1.4::double * len(moods) + ({_SUM}) + case when hinted then 3 else 0 end + coalesce(greatest(0, 2.5::double - 0.25::double * least(distance_km, 10)), 0)
 + case when latitude is null then 0 else 0.5::double end + case when address is null then 0 else 0.25::double end + case when image_id is null then 0 else 0.25::double end)::decimal(18, 9), 3)::double as suited_score from s)
select id, name, matched_terms, moods, distance_km, suited_score as relevance_score from w order by suited_score desc, coalesce(distance_km, 9999), id limit 10""")
def search_cards_suited(spark, sf):
    """search_cards with the intent tags' suitability, by the terms of each tag in the description."""
    scores = F.create_map(*[x for t in _SUITED for x in (F.lit(t), tx.keyword_score(F.col("description"), lex.INTENT_TERMS[t]))])
    e = entities(spark, sf).withColumn("suitability_scores", scores)
    return se.top(se.cards(e, se.hinted(ASKED, e)), 10).select("id", "name", "matched_terms", "moods", "distance_km", "relevance_score")


_OWN_MOODS = f"""list_sort(list_distinct(list_concat(intent_tags, list_filter([{", ".join(f"case when {_HIT(words)} > 0 then '{m}' end" for m, words in lex.MOOD_TERMS.items())}], lambda x: x is not null))))"""


def _met(term: str) -> str:
    moods = ", ".join(f"'{m}'" for m in {*se.moods_of((term,)), term})
    return f"case when {_HIT([term])} > 0 or list_has_any(mood_tags, [{moods}]) then '{term}' end"


@query(_CARDS + f""", t as (select *, {_OWN_MOODS} as mood_tags from c), y as (select *, list_filter([{", ".join(_met(t) for t in sorted(set(ASKED.terms)))}], lambda x: x is not null) as met, list_sort(list_intersect(mood_tags, [{", ".join(f"'{m}'" for m in ASKED.moods)}])) as felt,
 regexp_matches(lower(concat_ws(' ', name, locality, address)), '(^|[^a-z0-9])begumpet($|[^a-z0-9])') as at_hint from t),
w as (select *, round((0.9::double * len(met) + 1.4::double * len(felt) + ({_SUM}) + case when at_hint then 3 else 0 end + coalesce(greatest(0, 2.5::double - 0.25::double * least(distance_km, 10)), 0)
 + case when latitude is null then 0 else 0.5::double end + case when address is null then 0 else 0.25::double end + case when image_id is null then 0 else 0.25::double end)::decimal(18, 9), 3)::double as score from y where len(met) > 0 or len(felt) > 0 or coalesce(distance_km <= 8, false))
select id, name, met as matched_terms, felt as moods, mood_tags, distance_km, score as relevance_score from w order by score desc, coalesce(distance_km, 9999), id limit 10""")
def search_cards_whole(spark, sf):
    """Terms, moods and the hint by all that entities say, with their suitability."""
    scores = F.create_map(*[x for t in _SUITED for x in (F.lit(t), tx.keyword_score(F.col("description"), lex.INTENT_TERMS[t]))])
    e = entities(spark, sf).withColumn("suitability_scores", scores)
    return se.top(se.cards(e, se.hinted(ASKED, e), whole=True), 10).select("id", "name", "matched_terms", "moods", "mood_tags", "distance_km", "relevance_score")


@query(SQL["search_cards_whole"])
def search_indexed(spark, sf):
    """search_cards_whole from an inverted index over all entities, of which only blocks that can enter are read."""
    from waymark.operators.scratch import folder
    from waymark.operators.search_index import Index, search

    scores = F.create_map(*[x for t in _SUITED for x in (F.lit(t), tx.keyword_score(F.col("description"), lex.INTENT_TERMS[t]))])
    index = Index.write(entities(spark, sf).withColumn("suitability_scores", scores), folder(spark, "index"))
    found = search(index, se.hinted(ASKED, index.read("cards")), 10)
    return found.cards.select("id", "name", "matched_terms", "moods", "mood_tags", "distance_km", "relevance_score")


@query(_CARDS + "select count(*) as total_cards from s")
def search_total(spark, sf):
    return se.cards(entities(spark, sf), ASKED).agg(F.count("*").alias("total_cards"))


# Tables --------------------------------------------------------------------------------------------------------------


@query(r"with k as (select p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g'), '\b(?:the|near|at|in|hyderabad|telangana|india)\b', ' ', 'g'), ' +', ' ', 'g')) as key from part) select p_partkey, key from k qualify row_number() over (partition by key order by p_partkey) = 1")
def serving_dedupe(spark, sf):
    words = F.regexp_replace(F.regexp_replace(F.lower("p_name"), "[^a-z0-9]+", " "), lex.SERVING_STOPS, " ")
    rows = table(spark, sf, "part").select("p_partkey", F.trim(F.regexp_replace(words, " +", " ")).alias("key"))
    return tb.keep_first(rows, [F.col("key")], [F.col("p_partkey")])


_BRANCH = ENTITIES + ", b as (select id, name, c_acctbal, ['build', 'network', 'explore', 'date'][1 + id % 4] as branch from e)"


def branches(spark, sf):
    return entities(spark, sf).select("id", "name", "c_acctbal", F.element_at(F.array(*map(F.lit, lex.BRANCHES)), (F.col("id") % 4 + 1).cast("int")).alias("branch"))


@query(_BRANCH + " select id, branch, row_number() over (partition by branch order by c_acctbal desc, lower(name) desc, id)::int as turn, (1 + id % 4)::bigint as group_order from b")
def branch_round_robin(spark, sf):
    return tb.round_robin(branches(spark, sf), "branch", lex.BRANCHES, [F.desc("c_acctbal"), F.desc(F.lower("name")), F.col("id")], -F.col("c_acctbal")).select("id", "branch", "turn", "group_order")


@query(_BRANCH + " select branch, count(*) as n from b group by 1")
def branch_counts(spark, sf):
    return branches(spark, sf).groupBy("branch").agg(F.count("*").alias("n"))


_A = "a as (select o_custkey as id, max(o_orderpriority) as label, max(o_totalprice) as confidence, list_sort(list_distinct(list(o_orderstatus))) as tags from orders where o_orderkey % 3 <> 0 group by 1)"
_B = "b as (select o_custkey as id, min(o_orderpriority) as label, max(o_totalprice) as confidence, list_sort(list_distinct(list(o_orderpriority))) as tags from orders where o_orderkey % 3 = 0 group by 1)"


@query(f"with {_A}, {_B} select a.id, coalesce(a.label, b.label) as label, list_sort(list_distinct(list_concat(a.tags, b.tags))) as tags, greatest(a.confidence, b.confidence) as confidence from a join b using (id)")
def merge_pairs(spark, sf):
    o = table(spark, sf, "orders")
    a = o.where("o_orderkey % 3 <> 0").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderpriority").alias("label"), F.max("o_totalprice").alias("confidence"), F.array_sort(F.collect_set("o_orderstatus")).alias("tags"))
    b = o.where("o_orderkey % 3 = 0").groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderpriority").alias("label"), F.max("o_totalprice").alias("confidence"), F.array_sort(F.collect_set("o_orderpriority")).alias("tags"))
    return a.alias("a").join(b.alias("b"), F.col("a.id") == F.col("b.id")).select(F.col("a.id").alias("id"), *tb.merged("a", "b", ["label"], ["tags"], ["confidence"]))


_OLD, _NEW = "select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey % 2 = 0", "select o_orderkey, o_custkey, o_totalprice + 1 as o_totalprice from orders where o_orderkey % 3 = 0"


def old_new(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)


_WHOLE = "with o as (select o_orderkey as k, o_totalprice as v from orders), n as (select l_orderkey + 3 as k, max(l_extendedprice) as v from lineitem group by 1) "


def whole_sides(spark, sf):
    """All orders, and all orders of line items under keys of which some are an order's."""
    old = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    return old, table(spark, sf, "lineitem").groupBy((F.col("l_orderkey") + 3).alias("k")).agg(F.max("l_extendedprice").alias("v"))


@query(_WHOLE + "select * from o union all select * from n where k not in (select k from o)")
def append_whole(spark, sf):
    """K3, J14 over whole sides."""
    return tb.append_unique(*whole_sides(spark, sf), ["k"])


@query(_WHOLE + "select * from o where k not in (select k from n) union all select * from n")
def upsert_whole(spark, sf):
    """K1, K5 over whole sides."""
    return tb.upsert(*whole_sides(spark, sf), "k")


@query(f"with o as ({_OLD}), n as ({_NEW}) select * from o union all select * from n where o_orderkey not in (select o_orderkey from o)")
def append_unique(spark, sf):
    return tb.append_unique(*old_new(spark, sf), ["o_orderkey"])


@query(f"with o as ({_OLD}), n as ({_NEW}) select * from o where o_orderkey not in (select o_orderkey from n) union all select n.o_orderkey, n.o_custkey, coalesce(o.o_totalprice, n.o_totalprice) from n left join o using (o_orderkey)")
def upsert_keep_first(spark, sf):
    return tb.upsert(*old_new(spark, sf), "o_orderkey", ["o_totalprice"])


@query("with p as (select distinct o_orderkey from orders where o_orderkey % 5 = 0) select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey not in (select o_orderkey from p) union all select l_orderkey, l_linenumber, l_quantity * 2 from lineitem where l_orderkey in (select o_orderkey from p) and l_linenumber = 1")
def replace_children(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    parents = table(spark, sf, "orders").where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    fresh = items.where("l_linenumber = 1").join(parents.distinct(), "l_orderkey", "left_semi").withColumn("l_quantity", F.col("l_quantity") * 2)
    return tb.replace_children(items, fresh, "l_orderkey", parents)


@query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')")
def anti_delete(spark, sf):
    listed = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return tb.delete_unlisted(table(spark, sf, "customer").select("c_custkey", "c_name"), listed, "c_custkey")


@query("select l_partkey, round(avg(l_quantity) + 1e-9::double, 2) as mean_rating, count(*) as ratings from lineitem group by 1")
def rating_summary(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.round(F.avg("l_quantity") + 1e-9, 2).alias("mean_rating"), F.count("*").alias("ratings"))


@query("select o_orderkey, l_linenumber, l_extendedprice from (select l_orderkey as o_orderkey, l_linenumber, l_extendedprice, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber) as p from lineitem) where p <= 4")
def evidence_topk(spark, sf):
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber"))
    return table(spark, sf, "lineitem").withColumn("p", place).where("p <= 4").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_extendedprice")


# Pages ---------------------------------------------------------------------------------------------------------------

_TEXT = r"trim(regexp_replace({x}, '[ \t\r\n\f]+', ' ', 'g'))"
_UNESCAPE = "replace(replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"


@query("select page_id, coalesce(nullif(" + _TEXT.format(x=_UNESCAPE.format(x="regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")) + ", ''), nullif(" + _TEXT.format(x=_UNESCAPE.format(x="regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")) + ", '')) as title from pages")
def page_titles(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.title(F.col("html")).alias("title"))


@query("select page_id, " + _TEXT.format(x=_UNESCAPE.format(x="regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript|svg)[^>]*>.*?</(script|style|noscript|svg)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')")) + " as text from pages")
def page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.visible_text(F.col("html")).alias("text"))


@query("""select page_id, href, position::int as position from (select page_id, unnest(l) as href, unnest(range(len(l))) as position from (select page_id, regexp_extract_all(html, '(?i)<a[^>]*href="([^"]*)"', 1) as l from pages))""")
def page_links(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.posexplode(tx.hrefs(F.col("html"))).alias("position", "href")).select("page_id", "href", "position")


@query("select lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) as domain, count(*) as n from pages group by 1")
def page_domains(spark, sf):
    return table(spark, sf, "pages").groupBy(tx.domain(F.col("url")).alias("domain")).agg(F.count("*").alias("n"))


@query("select url, page_id from pages qualify row_number() over (partition by url order by page_id desc) = 1")
def source_page_upsert(spark, sf):
    return tb.keep_first(table(spark, sf, "pages").select("url", "page_id"), [F.col("url")], [F.desc("page_id")])


@query(r"select page_id, len(regexp_extract_all(html, '(?i)<li')) >= 3 or regexp_matches(lower(html), '\b(?:top|best)\s+[0-9]+') as is_list from pages")
def list_page_flag(spark, sf):
    return table(spark, sf, "pages").select("page_id", ((F.regexp_count("html", F.lit("(?i)<li")) >= 3) | F.lower("html").rlike(r"\b(?:top|best)\s+[0-9]+")).alias("is_list"))


_TITLE = "coalesce(nullif(" + _TEXT.format(x=_UNESCAPE.format(x="regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")) + ", ''), nullif(" + _TEXT.format(x=_UNESCAPE.format(x="regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")) + ", ''))"
_VISIBLE = _TEXT.format(x=_UNESCAPE.format(x="regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript|svg)[^>]*>.*?</(script|style|noscript|svg)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"))


@query(rf"""with p as (select page_id, coalesce(url, '') as url, coalesce({_TITLE}, '') as title, coalesce({_VISIBLE}, '') as text from pages),
h as (select *, lower(trim(regexp_replace(title || ' ' || substr(text, 1, 3000) || ' ' || url, '\s+', ' ', 'g'))) as hay from p)
select page_id, hay <> '' and ({" or ".join(f"contains(hay, '{t}')" for t in lex.ARTICLE_TERMS)} or regexp_matches(hay, '\b(?:top|best)\s+[0-9]{{1,3}}\b') or len(regexp_extract_all(substr(text, 1, 8000), '\b[0-9]{{1,2}}\.\s+[A-Z]')) >= 3) as is_source_page from h""")
def source_page_flag(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.source_page(tx.title(F.col("html")), tx.visible_text(F.col("html")), F.col("url")).alias("is_source_page"))


@query("select case when p_retailprice = 0 then 'free' when p_retailprice <= 300 then 'budget' when p_retailprice <= 1200 then 'mid' when p_retailprice <= 3000 then 'premium' else 'luxury' end as price_level, count(*) as n from part group by 1")
def price_levels(spark, sf):
    return table(spark, sf, "part").groupBy(tx.price_level(F.col("p_retailprice")).alias("price_level")).agg(F.count("*").alias("n"))


# More reports and merges ---------------------------------------------------------------------------------------------


@query(ENTITIES + "select category, count(*) as n, round(100 * count(*) / 5000::double, 2) as percent from e group by 1")
def bulk_report(spark, sf):
    return entities(spark, sf).groupBy("category").agg(F.count("*").alias("n"), F.round(100 * F.count("*") / F.lit(5000.0), 2).alias("percent"))


@query(" union all ".join(f"select '{t}' as table_name, count(*) as n from {t}" for t in ("customer", "orders", "lineitem", "part", "events", "pages")))
def table_counts(spark, sf):
    counts = [table(spark, sf, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t in ("customer", "orders", "lineitem", "part", "events", "pages")]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("select o_custkey, list_sort(list_distinct(list(o_orderpriority))) as priorities, count(distinct o_orderpriority) as distinct_priorities, count(*) as records from orders group by 1")
def source_counts(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"), F.count_distinct("o_orderpriority").alias("distinct_priorities"), F.count("*").alias("records"))


@query("select p_brand, min(p_retailprice) as low, max(p_retailprice) as high, list_sort(list(p_partkey))[1:10] as first_parts from part group by 1")
def observed_prices(spark, sf):
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    p = table(spark, sf, "part").withColumn("place", place)
    return p.groupBy("p_brand").agg(F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high"), F.array_sort(F.collect_list(F.when(F.col("place") <= 10, F.col("p_partkey")))).alias("first_parts"))


@query("with v as (select l_orderkey, arg_max(l_returnflag, struct_pack(p := l_extendedprice, n := -l_linenumber)) as flag, max(l_extendedprice) as confidence, count(*) as records from lineitem group by 1) select o_orderkey, coalesce(case when o_orderkey % 2 = 0 then null else o_orderstatus end, flag) as status, coalesce(confidence, 0) as confidence, coalesce(records, 0)::bigint as records from orders left join v on o_orderkey = l_orderkey")
def evidence_merge(spark, sf):
    """The best evidence fills what is missing; all of it is counted."""
    best = F.max_by("l_returnflag", F.struct("l_extendedprice", -F.col("l_linenumber"))).alias("flag")
    v = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(best, F.max("l_extendedprice").alias("confidence"), F.count("*").alias("records"))
    known = F.when(F.col("o_orderkey") % 2 != 0, F.col("o_orderstatus"))
    return table(spark, sf, "orders").join(v, "o_orderkey", "left").select("o_orderkey", F.coalesce(known, "flag").alias("status"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("records", F.lit(0).cast("bigint")).alias("records"))


@query("select lower(url) as key, min(page_id) as page_id from pages group by 1 order by 2 limit 12")
def search_union(spark, sf):
    return table(spark, sf, "pages").groupBy(F.lower("url").alias("key")).agg(F.min("page_id").alias("page_id")).orderBy("page_id").limit(12)


@query("select l_orderkey, l_linenumber, round(0.35::double + 0.4::double * l_discount * 10 + case when l_returnflag = 'R' then 0.25::double else 0 end - case when l_linestatus = 'F' then 0.4::double else 0 end, 3) as score from lineitem where round(0.35::double + 0.4::double * l_discount * 10 + case when l_returnflag = 'R' then 0.25::double else 0 end - case when l_linestatus = 'F' then 0.4::double else 0 end, 3) >= 0.45 qualify row_number() over (partition by l_orderkey order by score desc, l_linenumber) <= 4")
def image_top4(spark, sf):
    score = F.round(0.35 + 0.4 * F.col("l_discount") * 10 + F.when(F.col("l_returnflag") == "R", 0.25).otherwise(0.0) - F.when(F.col("l_linestatus") == "F", 0.4).otherwise(0.0), 3)
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("score"), "l_linenumber"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", score.alias("score")).where("score >= 0.45").withColumn("place", place).where("place <= 4").drop("place")


@query(ENTITIES + "select id, coalesce(map {'building': 'build', 'automobile': 'network', 'household': 'date'}[category], 'explore') as branch from e")
def branch_map(spark, sf):
    known = F.create_map(*[F.lit(x) for x in ("building", "build", "automobile", "network", "household", "date")])
    return entities(spark, sf).select("id", F.coalesce(known[F.col("category")], F.lit("explore")).alias("branch"))


@query(ENTITIES + "select id, coalesce(length(address) between 12 and 220 and regexp_matches(lower(address), '[0-9]') and regexp_matches(lower(address), '\\b(?:road|street|lane|nagar|colony)\\b'), false) as valid from e")
def address_valid(spark, sf):
    a = F.lower("address")
    return entities(spark, sf).select("id", F.coalesce(F.length("address").between(12, 220) & a.rlike("[0-9]") & a.rlike(r"\b(?:road|street|lane|nagar|colony)\b"), F.lit(False)).alias("valid"))


@query()
def fuzzy_resolve(spark, sf):
    """All suppliers against all customers; similarity of names has no SQL form."""
    from waymark.operators.resolve import best_matches

    incoming, known = resolvable(spark, sf, "supplier", "s_suppkey", "s_nationkey"), resolvable(spark, sf, "customer", "c_custkey", "c_nationkey")
    return best_matches(incoming, known, one_table=False)


from waymark.plans import survey  # noqa: E402, F401  registers the queries of the remaining operators

__all__ = ["QUERIES", "SQL"]
