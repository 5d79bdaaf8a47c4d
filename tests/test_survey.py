"""Operators of the engine against plain Python on fixtures worked out by hand, restarts of its tables, and a run from pages to served tables."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from waymark.engine import Engine, Settings, as_entities
from waymark.functions import documents, names, pages
from waymark.functions import text as tx
from waymark.operators import extract, publish, quality, refine, resolve, tables
from waymark.streaming.batches import Versions, crawl, first_frontier, seeded, stream_upserts

CANDIDATE = (
    "name string, category string, primary_category string, locality string, address string, latitude double, longitude double, website string, has_contact boolean, has_social boolean, has_media boolean, event_known boolean, "
    "community_known boolean, source_names array<string>, source_types array<string>, geo_precision string, status string"
)


def candidate(name, category="place", locality=None, address=None, lat=None, lon=None, website=None, media=False, event=False, sources=("web_page",), types=("webpage",), precision=None):
    return (name, category, None, locality, address, lat, lon, website, False, False, media, event, False, list(sources), list(types), precision, "ACTIVE")


def column(spark, values, f, kind="string"):
    """f over one column, in the order of values."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_folding_is_that_of_the_unicode_tables(spark):
    rng = random.Random(1)
    texts = ["Café Nirvana", "ﬁn ½ Ⅳ №5", "Ｆｕｌｌ", "𝐀𝐛", "日本 é", "ß", "", None] + ["".join(chr(rng.choice([rng.randrange(32, 0x2FF), rng.randrange(0x1E00, 0x3300), rng.randrange(0xFB00, 0xFFEF)])) for _ in range(20)) for _ in range(80)]
    want = [None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert column(spark, texts, names.folded) == want
    assert column(spark, ["Café  Nirvana!", None, "ÀB-c"], tx.plain) == ["cafe nirvana", "", "ab c"]


def test_ids_are_those_of_the_rounded_numbers(spark):
    import hashlib

    row = spark.sql("select 'Café Nirvana' as n, 'Begumpet' as l, 17.4D as a, 78.46651D as o").select(tx.entity_id(F.col("n"), F.col("l"), F.col("a"), F.col("o"))).collect()[0][0]
    assert row == "cafe-nirvana-" + hashlib.sha1(b"cafe nirvana|begumpet|17.4:78.4665").hexdigest()[:12]


def test_decisions_worked_out_by_hand(spark):
    rows = [
        (candidate("Lotus Lake Park", "park", "Begumpet", "1 Lake Road", 17.4, 78.4, "w", True), "serve", 1.0, None),
        (candidate("ab"), "reject_page_fragment", 0.0, "empty_or_short_name"),
        (candidate("Main", "bank"), "reject_page_fragment", 0.12, "non_card_map_infrastructure"),
        (candidate("Where to go"), "reject_page_fragment", 0.08, "instruction_article_or_page_furniture"),
        (candidate("Blue Cup", types=["source_page_mention"], lat=17.4, lon=78.4, precision="geocoded"), "reject_page_fragment", 0.1, "bad_fragment_geocoded_from_page_text"),
        (candidate("One two three four five six seven", types=["source_page_mention"]), "reject_page_fragment", 0.2, "sentence_like_page_mention_without_location"),
        (candidate("Events in Hyderabad"), "reject_page_fragment", 0.16, "collection_or_search_result_heading"),
        (candidate("AI Labs", "business"), "reject_page_fragment", 0.18, "abstract_topic_not_entity"),
        (candidate("Hackathon"), "reject_page_fragment", 0.18, "generic_event_or_topic_name"),
        (candidate("Green Cafe"), "serve" if False else "needs_enrichment", 0.75, "real_entity_name_hint"),  # 0.45 + 0.3, no strong identity
        (candidate("Green Cafe", locality="Alwal"), "serve", 1.0, "real_entity_name_hint"),  # 0.45 + 0.3 + 0.26 + 0.12
        (candidate("Blue Cup", "web_entity", types=["source_page_mention"]), "reject_page_fragment", 0.21, "single_source_page_mention"),  # 0.45 - 0.24
        (candidate("Nirvana"), "reject_page_fragment", 0.27, "single_generic_token"),  # 0.45 - 0.18
        (candidate("Blue Cup", "cafe", sources=["wikidata"]), "serve", 1.0, "strong_identity_evidence"),  # 0.45 + 0.26 + 0.08 + 0.25, over 1
    ]
    got = refine.decided(spark.createDataFrame([r[0] for r in rows], CANDIDATE)).collect()
    by_name = {(r.name, r.locality, tuple(r.source_names), tuple(r.source_types), r.category): r for r in got}
    for c, decision, score, reason in rows:
        r = by_name[c[0], c[3], tuple(c[13]), tuple(c[14]), c[1]]
        assert (r.decision, r.decision_score) == (decision, score), c[0]
        assert reason is None or r.decision_reasons[0] == reason, c[0]


def test_refinement_cleans_geocodes_and_decides_again(spark):
    rows = [
        (1, *candidate("1. Green Cafe | Hyderabad", "cafe", "Alwal")),
        (2, *candidate("Old Fort", "place", address="somewhere else", lat=17.4, lon=78.4, precision="source_page_coordinates")),
        (3, *candidate("What to do")),
    ]
    answers = spark.createDataFrame([(1, 17.5, 78.5, "Uppal", "5 Main Road, Hyderabad"), (3, 17.5, 78.5, None, "x Hyderabad")], "id int, latitude double, longitude double, locality string, address string")
    got = {r.id: r for r in refine.refined(spark.createDataFrame(rows, "id int, " + CANDIDATE), answers).collect()}
    assert (got[1].name, got[1].latitude, got[1].locality, got[1].address, got[1].status, got[1].geo_precision) == ("Green Cafe", 17.5, "Alwal", "5 Main Road, Hyderabad", "ACTIVE", "geocoded")
    assert (got[2].address, got[2].latitude, got[2].geo_precision, got[2].status) == (None, None, "unresolved", "NEEDS_ENRICHMENT")
    assert (got[3].status, got[3].latitude, got[3].review_reason) == ("REJECTED_PAGE_FRAGMENT", None, "instruction_article_or_page_furniture")


def test_urls_join_as_the_standard_says(spark):
    from urllib.parse import urljoin

    base = "https://a.example:8080/b/c/d.html?q=1#f"
    hrefs = ["/x", "x", "../x", "../../x", "./x/./y", "//h.example/p", "?a=b", "#z", "", "http://o.example/q", "mailto:a@b.org", "x/../y?k=../z", "..", ".", "g;x=1/./y", "../../../x"]
    got = column(spark, hrefs, lambda c: names.joined_url(F.lit(base), c))
    assert got == [urljoin(base, h) for h in hrefs]


def test_links_of_pages(spark):
    html = '<a class="k" href="/events/x">The <b>Events</b></a><a href="https://instagram.com/me">me</a><a href=\'mailto:a@b.org\'>events</a><a href="https://far.example/cafe">cafe</a><a href="/login?cafe">cafe</a>'
    df = spark.createDataFrame([("http://h.example/a/b", html)], "url string, html string").withColumn("l", pages.links(F.col("html"), F.col("url")))
    r = df.select("l", pages.followed(F.col("l"), F.col("url")).alias("f"), pages.social_links(F.col("l")).alias("s")).collect()[0]
    assert [(x.href, x.label) for x in r.l][:2] == [("http://h.example/events/x", "The Events"), ("https://instagram.com/me", "me")]
    assert [x.href for x in r.f] == ["http://h.example/events/x"] and r.s == ["instagram=https://instagram.com/me"]


def test_linked_data_in_every_form(spark):
    html = (
        '<script type="application/ld+json">[{"@type":"Cafe","name":"A","image":["u1","u2"],"openingHours":["Mo 9-5","Tu 9-5"],"sameAs":"https://www.instagram.com/a","servesCuisine":["thai","asian"],"aggregateRating":{"ratingValue":"4.5","reviewCount":"1,200"}},'
        '{"name":"B","image":{"url":"u3"},"address":"1 Lake Road, Begumpet","openingHours":"daily","priceRange":"₹₹","servesCuisine":"thai","geo":{"latitude":"17.4","longitude":78.4}}]</script>'
    )
    got = {r.name: r for r in extract.linked_entities(spark.createDataFrame([(1, "http://p", html)], "page_id long, url string, html string")).collect()}
    a, b = got["A"], got["B"]
    assert (a.image_urls, a.opening_hours, a.social, a.cuisines, a.rating, a.rating_count, a.url, a.category) == (["u1", "u2"], "Mo 9-5; Tu 9-5", ["instagram=https://www.instagram.com/a"], ["thai", "asian"], 4.5, 1200, "http://p", "Cafe")
    assert (b.image_urls, b.address, b.locality, b.opening_hours, b.price, b.cuisines, b.latitude, b.category) == (["u3"], "1 Lake Road, Begumpet", "Begumpet", "daily", "₹₹", ["thai"], 17.4, "web_entity")


def test_pages_take_their_routes(spark):
    fill = "x " * 300
    rows = [
        (1, "http://a/", "<title>Blue Cup</title>" + fill, "skip"), (2, "http://a/", "<title>Blue Cup</title>short hyderabad", "rerender"), (3, "http://a/", f"<title>Blue Cup</title>{fill} hyderabad", "page"),
        (4, "http://a/", f"<title>Best cafes</title>{fill} hyderabad\n<h2>Hidden Leaf Cafe</h2>", "mentions"), (5, "http://a/", f'<script type="application/ld+json">{{"name":"A B"}}</script><title>Blue Cup</title>{fill} hyderabad', "linked"), (6, "http://a/", f"{fill} hyderabad", "none"),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    assert {r.page_id: r.route for r in extract.routed(df).collect()} == {r[0]: r[3] for r in rows}
    got = {(r.page_id, r.name, r["mode"]) for r in extract.page_entities(df).collect()}
    assert got == {(3, "Blue Cup", "page"), (4, "Hidden Leaf Cafe", "mentioned_entity"), (5, "A B", "linked")}
    assert [r.value for r in extract.lookups(extract.page_entities(df)).orderBy("page_id").collect()] == ["Blue Cup Hyderabad", "Hidden Leaf Cafe Hyderabad", "A B Hyderabad"]


def test_relations_and_unique_media(spark):
    df = spark.createDataFrame([(1, "between Madhapur and Hitec City", "madhapur", ["quiet", "date", "quiet"]), (2, "in Abids", None, [])], "id int, text string, locality string, intent_tags array<string>")
    assert sorted((r.id, r.predicate, r.object, r.confidence) for r in extract.relations(df).collect()) == [(1, "near", "hitec_city", 0.35), (1, "recommended_for", "date", 0.5), (1, "recommended_for", "quiet", 0.5)]
    got = column(spark, [["U1", "u2", "u1"]], extract.media_unique, "array<string>")[0]
    assert [(m.url, m.is_primary) for m in got] == [("U1", True), ("u2", False)]


def test_evidence_windows(spark):
    text = "A line\n  \nThe Blue Cup is here\n" + "y" * 900
    df = spark.createDataFrame([(text, "blue cup"), ("a Blue\nCup b", "Blue\nCup"), ("none", "x"), ("", "x")], "t string, n string")
    assert [r[0] for r in df.select(tx.evidence_window(F.col("t"), F.col("n"))).collect()] == ["The Blue Cup is here", "a Blue Cup b", "", ""]


def test_documents_keep_what_entities_have(spark):
    rows = [("Blue Cup", "cafe", None, None, None, None, None, None, "Rated 4.5/5 by 2,310 reviews. A quiet lake in Madhapur. Rs. 300.", 3.0, ["x"], {"quiet": 0.9, "odd": 0.1}, "late")]
    e = spark.createDataFrame(rows, "name string, category string, description string, locality string, address string, latitude double, longitude double, website string, text string, rating double, intent_tags array<string>, suitability_scores map<string,double>, price_level string")
    r = documents.enriched(e).collect()[0]
    assert (r.rating, r.rating_count, r.locality, r.price_level, r.price_max) == (3.0, 2310, "Madhapur", "late", 300)
    assert r.intent_tags == ["quiet", "walking", "x"] and r.suitability_scores["quiet"] == 0.9 and r.suitability_scores["odd"] == 0.1 and r.suitability_scores["walking"] == 0.5
    empty = documents.enriched(e.withColumn("text", F.lit(None).cast("string"))).collect()[0]
    assert empty.rating == 3.0 and empty.emails == [] and empty.summary is None and documents.enriched(e.limit(0)).count() == 0


def test_caps_and_first_results(spark):
    rows = spark.createDataFrame([(i, ["q"] * n) for i, n in enumerate([2, 0, 3, 1, 5, 1])], "id int, queries array<string>")
    assert [r.id for r in tables.capped(rows, F.size("queries"), 5).orderBy("id").collect()] == [0, 2] and [r.id for r in tables.capped(rows, F.size("queries"), 7).orderBy("id").collect()] == [0, 2, 3, 4]
    hits = spark.createDataFrame([(1, q, p, u, t) for q, p, u, t in [(0, 0, "U", "a"), (0, 1, "u", "b"), (0, 2, None, "T"), (1, 0, "", "t"), (1, 1, "v", ""), (2, 0, "w", "")]], "id int, query_no int, pos int, url string, title string")
    assert sorted((r.query_no, r.pos) for r in tables.first_results(hits, 3).collect()) == [(0, 0), (0, 2), (1, 1)] and tables.first_results(hits, 12).count() == 4
    maps = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3"}), (None, {"c": "4"})], "l map<string,string>, r map<string,string>")
    assert [r[0] for r in maps.select(tables.map_merge(F.col("l"), F.col("r"))).collect()] == [{"a": "1", "b": "3"}, {"c": "4"}]
    assert maps.select(tables.map_merge(F.col("l"), F.col("r"), False)).collect()[0][0] == {"a": "1", "b": "2"}


def test_best_matches_equal_brute_force_at_any_latitude(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["Blue Cup", "Blue Cups", "Red Fort", "Blué Cup"]), rng.choice([["Cup Blue"], None, ["Red Forts", "x"]]), rng.choice(["1 Lake Road", None]), rng.choice([None, "https://x.example", "https://X.example"]), rng.choice([17.4, 60.0]) + rng.random() / 50, 78.4 + rng.random() / 25) for i in range(70)]
    rows += [(200 + i, "Same", None, "s", None, 50.0, 1.0) for i in range(4)] + [(300, None, None, None, "https://x.example", None, None), (301, "", None, None, "", None, 3.0)]
    d = spark.createDataFrame(rows, "id long, name string, aliases array<string>, address string, website string, latitude double, longitude double")
    every = resolve.similar(d.select(F.struct(*d.columns).alias("a")).crossJoin(d.select(F.struct(*d.columns).alias("b")))).where(F.col("score") >= resolve.MATCH)
    want = {}
    for r in every.select("a.id", F.col("b.id").alias("known"), F.round("score", 6).alias("score")).where("id <> known").collect():
        want[r.id] = min(want.get(r.id, (0, 0)), (-r.score, r.known))
    assert {r.incoming_id: (-r.score, r.known_id) for r in resolve.best_matches(d, d).collect()} == want != {}
    assert resolve.best_matches(d.limit(0), d).count() == 0


def test_versions_and_streams_survive_a_restart(spark, tmp_path):
    """Rows of a first run stay when a second run, with new objects, goes on; a batch that is played again changes nothing."""
    def land(rows, i):
        spark.createDataFrame(rows, "k long, v string, ts long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run(checkpoint):
        table = Versions(spark, f"file://{tmp_path}/t")
        stream = spark.readStream.schema("k long, v string, ts long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        stream_upserts(stream, table, "k", f"{tmp_path}/{checkpoint}").awaitTermination()
        return {r.k: r.v for r in Versions(spark, f"file://{tmp_path}/t").read().collect()}

    land([(1, "a", 1), (2, "b", 1)], 0)
    assert run("c") == {1: "a", 2: "b"}
    land([(3, "c", 1), (2, "B", 2)], 1)
    assert run("c") == {1: "a", 2: "B", 3: "c"} and run("c") == {1: "a", 2: "B", 3: "c"}
    assert run("lost-checkpoint") == {1: "a", 2: "B", 3: "c"}  # all batches are played again, over versions of their numbers
    v = Versions(spark, f"file://{tmp_path}/v")
    assert v.at == 0
    for n in (1, 2, 3):
        v.write(spark.range(n))
    (tmp_path / "v" / "v=000003" / "_SUCCESS").unlink()
    again = Versions(spark, f"file://{tmp_path}/v")
    assert again.at == 2 and again.read().count() == 2
    again.drop_before(1)
    assert again.numbers() == [2]


def test_crawl_numbers_children_apart_and_takes_gaps(spark, tmp_path):
    """Children of many parents have numbers of their own; visited keys are known to later runs; entities' gaps join the queue."""
    schema = "kind string, source string, value string, priority double, depth int, retry_count int, seq long"
    frontier = Versions(spark, f"file://{tmp_path}/f")
    frontier.write(spark.createDataFrame([("query", "s", f"A{i}", 0.9, 0, 0, i) for i in (1, 2)] + [("source_url", "s", "bad", 0.8, 0, 1, 3)], schema))
    child = F.transform(F.sequence(F.lit(0), F.lit(1500)), lambda i: F.struct(F.lit("source_url").alias("kind"), F.concat("value", F.lit("/"), i.cast("string")).alias("value"), F.lit("s").alias("source"), F.lit(0.4).alias("priority")))
    visit = lambda b: b.withColumn("outcome", F.when(F.col("value") == "bad", "failed").otherwise("done")).withColumn("children", child)
    gaps = lambda r: r.where("value = 'A1'").selectExpr("'query' as kind", "'openstreetmap' as source", "'A1 address' as value", "0.9D as priority")
    rows = crawl(frontier, visit, 10, 1, gaps=gaps).collect()
    assert len(rows) == 3003 == len({r.seq for r in rows}) and {r.value for r in rows if r.depth == 0} == {"A1 address"}
    assert [r.value for r in Versions(spark, f"file://{tmp_path}/f-failed").read().collect()] == ["bad"]
    back = lambda b: b.withColumn("outcome", F.lit("done")).withColumn("children", F.array(F.struct(F.lit("query").alias("kind"), F.lit("a1").alias("value"), F.lit("s").alias("source"), F.lit(0.9).alias("priority"))))
    later = crawl(Versions(spark, f"file://{tmp_path}/f"), back, 5, 1).collect()
    assert len(later) == 2998 and "a1" not in {r.value for r in later}


def test_seeds_join_a_frontier_once(spark):
    first = first_frontier(spark)
    assert first.count() == 26 and seeded(first, first).count() == 26
    more = spark.createDataFrame([("query", "openstreetmap", "FOOD", 0.5, 0, 0, 1), ("query", "openstreetmap", "zoos", 0.5, 0, 0, 2)], first.schema)
    assert {r.value for r in seeded(first, more).collect()} - {r.value for r in first.collect()} == {"zoos"}


def test_served_keys_and_ratings(spark):
    df = spark.createDataFrame([("The Golkonda Fort, Hyderabad", 17.40004, 78.4), ("golconda  fort", None, None)], "n string, a double, o double")
    assert [r[0] for r in df.select(publish.serving_key(F.col("n"), F.col("a"), F.col("o"))).collect()] == ["golconda fort|17.4:78.4", "golconda fort"]
    assert quality.recommendable(F.lit("x"), F.lit("y")) is not None


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    """From pages and map elements to refined entities."""
    e = Engine(spark, f"file://{tmp_path_factory.mktemp('engine')}", Settings(target_ready=5, batch=10))
    fill = "A quiet lake with a walking trail, good for a walk in the evening; people say that it is calm and peaceful in Begumpet, Hyderabad! " * 5
    linked = '<script type="application/ld+json">{"@type":"park","name":"Lotus Lake Park","description":"a quiet lake","address":{"streetAddress":"1 Lake Road","addressLocality":"Begumpet","addressRegion":"Hyderabad"},"geo":{"latitude":17.4449,"longitude":78.4666}}</script>'
    html = [(1, "http://a.example/p", f"{linked}<title>Lotus Lake Park</title><p>{fill}</p>"), (2, "http://b.example/best", f"<title>Best cafes</title><p>{fill}</p><h2>Hidden Leaf Cafe</h2><h2>Read more</h2>")]
    found = extract.page_entities(spark.createDataFrame(html, "page_id long, url string, html string")).withColumns({
        "text": F.lit(fill), "confidence": F.lit(0.6), "sources": F.expr("array(named_struct('source', 'web_page', 'url', website, 'source_type', if(mode = 'mentioned_entity', 'source_page_mention', 'webpage'), 'raw_path', cast(null as string), 'extraction_confidence', 0.5D))"),
        "media": F.expr("if(mode = 'linked', array(named_struct('id', 'i1', 'url', 'http://img/1', 'source', 'web_page', 'caption', name, 'labels', array('a'), 'is_primary', true)), null)"), "extraction_mode": F.col("mode"),
    })
    e.add(found)
    e.add(spark.createDataFrame([("x-1", "Old Fort", "attraction", "Madhapur", "2 Fort Road, Hyderabad", 17.5, 78.3, 0.8)], "id string, name string, category string, locality string, address string, latitude double, longitude double, confidence double").withColumns({
        "text": F.lit("an old fort"), "sources": F.expr("array(named_struct('source', 'openstreetmap', 'url', 'u', 'source_type', 'open_data', 'raw_path', 'r', 'extraction_confidence', 0.9D))"),
    }))
    e.refine(spark.createDataFrame([("r1", "x-1", "quiet and good")], "id string, entity_id string, text string"))
    return e


def test_engine_refines_validates_and_reports(spark, engine):
    rows = {r.name: r for r in engine.rows("refined").collect()}
    assert set(rows) == {"Lotus Lake Park", "Hidden Leaf Cafe", "Old Fort"}
    assert (rows["Lotus Lake Park"].status, rows["Old Fort"].status) == ("ACTIVE", "ACTIVE") and rows["Hidden Leaf Cafe"].status == "NEEDS_ENRICHMENT"
    assert "quiet" in rows["Old Fort"].intent_tags  # from its review
    ready = {r.name: (r.production_ready, r.missing) for r in engine.validate().collect()}
    assert ready["Lotus Lake Park"] == (True, []) and ready["Old Fort"] == (False, ["image"]) and not ready["Hidden Leaf Cafe"][0]
    assert [r.name for r in engine.image_candidates().collect()] == ["Old Fort"]
    assert {r.id for r in engine.enrichment_candidates().collect()} == {rows["Old Fort"].id, rows["Hidden Leaf Cafe"].id}
    assert engine.coverage()["category"] == [("attraction", 1), ("park", 1), ("restaurant", 1)] and engine.sources().count() == 21
    assert {r.branch for r in engine.normalize_branches().collect()} == {"explore", "date"}
    assert engine.rows("signals").count() > 0 and engine.rows("relations").where("predicate = 'near'").count() >= 0
    assert as_entities(spark.createDataFrame([("1",)], "id string")).collect()[0].media == []


def test_engine_publishes_and_searches(spark, engine):
    images = spark.createDataFrame([("http://img/1", "image/png", 5, "h")], "url string, mime_type string, byte_size long, content_hash string")
    pages_ = spark.createDataFrame([("http://a.example/p", "t", None, "web_page", "entity_page", "r", False, None, None)], "url string, title string, description string, source string, source_type string, raw_path string, is_source_page boolean, search_query string, search_rank int")
    reviews = spark.createDataFrame([("r1", "x-1", "web", 4.0, "quiet", "positive", 1.0, ["a"])], "id string, entity_id string, source string, rating double, text string, sentiment string, sentiment_score double, topics array<string>")
    first = engine.publish(reviews, pages_, images)
    counts = {name: engine.published(name).count() for name in publish.SCHEMAS}
    assert counts["entities_raw"] == 3 == counts["entity_quality"] and counts["city_entities"] == 1 == counts["entity_media"] and counts["entity_reviews"] == 0 and counts["source_pages"] == 1
    assert counts["entity_intents"] > 2 and engine.published("city_entities").collect()[0].primary_image_id.endswith(":i1")
    assert engine.publish(reviews, pages_, images) != first
    card = engine.search("quiet places to walk near Begumpet").collect()
    assert [(c.name, c.distance_km) for c in card] == [("Lotus Lake Park", 0.02)] and {"quiet", "walk", "begumpet"} <= set(card[0].matched_terms) and "quiet" in card[0].moods


def test_engine_starts_and_goes_on_after_a_restart(spark, tmp_path):
    a = Engine(spark, f"file://{tmp_path}", Settings(batch=3))
    assert a.init().count() == 26 and a.init().count() == 26
    none = F.array().cast("array<struct<kind: string, value: string, source: string, priority: double>>")
    visit = lambda b: b.withColumn("outcome", F.lit("done")).withColumn("children", none)
    assert a.run(visit, 2).count() == 20 and Engine(spark, f"file://{tmp_path}", Settings(batch=3)).run(visit, 1).count() == 17
    with pytest.raises(ValueError):
        a.validate()


def test_schema_of_served_tables(spark):
    publish.ensure_schema(spark, "waymark_test")
    publish.ensure_schema(spark, "waymark_test")
    assert {t.name for t in spark.catalog.listTables("waymark_test")} == set(publish.SCHEMAS)
    spark.sql("drop database waymark_test cascade")


def test_knowledge_base_and_encyclopedia_payloads(spark):
    from waymark.sources import landed

    kb = '{"entities":{"Q1":{"claims":{"P18":[{"mainsnak":{"datavalue":{"value":"a.jpg"}}},{"mainsnak":{}}],"P31":[{"mainsnak":{"datavalue":{"value":{"id":"Q5"}}}}]}}}}'
    df = spark.createDataFrame([("Q1", kb), ("Q2", "{}"), ("Q3", None)], "qid string, payload string")
    got = {r.qid: (r.a, r.b) for r in df.select("qid", landed.claim_values(F.col("payload"), F.col("qid"), "P18").alias("a"), landed.claim_values(F.col("payload"), F.col("qid"), "P31").alias("b")).collect()}
    assert got == {"Q1": (["a.jpg"], ["Q5"]), "Q2": ([], []), "Q3": ([], [])}
    pages_ = [(1, '{"query":{"pages":{"7":{"title":"Old Fort","extract":" x ","thumbnail":{"source":"u"}},"-1":{"title":"No","missing":""}}}}'), (2, '{"query":{"pages":[{"title":"B"}]}}'), (3, "{bad")]
    assert sorted((r.id, r.title, r.extract, r.image_url) for r in landed.page_summaries(spark.createDataFrame(pages_, "id int, payload string")).collect()) == [(1, "Old Fort", "x", "u"), (2, "B", None, None)]
    said = [(1, "Old Fort Gate", '{"type":"standard","title":"Old Fort","extract":"","thumbnail":{"source":"t"},"originalimage":{"source":"o"}}'), (2, "Old Fort", '{"type":"disambiguation","title":"Old Fort","thumbnail":{"source":"t"}}'), (3, "Blue Cup", '{"title":"Cup","extract":"a place in hyderabad","thumbnail":{"source":"t"}}'), (4, "Blue Cup", '{"title":"Saucer","extract":"hyderabad","thumbnail":{"source":"t"}}')]
    assert sorted((r.id, r.image_url) for r in landed.summary_images(spark.createDataFrame(said, "id int, name string, payload string")).collect()) == [(1, "o"), (3, "t")]


def test_round_robin_is_the_same_cut_at_quantiles(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("abc"), float(rng.randrange(40))) for i in range(500)] + [(900, None, 1.0), (901, "a", None)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    order = [F.desc_nulls_last("v"), F.col("id")]
    plain = {r.id: r.turn for r in tables.round_robin(df, "g", ["a", "b", "c"], order).where("g is not null and v is not null").collect()}
    got = {r.id: r.turn for r in tables.round_robin(df.where("v is not null"), "g", ["a", "b", "c"], order, -F.col("v"), 8).where("g is not null").collect()}
    assert got == plain and len(got) == 500


def test_engine_merges_web_evidence(spark, tmp_path):
    e = Engine(spark, f"file://{tmp_path}")
    e.add(spark.createDataFrame([("1", "Green Cafe", "cafe", "Alwal"), ("2", "Blue Cup", "cafe", None)], "id string, name string, category string, locality string"))
    text = "Green Cafe, Hyderabad. Address: 12 Lake Road, Alwal, Hyderabad 500010. 17.44470, 78.46650"
    found = spark.createDataFrame([("1", 1, "https://www.zomato.com/g", text), ("2", 1, "https://a.example/", "nothing of it")], "id string, position_in_search int, url string, text string")
    found = found.withColumns(refine.evidence_fields(F.col("text"))).withColumns({"latitude": F.col("position.lat"), "longitude": F.col("position.lon"), "source": names.source_name(F.col("url"))}).drop("position")
    named = found.join(e.rows("entities").select("id", "name"), "id")
    scored = named.withColumn("confidence", refine.evidence_confidence(F.col("name"), F.concat_ws(" ", "text", "url"), F.col("source"), F.lit(2))).drop("name")
    got = {r.id: r for r in e.refine(evidence=scored).collect()}
    assert (got["1"].address, got["1"].latitude, got["1"].status, got["1"].evidence_count) == ("12 Lake Road, Alwal, Hyderabad 500010", 17.4447, "ACTIVE", 1)
    assert (got["2"].address, got["2"].evidence_count) == (None, 0)


def test_names_in_scripts_without_case(spark):
    """Letters that have no case are no lower-case name; a name all in lower case is none."""
    from waymark.functions import names

    rows = [("హైదరాబాద్ కోట", True), ("حیدرآباد قلعہ", True), ("old fort gate", False), ("Old Fort Gate", True), ("123 456", False)]
    got = {r.x: r.v for r in spark.createDataFrame([(x,) for x, _ in rows], "x string").select("x", names.valid_name(F.col("x")).alias("v")).collect()}
    assert got == dict(rows)
