"""Operators on small fixtures, and queries against their SQL where the star-schema tables are at hand."""

import os

import pytest
from pyspark.sql import functions as F

from waymark.functions import text as tx
from waymark.operators import extract, quality, resolve, search, tables
from waymark.plans.queries import QUERIES, SQL
from waymark.plans.views import entities, resolvable
from waymark.sources import landed
from waymark.streaming.batches import Versions, crawl, stream_upserts

SF = "/root/testdata/sf0.001"


def test_query_is_compiled_to_terms_moods_and_centre():
    q = search.compiled("quiet places to walk near Begumpet")
    assert q.terms == ("quiet", "walk", "begumpet") and q.moods == ("good_for_walking", "quiet") and q.hint == "begumpet" and q.centre == (17.4447, 78.4665)


def test_relevance_counts_suitability_and_hints_come_from_entities(spark):
    schema = "id long, name string, category string, locality string, address string, description string, intent_tags array<string>, latitude double, longitude double, image_id string, popularity double, n_sources int, suitability_scores map<string,double>"
    rows = [(i, "Old Fort", "museum", "In Alwal", None, "quiet", tags, None, None, None, 0.0, 1, scores) for i, (tags, scores) in enumerate([(["solo", "quiet", "odd"], {"solo": 0.5, "quiet": 0.65, "other": 1.0}), (["solo"], None), (None, {"solo": 0.5})])]
    e = spark.createDataFrame(rows, schema)
    got = {r.id: r.relevance_score for r in search.cards(e, search.compiled("museum")).collect()}
    assert got == {0: 2.05, 1: 0.9, 2: 0.9}
    assert search.hinted(search.compiled("quiet museum in alwal"), e).hint == "alwal" and search.hinted(search.compiled("quiet museum"), e).hint is None
    assert search.hinted(search.compiled("alwal near begumpet for kids"), e).hint == "begumpet" and search.compiled("parks near places with kids").hint is None


def test_linked_data_and_mentions(spark):
    html = '<script type="application/ld+json">{"@graph":[{"@type":["Cafe"],"name":"Blue  Cup","address":{"streetAddress":"1 Lake Road","postalCode":"500016"},"geo":{"latitude":17.4,"longitude":78.4}}]}</script><script type="application/ld+json">{bad</script>'
    got = extract.linked_entities(spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id long, html string")).collect()
    assert [(r.name, r.category, r.address, r.latitude) for r in got] == [("Blue Cup", "Cafe", "1 Lake Road, 500016", 17.4)]
    text = "Intro\n1. Hidden Leaf Cafe\n2. Old Fort Museum\n3. Read more\nVisit **Hidden Leaf Cafe** today"
    named = extract.mentions(spark.createDataFrame([(1, text)], "page_id long, text string")).orderBy("rank").collect()
    assert [r.name for r in named] == ["Hidden Leaf Cafe", "Old Fort Museum"] and named[0].evidence == "1. Hidden Leaf Cafe"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the star-schema tables")
def test_quality_scores_stay_in_range(spark):
    assert quality.with_quality(entities(spark, SF)).where("quality_score < 0 or quality_score > 1").isEmpty()


def test_resolution_needs_near_places_or_equal_sites(spark):
    schema = "id long, name string, address string, website string, latitude double, longitude double"
    known = spark.createDataFrame([(1, "Blue Cup Cafe", "1 Lake Road", None, 17.40, 78.40), (2, "Blue Cup Cafe", None, "https://b.example", None, None), (3, "Far Cafe", None, None, 18.0, 79.0)], schema)
    new = spark.createDataFrame([(10, "Blue Cup Café", "1 Lake Road", None, 17.4003, 78.4), (11, "Blue Cup Cafe", None, "https://b.example", None, None), (13, "Blue Cup Cafe", None, "https://B.example", None, None), (12, "Blue Cup Cafe", None, None, 17.5, 78.5)], schema)
    got = {r.incoming_id: r.known_id for r in resolve.best_matches(new, known).collect()}
    assert got == {10: 1, 11: 2}


def test_blocking_loses_no_match(spark):
    import random

    rng = random.Random(3)
    rows = [(i, rng.choice(["Blue Cup", "Blue Cups", "Red Fort"]), rng.choice(["1 Lake Road", None]), rng.choice([None, "https://x.example", "https://y.example"]), 17.4 + rng.random() / 50, 78.4 + rng.random() / 50) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, name string, address string, website string, latitude double, longitude double")
    a, b = df.where("id % 2 = 0"), df.where("id % 2 = 1")
    every = a.select(F.struct(*df.columns).alias("a"), F.lit(1).alias("k")).join(b.select(F.struct(*df.columns).alias("b"), F.lit(1).alias("k")), "k").drop("k")
    pairs = lambda p: {(r.x, r.y) for r in resolve.similar(p).where(F.col("score") >= resolve.MATCH).select(F.col("a.id").alias("x"), F.col("b.id").alias("y")).collect()}
    assert pairs(every) == pairs(resolve.blocked_pairs(a, b)) != set()


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the star-schema tables")
def test_fuzzy_resolve_asks_every_supplier_of_every_customer(spark):
    a, b = (resolvable(spark, SF, *x) for x in (("supplier", "s_suppkey", "s_nationkey"), ("customer", "c_custkey", "c_nationkey")))
    assert (a.count(), b.count()) == (spark.read.parquet(f"{SF}/supplier.parquet").count(), spark.read.parquet(f"{SF}/customer.parquet").count())
    every = resolve.similar(a.select(F.struct(*a.columns).alias("a")).crossJoin(b.select(F.struct(*b.columns).alias("b")))).where(F.col("score") >= resolve.MATCH)
    want = {}
    for r in every.select("a.id", F.col("b.id").alias("known"), F.round("score", 6).alias("score")).collect():
        want[r.id] = min(want.get(r.id, (0, 0)), (-r.score, r.known))
    got = {r.incoming_id: (-r.score, r.known_id) for r in QUERIES["fuzzy_resolve"](spark, SF).collect()}
    assert got == want != {}


def test_table_operations_are_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k long, v string, first long")
    new = spark.createDataFrame([(2, "B", 99), (3, "C", 30)], "k long, v string, first long")
    once = tables.upsert(old, new, "k", ["first"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", 10), (2, "B", 20), (3, "C", 30)]
    assert sorted(map(tuple, tables.upsert(once, new, "k", ["first"]).collect())) == sorted(map(tuple, once.collect()))
    added = tables.append_unique(old, new, ["k"])
    assert sorted(map(tuple, tables.append_unique(added, new, ["k"]).collect())) == sorted(map(tuple, added.collect()))


def test_landed_payloads(spark):
    rows = [("q", '{"data":{"web":[{"url":"u1","title":" A  b"}],"news":[{"url":"u2"}]}}'), ("r", '{"items":[{"link":"u3","title":"T"}]}'), ("s", "{bad"), ("t", None)]
    got = landed.search_hits(spark.createDataFrame(rows, "query string, payload string")).orderBy("query", "rank").collect()
    assert [(r.query, r.url, r.title, r.priority) for r in got] == [("q", "u1", "A b", 0.8), ("q", "u2", "", 0.77), ("r", "u3", "T", 0.8)]
    elements = [(1, 17.4, 78.4, None, {"name": "Cup", "amenity": "cafe"}), (2, None, None, None, {"name": "Xyz", "amenity": "cafe"}), (3, 17.4, 78.4, None, {"name": "Pol", "amenity": "police"}), (4, 1.0, 1.0, None, {}), (5, 1.0, 1.0, None, {"amenity": "cafe"})]
    df = spark.createDataFrame(elements, "id long, lat double, lon double, center struct<lat: double, lon: double>, tags map<string,string>")
    assert [r.reject_reason for r in landed.map_entities(df).orderBy("element_id").collect()] == [None, "missing_coordinates", "non_serving_category", "missing_tags", "missing_name"]
    assert landed.registry(spark).count() == 21


def test_text_functions(spark):
    df = spark.createDataFrame([("Rs. 1,200 and rs 50. Rated 4.5/5 on Mar 3, 2024 at 500016 @17.44,78.46 a barber",)], "t string")
    r = df.select(tx.prices(F.col("t")).alias("p"), tx.rating(F.col("t")).alias("r"), tx.date_hint(F.col("t")).alias("d"), tx.coordinates(F.col("t")).alias("c"), tx.has_term(F.col("t"), ["bar"]).alias("b"), tx.folded(F.lit("Café")).alias("f")).collect()[0]
    assert (list(r.p), r.r, r.d, tuple(r.c), r.b, r.f) == ([1200, 50], 4.5, "mar 3, 2024", (17.44, 78.46), False, "Cafe")


def test_review_signals_are_cued_sentences(spark, tmp_path):
    import hashlib
    import re

    fill = "and nobody there knew of any other thing to tell"
    texts = [
        f"Nothing to see here {fill}. Visitors say it is good, safe and  clean {fill}! Too short, bad. It is crowded, rude and costs ₹ 50 {fill}? The end of it {fill}.",
        " ".join(f"Number {i} is a quiet lake {fill}." for i in range(15)), "", None, f"No cue {fill}.",
    ]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for d, t in enumerate(texts):
        kept = [re.sub(r"\s+", " ", x).strip() for x in re.split(r"(?<=[.!?])\s+", t or "") if len(x.strip()) > 40]
        cued = [(i, x) for i, x in enumerate(kept) if any(c in x.lower() for c in ("review", "people say", "visitors", "users", "crowded", "quiet", "safe", "expensive", "good", "bad"))]
        want |= {hashlib.sha256(f"{d}:{i}:{x}".encode()).hexdigest()[:16]: (d, i, x) for i, x in cued[:12]}
    rows = {r.id: r for r in QUERIES["review_signal_rows"](spark, str(tmp_path)).collect()}
    assert {k: (r.doc_id, r.idx, r.text) for k, r in rows.items()} == want and len(want) == 14
    first, second = (next(r for r in rows.values() if (r.doc_id, r.idx) == (0, i)) for i in (1, 2))
    assert (first.sentiment, first.sentiment_score, first.topics[:4], first.mentioned_intents, first.mentioned_safety_signals) == ("positive", 1.0, ["visitors", "say", "good", "safe"], ["women_friendly"], ["safety"])
    assert (second.sentiment, second.sentiment_score, second.mentioned_price_signals) == ("negative", -1.0, ["price"])


def test_source_pages_by_terms_and_numbered_items(spark, tmp_path):
    rows = [
        ("<title>Things to do in town</title>", "u", True), ("<p>1. Blue Cup 2. Red Fort 3. Old Lake</p>", "u", True), ("<ul><li>Home<li>News<li>Us</ul>", "u", False), ("<p>1. Blue Cup 2. Red Fort</p>", "u", False),
        ("<p>a</p>", "https://x.example/romantic-guide", True), ("<script>best</script><p>Hours</p>", "u", False), (None, None, False), ("", "", False), ("<p>" + "x " * 1600 + "best</p>", "u", False),
    ]
    spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(rows)], "page_id long, html string, url string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.page_id: r.is_source_page for r in QUERIES["source_page_flag"](spark, str(tmp_path)).collect()} == {i: r[2] for i, r in enumerate(rows)}


def test_crawl_expands_and_retries(spark, tmp_path):
    schema = "kind string, source string, value string, priority double, depth int, retry_count int, seq long"
    frontier = Versions(spark, f"file://{tmp_path}/f")
    frontier.write(spark.createDataFrame([("query", "s", "A", 0.9, 0, 0, 1), ("query", "s", "a", 0.5, 0, 0, 2), ("query", "s", "bad", 0.8, 0, 0, 3)], schema))
    child = F.array(F.struct(F.lit("source_url").alias("kind"), F.concat("value", F.lit("/x")).alias("value"), F.lit("s").alias("source"), F.lit(0.4).alias("priority")))
    visit = lambda b: b.withColumn("outcome", F.when(F.col("value") == "bad", "failed").otherwise("done")).withColumn("children", child)
    rows = {r.value: (r.depth, r.retry_count) for r in crawl(frontier, visit, 10, 1).collect()}
    assert rows == {"bad": (0, 1), "A/x": (1, 0)}


def test_stream_upserts(spark, tmp_path):
    for i, rows in enumerate([[(1, "a", 1), (1, "b", 2)], [(1, "c", 3), (2, "d", 1)]]):
        spark.createDataFrame(rows, "k long, v string, ts long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    table = Versions(spark, f"file://{tmp_path}/t")
    stream = spark.readStream.schema("k long, v string, ts long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    stream_upserts(stream, table, "k", f"{tmp_path}/c").awaitTermination()
    assert {r.k for r in table.read().collect()} == {1, 2}


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the star-schema tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns

    def plain(v):
        if isinstance(v, (list, tuple)) or getattr(v, "ndim", 0):
            return [plain(x) for x in v]
        v = v.item() if hasattr(v, "item") else v
        return None if v is None or v != v else round(v, 9) if isinstance(v, float) else v

    def rows(df):
        return sorted(repr([plain(x) for x in t]) for t in df[columns].astype(object).itertuples(index=False))

    assert len(got) == len(want)
    assert rows(got) == rows(want)
