"""Resolution batch by batch against the plain loop; tables in buckets; what streams, crawls and quality rules must not lose."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from waymark.engine import Engine, Settings, as_entities
from waymark.functions.text import plain
from waymark.operators import quality, resolution, tables
from waymark.operators.resolution import metres_between
from waymark.streaming.batches import Versions, candidate_key, crawl, stream_upserts
from waymark.streaming.buckets import Buckets

NAMES = ["Lotus Pond Park", "Lotus Pond Park Gate", "Lotus Pond", "Blue Cup Cafe", "Blue Cup", "Blue Cup Coffee House", "Old Fort", "Old Fort Museum", "Green Leaf Garden", "Café Nirvana"]


def places(seed, n):
    """Found things: a few places, named and placed with noise; some without a position, a site or an address."""
    rng, out = random.Random(seed), []
    for i in range(n):
        p = rng.randrange(12)
        lat, lon = 17.40 + p * 0.004 + rng.choice([0, 0, 0.0008, 0.003]), 78.40 + (p * 7 % 12) * 0.004 + rng.choice([0, 0.001])
        here = rng.random() < 0.75
        out.append((f"{seed}-{i}", rng.choice(NAMES), lat if here else None, lon if here else None, rng.choice([None, f"https://s{p}.example", "https://all.example"]), rng.choice([None, "", f"{p} Lake Road", f"{p} Lake Road, Begumpet"]), f"src{i % 4}"))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, latitude double, longitude double, website string, address string, source string").withColumn(
        "sources", F.expr("array(named_struct('source', source, 'url', id, 'source_type', 'web', 'raw_path', cast(null as string), 'extraction_confidence', 0.5D))")
    ).drop("source").coalesce(1)


def normal(spark, texts):
    """The words of the engine's own normal form, from the engine: the loop is about turns, not about names."""
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", plain(F.col("t")).alias("n"))
    return {r.t: r.n for r in df.collect()}


def plain_loop(batches, form):
    """find_match and merge for each found thing in turn; the store is read again, in the order of saving, before each batch."""
    ratio = lambda x, y: SequenceMatcher(None, x, y).ratio()
    store = {}

    def similarity(a, b):
        name = max(ratio(form[x], form[y]) for x in [a["name"], *a["aliases"]] for y in [b["name"], *b["aliases"]])
        geo = 0.0
        if None not in (a["lat"], a["lon"], b["lat"], b["lon"]):
            d = metres_between((a["lat"], a["lon"]), (b["lat"], b["lon"]))
            geo = 1.0 if d <= 120 else max(0.0, 1 - d / 1000)
        site = 1.0 if a["site"] and a["site"] == b["site"] else 0.0
        return max(0.65 * name + 0.25 * geo + 0.1 * ratio(form[a["address"] or ""], form[b["address"] or ""]), 0.55 * name + 0.45 * site)

    for batch in batches:
        known = list(store.values())
        for i, name, lat, lon, site, address, source in batch:
            x = {"id": i, "name": name, "aliases": [], "lat": lat, "lon": lon, "site": site, "address": address, "sources": [source]}
            best, score = None, 0.0
            for e in known:
                s = similarity(x, e)
                if s >= 0.86 and s > score:
                    best, score = e, s
            if best is not None:
                known = [e for e in known if e is not best]
                first = lambda k: best[k] if best[k] not in (None, "") else x[k]  # noqa: B023, E731
                x = {**best, "aliases": sorted({*best["aliases"], x["name"]} - {best["name"]}), "sources": best["sources"] + x["sources"], **{k: first(k) for k in ("lat", "lon", "site", "address")}}
            store.pop(x["id"], None)
            store[x["id"]] = x
            known.append(x)
    return {e["id"]: (e["name"], tuple(e["aliases"]), e["lat"], e["lon"], e["site"], e["address"] or None, tuple(e["sources"])) for e in store.values()}


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1]])
def test_resolution_equals_the_plain_loop(spark, tmp_path, order):
    batches = [places(s, 100) for s in order]
    batches[1].append(batches[0][3])  # the same id again, as found before
    engine = Engine(spark, f"file://{tmp_path}", Settings(buckets=4))
    for batch in batches:
        out = engine.resolve(frame(spark, batch))
    form = normal(spark, {*NAMES, "", *[r[5] for b in batches for r in b if r[5]]})
    got = {r.id: (r.name, tuple(r.aliases), r.latitude, r.longitude, r.website, r.address or None, tuple(s.source for s in r.sources)) for r in out.collect()}
    assert got == plain_loop(batches, form) and len(got) < 250


def test_same_place_in_two_batches_is_one_entity(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}", Settings(buckets=8, batch=2))
    engine.seed(spark.createDataFrame([("query", "maps", "a", 1.0, 0, 0, 1), ("query", "web", "b", 0.5, 0, 0, 2), ("query", "web", None, 0.4, 0, 0, 3)], "kind string, source string, value string, priority double, depth int, retry_count int, seq long"))
    none = F.array().cast("array<struct<kind: string, value: string, source: string, priority: double>>")
    seen = []

    def visit(batch):
        seen.append(sorted(str(r.value) for r in batch.collect()))
        return batch.withColumn("outcome", F.lit("done")).withColumn("children", none)

    def found(result):
        rows = result.select(F.concat_ws("-", "source", "value").alias("id"), F.lit("Lotus Pond Park").alias("name"), (17.4 + F.length("source") * 1e-5).alias("latitude"), F.lit(78.4).alias("longitude"), F.lit("1 Lake Road").alias("address"), F.col("source").alias("s"))
        return rows.withColumn("sources", F.expr("array(named_struct('source', s, 'url', id, 'source_type', 'web', 'raw_path', cast(null as string), 'extraction_confidence', 0.5D))")).drop("s")

    engine.settings = Settings(buckets=8, batch=1)
    assert engine.run(visit, 2, found=found).count() == 1 and seen == [["a"], ["b"]]
    rows = engine.rows("entities").collect()
    assert len(rows) == 1 and sorted(s.source for s in rows[0].sources) == ["maps", "web"]
    assert engine.run(visit, 5, found=found).count() == 0 and seen[2:] == [["None"], []]
    # A batch whose entities were saved when its run broke off is not merged again.
    before = engine.rows("entities").collect()
    engine.resolve(found(spark.createDataFrame([("web", "b")], "source string, value string")), "batch 1")
    assert engine.rows("entities").collect() == before


def test_merged_states_match_what_their_parts_do_not(spark):
    """The name from one record and the site from another: only their merger matches the third."""
    rows = [("a", "Blue Cup Cafe", 17.4, 78.4, None, "1 Lake Road"), ("b", "Blue Cup Cafe Hub", 17.4, 78.4, "https://x.example", "1 Lake Road"), ("c", "Cup Cafe", None, None, "https://x.example", None), ("d", "Nowhere", None, None, None, None)]
    e = as_entities(spark.createDataFrame(rows, "id string, name string, latitude double, longitude double, website string, address string")).withColumns({"turn": F.lit(1), "place": F.ascii("id")})
    facts = resolution.facts(e, False)
    got = resolution.resolved(facts, facts.limit(0), lambda df: df.checkpoint()).collect()
    root = {r.node.split(":")[2]: r.root.split(":")[2] for r in got}
    assert {chr(int(k)): chr(int(v)) for k, v in root.items()} == {"a": "a", "b": "a", "c": "a", "d": "d"}


def test_resolution_of_nothing(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}")
    assert engine.resolve(frame(spark, [])).count() == 0
    assert engine.resolve(frame(spark, places(5, 3))).count() <= 3 and engine.resolve(frame(spark, [])).count() <= 3


def test_buckets_rewrite_what_a_step_touches(spark, tmp_path):
    table = Buckets(spark, f"file://{tmp_path}/t", F.col("k"), 64)
    with pytest.raises(ValueError):
        table.read()
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    table.write(rows)
    before = table.manifest()[0]
    new = spark.createDataFrame([(5, 1), (19_999, 1), (20_000, 1), (None, 1)], "k long, v int")
    change = lambda old: tables.upsert(old, new, "k")
    table.change(2, new, change)
    after = table.manifest()[0]
    moved = [b for b in after if after[b] != before.get(b)]
    assert len(moved) == len(table.touched(new)) <= 4 and sum(spark.read.parquet(after[b]).count() for b in moved) < 0.08 * 20_000
    assert sorted((r.k if r.k is not None else -1) for r in table.read().where("v = 1").collect()) == [-1, 5, 19_999, 20_000] and table.read().count() == 20_002
    assert table.read(1).where("v = 1").count() == 0  # older versions stay as they were
    again = Buckets(spark, f"file://{tmp_path}/t", F.col("k"), 64)
    assert again.at == 2 and again.change(2, new, change).count() == 20_002  # made again: the same
    table.change(3, spark.range(100).select(F.col("id").alias("k")), lambda old: old.where("k >= 100 or k is null"))
    table.drop_before(1)
    assert table.read().count() == 19_902 and table.numbers() == [3]
    with pytest.raises(ValueError):
        table.change(4, new.limit(1), lambda old: old.unionByName(rows.limit(50)))


@pytest.mark.parametrize("kind", ["versions", "buckets"])
def test_streamed_rows_without_time_or_key_stay(spark, tmp_path, kind):
    table = Versions(spark, f"file://{tmp_path}/t") if kind == "versions" else Buckets(spark, f"file://{tmp_path}/t", F.col("k"), 4)
    schema = "k long, ts long, v string"
    spark.createDataFrame([(1, None, "a"), (2, 5, "b"), (2, 5, "c"), (2, None, "z"), (None, 1, "n"), (None, None, "m")], schema).coalesce(1).write.parquet(f"file://{tmp_path}/in/1")
    stream = spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in/*")
    stream_upserts(stream, table, "k", f"file://{tmp_path}/c").awaitTermination()
    got = lambda: sorted((r.k or 0, r.ts or 0, r.v) for r in table.read().collect())
    assert got() == [(0, 0, "m"), (0, 1, "n"), (1, 0, "a"), (2, 5, "c")]
    spark.createDataFrame([(1, 7, "x"), (3, None, "y")], schema).write.parquet(f"file://{tmp_path}/in/2")
    stream_upserts(spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in/*"), table, "k", f"file://{tmp_path}/c").awaitTermination()
    assert got() == [(0, 0, "m"), (0, 1, "n"), (1, 7, "x"), (2, 5, "c"), (3, 0, "y")]


@pytest.mark.parametrize("kind", ["versions", "buckets"])
def test_null_candidates_are_visited_once(spark, tmp_path, kind):
    frontier = Versions(spark, f"file://{tmp_path}/f") if kind == "versions" else Buckets(spark, f"file://{tmp_path}/f", candidate_key(), 4)
    frontier.write(spark.createDataFrame([("query", "web", None, 1.0, 0, 0, 1), ("query", None, "s", 0.9, 0, 0, 2), (None, "web", "k", 0.8, 0, 0, 3), ("query", "web", "v", 0.1, 0, 0, 4)], "kind string, source string, value string, priority double, depth int, retry_count int, seq long"))
    none, seen = F.array().cast("array<struct<kind: string, value: string, source: string, priority: double>>"), []

    def visit(batch):
        seen.extend((r.kind, r.source, r.value) for r in batch.collect())
        return batch.withColumn("outcome", F.when(F.col("value") == "v", "failed").otherwise("done")).withColumn("children", none)

    crawl(frontier, visit, 1, 7)
    assert seen[:4] == [("query", "web", None), ("query", None, "s"), (None, "web", "k"), ("query", "web", "v")] and set(seen[4:]) == {("query", "web", "v")} and len(seen) == 7
    assert frontier.beside("failed", candidate_key()).read().count() == 1  # after its last retry, once


def test_failures_are_written_once(spark, tmp_path):
    """A run that breaks off between the failures and the frontier makes the batch again; its failures count once."""
    frontier = Versions(spark, f"file://{tmp_path}/f")
    frontier.write(spark.createDataFrame([("source_url", "web", "u", 1.0, 0, 1, 1)], "kind string, source string, value string, priority double, depth int, retry_count int, seq long"))
    none = F.array().cast("array<struct<kind: string, value: string, source: string, priority: double>>")
    visit = lambda b: b.withColumn("outcome", F.lit("failed")).withColumn("children", none)
    change, broken = frontier.change, []

    def breaks(*a):
        if not broken:
            broken.append(1)
            raise RuntimeError("lost")
        return change(*a)

    frontier.change = breaks
    with pytest.raises(RuntimeError):
        crawl(frontier, visit, 1, 1)
    crawl(frontier, visit, 1, 1)
    assert frontier.beside("failed", candidate_key()).read().count() == 1 and frontier.read().count() == 0


def test_upsert_takes_one_row_of_a_key(spark):
    old = spark.createDataFrame([(1, "a"), (None, "n")], "k long, v string")
    new = spark.createDataFrame([(1, "b"), (1, "c"), (2, "d"), (None, "m"), (None, "m")], "k long, v string")
    assert sorted((r.k or 0, r.v) for r in tables.upsert(old, new, "k").collect()) == [(0, "m"), (0, "m"), (0, "n"), (1, "c"), (2, "d")]


def test_readiness_reads_status_primary_category_and_mode(spark):
    rows = [(1, "Lotus Park", "park", None, "ACTIVE", None), (2, "Lotus Park", "park", None, "REJECTED_PAGE_FRAGMENT", None), (3, "Lotus Park", "park", "police", "ACTIVE", None), (4, "Lotus Park", "police", "park", None, None), (5, "Top 10 parks", "park", None, "ACTIVE", "mentioned_entity"), (6, "Top 10 parks", "park", None, "ACTIVE", "linked")]
    df = spark.createDataFrame(rows, "id int, name string, category string, primary_category string, status string, extraction_mode string").withColumns({"locality": F.lit("L"), "address": F.lit("A"), "latitude": F.lit(None).cast("double"), "longitude": F.lit(1.0), "image_id": F.lit("i"), "n_sources": F.lit(1), "confidence": F.lit(0.9), "rating": F.lit(4.0), "timings": F.lit("9"), "intent_tags": F.array(F.lit("x"))})
    got = {r.id: {b for b in r.blockers if b in ("not_recommendation_entity", "source_or_article_title")} for r in quality.with_quality(df).collect()}
    assert got == {1: set(), 2: {"not_recommendation_entity"}, 3: {"not_recommendation_entity"}, 4: set(), 5: set(), 6: {"source_or_article_title"}}
    whole = df.withColumn("latitude", F.lit(17.4))
    assert {r.id for r in quality.with_quality(whole).where("production_ready").collect()} == {1, 4, 5, 6}
