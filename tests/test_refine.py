"""Refinement of what has changed alone, and search over what it wrote: reviews' words, an index, questions without words."""

import pytest
from pyspark.sql import functions as F

from waymark.engine import CARD, Engine
from waymark.operators import refine as rf

SCHEMA = "id string, name string, category string, locality string, address string, latitude double, longitude double, rating double, rating_count long, confidence double, timings string, text string"
ROWS = [
    ("1", "Lotus Lake Park", "park", "Begumpet", "1 Lake Road, Begumpet, Hyderabad 500016", 17.4449, 78.4666, 4.5, 900, 0.8, "9-21", "a quiet lake with a walking trail"),
    ("2", "Old Fort Museum", "museum", "Golconda", "2 Fort Road, Golconda, Hyderabad 500008", 17.38, 78.40, None, None, 0.8, "9-17", "an old fort"),
    ("3", "Blue Cup Cafe", "cafe", "Madhapur", "3 Hill Road, Madhapur, Hyderabad 500081", 17.45, 78.39, 4.0, 20, 0.8, "8-23", "coffee"),
]


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    e = Engine(spark, f"file://{tmp_path_factory.mktemp('refine')}")
    more = {
        "sources": F.expr("array(named_struct('source', 'openstreetmap', 'url', id, 'source_type', 'open_data', 'raw_path', 'r', 'extraction_confidence', 0.9D))"),
        "media": F.expr("array(named_struct('id', concat('i', id), 'url', concat('http://img/', id), 'source', 'web', 'caption', name, 'labels', array('a'), 'is_primary', true))"),
    }
    e.add(spark.createDataFrame(ROWS, SCHEMA).withColumns(more))
    return e


def reviews(spark, *more):
    return spark.createDataFrame([("r1", "1", "calm and peaceful, good for families"), ("r2", "3", "good coffee"), *more], "id string, entity_id string, text string")


def plain(df):
    return sorted(str(r.asDict(True)) for r in df.select(*sorted(df.columns)).collect())


def test_only_what_has_changed_is_refined(spark, engine, monkeypatch):
    seen, whole = [], rf.refined
    monkeypatch.setattr(rf, "refined", lambda rows, geocodes=None: (seen.append(rows.select("id").collect()), whole(rows, geocodes))[1])
    first = {r.id: r for r in engine.refine(reviews(spark)).collect()}
    assert len(seen[-1]) == 3 and first["1"].review_count == 1 and first["1"].popularity > first["2"].popularity and first["2"].hidden_gem == 0.5
    assert first["1"].sentiment == "positive" and "quiet" in first["1"].suitability_scores and "coffee" in {*first["3"].topics}
    assert first["1"].first_seen_at is not None
    second = engine.refine(reviews(spark, ("r3", "2", "an observatory with a view, romantic")))
    assert [r.id for r in seen[-1]] == ["2"] and {r.id: r.review_count for r in second.collect()} == {"1": 1, "2": 1, "3": 1}
    assert engine.rows("signals").count() == engine.rows("signals").select("id").distinct().count()
    incremental = plain(second)
    assert plain(engine.refine(reviews(spark, ("r3", "2", "an observatory with a view, romantic")), everything=True)) == incremental and len(seen[-1]) == 3
    engine.refine(reviews(spark, ("r3", "2", "an observatory with a view, romantic")))
    assert seen[-1] == []
    geocodes = spark.createDataFrame([("3", 17.46, 78.38, "Madhapur", "x")], "id string, latitude double, longitude double, locality string, address string")
    engine.refine(reviews(spark, ("r3", "2", "an observatory with a view, romantic")), geocodes)
    assert len(seen[-1]) == 3  # a table that was not there before is an input of all
    engine.refine(reviews(spark, ("r3", "2", "an observatory with a view, romantic")), geocodes.withColumn("address", F.lit("y")))
    assert [r.id for r in seen[-1]] == ["3"]


def test_search_reads_reviews_and_takes_questions_without_words(spark, engine):
    engine.refine(reviews(spark, ("r3", "2", "an observatory with a view, romantic")))
    card = engine.search("observatory").collect()
    assert [c.id for c in card] == ["2"] and card[0].review_snippets == ["an observatory with a view, romantic"] and card[0].review_count == 1 and tuple(card[0].asDict()) == CARD
    assert [c.id for c in engine.search("").collect()] == ["1", "3", "2"]  # by popularity
    scanned = {q: plain(engine.search(q)) for q in ("observatory", "", "quiet near Begumpet", "near Begumpet", "coffee")}
    assert engine.search("near Begumpet").first().id == "1"
    engine.index_cards()
    assert {q: plain(engine.search(q)) for q in scanned} == scanned
