"""The pipeline's stages against brute force and direct scoring, and rows that repeat."""

import os
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from waymark.llm import minhash, quality, substring, toxicity

SF = "/root/testdata/sf0.001"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def test_near_dedup_keeps_one_row_of_each_document(spark):
    text, other, third = (" ".join(f"{w}{i}" for i in range(30)) for w in "abc")
    rows = [(1, text, "y"), (1, text, "x"), (1, text, "x"), (2, text, "x"), (3, other, "x"), (None, other + " more", "x"), (None, third, "x"), (None, third, "x"), (4, "", "x"), (5, None, "x"), (6, "p q r", "x"), (6, "s t u", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    assert out.columns == docs.columns
    want = [(1, text, "x"), (3, other, "x"), (None, third, "x"), (4, "", "x"), (5, None, "x"), (6, "p q r", "x"), (6, "s t u", "x")]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the tables")
def test_stages_drop_what_brute_force_drops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = lambda stage: {r.doc_id for r in stage(spark, docs, SF).collect()}
    rows = docs.collect()
    assert kept(corpus_pipeline.quality_stage) == {r.doc_id for r in quality.classify(docs).collect() if r.quality_score >= quality.LEAST} != {r.doc_id for r in rows}
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert kept(corpus_pipeline.toxicity_stage) == {r.doc_id for r in rows if model.score(pa.array([r.text], pa.string()))[0] < 0.5} != {r.doc_id for r in rows}
    sets, parent = {}, {r.doc_id: r.doc_id for r in rows}
    for r in rows:
        w = [x.lower() for x in WORDS.findall((r.text or "").encode())]
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = lambda x: x if parent[x] == x else root(parent[x])
    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[:i]:
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                a, b = root(x), root(y)
                parent[max(a, b)] = min(a, b)
    assert kept(corpus_pipeline.near_duplicate_stage) == {x for x in ids if root(x) == x} != set(ids)


def test_stages_take_odd_tables(spark):
    """Null ids and texts, repeated rows, empty tables, and tables without n_chars or with columns named like the operators'."""
    text, other = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    rows = [(1, text, "x", 1), (1, text, "x", 1), (2, other + " " + text, "y", 2), (None, text, "z", 3), (3, None, "w", 4), (4, "", "v", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, repeats string, keep int").repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF) if name != "toxicity" or os.path.isdir(SF) else None
        if out is None:
            continue
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert {tuple(r)[2:] for r in out.collect()} <= {tuple(r)[2:] for r in docs.collect()}, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    cut = {(r.doc_id, r.repeats): r.text for r in corpus_pipeline.substring_stage(spark, docs, SF).collect()}
    assert cut == {(1, "x"): text, (2, "y"): other, (None, "z"): text, (3, "w"): None, (4, "v"): ""}
    packed = corpus_pipeline.packing_stage(spark, docs, SF).collect()
    assert len(packed) == 6 and sorted(r.length for r in packed)[:2] == [1, 1] and corpus_pipeline.packing_stage(spark, docs.limit(0), SF).count() == 0


def test_dedup_stages_broadcast_no_table(spark):
    """Tables that grow with the documents stay out of the driver, however small they are."""
    texts = [" ".join(f"{'abc'[d % 3]}{i * (d % 7 + 1)}" for i in range(40)) + f" shared {' '.join(f's{i}' for i in range(30))} {d % 5}" for d in range(60)]
    docs = spark.createDataFrame([(d, t if d % 4 else texts[0] + " x" * (d % 3), "x") for d, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    store = spark._jsparkSession.sharedState().statusStore()
    for stage in (corpus_pipeline.near_duplicate_stage, corpus_pipeline.substring_stage):
        before = store.executionsCount()
        assert 0 < stage(spark, docs, SF).count() <= 60
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        plans = [store.executionsList().apply(i).physicalPlanDescription() for i in range(before, store.executionsCount())]
        assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastExchange" in p for p in plans), stage.__name__


def test_a_worker_holds_few_arrays_at_once():
    """Two tasks of an executor share what its heap leaves: a batch of 8 MB of text takes far less than 100 MB in each stage's function."""
    words_of = np.random.default_rng(1).integers(0, 3000, (3800, 400))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(3800)), "text": [" ".join(f"w{x}" for x in row) for row in words_of.tolist()]})
    match = pa.struct([("start", pa.int64()), ("windows", pa.int32()), ("of_doc", pa.int64()), ("of_start", pa.int64())])
    found = batch.append_column("found", pa.array([[{"start": 5, "windows": 3, "of_doc": 0, "of_start": 0}]] * 3800, pa.list_(match)))
    for name, rows in (
        ("seeds", substring.seeded(iter([batch]), 20, np.empty(0, np.int64))), ("cut", substring.cut(iter([found]), 20)), ("sketches", minhash.sketched(iter([batch]), 5)),
        ("quality", quality.scored(iter([batch]), np.zeros(quality.FEATURES + 1), {}, 0.5, 0.25)),
    ):
        tracemalloc.start()
        assert sum(r.num_rows for r in rows) >= 3800, name
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 70e6, name
