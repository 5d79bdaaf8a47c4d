"""The training-data operators against brute force, on small tables with nulls, ties, repeats, long texts and clashing columns."""

import base64
import hashlib
import os
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymark.llm import bpe, graph, graph_search, hamming, minhash, packing, quality, substring, token_count, toxicity, warc
from waymark.llm.tokens import Encoder

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD, BYTE, RANKS = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
ODD = ["", " ", None, "a  b\n\nc ", "x<|endoftext|> y", "naïve Ünïcode ΟΔΟΣ 日本語 テキスト", "é a b  c　 d", "x" * 5000, "don't I'm 12345 ½", "\t\r\n", "aaaa aaa aa a" * 50]
EXTRA = "doc_id long, text string, starts string, score string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(["the", "lake", "garden", "Quiet", "walk", "stone", "of", "light", "river,", "old."]) + rng.choice(["", "s", "er"]) for _ in range(n))


def table(spark, texts, first=0):
    return spark.createDataFrame([(None if t == "NULLID" else first + i, "null id" if t == "NULLID" else t, "s", "x", "en", "src0", 1) for i, t in enumerate(texts)], EXTRA)


def corpus(seed=1, n=40):
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(1, 300)) for _ in range(n)]
    texts = ODD + base + base[:10]
    for t in base[:15]:
        w = t.split()
        if len(w) > 10:
            w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    shared = prose(rng, 40)
    return texts + [prose(rng, 30) + "\n" + shared + "\n" + prose(rng, 5) for _ in range(8)] + [shared + " " + shared, "NULLID"]


@pytest.mark.parametrize("path,ranks", [(WORD, ""), (BYTE, ""), (BYTE, RANKS)])
def test_encoder_equals_the_library(path, ranks):
    encode = Encoder(path, ranks, public_tokenizers.PATTERN)
    texts = pa.array([t for t in corpus() if t != "NULLID"])
    ids, at = encode.encode(texts)
    want = [e.ids for e in encode.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want
    assert encode.counts(texts).tolist() == [len(w) for w in want]


def test_chunked_encoding_and_decoding(spark, monkeypatch):
    for bits in (4, 11):
        monkeypatch.setattr(bpe, "CUT_BITS", bits)
        encode = Encoder(BYTE)
        texts = pa.array([t for t in corpus(2) if t != "NULLID"])
        ids, at, *_ = bpe.encode_chunked(encode, bpe.Chunks(encode), texts)
        want = [e.ids for e in encode.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want
        assert [t.decode() for t in bpe.Decoder(encode).decode(ids, at)] == [t or "" for t in texts.to_pylist()]
    got = {r.doc_id: r for r in bpe.encoding_digests(table(spark, ["", None, "a b"]), BYTE).collect()}
    assert got[0].ids_sha256 == hashlib.sha256(b"").hexdigest() and got[2].ids_sha256 == hashlib.sha256(",".join(map(str, encode.tokenizer.encode("a b").ids)).encode()).hexdigest()
    assert bpe.encoding_digests(table(spark, []), BYTE).count() == 0


def test_shared_chunks_are_encoded_once_for_all(spark):
    """Chunks of copies in different partitions come from the shared table; ids and texts are the library's all the same."""
    rng = random.Random(12)
    long = [prose(rng, 3000) for _ in range(3)]
    texts = [t for t in ODD if t is not None] + long * 3 + [long[0][:9000] + " other end " + prose(rng, 800), "café 日本 " * 900, "NULLID"]
    df = table(spark, texts).repartition(6)
    encode = Encoder(BYTE)
    got = {r.doc_id: r for r in bpe.encoding_digests(df, BYTE, RANKS, public_tokenizers.PATTERN).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        if t != "NULLID":
            ids = encode.tokenizer.encode(t, add_special_tokens=False).ids
            assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            assert got[i].decoded_sha256 == hashlib.sha256(encode.tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    copies = [got[i] for i, t in enumerate(texts) if t in long]
    assert len(copies) == 9 and all(r.n_chunks > 3 and r.n_shared == r.n_reused == r.n_chunks for r in copies)


def test_wrong_joins_are_repaired_until_they_agree(monkeypatch):
    """Chunks whose edge units are told wrong: joins that don't agree merge their chunks, and the ids are the library's in the end."""
    encode = Encoder(BYTE)
    rng = random.Random(13)
    texts = pa.array([prose(rng, 400), prose(rng, 200), "", prose(rng, 300)])
    want = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
    monkeypatch.setattr(bpe, "CUT_BITS", 6)
    chunks, broken, calls = bpe.Chunks(encode), set(), []
    true_of, true_encode = bpe.Chunks.of, bpe.encode_chunked

    def spoiled(self, forms):
        row, known, shared = true_of(self, forms)
        for r in row.tolist():  # spoil the unit before the last inner cut of some chunks, once
            if r not in broken and len(broken) < 9 and self.rows[r, 2] > 4:
                broken.add(r)
                self.ids[self.rows[r, 0] + self.rows[r, 8]] += 1
        return row, known, shared

    def counted(*a):
        calls.append(len(a[2]))
        return true_encode(*a)

    monkeypatch.setattr(bpe.Chunks, "of", spoiled)
    monkeypatch.setattr(bpe, "encode_chunked", counted)
    ids, at, *_ = bpe.encode_chunked(encode, chunks, texts)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want and len(broken) == 9 and len(calls) > 1


def test_token_counts_splice_exactly(spark):
    texts = [t for t in corpus(3)] + ["word " * 3000, "y" * 4000]
    encode = Encoder(WORD)
    want = [len(encode.tokenizer.encode("null id" if t == "NULLID" else t or "", add_special_tokens=False).ids) for t in texts]
    got = token_count.count_tokens(table(spark, texts), WORD, limit=100, huge=400, chunk=150, overlap=8).collect()
    known = {r.doc_id: (r.n_tokens, r.over_limit, r.n_bytes) for r in got if r.doc_id is not None}
    assert len(got) == len(texts) and all(known[i] == (want[i], want[i] > 100, len((t or "").encode())) for i, t in enumerate(texts) if t != "NULLID")


def test_packing_is_whole_and_gapless(spark):
    texts = corpus(4) + ["word " * 700]
    rows = packing.pack(table(spark, texts), WORD, capacity=256, group=20).collect()
    encode = Encoder(WORD)
    for i, t in enumerate(texts):
        if t == "NULLID":
            continue
        ids = [*encode.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == i)
        assert pieces == [(s, len(p), zlib.crc32(struct.pack(f"<{len(p)}I", *p)), len(ids)) for s in range(0, len(ids), 256) if (p := ids[s : s + 256])]
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(table(spark, []), WORD).count() == 0


def test_packing_pads_little_and_bounds_groups(spark):
    """Groups hold pieces, not documents: long documents do not make them larger. Full sequences but for a few in each group."""
    texts = ["word " * n for n in (3, 900, 4000, 12, 700)] * 12
    rows = packing.pack(table(spark, texts), WORD, capacity=256, group=40).collect()
    groups, used = {}, {}
    for r in rows:
        groups[r.sequence_id >> 32] = groups.get(r.sequence_id >> 32, 0) + 1
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert len(groups) == -(-len(rows) // 40) and max(groups.values()) < 80
    assert sum(256 - n for n in used.values()) < 0.1 * 256 * len(used)


def test_first_fit_decreasing_equals_the_plain_loop():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 300)
    bins, _ = packing.first_fit_decreasing(lengths, 100)
    room, want = [], np.empty(300, int)
    for i in np.argsort(-lengths, kind="stable"):
        for b, free in enumerate(room):
            if free >= lengths[i]:
                break
        else:
            room.append(100)
            b = len(room) - 1
        room[b] -= lengths[i]
        want[i] = b
    assert (bins == want).all()


def without_repeats(texts, length=20):
    """Words, removed words and kept words of each text in order, by a set of all windows."""
    seen, want = set(), {}
    for i, t in enumerate(texts):
        w = WORDS.findall((t or "").encode())
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            key = tuple(w[s : s + length])
            if key in seen:
                gone[s : s + length] = [True] * length
            seen.add(key)
        want[i] = (w, [x for x, g in zip(w, gone) if not g])
    return want


@pytest.mark.parametrize("looked_at,often", [(64, 16), (1, 2)])
def test_substrings_equal_brute_force(spark, monkeypatch, looked_at, often):
    """With and without hot anchors; extra columns of clashing names go or stay as stated."""
    for name, value in (("LOOKED_AT", looked_at), ("OFTEN", often)):
        monkeypatch.setattr(substring, name, value)
    rng = random.Random(5)
    often_said = prose(rng, 9)  # one anchor in many contexts
    texts = [t for t in corpus(5) if t != "NULLID"] + [f"{prose(rng, 15)} {often_said} {prose(rng, 15)}" for _ in range(20)] + ["NULLID"]
    want = {i: (len(w), len(w) - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for i, (w, k) in without_repeats([t if t != "NULLID" else "" for t in texts]).items()}
    want.pop(len(texts) - 1)
    rows = substring.remove_repeats(table(spark, texts).withColumn("found", F.lit(1)).repartition(3)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows if r.doc_id is not None} == want
    assert [(r.n_removed, r.repeats) for r in rows if r.doc_id is None] == [(0, [])] and rows[0].lang == "en" and rows[0].starts == "s"
    for r in rows:
        w, covered = WORDS.findall((r.text or "").encode()), set()
        for x in r.repeats:
            of = WORDS.findall(texts[x.of_doc].encode())
            assert x.words >= 20 and (x.of_doc, x.of_start) < (r.doc_id, x.start) and w[x.start : x.start + x.words] == of[x.of_start : x.of_start + x.words]
            covered |= set(range(x.start, x.start + x.words))
        assert len(covered) == r.n_removed


def test_substrings_of_repeated_ids_and_empty_tables(spark):
    """Rows of one id precede one another by their start alone: equal ones keep their words, and each loses what the other repeats."""
    rng = random.Random(6)
    x, y = prose(rng, 30), prose(rng, 30)
    rows = substring.remove_repeats(table(spark, [x]).unionByName(table(spark, [x])).unionByName(table(spark, [y, x]))).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(0, 0), (0, 0), (0, 0), (1, 30)]
    assert substring.remove_repeats(table(spark, [])).count() == 0


def test_joining_seeds_is_the_same_over_any_batches():
    rng = random.Random(8)
    keys = [(rng.randrange(6), rng.randrange(4)) for _ in range(120)]
    rows = sorted((a, e, rng.randrange(9), rng.randrange(9), 1 + rng.randrange(4)) for a, e in keys)
    want = []
    for a in {a for a, _ in keys}:
        extents = {e for b, e in keys if a == b}
        for e in extents:
            own = [r for r in rows if r[:2] == (a, e)]
            want += [(*own[0][2:], substring.OPEN, *own[0][2:4])] if len(extents) > 1 else []
            want += [(*r[2:], substring.REPEATED, *own[0][2:4]) for r in own if r[2:4] > own[0][2:4]]
    for size in (1, 2, 7, 200):
        told = [(None, 1, 5, 6, 7, substring.OPEN, 5, 6)] + [(*r, substring.SEED, r[2], r[3]) for r in rows]
        batches = [substring.batch_of(list(zip(*told[i : i + size])), substring.ANCHORS) for i in range(0, len(told), size)]
        got = [tuple(x.values()) for b in substring.extended(iter(batches)) for x in b.to_pylist()]
        assert sorted(got) == sorted(want + [(5, 6, 7, substring.OPEN, 5, 6)]), size


def test_matches_on_one_line_are_one_maximal_repeat():
    row, start, windows, of_doc, of_start = (np.array(x) for x in ([0, 0, 0, 1], [4, 0, 9, 0], [3, 5, 1, 2], [7, 7, 7, 7], [14, 10, 19, 10]))
    got = [x.tolist() for x in substring.maximal(row, start, windows, of_doc, of_start)]
    assert got == [[0, 0, 1], [0, 9, 0], [7, 1, 2], [7, 7, 7], [10, 19, 10]]


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    texts = [t for t in corpus(6, 60) if t != "NULLID"]
    sets = []
    for t in texts:
        w = [x.lower() for x in WORDS.findall((t or "").encode())]
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(table(spark, texts + ["NULLID"]).repartition(3), k=k).collect()}
    assert got == {i: (len(sets[i]), root(i), root(i) == i) for i in range(len(texts))}


def test_families_of_near_copies_lose_no_link(spark, monkeypatch):
    """Many versions around the threshold, compared in small blocks: components must be those of all pairs."""
    monkeypatch.setattr(minhash, "BLOCK", 5)
    monkeypatch.setattr(minhash, "FAMILY", 4)
    monkeypatch.setattr(minhash, "BESIDE", 3)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(30):
        w = list(base)
        for j in rng.sample(range(60), rng.randrange(0, 7)):
            w[j] = f"c{i}x{j}"
        texts.append(" ".join(w))
    sets = [set(zip(t.split(), t.split()[1:])) for t in texts]
    parent = list(range(30))
    root = lambda x: x if parent[x] == x else root(parent[x])
    for i in range(30):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(table(spark, texts), k=2).collect()}
    assert got == {i: root(i) for i in range(30)}
    assert len(set(got.values())) > 1


def test_near_duplicates_of_an_empty_table(spark):
    assert minhash.near_duplicates(table(spark, [])).count() == 0


@pytest.mark.parametrize("one_task", [400_000, 0])
def test_components(spark, one_task):
    edges = [(i, i + 1) for i in range(1, 30)] + [(50, 40), (40, 45), (60, 60), (None, 3)]
    got = {r.id: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long"), one_task).collect()}
    assert got == {i: 1 for i in range(1, 31)} | {40: 40, 45: 40, 50: 40}


def test_archives_round_trip_and_index_order(spark):
    html = ["<p>é</p>", None, "", "same", "same", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "z" * 100_000, "same"]
    rows = [(i, f"http://www.b{i % 2}.example.com:80/p{i}#x" if i else None, h, "text/html") for i, h in enumerate(html)] + [(None, "http://n/", "n", "x")]
    index = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string, digest string")).orderBy("position").collect()
    first, want = {}, {}
    for i, h in enumerate(html):
        raw = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        lead = first.setdefault(digest, i)
        want[i] = (len(raw), digest, "response" if lead == i else "revisit", None if lead == i else lead)
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index} == want
    keys = [(r.url_key, r.captured, r.page_id) for r in index]
    assert keys == sorted(keys) and index[-1].url_key.startswith("com,example,b1)/p")
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_of_repeated_pages_and_many_ranges(spark, monkeypatch):
    """Rows of one page_id are archived by their own payloads; runs cut into many ranges merge to one order."""
    rows = [(1, "http://a/", "A"), (5, "http://a/", "A"), (5, "http://a/", "BB"), (5, "http://a/", "BB")] + [(10 + i, f"http://h{i % 3}/p{i % 7}", f"x{i % 40}") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = warc.archive_pages(df).where("page_id < 10").select("page_id", "payload_bytes", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([(1, 1, "response", None), (5, 1, "revisit", 1), (5, 2, "response", None), (5, 2, "response", None)], key=str)
    path = f"{spark.conf.get('spark.checkpoint.dir')}/many"
    warc.write_archives(df.where("page_id >= 10"), path, F.date_format(F.timestamp_seconds(F.lit(0)), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    index = warc.capture_index(warc.read_archives(spark, path), range_rows=20).orderBy("position").collect()
    keys = [(r.url_key, r.captured, r.page_id) for r in index]
    assert len(keys) == 300 and keys == sorted(keys) and len({r.position >> 32 for r in index}) >= 10


def test_payloads_are_hashed_once_where_they_are_read(spark):
    """The three reads of the pages (sizes of groups, their members, payloads) take one SHA-1 each, and its base32 form is right."""
    html = [None, "", "a", "a", "é" * 999] + [f"x{i}" for i in range(300)]
    found = warc.records(spark.createDataFrame(list(enumerate(html)), "page_id long, html string").withColumn("url", F.lit("u")), 0)
    assert {r.page_id: r.digest for r in found.collect()} == {i: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for i, h in enumerate(html)}
    assert 1 <= found._jdf.queryExecution().optimizedPlan().toString().count("sha1(") <= 3


def test_loser_tree_merges():
    rng = random.Random(2)
    runs = [sorted((rng.randrange(50),) for _ in range(rng.randrange(0, 20))) for _ in range(7)]
    assert [runs[r][i] for r, i in warc.LoserTree(runs)] == sorted(x for r in runs for x in r)
    assert list(warc.LoserTree([])) == []


def vectors(spark, n=400, width=16):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(n, width)) + 3 * rng.normal(size=(8, width))[rng.integers(0, 8, n)]
    v[n // 2 : n // 2 + 60] = v[20]
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)] + [(n + 20, None, 0), (n + 40, [0.0] * width, 0), (n + 60, [float("nan")] * width, 0), (None, v[0].tolist(), 0), (0, v[0].tolist(), 1)]
    return v, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_graph_search_recall(spark):
    v, df = vectors(spark)
    got = {}
    for r in graph_search.search(df, shard=100).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert sorted(got) == list(range(0, 400, 20))
    hits = 0
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21)) and all(abs(s - v[q] @ v[i]) < 1e-9 for i, s in found.values())
        score = np.round(v @ v[q], 9)
        score[q] = -np.inf
        hits += len({i for i, _ in found.values()} & set(np.lexsort((np.arange(400), -score))[:20]))
    assert hits / (20 * len(got)) >= 0.95
    assert graph_search.search(df.limit(0)).count() == 0


@pytest.mark.parametrize("find,value", [(lambda d: graph_search.search(d, every=1), "score"), (lambda d: hamming.search(hamming.sign_codes(d), every=1), "distance")])
def test_searches_list_a_repeated_id_once(spark, find, value):
    """Rows that share an id stand for its least vector; other widths and clashing columns take no part."""
    rows = [(0, [1.0, 1.0], 7), (1, [2.0, 0.5], 7), (1, [-3.0, 1.0], 7), (2, [1.0, -1.0], 7), (3, [1.0, 1.0, 1.0], 7)]
    got = {(r.query_id, r.rank): (r.vec_id, r[value]) for r in find(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")).collect()}
    want = {(0, 1): (2, 0.0), (0, 2): (1, -2.0), (1, 1): (0, -2.0), (1, 2): (2, -4.0), (2, 1): (0, 0.0), (2, 2): (1, -4.0)}
    assert got == want if value == "score" else sorted(got) == sorted(want) and got[0, 1][0] == 1 and got[0, 2][0] == 2


def test_graph_search_compares_a_small_part_of_a_large_shard():
    """On clustered vectors: few distances a query, and a recall of 0.9 or more."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(8_000, 24)) + 4 * rng.normal(size=(200, 24))[rng.integers(0, 200, 8_000)]
    largest = np.sqrt((v**2).sum(1).max())
    graph_ = graph_search.Graph(np.concatenate([v, np.sqrt(largest**2 - (v**2).sum(1, keepdims=True).clip(0, largest**2))], 1))
    q = v[::20]
    graph_.compared = 0
    near = graph_.search(np.concatenate([q, np.zeros((len(q), 1))], 1).astype(np.float32), graph_search.BEAM)[0][:, :20]
    exact = np.argsort(-(q @ v.T), 1)[:, :20]
    assert graph_.compared / len(q) < 0.15 * len(v)
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(near.tolist(), exact.tolist())]) >= 0.9


def test_hamming_search_is_exact(spark):
    v, df = vectors(spark, 300, 70)
    bits = np.vstack([v > 0, np.zeros((1, 70), bool)])
    ids = [*range(300), 340]
    got = {(r.query_id, r.rank): (r.vec_id, r.distance) for r in hamming.search(hamming.sign_codes(df), k=7, shard=90).collect()}
    for q in [*range(0, 300, 20), 340]:
        row = ids.index(q)
        order = sorted((int((bits[row] ^ bits[i]).sum()), ids[i]) for i in range(301) if i != row)[:7]
        assert [got[q, k + 1] for k in range(7)] == [(i, d) for d, i in order]
    assert hamming.search(hamming.sign_codes(df.limit(0))).count() == 0


def test_label_model_equals_a_plain_em():
    """Expectation-maximisation by loops over documents gives the posteriors and the accuracies of the one over pattern counts."""
    rng = np.random.default_rng(2)
    m = len(quality.LABELLERS)
    good = rng.random(400) < 0.7
    ballots = [[quality.ABSTAIN if rng.random() < 0.3 else (quality.GOOD if g == (rng.random() < 0.6 + 0.04 * i) else quality.BAD) for i in range(m)] for g in good]
    patterns = {}
    for b in ballots:
        key = int("".join(map(str, b)), 3)
        patterns[key] = patterns.get(key, 0) + 1
    got, table_ = quality.label_model(patterns, rounds=15)
    first = {0: 0.95, 1: 0.4}
    p = [first.get(sum(v == quality.BAD for v in b), 0.05) for b in ballots]
    for _ in range(15):
        prior = [sum(p) + 1, sum(1 - x for x in p) + 1]
        seen = [[[0.5] * 3, [0.1] * 3] for _ in range(m)]
        for b, x in zip(ballots, p):
            for i, v in enumerate(b):
                seen[i][0][v] += x
                seen[i][1][v] += 1 - x
        share = [[[n / sum(c) for n in c] for c in one] for one in seen]
        p = []
        for b in ballots:
            like = [prior[c] / sum(prior) for c in (0, 1)]
            for i, v in enumerate(b):
                if v != quality.ABSTAIN:
                    like = [like[c] * share[i][c][v] for c in (0, 1)]
            p.append(like[0] / sum(like))
    assert np.allclose([got[int("".join(map(str, b)), 3)] for b in ballots], p, atol=1e-6) and np.allclose(table_, share, atol=1e-6)


def test_scorer_follows_its_gradient_to_the_plain_optimum():
    """The scorer's loss, by plain loops, is as low as that of many more plain steps, and its direction parts the classes."""
    rng = np.random.default_rng(3)
    features = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(200)]
    target = np.array([0.9 if (f < 10).sum() > 1 else 0.1 for f in features])
    weights = [np.full(6, 1 / 6) for _ in features]
    theta = quality.fit_scorer(features, weights, target)
    share = [0.5 / max(1, (target > 0.5).sum()) if t > 0.5 else 0.5 / max(1, (target <= 0.5).sum()) for t in target]

    def loss(w):
        total = 0.0
        for f, t, s in zip(features, target, share):
            p = 1 / (1 + np.exp(-(sum(w[j] / 6 for j in f) + w[-1])))
            total -= s * (t * np.log(p) + (1 - t) * np.log(1 - p))
        return total

    plain = np.zeros(len(theta))
    for _ in range(1500):
        slope = np.zeros(len(theta))
        for f, t, s in zip(features, target, share):
            e = s * (1 / (1 + np.exp(-(plain[f].sum() / 6 + plain[-1]))) - t)
            slope[f] += e / 6
            slope[-1] += e
        plain -= 4.0 * slope
    assert loss(theta) < loss(np.zeros(len(theta))) - 0.05 and loss(theta) < loss(plain) + 0.02


def test_quality_of_odd_rows(spark):
    """Null ids, repeated rows, very long texts and columns of clashing names have results of their own."""
    rng = random.Random(17)
    texts = [prose(rng, 120) for _ in range(60)] + [prose(rng, 60_000), "NULLID"]
    df = table(spark, texts).withColumn("keep", F.lit("x")).withColumn("quality_score", F.lit(7))
    rows = quality.classify(df.unionByName(df.where("doc_id = 3"))).collect()
    assert len(rows) == 63 and {type(r.keep) for r in rows} == {bool} and all(0 <= r.quality_score <= 1 for r in rows)
    assert len({round(r.quality_score, 9) for r in rows if r.doc_id == 3}) == 1 and len({r.keep for r in rows if r.doc_id == 3}) == 1


def test_quality_keeps_prose_and_rejects_junk(spark):
    rng = random.Random(7)
    good = [prose(rng, rng.randrange(60, 200)) for _ in range(150)]
    bad = [" ".join(["spam"] * 100) for _ in range(15)] + [(prose(rng, 80).upper() + "!!").replace(" ", "!! ") for _ in range(15)] + [" | ".join(prose(rng, 60).split()) for _ in range(15)]
    rows = quality.classify(table(spark, good + bad + [None, ""])).collect()
    keep = {r.doc_id: r.keep for r in rows}
    assert np.mean([keep[i] for i in range(150)]) > 0.97 and np.mean([not keep[150 + i] for i in range(45)]) > 0.9
    assert not keep[195] and not keep[196] and rows[0].lang == "en"
    assert quality.classify(table(spark, [])).count() == 0


def test_toxicity_finds_unseen_forms(spark):
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(400):
        w = prose(rng, rng.randrange(20, 120)).split()
        if i % 4 == 0:
            w[rng.randrange(len(w))] = "grumbl" + rng.choice(["ed", "ing", "es", "y", "or", "ax", f"q{i}"])
        texts.append(" ".join(w))
        labels.append((i, 1, int(i % 4 == 0)))
    texts += ["", None]
    rows = {r.doc_id: r for r in toxicity.classify(table(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([rows[i].predicted == int(i % 4 == 0) for i in held]) > 0.95
    assert rows[400].predicted == 0 == rows[401].predicted
    none = toxicity.classify(table(spark, ["a"]), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert none[0].score == 0 and toxicity.classify(table(spark, []), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_toxicity_scores_equal_plain_averages():
    """A document's score, by loops over windows and n-grams, from the model's n-gram values."""
    rng = random.Random(18)
    texts = [prose(rng, rng.randrange(1, 40)) + (" grumbling grumbled" if i % 3 == 0 else "") for i in range(90)]
    model = toxicity.fit(pa.array(texts), np.array([i % 3 == 0 for i in range(90)]))

    def bag(word):
        buckets, at = toxicity.grams([word.encode()])
        return buckets[: at[1]].tolist()

    want = []
    for t in texts + ["", "x"]:
        w = t.split()
        best = []
        for i in range(len(w)):
            g = [x for word in w[i : i + toxicity.WINDOW] for x in bag(word)]
            best.append(sum(model.per_gram[x] for x in g) / max(1, len(g)))
        z = model.scale * (max(best) if best else model.empty) + model.shift
        want.append(1 / (1 + np.exp(-np.clip(z, -50, 50))))
    assert np.allclose(model.score(pa.array(texts + ["", "x"])), want, atol=1e-9)
    assert np.mean([(p >= 0.5) == (i % 3 == 0) for i, p in enumerate(want[:90])]) > 0.95


def test_toxicity_of_odd_rows(spark):
    """Contradictory labels count as toxic; null ids, very long texts and clashing columns are scored."""
    rng = random.Random(19)
    texts = [prose(rng, 30) + (" grumbled grumbling" if i % 4 == 0 else "") for i in range(120)] + [prose(rng, 60_000), "NULLID"]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)] + [(4, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.classify(table(spark, texts).withColumn("predicted", F.lit("x")), labels).collect()
    assert len(rows) == 122 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert next(r for r in rows if r.doc_id == 4).predicted == 1 and next(r for r in rows if r.doc_id == 120).predicted == 0


def test_toxicity_trains_on_present_documents_once_each(spark):
    """Labels without documents and rows that repeat a doc_id leave both labels in the sample."""
    rng = random.Random(9)
    texts = [prose(rng, 30) + (" grumbled grumbling" if i % 4 == 0 else "") for i in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)] + [(i, 1, i % 2) for i in range(1000, 9000)], "doc_id long, quality int, toxic int")
    twice = table(spark, texts)
    for i in [i for i in range(120) if i % 4 and zlib.crc32(str(i).encode()) % 5][:3]:
        twice = twice.unionByName(table(spark, [texts[i]] * 1000).drop("doc_id").withColumn("doc_id", F.lit(i).cast("long")))
    got = {r.doc_id: r.predicted for r in toxicity.classify(twice, labels, sample=40).collect()}
    assert np.mean([got[i] == int(i % 4 == 0) for i in range(120)]) > 0.95


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the tables")
def test_pipeline_stages_agree_with_brute_force(spark):
    """Each stage keeps columns and only takes what its operator rejects; packed tokens are those of the last texts."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == columns, name
        before, after = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in out.collect()}
        assert set(after) <= set(before) and len(after) == out.count()
        if name == "substring dedup":
            seen = set()
            for i in sorted(before):
                w = WORDS.findall(before[i].encode())
                gone = [False] * len(w)
                for s in range(len(w) - 19):
                    key = tuple(w[s : s + 20])
                    if key in seen:
                        gone[s : s + 20] = [True] * 20
                    seen.add(key)
                want = b" ".join(x for x, g in zip(w, gone) if not g).decode() if any(gone) else before[i]
                assert after[i] == want
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    encode = Encoder(WORD)
    assert sum(r.length for r in packed) == sum(len(encode.tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in after.values())
