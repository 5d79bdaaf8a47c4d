"""Mixing, alignment and phrases against plain Python; searches of vectors whose norms differ; stages over tables with odd columns."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waymark.llm import align, graph_search, mixing, phrases
from waymark.llm.tokens import byte_letters

public_tokenizers = pytest.importorskip("public_tokenizers")
FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))
ODD = ["", " ", None, "a  b\n\nc ", "x<|endoftext|> y <s> </s>", "naïve Ünïcode ΟΔΟΣ 日本語 テキスト", "é a b  c　 d", "x" * 5000, "don't I'm 12345 ½", "\t\r\n", "aaaa aaa aa a" * 50, "▁ x", "a\x00b c", "   ", "\n  \n x  "]
SCHEMA = "doc_id long, text string, lang string, source string, n string, size string, row string, hash string, part string, phrase string, block string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "n", "s", "r", "h", "p", "q", "b") for r in rows], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def targets(sizes, weights=(5, 2, 1), most=3):
    """By the rule's own words: share by weight, stop at most times the size, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), float(sum(sizes.values()))
    while left > 1e-9:
        able = [s for s in names if target[s] < most * sizes[s]]
        total = sum(weight[s] for s in able)
        given = {s: min(most * sizes[s] - target[s], left * weight[s] / total) for s in able}
        for s, x in given.items():
            target[s] += x
        left -= sum(given.values())
    return target


def mixed_rows(seed=3):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" for _ in range(int(rng.paretovariate(0.9) * 3) % 3000)), "en", rng.choice(["b", "b", "b", "b", "a", "c", "é", "Z", None])) for i in range(600)]
    rows += [(1000 + i, t, None, "odd") for i, t in enumerate(ODD)]
    rows += [(2000, "one two three", "en", "rep")] * 40 + [(None, "no id here", "en", "rep")] * 5 + [(3000 + i, "same size text", "en", "hot") for i in range(900)] + [(4000, "", "en", "none"), (4001, None, "en", "none")]
    return rows


def test_mixing_meets_its_targets(spark):
    rows = mixed_rows()
    got = mixing.mix(docs(spark, rows)).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(i), len(words(t))) for i, t, _, _ in rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    want = targets(sizes)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s, t in want.items():
        smallest = min([len(words(x)) for _, x, _, y in rows if y == s and words(x)], default=0)
        assert abs(taken[s] - t) <= max(0.02 * t, 2 * smallest), (s, taken[s], t)
    again = mixing.mix(docs(spark, random.Random(1).sample(rows, len(rows))).repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.source or "", r["size"], r.taken, r.target, r.rate)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_mixing_rates_solve_the_convex_dual(spark):
    """rates are min(3, exp(tilt * size)) with one tilt for each source, and their words are the target: the optimality conditions of the problem."""
    got = [r for r in mixing.mix(docs(spark, mixed_rows(4))).collect() if r["size"]]
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r.rate * r["size"] for r in own) == pytest.approx(own[0].target, rel=1e-6)
        tilts = [np.log(r.rate) / r["size"] for r in own if 1e-300 < r.rate < 3]
        assert not tilts or max(tilts) - min(tilts) <= 1e-9 * max(1e-3, abs(max(tilts, key=abs)))
        if tilts and any(r.rate >= 3 for r in own):
            assert min(r["size"] for r in own if r.rate >= 3) * max(tilts) >= np.log(3) - 1e-9


def test_mixing_of_nothing(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert [(r.taken, r.target) for r in mixing.mix(docs(spark, [(1, None, "en", None), (2, " ", "en", "a")])).collect()] == [(0, 0.0)] * 2
    one = mixing.mix(docs(spark, [(1, "a b c", "en", None)])).collect()
    assert [(r.doc_id, r.taken, r.target, r.source) for r in one] == [(1, 3, 3.0, None)]


def aligned_by_hand(texts, how="end"):
    """The rows that align() has to give, from the two libraries and plain Python; overlap takes tokens that share a byte."""
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer, pieces = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[3])
    tokenizer.encode_special_tokens = True
    letters = {c: b for b, c in byte_letters().items()}
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in tokenizer.get_vocab().items() if all(c in letters for c in t)}
    b_bytes = lambda i: bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
    rows, count = [], Counter()
    for text in texts:
        a, b = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids, pieces.encode(text or "")
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in a) != raw or b"".join(map(b_bytes, b)) != raw:
            rows.append((0, 0, [], []))
            continue
        ends = [np.cumsum([len(x) for x in part]).tolist() for part in ([a_bytes[i] for i in a], [b_bytes(i) for i in b])]
        if how == "end":
            links = [(x, y) for x, e in zip(a, ends[0]) for y, f in zip(b, ends[1]) if e == f]
        else:
            starts = [[0, *e[:-1]] for e in ends]
            links = [(x, y) for x, s, e in zip(a, starts[0], ends[0]) for y, t, f in zip(b, starts[1], ends[1]) if s < f and t < e]
        groups, at = [], (0, 0)
        for c in sorted(set(ends[0]) & set(ends[1])):
            end = (ends[0].index(c) + 1, ends[1].index(c) + 1)
            groups.append(",".join(map(str, a[at[0] : end[0]])) + "|" + ",".join(map(str, b[at[1] : end[1]])))
            at = end
        count.update(links)
        rows.append((len(a), len(b), groups, links))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    digest = lambda g: hashlib.sha256(";".join(g).encode()).hexdigest() if g else ""
    return [(a, b, len(g), len(k), sum(count[p] == most[p[1]] for p in k), sum(count[p] for p in k), digest(g)) for a, b, g, k in rows]


@pytest.mark.parametrize("how", ["end", "overlap"])
def test_alignment_equals_plain_python(spark, how, monkeypatch):
    rng = random.Random(5)
    texts = ODD[:7] + ["x" * 300, *ODD[8:]] + [" ".join(rng.choice(["Lake", "garden's", "unbelievable", "x1y2", "Hyderabad", "日本", "<|endoftext|>", "tokenisation,", "\n", ""]) for _ in range(rng.randrange(60))) for _ in range(40)]
    texts += texts[-6:]
    monkeypatch.setattr(align, "BLOCK", 300)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, "no id", "en", "s")]
    got = align.align(docs(spark, rows).repartition(3), *FILES, how).collect()
    want = aligned_by_hand([*texts, "no id"], how)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r.doc_id: tuple(r[n] for n in names) for r in got} == dict(zip([*range(len(texts)), None], want)) and len(got) == len(want)
    assert align.align(docs(spark, []), *FILES).count() == 0


def test_alignment_forgets_units_without_a_trace(spark):
    known = align.Aligner(*FILES, "end")
    text = b" one two three one"
    first = known.units(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    facts = known.facts[first[2]].copy()
    known.clear()
    again = known.units(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert (known.facts[again[2]] == facts).all() and facts[:, 4].all()


def mined_by_hand(rows, longest=4, least=30, percent=80, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, total = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    frequent = {p: a for p, a in counts.items() if a >= least}
    out = []
    for (lang, w), a in frequent.items():
        if len(w) < 2 or any(l2 == lang and len(v) > len(w) and 100 * f >= percent * a and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1)) for (l2, v), f in frequent.items()):
            continue
        cuts = [(2_000_000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, " ".join(w), a, counts[lang, w[:k]], counts[lang, w[k:]], total[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(x[0], i, *x[1:]) for i, x in enumerate(own[:top], 1)]
    return ranked


@pytest.mark.parametrize("top", [2000, 7])
def test_phrases_equal_plain_python(spark, top, monkeypatch):
    rng = random.Random(6)
    pool = ["New", "york", "City", "of", "the", "lake", "é́t", "side", "walk", "日本", "don't", "a"]
    piece = lambda: " ".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) + rng.choice([".", ", ", "\n", "\x0b", "\t", " ", "!", "  "])
    rows = [(i, "".join(piece() for _ in range(rng.randrange(12))) + rng.choice(["", "new york city of the lake side. "]), rng.choice(["en", "en", "de", None, "und"]), "s") for i in range(300)]
    rows += [(900 + i, t, None, "s") for i, t in enumerate(ODD)] + [(None, "new york city", "en", "s")] * 3
    monkeypatch.setattr(phrases, "BATCH", 2000)
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = sorted(mined_by_hand(rows, least=12, top=top))
    for bits in (16, 1):  # few bits let many phrases through that are not frequent: no result changes
        monkeypatch.setattr(phrases, "BITS", bits)
        monkeypatch.setattr(phrases, "LEAST_BITS", 1 << 12 if bits == 16 else 64)
        got = sorted(tuple(r[n] for n in names) for r in phrases.collocations(docs(spark, rows).repartition(3), least=12, top=top).collect())
        assert got == want and len(want) > 10
    assert phrases.collocations(docs(spark, [])).count() == 0
    assert phrases.collocations(docs(spark, [(1, "too few words", "en", "s")])).count() == 0


def test_phrases_score_exactly_beyond_64_bits(spark):
    big = 10**17
    level = lambda rows: spark.createDataFrame(rows, "lang string, phrase string, n long")
    tables = [level([("en", "a", big + 1), ("en", "b", big + 7)]), level([("en", "a b", big)])]
    assert [tuple(r) for r in phrases.cut_scores(tables).collect()] == [("en", "a b", big, big + 1, big + 7, 2_000_000 * big // (2 * big + 8))]


def recall(spark, vectors, shard=16_384):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = graph_search.search(df, shard=shard).collect()
    score = vectors[::20] @ vectors.T
    met = 0
    for q in range(len(score)):
        score[q, 20 * q] = -np.inf
        best = set(sorted(range(len(vectors)), key=lambda i: (-score[q, i], i))[:20])
        met += len(best & {r.vec_id for r in got if r.query_id == 20 * q})
    for r in got[:200]:
        assert r.score == pytest.approx(float(vectors[r.query_id] @ vectors[r.vec_id]), rel=1e-12)
    return met / (20 * len(score))


@pytest.mark.parametrize("norms", ["one long", "three huge", "spread"])
def test_graph_search_with_differing_norms(spark, norms):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(1500, 32)) + 2 * rng.normal(size=(30, 32))[rng.integers(0, 30, 1500)]
    v /= np.sqrt((v**2).sum(1))[:, None]
    if norms == "one long":
        v[77] *= 10_000
    elif norms == "three huge":
        v[[5, 600, 1400]] *= 1e25
    else:
        v *= 10 ** rng.uniform(0, 6, (1500, 1))
    assert recall(spark, v) >= 0.9


def test_near_duplicate_stage_takes_any_columns(spark):
    text = "the same text of quite a few words that stands here more than once in the table of documents"
    rows = [(1, text), (1, text), (2, text), (3, "another text"), (None, "no id"), (None, "no id"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"facts": F.create_map(F.lit("k"), F.col("text")), "__row_key": F.lit(9), "row": F.lit("r"), "row_key": F.lit(2.5), "raw": F.lit(b"x")})
    got = corpus_pipeline.near_duplicate_stage(spark, df, "").select(df.columns)
    assert got.dtypes == df.dtypes
    assert sorted((str(r.doc_id), r.text or "", r["__row_key"], r.row, r.row_key) for r in got.collect()) == [("1", text, 9, "r", 2.5), ("3", "another text", 9, "r", 2.5), ("4", "", 9, "r", 2.5), ("None", "no id", 9, "r", 2.5)]
