"""Phrase collocation mining (13): level-wise counting of word sequences, each level only where both shorter ones are frequent."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.llm.arrowtext import BASES, LOWER, U64, Spans, distinct_words, flat, hash128, mixed, sliced, words
from waymark.llm.runtime import prepared, written

BATCH = 4 << 20
#: Bits for each frequent phrase in what is broadcast, and at most: 32 MB however much the corpus holds.
BITS, LEAST_BITS, MOST_BITS = 16, 1 << 12, 1 << 28
#: Parts in which a language's phrases are ranked before the best of each meet.
PARTS = 64
COUNTED = "lang string, phrase string, n bigint"
SET = "word bigint, bits bigint"
#: Ends of pieces: . , ; : ! ? and the line breaks 0x0A-0x0D. Words end there, at spaces and at tabs.
STOP = np.zeros(256, bool)
STOP[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
TEXT = LOWER.copy()
TEXT[STOP] = 0x20
SCALE = 2_000_000


class Phrases:
    """Words of a batch of texts with their languages, and hashes of any run of them."""

    def __init__(self, texts: pa.Array, langs: list[str]):
        raw, self.offsets = flat(texts)
        self.data = TEXT[raw]
        self.starts, self.ends, at = words(self.data, self.offsets)
        of = np.repeat(np.arange(len(langs)), np.diff(at))
        # Words of one piece have as many stops before them, and stand in one document.
        self.piece = np.searchsorted(np.flatnonzero(STOP[raw]), self.starts) + of
        self.form, self.forms = distinct_words(self.data, self.starts, self.ends)
        self.langs = sorted(set(langs))
        number = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.fromiter((number[x] for x in langs), np.int64, len(langs))[of]
        _, low = hash128(self.forms) if self.forms else (None, np.empty(0, U64))
        self.spans = Spans(low[self.form], BASES[0])
        self.seed = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in self.langs], U64)

    def hashes(self, at: np.ndarray, k: int) -> np.ndarray:
        """Hash of the k words from each place on, in their language."""
        return mixed(self.spans.of(at, at + k) ^ self.seed[self.lang[at]])

    def whole(self, k: int) -> np.ndarray:
        """Places from which k words lie in one piece."""
        n = len(self.starts) - k + 1
        return np.flatnonzero(self.piece[: max(0, n)] == self.piece[k - 1 :]) if n > 0 else np.empty(0, np.int64)

    def counted(self, at: np.ndarray, k: int) -> pa.RecordBatch:
        """Distinct phrases of k words at these places, and how often each stands there."""
        code = self.lang[at]
        for i in range(k):
            code, first, again, count = np.unique(code * (len(self.forms) + 1) + self.form[at + i], return_index=True, return_inverse=True, return_counts=True)
            if i < k - 1:
                code = again
        where = at[first]
        forms = pa.array(self.forms, pa.binary()).cast(pa.string())
        columns = [forms.take(pa.array(self.form[where + i])) for i in range(k)]
        phrase = pc.binary_join_element_wise(*columns, " ") if k > 1 else columns[0]
        return pa.RecordBatch.from_arrays([pa.array(self.langs, pa.string()).take(pa.array(self.lang[where])), phrase, pa.array(count)], names=["lang", "phrase", "n"])


def phrases_of(batch: pa.RecordBatch) -> Phrases:
    return Phrases(batch.column("text"), pc.fill_null(batch.column("lang"), "und").to_pylist())


def level(batches: Iterator[pa.RecordBatch], k: int, frequent) -> Iterator[pa.RecordBatch]:
    """Phrases of k words whose first and last k - 1 words are in the broadcast set of frequent ones, counted for each batch of whole texts."""
    bits = frequent.value if frequent is not None else None
    for batch in sliced(batches, "text", BATCH):
        found = phrases_of(batch)
        at = found.whole(k)
        if bits is not None and len(at):
            left = held(bits, found.hashes(at, k - 1))
            at = at[left]
            at = at[held(bits, found.hashes(at + 1, k - 1))]
        if len(at):
            yield found.counted(at, k)


def held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    spot = hashes & U64(len(bits) * 64 - 1)
    return (bits[(spot >> U64(6)).astype(np.int64)] >> (spot & U64(63))) & U64(1) > 0


def spots(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Words of a set of `size` bits with the bits of a batch's phrases."""
    for batch in sliced(batches, "phrase", BATCH):
        found = Phrases(batch.column("phrase"), batch.column("lang").to_pylist())
        first = np.flatnonzero(np.append(True, found.piece[1:] != found.piece[:-1])) if len(found.piece) else np.empty(0, np.int64)
        count = np.diff(np.append(first, len(found.piece)))
        spot = np.unique(np.concatenate([np.empty(0, U64), *(found.hashes(first[count == k], k) & U64(size - 1) for k in np.unique(count).tolist())]))
        word, at = np.unique(spot >> U64(6), return_index=True)
        bits = np.bitwise_or.reduceat(U64(1) << (spot & U64(63)), at) if len(at) else spot
        yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(bits.view(np.int64))], names=["word", "bits"])


def broadcast_set(phrases: DataFrame):
    """The frequent phrases as bits at their hashes, broadcast: a superset of them, of bounded size. Counts, not bits, decide in the end."""
    count, size = phrases.count(), LEAST_BITS
    while size < min(count * BITS, MOST_BITS):
        size *= 2
    rows = phrases.select("lang", "phrase").mapInArrow(lambda it: spots(it, size), SET).groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    bits = np.zeros(size // 64, np.int64)
    bits[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return phrases.sparkSession.sparkContext.broadcast(bits.view(U64))


def levels(documents: DataFrame, longest: int, least: int) -> tuple[DataFrame, list[DataFrame]]:
    """n of each language, and the tables (lang, phrase, n) of the frequent phrases of 1, 2, ... longest words."""
    docs = prepared(documents.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")))
    all_words = written(docs.mapInArrow(lambda it: level(it, 1, None), COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words")
    total = written(all_words.groupBy("lang").agg(F.sum("n").alias("words")), "totals")
    tables = [written(all_words.where(F.col("n") >= least), "level-1")]
    for k in range(2, longest + 1):
        frequent = broadcast_set(tables[-1])
        emitted = docs.mapInArrow(lambda it, k=k, frequent=frequent: level(it, k, frequent), COUNTED)
        tables.append(written(emitted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least), f"level-{k}"))
        frequent.destroy()
    return total, tables


def first_words(k: int) -> Column:
    return F.substring_index("phrase", " ", k)


def last_words(k: int) -> Column:
    return F.substring_index("phrase", " ", -k)


def cut_scores(tables: list[DataFrame]) -> DataFrame:
    """lang, phrase, a, l, r, score of every phrase of two and more words, at its lowest-scoring cut; ties to the first cut. All integers are exact."""
    found = []
    for size, table in enumerate(tables[1:], 2):
        cuts = table.select("lang", "phrase", F.col("n").alias("a"))
        for k in range(1, size):
            for side, name, part in ((k, "l", first_words(k)), (size - k, "r", last_words(size - k))):
                counts = tables[side - 1].select("lang", F.col("phrase").alias("part"), F.col("n").alias(f"{name}{k}"))
                cuts = cuts.withColumn("part", part).join(counts, ["lang", "part"]).drop("part")
        wide = lambda x: x.cast("decimal(20,0)")
        score = lambda k: F.expr(f"(cast(a as decimal(20,0)) * {SCALE}BD) div (cast(l{k} as decimal(20,0)) + cast(r{k} as decimal(20,0)))")
        each = [F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)]
        best = F.least(*each) if len(each) > 1 else each[0]
        found.append(cuts.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def swallowed(tables: list[DataFrame], percent: int) -> DataFrame:
    """lang, phrase of those that lie in a longer phrase which stands percent of 100 times as often at least.

    A phrase stands as often as any that holds it, at least, so one more word on either side is all that has to be asked.
    """
    found = None
    for size, table in enumerate(tables[2:], 2):
        for part in (first_words(size), last_words(size)):
            one = table.select("lang", part.alias("phrase"), F.col("n").alias("longer"))
            found = one if found is None else found.unionByName(one)
    own = None
    for table in tables[1:-1]:
        own = table if own is None else own.unionByName(table)
    most = found.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    enough = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("n").cast("decimal(20,0)") * percent
    return own.join(most, ["lang", "phrase"]).where(enough).select("lang", "phrase")


def collocations(documents: DataFrame, longest: int = 4, least: int = 30, percent: int = 80, top: int = 2000) -> DataFrame:
    """The first `top` phrases of 2 to `longest` words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split at . , ; : ! ? and line breaks into pieces, and these at spaces and tabs into words; phrases lie within a
    piece. A null lang is `und`. A null or empty text has no words; repeated rows count each; a language without a phrase that stands
    `least` times has no rows, nor has an empty table; other columns are ignored. Ties of score and count go by the phrase's bytes.

    Each level reads the texts again and emits a phrase only where both phrases of one word less are in the broadcast set, so what is shuffled
    is one row for each batch and distinct phrase. The set is bits at hashes, 32 MB at most: it lets some phrases through that
    are not frequent, which their exact counts drop, and never holds one back that is.
    """
    total, tables = levels(documents, longest, least)
    scored = cut_scores(tables)
    if longest > 2:
        scored = scored.join(swallowed(tables, percent), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part")
    some = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
