"""Substring dedup (8): winnowed anchors joined across documents, extended both ways, repeats over the length threshold removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from waymark.llm.arrowtext import BASES, Spans, flat, ragged, signed, sliced, word_hashes, words
from waymark.llm.runtime import large, prepared, written

#: Words of an anchor. Of the windows of `length` words, each picks the least of its length - ANCHOR + 1 anchors.
ANCHOR = 8
#: One of so many documents is looked at for hot anchors; these are so many of their most frequent anchors at most, with so many runs or more each.
LOOKED_AT, HOT, OFTEN = 64, 2_000, 16
ANCHORS = "anchor bigint, extent bigint, doc_id bigint, start bigint, windows int, kind int, of_doc bigint, of_start bigint"
RANGES = "doc_id bigint, start bigint, windows int, kind int, of_doc bigint, of_start bigint"
WINDOWS = "w1 bigint, w2 bigint, doc_id bigint, start bigint, of_doc bigint, of_start bigint"
MATCHES = "doc_id bigint, start bigint, of_doc bigint, of_start bigint"
REPEATS = "array<struct<start: bigint, words: bigint, of_doc: bigint, of_start: bigint>>"
#: Kinds of runs of windows: those that start earlier elsewhere, those to be extended word by word, and seeds.
REPEATED, OPEN, SEED = 0, 1, 2


class Sequence:
    """Words of a batch of texts, with hashes of any span of them."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = flat(texts)
        self.starts, self.ends, self.at = words(self.data, self.offsets)
        high, low = word_hashes(self.data, self.starts, self.ends)
        self.one, self.two = Spans(low, BASES[0]), Spans(high, BASES[1])


def anchors(seq: Sequence, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: anchor hash, hash of all words that the run covers, first window, number of windows.

    A window's anchor is the least hash of its ANCHOR-word spans, the last one of equal ones: the window's words alone decide, so equal
    windows have equal anchors. It never moves back from one window to the next, so runs are contiguous.
    """
    n = len(seq.starts)
    none = np.empty(0, np.int64)
    if n < length:
        return none, none, none, none
    k = min(ANCHOR, length)
    spots = np.arange(n - k + 1)
    hashes = seq.one.of(spots, spots + k)
    best, where = hashes, spots
    reach, want = 1, length - k + 1
    while reach < want:
        step = min(reach, want - reach)
        a, b = slice(None, len(best) - step), slice(step, None)
        later = best[b] <= best[a]
        best, where = np.where(later, best[b], best[a]), np.where(later, where[b], where[a])
        reach += step
    doc_end = np.repeat(seq.at[1:], np.diff(seq.at))
    windows = np.flatnonzero(np.arange(n - length + 1) + length <= doc_end[: n - length + 1])
    if not len(windows):
        return none, none, none, none
    own = where[windows]
    head = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (windows[1:] != windows[:-1] + 1)))
    first = windows[head]
    count = np.diff(np.append(head, len(windows)))
    end = first + count - 1 + length
    # Where the anchor stands and how far the run reaches are part of the extent: equal extents hold equal windows.
    extent = seq.two.of(first, end) ^ ((own[head] - first).astype(np.uint64) << np.uint64(32) | count.astype(np.uint64)) * np.uint64(BASES[0])
    return signed(best[first]), signed(extent), first, count


def later_ones(keys: list[np.ndarray], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (keys, doc, start), and in that order whether a row of the same keys stands earlier, and the place of the earliest."""
    order = np.lexsort((start, doc, *keys[::-1]))
    d, s = doc[order], start[order]
    head = np.ones(len(order), bool)
    for k in keys:
        head[1:] &= k[order][1:] == k[order][:-1]
    head[1:] = ~head[1:]
    head[:1] = True
    first = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    return order, (d > d[first]) | ((d == d[first]) & (s > s[first])), first


def batch_of(columns: list, names: str) -> pa.RecordBatch:
    fields = [c.split() for c in names.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32()}
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def seeded(batches: Iterator[pa.RecordBatch], length: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Seeds: anchor runs of whole texts. Runs whose extent stands earlier in the same batch are told at once, and runs of
    hot anchors go on to be extended: neither has an anchor to be joined on."""
    for batch in sliced(batches, "text"):
        seq = Sequence(batch.column("text"))
        anchor, extent, first, count = anchors(seq, length)
        if not len(anchor):
            continue
        of = np.searchsorted(seq.at, first, side="right") - 1
        doc, start = batch.column("doc_id").to_numpy()[of], first - seq.at[of]
        order, known, lead = later_ones([anchor, extent], doc, start)
        anchor, doc, start = anchor[order], doc[order], start[order]
        kind = np.where(known, REPEATED, np.where(np.isin(anchor, hot), OPEN, SEED)).astype(np.int32)
        yield batch_of([pa.array(anchor, mask=kind != SEED), extent[order], doc, start, count[order], kind, doc[lead], start[lead]], ANCHORS)


def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The join of seeds sorted by (anchor, extent, doc_id, start): what each run is; constant memory, whatever an anchor's rows.

    A run after the first of its extent repeats that one as a whole. A first run is open if the anchor has another extent; whether it has is
    known from its neighbours: the row before with the same anchor, or the next first row.
    """
    anchor = extent = None
    lead: tuple = (0, 0)  # document and start of the extent's first run
    waiting: tuple | None = None  # the only first run of the anchor so far, not yet known to have company
    company = False
    for batch in batches:
        told = batch.filter(batch.column("anchor").is_null())
        if told.num_rows:
            yield batch_of([told.column(c) for c in ("doc_id", "start", "windows", "kind", "of_doc", "of_start")], RANGES)
        rest = batch.filter(batch.column("anchor").is_valid())
        if not rest.num_rows:
            continue
        a, e, d, s, n = (rest.column(c).to_numpy() for c in ("anchor", "extent", "doc_id", "start", "windows"))
        new_a, new_e = np.ones(len(a), bool), np.ones(len(a), bool)
        new_a[1:] = a[1:] != a[:-1]
        new_a[0] = a[0] != anchor
        new_e[1:] = new_a[1:] | (e[1:] != e[:-1])
        new_e[0] = new_a[0] or e[0] != extent
        at = np.maximum.accumulate(np.where(new_e, np.arange(len(a)), -1))
        fd, fs = np.where(at < 0, lead[0], d[at]), np.where(at < 0, lead[1], s[at])
        later = ~new_e & ((d > fd) | ((d == fd) & (s > fs)))
        group = np.cumsum(new_a)  # 0: the anchor of the rows before
        heads = np.bincount(group[new_e], minlength=group[-1] + 1)
        before = 0 if anchor is None else 2 if company else 1
        open_ = new_e & (np.where(group == 0, heads[0] + before, heads[group]) > 1)
        if waiting and heads[0]:
            yield batch_of([np.array([x]) for x in (*waiting, OPEN, waiting[0], waiting[1])], RANGES)
        out = np.flatnonzero(later | open_)
        yield batch_of([d[out], s[out], n[out], np.where(later[out], REPEATED, OPEN).astype(np.int32), fd[out], fs[out]], RANGES)
        anchor, extent, lead = a[-1], e[-1], (int(fd[-1]), int(fs[-1]))
        if group[-1]:
            company = heads[-1] > 1
            only = int(np.flatnonzero(new_a)[-1])
            waiting = None if company else (d[only], s[only], n[only])
        elif heads[0]:
            company, waiting = True, None


def opened(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Extensions of open runs: each takes the anchor some words to the left and the rest of `length` to the right, and is known by a hash.

    Of equal ones in a batch only the first goes on, the others are told at once (w1 null).
    """
    for batch in sliced(batches, "text"):
        seq = Sequence(batch.column("text"))
        starts, counts = batch.column("starts"), batch.column("counts")
        rows = np.repeat(np.arange(batch.num_rows), np.diff(starts.offsets.to_numpy()))
        first, count = starts.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
        start = ragged(first, count)
        of = np.repeat(rows, count)
        spot = start + seq.at[of]
        ok = spot + length <= seq.at[of + 1]  # rows that repeat an id may have another text
        start, of, spot = start[ok], of[ok], spot[ok]
        doc = batch.column("doc_id").to_numpy()[of]
        w1, w2 = signed(seq.one.of(spot, spot + length)), signed(seq.two.of(spot, spot + length))
        order, known, lead = later_ones([w1, w2], doc, start)
        doc, start = doc[order], start[order]
        yield batch_of([pa.array(w1[order], mask=known), w2[order], doc, start, doc[lead], start[lead]], WINDOWS)


def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Extensions that have an equal one earlier, with the first of these; rows sorted by (w1, w2, doc_id, start). Constant memory."""
    last, first = None, (0, 0)
    for batch in batches:
        w1, w2, doc, start = (batch.column(c).to_numpy() for c in ("w1", "w2", "doc_id", "start"))
        if not len(w1):
            continue
        head = np.ones(len(w1), bool)
        head[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        head[0] = (w1[0], w2[0]) != last
        at = np.maximum.accumulate(np.where(head, np.arange(len(w1)), -1))
        fd, fs = np.where(at < 0, first[0], doc[at]), np.where(at < 0, first[1], start[at])
        later = (doc > fd) | ((doc == fd) & (start > fs))
        last, first = (w1[-1], w2[-1]), (int(fd[-1]), int(fs[-1]))
        yield batch_of([doc[later], start[later], fd[later], fs[later]], MATCHES)


def maximal(row: np.ndarray, start: np.ndarray, windows: np.ndarray, of_doc: np.ndarray, of_start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Matches of windows that go on from one another, in one row and with one earlier document at one distance, as one: the same columns, by row and start."""
    shift = start - of_start
    order = np.lexsort((start, shift, of_doc, row))
    row, start, windows, of_doc, of_start, shift = (x[order] for x in (row, start, windows, of_doc, of_start, shift))
    if not len(row):
        return row, start, windows, of_doc, of_start
    other = np.ones(len(row), bool)
    other[1:] = (row[1:] != row[:-1]) | (of_doc[1:] != of_doc[:-1]) | (shift[1:] != shift[:-1])
    line = np.cumsum(other)
    end = start + windows
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + line * span) - line * span  # the farthest end of the line so far
    head = other.copy()
    head[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(head)
    tail = np.append(at[1:], len(row)) - 1
    row, first, of_doc, of_start, windows = row[at], start[at], of_doc[at], of_start[at], reach[tail] - start[at]
    order = np.lexsort((first, row))
    return tuple(x[order] for x in (row, first, windows, of_doc, of_start))


def cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Texts without the words that maximal repeats cover: columns of the batch but found, then the counts, both forms and the repeats."""
    for batch in sliced(batches, "text"):
        data, offsets = flat(batch.column("text"))
        starts, ends, at = words(data, offsets)
        gone = np.zeros(len(starts) + 1, np.int64)
        found = batch.column("found")
        row = np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
        row, first, count, of_doc, of_start = maximal(row, *(found.flatten().field(i).to_numpy().astype(np.int64) for i in range(4)))
        low = np.minimum(first + at[row], at[row + 1])
        high = np.minimum(low + count - 1 + length, at[row + 1])
        np.add.at(gone, low, 1)
        np.add.at(gone, high, -1)
        keep = np.cumsum(gone)[:-1] == 0
        kept_n = np.diff(np.append(0, np.cumsum(keep))[at])
        size = (ends - starts)[keep] + 1
        spots = ragged(starts[keep], size)
        packed = np.where(spots < len(data), data[np.minimum(spots, max(len(data) - 1, 0))], 32).astype(np.uint8) if len(spots) else np.empty(0, np.uint8)
        last = np.cumsum(size) - 1
        packed[last] = 32
        edge = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(kept_n))]
        raw = packed.tobytes()
        texts = [raw[a : max(a, b - 1)] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
        n = np.diff(at)
        rest = [(batch.column(c), c) for c in batch.schema.names if c != "found"]
        spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (first, high - low, of_doc, of_start)], names=["start", "words", "of_doc", "of_start"])
        extra = [
            (pa.array(n), "n_words"), (pa.array(n - kept_n), "n_removed"),
            (pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()), "kept_sha256"),
            (pa.array([t.decode() for t in texts], pa.string()), "kept_text"),
            (pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32()), spans), "repeats"),
        ]
        yield pa.RecordBatch.from_arrays([c for c, _ in rest + extra], names=[c for _, c in rest + extra])


def hot_anchors(documents: DataFrame, length: int) -> np.ndarray:
    """The most frequent anchors of one in LOOKED_AT documents. They only choose a run's way, not its result."""
    some = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(LOOKED_AT)) == 0)
    counts = some.mapInArrow(lambda it: seeded(it, length, np.empty(0, np.int64)), ANCHORS).groupBy("anchor").agg(F.count("*").alias("n"))
    most = counts.where(F.col("anchor").isNotNull() & (F.col("n") >= OFTEN)).orderBy(F.desc("n"), "anchor").limit(HOT).collect()
    return np.array([r["anchor"] for r in most], np.int64)


def repeats(documents: DataFrame, length: int) -> DataFrame:
    """(doc_id, start, windows, of_doc, of_start): runs of windows, and the earlier place whose windows they repeat.

    Seed: each run of windows with one winnowed anchor is a row, and documents are joined on anchors. Extend: within an anchor, runs with equal
    words all round are told by one comparison; runs that differ somewhere are extended by each number of words to the left and the
    rest to the right, and each extension finds its first equal one. Equal rows of a batch are reduced to their first before
    they are dealt, so a passage in very many documents brings one row for each batch and not for each document; an anchor in
    very many contexts skips the join, as its extensions are dealt by all their words.
    """
    hot = hot_anchors(documents, length)
    seeds = documents.mapInArrow(lambda it: seeded(it, length, hot), ANCHORS)
    dealt = seeds.repartition(F.coalesce("anchor", F.xxhash64("doc_id", "start"))).sortWithinPartitions("anchor", "extent", "doc_id", "start")
    ranges = written(dealt.mapInArrow(extended, RANGES), "ranges")
    open_ = ranges.where(F.col("kind") == OPEN).groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows")).alias("r"))
    with_text = documents.join(large(open_), "doc_id").select("doc_id", "text", F.col("r.start").alias("starts"), F.col("r.windows").alias("counts"))
    windows = written(with_text.mapInArrow(lambda it: opened(it, length), WINDOWS), "windows")
    own = windows.where("w1 is null").select("doc_id", "start", "of_doc", "of_start")
    over = windows.where("w1 is not null").select("w1", "w2", "doc_id", "start").repartition("w1", "w2").sortWithinPartitions("w1", "w2", "doc_id", "start").mapInArrow(settled, MATCHES)
    single = own.unionByName(over).select("doc_id", "start", F.lit(1).alias("windows"), "of_doc", "of_start")
    return ranges.where(F.col("kind") == REPEATED).select("doc_id", "start", "windows", "of_doc", "of_start").unionByName(single)


def remove_repeats(documents: DataFrame, length: int = 20) -> DataFrame:
    """documents with n_words, n_removed, kept_sha256, kept_text (the text's words without those that an earlier window repeats) and repeats.

    A window is `length` consecutive words of one document (split at 0x20 and 0x09-0x0D). It is a repeat if its words also
    start at a smaller doc_id or earlier in the same document; all words that a repeat covers go. Windows are
    compared by 128-bit hashes of their words, over all documents. repeats lists the document's maximal repeats of `length` words or more: first
    word, number of words, and the document and word where an earlier occurrence starts (the first one known to the step that found it).

    Null or empty text: no words, kept_text is empty, no repeats. A null doc_id: the row stays whole and makes no other a repeat. Rows that share
    an id precede one another only by their start; each loses what any of them repeats. Other columns stay; the five new names
    and found replace columns of the same names. An empty table gives no rows.
    """
    documents = prepared(documents).drop("n_words", "n_removed", "kept_sha256", "kept_text", "repeats", "found")
    known = documents.where("doc_id is not null").select("doc_id", "text")
    parts = ("start", "windows", "of_doc", "of_start")
    ranges = repeats(known, length).groupBy("doc_id").agg(F.collect_list(F.struct(*parts)).alias("found"))
    none = F.array().cast("array<struct<start: bigint, windows: int, of_doc: bigint, of_start: bigint>>")
    joined = documents.join(large(ranges), "doc_id", "left").select(*documents.columns, F.coalesce("found", none).alias("found"))
    added = T._parse_datatype_string(f"n_words bigint, n_removed bigint, kept_sha256 string, kept_text string, repeats {REPEATS}")
    return joined.mapInArrow(lambda it: cut(it, length), StructType([*documents.schema.fields, *added.fields]))
