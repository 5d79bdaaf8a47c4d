"""BPE encoding and decoding (3): content-defined chunks encoded once, joined by re-encoding until exact agreement."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.arrowtext import distinct_spans, flat, mixed, ragged, sliced
from waymark.llm.runtime import prepared
from waymark.llm.tokens import Encoder, byte_letters, encoder

#: Bits of the rolling hash that are 0 at a cut: chunks of 2 KiB on average. The hash sees the last 32 bytes.
CUT_BITS, WINDOW = 11, 32
#: Chunk ids that a worker keeps beside the shared ones; past it the table starts anew, which changes no result.
KEPT_IDS = 4_000_000
#: Chunks that all workers share: so many at most, with so many bytes together, of so many bytes each. They are those that save the most.
SHARED, SHARED_BYTES, SHARED_EACH = 16_384, 32 << 20, 16 << 10
GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
BATCH = 4 << 20
COLUMNS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_chunks bigint, n_reused bigint, n_shared bigint"
MET = "chunk binary, n bigint, size bigint, doc_id bigint"
ENCODED = "chunk binary, row array<bigint>, ids array<int>"


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of chunks: document starts, and characters where the rolling hash of the bytes before has its low bits 0."""
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    if len(data) > WINDOW:
        rolled = GEAR[data]
        step = 1
        while step < WINDOW:  # sum of gear << age over the last `step` bytes, doubled each time
            rolled[step:] = rolled[step:] + (rolled[:-step] << np.uint32(step))
            step *= 2
        cut = np.flatnonzero(rolled >> np.uint32(32 - CUT_BITS) == 0) + 1
        inside = cut - offsets[np.searchsorted(offsets, cut, side="right") - 1] >= WINDOW
        cut = cut[inside]
        for _ in range(3):  # on to the start of a character
            cut = cut + ((cut < len(data)) & ((data[np.minimum(cut, len(data) - 1)] & 0xC0) == 0x80))
        first[cut] = True
    return np.flatnonzero(first[:-1])


class Chunks:
    """ids of chunks met so far, with their first two and last two inner cuts (byte, token); shared ones are there from the start."""

    def __init__(self, encode: Encoder, shared: tuple[list[bytes], np.ndarray, np.ndarray] | None = None):
        self.encode, self.shared = encode, shared
        self.clear()

    def clear(self) -> None:
        keys, rows, ids = self.shared or ([], np.empty((0, 11), np.int64), np.empty(0, np.int32))
        self.slots: dict[bytes, int] = dict(zip(keys, range(len(keys))))
        self.ids = ids
        #: first id, number of ids, units, then byte and token of: first, second, last but one and last inner cut.
        self.rows = rows

    def of(self, forms: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of each distinct chunk, and whether it was met before and is a shared one."""
        if len(self.ids) - (len(self.shared[2]) if self.shared else 0) > KEPT_IDS:
            self.clear()
        keys = [xxhash.xxh3_128_digest(f) for f in forms]
        new = [i for i, k in enumerate(keys) if k not in self.slots]
        known = np.ones(len(forms), bool)
        known[new] = False
        if new:
            lengths = np.fromiter((len(forms[i]) for i in new), np.int64, len(new))
            offsets = np.append(0, np.cumsum(lengths))
            bounds, slots = self.encode.units(np.frombuffer(b"".join(forms[i] for i in new), np.uint8), offsets)
            size = self.encode.size[slots]
            ids = self.encode.ids[ragged(self.encode.first[slots], size)]
            token = np.append(0, np.cumsum(size))
            unit = np.searchsorted(bounds[:-1], offsets)
            a, b = unit[:-1], unit[1:]
            rows = [len(self.ids) + token[a], token[b] - token[a], b - a]
            for u in (np.minimum(a + 1, b - 1), np.minimum(a + 2, b - 1), np.maximum(b - 2, a), b - 1):
                rows += [bounds[u] - offsets[:-1], token[u] - token[a]]
            self.slots.update(zip((keys[i] for i in new), range(len(self.rows), len(self.rows) + len(new))))
            self.ids, self.rows = np.concatenate([self.ids, ids]), np.concatenate([self.rows, np.stack(rows, 1)])
        found = np.array([self.slots[k] for k in keys], np.int64)
        return found, known, found < (len(self.shared[0]) if self.shared else 0)


def encode_chunked(encode: Encoder, chunks: Chunks, texts: pa.Array, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat ids and offsets of all texts, and for each text the number of its chunks, of those already known and of shared ones.

    Chunks are encoded apart, so the units that a chunk's edge cuts may be wrong. Between the last inner cut of a chunk and
    the first one of the next that has any, the text is encoded again, together with the unit on either side; the ids of these two
    must come out as the chunks have them. Where they don't, the chunks on either side become one, and the document's joins are
    tried again, until all agree or the document is one chunk. starts: where chunks begin, if not where the rolling hash says.
    """
    data, offsets = flat(texts)
    n_docs = len(offsets) - 1
    starts = chunk_starts(data, offsets) if starts is None else starts
    if not len(starts):
        none = np.zeros(n_docs, np.int64)
        return np.empty(0, np.int32), np.zeros(n_docs + 1, np.int64), none, none, none
    bounds = np.append(starts, len(data))
    index, forms = distinct_spans(data, bounds)
    row_of, met, common = chunks.of(forms)
    row = chunks.rows[row_of[index]]
    doc = np.searchsorted(offsets, starts, side="right") - 1
    head, tail = np.append(True, doc[1:] != doc[:-1]), np.append(doc[1:] != doc[:-1], True)
    first_met = np.zeros(len(index), bool)
    first_met[np.unique(index, return_index=True)[1]] = True
    reused, common = ~first_met | met[index], common[index]
    length, has = np.diff(bounds), row[:, 2] > 1
    low_byte, low_tok = np.where(has, row[:, 3], length), np.where(has, row[:, 4], row[:, 1])
    high_byte, high_tok = np.where(has, row[:, 9], 0), np.where(has, row[:, 10], 0)
    low_byte[head] = low_tok[head] = 0
    high_byte[tail], high_tok[tail] = length[tail], row[tail, 1]
    keep = np.flatnonzero(has | head | tail)
    row, start, doc_k, head_k = row[keep], starts[keep], doc[keep], head[keep]
    low_byte, low_tok, high_byte, high_tok = low_byte[keep], low_tok[keep], high_byte[keep], high_tok[keep]
    # Joins between kept neighbours of a document, each with one unit of the chunks' own on either side.
    right = np.flatnonzero(~head_k)
    left = right - 1
    before = row[left, 8] >= low_tok[left]
    before &= row[left, 2] > 1
    after = (row[right, 2] > 2) & (row[right, 6] <= high_tok[right])
    a = start[left] + np.where(before, row[left, 7], high_byte[left])
    b = start[right] + np.where(after, row[right, 5], low_byte[right])
    window = ragged(a, b - a)
    w_offsets = np.append(0, np.cumsum(b - a))
    w_bounds, w_slots = encode.units(data[window], w_offsets)
    w_size = encode.size[w_slots]
    w_ids = encode.ids[ragged(encode.first[w_slots], w_size)]
    w_tok = np.append(0, np.cumsum(w_size))[np.searchsorted(w_bounds[:-1], w_offsets)]
    n_before = np.where(before, high_tok[left] - row[left, 8], 0)
    n_after = np.where(after, row[right, 6] - low_tok[right], 0)
    # Agreement of the units on either side.
    wrong = (w_tok[1:] - w_tok[:-1]) < n_before + n_after
    ok = np.where(wrong, 0, 1)
    for mine, theirs, count in (
        (w_tok[:-1], row[left, 0] + row[left, 8], n_before * ok),
        (w_tok[1:] - n_after, row[right, 0] + low_tok[right], n_after * ok),
    ):
        bad = w_ids[ragged(mine, count)] != chunks.ids[ragged(theirs, count)]
        wrong[np.repeat(np.arange(len(count)), count)[bad]] = True
    # Pieces in order: inner ids of a kept chunk, then the ids of the join after it.
    base = len(chunks.ids)
    piece_first = np.zeros(2 * len(keep), np.int64)
    piece_size = np.zeros(2 * len(keep), np.int64)
    piece_first[0::2], piece_size[0::2] = row[:, 0] + low_tok, np.maximum(0, high_tok - low_tok)
    piece_first[1::2][left] = base + w_tok[:-1] + n_before
    piece_size[1::2][left] = np.maximum(0, w_tok[1:] - w_tok[:-1] - n_before - n_after)
    pool = np.concatenate([chunks.ids, w_ids])
    ids = pool[ragged(piece_first, piece_size)]
    sizes = np.bincount(np.repeat(doc_k, 2), piece_size, minlength=n_docs).astype(np.int64)
    at = np.append(0, np.cumsum(sizes))
    if wrong.any():
        again = np.unique(doc_k[left[wrong]])
        # In these documents, chunks that a wrong join touches or skips are one from now on.
        merged = np.zeros(len(starts), bool)
        merged[ragged(keep[left[wrong]] + 1, keep[right[wrong]] - keep[left[wrong]])] = True
        these = np.flatnonzero(np.isin(doc, again) & ~merged)
        shift = offsets[again] - np.append(0, np.cumsum(np.diff(offsets)[again]))[:-1]
        fresh = starts[these] - shift[np.searchsorted(again, doc[these])]
        full, full_at, *_ = encode_chunked(encode, chunks, texts.take(pa.array(again)), fresh)
        parts = [ids[at[i] : at[i + 1]] for i in range(n_docs)]
        for k, i in enumerate(again.tolist()):
            parts[i] = full[full_at[k] : full_at[k + 1]]
        ids, at = np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))
    counts = [np.bincount(doc, x, minlength=n_docs).astype(np.int64) for x in (np.ones(len(doc)), reused, common)]
    return ids, at, *counts


def met_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of each batch: hash, how often it stands there, bytes, and a document that holds it."""
    for batch in sliced(batches, "text", BATCH):
        data, offsets = flat(batch.column("text"))
        starts = chunk_starts(data, offsets)
        if not len(starts):
            continue
        index, forms = distinct_spans(data, np.append(starts, len(data)))
        doc = np.searchsorted(offsets, starts, side="right") - 1
        first = np.unique(index, return_index=True)[1]
        columns = [pa.array([xxhash.xxh3_128_digest(f) for f in forms], pa.binary()), pa.array(np.bincount(index, minlength=len(forms))), pa.array([len(f) for f in forms], pa.int64()), batch.column("doc_id").cast(pa.int64()).take(pa.array(doc[first]))]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in MET.split(", ")]).filter(pa.array([len(f) <= SHARED_EACH for f in forms]))


def encoded_chunks(batches: Iterator[pa.RecordBatch], wanted: set[bytes], vocabulary: str, ranks: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """The wanted chunks that the documents hold, encoded: their row among Chunks with the first id at 0, and their ids."""
    encode = encoder(vocabulary, ranks, pattern)
    for batch in sliced(batches, "text", BATCH):
        data, offsets = flat(batch.column("text"))
        starts = chunk_starts(data, offsets)
        forms = [f for f in distinct_spans(data, np.append(starts, len(data)))[1] if xxhash.xxh3_128_digest(f) in wanted] if len(starts) else []
        if not forms:
            continue
        chunks = Chunks(encode)
        chunks.of(forms)
        rows, ids = chunks.rows, [chunks.ids[r[0] : r[0] + r[1]] for r in chunks.rows]
        rows[:, 0] = 0
        yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(f) for f in forms], pa.binary()), pa.array(list(rows), pa.list_(pa.int64())), pa.array(ids, pa.list_(pa.int32()))], names=[c.split()[0] for c in ENCODED.split(", ")])


def shared_chunks(documents: DataFrame, vocabulary: str, ranks: str, pattern: str) -> tuple[list[bytes], np.ndarray, np.ndarray] | None:
    """The chunks that stand in the corpus more than once and save the most, encoded once: hashes, rows and ids as Chunks takes them.

    Hashes are counted over all documents; only they are shuffled. The bounds keep the table below 32 MB of text, and so below
    32 million ids, at any size of the corpus; a chunk beyond them is shared by the documents that a worker meets.
    """
    spark = documents.sparkSession
    counts = documents.select("doc_id", "text").mapInArrow(met_chunks, MET).groupBy("chunk").agg(F.sum("n").alias("n"), F.first("size").alias("size"), F.min("doc_id").alias("doc_id"))
    best = counts.where("n > 1 and doc_id is not null").orderBy(F.desc(F.expr("(n - 1) * size")), "chunk").limit(SHARED).collect()
    total = np.cumsum([r["size"] for r in best])
    best = best[: int(np.searchsorted(total, SHARED_BYTES, side="right"))]
    if not best:
        return None
    wanted = {bytes(r["chunk"]) for r in best}
    owners = F.broadcast(spark.createDataFrame([(i,) for i in sorted({r["doc_id"] for r in best})], "doc_id bigint"))  # SHARED rows at most
    held = documents.select("doc_id", "text").join(owners, "doc_id", "left_semi")
    rows = held.mapInArrow(lambda it: encoded_chunks(it, wanted, vocabulary, ranks, pattern), ENCODED).dropDuplicates(["chunk"]).toArrow()
    table = np.array(rows["row"].to_pylist(), np.int64).reshape(-1, 11)
    table[:, 0] = np.cumsum(table[:, 1]) - table[:, 1]
    return rows["chunk"].to_pylist(), table, rows["ids"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int32)


class Decoder:
    """Bytes and decimal digits of every id, laid out for gathering."""

    def __init__(self, encode: Encoder):
        letters = {c: b for b, c in byte_letters().items()}
        vocab = encode.tokenizer.get_vocab(with_added_tokens=True)
        added = {i for i in encode.tokenizer.get_added_tokens_decoder()}
        tokens = [b""] * (max(vocab.values()) + 1)
        for text, i in vocab.items():
            tokens[i] = text.encode() if i in added else bytes(letters[c] for c in text)
        self.raw, self.first, self.size = self.table(tokens)
        self.digits, self.digit_first, self.digit_size = self.table([b"%d," % i for i in range(len(tokens))])

    @staticmethod
    def table(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, values), np.int64, len(values))
        return np.frombuffer(b"".join(values), np.uint8), np.cumsum(size) - size, size

    @staticmethod
    def gathered(ids: np.ndarray, at: np.ndarray, raw: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[memoryview, np.ndarray]:
        lengths = size[ids]
        return memoryview(raw[ragged(first[ids], lengths)]), np.append(0, np.cumsum(lengths))[at]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """UTF-8 of each document's text; bytes that are no UTF-8 become U+FFFD, as the library does."""
        raw, spots = self.gathered(ids, at, self.raw, self.first, self.size)
        parts = [bytes(raw[a:b]) for a, b in zip(spots[:-1].tolist(), spots[1:].tolist())]
        return [p.decode("utf-8", "replace").encode() for p in parts]

    def joined(self, ids: np.ndarray, at: np.ndarray) -> list[memoryview]:
        """Decimal ids of each document, joined by commas."""
        raw, spots = self.gathered(ids, at, self.digits, self.digit_first, self.digit_size)
        return [raw[a : max(a, b - 1)] for a, b in zip(spots[:-1].tolist(), spots[1:].tolist())]


#: Of the last vocabulary and shared table that this worker used.
_KEPT: dict[tuple, tuple[Chunks, Decoder]] = {}


def encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, ranks: str, pattern: str, shared) -> Iterator[tuple[pa.RecordBatch, tuple, Decoder]]:
    """Each sub-batch with its ids and the decoder."""
    encode = encoder(vocabulary, ranks, pattern)
    key = vocabulary, ranks, None if shared is None else shared.id
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Chunks(encode, shared and shared.value), Decoder(encode)
    chunks, decoder = _KEPT[key]
    for batch in sliced(batches, "text", BATCH):
        yield batch, encode_chunked(encode, chunks, batch.column("text")), decoder


class Shared:
    """The shared table as a broadcast that knows which one it is."""

    def __init__(self, broadcast, name: str):
        self.broadcast, self.id = broadcast, name

    @property
    def value(self):
        return self.broadcast.value


def handed_out(documents: DataFrame, vocabulary: str, ranks: str, pattern: str) -> Shared | None:
    found = shared_chunks(prepared(documents), vocabulary, ranks, pattern)
    return found and Shared(documents.sparkSession.sparkContext.broadcast(found), uuid.uuid4().hex)


def digests(batches: Iterator[pa.RecordBatch], vocabulary: str, ranks: str, pattern: str, shared) -> Iterator[pa.RecordBatch]:
    for batch, (ids, at, *counts), decoder in encoded(batches, vocabulary, ranks, pattern, shared):
        hexed = [hashlib.sha256(x).hexdigest() for x in decoder.joined(ids, at)]
        texts = [hashlib.sha256(x).hexdigest() for x in decoder.decode(ids, at)]
        columns = [batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(at)), pa.array(hexed, pa.string()), pa.array(texts, pa.string()), *map(pa.array, counts)]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in COLUMNS.split(", ")])


def ids_of(batches: Iterator[pa.RecordBatch], vocabulary: str, ranks: str, pattern: str, shared) -> Iterator[pa.RecordBatch]:
    for batch, (ids, at, *_), decoder in encoded(batches, vocabulary, ranks, pattern, shared):
        lists = pa.LargeListArray.from_arrays(pa.array(at), pa.array(ids)).cast(pa.list_(pa.int32()))
        texts = pa.array([t.decode() for t in decoder.decode(ids, at)], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), lists, texts], names=["doc_id", "ids", "decoded"])


def encode_documents(documents: DataFrame, vocabulary: str, ranks: str = "", pattern: str = "") -> DataFrame:
    """doc_id, the ids of every whole text, and the text decoded from them."""
    shared = handed_out(documents, vocabulary, ranks, pattern)
    return documents.select("doc_id", "text").mapInArrow(lambda it: ids_of(it, vocabulary, ranks, pattern, shared), "doc_id bigint, ids array<int>, decoded string")


def encoding_digests(documents: DataFrame, vocabulary: str, ranks: str = "", pattern: str = "") -> DataFrame:
    """As encode_documents, but only counts and digests leave the task: n_tokens, ids_sha256, decoded_sha256, n_chunks, n_reused, n_shared.

    ranks and pattern name the same vocabulary for the faster library. A first pass counts the corpus's chunks by their hashes; those that save the
    most are encoded once and handed to all workers, within fixed bounds (n_shared of a document's chunks). A worker shares the
    others among the documents that it meets (n_reused counts both, and depends on who met what). Texts are not shuffled.

    Null or empty text: no ids, decoded to an empty text. A null doc_id stays null; repeated rows are encoded each; other columns are ignored.
    """
    shared = handed_out(documents, vocabulary, ranks, pattern)
    return documents.select("doc_id", "text").mapInArrow(lambda it: digests(it, vocabulary, ranks, pattern, shared), COLUMNS)
