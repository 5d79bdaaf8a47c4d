"""Packing (7): first-fit decreasing with a tournament tree of bin capacities, in randomised groups of documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.arrowtext import sliced
from waymark.llm.runtime import prepared, written
from waymark.llm.tokens import encoder

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = f"{PIECES}, sequence_id bigint, offset bigint"
#: Pieces expected in a group; a group is packed in one task.
GROUP = 20_000
BATCH = 4 << 20


class Tournament:
    """Free room of bins in a complete binary tree whose inner nodes hold the larger room of their two children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def first(self, need: int) -> int:
        """The leftmost bin with that much room; its room is taken. Returns the bin."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            at += room[at] < need
        room[at] -= need
        bin_ = at - self.leaves
        while at > 1:
            at >>= 1
            left, right = room[2 * at], room[2 * at + 1]
            room[at] = left if left > right else right
        return bin_


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces go in by length, longest first, equal ones in the order given."""
    order = np.argsort(-lengths, kind="stable")
    tree = Tournament(max(1, len(lengths)), capacity)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in order.tolist():
        need = int(lengths[i])
        bins[i] = tree.first(need)
        offsets[i] = capacity - tree.room[tree.leaves + bins[i]] - need
    return bins, offsets


def pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, limit: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Cut each document's ids, with end_id after them, into pieces of limit ids and a rest."""
    encode = encoder(vocabulary).encode
    for batch in sliced(batches, "text", BATCH):
        ids, at = encode(batch.column("text"))
        at = at + np.arange(len(at))
        whole = np.full(at[-1], end_id, "<u4")
        inner = np.ones(at[-1], bool)
        inner[at[1:] - 1] = False
        whole[inner] = ids
        total = np.diff(at)
        count = (total + limit - 1) // limit
        doc = np.repeat(np.arange(len(total)), count)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * limit
        length = np.minimum(limit, total[doc] - start)
        first = at[:-1][doc] + start
        raw = memoryview(whole.tobytes())
        crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(total[doc])],
            names=[f.split()[0] for f in PIECES.split(", ")],
        )


def packed(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """Pack the groups of a partition; its rows come sorted by group and document."""
    held: list[pa.Table] = []

    def out(table: pa.Table) -> pa.RecordBatch:
        bins, offsets = first_fit_decreasing(table["length"].to_numpy(), capacity)
        group = table["group"][0].as_py()
        table = table.drop_columns(["group"]).append_column("sequence_id", pa.array((group << 32) + bins)).append_column("offset", pa.array(offsets))
        return table.combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        group = table["group"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for a, b in zip(edges, edges[1:]):
            part = table.slice(a, b - a)
            if held and held[0]["group"][0].as_py() != part["group"][0].as_py():
                yield out(pa.concat_tables(held))
                held = []
            held.append(part)
    if held:
        yield out(pa.concat_tables(held))


def pack(documents: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 2, group: int = GROUP, seed: int = 7) -> DataFrame:
    """Pack all documents into sequences of at most capacity tokens; one row for each piece.

    A document's ids and end_id are cut into pieces of capacity ids and a rest, so whole pieces fill a sequence. The pieces' lengths and
    checksums are written, and counted; groups are dealt by a seeded hash of the document and the piece, about group
    pieces each, whatever the ids or sources are and however long texts are. Each is packed alone by first-fit decreasing.

    Null or empty text: end_id alone. A null doc_id stays null. Repeated rows are packed each. Other columns are ignored.
    An empty table gives no rows. sequence_id is the group's number shifted left by 32 bits plus the bin.
    """
    cut = written(prepared(documents).select("doc_id", "text").mapInArrow(lambda it: pieces(it, vocabulary, capacity, end_id), PIECES), "pieces")
    groups = max(1, -(-cut.count() // group))
    # Rows that are alike in every column differ by a number, so that a group of copies is spread as well.
    dealt = cut.withColumn("copy", F.monotonically_increasing_id()).withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", "copy"), F.lit(groups)).cast("int"))
    own = dealt.drop("copy").repartitionById(groups, F.col("group")).withColumn("group", F.col("group").cast("bigint")).sortWithinPartitions("group", F.desc("length"), "doc_id", "start", "ids_crc32")
    return own.mapInArrow(lambda it: packed(it, capacity), PACKED)
