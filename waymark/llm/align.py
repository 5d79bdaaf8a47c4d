"""Cross-tokenizer alignment (12): common cuts of two tokenizations, links between their tokens, and how often each pair is linked.

Both tokenizers cut before a run of spaces that follows a visible character, so what lies between such cuts (a *unit*) is aligned once
and kept by the worker; a batch costs numpy work for its new units, and gathers for the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.llm.arrowtext import by_document, distinct_spans, flat, ragged, sliced
from waymark.llm.runtime import prepared, written
from waymark.llm.tokens import LATIN, Encoder, byte_letters, cuts

#: Text of a block: the pairs of a block are counted together, and its documents meet their pairs' counts together.
BLOCK = 8 << 20
#: Units kept by a worker; past it all are forgotten, which changes no result.
KEPT_UNITS = 300_000
#: Units that are aligned at a time.
LEARNT = 20_000
#: Parts in which the counts of a pair are added up before they meet.
SALTS = 8
LINKS = "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<int>, pairs array<struct<a: int, b: int, n: bigint>>"
ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def linked(a_end: np.ndarray, b_end: np.ndarray, how: str = "end") -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and B tokens of each link, by A token. end: tokens that end together; overlap: tokens that share a byte."""
    if how == "end":
        first = np.searchsorted(b_end, a_end)
        count = (b_end[np.minimum(first, len(b_end) - 1)] == a_end).astype(np.int64) if len(b_end) else np.zeros(len(a_end), np.int64)
    elif how == "overlap":
        first = np.searchsorted(b_end, np.append(0, a_end[:-1]), side="right")
        count = np.searchsorted(np.append(0, b_end[:-1]), a_end) - first if len(b_end) else np.zeros(len(a_end), np.int64)
    else:
        raise ValueError(f"unknown kind of link: {how}")
    return np.repeat(np.arange(len(a_end)), count), ragged(first, count)


def grouped_text(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, groups: int) -> list[bytes]:
    """`a1,a2|b1` of each group."""
    sides = []
    for ids, label in ((a, a_group), (b, b_group)):
        at = np.searchsorted(label, np.arange(groups + 1)).tolist()
        words = [str(i) for i in ids.tolist()]
        sides.append([words[x] if y == x + 1 else ",".join(words[x:y]) for x, y in zip(at, at[1:])])
    return [f"{x}|{y}".encode() for x, y in zip(*sides)]


class Table:
    """Bytes of a vocabulary's tokens by id."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.first = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.first[ids], self.size[ids])]


class Aligner:
    """Aligned units: how many tokens, groups and links each has, its linked pairs and the text of its groups."""

    def __init__(self, byte_path: str, ranks: str, pattern: str, piece_path: str, how: str):
        import sentencepiece

        self.how = how
        self.a = Encoder(byte_path, ranks, pattern)
        self.a.tokenizer.encode_special_tokens = True
        letters = {c: b for b, c in byte_letters().items()}
        tokens = [b""] * self.a.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.tokenizer.get_vocab(with_added_tokens=True).items():
            tokens[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.a_table = Table(tokens)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece of this vocabulary goes on past a space, so texts can't be cut there")
        self.b_table = Table([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        self.space = self.b.piece_to_id("▁")
        self.clear()

    def clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.text: list[bytes] = []
        #: By slot: A tokens, B tokens, groups, links, and whether both tokenizations hold the unit's own bytes.
        self.facts = np.zeros((1 << 14, 5), np.int64)
        self.first = np.zeros(1 << 14, np.int64)
        self.links, self.used = np.zeros(1 << 16, np.int64), 0

    def a_ids(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of A tokens, and ids."""
        texts = [u.decode("utf-8") for u in units]
        quick = np.array([self.a.fast is not None and LATIN.fullmatch(t) is not None for t in texts], bool)
        size, parts = np.zeros(len(units), np.int64), [np.empty(0, np.int64)] * 2
        for i, (mask, of) in enumerate(((quick, lambda w: self.a._fast([units[k] for k in w])), (~quick, lambda w: self.a._single([texts[k] for k in w])))):
            if len(where := np.flatnonzero(mask)):
                size[where], parts[i], _ = of(where)
        ids = np.empty(int(size.sum()), np.int64)
        of_quick = np.repeat(quick, size)
        ids[of_quick], ids[~of_quick] = parts
        return size, ids

    def b_ids(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of B tokens, and ids; the library adds the space that each unit starts with."""
        got = self.b.encode([u[1:].decode("utf-8") for u in units], num_threads=1)
        got = [g or [self.space] for g in got]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return size, np.fromiter((i for g in got for i in g), np.int64, int(size.sum()))

    def learn(self, units: list[bytes]) -> None:
        """Align new units."""
        length = np.fromiter(map(len, units), np.int64, len(units))
        data = np.frombuffer(b"".join(units), np.uint8)
        good, sides = np.ones(len(units), bool), []
        for (size, ids), table in ((self.a_ids(units), self.a_table), (self.b_ids(units), self.b_table)):
            held = np.zeros(len(units), np.int64)
            np.add.at(held, np.repeat(np.arange(len(units)), size), table.size[ids])
            same = held == length
            take = np.repeat(same, length)
            wrong = np.flatnonzero(table.bytes_of(ids[np.repeat(same, size)]) != data[take])
            same[np.repeat(np.arange(len(units)), length)[take][wrong]] = False
            good &= same
            sides.append((size, ids, table))
        end, lists = np.cumsum(length[good]), []
        for size, ids, table in sides:
            ids = ids[np.repeat(good, size)]
            lists.append((size * good, ids, np.cumsum(table.size[ids])))
        (n_a, a, a_end), (n_b, b, b_end) = lists
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        text = grouped_text(a, b, np.searchsorted(common, a_end), np.searchsorted(common, b_end), len(common))
        at_a, at_b = linked(a_end, b_end, self.how)
        groups, links = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        of_group = np.append(0, np.searchsorted(common, end, side="right"))
        groups[good] = np.diff(of_group)
        links[good] = np.diff(np.append(0, np.searchsorted(a_end[at_a], end, side="right")))
        old, new = len(self.slots), len(self.slots) + len(units)
        while len(self.first) < new:
            self.facts, self.first = np.concatenate([self.facts, np.zeros_like(self.facts)]), np.concatenate([self.first, np.zeros_like(self.first)])
        while len(self.links) < self.used + len(at_a):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.facts[old:new] = np.stack([n_a, n_b, groups, links, good], axis=1)
        self.first[old:new] = self.used + np.cumsum(links) - links
        self.links[self.used : self.used + len(at_a)] = a[at_a] << 32 | b[at_b]
        self.used += len(at_a)
        at = iter(zip(of_group.tolist(), of_group[1:].tolist()))
        self.text += [b";".join(text[slice(*next(at))]) if g else b"" for g in good.tolist()]
        self.slots.update(zip(units, range(old, new)))

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the batch's units, each one's number among the distinct ones, and the slots of these."""
        starts = cuts(data, offsets)
        starts = starts[data[starts] == 0x20]
        index, forms = distinct_spans(data, np.append(starts, len(data)))
        if len(self.slots) + len(forms) > KEPT_UNITS:
            self.clear()
        new = [u for u in forms if u not in self.slots]
        for at in range(0, len(new), LEARNT):
            self.learn(new[at : at + LEARNT])
        return starts, index, np.fromiter((self.slots[u] for u in forms), np.int64, len(forms))


_KEPT: dict[tuple, Aligner] = {}


def aligner(*how: str) -> Aligner:
    """The worker's aligner of two vocabulary files."""
    if how not in _KEPT:
        _KEPT[how] = Aligner(*how)
    return _KEPT[how]


def aligned_blocks(batches: Iterator[pa.RecordBatch], how: tuple) -> Iterator[pa.RecordBatch]:
    """A row for each document, with its links as numbers of its block's pairs, and one for each block, with the pairs and their counts."""
    known, task, n = aligner(*how), TaskContext.get().partitionId(), 0
    names = [f.split()[0] for f in LINKS.split(", ")[:7]] + ["pairs"]
    pair = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
    for batch in sliced(batches, "text", BLOCK):
        block, n = task << 32 | n, n + 1
        texts = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
        data, offsets = flat(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
        starts, index, slots = known.units(data, offsets)
        at = np.searchsorted(starts, offsets)
        facts = known.facts[slots]
        whole = (by_document(1 - facts[index, 4], at) == 0) & (np.diff(offsets) > 1)
        a, b, groups = (by_document(facts[index, k], at) * whole for k in range(3))
        text = [known.text[s] for s in slots.tolist()]
        digest = [hashlib.sha256(b";".join([text[i] for i in index[x:y].tolist()])).hexdigest() if w else "" for x, y, w in zip(at.tolist(), at[1:].tolist(), whole.tolist())]
        codes, number = np.unique(known.links[ragged(known.first[slots], facts[:, 3])], return_inverse=True)
        first = np.cumsum(facts[:, 3]) - facts[:, 3]
        index = index[np.repeat(whole, np.diff(at))]
        links = number[ragged(first[index], facts[index, 3])].astype(np.int32)
        per_document = np.zeros(len(whole) + 1, np.int32)
        np.cumsum(by_document(facts[index, 3], np.append(0, np.cumsum(np.diff(at) * whole))), out=per_document[1:])
        rows = len(whole)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(rows, block)), batch.column("doc_id").cast(pa.int64()), pa.array(a), pa.array(b), pa.array(groups), pa.array(digest, pa.string()), pa.ListArray.from_arrays(pa.array(per_document), pa.array(links)), pa.nulls(rows, pa.list_(pair))],
            names=names,
        )
        if len(codes):
            count = np.bincount(links, minlength=len(codes))
            held = pa.StructArray.from_arrays([pa.array((codes >> 32).astype(np.int32)), pa.array((codes & 0xFFFFFFFF).astype(np.int32)), pa.array(count)], fields=list(pair))
            row = [pa.array([block]), *(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), held)]
            yield pa.RecordBatch.from_arrays(row, names=names)


def link_table(documents: DataFrame, byte_path: str, ranks: str, pattern: str, piece_path: str, how: str = "end") -> DataFrame:
    """Both tokenizations of every whole text, aligned once and written: rows of documents and rows of blocks (see LINKS)."""
    files = (byte_path, ranks, pattern, piece_path, how)
    return written(prepared(documents.select("doc_id", "text")).mapInArrow(lambda it: aligned_blocks(it, files), LINKS), "links")


def pairs_of(links: DataFrame) -> DataFrame:
    """block, place, a, b, n: the pairs of each block, each of them once."""
    return links.where("pairs is not null").select("block", F.posexplode("pairs").alias("place", "pair")).select("block", "place", "pair.a", "pair.b", "pair.n").where("n > 0")


def pair_counts(links: DataFrame) -> DataFrame:
    """a, b, count, and whether no other A id is linked more often with the B id. Counts are added up by salt first, then over the salts.

    All pairs of a B id meet in one task: as many as the A vocabulary has ids at most.
    """
    parts = pairs_of(links).groupBy("a", "b", F.pmod(F.xxhash64("block"), F.lit(SALTS)).alias("salt")).agg(F.sum("n").alias("n"))
    total = parts.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return total.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def settled(documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one block with the sums over their links."""
    places = pairs["place"].to_numpy()
    count, best = (np.zeros(int(places.max(initial=-1)) + 1, np.int64) for _ in range(2))
    count[places], best[places] = pairs["count"].to_numpy(), pairs["best"].to_numpy().astype(np.int64)
    links = documents["links"].combine_chunks()
    if isinstance(links, pa.ChunkedArray):
        links = links.chunk(0) if links.num_chunks else pa.array([], links.type)
    numbers, offsets = links.flatten().to_numpy(), np.append(0, np.cumsum(pc.list_value_length(links).to_numpy(zero_copy_only=False))).astype(np.int64)
    sums = {"n_links": np.diff(offsets), "n_best": by_document(best[numbers], offsets), "count_sum": by_document(count[numbers], offsets)}
    names = [f.split()[0] for f in ALIGNED.split(", ")]
    return pa.table([pa.array(sums[c]) if c in sums else documents[c] for c in names], names=names)


def align(documents: DataFrame, byte_path: str, ranks: str, pattern: str, piece_path: str, how: str = "end") -> DataFrame:
    """Align two tokenizations of every whole text; one row for each document (see ALIGNED).

    A's tokens are those of space and text, B's those of the text, to which it adds the space; neither takes special strings as special.
    Texts null, empty, or not held byte by byte by both have no tokens: zeros and an empty digest. A null doc_id stays null, repeated rows
    count each, other columns are ignored, an empty table gives no rows. Ties of the highest count are all best.

    Texts are read once. A block's distinct pairs are counted by the worker, so a pair, however frequent, is one row for each block; the counts
    come back to the blocks by pair, and to the documents by block.
    """
    links = link_table(documents, byte_path, ranks, pattern, piece_path, how)
    counts = written(pair_counts(links), "pairs")
    back = pairs_of(links).select("block", "place", "a", "b").join(counts, ["a", "b"]).select("block", "place", "count", "best")
    docs = links.where("pairs is null").drop("pairs").withColumnRenamed("block", "own_block")
    return docs.groupBy("own_block").cogroup(back.groupBy("block")).applyInArrow(settled, ALIGNED)
