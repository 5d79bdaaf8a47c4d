"""Exact top-k search (9): incremental multi-index hashing of binary codes."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.arrowtext import ragged
from waymark.llm.runtime import written
from waymark.llm.shards import deal, nearest, one_for_each_id, sharded, smallest_of_class

#: Bits of a segment, and distinct rows of a shard.
SEGMENT, SHARD = 16, 16_384


class Segments:
    """Tables from each segment's value to the codes that hold it."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes.view(np.uint64)
        parts = self.split(self.codes)
        self.order = [np.argsort(p, kind="stable") for p in parts]
        self.at = [np.searchsorted(p[o], np.arange((1 << SEGMENT) + 1)) for p, o in zip(parts, self.order)]
        self.flips: list[np.ndarray] = []

    @staticmethod
    def split(codes: np.ndarray) -> list[np.ndarray]:
        return [((codes[:, w] >> np.uint64(s)) & np.uint64((1 << SEGMENT) - 1)).astype(np.int64) for w in range(codes.shape[1]) for s in range(0, 64, SEGMENT)]

    def masks(self, radius: int) -> np.ndarray:
        """All segment values with exactly `radius` bits set."""
        while len(self.flips) <= radius:
            self.flips.append(np.array([sum(1 << b for b in c) for c in combinations(range(SEGMENT), len(self.flips))], np.int64))
        return self.flips[radius]

    def top(self, query: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of the k nearest codes but the query's own, ties to smaller ids.

        Radius r in the first j + 1 of m segments, and r - 1 in the others, finds every code within distance m * r + j: a farther-off
        code would need more differing bits. The search ends once the k-th verified distance is within that bound.
        """
        values = [int(p[0]) for p in self.split(query[None])]
        m = len(values)
        seen = np.zeros(len(self.codes), bool)
        rows, distances = np.empty(0, np.int64), np.empty(0, np.int64)
        for radius in range(SEGMENT + 1):
            for j, value in enumerate(values):
                probe = self.masks(radius) ^ value
                low = self.at[j][probe]
                found = self.order[j][ragged(low, self.at[j][probe + 1] - low)]
                found = found[~seen[found] & (ids[found] != own)]
                seen[found] = True
                if len(found):
                    rows = np.concatenate([rows, found])
                    distances = np.concatenate([distances, np.bitwise_count(self.codes[found] ^ query).sum(1).astype(np.int64)])
                    if len(rows) > 4 * k:
                        best = np.lexsort((ids[rows], distances))[:k]
                        rows, distances = rows[best], distances[best]
                if len(rows) >= k and np.partition(distances, k - 1)[k - 1] <= m * radius + j:
                    best = np.lexsort((ids[rows], distances))[:k]
                    return rows[best], distances[best]
        best = np.lexsort((ids[rows], distances))[:k]
        return rows[best], distances[best]


def shard_search(ids: np.ndarray, codes: np.ndarray, k: int):
    index = Segments(np.ascontiguousarray(codes))

    def search(query_ids: np.ndarray, queries: np.ndarray) -> tuple:
        queries = np.ascontiguousarray(queries).view(np.uint64)
        found = [index.top(q, ids, own, k) for q, own in zip(queries, query_ids.tolist())]
        size = [len(r) for r, _ in found]
        rows = np.concatenate([r for r, _ in found])
        return np.repeat(query_ids, size), ids[rows], np.concatenate([d for _, d in found])

    return search


def sign_codes(vectors: DataFrame) -> DataFrame:
    """(id, code): one bit for each component, 1 where it is above 0, in 64-bit words. Null, empty or non-finite vectors are left out."""
    whole = "size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    word = "aggregate(transform(slice(embedding, w * 64 + 1, 64), (x, i) -> if(x > 0, shiftleft(1L, i), 0L)), 0L, (a, b) -> a | b)"
    code = F.expr(f"transform(sequence(0, cast((size(embedding) - 1) div 64 as int)), w -> {word})")
    return vectors.select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding")).where("id is not null and embedding is not null").where(whole).select("id", code.alias("code"), F.size("embedding").alias("bits"))


def search(codes: DataFrame, k: int = 20, every: int = 20, shard: int = SHARD, seed: int = 9) -> DataFrame:
    """The k nearest codes by Hamming distance of each row whose id is divisible by `every`: query_id, rank, vec_id, distance.

    Exact. codes has id, code (64-bit words) and bits. Of equal codes the k + 1 smallest ids are enough. Codes are dealt to shards of about
    `shard` rows; a task indexes its shard and all queries stream past it, in blocks; shards' lists are merged.

    Codes of another length than most take no part. Rows that share an id count as one, with the least code (as arrays of signed words compare). Fewer rows than k: all of them.
    The query's own id is no neighbour; ties go to smaller ids. Empty table: no rows.
    """
    sizes = codes.groupBy("bits").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "bits").limit(1).collect()
    if not sizes:
        return codes.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, distance long")
    rows = codes.where(F.col("bits") == sizes[0]["bits"]).select("id", "code")
    rows = one_for_each_id(rows, "code")
    few = written(smallest_of_class(rows, F.col("code"), k + 1), "codes")
    shards = max(1, -(-few.count() // shard))
    found = deal(few, rows.where(F.col("id") % every == 0), shards, seed).mapInArrow(
        lambda it: sharded(it, "code", lambda ids, c: shard_search(ids, c, k), ["query_id", "id", "distance"]), "query_id bigint, id bigint, distance bigint"
    )
    return nearest(found, F.col("distance"), k).select("query_id", "rank", F.col("id").alias("vec_id"), "distance")
