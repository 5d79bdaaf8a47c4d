"""Searches of sharded vectors: classes of equal vectors, shards of bounded size, and queries that stream past each shard."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Queries that a shard answers at a time.
BLOCK = 512


def one_for_each_id(rows: DataFrame, value: str) -> DataFrame:
    """(id, value): of the rows that share an id the one with the least value, so that no answer lists an id twice."""
    return rows.groupBy("id").agg(F.min(value).alias(value))


def smallest_of_class(rows: DataFrame, key: Column, keep: int) -> DataFrame:
    """Of the rows with equal keys those with the `keep` smallest ids, in two steps so that a key with very many rows is spread.

    Exact for nearest-neighbour lists shorter than keep: equal vectors tie, ties go to smaller ids, and a query is never its own neighbour.
    """
    dealt = rows.withColumn("__key", key).withColumn("__salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    for keys in (["__key", "__salt"], ["__key"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
        dealt = dealt.withColumn("__place", place).where(F.col("__place") <= keep)
    return dealt.drop("__key", "__salt", "__place")


def matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) if batch.num_rows else np.empty((0, 0))


def sharded(batches: Iterator[pa.RecordBatch], column: str, answer: Callable[[np.ndarray, np.ndarray], Callable[[np.ndarray, np.ndarray], tuple]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (shard, role, id): a shard's own rows (role 0) are gathered, then its queries (role 1) stream past them.

    answer(ids, values) builds the shard's index and returns a function of (query ids, query values) to output columns.
    """
    shard, ids, values, search = None, [], [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("shard").to_numpy().astype(np.int64) * 2 + batch.column("role").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            part = batch.slice(a, b - a)
            here, role = divmod(int(key[a]), 2)
            if here != shard:
                shard, ids, values, search = here, [], [], None
            if role == 0:
                ids.append(part.column("id").to_numpy())
                values.append(matrix(part, column))
                continue
            if not ids:
                continue
            if search is None:
                search = answer(np.concatenate(ids), np.concatenate(values))
            for at in range(0, part.num_rows, BLOCK):
                block = part.slice(at, BLOCK)
                columns = search(block.column("id").to_numpy(), matrix(block, column))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def deal(rows: DataFrame, queries: DataFrame, shards: int, seed: int) -> DataFrame:
    """Rows by a seeded hash of their id, one copy of every query for each shard; sorted as sharded() needs them."""
    own = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(shards)).cast("int")).withColumn("role", F.lit(0))
    asked = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("role", F.lit(1))
    columns = ["shard", "role", *[c for c in rows.columns]]
    both = own.select(columns).unionByName(asked.select(columns))
    return both.repartitionById(shards, "shard").sortWithinPartitions("shard", "role", "id")


def nearest(found: DataFrame, measure: Column, k: int) -> DataFrame:
    """The first k of each query over all shards: query_id, rank, id, and the other columns of found."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(measure, "id"))
    return found.withColumn("rank", place.cast("int")).where(F.col("rank") <= k)
