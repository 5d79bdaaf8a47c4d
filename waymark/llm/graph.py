"""Connected components of an edge table, without gathering any node's neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.runtime import large, written

#: Edges up to which one task joins them all in memory (about 100 MB); more go through distributed rounds.
ONE_TASK = 400_000


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label) of the components of a partition's edges, by union-find towards smaller ids."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent[top]) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    ids = list(parent)
    for at in range(0, len(ids), 50_000):
        part = ids[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], names=["id", "label"])


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(id, label) for every node of edges (a, b); label is the smallest id of its component.

    Each partition first reduces its edges to a forest, so repeated edges and cycles within it go. What is left is joined by one task if it is
    at most one_task edges. Else minimum labels spread over edges and jump along themselves, in rounds that grow with
    the logarithm of a component's width and are written to the shared folder; a node with many edges is aggregated before any
    shuffle. Self loops and repeated edges do no harm; null ends are ignored.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    forest = written(edges.mapInArrow(joined, "id bigint, label bigint").where("id <> label").select(F.col("id").alias("a"), F.col("label").alias("b")), "edges")
    if forest.count() <= one_task:
        return written(forest.coalesce(1).mapInArrow(joined, "id bigint, label bigint"), "labels")
    both = written(forest.union(forest.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(large(labels), both.b == labels.id).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        new = labels.join(large(near), "id").join(large(jump), "label", "left").select("id", F.least("label", "near", "far").alias("new"), "label")
        new = written(new, "labels")
        if new.where("new <> label").isEmpty():
            return labels
        labels = new.select("id", F.col("new").alias("label"))
