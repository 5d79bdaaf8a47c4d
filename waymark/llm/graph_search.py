"""Approximate nearest neighbours (5): robust-pruned directed graphs over shards, searched with a beam."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.runtime import written
from waymark.llm.shards import deal, nearest, one_for_each_id, sharded, smallest_of_class

#: Out-edges of a node, width of the beam that proposes neighbours and of the one that answers, slack of pruning, vectors in a shard.
DEGREE, PROPOSE, BEAM, SLACK, SHARD = 24, 48, 64, 1.2, 16_384
#: Points inserted against one state of the graph; points that searches start from beside the medoid, so that a tight
#: group of points around it cannot fill the beam of a query from elsewhere; nodes of the beam whose edges are followed at a time.
INSERT, ENTRIES, AHEAD = 256, 40, 4
#: Vectors of a shard with norms of their own that are compared one by one, without a graph.
SMALL = 256


class Graph:
    """A directed graph over points whose squared distance orders neighbours; every point is reached from the medoid."""

    def __init__(self, points: np.ndarray, seed: int = 1):
        self.points = points.astype(np.float32)
        self.compared = 0  # distances computed so far
        self.norms = (self.points**2).sum(1)
        n = len(points)
        self.edges = np.full((n, DEGREE), -1, np.int64)
        medoid = int(np.argmin(((self.points - self.points.mean(0)) ** 2).sum(1)))
        rng = np.random.default_rng(seed)
        self.entry = np.unique(np.append(rng.permutation(n)[:ENTRIES], medoid))
        order = rng.permutation(n)
        if n > 1:
            self.edges[:, : min(8, n - 1)] = (np.arange(n)[:, None] + rng.integers(1, n, (n, min(8, n - 1)))) % n
        for slack in (1.0, SLACK):  # a first pass for short edges, a second that keeps diverse long ones
            for at in range(0, n, INSERT):
                self.insert(order[at : at + INSERT], slack)

    def distance(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distance of each query to each of its ids; infinite for -1."""
        self.compared += int(np.count_nonzero(ids >= 0))
        got = self.norms[ids] - 2 * np.einsum("qd,qkd->qk", queries, self.points[ids]) + (queries**2).sum(1)[:, None]
        return np.where(ids < 0, np.inf, np.maximum(got, 0))

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all queries at once: the ids and distances of the `width` nearest points seen, nearest first."""
        q, n = len(queries), len(self.points)
        seen = np.zeros((q, n), bool)
        ids = np.full((q, width), -1, np.int64)
        far = np.full((q, width), np.inf, np.float32)
        open_ = np.zeros((q, width), bool)
        e = len(self.entry[:width])
        ids[:, :e], open_[:, :e] = self.entry[:width], True
        far[:, :e] = self.distance(queries, ids[:, :e])
        order = np.argsort(far, 1, kind="stable")
        ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
        seen[:, self.entry] = True
        active = np.arange(q)
        while len(active):
            rank = np.cumsum(open_[active], 1)  # the beam is sorted: the first open ones are the nearest
            follow = open_[active] & (rank <= AHEAD)
            at = np.where(follow.any(1)[:, None], np.argsort(~follow, 1, kind="stable")[:, :AHEAD], 0)
            real = np.take_along_axis(follow, at, 1)
            open_[active] &= ~follow
            new = np.where(real[:, :, None], self.edges[np.take_along_axis(ids[active], at, 1)], -1).reshape(len(active), -1)
            new = np.sort(new, 1)
            fresh = (new >= 0) & ~seen[active[:, None], new]
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            seen[active[:, None], np.where(fresh, new, self.entry[0])] = True
            most = int(fresh.sum(1).max())
            front = np.argsort(~fresh, 1, kind="stable")[:, :most]
            fresh = np.take_along_axis(fresh, front, 1)
            new = np.where(fresh, np.take_along_axis(new, front, 1), -1)
            distance = self.distance(queries[active], new)
            all_ids = np.concatenate([ids[active], new], 1)
            all_far = np.concatenate([far[active], distance], 1)
            all_open = np.concatenate([open_[active], fresh], 1)
            best = np.argsort(all_far, 1, kind="stable")[:, :width]
            ids[active], far[active] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_far, best, 1)
            open_[active] = np.take_along_axis(all_open, best, 1)
            active = active[open_[active].any(1)]
        return ids, far

    def pruned(self, points: np.ndarray, ids: np.ndarray, far: np.ndarray, slack: float) -> np.ndarray:
        """Robust pruning, for many points at once: take the nearest candidate, drop those that it is closer to by the slack, and so on."""
        order = np.argsort(far, 1, kind="stable")
        ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
        alive = np.isfinite(far) & (ids != points[:, None])
        alive[:, 1:] &= ids[:, 1:] != ids[:, :-1]
        vectors = self.points[ids]
        out = np.full((len(points), DEGREE), -1, np.int64)
        for slot in range(DEGREE):
            some = np.flatnonzero(alive.any(1))
            if not len(some):
                break
            at = np.argmax(alive[some], 1)
            out[some, slot] = ids[some, at]
            alive[some, at] = False
            picked = vectors[some, at]
            between = self.norms[ids[some]] - 2 * np.einsum("qd,qkd->qk", picked, vectors[some]) + self.norms[out[some, slot]][:, None]
            alive[some] &= slack * slack * between > far[some]
        return out

    def insert(self, points: np.ndarray, slack: float) -> None:
        """Propose neighbours by greedy search, prune them, and offer each point to its new neighbours in turn."""
        ids, far = self.search(self.points[points], PROPOSE)
        old = self.edges[points]
        ids, far = np.concatenate([ids, old], 1), np.concatenate([far, self.distance(self.points[points], old)], 1)
        self.edges[points] = out = self.pruned(points, ids, far, slack)
        target, source = out.ravel(), np.repeat(points, DEGREE)
        ok = target >= 0
        target, source = target[ok], source[ok]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        offered = np.full((len(nodes), int(count.max()) if len(count) else 0), -1, np.int64)
        row = np.repeat(np.arange(len(nodes)), count)
        offered[row, np.arange(len(target)) - first[row]] = source
        for at in range(0, len(nodes), 1024):  # a batch's points can all choose one node: bounded by INSERT offers
            part, more = nodes[at : at + 1024], offered[at : at + 1024]
            more = np.where((more[:, :, None] == self.edges[part][:, None, :]).any(2), -1, more)
            both = np.concatenate([self.edges[part], more], 1)
            room = (both >= 0).sum(1) <= DEGREE  # no need to prune: the edges are moved to the front
            front = np.argsort(both[room] < 0, 1, kind="stable")[:, :DEGREE]
            self.edges[part[room]] = np.take_along_axis(both[room], front, 1)
            full = part[~room]
            if len(full):
                self.edges[full] = self.pruned(full, both[~room], self.distance(self.points[full], both[~room]), slack)


def norms_of(vectors: np.ndarray) -> np.ndarray:
    """Euclidean norms, also where squares leave the range of double precision."""
    most = np.abs(vectors).max(1)
    return most * np.sqrt(((vectors / most[:, None]) ** 2).sum(1))


def bands(norms: np.ndarray) -> list[np.ndarray]:
    """Places of the vectors by norm: a band's largest norm is less than twice its least, and the first band has the longest vectors."""
    order = np.argsort(-norms, kind="stable")
    out, at = [], 0
    while at < len(order):
        end = at + int(np.searchsorted(-norms[order[at:]], -norms[order[at]] / 2, side="left"))
        out.append(order[at:end])
        at = end
    return out


def shard_search(ids: np.ndarray, vectors: np.ndarray, k: int, beam: int = BEAM):
    """Index a shard and return its search.

    Vectors of alike norms share a graph, so that no long one drowns the others' distances. Largest inner product becomes least distance by
    one more coordinate: with norms brought to 1, the band's largest, |x - q|^2 = 2 - 2 x.q for queries of norm 1. Bands are searched from
    the longest vectors down; a band whose largest norm cannot bring a product into a query's best ones is passed over.
    """
    vectors = vectors.astype(np.float64)
    norms, parts = norms_of(vectors), []
    for places in bands(norms):
        graph = None
        if len(places) > SMALL:
            short = vectors[places] / norms[places[0]]
            graph = Graph(np.concatenate([short, np.sqrt(np.maximum(1 - (short**2).sum(1, keepdims=True), 0))], 1))
        parts.append((places, norms[places[0]], graph))
    wanted = k + 2  # the k + 1 classes that can matter, and the query itself

    def search(query_ids: np.ndarray, queries: np.ndarray) -> tuple:
        queries = queries.astype(np.float64)
        length = norms_of(queries)
        flat = np.concatenate([queries / length[:, None], np.zeros((len(queries), 1))], 1).astype(np.float32)
        best = np.full((len(queries), wanted), -np.inf)
        rows, columns, scores = [], [], []
        for places, longest, graph in parts:
            able = np.flatnonzero(longest * length * (1 + 1e-9) >= best[:, -1])
            if not len(able):
                continue
            if graph is None:
                near = np.broadcast_to(np.arange(len(places)), (len(able), len(places)))
            else:
                near = graph.search(flat[able], max(beam, 2 * k))[0][:, :wanted]
            row, column = np.nonzero(near >= 0)
            found = places[near[row, column]]
            score = np.einsum("nd,nd->n", queries[able[row]], vectors[found])
            table = np.full(near.shape, -np.inf)
            table[row, column] = score
            best[able] = -np.sort(-np.concatenate([best[able], table], 1), 1)[:, :wanted]
            enter = score >= best[able[row], -1]
            rows.append(able[row[enter]])
            columns.append(found[enter])
            scores.append(score[enter])
        row, found, score = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((rows, np.int64), (columns, np.int64), (scores, np.float64)))
        own = ids[found] != query_ids[row]
        return query_ids[row][own], ids[found][own], score[own]

    return search


def search(vectors: DataFrame, k: int = 20, every: int = 20, shard: int = SHARD, beam: int = BEAM, seed: int = 9) -> DataFrame:
    """The k rows of largest inner product for each row whose vec_id is divisible by `every`: query_id, rank, vec_id, score.

    Equal vectors are one class of which the k + 1 smallest ids are enough. Classes are dealt to shards of about `shard` vectors; a task builds
    its shard's graphs, one for each doubling of the norms, and streams all queries past them, in blocks. A graph holds one node for each distinct
    vector and orders them in single precision, scaled to its band; scores are exact inner products in double precision. Recall is not 1 by nature: a wider beam finds more, and a larger
    shard compares less: a query's distances in a shard grow far slower than the shard. A task holds 8 * width + 200 bytes
    a vector, and a byte for each of its vectors and 512 queries.

    Null ids; null, empty or zero vectors; vectors with null or non-finite components or another length than most: no part.
    Rows that share an id count as one, with the least vector (as arrays compare). Fewer candidates than k: all of them. Other columns are ignored. Empty table: no rows.
    """
    whole = F.expr("size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").cast("array<double>").alias("embedding")).where("id is not null and embedding is not null").where(whole)
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, n = sizes[0]["d"], sizes[0]["n"]
    rows = one_for_each_id(rows.where(F.size("embedding") == width), "embedding")
    queries = rows.where(F.col("id") % every == 0)
    few = written(smallest_of_class(rows, F.xxhash64("embedding"), k + 1).withColumn("class", F.struct(F.xxhash64("embedding"), F.hash("embedding"))), "vectors")
    heads = few.groupBy("class").agg(F.min("id").alias("id"), F.first("embedding").alias("embedding"))
    shards = max(1, -(-n // shard))
    found = deal(heads.select("id", "embedding"), queries, shards, seed).mapInArrow(
        lambda it: sharded(it, "embedding", lambda ids, v: shard_search(ids, v, k, beam), ["query_id", "id", "score"]), "query_id bigint, id bigint, score double"
    )
    best = nearest(found, F.desc("score"), k + 1)
    # Members of the classes found; a query's own class is found through its head, or is looked up when the query is the head.
    own = queries.select(F.col("id").alias("query_id"), F.struct(F.xxhash64("embedding"), F.hash("embedding")).alias("class"), F.expr("aggregate(zip_with(embedding, embedding, (a, b) -> a * b), 0D, (s, x) -> s + x)").alias("score"))
    of_heads = heads.select("id", "class")
    classes = best.join(of_heads, "id").select("query_id", "class", "score").unionByName(own).groupBy("query_id", "class").agg(F.max("score").alias("score"))
    members = classes.join(few.select("class", "id"), "class").where("id <> query_id")
    return nearest(members, F.desc("score"), k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
