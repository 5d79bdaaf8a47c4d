"""MinHash near-duplicates (10): banded candidates, sequential Bayesian pruning of signatures, exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.arrowtext import LOWER, flat, mixed, signed, sliced, word_hashes, words
from waymark.llm.graph import components
from waymark.llm.runtime import large, prepared, salted, written

#: A pair at similarity 0.8 shares no band with probability (1 - 0.8 ** ROWS) ** BANDS = 3e-6.
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Hashes that are compared at a time, and the posterior probability of similarity >= threshold below which a pair is pruned.
BATCH, MISS = 32, 1e-9
#: Rows of a bucket's block in the second round, and of members beside one copy of a group's centre.
BLOCK, BESIDE = 2_000, 500
#: Members of a family's block, whose sets are in memory together.
FAMILY = 500
U64 = np.uint64
_A = mixed(np.arange(1, HASHES + 1, dtype=U64)) | U64(1)
_B = mixed(np.arange(1001, HASHES + 1001, dtype=U64))


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, flat, and their n + 1 offsets.

    Words are split at 0x20 and 0x09-0x0D after A-Z are lower-cased; a text with fewer than k words is one shingle, one without words has none.
    """
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, at = words(data, offsets)
    high, low = word_hashes(data, starts, ends)
    n = np.diff(at)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + at[:-1][doc]
    size = np.minimum(k, n[doc])
    value = np.zeros(len(doc), U64)
    for i in range(k):
        more = size > i
        spot = np.minimum(first + i, max(len(low) - 1, 0))
        value = np.where(more, mixed(value * U64(0x9E3779B97F4A7C15) + low[spot] + (high[spot] << U64(1))), value) if len(low) else value
    value ^= size.astype(U64)
    order = np.argsort(doc.astype(U64) << U64(40) | value >> U64(24), kind="stable")
    value, doc = value[order], doc[order]
    near = np.flatnonzero((doc[1:] == doc[:-1]) & (value[1:] >> U64(24) == value[:-1] >> U64(24)) & (value[1:] < value[:-1]))
    if len(near):  # equal high bits in the wrong order: sort those documents fully
        for d in np.unique(doc[near]).tolist():
            a, b = np.searchsorted(doc, [d, d + 1])
            value[a:b] = np.sort(value[a:b])
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[fresh], np.append(0, np.cumsum(np.bincount(doc[fresh], minlength=len(n))))


def signatures(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash signatures [text, HASHES] of 32 bits; zeros for a text without shingles."""
    out = np.zeros((len(at) - 1, HASHES), np.uint32)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        for k in range(HASHES):
            out[some, k] = np.minimum.reduceat(((values * _A[k] + _B[k]) >> U64(32)).astype(np.uint32), at[:-1][some])
    return out


SKETCH = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, sig binary"


def sketched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        values, at = shingles(batch.column("text"), k)
        sig = signatures(values, at)
        n = np.diff(at)
        total = [np.append(U64(0), np.cumsum(mixed(values + U64(c)), dtype=U64)) for c in (0, 0x5851F42D4C957F2D)]
        keys = [pa.array(signed(mixed(t[at[1:]] - t[at[:-1]] + n.astype(U64))), mask=n == 0) for t in total]
        raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * HASHES), len(n), [None, pa.py_buffer(sig.tobytes())]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n), *keys, raw], names=[c.split()[0] for c in SKETCH.split(", ")])


def signature_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """Bucket of each band of each signature."""
    sig = sig.astype(U64)
    key = np.zeros((len(sig), BANDS), U64) + np.arange(1, BANDS + 1, dtype=U64)
    for r in range(ROWS):
        key = mixed(key * U64(0x9E3779B97F4A7C15) + sig[:, r::ROWS])
    return signed(key)


def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, id) of each band of each signature."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            key = band_keys(signature_rows(part.column("sig")))
            ids = np.repeat(part.column("id").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1)), pa.array(ids)], names=["bucket", "id"])


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, fewest matches to go on): below, P(similarity >= threshold | matches) < miss under a uniform prior.

    With n hashes and m matches the posterior is Beta(m + 1, n - m + 1), whose upper tail is P(Binomial(n + 1, threshold) <= m).
    """
    table = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        table.append((n, m))
    return table


def surviving(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of aligned signature pairs that no batch of hashes prunes, and their matches over all hashes."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, least in least_matches(threshold):
        matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(1)
        go = matches >= least
        alive, matches, done = alive[go], matches[go], n
    return alive, matches


def likely(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            alive, matches = surviving(signature_rows(part.column("sig_a")), signature_rows(part.column("sig_b")), threshold)
            take = pa.array(alive)
            yield pa.RecordBatch.from_arrays([part.column("a").take(take), part.column("b").take(take), pa.array(matches)], names=["a", "b", "matches"])


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal keys within each batch, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            column = batch.column(k).to_numpy(zero_copy_only=False)
            change |= column[1:] != column[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def pruned(sx: np.ndarray, sig: np.ndarray, alive: np.ndarray, table: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows alive of sig those that no batch of hashes prunes beside sx, and their matches."""
    matches, done = np.zeros(len(alive), np.int64), 0
    for n, least in table:
        if not len(alive):
            break
        matches = matches + (sig[alive, done:n] == sx[done:n]).sum(1)
        go = matches >= least
        alive, matches, done = alive[go], matches[go], n
    return alive, matches


def crossed(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Compare each block of a bucket with the bucket's stragglers; rows come by (bucket, block, role), role 0 the block's own.

    Only pairs of different components are looked at. Survivors are not listed: edges (a, b) join the ids that survivors connect,
    about one for each id. The block's rows stay in memory, stragglers stream past them.
    """
    now, blocks, table = None, [], least_matches(threshold)
    for part in grouped(batches, ["bucket", "block", "role"]):
        key = part.column("bucket")[0].as_py(), part.column("block")[0].as_py()
        if key != now:
            now, blocks = key, []
        own = part.column("id").to_numpy(), part.column("label").to_numpy(), signature_rows(part.column("sig"))
        if part.column("role")[0].as_py() == 0:
            blocks.append(own)
            continue
        if len(blocks) > 1:
            blocks = [tuple(np.concatenate(c) for c in zip(*blocks))]
        ids, label, sig = blocks[0]
        root = np.full(len(ids), -1)  # of each row of the block, the place among parents of the straggler that it met
        parents, met, a, b = [], [], [], []
        for x, lx, sx in zip(*own):
            alive, _ = pruned(sx, sig, np.flatnonzero(label != lx), table)
            if not len(alive):
                continue
            mine = len(parents)
            parents.append(mine)
            for other in np.unique(root[alive]).tolist():
                if other < 0:
                    continue
                while parents[other] != other:
                    other = parents[other]
                if other != mine:
                    parents[other] = mine
                    a.append(int(x))
                    b.append(met[other])
            met.append(int(x))
            new = alive[root[alive] < 0]
            a += [int(x)] * len(new)
            b += ids[new].tolist()
            root[alive] = mine
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def settled(batches: Iterator[pa.RecordBatch], threshold: float, percent: int) -> Iterator[pa.RecordBatch]:
    """Links of a family, exactly verified; rows come by (family, block, role), role 0 the block's own and 1 the stragglers.

    A survivor is verified unless a link found here has joined its component with the straggler's; likeliest ones come first.
    """
    now, block, table = None, [], least_matches(threshold)
    for part in grouped(batches, ["family", "block", "role"]):
        key = part.column("family")[0].as_py(), part.column("block")[0].as_py()
        if key != now:
            now, block, joined = key, [], {}
        rows = list(zip(*(part.column(c).to_pylist() for c in ("id", "label", "straggler"))))
        sets = [np.frombuffer(h, U64) for h in part.column("hashes").to_pylist()]
        sig = signature_rows(part.column("sig"))
        if part.column("role")[0].as_py() == 0:
            block.append((rows, sets, sig))
            continue
        if len(block) > 1:
            block = [([r for x in block for r in x[0]], [h for x in block for h in x[1]], np.concatenate([x[2] for x in block]))]
        own_rows, own_sets, own_sig = block[0]
        ids, labels, late = (np.array(c) for c in zip(*own_rows))

        def root(label: int) -> int:
            while label in joined:
                label = joined[label]
            return label

        a, b = [], []
        for (x, lx, _), hx, sx in zip(rows, sets, sig):
            alive, matches = pruned(sx, own_sig, np.flatnonzero((labels != lx) & (~late | (ids > x))), table)
            for i in alive[np.argsort(-matches, kind="stable")].tolist():
                mine, other = root(lx), root(int(labels[i]))
                if mine == other:
                    continue
                hy = own_sets[i]
                same = int((hx[np.minimum(np.searchsorted(hx, hy), len(hx) - 1)] == hy).sum())
                if 100 * same >= percent * (len(hx) + len(hy) - same):
                    a.append(x)
                    b.append(int(ids[i]))
                    joined[mine] = other
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def sets_of(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The batches with each text's sorted shingle hashes in place of the text."""
    for batch in sliced(batches, "text"):
        values, at = shingles(batch.column("text"), k)
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(at.astype(np.int64) * 8), pa.py_buffer(values.tobytes())]).cast(pa.binary())
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), raw], names=[*names, "hashes"])


def verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Exact similarity of each member's set with its centre's; rows come by (grp, part, role), the centre first."""
    now, centre = None, np.empty(0, U64)
    for batch in batches:
        a, b = [], []
        for grp, part, role, id_, raw in zip(*(batch.column(c).to_pylist() for c in ("grp", "part", "role", "id", "hashes"))):
            own = np.frombuffer(raw, U64)
            if role == 0:
                now, centre = (grp, part), own
                continue
            if now != (grp, part):
                continue
            spot = np.minimum(np.searchsorted(centre, own), max(len(centre) - 1, 0))
            same = int((centre[spot] == own).sum()) if len(centre) else 0
            if 100 * same >= percent * (len(centre) + len(own) - same):
                a.append(grp)
                b.append(id_)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def exact(pairs: DataFrame, documents: DataFrame, k: int, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets are similar enough. a is the centre; one with many partners gets several copies."""
    split = F.greatest(F.lit(1), F.ceil(F.col("n") / BESIDE)).cast("int")
    size = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", split.alias("parts"))
    members = salted(pairs, large(size), ["a"], F.col("b"), "inner").select(F.col("b").alias("id"), F.col("a").alias("grp"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"))
    centres = size.select(F.col("a").alias("id"), F.col("a").alias("grp"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"))
    rows = members.unionByName(centres)
    texts = documents.select(F.col("doc_id").alias("id"), "text").join(large(rows), "id").select("grp", "part", "role", "id", "text")
    sets = texts.mapInArrow(lambda it: sets_of(it, k), "grp bigint, part int, role int, id bigint, hashes binary")
    return sets.repartition("grp", "part").sortWithinPartitions("grp", "part", "role", "id").mapInArrow(lambda it: verified(it, percent), "a bigint, b bigint")


def family_links(families: DataFrame, labels: DataFrame, sigs: DataFrame, documents: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified links between components of a family, at least one for each two that are linked. families: (id, label).

    A family's members go to blocks; those outside its largest component, the stragglers, go to every block, with their sets.
    """
    of = written(families.select("id", F.col("label").alias("family")).join(large(labels), "id", "left").select("id", "family", F.coalesce("label", "id").alias("label")), "families")
    parts = of.groupBy("family", "label").agg(F.count("*").alias("size")).groupBy("family").agg(F.max_by("label", F.struct("size", -F.col("label"))).alias("largest"), F.sum("size").alias("n"))
    rows = salted(of, large(parts.where("n > 1")), ["family"], F.col("id"), "inner").withColumn("straggler", F.expr("label <> largest")).withColumn("blocks", F.ceil(F.col("n") / FAMILY).cast("int"))
    texts = documents.select(F.col("doc_id").alias("id"), "text").join(large(rows), "id").join(large(sigs), "id").select("family", "id", "label", "straggler", "blocks", "sig", "text")
    sets = texts.mapInArrow(lambda it: sets_of(it, k), "family bigint, id bigint, label bigint, straggler boolean, blocks int, sig binary, hashes binary")
    own = F.array(F.struct(F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role")))
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(i.alias("block"), F.lit(1).alias("role")))
    dealt = sets.withColumn("to", F.explode(F.when(F.col("straggler"), F.concat(own, every)).otherwise(own))).select("family", F.col("to.block").alias("block"), F.col("to.role").alias("role"), "id", "label", "straggler", "sig", "hashes")
    return dealt.repartition("family", "block").sortWithinPartitions("family", "block", "role", "id").mapInArrow(lambda it: settled(it, percent / 100, percent), "a bigint, b bigint")


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links of percent % Jaccard similarity) and kept.

    1. One pass makes each document's set key and signature; documents with equal sets become one class, named by its smallest id.
    2. Each class takes, of the smallest classes of its band buckets, the one whose signature agrees best; pairs that survive the
       Bayesian pruning are verified on full sets. This links groups of copies to their centre without any pairs within them.
    3. Buckets that still hold several components are compared in blocks: every member outside the bucket's largest component
       against all others. Those that pruning leaves connected are a family, whose components are compared again in blocks that hold the full
       sets, until they are joined or every survivor is verified. No bucket, candidate or partner is capped.

    All joins sort both sides; no table that grows with the documents goes through the driver.

    Losses: a pair at the threshold shares no band with probability 3e-6, and is pruned with one below 1e-9 a batch.

    Null or empty text: no shingles, linked with nothing, its own component. A null doc_id is ignored. Rows that repeat an id
    stand for one document each and share its component. Other columns are ignored. An empty table gives no rows.
    """
    threshold = percent / 100
    documents = prepared(documents).select("doc_id", "text").where("doc_id is not null")
    sketch = written(documents.mapInArrow(lambda it: sketched(it, k), SKETCH), "sketch")
    classes = written(sketch.where("k1 is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")), "classes")
    sigs = classes.select("id", "sig")
    bands = written(sigs.mapInArrow(banded, "bucket bigint, id bigint"), "bands")
    shared = bands.groupBy("bucket").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("n")).where("least < most")
    shared = written(shared.select("bucket", "least", "n"), "buckets")
    stars = salted(bands, large(shared), ["bucket"], F.col("id"), "inner").where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    with_sigs = lambda p: p.join(large(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))), "b").join(large(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))), "a")
    found = with_sigs(stars).select("a", "b", "sig_a", "sig_b").mapInArrow(lambda it: likely(it, threshold), "a bigint, b bigint, matches bigint")
    best = found.groupBy("b").agg(F.max_by("a", F.struct("matches", -F.col("a"))).alias("a")).select("a", "b")
    edges = written(exact(written(best, "pairs"), documents, k, percent), "links")
    labels = components(edges)

    named = bands.join(large(shared.select("bucket", "n")), "bucket").join(large(labels), "id", "left").select("bucket", "id", "n", F.coalesce("label", "id").alias("label"))
    parts = named.groupBy("bucket", "label").agg(F.count("*").alias("size"), F.first("n").alias("n"))
    several = parts.groupBy("bucket").agg(F.max_by("label", F.struct("size", -F.col("label"))).alias("largest"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.first("n").alias("n")).where("lo < hi")
    several = written(several.select("bucket", "largest", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "mixed")
    open_ = salted(bands, large(several), ["bucket"], F.col("id"), "inner").join(large(labels), "id", "left").join(large(sigs), "id")
    open_ = open_.select("bucket", "id", "sig", "largest", "blocks", F.coalesce("label", "id").alias("label"))
    own = open_.select("bucket", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role"), "id", "label", "sig")
    others = open_.where("label <> largest").select("bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), "id", "label", "sig")
    dealt = own.unionByName(others).repartition("bucket", "block").sortWithinPartitions("bucket", "block", "role", "id")
    near = written(dealt.mapInArrow(lambda it: crossed(it, threshold), "a bigint, b bigint").distinct(), "near")
    if not near.isEmpty():
        labels = components(edges.unionByName(written(family_links(components(near), labels, sigs, documents, k, percent), "links")))
    named = classes.select("k1", "k2", "id").join(large(labels), "id", "left").select("k1", "k2", F.coalesce("label", "id").alias("component_id"))
    with_sets = salted(sketch.where("k1 is not null").select("doc_id", "n_shingles", "k1", "k2"), large(named), ["k1", "k2"], F.col("doc_id"), "inner").select("doc_id", "n_shingles", "component_id")
    without = sketch.where("k1 is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return with_sets.unionByName(without).withColumn("kept", F.expr("doc_id = component_id"))
