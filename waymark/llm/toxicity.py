"""Toxicity (4): subword-bag embeddings averaged into a linear softmax, trained jointly in numpy on labelled documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from waymark.llm.arrowtext import LOWER, Spans, distinct_words, flat, ragged, sliced, words
from waymark.llm.runtime import prepared

#: Most training documents of either label, drawn by hash of doc_id.
SAMPLE = 1_000
#: Hash buckets of character n-grams, their vectors' length, lengths of n-grams, and words in an averaged window.
BUCKETS, WIDTH, GRAMS, WINDOW = 1 << 16, 8, (3, 4, 5), 2
EDGE = np.frombuffer(b"<>", np.uint8)
_TRIM = bytes(range(33, 48)) + b":;<=>?@[\\]^_`{|}~"


def grams(forms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Flat n-gram buckets of each word form between edge marks, and their n + 1 offsets."""
    parts = [few_grams(forms[i : i + 20_000]) for i in range(0, len(forms), 20_000)]
    return np.concatenate([b for b, _ in parts]), np.append(0, np.cumsum(np.concatenate([n for _, n in parts])))


def few_grams(forms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Flat n-gram buckets of each form, and how many it has; the temporary arrays are as large as the list is long."""
    marked = [b"<" + (f.strip(_TRIM) or f) + b">" for f in forms]
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    data = LOWER[np.frombuffer(b"".join(marked), np.uint8)]
    end = np.repeat(np.cumsum(size), size)
    hashes = Spans(data.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15)
    at = np.arange(len(data))
    which = np.repeat(np.arange(len(size)), size)
    owner, bucket = [], []
    for n in GRAMS:
        ok = np.flatnonzero(at + n <= end)
        bucket.append((hashes.of(ok, ok + n) % np.uint64(BUCKETS)).astype(np.int32))
        owner.append(which[ok])
    owner = np.concatenate(owner)
    return np.concatenate(bucket)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(size))


class Texts:
    """Words of a batch of texts as n-gram bags, each distinct form once."""

    def __init__(self, texts: pa.Array):
        data, offsets = flat(texts)
        starts, ends, self.at = words(data, offsets)
        self.index, forms = distinct_words(data, starts, ends)
        self.bucket, self.gram_at = grams(forms) if forms else (np.empty(0, np.int32), np.zeros(1, np.int64))
        doc_end = np.repeat(self.at[1:], np.diff(self.at))
        self.window_end = np.minimum(np.arange(len(self.index)) + WINDOW, doc_end)

    def window_values(self, per_gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean of per_gram over the n-grams of the window from each word on, and the number of n-grams in it."""
        total = np.append(0, np.cumsum(per_gram[self.bucket]))
        value = (total[self.gram_at[1:]] - total[self.gram_at[:-1]])[self.index]
        count = np.diff(self.gram_at)[self.index]
        v, c = np.append(0, np.cumsum(value)), np.append(0, np.cumsum(count))
        here = np.arange(len(self.index))
        n = c[self.window_end] - c[here]
        return (v[self.window_end] - v[here]) / np.maximum(n, 1), n

    def best(self, per_gram: np.ndarray, empty: float) -> np.ndarray:
        """Each document's largest window value; empty for one without words."""
        value, _ = self.window_values(per_gram)
        out = np.full(len(self.at) - 1, empty)
        some = np.flatnonzero(np.diff(self.at))
        if len(some):
            out[some] = np.maximum.reduceat(value, self.at[:-1][some])
        return out


class Model:
    """Document score: softmax of the linear layer on the averaged embeddings of its most toxic window, calibrated."""

    def __init__(self, per_gram: np.ndarray, scale: float, shift: float, empty: float):
        self.per_gram, self.scale, self.shift, self.empty = per_gram, scale, shift, empty

    def score(self, texts: pa.Array) -> np.ndarray:
        z = self.scale * Texts(texts).best(self.per_gram, self.empty) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(texts: pa.Array, toxic: np.ndarray, epochs: int = 10, seed: int = 5) -> Model:
    """Train on whole documents of which only the label is known.

    A document is a bag of windows; it is toxic if one of them is. Each epoch takes the windows that the model finds most toxic,
    from documents of either label, and random ones of the others; embeddings and softmax weights take Adam steps on their
    mean cross-entropy together. The first choice of windows is by the n-grams' document odds.
    """
    bag, rng = Texts(texts), np.random.default_rng(seed)
    toxic = toxic.astype(bool)
    n_words = np.diff(bag.at)
    doc = np.repeat(np.arange(len(n_words), dtype=np.int32), n_words)
    df, grams_of = np.zeros((2, BUCKETS)), np.diff(bag.gram_at)
    for d in range(len(n_words)):
        form = np.unique(bag.index[bag.at[d] : bag.at[d + 1]])
        df[int(toxic[d]), np.unique(bag.bucket[ragged(bag.gram_at[form], grams_of[form])])] += 1
    per_gram = np.log((df[1] + 0.5) / (toxic.sum() + 1)) - np.log((df[0] + 0.5) / ((~toxic).sum() + 1))
    per_gram = np.where(df.sum(0) >= 3, np.clip(per_gram, -3, 3), 0)
    table = rng.normal(0, 0.3, (BUCKETS, WIDTH))
    weights, bias = rng.normal(0, 0.3, (WIDTH, 2)), np.zeros(2)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (table, weights, bias)]
    t = 0
    for epoch in range(epochs):
        value, _ = bag.window_values(per_gram)
        order = np.lexsort((-value, doc))
        rank = np.arange(len(order)) - bag.at[:-1][doc[order]]
        take = np.where(toxic[doc[order]], 2, 3)
        chosen = order[rank < take]
        spare = np.flatnonzero(~toxic[doc])
        if len(spare):
            chosen = np.concatenate([chosen, rng.choice(spare, min(len(spare), len(chosen)))])
        chosen = rng.permutation(chosen)
        for part in np.array_split(chosen, max(1, len(chosen) // 512)):
            t += 1
            size = bag.window_end[part] - part
            who = np.repeat(np.arange(len(part)), size)
            form = bag.index[ragged(part, size)]
            count = grams_of[form]
            ids, owner = bag.bucket[ragged(bag.gram_at[form], count)], np.repeat(who, count)
            n = np.maximum(np.bincount(owner, minlength=len(part)), 1)
            mean = np.stack([np.bincount(owner, table[ids, k], minlength=len(part)) for k in range(WIDTH)], 1) / n[:, None]
            logit = mean @ weights + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            y = toxic[doc[part]].astype(int)
            p[np.arange(len(part)), y] -= 1
            weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
            p *= weight[:, None]
            back = (p @ weights.T) / n[:, None]
            used, inverse = np.unique(ids, return_inverse=True)
            slope = np.stack([np.bincount(inverse, back[owner, k], minlength=len(used)) for k in range(WIDTH)], 1)
            for x, g, (m, v), rows in ((table, slope, state[0], used), (weights, mean.T @ p + 1e-5 * weights, state[1], slice(None)), (bias, p.sum(0), state[2], slice(None))):
                m[rows] = 0.9 * m[rows] + 0.1 * g
                v[rows] = 0.99 * v[rows] + 0.01 * g**2
                x[rows] -= 0.03 * (m[rows] / (1 - 0.9**t)) / (np.sqrt(v[rows] / (1 - 0.99**t)) + 1e-8)
        if epoch >= 1:
            per_gram = table @ (weights[:, 1] - weights[:, 0])
    per_gram = table @ (weights[:, 1] - weights[:, 0])
    seen = np.zeros(BUCKETS, bool)
    seen[bag.bucket] = True
    per_gram[~seen] = 0
    empty = float(np.quantile(bag.window_values(per_gram)[0], 0.05)) if len(doc) else -1.0
    best = bag.best(per_gram, empty)
    scale, shift = calibrated(best, toxic)
    return Model(per_gram, scale, shift, empty)


def calibrated(value: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve through the documents' values, both labels weighing the same."""
    mid, spread = float(np.median(value)), float(value.std()) or 1.0
    x = np.stack([(value - mid) / spread, np.ones(len(value))], 1)
    share = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum()))
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (share * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-4 * np.eye(2), x.T @ (share * (p - toxic)) + 1e-4 * (theta - [1, 0]))
        theta -= np.clip(step, -1, 1)
    return float(theta[0] / spread), float(theta[1] - theta[0] * mid / spread)


def fold(doc_id: Column) -> Column:
    """0 for documents whose labels are held out."""
    return F.crc32(doc_id.cast("string")) % 5


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 3) -> Model | None:
    """Fit on at most `sample` labelled documents of either label outside the held-out fold; None without both labels.

    Drawn from the labels that a document with a text has, so labels of absent documents take no place. Rows that repeat a doc_id count once, with the smallest text.
    """
    usable = F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0)
    there = documents.where(usable & F.col("text").isNotNull()).select("doc_id").distinct()
    known = labels.where(F.col("toxic").isNotNull() & usable).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(there, "doc_id", "left_semi")
    drawn = [known.where(F.col("toxic") == c).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample) for c in (0, 1)]
    few = F.broadcast(drawn[0].unionByName(drawn[1]))  # 2 * sample rows of two numbers at most
    rows = documents.select("doc_id", "text").join(few, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).toArrow().sort_by("doc_id")
    toxic = rows["toxic"].to_numpy().astype(int)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    return fit(rows["text"].combine_chunks(), toxic)


def scored(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        score = model.score(batch.column("text")) if model else np.zeros(batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])


def classify(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of documents with score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= 0.5, else 0).

    The model is trained on a bounded sample of labelled whole texts and applied to every whole text in one narrow pass;
    a document's score is that of its most toxic window of words. doc_id, lang, source and labels are no inputs of a score.

    Null or empty text: the score of a document without evidence. Null doc_id: scored too. Repeated rows are scored each.
    A doc_id trains once, however often its row is repeated. Columns of documents stay, but for any named score or predicted. Labels without both values: score 0. Empty table: no rows.
    """
    documents = prepared(documents).drop("score", "predicted")
    model = train(documents, labels, sample)
    schema = StructType([*documents.schema.fields]).add("score", DoubleType()).add("predicted", IntegerType())
    return documents.mapInArrow(lambda it: scored(it, model), schema)
