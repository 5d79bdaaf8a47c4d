"""Quality classifier (1): heuristic labellers, their accuracies by EM, and a hashed linear scorer of the posterior labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from waymark.llm.arrowtext import Spans, by_document, distinct_words, flat, sliced, words
from waymark.llm.runtime import prepared, written

#: Most documents of which the scorer's training set holds features (a uniform sample by hash of doc_id).
SAMPLE = 12_000
#: Score from which a document is kept: clean documents that hold numbers or addresses score lower than prose, junk close to 0.
LEAST = 0.25
BUCKETS = 4096
#: Labellers: name, statistic, the bounds (good below, bad above; between them a labeller abstains), usual value in prose.
LABELLERS = (
    ("signs", "sign_share", 0.045, 0.070, 0.02),
    ("capitals", "upper_share", 0.12, 0.35, 0.02),
    ("stutter", "repeat_share", 0.06, 0.20, 0.0),
    ("variety", "old_share", 0.50, 0.65, 0.2),
    ("separators", "bare_share", 0.03, 0.10, 0.0),
    ("emphasis", "loud_share", 0.02, 0.10, 0.0),
    ("letters", "other_share", 0.24, 0.33, 0.19),
    ("dominance", "top_share", 0.15, 0.22, 0.05),
)
#: Words of usual prose that each document's statistics are mixed with, so that a few words alone prove little.
MIXED_IN = 15
#: Words from which variety and dominance mean anything; shorter documents make these two labellers abstain.
ENOUGH = 40
#: Equal steps of a statistic between 0 and 1 that the scorer sees as one feature.
STEPS = 20
ABSTAIN, GOOD, BAD = 0, 1, 2

_BYTES = np.arange(256)
_LOWER = ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 0xC0)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_FOLLOW = (_BYTES >= 0x80) & (_BYTES < 0xC0)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_SIGN = ~(_LOWER | _UPPER | _DIGIT | _FOLLOW | _SPACE)
#: Kinds of bytes in a word's shape: lower, upper, digit; every sign is a kind of its own.
_KIND = np.where(_LOWER | _FOLLOW, 1, np.where(_UPPER, 2, np.where(_DIGIT, 3, _BYTES + 4))).astype(np.uint64)


def measure(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Statistics of each whole text; the number of its words; the shape bucket of every word; word offsets."""
    data, offsets = flat(texts)
    starts, ends, at = words(data, offsets)
    n = np.diff(at)
    some = np.maximum(n, 1)
    each = {k: by_document(table[data], offsets) for k, table in (("lower", _LOWER), ("upper", _UPPER), ("sign", _SIGN), ("follow", _FOLLOW))}
    chars = np.maximum(np.diff(offsets) - each["follow"], 1)
    index, _ = distinct_words(data, starts, ends)
    doc = np.repeat(np.arange(len(n)), n)
    same = np.zeros(len(index), bool)
    same[1:] = (index[1:] == index[:-1]) & (doc[1:] == doc[:-1])
    pair = np.sort(doc.astype(np.int64) << 32 | index)
    head = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.empty(0, np.int64)
    owner = pair[head] >> 32
    distinct = np.bincount(owner, minlength=len(n))
    top = np.zeros(len(n), np.int64)
    np.maximum.at(top, owner, np.diff(np.append(head, len(pair))))
    sign_total = np.append(0, np.cumsum(_SIGN[data]))
    signs = sign_total[ends] - sign_total[starts]
    tail2 = _SIGN[data[ends - 1]] & _SIGN[data[np.maximum(ends - 2, 0)]] & (ends - starts > 2) if len(ends) else np.empty(0, bool)
    stats = {
        "sign_share": each["sign"] / chars,
        "upper_share": each["upper"] / np.maximum(each["upper"] + each["lower"], 1),
        "repeat_share": by_document(same, at) / some,
        "old_share": 1 - distinct / some,
        "bare_share": by_document(signs == ends - starts, at) / some,
        "loud_share": by_document(tail2, at) / some,
        "other_share": 1 - (each["upper"] + each["lower"]) / chars,
        "top_share": top / some,
    }
    for _, name, _, _, usual in LABELLERS:
        stats[name] = (stats[name] * n + usual * MIXED_IN) / (n + MIXED_IN)
    # Shape of a word: its kinds of bytes, runs of a kind as one.
    kind = _KIND[data]
    change = np.ones(len(data), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[starts] = True
    kept = np.append(0, np.cumsum(change))
    shape = Spans(kind[change] * np.uint64(0x9E3779B97F4A7C15), 0x9E3779B97F4A7C15).of(kept[starts], kept[ends]) if len(starts) else np.empty(0, np.uint64)
    return stats, n, (shape % np.uint64(BUCKETS)).astype(np.int64), at


def votes(stats: dict[str, np.ndarray], n: np.ndarray) -> np.ndarray:
    """The labellers' votes on each document as one number in base 3."""
    total = np.zeros(len(n), np.int64)
    for name, stat, good, bad, _ in LABELLERS:
        vote = np.where(stats[stat] < good, GOOD, np.where(stats[stat] > bad, BAD, ABSTAIN))
        if name in ("variety", "dominance"):
            vote = np.where(n < ENOUGH, ABSTAIN, vote)
        total = total * 3 + np.where(n == 0, ABSTAIN, vote)
    return total


def steps(stats: dict[str, np.ndarray], n: np.ndarray) -> np.ndarray:
    """For each document and labeller the feature of the statistic's step, after the shape buckets."""
    long = np.where(n < ENOUGH, 0, 1)
    return np.stack([BUCKETS + (i * 2 + long) * STEPS + np.clip((stats[s] * STEPS).astype(np.int64), 0, STEPS - 1) for i, (_, s, *_) in enumerate(LABELLERS)], 1)


FEATURES = BUCKETS + 2 * STEPS * len(LABELLERS)


def observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes of every document; features of those in the sample."""
    for batch in sliced(batches, "text"):
        stats, n, shape, at = measure(batch.column("text"))
        step = steps(stats, n)
        chosen = batch.column("sampled").to_numpy(zero_copy_only=False).astype(bool)
        features, weights = [], []
        for i in range(len(n)):
            if not chosen[i]:
                features.append(None)
                weights.append(None)
                continue
            bucket, count = np.unique(shape[at[i] : at[i + 1]], return_counts=True)
            features.append(np.concatenate([bucket, step[i]]).astype(np.int32))
            weights.append(np.concatenate([count / (n[i] + MIXED_IN), np.full(step.shape[1], 1 / len(LABELLERS))]).astype(np.float32))
        yield pa.RecordBatch.from_arrays([pa.array(votes(stats, n)), pa.array(features, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float32()))], names=["votes", "features", "weights"])


def label_model(patterns: dict[int, int], rounds: int = 60) -> tuple[dict[int, float], np.ndarray]:
    """Probability of good for each pattern of votes, and P(vote | class) as [labeller, class, vote], by EM.

    The counts of patterns are all that EM needs of the corpus; there are 3 ** labellers of them at most.
    """
    keys = np.array(sorted(patterns), np.int64)
    count = np.array([patterns[k] for k in keys.tolist()], float)
    m = len(LABELLERS)
    ballot = np.stack([keys // 3 ** (m - 1 - i) % 3 for i in range(m)], 1)
    bad_votes = (ballot == BAD).sum(1)
    good = np.select([bad_votes == 0, bad_votes == 1], [0.95, 0.4], 0.05)
    for _ in range(rounds):
        both = np.stack([good, 1 - good])
        prior = (both * count).sum(1) + 1
        table = np.empty((m, 2, 3))
        for i in range(m):
            for c in range(2):
                seen = np.bincount(ballot[:, i], both[c] * count, minlength=3) + (0.5 if c == 0 else 0.1)
                table[i, c] = seen / seen.sum()
        logs = np.log(prior / prior.sum())[:, None] + sum(np.where(ballot[:, i] == ABSTAIN, 0, np.log(table[i][:, ballot[:, i]])) for i in range(m))
        good = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
    return dict(zip(keys.tolist(), good.tolist())), table


def fit_scorer(features: list[np.ndarray], weights: list[np.ndarray], target: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Weights of a logistic scorer, the last one its bias, by full-batch Adam on soft labels."""
    size = np.array([len(f) for f in features])
    row = np.repeat(np.arange(len(size)), size)
    column, value = np.concatenate(features), np.concatenate(weights).astype(float)
    theta, first, second = (np.zeros(FEATURES + 1) for _ in range(3))
    share = np.where(target > 0.5, 0.5 / max(1, (target > 0.5).sum()), 0.5 / max(1, (target <= 0.5).sum()))
    for t in range(1, rounds + 1):
        z = np.bincount(row, value * theta[column], minlength=len(size)) + theta[-1]
        error = share * (1 / (1 + np.exp(-z)) - target)
        slope = np.append(np.bincount(column, value * error[row], minlength=FEATURES), error.sum()) + 1e-6 * theta
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
    return theta


def scored(batches: Iterator[pa.RecordBatch], theta: np.ndarray, posterior: dict[int, float], prior: float, least: float) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        stats, n, shape, at = measure(batch.column("text"))
        z = by_document(theta[shape], at) / (n + MIXED_IN) + theta[steps(stats, n)].mean(1) + theta[-1]
        score = np.where(n == 0, 0.0, 1 / (1 + np.exp(-np.clip(z, -50, 50))))
        weak = [posterior.get(v, prior) for v in votes(stats, n).tolist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weak, pa.float64()), pa.array(score), pa.array(score >= least)], names=[*batch.schema.names, "weak_posterior", "quality_score", "keep"])


def classify(documents: DataFrame, sample: int = SAMPLE, seed: int = 11, least: float = LEAST) -> DataFrame:
    """The rows of documents with weak_posterior, quality_score (0 to 1, higher is better) and keep (quality_score >= least).

    One pass counts the labellers' vote patterns over all documents; EM on these counts gives the labellers' accuracies and each pattern's
    posterior. The posterior labels of a uniform sample of about `sample` documents train the scorer, and a second pass
    applies it to whole texts. No labels table is read, and lang and source are no inputs. No shuffle but of counts.

    Null or empty text: score 0, not kept. Null doc_id: scored too. Repeated rows are scored each. Columns of documents,
    whatever their names, stay; the three new names replace columns of the same name. An empty table gives no rows.
    """
    documents = prepared(documents).drop("weak_posterior", "quality_score", "keep")
    share = min(1.0, sample / max(1, documents.count()))
    drawn = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.length("text")), F.lit(1_000_000)) < int(share * 1_000_000)).alias("sampled")
    seen = written(documents.select("text", drawn).mapInArrow(observed, "votes bigint, features array<int>, weights array<float>"), "votes")
    patterns = {r["votes"]: r["n"] for r in seen.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    rows = seen.where("features is not null").limit(2 * sample).toArrow()
    theta, posterior, prior = np.zeros(FEATURES + 1), {}, 0.5
    if rows.num_rows:
        posterior, _ = label_model(patterns)
        total = sum(patterns.values())
        prior = sum(posterior[k] * v for k, v in patterns.items()) / total
        target = np.array([posterior[v] for v in rows["votes"].to_pylist()])
        theta = fit_scorer([np.array(f) for f in rows["features"].to_pylist()], [np.array(w) for w in rows["weights"].to_pylist()], target)
    schema = StructType([*documents.schema.fields]).add("weak_posterior", DoubleType()).add("quality_score", DoubleType()).add("keep", BooleanType())
    return documents.mapInArrow(lambda it: scored(it, theta, posterior, prior, least), schema)
