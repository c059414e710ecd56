"""Quality classifier by positive-unlabelled learning.

Trusted positives are the documents labelled good; unlabelled text is a sample of all documents, labels unseen. The class
prior is estimated from how a first separator of positives and unlabelled text ranks both (best bin estimate), and a small
network minimises the non-negative unbiased risk: prior * R+ on positives, plus max(0, R- on unlabelled - prior * R- on
positives). Training reads a bounded, documented sample; scoring reads every whole text in one pass.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolake.llm.common import bounded_rows, whole_text

FOLDS = 5
N_FEATURES = 24
BATCH = 2048


def fold_of(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; fold 0 is held out. Null doc_id: null."""
    return F.crc32(doc_id.cast("string")) % FOLDS


def text_features(text: str) -> np.ndarray:
    """Fixed-length measures of one whole text; nothing else of the document is used."""
    raw = text.encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
    words = raw.split()
    m = max(1, len(words))
    kinds = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    lengths = np.fromiter(map(len, kinds), np.int64, len(kinds)) if kinds else np.zeros(1, np.int64)
    times = np.fromiter(kinds.values(), np.int64, len(kinds)) if kinds else np.zeros(1, np.int64)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper, lower, digit = c[65:91].sum(), c[97:123].sum(), c[48:58].sum()
    symbols = c[[35, 36, 37, 38, 42, 60, 62, 124]].sum()
    marks = c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum()
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return np.array(
        [
            np.log1p(len(raw)), np.log1p(len(words)), (lengths * times).sum() / m, lengths.max(initial=0) ** 0.5, upper / n * 10, upper / max(1, upper + lower), digit / n * 10,
            symbols / m * 3, c[33] / m * 3, c[124] / m * 3, marks / m, c[46] / m * 3, c[44] / m * 3, c[10] / m * 5, c[128:].sum() / n * 5,
            len(kinds) / m, np.log1p(len(kinds)) / np.log1p(m), times.max(initial=0) / m * 3, pairs / m, same / m * 3,
            len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)), np.log1p(m / max(1, len(lines))), float(not words),
        ]
    )


@dataclass
class Network:
    """One hidden layer on standardised features; the output is the log-odds of label 1."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _softplus_grad(z: np.ndarray, sign: float) -> np.ndarray:
    """Gradient of log(1 + exp(-sign * z))."""
    return -sign / (1 + np.exp(np.clip(sign * z, -30, 30)))


def _fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, hidden: int, steps: int, seed: int) -> Network:
    """Adam on mini-batches. prior None: plain positives against unlabelled; else the non-negative risk."""
    rng = np.random.default_rng(seed)
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-6
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    d = both.shape[1]
    theta = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    m1, m2 = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    # large batches: the risk of the few negatives is a difference of two means, and its noise would look like overfit
    n_p, n_u = min(BATCH, len(p)), min(BATCH, len(u))
    for step in range(1, steps + 1):
        xp = p if n_p == len(p) else p[rng.integers(0, len(p), n_p)]
        xu = u if n_u == len(u) else u[rng.integers(0, len(u), n_u)]
        hp, hu = np.tanh(xp @ theta[0] + theta[1]), np.tanh(xu @ theta[0] + theta[1])
        zp, zu = hp @ theta[2] + theta[3], hu @ theta[2] + theta[3]
        if prior is None:
            gp, gu = 0.5 * _softplus_grad(zp, 1), 0.5 * _softplus_grad(zu, -1)
        else:
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if negative >= 0:
                gp, gu = prior * _softplus_grad(zp, 1) - prior * _softplus_grad(zp, -1), _softplus_grad(zu, -1)
            else:  # the risk of negatives went below zero: step back along it
                gp, gu = prior * _softplus_grad(zp, -1), -_softplus_grad(zu, -1)
        grads = [0.0] * 4
        for x, h, g in ((xp, hp, gp / n_p), (xu, hu, gu / n_u)):
            back = np.outer(g, theta[2]) * (1 - h * h)
            for i, part in enumerate((x.T @ back, back.sum(0), h.T @ g, g.sum(keepdims=True))):
                grads[i] = grads[i] + part
        rate = 0.01 * (1 - step / steps) + 1e-4
        for i, g in enumerate(grads):
            g = g + 1e-4 * theta[i]
            m1[i] = 0.9 * m1[i] + 0.1 * g
            m2[i] = 0.999 * m2[i] + 0.001 * g * g
            theta[i] = theta[i] - rate * (m1[i] / (1 - 0.9**step)) / (np.sqrt(m2[i] / (1 - 0.999**step)) + 1e-8)
    return Network(mean, scale, theta[0], theta[1], theta[2], float(theta[3][0]))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in unlabelled text: at the top of the ranking unlabelled text is all positive, so the least
    ratio of the two tails, with a margin for their sampling error, is the prior."""
    n_p, n_u = len(positive), len(unlabelled)
    cuts = np.quantile(positive, np.linspace(0, 0.9, 91))
    tail_p = (positive[None, :] >= cuts[:, None]).mean(1)
    tail_u = (unlabelled[None, :] >= cuts[:, None]).mean(1)
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(n_p) + 1 / np.sqrt(n_u))
    best = int(np.argmin((tail_u + margin) / tail_p))
    return float(np.clip(tail_u[best] / tail_p[best], 0.01, 0.99))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, hidden: int = 24, steps: int = 1000, seed: int = 3) -> tuple[Network, float]:
    """The scorer and the prior. Half of each side fits the separator, the other half estimates the prior."""
    half_p, half_u = np.arange(len(positive)) % 2 == 0, np.arange(len(unlabelled)) % 2 == 0
    first = _fit(positive[half_p], unlabelled[half_u], None, hidden, steps // 2, seed)
    prior = estimate_prior(first.logit(positive[~half_p]), first.logit(unlabelled[~half_u]))
    return _fit(positive, unlabelled, prior, hidden, steps, seed), prior


def with_features(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and _x: features of the whole text (null: empty)."""
    kept = docs.select(*keep, whole_text().alias("_whole"))
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([text_features(t).tolist() for t in batch.column(n).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], x], names=[*keep, "_x"])

    return kept.mapInArrow(run, T.StructType([*docs.select(*keep).schema.fields, T.StructField("_x", T.ArrayType(T.DoubleType()))]))


def training_sample(docs: DataFrame, labels: DataFrame, n_positive: int, n_unlabelled: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of at most ``n_positive`` documents labelled 1 and ``n_unlabelled`` documents of any kind, fold 0 left out.

    The first of each by a hash of doc_id; so the sample is the same at every run, and its bound is the parameter.
    """
    order = F.xxhash64(F.col("doc_id"), F.lit(seed))
    learn = fold_of(F.col("doc_id")) != 0
    good = labels.where(F.col("quality") == 1).where(learn).select("doc_id").distinct().orderBy(order, "doc_id").limit(n_positive)
    some = docs.where(learn).select("doc_id").orderBy(order, "doc_id").limit(n_unlabelled)
    # at most n_positive + n_unlabelled ids: a bounded broadcast
    want = good.withColumn("_p", F.lit(True)).unionByName(some.distinct().withColumn("_p", F.lit(False))).groupBy("doc_id").agg(F.max("_p").alias("_good"), F.max(~F.col("_p")).alias("_any"))
    rows = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(want), F.col("_id") == F.col("doc_id"))
    # repeated documents of one id are one example
    found = bounded_rows(with_features(rows.dropDuplicates(["_id"]), ["_id", "_good", "_any"]), n_positive + n_unlabelled, "training sample")
    found.sort(key=lambda r: r["_id"])
    x = lambda flag: np.array([r["_x"] for r in found if r[flag]]).reshape(-1, N_FEATURES)
    return x("_good"), x("_any")


def score_quality(docs: DataFrame, labels: DataFrame, keep: Sequence[str] | None = None, n_positive: int = 6000, n_unlabelled: int = 12000, threshold: float = 0.3, seed: int = 11, with_text: bool = False) -> DataFrame:
    """``keep`` columns (doc_id by default), held_out, score, predicted for every row of ``docs``; with_text: and _whole,
    the text with null as empty.

    Null or empty text is scored like any text without words. Without 20 positives and 20 unlabelled documents there
    is nothing to learn: every score is 0.5. Null doc_ids are scored, never learnt from, and not held out. Columns named
    like a result are replaced by it; extra columns are ignored.
    """
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in ("held_out", "score", "predicted")]
    positive, unlabelled = training_sample(docs, labels, n_positive, n_unlabelled, seed)
    model = fit_pu(positive, unlabelled, seed=seed)[0] if min(len(positive), len(unlabelled)) >= 20 else None
    kept = docs.select(*keep, F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), whole_text().alias("_whole"))
    n = len(keep) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(n).to_pylist()
            x = np.array([text_features(t) for t in texts]).reshape(-1, N_FEATURES)
            score = np.full(len(texts), 0.5) if model is None else model.score(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: n + with_text], pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32), pa.int32())],
                names=[*keep, "held_out", *["_whole"] * with_text, "score", "predicted"],
            )

    schema = T.StructType([*(kept if with_text else kept.drop("_whole")).schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return kept.mapInArrow(run, schema)
