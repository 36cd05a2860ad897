"""Toxicity of texts: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the n-grams of its distinct lower-cased words, with the words' ends marked, dealt to ``BUCKETS`` by
their hash; a feature's value is 1 + log(n), n the text's distinct words that hold it. Over the labelled sample each bucket has a
log-count ratio

    r = log((p + a) / (P + a B)) - log((q + a) / (Q + a B)),

p and q the toxic and other documents that hold it, P and Q their sums. Buckets whose ratio is within its noise are left
out, so an ordinary word has few features or none. The classifier is logistic regression on the features scaled by r, so a
weight counts as far as the labels' counts bear it out, with its bias and scale fitted on folds that its weights did not see.

Everything fitted comes from at most ``MAX_FIT`` labelled documents, drawn by a hash of their id. Scoring reads each text once, in
the task that reads it, and keeps the weights of words at hand.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, stage, text_of

HELD_OUT, FOLDS = 2, 4
#: Bounds of what is fitted: labelled documents, hash buckets, and buckets with a weight.
MAX_FIT, BUCKETS, MAX_FEATURES = 8_000, 1 << 20, 1 << 14
SHORTEST, LONGEST = 3, 6
#: Added to every count; documents that must hold a feature, and the standard errors its ratio must lie from 0.
SMOOTH, LEAST_DOCS, LEAST_Z = 1.0, 3, 2.5
#: Words whose features a worker keeps at hand.
CACHE = 500_000
DECAY, STEPS, INNER_FOLDS = 2e-3, 300, 4
_WORD = re.compile(r"\w+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def grams(word: str) -> set[int]:
    """Buckets of the n-grams of a word between marks of its ends."""
    marked = f"\x02{word}\x03"
    return {zlib.crc32(marked[i : i + n].encode()) % BUCKETS for n in range(SHORTEST, LONGEST + 1) for i in range(len(marked) - n + 1)}


@dataclass
class Model:
    """Buckets with a weight, their log-count ratios and weights, and the bias. ``known`` is a worker's own cache."""

    buckets: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    known: dict = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Places (in ``buckets``) of the features of a text, ascending, and the number of words that hold each."""
        known, found = self.known, []
        if len(known) > CACHE:
            known.clear()
        for word in words_of(text):
            has = known.get(word)
            if has is None:
                ids = np.fromiter(grams(word), np.int64)
                at = np.minimum(np.searchsorted(self.buckets, ids), max(len(self.buckets) - 1, 0))
                has = known[word] = tuple(at[self.buckets[at] == ids].tolist()) if len(self.buckets) else ()
            if has:
                found += has
        return np.unique(np.array(found, np.int64), return_counts=True)

    def __call__(self, texts: list[str]) -> np.ndarray:
        scaled = self.ratios * self.weights
        found = map(self.features, texts)
        z = np.array([(scaled[at] * (1 + np.log(n))).sum() + self.bias for at, n in found])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of least log loss plus DECAY |w|^2 / 2, by Adam over all rows; a row holds places of features and their values."""
    size, n = np.array([len(at) for at, _ in rows], np.int64), len(rows)
    flat, owner = np.concatenate([at for at, _ in rows] or [np.zeros(0, np.int64)]), np.repeat(np.arange(n), size)
    x = ratios[flat] * np.concatenate([v for _, v in rows] or [np.zeros(0)])
    share = (y.sum() + 1) / (n + 2)
    w, b = np.zeros(len(ratios)), float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2 or not len(flat):
        return w, b
    p, m, s = np.append(w, b), np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, STEPS + 1):
        z = np.bincount(owner, x * p[flat], n) + p[-1]
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        g = np.append(np.bincount(flat, x * e[owner], len(w)) + DECAY * p[:-1], e.sum())
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        p = p - 0.05 * m / (1 - 0.9**t) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    return p[:-1], float(p[-1])


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of least log loss for scores of rows that the weights did not see."""
    scale, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(scale * z + shift, -30, 30)))
        h = p * (1 - p)
        g = np.array([((p - y) * z).sum() + 1e-2 * (scale - 1), (p - y).sum()])
        hess = np.array([[(h * z * z).sum() + 1e-2, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-2]])
        step = np.clip(np.linalg.solve(hess, g), -1, 1)
        scale, shift = float(np.clip(scale - step[0], 0.1, 10)), shift - float(step[1])
    return scale, shift


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_fit: int = MAX_FIT) -> Model:
    """Model from labelled documents outside the held-out fold. Null labels and ids are left out; a document labelled more than once
    takes the majority, ties 1; of rows with one id the smallest text is used. Without labels the model gives 0.5; with one
    class, its smoothed share. Other columns are not read, whatever their names."""
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (remainder(id_col, FOLDS) != HELD_OUT)).groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    n = marks.count()
    if n > max_fit:
        marks = marks.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_003)) < int(1_000_003 * max_fit / n))
    drawn = docs.select(F.col(id_col), text_of(text_col).alias("text")).join(F.broadcast(marks), id_col)  # at most about max_fit rows
    sample = stage(drawn.groupBy(id_col).agg(F.min("text").alias("text"), F.min("y").alias("y")), "toxicity-sample").select("text", "y", F.xxhash64(id_col).alias("h"))

    def count(batches):
        held, known = np.zeros((2, BUCKETS), np.int64), {}
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found: set[int] = set()
                for w in words_of(text.as_py()):
                    if w not in known:
                        known = known if len(known) < CACHE // 10 else {}
                        known[w] = grams(w)
                    found |= known[w]
                held[y, np.fromiter(found, np.int64)] += 1
        at = np.flatnonzero(held.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[1, at]), pa.array(held[0, at])], names=["bucket", "p", "q"])

    counts = sample.select("text", "y").coalesce(8).mapInArrow(count, "bucket long, p long, q long").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    counts = stage(counts, "toxicity-counts")
    total = counts.agg(F.coalesce(F.sum("p"), F.lit(0)).alias("p"), F.coalesce(F.sum("q"), F.lit(0)).alias("q")).first()
    p, q = F.col("p") + SMOOTH, F.col("q") + SMOOTH
    ratio = F.log(p / (total["p"] + SMOOTH * BUCKETS)) - F.log(q / (total["q"] + SMOOTH * BUCKETS))
    # the share of toxic n-grams is taken off what the smoothing alone gives a bucket
    z = F.abs(F.log(p / q) - F.log(F.lit((total["p"] + SMOOTH) / (total["q"] + SMOOTH)))) / F.sqrt(1 / p + 1 / q)
    strong = counts.withColumn("r", ratio).withColumn("z", z).where((F.col("p") + F.col("q") >= LEAST_DOCS) & (F.col("z") >= LEAST_Z))
    top = sorted((r["bucket"], r["r"]) for r in strong.orderBy(F.desc("z"), "bucket").limit(MAX_FEATURES).collect())
    model = Model(np.array([t[0] for t in top], np.int64), np.array([t[1] for t in top], float), np.zeros(len(top)), 0.0)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def placed(batches):
        for batch in batches:
            found = [sent.value.features(t.as_py()) for t in batch.column(0)]
            at, value = (pa.array([v.astype(kind).tobytes() for v in each], pa.binary()) for each, kind in (([f[0] for f in found], np.uint16), ([1 + np.log(f[1]) for f in found], np.float32)))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), at, value], names=["h", "y", "at", "value"])

    rows = sorted((r["h"], r["y"], bytes(r["at"]), bytes(r["value"])) for r in sample.mapInArrow(placed, "h long, y int, at binary, value binary").collect())
    x, y = [(np.frombuffer(r[2], np.uint16).astype(np.int64), np.frombuffer(r[3], np.float32)) for r in rows], np.array([r[1] for r in rows], float)
    model.weights, model.bias = fit_linear(x, y, model.ratios)
    if len(set(y.tolist())) == 2 and len(top):
        out = np.zeros(len(y))
        fold = np.arange(len(y)) % INNER_FOLDS
        for k in range(INNER_FOLDS):
            own = np.flatnonzero(fold != k)
            w, b = fit_linear([x[i] for i in own], y[own], model.ratios)
            for i in np.flatnonzero(fold == k):
                out[i] = ((model.ratios * w)[x[i][0]] * x[i][1]).sum() + b
        scale, shift = calibrate(out, y)
        model.weights, model.bias = model.weights * scale, model.bias * scale + shift
    return model


def with_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a probability of label 1. A null text counts as empty and gets the score of a text without features; repeated rows get
    equal ones; a very long text is read whole; an empty table stays empty. A column called like ``out`` is replaced; all others stay as they
    are, whatever their names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts):
        import pandas as pd

        return pd.Series(sent.value(texts.tolist()), dtype="float64")

    return docs.withColumn(out, probability(text_of(text_col)))
