"""Quality of texts: random-indexing word vectors, pooled per document, and a small numpy network.

Every word has a sparse random index vector, found by its hash; the context vector of a counted word is the sum of the
index vectors of the words around it. All other words share a context vector per shape (case,
digits, symbols, length), and a word said again at once becomes one entry of its own. A document is the
mean of its words' index and context vectors, shrunk towards zero where words are few. A network of two
layers learns from these; a temperature fitted on a part it did not see calibrates its
probabilities.

Everything that is fitted comes from at most ``MAX_FIT`` labelled documents, drawn by a hash of their id, so the
vocabulary, the vectors and the network have fixed sizes. Scoring reads each text once, in the task that reads it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, stage, text_of

HELD_OUT, FOLDS = 1, 3
#: Bounds of what is fitted: labelled documents, and words with a context vector. Index vectors, dealt by the words' hashes.
MAX_FIT, MAX_WORDS, HASHED = 8_000, 10_000, 1 << 15
#: Words whose places a worker keeps at hand, and documents whose words' vectors it holds at once.
CACHE, SLICE = 100_000, 32
DIM, SEEDS, WINDOW, HIDDEN, EPOCHS = 48, 6, 2, 24, 60
_TOKEN = re.compile(r"\w+|[^\w\s]+")
#: The shapes, then the entry of a word that repeats the one before.
_SHAPES = 6 * 5 + 1
#: Words of a document's mean that count as zero vectors.
PRIOR = 10


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text)


def shape(word: str) -> int:
    kind = 0 if word.islower() else 1 if word.isupper() else 2 if word.istitle() else 3 if word.isdigit() else 4 if word.isalnum() else 5
    return kind * 5 + min(len(word) // 3, 4)


@lru_cache(maxsize=1)
def index_vectors() -> np.ndarray:
    """Sparse random vectors by a word's hash, ``SEEDS`` ones of either sign each; the last one is zero."""
    draw = np.random.default_rng(23)
    out = np.zeros((HASHED + 1, DIM), np.float32)
    place = np.argsort(draw.random((HASHED, DIM)), axis=1)[:, :SEEDS]
    out[np.arange(HASHED)[:, None], place] = draw.choice((-1.0, 1.0), (HASHED, SEEDS))
    return out


class Vectors:
    """Every word has the index vector of its hash. ``table`` holds context vectors, of the counted words and then of the shapes, which stand
    for all other words; a shape's also holds a random vector of its own."""

    def __init__(self, words: list[str]) -> None:
        self.rows = {w: i for i, w in enumerate(words)}
        self.size = len(words) + _SHAPES
        self.table = np.zeros((self.size, DIM), np.float32)
        self.known: dict[str, int] = {}

    def code(self, word: str) -> int:
        """Row of the table and place of the index vector in one number."""
        row = self.rows.get(word)
        return (len(self.rows) + shape(word) if row is None else row) * (HASHED + 1) + zlib.crc32(word.encode("utf-8", "replace")) % HASHED

    def ids(self, text: str) -> list[int]:
        known, again, words = self.known, (self.size - 1) * (HASHED + 1) + HASHED, tokens(text)
        if len(known) > CACHE:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = self.code(w)
        return [again if w == before else known[w] for w, before in zip(words, [None, *words], strict=False)]

    def contexts(self, texts) -> np.ndarray:
        out, index = np.zeros((self.size, DIM)), index_vectors()
        for text in texts:
            ids = np.array(self.ids(text), np.int64)
            x, around = index[ids % (HASHED + 1)], np.zeros((len(ids), DIM), np.float32)
            for k in range(1, min(WINDOW, len(ids) - 1) + 1):
                around[k:] += x[:-k]
                around[:-k] += x[k:]
            np.add.at(out, ids // (HASHED + 1), around)
        return out

    def learn(self, contexts: np.ndarray) -> None:
        length = np.linalg.norm(contexts, axis=1, keepdims=True)
        self.table[:] = contexts / np.maximum(length, 1e-9) * np.sqrt(SEEDS)
        self.table[len(self.rows) :] += index_vectors()[:_SHAPES]

    def pool(self, texts: list[str]) -> np.ndarray:
        """Mean vectors, the share of distinct words and the logarithm of the length; an empty text is all zeros."""
        parts = [self._pool(texts[k : k + SLICE]) for k in range(0, len(texts), SLICE)]
        return np.concatenate(parts) if parts else np.zeros((0, 2 * DIM + 2), np.float32)

    def _pool(self, texts: list[str]) -> np.ndarray:
        ids = [self.ids(t) for t in texts]
        n = np.array([len(x) for x in ids])
        out = np.zeros((len(texts), 2 * DIM + 2), np.float32)
        full = np.flatnonzero(n)
        if len(full):
            flat = np.fromiter((i for x in ids for i in x), np.int64, int(n.sum()))
            starts, index = (np.cumsum(n) - n)[full], index_vectors()
            rows, place = np.divmod(flat, HASHED + 1)
            out[full, :DIM] = np.add.reduceat(index[place], starts, axis=0) / (n[full, None] + PRIOR)
            out[full, DIM:-2] = np.add.reduceat(self.table[rows], starts, axis=0) / (n[full, None] + PRIOR)
            out[:, -2] = [len(set(x)) for x in ids] / (n + PRIOR)
        out[:, -1] = np.log1p(n) / 10
        return out


@dataclass
class Network:
    """Two layers over standardised features: sigmoid((tanh(x W + c) . v + d) / temperature)."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    c: np.ndarray
    v: np.ndarray
    d: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w + self.c) @ self.v + self.d

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, decay: float = 1e-3) -> Network:
    """Adam on the log loss over four fifths, the temperature of least log loss on the rest. With no rows or one class
    the network gives the smoothed share of label 1."""
    x = x.astype(np.float64)
    draw = np.random.default_rng(11)
    f = x.shape[1]
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(f), np.ones(f))
    share = (y.sum() + 1) / (len(y) + 2)
    net = Network(mean, scale, draw.normal(0, 1 / np.sqrt(f), (f, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return net
    order = draw.permutation(len(x))
    cut = max(1, len(x) // 5)
    calib, own = order[:cut], order[cut:]
    p = {"w": net.w, "c": net.c, "v": draw.normal(0, 0.3, HIDDEN), "d": np.array([net.d])}
    m, s, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    z = (x - mean) / scale
    for _ in range(max(EPOCHS, -(-2000 * 64 // len(own)))):
        for rows in np.array_split(draw.permutation(own), max(1, len(own) // 64)):
            h = np.tanh(z[rows] @ p["w"] + p["c"])
            e = (1 / (1 + np.exp(-np.clip(h @ p["v"] + p["d"], -30, 30))) - y[rows]) / len(rows)
            back = np.outer(e, p["v"]) * (1 - h * h)
            grads = {"w": z[rows].T @ back + decay * p["w"], "c": back.sum(0), "v": h.T @ e + decay * p["v"], "d": np.array([e.sum()])}
            t += 1
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                p[k] = p[k] - 0.003 * m[k] / (1 - 0.9**t) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    net.w, net.c, net.v, net.d = p["w"], p["c"], p["v"], float(p["d"][0])
    logits, truth = net.logits(x[calib]), y[calib]
    loss = lambda temp: np.logaddexp(0, np.where(truth > 0, -logits, logits) / temp).mean()
    net.temperature = float(min(np.geomspace(1, 8, 31), key=loss))
    return net


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_fit: int = MAX_FIT) -> tuple[Vectors, Network]:
    """Vectors and network from labelled documents outside the held-out fold. Null labels are left out; a document
    labelled more than once takes the majority, ties 1; of rows with one id the smallest text is used."""
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (remainder(id_col, FOLDS) != HELD_OUT)).groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    n = marks.count()
    if n > max_fit:
        marks = marks.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_003)) < int(1_000_003 * max_fit / n))
    drawn = docs.select(F.col(id_col), text_of(text_col).alias("text")).join(F.broadcast(marks), id_col)
    sample = stage(drawn.groupBy(id_col).agg(F.min("text").alias("text"), F.min("y").alias("y")), "quality-sample").select("text", "y", F.col(id_col).alias("id"))

    sample_texts = sample.select("text").coalesce(8)  # each of at most eight tasks sums what it counts before it passes it on

    def count(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(tokens(text.as_py()))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    top = sample_texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n >= 3").orderBy(F.desc("n"), "word").limit(MAX_WORDS)
    vectors = Vectors([r["word"] for r in top.collect()])
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def contexts(batches):
        total = np.zeros((sent.value.size, DIM))
        for batch in batches:
            total += sent.value.contexts(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["sums"])

    parts = sorted(bytes(r[0]) for r in sample_texts.mapInArrow(contexts, "sums binary").collect())  # eight blocks of fixed size
    total = np.zeros((vectors.size, DIM))
    for part in parts:
        total += np.frombuffer(part, np.float32).reshape(total.shape)
    vectors.learn(total)
    learned = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(batches):
        for batch in batches:
            x = learned.value.pool(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([row.tobytes() for row in x], pa.binary())], names=["id", "y", "x"])

    kind = sample.schema["id"].dataType.simpleString()
    rows = sorted((str(r["id"]), r["y"], bytes(r["x"])) for r in sample.select("id", "text", "y").mapInArrow(pooled, f"id {kind}, y int, x binary").collect())
    x = np.array([np.frombuffer(r[2], np.float32) for r in rows]).reshape(len(rows), 2 * DIM + 2)
    return vectors, fit_network(x, np.array([r[1] for r in rows], float))


def with_score(docs: DataFrame, model: tuple[Vectors, Network], text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a probability of label 1. A null text counts as empty and gets a score too; repeated rows get equal
    ones. A column called like ``out`` is replaced; all others stay as they are, whatever their names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        pa.default_memory_pool().release_unused()  # what the batch before has left
        vectors, network = sent.value
        parts = (texts.slice(k, 256).to_pylist() for k in range(0, len(texts), 256))
        return pa.array(np.concatenate([network(vectors.pool(part)) for part in parts] or [np.zeros(0)]))

    return docs.withColumn(out, probability(text_of(text_col)))
