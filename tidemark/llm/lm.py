"""Log-probabilities of texts by a log-bilinear model trained with noise-contrastive estimation.

Words fall into classes: the most frequent ones have a class of their own, the end of a text has one, and all others
share classes by a hash of their last three bytes. In a shared class the words of the vocabulary have an entry
each, and one more entry, the tail, stands for all other words. With r the context vectors of the two tokens before (of
words, not of classes), C a matrix for each position, q and b target vectors and biases of classes and of entries,

    s(x | u, v) = q(x) . (C1 r(u) + C2 r(v)) + b(x)

gives the probability of a class, normalised over all classes, and that of an entry, normalised over the entries of
its class; both are smoothed by their unigram distribution. A word of a tail has (c + 1) / (n + v + 1) of it, with c its
training count and n, v the words and distinct words of the tail. Scores of a batch are matrix products.

Spark counts every training word (partial counts in Arrow batches, then a shuffle by word), and trains
on every training token. Each partition runs NCE from the same start and passes on the rows it has touched, which are
averaged row by row, weighted by how often each was used: a rare word keeps what the few partitions that hold it have
learnt. A first round over one text in ``FIRST`` gives the start of the round over all, so that the model gains from what
other partitions hold. Counts of at most ``N_TOP`` words go to all tasks; the others, counted per document, are joined
by word, which leaves no word frequent enough to be a hot key. All sizes of the model are fixed, so that it cannot tell
a text that the corpus repeats from one that occurs once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, stage, text_of

HELD_OUT, FOLDS = 2, 7
#: Most words whose counts go to all tasks; words with a class of their own; with an entry; shared classes; dimensions.
N_TOP, N_OWN, N_WORDS, N_SHARED, DIM = 150_000, 64, 12_352, 96, 16
#: Tokens a step; noise classes a step; noise entries a token; rates of rows and of matrices; share of the unigram distribution.
BATCH, NOISE, ENTRY_NOISE, RATE, MATRIX_RATE, SMOOTH = 8192, 24, 1, 0.06, 0.01, 0.05
#: One text in so many takes part in the first round.
FIRST = 24
#: Distinct words a task counts before it passes them on.
FLUSH = 250_000


def words_of(text: str) -> list[bytes]:
    """Words as bytes, A-Z lower-cased: bytes split at ASCII white space only."""
    return text.encode().lower().split()


def count_words(texts: DataFrame) -> DataFrame:
    """word, n over the column ``text``."""

    def run(batches):
        counts: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()

        for batch in batches:
            for text in batch.column(0):
                counts.update(words_of(text.as_py()))
                if len(counts) > FLUSH:
                    yield from out()
        if counts:
            yield from out()

    return texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Words:
    """index: words whose counts all tasks have, by falling count, and, as the empty word, the end; log_c: log10(c + 1) of each, with
    c = known > 0. cls: their classes; below ``own`` are single words, ``own`` is the end, then the shared ones. entry: their
    entries, -1 for those of single classes. Entries lie class by class, from ``start``, the tail last."""

    index: dict[bytes, int]
    log_c: np.ndarray
    known: np.ndarray
    cls: np.ndarray
    entry: np.ndarray
    own: int
    start: np.ndarray
    noise: np.ndarray  # unigram distribution of the classes
    entry_noise: np.ndarray  # of the entries, in their class
    tail: np.ndarray  # log10(n + v + 1) of the words in a class's tail
    train_tokens: int
    distinct: int

    @property
    def classes(self) -> int:
        return len(self.noise)

    @property
    def entries(self) -> int:
        return len(self.entry_noise)

    @property
    def symbols(self) -> int:
        """Kinds of context: single classes, entries, and last the start of a text."""
        return self.own + 2 + self.entries

    def ids(self, texts: list[str]):
        """Tokens of texts, one after the other: words, index (-1: none), class, entry (-1: none), and where each text ends."""
        tokens, ends = [], []
        for text in texts:
            tokens += words_of(text)
            tokens.append(b"")
            ends.append(len(tokens))
        find = self.index.get
        index = np.fromiter(map(find, tokens, repeat(-1)), np.int64, len(tokens))
        cls, entry = self.cls[index], self.entry[index]
        rare = np.flatnonzero(index < 0)
        cls[rare] = [self.own + 1 + zlib.crc32(tokens[i][-3:]) % (len(self.start) - 1) for i in rare.tolist()]
        entry[rare] = self.start[cls[rare] - self.own] - 1
        return tokens, index, cls, entry, np.array(ends)

    def is_tail(self, cls: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return (entry >= 0) & (entry + 1 == self.start[np.maximum(cls - self.own, 0)])

    def contexts(self, cls: np.ndarray, entry: np.ndarray, ends: np.ndarray):
        """Symbols one and two tokens before; the last symbol stands for the start of a text."""
        symbol, begin = np.where(entry < 0, cls, self.own + 1 + entry), self.symbols - 1
        first = np.concatenate(([0], ends[:-1]))
        u = np.concatenate(([begin], symbol[:-1]))
        v = np.concatenate(([begin], u[:-1]))
        u[first] = begin
        v[first] = begin
        v[first[ends - first > 1] + 1] = begin
        return u, v


def _frequent(counts: DataFrame) -> list:
    """At most N_TOP words with their counts, the most frequent: all that are beyond a count, found from a histogram of its logarithm."""
    level = F.floor(8 * F.log2("n"))
    sizes = sorted(((r["l"], r["n"]) for r in counts.groupBy(level.alias("l")).agg(F.count("*").alias("n")).collect()), reverse=True)  # some hundreds
    total, least = 0, None
    for at, n in sizes:
        total += n
        if total > N_TOP:
            break
        least = at
    if least is None:
        return []
    return sorted(counts.where(level >= least).collect(), key=lambda r: (-r["n"], r["word"]))


def learn_words(counts: DataFrame, n_texts: int) -> Words:
    top = _frequent(counts)
    own, n_words = min(N_OWN, len(top)), min(N_WORDS, len(top))
    index = {r["word"].encode(): i for i, r in enumerate(top)}
    c = np.array([r["n"] for r in top] + [n_texts], float)
    suffix = F.pmod(F.crc32(F.expr("substring(cast(word AS binary), -3, 3)")), F.lit(N_SHARED))
    totals = {r["k"]: (r["n"], r["v"]) for r in counts.groupBy(suffix.alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    rest = np.array([totals.get(k, (0, 0)) for k in range(N_SHARED)], float).reshape(N_SHARED, 2)
    n_all, v_all = rest.sum(0)
    group = np.array([zlib.crc32(w[-3:]) % N_SHARED for w in index], np.int64)
    single, mass = group[:own], np.zeros(N_SHARED)
    np.subtract.at(rest, single, np.stack([c[:own], np.ones(own)], 1))
    mass[:] = rest[:, 0]  # words of each shared class, tails included
    np.subtract.at(rest, group[own:n_words], np.stack([c[own:n_words], np.ones(n_words - own)], 1))  # what is left are the tails
    inside = np.bincount(group[own:n_words], minlength=N_SHARED) + 1
    start = np.concatenate(([0], np.cumsum(inside)))
    order = np.argsort(group[own:n_words], kind="stable")
    entry = np.full(len(top) + 1, -1)
    ranked = group[own:n_words][order]
    entry[own + order] = start[ranked] + np.arange(len(order)) - (np.cumsum(inside - 1) - (inside - 1))[ranked]
    entry[n_words : len(top)] = start[group[n_words:] + 1] - 1
    cls = np.concatenate((np.arange(own), own + 1 + group[own:], [own])).astype(np.int64)
    entry_mass = np.ones(int(start[-1]))
    np.add.at(entry_mass, entry[own:n_words], c[own:n_words])
    entry_mass[start[1:] - 1] += rest[:, 0]
    entry_noise = entry_mass / np.repeat(np.add.reduceat(entry_mass, start[:-1]), inside)
    noise = np.concatenate((c[:own], [n_texts], mass)) + 1.0
    index[b""] = len(top)
    return Words(index, np.log10(c + 1), c > 0, cls, entry, own, start, noise / noise.sum(), entry_noise, np.log10(rest.sum(1) + 1), int(n_all) + n_texts, int(v_all) + (n_texts > 0))


class Model:
    """All parameters as rows of one table, so that they can be averaged row by row: context vectors, classes, entries (target vector and
    bias), then the rows of C1 and C2."""

    def __init__(self, words: Words, table: np.ndarray | None = None) -> None:
        sizes = (words.symbols, words.classes, words.entries, DIM, DIM)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        if table is None:
            draw = np.random.default_rng(3)
            table = np.zeros((edges[-1], DIM + 1), np.float32)
            table[: edges[1], :DIM] = draw.normal(0, 0.3, (edges[1], DIM))
            table[edges[1] : edges[3], :DIM] = draw.normal(0, 0.05, (edges[3] - edges[1], DIM))
            table[edges[1] : edges[2], DIM] = np.log(words.noise)
            table[edges[2] : edges[3], DIM] = np.log(words.entry_noise)
            table[edges[3] : edges[4], :DIM] = np.eye(DIM)
            table[edges[4] :, :DIM] = 0.5 * np.eye(DIM)
        self.table, self.edges = table, edges
        self.context, self.classes, self.entries, self.c1, self.c2 = (table[a:z] for a, z in zip(edges, edges[1:], strict=False))


class Trainer:
    """Noise-contrastive estimation with Adagrad. A batch shares its noise classes; a token of a shared class has noise entries of its own,
    drawn from that class. A row moves by the mean gradient of its uses in the batch."""

    def __init__(self, words: Words, table: np.ndarray | None = None, held: float = 0.02) -> None:
        self.words = words
        self.m = Model(words, None if table is None else table.copy())
        self.sq = np.full_like(self.m.table, held)
        self.used = np.zeros(len(self.m.table))
        self.draw = np.random.default_rng(5)
        self.cum, self.log_kq = np.cumsum(words.noise), np.log(NOISE * words.noise).astype(np.float32)
        # in-class distributions one after the other: entry e of the k-th shared class ends at k plus its cumulated share
        within = np.cumsum(words.entry_noise)
        before = np.repeat(np.concatenate(([0.0], within[words.start[1:-1] - 1])), np.diff(words.start))
        self.entry_cum = within - before + np.repeat(np.arange(len(words.start) - 1), np.diff(words.start))
        self.entry_log_kq = np.log(ENTRY_NOISE * words.entry_noise).astype(np.float32)

    def _move(self, offset: int, index: np.ndarray, grads: np.ndarray, counted: int) -> None:
        """Rows move by the mean of their gradients; ``counted``: how many of the gradients, from the first, count as uses."""
        order = np.argsort(index, kind="stable")  # radix sort, as indexes are short integers
        ranked = index[order]
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        g = np.add.reduceat(grads[order], first, axis=0)
        g /= np.diff(np.append(first, len(ranked)))[:, None].astype(np.float32)
        rows = ranked[first].astype(np.int64) + offset
        sq = self.sq[rows]
        sq += g * g
        self.sq[rows] = sq
        g *= np.float32(RATE)
        g /= np.sqrt(sq)
        self.m.table[rows] += g
        self.used[rows] += np.add.reduceat((order < counted).astype(np.float64), first)

    def step(self, u: np.ndarray, v: np.ndarray, cls: np.ndarray, entry: np.ndarray) -> None:
        m, words, edges, n = self.m, self.words, self.m.edges, len(u)
        symbol = np.where(entry < 0, cls, words.own + 1 + entry)  # in this order what is gathered lies together, single classes first
        order = np.argsort(symbol.astype(np.uint16 if words.symbols <= 1 << 16 else np.int64), kind="stable")
        u, v, cls, entry = u[order], v[order], cls[order], entry[order]
        z = np.minimum(np.searchsorted(self.cum, self.draw.random(NOISE)), words.classes - 1)
        ru, rv = m.context[u], m.context[v]  # their last column is zero
        c1, c2 = np.zeros((DIM + 1, DIM + 1), np.float32), np.zeros((DIM + 1, DIM + 1), np.float32)
        c1[:DIM], c2[:DIM] = m.c1, m.c2
        h = ru @ c1
        h += rv @ c2
        h[:, DIM] = 1  # meets the bias
        qw, qz = m.classes[cls], m.classes[z]
        good = 1 / (1 + np.exp(np.einsum("ij,ij->i", h, qw) - self.log_kq[cls]))
        bad = -1 / (1 + np.exp(self.log_kq[z] - h @ qz.T))
        dh = good[:, None] * qw
        dh += bad @ qz
        total = np.zeros((words.classes, DIM + 1), np.float32)
        first = np.flatnonzero(np.diff(cls, prepend=-1))
        total[cls[first]] = np.add.reduceat(good[:, None] * h, first, axis=0)
        np.add.at(total, z, bad.T @ h)
        g = total / (n * self.words.noise[:, None]).astype(np.float32)  # by the uses that are to be expected
        at = slice(edges[1], edges[2])
        self.sq[at] += g * g
        m.classes += np.float32(RATE) * g / np.sqrt(self.sq[at])
        self.used[at] += np.bincount(cls, minlength=words.classes) + n * words.noise
        begin = int(np.searchsorted(cls, words.own, "right"))
        if begin < n:
            hs, e, k = h[begin:], entry[begin:], cls[begin:] - words.own - 1
            noise = np.searchsorted(self.entry_cum, (k + self.draw.random((ENTRY_NOISE, len(k)))).ravel())
            noise = np.clip(noise, np.tile(words.start[k], ENTRY_NOISE), np.tile(words.start[k + 1] - 1, ENTRY_NOISE))
            every = np.concatenate((e, noise))  # the words themselves first
            q = m.entries[every]
            reps = q.reshape(ENTRY_NOISE + 1, len(k), DIM + 1)
            pull = np.einsum("kij,ij->ki", reps, hs)
            pull -= self.entry_log_kq[every].reshape(ENTRY_NOISE + 1, -1)
            pull = -1 / (1 + np.exp(-pull))
            pull[0] += 1
            dh[begin:] += np.einsum("ki,kij->ij", pull, reps)
            grads = (pull[:, :, None] * hs[None]).reshape(len(every), DIM + 1)
            self._move(edges[2], every.astype(np.uint16), grads, len(e))
        dh[:, DIM] = 0
        grads = np.empty((2 * n, DIM + 1), np.float32)
        np.matmul(dh, c1.T, out=grads[:n])
        np.matmul(dh, c2.T, out=grads[n:])
        grads[:, DIM] = 0
        self._move(0, np.concatenate((u, v)).astype(np.uint16), grads, 2 * n)
        for at, r in ((edges[3], ru), (edges[4], rv)):
            g = (r.T @ dh)[:DIM] / np.float32(n)
            self.sq[at : at + DIM] += g * g
            m.table[at : at + DIM] += np.float32(MATRIX_RATE) * g / np.sqrt(self.sq[at : at + DIM])
            self.used[at : at + DIM] += n


def _round(texts: DataFrame, words: Words, table: np.ndarray | None) -> np.ndarray:
    """The table after each partition has trained on its texts from ``table``, averaged row by row."""
    shared = texts.sparkSession.sparkContext.broadcast((words, table))
    start = Model(words, table).table
    n_rows = len(start)

    def run(batches):
        own, first = shared.value
        trainer = Trainer(own, first)
        waiting: list[list[np.ndarray]] = [[], [], [], []]

        def learn():
            u, v, cls, entry = map(np.concatenate, waiting)
            mixed = trainer.draw.permutation(len(cls))
            for k in range(0, len(cls), BATCH):
                at = mixed[k : k + BATCH]
                trainer.step(u[at], v[at], cls[at], entry[at])
            for part in waiting:
                part.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                _, _, cls, entry, ends = own.ids(batch.column(0).slice(at, 256).to_pylist())
                for part, x in zip(waiting, (*own.contexts(cls, entry, ends), cls, entry), strict=True):
                    part.append(x)
                if sum(map(len, waiting[2])) >= 32 * BATCH:
                    learn()
        if waiting[2]:
            learn()
        touched = np.flatnonzero(trainer.used)
        for at in range(0, len(touched), 8192):
            rows = touched[at : at + 8192]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(trainer.used[rows]), pa.array([x.tobytes() for x in trainer.m.table[rows]], pa.binary())], names=["row", "used", "x"])

    def mean(batches):
        total, weight = np.zeros((n_rows, DIM + 1)), np.zeros(n_rows)
        for batch in batches:
            rows, used = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            np.add.at(total, rows, used[:, None] * np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float32).reshape(-1, DIM + 1))
            np.add.at(weight, rows, used)
        rows = np.flatnonzero(weight)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array([x.tobytes() for x in (total[rows] / weight[rows, None]).astype(np.float32)], pa.binary())], names=["row", "x"])

    models = texts.select("text").mapInArrow(run, "row long, used double, x binary")
    table = start.copy()
    for r in models.repartition(16, "row").mapInArrow(mean, "row long, x binary").collect():  # one row a row of the table, whatever the input
        table[r["row"]] = np.frombuffer(bytes(r["x"]), np.float32)
    return table


def train(texts: DataFrame, words: Words) -> np.ndarray:
    """The model's table after both rounds."""
    some = texts.where(F.pmod(F.xxhash64("text", F.lit(31)), F.lit(FIRST)) == 0)
    return _round(texts, words, _round(some, words, None))


class Scorer:
    """A model with the contexts' products at hand. Biases lie in one more row, which meets a one. As a score of a class is a sum of what
    the two contexts add, its exponential is a product: one table has the factors of the nearer symbol, one those of the farther,
    each row divided by its largest, and a normaliser is the product of two rows."""

    def __init__(self, words: Words, table: np.ndarray) -> None:
        m = Model(words, table)
        self.words = words
        near, far = m.context[:, :DIM] @ m.c1[:, :DIM], m.context[:, :DIM] @ m.c2[:, :DIM]
        self.near, self.far = np.append(near, np.ones((len(near), 1), np.float32), 1), np.append(far, np.zeros((len(far), 1), np.float32), 1)
        self.q, self.entry_q = np.ascontiguousarray(m.classes.T), m.entries
        self.near_factor, self.far_factor = self._factors(self.near), self._factors(self.far)

    def _factors(self, contexts: np.ndarray) -> np.ndarray:
        score = contexts @ self.q
        score -= score.max(1, keepdims=True)
        return np.exp(score, out=score)

    def _classes(self, u: np.ndarray, v: np.ndarray, h: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Smoothed log10 probabilities of classes, normalised by row."""
        near, far = self.near_factor[u], self.far_factor[v]
        total, rows = np.einsum("ij,ij->i", near, far).astype(np.float64), np.arange(len(cls))
        p = near[rows, cls].astype(np.float64) * far[rows, cls] / np.maximum(total, 1e-300)
        low = np.flatnonzero(total < 1e-25)  # the contexts favour classes far apart, beyond what single precision can hold
        if len(low):
            p[low] = self._exact(h[low], self.q, cls[low])
        return np.log10((1 - SMOOTH) * p + SMOOTH * self.words.noise[cls])

    @staticmethod
    def _exact(h: np.ndarray, q: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        score = h.astype(np.float64) @ q
        score -= score.max(1, keepdims=True)
        return np.exp(score[np.arange(len(chosen)), chosen]) / np.exp(score).sum(1)

    @staticmethod
    def _log10(h: np.ndarray, q: np.ndarray, chosen: np.ndarray, noise: np.ndarray) -> np.ndarray:
        """Smoothed log10 probabilities of the columns ``chosen`` of h q, normalised by row."""
        score = h @ q
        mine = score[np.arange(len(chosen)), chosen].astype(np.float64)
        with np.errstate(over="ignore"):  # an infinite sum is added up again below
            np.exp(score, out=score)
            total = (score @ np.ones(score.shape[1], np.float32)).astype(np.float64)
        p = np.exp(np.minimum(mine, 60)) / np.maximum(total, 1e-300)
        wild = np.flatnonzero((total < 1e-25) | (total > 1e25))  # beyond what single precision can add up
        if len(wild):
            p[wild] = Scorer._exact(h[wild], q, chosen[wild])
        return np.log10((1 - SMOOTH) * p + SMOOTH * noise[chosen])

    def log10(self, u: np.ndarray, v: np.ndarray, cls: np.ndarray, entry: np.ndarray, width: int = 1024) -> np.ndarray:
        """log10 of the probability of each class, and of its entry if it has any, after the symbols u and v. Scores of ``width`` tokens are
        held at once, so that they stay in the processor's cache."""
        words, out = self.words, np.empty(len(cls))
        h = self.near[u] + self.far[v]
        for at in range(0, len(cls), width):
            part = slice(at, at + width)
            out[part] = self._classes(u[part], v[part], h[part], cls[part])
        shared = np.flatnonzero(entry >= 0)
        shared = shared[np.argsort(cls[shared].astype(np.int16), kind="stable")]
        edges = np.flatnonzero(np.diff(cls[shared], prepend=-1, append=-1))
        for a, z in zip(edges, edges[1:], strict=False):
            k = cls[shared[a]] - words.own - 1
            lo, hi = words.start[k], words.start[k + 1]
            for at in range(a, z, width):
                rows = shared[at : min(z, at + width)]
                out[rows] += self._log10(h[rows], self.entry_q[lo:hi].T, entry[rows] - lo, words.entry_noise[lo:hi])
        return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, n_tokens, n_known, train_tokens, base_score, score for each row.

    A null text counts as empty and has its end token alone; a null id counts as the empty text where folds are
    drawn. Repeated rows are scored, and trained on, as often as they come. If no row is in the training folds,
    train_tokens is 0 and the model is its start. Other columns are not read. Long texts are scored whole.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    held = remainder(id_col, FOLDS) == HELD_OUT
    texts = docs.select(F.col(id_col), held.alias("held_out"), text_of(text_col).alias("text"))
    training = texts.where(~F.col("held_out"))
    counts = stage(count_words(training), "lm-counts")
    words = learn_words(counts, training.count())
    sent = docs.sparkSession.sparkContext.broadcast((words, train(training, words)))
    schema = f"{id_col} {kind}, held_out boolean, n_tokens long, n_known long, base double, model double, rare array<struct<word: string, n: long>>"
    names = [id_col, "held_out", "n_tokens", "n_known", "base", "model", "rare"]
    pair = pa.struct([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        scorer = Scorer(*sent.value)
        words = scorer.words
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                tokens, index, cls, entry, ends = words.ids(batch.column(2).to_pylist())
                u, v = words.contexts(cls, entry, ends)
                first = np.concatenate(([0], ends[:-1]))
                frequent = index >= 0
                log_c = np.where(frequent, words.log_c[index], 0.0)
                model = scorer.log10(u, v, cls, entry)
                tail = np.flatnonzero(words.is_tail(cls, entry))  # the counts of words that only the join knows are added there
                model[tail] += log_c[tail] - words.tail[cls[tail] - words.own - 1]
                rare = [Counter(tokens[i] for i in (np.flatnonzero(index[a:b] < 0) + a).tolist()) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
                said = pa.array(list(chain.from_iterable(rare)), pa.binary()).cast(pa.string())
                times = pa.array(list(chain.from_iterable(c.values() for c in rare)), pa.int64())
                edges = np.concatenate(([0], np.cumsum([len(c) for c in rare]))).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays([said, times], fields=list(pair)))
                known = np.add.reduceat(frequent & words.known[index], first, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ends - first, pa.int64()), pa.array(known), pa.array(np.add.reduceat(log_c, first)), pa.array(np.add.reduceat(model, first)), found], names=names)

    scored = stage(texts.mapInArrow(run, schema).withColumn("rid", F.monotonically_increasing_id()), "lm-scored")
    rest = scored.select("rid", F.explode("rare").alias("r")).select("rid", "r.word", F.col("r.n").alias("times")).join(counts, "word")
    rest = rest.groupBy("rid").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").alias("also"))
    more, scale = F.coalesce("more", F.lit(0.0)), float(np.log10(words.train_tokens + words.distinct + 1))
    return scored.drop("rare").join(rest, "rid", "left").select(
        id_col, "held_out", "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(words.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * scale).alias("base_score"), (F.col("model") + more).alias("score"),
    )
