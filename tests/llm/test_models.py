"""Classifier and language model: held-out accuracy, brute-force counts, normalised probabilities, odd rows."""

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lm, quality


def test_quality_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit(docs, labels)
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "x"), (-3, "!" * 20_000), (-4, "wort " * 20_000)], "doc_id long, text string")
    scored = quality.with_score(docs.select("doc_id", "text").unionByName(odd).withColumn("score", F.lit("clash")), model).select("doc_id", "score").collect()
    by_id = {r["doc_id"]: r["score"] for r in scored}
    assert len(scored) == docs.count() + 5 and all(0 <= r["score"] <= 1 for r in scored)
    held = [(r["quality"], by_id[r["doc_id"]]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(held) > 50 and np.mean([(s >= 0.5) == (q == 1) for q, s in held]) > 0.97


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in quality.with_score(docs, quality.fit(docs, none)).collect()] == [0.5, 0.5]
    null = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.with_score(docs.limit(0), quality.fit(docs, null)).count() == 0


def test_base_scores_equal_brute_force(spark, sf_dir):
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "  \x0b"), (None, "The THE the"), (-4, "unseenword " * 3), (-4, "unseenword " * 3)], "doc_id long, text string")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(odd).withColumn("base", F.lit(1))
    rows = [(r["doc_id"], lm.words_of(r["text"] or "") + ["end"]) for r in docs.collect()]
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    c = Counter(w for i, words in rows if not held(i) for w in words)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in rows)
    old = lm.N_TOP
    lm.N_TOP = 500  # so that most words take the joined way
    try:
        out = lm.score(docs).collect()
    finally:
        lm.N_TOP = old
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out) == want
    assert {r["train_tokens"] for r in out} == {n}
    own = [(r["score"], r["base_score"]) for r in out if r["held_out"]]
    assert sum(s for s, _ in own) > sum(b for _, b in own)
    assert lm.score(docs.limit(0)).count() == 0


@pytest.fixture
def small(monkeypatch):
    """Few classes and entries, so that all can be listed."""
    for name, n in (("N_OWN", 5), ("N_WORDS", 40), ("N_SHARED", 4), ("N_TOP", 60)):
        monkeypatch.setattr(lm, name, n)


def learnt(spark):
    r = np.random.default_rng(2)
    order = [f"w{i:02d}" for i in range(90)]
    texts = []
    for _ in range(300):  # a word is mostly followed by the next one
        at, words = int(r.integers(90)), []
        for _ in range(40):
            words.append(order[at])
            at = (at + 1) % 90 if r.random() < 0.9 else int(r.integers(90))
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    counts = lm.count_words(docs).cache()
    words = lm.learn_words(counts, docs.count())
    return texts, docs, {r["word"].encode(): r["n"] for r in counts.collect()}, words


def plain_log10(words, table, counts, tokens, i):
    """The definition, token by token, in double precision."""
    m, d = lm.Model(words, table.astype(np.float64)), lm.DIM
    _, _, cls, entry, _ = words.ids([" ".join(t.decode() for t in tokens[:-1])])
    symbol = [c if e < 0 else words.own + 1 + e for c, e in zip(cls.tolist(), entry.tolist())]
    u = symbol[i - 1] if i > 0 else words.symbols - 1
    v = symbol[i - 2] if i > 1 else words.symbols - 1
    h = m.context[u, :d] @ m.c1[:, :d] + m.context[v, :d] @ m.c2[:, :d]

    def pick(rows, noise, k):
        e = np.exp(rows[:, :d] @ h + rows[:, d])
        return (1 - lm.SMOOTH) * e[k] / e.sum() + lm.SMOOTH * noise[k]

    p = pick(m.classes, words.noise, cls[i])
    if entry[i] >= 0:
        k = cls[i] - words.own - 1
        lo, hi = words.start[k], words.start[k + 1]
        p *= pick(m.entries[lo:hi], words.entry_noise[lo:hi], entry[i] - lo)
        if entry[i] == hi - 1:
            tail = [w for w in counts if zlib.crc32(w[-3:]) % lm.N_SHARED == k and (w not in words.index or words.entry[words.index[w]] == entry[i])]
            p *= (counts.get(tokens[i], 0) + 1) / (sum(counts[w] for w in tail) + len(tail) + 1)
    return math.log10(p)


def test_scores_equal_the_definition(spark, small):
    texts, docs, counts, words = learnt(spark)
    assert len(words.index) <= 61
    assert words.train_tokens == sum(counts.values()) + len(texts) and words.distinct == len(counts) + 1
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts[:20], "w00 nowhere w01", "", "w89"])], "doc_id long, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    got = {r["doc_id"]: r["score"] for r in lm.score(rows).collect()}
    # the query learns from its own rows: the same steps again
    own = rows.where(~F.col("doc_id").isin(*[i for i in range(23) if held(i)])).select("text")
    c = lm.count_words(own).cache()
    w = lm.learn_words(c, own.count())
    n = {r["word"].encode(): r["n"] for r in c.collect()}
    t = lm.train(own, w)
    for i, text in enumerate([*texts[:20], "w00 nowhere w01", "", "w89"]):
        tokens = lm.words_of(text) + [b""]
        assert got[i] == pytest.approx(sum(plain_log10(w, t, n, tokens, k) for k in range(len(tokens))), abs=2e-3), i


def test_training_learns_order(spark, small):
    texts, _, counts, words = learnt(spark)
    trainer = lm.Trainer(words)
    _, _, cls, entry, ends = words.ids(texts)
    u, v = words.contexts(cls, entry, ends)
    for k in range(400):
        at = trainer.draw.integers(0, len(cls), 1024)
        trainer.step(u[at], v[at], cls[at], entry[at])
    tokens = lm.words_of(texts[0]) + [b""]
    model = [plain_log10(words, trainer.m.table, counts, tokens, i) for i in range(len(tokens))]
    plain = [math.log10((counts.get(t, len(texts)) + 1) / (words.train_tokens + words.distinct)) for t in tokens]
    assert np.mean(model) > np.mean(plain) + 0.15, (np.mean(model), np.mean(plain))


def test_probabilities_sum_to_one(spark, small):
    _, docs, counts, words = learnt(spark)
    scorer = lm.Scorer(words, lm.train(docs, words))
    pairs = [(c, -1) for c in range(words.own + 1)] + [(words.own + 1 + k, e) for k in range(lm.N_SHARED) for e in range(words.start[k], words.start[k + 1])]
    cls, entry = (np.array(x) for x in zip(*pairs))
    for u, v in ((0, 0), (words.symbols - 1, words.symbols - 1), (words.own + 3, 2)):
        p = 10 ** scorer.log10(np.full(len(cls), u), np.full(len(cls), v), cls, entry)
        assert p.sum() == pytest.approx(1, abs=1e-4)


def test_vocabulary_is_cut_at_a_count(spark, small):
    counts = spark.createDataFrame([(f"w{i}", 1 + 1000 // (i + 1)) for i in range(500)], "word string, n long")
    top = lm._frequent(counts)
    assert 0 < len(top) <= 60 and min(r["n"] for r in top) > max(1 + 1000 // (i + 1) for i in range(len(top), 500)) - 1
    assert lm._frequent(spark.createDataFrame([(f"w{i}", 1) for i in range(500)], "word string, n long")) == []
    none = lm.learn_words(counts.limit(0), 0)
    assert none.train_tokens == 0 and none.classes == lm.N_SHARED + 1


def test_classes_equal_plain_softmax_also_far_apart(spark):
    """Class probabilities from two tables of factors equal a softmax in double precision, also where scores leave single precision."""
    words = learnt(spark)[3]
    draw = np.random.default_rng(2)
    for scale in (1, 30):
        table = lm.Model(words).table * scale
        scorer = lm.Scorer(words, table)
        u, v = draw.integers(0, words.symbols, 300), draw.integers(0, words.symbols, 300)
        cls = draw.integers(0, words.classes, 300)
        h = scorer.near[u] + scorer.far[v]
        score = h.astype(np.float64) @ scorer.q
        score -= score.max(1, keepdims=True)
        p = np.exp(score[np.arange(300), cls]) / np.exp(score).sum(1)
        plain = np.log10((1 - lm.SMOOTH) * p + lm.SMOOTH * words.noise[cls])
        assert np.abs(scorer._classes(u, v, h, cls) - plain).max() < 1e-3 * scale


def test_kept_words_of_quality_are_bounded():
    """A worker's cache of words stays small beside a worker's share of an executor; what is dropped is only looked up again."""
    vectors, first = quality.Vectors(["w1"]), None
    for k in range(30):
        ids = vectors.ids(" ".join(f"w{i}" for i in range(10_000 * k, 10_000 * (k + 1))))
        first = first or ids
        assert len(vectors.known) <= 110_000
    assert vectors.ids(" ".join(f"w{i}" for i in range(10_000))) == first


def test_quality_pools_many_texts_in_little_memory():
    """The words' vectors of a whole batch never lie in a worker at once; each text has the features it has alone."""
    texts = [" ".join(f"w{(i * j) % 997}" for j in range(400)) for i in range(1000)] + ["", "w1"]
    vectors = quality.Vectors([f"w{i}" for i in range(500)])
    vectors.table[:] = np.random.default_rng(5).normal(size=vectors.table.shape)
    alone = np.concatenate([vectors.pool([t]) for t in (texts[:3] + texts[-2:])])
    tracemalloc.start()
    try:
        out = vectors.pool(texts)
        assert tracemalloc.get_traced_memory()[1] < 30e6  # 400,000 words of two vectors are 154 MB
    finally:
        tracemalloc.stop()
    assert np.array_equal(out[[0, 1, 2, -2, -1]], alone)
    assert vectors.pool([]).shape == (0, out.shape[1])
