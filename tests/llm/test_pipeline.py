"""Every stage of the pipeline, on what the stage before kept, against a plain computation of what it must give."""

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import packing, pii, quality

from .test_joins import reach
from .test_mixing import WORD, plain_targets


def plain_quality(model, text):
    """Mean of index and context vectors, word by word, and the network in scalar loops."""
    vectors, net = model
    words, total, n = re.findall(r"\w+|[^\w\s]+", text or ""), np.zeros(2 * quality.DIM), 0
    index, seen, before = quality.index_vectors(), set(), None
    for w in words:
        if w == before:
            row, place = vectors.size - 1, quality.HASHED
        else:
            row = vectors.rows.get(w, len(vectors.rows) + quality.shape(w))
            place = zlib.crc32(w.encode("utf-8", "replace")) % quality.HASHED
        total += np.concatenate((index[place], vectors.table[row]))
        seen.add((row, place))
        before, n = w, n + 1
    x = np.concatenate((total / (n + quality.PRIOR), [len(seen) / (n + quality.PRIOR), np.log1p(n) / 10]))
    hidden = [np.tanh(sum((x[i] - net.mean[i]) / net.scale[i] * net.w[i, k] for i in range(len(x))) + net.c[k]) for k in range(quality.HIDDEN)]
    return 1 / (1 + np.exp(-(sum(h * v for h, v in zip(hidden, net.v)) + net.d) / net.temperature))


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_equal_plain_ones(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = table.unionByName(table.limit(5)).unionByName(table.limit(3).withColumn("text", F.lit(None).cast("string"))).withColumn("score", F.lit("clash")).withColumn("is_kept", F.lit(1)).withColumn("found", F.lit(2)).cache()
    stages = dict(corpus_pipeline.STAGES)
    names = docs.columns

    kept = stages["quality"](spark, docs, sf_dir).cache()
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r["text"]: plain_quality(model, r["text"]) for r in docs.select("text").distinct().collect()}
    want = Counter({k: n for k, n in rows_of(docs).items() if scores[k[names.index("text")]] >= 0.5 - 1e-6})
    assert all(abs(s - 0.5) > 1e-5 for s in scores.values()) and kept.columns == names and rows_of(kept) == want

    single = stages["jaccard"](spark, kept, sf_dir).cache()
    rows = kept.collect()
    sets = {}
    for r in rows:
        w = (r["text"] or "").lower().split()
        sets[r["doc_id"], r["text"]] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    keys = sorted(sets, key=lambda k: (k[0], k[1] or ""))
    pairs = [(i, j) for i in range(len(keys)) for j in range(i) if sets[keys[i]] and len(sets[keys[i]] & sets[keys[j]]) >= 0.8 * len(sets[keys[i]] | sets[keys[j]]) - 1e-9]
    root = reach(range(len(keys)), pairs)
    first = {keys[i] for i in root if root[i] == i}
    got = rows_of(single)
    for (key, text), n in Counter((r["doc_id"], r["text"]) for r in rows).items():
        here = sum(m for row, m in got.items() if row[names.index("doc_id")] == key and row[names.index("text")] == text)
        assert here == (0 if (key, text) not in first else 1 if sets[key, text] else n), key

    clean = stages["pii"](spark, single, sf_dir).cache()
    spans = {(r["doc_id"], r["text"]): [(s["start"], s["end"], s["kind"]) for s in r["spans"]] for r in pii.spans(single.drop("found")).collect()}
    want = Counter()
    for r in single.collect():
        text, at, parts = r["text"], 0, []
        for start, end, kind in sorted(spans[r["doc_id"], text]):
            if start >= at:
                parts += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        text = None if text is None else "".join(parts) + text[at:]
        want[tuple((r.asDict() | {"text": text, "n_chars": None if text is None else len(text)})[c] for c in names)] += 1
    assert rows_of(clean) == want and any("[EMAIL]" in (k[names.index("text")] or "") for k in want)

    mixed = stages["mixing"](spark, clean, sf_dir).cache()
    before, after = clean.collect(), mixed.collect()
    size = lambda text: len(WORD.findall(text or ""))
    sizes = Counter()
    for r in before:
        sizes[r["source"]] += size(r["text"])
    took = Counter()
    for r in after:
        took[r["source"]] += size(r["text"])
    assert all(abs(took[s] - t) <= 1 for s, t in plain_targets(sizes).items())
    source_texts = {}
    for r in before:
        source_texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    assert all(any(t.startswith(r["text"] or "") for t in source_texts[r["doc_id"]]) for r in after)

    pieces = stages["packing"](spark, mixed, sf_dir).collect()
    encode = packing.encoder(*packing.vocabulary_paths())
    need, have, places = Counter(), Counter(), {}
    for r in after:
        need[r["doc_id"], len(encode(r["text"] or "")) + 1] += len(encode(r["text"] or "")) + 1
    for p in pieces:
        have[p["doc_id"], p["doc_tokens"]] += p["length"]
        places.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert have == need
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_run_chains_the_stages(spark, sf_dir):
    a = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, sf_dir).collect())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, sf_dir).cache()
    assert sum(n * k[2] for k, n in a.items()) == docs.agg(F.sum("length")).first()[0]
    assert {k[0] for k in a} == {r[0] for r in docs.select("doc_id").distinct().collect()}
