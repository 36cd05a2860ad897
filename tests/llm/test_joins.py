"""Jaccard join, vector links and components against brute force; the pipeline's stages."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chosen_path, embeddings, graph
from tidemark.llm.common import stage


def reach(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(r.randrange(2000, 2400), r.randrange(2000, 2400)) for _ in range(250)]
    r.shuffle(edges)
    want = reach({n for e in edges for n in e if e[0] != e[1]}, edges)
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: want[n] for n in got} and set(got) == {n for n in want if want[n] != n}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def corpus():
    r = random.Random(7)
    word = lambda: "".join(r.choices("abcdefghij", k=5))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(40):
        base = [word() for _ in range(r.randrange(30, 120))]
        for _ in range(r.randrange(1, 5)):
            own = list(base)
            for _ in range(r.randrange(0, 4)):
                own[r.randrange(len(own))] = word()
            texts.append(" ".join(own))
    texts += [" ".join([word() for _ in range(60)] + passage) for _ in range(60)]
    big = [word() for _ in range(150)]
    for i in range(300):  # a group of near copies larger than a block
        own = list(big)
        own[i % 150] = word()
        texts.append(" ".join(own))
    texts += [texts[-1]] * 30 + ["a b", "A  B", "a", "", None, " \n", "x y z w v", "x y z w v u"]
    return texts


def test_jaccard_equals_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(None, texts[0], "clash")], "doc_id long, text string, size string")
    sets = {}
    for i, t in enumerate(texts):
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    links = dict.fromkeys(sets, 0)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    root = reach(sets, pairs)
    least, limit = graph.LEAST, chosen_path.LIMIT
    graph.LEAST, chosen_path.LIMIT = 32, 20  # so that cells have blocks and paths go deep
    try:
        out = chosen_path.join(docs).collect()
    finally:
        graph.LEAST, chosen_path.LIMIT = least, limit
    assert len(out) == len(texts) + 1
    for r in out:
        if r["doc_id"] is None:
            assert (r["class_id"], r["n_links"], r["kept"]) == (None, 0, True)
        else:
            i = r["doc_id"]
            assert (r["class_id"], r["n_links"], r["kept"]) == (root[i], links[i], root[i] == i), i
    assert chosen_path.join(docs.limit(0)).count() == 0


def test_vectors_equal_brute_force(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(60, 16))
    x = np.concatenate([b + 0.08 * r.normal(size=(k, 16)) for b, k in zip(base, r.integers(1, 8, 60))] + [base[0] + 0.02 * r.normal(size=(150, 16))]).astype(np.float32)
    label = r.integers(0, 3, len(x))
    label[-150:] = 1
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))]
    n = len(rows)
    rows += [(n, rows[5][1], rows[5][2]), (n + 1, [0.0] * 16, 1), (n + 2, None, 1), (n + 3, [float("nan")] * 16, 1), (n + 4, rows[0][1], None), (n + 5, [1.0, None], 1), (n + 6, [], 1), (n + 7, rows[5][1][:8], rows[5][2]), (None, rows[5][1], rows[5][2])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("clash"))
    y, k = np.concatenate([x, x[5:6]]).astype(float), np.append(label, label[5])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    s = (y @ y.T >= 0.93) & (k[:, None] == k[None, :])
    np.fill_diagonal(s, False)
    root = reach(range(n + 1), np.argwhere(s).tolist())
    old = embeddings.CELL, embeddings.FAN, graph.LEAST
    for embeddings.CELL, embeddings.FAN, graph.LEAST in (old, (20, 256, 16), (8, 4, 16)):  # the last one with two levels
        out = {r["vec_id"]: r for r in embeddings.near_duplicates(docs).collect()}
        assert len(out) == len(rows)
        for i in range(n + 1):
            assert (out[i]["n_links"], out[i]["component_id"], out[i]["kept"]) == (s[i].sum(), root[i], root[i] == i)
        for i in [*range(n + 1, n + 8), None]:
            assert (out[i]["n_links"], out[i]["component_id"], out[i]["kept"]) == (0, i, True)
    embeddings.CELL, embeddings.FAN, graph.LEAST = old
    assert embeddings.near_duplicates(docs.limit(0)).count() == 0


def test_no_link_is_lost_at_the_usual_settings(spark):
    """Every link by brute force, over vectors without clusters and with, many of them right at the threshold."""
    r = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    plain = unit(r.normal(size=(1500, 64)))
    away = unit(r.normal(size=(500, 64)))
    away = unit(away - (away * plain[:500]).sum(1, keepdims=True) * plain[:500])
    cosine = r.uniform(0.92, 0.945, size=(500, 1))
    near = cosine * plain[:500] + np.sqrt(1 - cosine**2) * away
    clusters = unit(r.normal(size=(12, 1, 64)) + 0.06 * r.normal(size=(12, 100, 64))).reshape(-1, 64)
    x = np.concatenate((plain, near, clusters))
    s = x @ x.T >= 0.93
    np.fill_diagonal(s, False)
    assert 200 < s[:1500, 1500:2000].sum() and s[2000:].sum() > 1000
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {q["vec_id"]: q["n_links"] for q in embeddings.near_duplicates(docs, label_col=None).collect()}
    assert [got[i] for i in range(len(x))] == s.sum(1).tolist()
    tree = embeddings.grow(x, 6)
    assert len(tree[0]) == 6 and all(any(home for *_, home in own) for own in embeddings.place(x, tree, embeddings.margin_of(0.93)))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    twice = docs.unionByName(docs.limit(20)).unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string")))
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, twice, sf_dir)
        assert out.columns == docs.columns, name
        n = out.count()
        assert 0 < n <= 3 * twice.count(), name
        assert step(spark, docs.limit(0), sf_dir).count() == 0
    kept = corpus_pipeline.deduplicated(spark, twice, sf_dir).collect()
    filled = [r["text"] for r in kept if r["text"] and r["text"].split()]
    assert len(filled) == len(set(filled)) and len({r["doc_id"] for r in kept if r["text"]}) == len([r for r in kept if r["text"]])
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert pieces and all(r["length"] > 0 for r in pieces)


def test_sieve_misses_no_member_and_starts_no_worker(spark):
    """Rows of members are told by a join with a small bitmap, not in a second Python worker of the task that shingles texts."""
    members = spark.range(0, 300, 3).selectExpr("id AS node").unionByName(spark.createDataFrame([(None,)], "node long"))
    rows = spark.range(-500, 50_000).selectExpr("id AS node", "id AS filter_none").unionByName(spark.createDataFrame([(None, 0)], "node long, filter_none long"))
    some = graph.only_nodes(rows, members)
    assert "Python" not in some._jdf.queryExecution().executedPlan().toString()
    taken = [r["node"] for r in some.collect()]
    assert {*range(0, 300, 3), None} <= {*taken} and len(taken) == len({*taken}) < 150
    rest = [r["node"] for r in graph.sieve(rows, graph.bitmap(members), "node", "left_anti").collect()]
    assert sorted(map(str, taken + rest)) == sorted(map(str, [*range(-500, 50_000), None]))
    assert graph.only_nodes(rows, members.where("false")).count() == 0


def test_staged_batches_are_bounded(spark):
    """A worker gets few rows at once where texts are staged, and the session keeps its own setting."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def sizes(batches):
        for batch in batches:
            yield type(batch).from_pydict({"n": [batch.num_rows]})

    def most(rows):
        return stage(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long"), "sizes", rows).agg(F.max("n")).first()[0]

    before = spark.conf.get(key)
    assert most(None) == 5000 and most(chosen_path.BATCH) == chosen_path.BATCH and spark.conf.get(key) == before
    try:
        spark.conf.set(key, 100)
        assert most(chosen_path.BATCH) == 100 and spark.conf.get(key) == "100"
    finally:
        spark.conf.set(key, before)
