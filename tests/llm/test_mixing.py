import re

from pyspark.sql import functions as F

from tidemark.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Share, stop at three times, share the excess anew, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    total = sum(sizes.values())
    fixed, free = {}, set(names)
    while free:
        rest = total - sum(fixed.values())
        w = sum(weight[s] for s in free)
        over = {s for s in free if rest * weight[s] / w > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return fixed | {s: rest * weight[s] / w for s in free}
        fixed |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    return fixed


def check(docs):
    rows = mixing.mix(docs).select("row.*", "size", "source_size", "target", "epochs", "taken").collect()
    assert len(rows) == docs.count()
    sizes = {}
    for r in rows:
        assert r["size"] == len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    targets = plain_targets(sizes)
    took = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - targets[r["source"]]) <= 1e-6 * max(1, r["target"])
        assert r["epochs"] * r["size"] <= r["taken"] <= (r["epochs"] + 1) * r["size"] and r["taken"] <= 3 * r["size"]
        took[r["source"]] += r["taken"]
    for s, n in took.items():
        assert abs(n - targets[s]) <= 1, s
    return rows


def test_targets_and_budgets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = {r["doc_id"]: r["taken"] for r in check(docs)}
    assert first == {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(7)).select("row.doc_id", "taken").collect()}


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " x y\x0bz\n", "a"), (3, " x y\x0bz\n", "a"), (None, "w " * 500, None), (5, "one", ""), (6, "b c d e", "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("row", F.lit(1))
    check(docs.drop("size", "row"))
    mixed = mixing.mix(docs)
    out = mixing.materialise(mixed)
    assert out.columns == docs.columns
    words = out.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words == mixed.agg(F.sum("taken")).first()[0]
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.materialise(mixing.mix(docs.limit(0))).count() == 0


def test_quality_favours(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.when(F.col("id") < 2000, "x").otherwise("y").alias("source"), (F.col("id") % 2 + 0.1).alias("q"))
    rows = mixing.mix(docs, quality=F.col("q")).where("target < source_size").groupBy("row.q").agg(F.sum("taken").alias("n")).collect()
    n = {round(r["q"], 1): r["n"] for r in rows}
    assert n[1.1] > 3 * n[0.1]


def test_any_weights_keep_the_edge_bucket_small(spark, monkeypatch):
    """Low, null and zero weights, and rows equal in id and text, of which a budget may take a part."""
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "a" if i % 10 else "b", (0.05, None, 0.0, 1.0)[i % 4]) for i in range(3000)]
    rows += [(-1, "same words here", "a", 0.05)] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, q double").repartition(5)
    sizes = {}
    for i, t, s, q in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    targets = plain_targets(sizes)
    for quality in (F.col("q"), F.lit(0.05), F.lit(None).cast("double")):
        out = mixing.mix(docs, quality=quality).select("row.*", "size", "taken", "epochs").collect()
        assert len(out) == len(rows)
        took = dict.fromkeys(sizes, 0)
        for r in out:
            assert r["epochs"] * r["size"] <= r["taken"] <= (r["epochs"] + 1) * r["size"]
            took[r["source"]] += r["taken"]
        assert all(abs(took[s] - t) <= 1 for s, t in targets.items())
        assert sum(0 < r["taken"] - r["epochs"] * r["size"] < r["size"] for r in out) <= len(sizes)
    key = mixing.mix(docs, quality=F.col("q"), buckets=4).select("row.doc_id", "taken").groupBy("doc_id").agg(F.sum("taken").alias("n"))
    same = mixing.mix(docs.repartition(3), quality=F.col("q"), buckets=256).select("row.doc_id", "taken").groupBy("doc_id").agg(F.sum("taken").alias("n"))
    assert sorted(map(tuple, key.collect())) == sorted(map(tuple, same.collect()))


def test_edges_of_many_sources_are_shuffled(spark, sf_dir, monkeypatch):
    """Beyond the bound of a broadcast the edges are joined by a shuffle, with the same rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    taken = lambda: {r["doc_id"]: (r["taken"], r["epochs"]) for r in mixing.mix(docs).select("row.doc_id", "taken", "epochs").collect()}
    few = taken()
    monkeypatch.setattr(mixing, "MOST_SOURCES", 0)
    assert taken() == few
    check(docs)
