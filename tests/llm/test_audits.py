"""Toxicity, filter interactions, tokenizer alignment: held-out labels and brute force, odd rows, hot groups, small settings."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, filters_audit, toxicity
from tidemark.llm.packing import vocabulary_paths
from tidemark.llm.queries import ORACLE_SQL

ODD = [(-1, None), (-2, ""), (None, "x"), (-3, "!" * 20_000), (-4, "wort " * 20_000), (-5, "y"), (-5, "y"), (-6, "é😀".encode("utf-16", "surrogatepass").decode("utf-16"))]


def test_toxicity_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    scored = toxicity.with_score(docs.select("doc_id", "text").unionByName(odd).withColumn("Score", F.lit("clash")), model).select("doc_id", "text", "score").collect()
    assert len(scored) == docs.count() + len(ODD) and all(0 <= r["score"] <= 1 for r in scored)
    assert len({r["score"] for r in scored if r["doc_id"] == -5}) == 1
    by_id = {r["doc_id"]: r["score"] for r in scored}
    held = [(r["toxic"], by_id[r["doc_id"]]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    clean, toxic = [s for y, s in held if y == 0], [s for y, s in held if y == 1]
    assert len(toxic) > 10 and np.mean([s < 0.3 for s in clean]) > 0.97 and np.mean([s >= 0.3 for s in toxic]) >= 0.7
    # the score by its definition, from the model's tables
    weight = dict(zip(model.buckets.tolist(), (model.ratios * model.weights).tolist(), strict=True))
    for r in scored[:40]:
        n = Counter(b for w in toxicity.words_of(r["text"] or "") for b in toxicity.grams(w) if b in weight)
        z = model.bias + sum(weight[b] * (1 + np.log(k)) for b, k in n.items())
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-9


def test_ratios_equal_counts(spark):
    rows = [(i, "bad apple" if i % 3 == 0 else "good pear", int(i % 3 == 0)) for i in range(60)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    held = {y: Counter(b for _, t, label in train if label == y for b in {g for w in t.split() for g in toxicity.grams(w)}) for y in (0, 1)}
    p, q = sum(held[1].values()), sum(held[0].values())
    want = {b: np.log((held[1][b] + 1) / (p + toxicity.BUCKETS)) - np.log((held[0][b] + 1) / (q + toxicity.BUCKETS)) for b in {*held[0], *held[1]}}
    assert len(model.buckets) and all(abs(want[b] - r) < 1e-9 for b, r in zip(model.buckets.tolist(), model.ratios.tolist(), strict=True))
    scores = {r["text"]: r["score"] for r in toxicity.with_score(docs, model).collect()}
    assert scores["bad apple"] > 0.8 > 0.2 > scores["good pear"]


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in toxicity.with_score(docs, toxicity.fit(docs, none)).collect()] == [0.5, 0.5]
    null = spark.createDataFrame([(1, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.with_score(docs.limit(0), toxicity.fit(docs, null)).count() == 0


def plain_audit(docs, labels):
    """Every order applied to every document, one filter after the other."""
    first = {}
    for i, _, t in docs:
        if i is not None and (t not in first or first[t] is None or i < first[t]):
            first[t] = i
        first.setdefault(t, None)
    good, toxic = ({i for i, *marks in labels if marks[k] == 1} for k in (0, 1))
    failed = defaultdict(list)
    for i, part, t in docs:
        words = [w for w in t.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
        copy = first[t] is not None and (i is None or i > first[t])
        marks = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), any(c in "#$%&*|" for c in t), copy)
        failed[part].append((i, {f for f, m in zip("ABCDE", marks, strict=True) if m}))
    out = {}
    for part, rows in failed.items():
        shares = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone, kept = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                earlier = set(order[: step - 1])
                shares[f] += len(gone)
                out[part, "".join(order), step] = [len(kept), len(gone), sum(f in m and bool(m & earlier) for _, m in rows), sum(m == {f} for _, m in rows), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
                left = kept
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shares[order[step - 1]])
    return out


def draw_documents(n, seed):
    r = random.Random(seed)
    texts = ["", "one", "A B C", "a # b", "word " * 250, " ".join(f"w{i}" for i in range(300)), "éè  x Y", *(" ".join(r.choice("ab cd Ef g# h".split()) for _ in range(r.randint(1, 260))) for _ in range(12))]
    docs = [(r.choice([None, *range(40)]) if r.random() < 0.3 else 100 + k, r.choice(["", "s1", "s2"]), r.choice(texts)) for k in range(n)]
    docs += [(1000 + k, "s1", texts[4]) for k in range(n)] + [(7, "s2", texts[5])] * n  # copies, and one row again and again
    labels = [(r.choice([None, *range(40), *range(100, 1200)]), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(n)]
    return docs, labels


@pytest.mark.parametrize(("partitions", "seed"), [(1, 1), (3, 2), (40, 3)])
def test_audit_equals_brute_force(spark, partitions, seed):
    docs, labels = draw_documents(150, seed)
    random.Random(seed).shuffle(docs)
    table = spark.createDataFrame([(i, p or None, t or None, 1) for i, p, t in docs], "doc_id long, source string, text string, mask int").repartition(7)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that ranges stay as many, and cut the groups
    try:
        out = filters_audit.audit(table, marks).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in out}
    assert len(out) == len(got) == 3 * 600 and got == plain_audit(docs, labels)


def test_audit_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL['op12_filter_audit']})").fetchall()
    out = filters_audit.audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert sorted(map(tuple, out.select(*columns).collect())) == sorted(want)
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert filters_audit.audit(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_hash_collisions_keep_texts_apart(monkeypatch):
    """Rows of one fingerprint but different texts, and a group that goes on from the range before."""
    import pyarrow as pa

    rows = [(1, "s", "a", 5), (4, "s", "a", 5), (2, "s", "b", 5), (2, "s", "b", 5), (9, "s", "c", 6)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part, strict=True)], names=["id", "part", "text", "fp"]) for part in (rows[:3], rows[3:])]
    out = [r for b in filters_audit._sorted_masks(batches) for r in b.to_pylist()]
    assert [(r["id"], r["mask"] is not None and r["mask"] >= 16, r["edge"] is not None) for r in out] == [(1, False, True), (4, True, False), (2, False, True), (2, False, True), (9, False, False), (9, False, True)]
    assert out[-1]["mask"] is None and out[-1]["edge"] == hashlib.sha256(b"c").digest()


def plain_alignment(docs):
    """Token by token over whole texts, by the tokenizers themselves."""
    import sentencepiece
    from tokenizers import Tokenizer

    json_path, _ = vocabulary_paths()
    a = Tokenizer.from_file(json_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.piece_path())
    byte = {c: v[0] for c, v in alignment._byte_decoder().items()}
    spans, counts = [], Counter()
    for _, text in docs:
        if not text:
            spans.append(None)
            continue
        raw = (" " + text).encode()
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ba = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ba) != raw or b"".join(bb) != raw:
            spans.append(None)
            continue
        at = lambda parts: [(sum(map(len, parts[:k])), sum(map(len, parts[: k + 1]))) for k in range(len(parts))]
        sa, sb = at(ba), at(bb)
        links = [(x, y) for x, (s, e) in enumerate(sa) for y, (t, f) in enumerate(sb) if s < f and t < e]
        counts.update({(ia[x], ib[y]) for x, y in links})
        groups, k, m = [], 0, 0
        for end in sorted({e for _, e in sa} & {e for _, e in sb}):
            u, v = sum(e <= end for _, e in sa), sum(e <= end for _, e in sb)
            groups.append((ia[k:u], ib[m:v]))
            k, m = u, v
        spans.append((ia, ib, groups, [(ia[x], ib[y]) for x, y in links]))
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for (i, _), s in zip(docs, spans, strict=True):
        if s is None:
            out.append((str(i), 0, 0, 0, 0, 0, 0, "", 0))
        else:
            text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in s[2])
            out.append((str(i), len(s[0]), len(s[1]), len(s[2]), len(s[3]), sum(counts[p] == most[p[0]] for p in s[3]), sum(counts[p] for p in s[3]), hashlib.sha256(text.encode()).hexdigest(), sum(len(g) * len(h) for g, h in s[2])))
    return sorted(out)


@pytest.mark.parametrize(("top", "pending", "cache"), [(None, None, None), (5, 50, 3), (0, 1, 1)])
def test_alignment_equals_brute_force(spark, sf_dir, top, pending, cache, monkeypatch):
    r = random.Random(7)
    signs = [*"abcXYZ 01.,;'\n\r\t)}{*/>\"", " ", "　", "é", "漢", "\U0001f600", "▁", "\x00", "\x1c", "\x85", "don't", "<s>", "<|endoftext|>", "<0x0A>", "});\r", "؀"]
    odd = ["".join(r.choice(signs) for _ in range(r.randint(1, 40))) for _ in range(150)] + ["  ", " ", "\n", "é", "x" * 300, "Same text.", "Same text."]
    docs = [(k, t) for k, t in enumerate(odd)] + [(None, "Same text."), (-1, None), (-2, "")]
    docs += [(1000 + x["doc_id"], x["text"][:300] if x["text"] else x["text"]) for x in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    table = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n_a int").repartition(3)
    for name, value in (("PENDING", pending), ("CACHE", cache)):
        if value is not None:
            monkeypatch.setattr(alignment, name, value)
    out = alignment.align(table, top=top).collect()
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_products")
    assert sorted((str(x["doc_id"]), *(x[c] for c in columns)) for x in out) == plain_alignment(docs)
    assert alignment.align(table.limit(0)).count() == 0


def test_alignment_of_long_texts(spark):
    words = " ".join(f"word{i % 997} and, so (on)" for i in range(6000))
    table = spark.createDataFrame([(1, words), (2, "y" * 50_000)], "doc_id string, text string")
    got = {x["doc_id"]: x for x in alignment.align(table).collect()}
    align = alignment.aligner(*vocabulary_paths(), alignment.piece_path())
    whole = align.a.whole.encode(" " + words, add_special_tokens=False).ids
    assert got["1"]["n_a"] == len(whole) and got["1"]["n_b"] == len(align.b.encode(words)) and got["2"]["n_a"] > 0
