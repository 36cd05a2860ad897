"""Names looked up by their rarest piece, against every name in every text; canonical tables joined where they lie."""

import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.functions import substrings
from tidemark.operators import bars, funding, inventory
from tidemark.sources import canonical


def test_names_equal_brute_force(spark):
    r = random.Random(1)
    signs = "ABé漢\U0001f600 1\n"
    texts = [(i, "".join(r.choice(signs) for _ in range(r.randint(0, 60)))) for i in range(200)] + [(1000, ""), (1001, "A" * 20_000)]
    names = sorted({"".join(r.choice(signs) for _ in range(r.randint(1, 6))) for _ in range(300)} | {"A" * 50, "missing"})
    got = inventory.names_in_texts(spark.createDataFrame(texts, "_id long, _text string"), spark.createDataFrame([(n,) for n in names], "name string")).collect()
    want = {(i, n) for i, t in texts for n in names if n in t}
    assert len(got) == len(want) and {tuple(x) for x in got} == want
    assert inventory.names_in_texts(spark.createDataFrame(texts, "_id long, _text string"), spark.createDataFrame([], "name string")).count() == 0


def test_any_number_of_names(spark):
    r = random.Random(2)
    words = sorted({"".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(r.randint(5, 8))) for _ in range(300_000)})
    texts = [(i, " ".join(r.choice(words) for _ in range(20))) for i in range(50)]
    names = spark.createDataFrame([(w,) for w in words], "name string")
    got = {tuple(x) for x in inventory.names_in_texts(spark.createDataFrame(texts, "_id long, _text string"), names).collect()}
    known = set(words)
    assert got == {(i, t[a : a + n]) for i, t in texts for n in range(5, 9) for a in range(len(t) - n + 1) if t[a : a + n] in known}


def test_names_move_no_text(spark, tmp_path):
    """By each of the three ways the same names are found; with an index that goes to all tasks only counts of pieces are shuffled."""
    r = random.Random(3)
    texts = [(i, "".join(r.choice("ABé\U0001f600 ") for _ in range(r.randint(0, 40))), i % 3) for i in range(300)] + [(300, None, 0)]
    names = sorted({"".join(r.choice("ABé\U0001f600 ") for _ in range(r.randint(1, 5))) for _ in range(200)})
    want = {(i, k, n) for i, t, k in texts if t for n in names if n in t}
    rows = spark.createDataFrame(texts, "_id long, _text string, part int").select("_id", "part", "_text")
    table = spark.createDataFrame([(n,) for n in names], "name string")
    for few, most in ((1000, 1000), (10, 1000), (10, 10)):
        got = inventory.names_in_texts(rows, table, few=few, most=most)
        assert sorted(tuple(x) for x in got.select("_id", "part", "name").collect()) == sorted(want)
        if most == 1000:
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def scratch_files(spark):
    folder = Path(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:"))
    return {p for p in folder.rglob("part-*") if p.is_file()}


def test_beyond_the_bound_neither_texts_nor_results_move(spark):
    """More names than go to all tasks: no text is staged, and what is found is not shuffled."""
    r = random.Random(4)
    words = sorted({"".join(r.choice("ABCDEFGHé") for _ in range(r.randint(1, 9))) for _ in range(3000)})
    texts = [(i, " ".join(r.choice(words) for _ in range(400))) for i in range(200)] + [(7, "AB AB"), (7, None)]
    names = words[::3]
    rows = spark.createDataFrame(texts, "_id long, _text string")
    table = spark.createDataFrame([(n,) for n in names], "name string")
    inventory.names_in_texts(rows, table, few=10, most=10_000)  # the folder is there
    before = scratch_files(spark)
    got = inventory.names_in_texts(rows, table, few=10, most=100)
    assert sorted(tuple(x) for x in got.collect()) == sorted((i, n) for i, t in texts if t for n in names if n in t)
    assert sum(p.stat().st_size for p in scratch_files(spark) - before) < 100_000 < sum(len(t or "") for _, t in texts)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_substrings_at_edges():
    """Of windows, of texts, of lengths; a bitmap that is full rules nothing out, and one that fits nearly everything."""
    r = random.Random(5)
    texts = [None, "", "b" * 9, *("".join(r.choice("abé\0") for _ in range(r.randint(0, 120))) for _ in range(12)), "", "ab" * 40 + "Z"]
    names = sorted({t[a : a + n] for t in texts if t for n in (1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 40) for a in (0, len(t) // 2, len(t) - n) if a >= 0} - {""})
    block, hits = substrings.BLOCK, substrings.HITS
    try:
        for substrings.BLOCK, substrings.HITS, power in ((1 << 18, 1 << 24, 20), (64, 100, 20), (50, 7, 12), (41, 60, 3)):
            bitmap = np.zeros(1 << power, np.uint8)
            bitmap[substrings.bits_of(pa.array(names), power).to_numpy()] = 1
            known = substrings.Names(np.packbits(bitmap, bitorder="little"), power, sorted({len(n.encode()) for n in names}))
            column = pa.array(["x", *texts, "y"])[1:-1]
            got = [(o, n) for t in substrings.held(column, known) for o, n in zip(t["owner"].to_pylist(), t["name"].cast(pa.binary()).to_pylist(), strict=True)]
            want = {(i, n.encode()) for i, t in enumerate(texts) if t for n in names if n in t}
            assert len(got) == len(set(got)) and want <= set(got) and all(n in texts[i].encode() for i, n in got)
            assert power < 20 or len(got) < len(want) * 1.02
        assert not list(substrings.held(pa.array([], pa.string()), known)) and not len(substrings.bits_of(pa.array([], pa.string()), 10))
    finally:
        substrings.BLOCK, substrings.HITS = block, hits


def test_candidates_are_named_once(spark):
    said = spark.createDataFrame([("Delist ABUSDT", "and AB", "5"), ("delist ab", None, "x"), ("nothing", "ABUSDT", "7"), (None, "migrate é", "1")], "title string, description string, publish_time string")
    coins = spark.createDataFrame([("ABUSDT", "AB", 5), ("ÉUSDT", "É", 6), ("OPEN", "DEL", 0), ("ABUSDT", "AB", 5), ("EMPTY", "", 9)], "symbol string, base_coin string, delivery_ms long")
    got = sorted((r["symbol"], r["match_kind"], r["publish_time_ms"]) for r in inventory.delisting_candidates(said, coins).collect())
    assert got == [("ABUSDT", "BASE_COIN_CANDIDATE", 0)] * 2 + [("ABUSDT", "EXACT_SYMBOL", 5)] * 2 + [("ÉUSDT", "BASE_COIN_CANDIDATE", 1)]
    plan = inventory.names_in_texts(said.select(F.monotonically_increasing_id().alias("_id"), F.col("title").alias("_text")), coins.select(F.col("symbol").alias("name")).distinct())._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Python" not in plan and "Cartesian" not in plan


def stored_bars(spark, path, step, n, buckets=8):
    rows = spark.range(n).select(F.concat(F.lit("S"), (F.col("id") % 3).cast("string")).alias("symbol"), (F.floor(F.col("id") / 3) * step).alias("start_ms"), *((F.col("id") % 7 + k).cast("decimal(18,2)").alias(c) for k, c in enumerate(bars.FIELDS)))
    canonical.write(rows, path, buckets)
    return rows, canonical.open_table(spark, path, rows.schema, buckets)


def shuffles_of_stored_sides(df):
    """Per scan of a stored table, the nodes from it up to its first join that are exchanges."""
    lines = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if line.strip()]
    depth = [re.search(r"[A-Za-z*]", line).start() for line in lines]
    found = []
    for k, line in enumerate(lines):
        if "FileScan" in line:
            above, at = [], depth[k]
            for j in range(k - 1, -1, -1):
                if depth[j] < at:
                    at = depth[j]
                    if "Join" in lines[j]:
                        break
                    above.append(lines[j])
            found.append(sum("Exchange" in x for x in above))
    return found


def test_stored_sides_are_not_shuffled(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain, a = stored_bars(spark, str(tmp_path / "a"), 60_000, 3000)
        hours, h = stored_bars(spark, str(tmp_path / "h"), 3_600_000, 60)
        _, b = stored_bars(spark, str(tmp_path / "b"), 60_000, 2000)
        compared = bars.reconcile(a, b)
        assert shuffles_of_stored_sides(compared) == [0, 0] and "Join" in compared._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, compared.select("symbol", "start_ms", "side").collect())) == sorted(map(tuple, bars.reconcile(plain, plain.where("start_ms < 39960000 OR symbol < 'S2' AND start_ms < 40020000")).select("symbol", "start_ms", "side").collect()))
        events = spark.createDataFrame([(f"S{i % 4}", i * 1_800_000 + (i % 2) * 60_000, 0.1) for i in range(40)], "symbol string, ts_ms long, rate double")
        valued = funding.value_events(events, h, a, 1)
        assert shuffles_of_stored_sides(valued) == [0, 0, 0]
        want = funding.value_events(events, hours, plain, 1)
        columns = ["symbol", "ts_ms", "mark_source", "mark_price"]
        assert sorted(map(repr, valued.select(*columns).collect())) == sorted(map(repr, want.select(*columns).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_first_trades_read_footers_only(spark, tmp_path):
    from tidemark.sources import store

    rows = spark.range(3000).select(F.concat(F.lit("S"), (F.col("id") % 3).cast("string")).alias("symbol"), (F.col("id") * 1_000_000 + 7).alias("start_ms"), *(F.lit(1.0).cast("decimal(18,2)").alias(c) for c in bars.FIELDS))
    rows = rows.withColumn("month", F.date_format(F.timestamp_millis("start_ms"), "yyyy-MM"))
    store.write_bars(rows, str(tmp_path / "b"))
    first = store.first_starts(spark, str(tmp_path / "b"), rows.schema)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(start_ms)]" in plan and "PushedGroupBy: [symbol, month]" in plan
    assert {r["symbol"]: r["first_trade_ms"] for r in first.collect()} == {"S0": 7, "S1": 1_000_007, "S2": 2_000_007}
    assert "BatchScan" not in spark.read.parquet(str(tmp_path / "b"))._jdf.queryExecution().executedPlan().toString()
