"""Queries whose input was thinned, held to brute force over every row."""

import hashlib
import random
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from tidemark.operators import replay, strategy, validation
from tidemark.queries import QUERIES, _replay_events


def test_bootstrap_reads_every_trade_and_week(spark, tmp_path):
    r = random.Random(5)
    first = datetime(1995, 2, 1)  # week 4 of the calendar; weeks 30 to 49 after it stay empty
    days = [d for d in range(7 * 120) if not 210 <= d < 350]
    orders = [(k, "A", first + timedelta(days=d), r.randint(100, 99_999) / 100) for k, d in enumerate([0, *r.choices(days, k=148), 7 * 120 - 1])]
    spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string, o_orderdate timestamp, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    by = {}
    for _, _, day, price in orders:
        by.setdefault((day - datetime(1995, 1, 1)).days // 7, []).append((round(price * 100) % 701 - 340) / 100)
    n = max(by) - min(by) + 1
    weeks = [(sum(x), len(x)) for x in (by.get(min(by) + i, []) for i in range(n))]
    assert n > 91 and (0, 0) in weeks
    means = []
    for b in range(20_000):
        drawn = [weeks[int(hashlib.sha256(f"bootstrap:{b}:{i}".encode()).hexdigest()[:8], 16) % n] for i in range(n)]
        means.append(sum(x for x, _ in drawn) / sum(c for _, c in drawn))
    means.sort()
    at = lambda q: means[int(q * (len(means) - 1))] + (q * (len(means) - 1) % 1) * (means[int(q * (len(means) - 1)) + 1] - means[int(q * (len(means) - 1))])
    got = QUERIES["q56_block_bootstrap_ci"](spark, str(tmp_path)).first()
    assert got["resamples"] == 20_000 and (got["ci_low"], got["ci_high"]) == (pytest.approx(at(0.025), abs=2e-6), pytest.approx(at(0.975), abs=2e-6))


def test_drift_gate_reads_every_exit(spark, tmp_path):
    r = random.Random(7)
    first = datetime(1995, 1, 1)
    lines = [(k // 3, k % 3 + 1, r.randint(1, 500), r.choice("AAAAR"), r.randint(100, 99_999) / 100, first + timedelta(days=r.randint(0, 40))) for k in range(600)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_extendedprice double, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    exits = [(flag, day, key * 1_000_000 + line * 100_000 + part, round(price * 100) % 997 / 10) for key, line, part, flag, price, day in lines]
    want = set()
    for flag in "AR":
        own = sorted(x[1:] for x in exits if x[0] == flag)
        for i, (_, k, bps) in enumerate(own):
            m = round(median(x[2] for x in own[i - 19 : i + 1]), 6) if i >= 19 else None
            want.add((flag, k, bps, m, m is not None and m > 50))
    got = QUERIES["q58_drift_gate"](spark, str(tmp_path)).collect()
    assert len(got) == 600 and set(map(tuple, got)) == want
    rows = spark.createDataFrame([(a, int((b - first).total_seconds() * 1000), c, d) for a, b, c, d in exits], "exit_class string, t long, id long, bps double")
    for block in (1, 7, 64):
        cut = validation.drift_gate(rows, F.lit(40.0), block=block).select("exit_class", "id", "bps", "median_bps", "blocked").collect()
        assert len(cut) == 600 and set(map(tuple, cut)) == want


def test_funding_and_blackout_read_every_event(spark, tmp_path):
    r = random.Random(9)
    start = datetime(2024, 1, 1)
    events = [(k, start + timedelta(milliseconds=r.randint(0, 10 * 86_400_000)), r.choice(["click", "view", "error"] if k % 8 else ["signup"]), r.randint(1, 999) / 100, '{"k": 1}') for k in range(400)]
    spark.createDataFrame(events, "event_id long, ts timestamp, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    tape = [(kind, round((ts - datetime(1970, 1, 1)).total_seconds() * 1000), seq) for seq, ts, kind, _, _ in events]
    due = {}
    for kind, t, seq in tape:
        due.setdefault(kind, set()).add(t - t % 3_600_000 if seq % 2 == 0 else t - t % 60_000)
    gaps = {kind: [(b - a) // 60_000 for a, b in zip(sorted(x), sorted(x)[1:], strict=False)] for kind, x in due.items()}
    run = lambda name: QUERIES[name](spark, str(tmp_path)).collect()
    assert {(x["symbol"], x["intervals_min"], x["events"]) for x in run("q30_funding_intervals")} == {(kind, ",".join(map(str, sorted(set(g)))), len(due[kind])) for kind, g in gaps.items()}
    assert sorted((x["symbol"], x["ts_ms"]) for x in run("q31_funding_mark_fallback")) == sorted((kind, t) for kind, x in due.items() for t in x)
    assert {(x["symbol"], x["funding_event_count"]) for x in run("q31b_mark_summary")} == {(kind, len(x)) for kind, x in due.items()}
    assert run("q32_cadence_gate")[0]["qualified"] == sum(min(g) <= 240 for kind, g in gaps.items() if kind != "view")
    news = [t for kind, t, _ in tape if kind == "signup"]
    kept = {seq for _, t, seq in tape if not any(x - 1_800_000 <= t < x + 1_800_000 for x in news)}
    assert {x["seq"] for x in run("q49_blackout_filter")} == kept and 0 < len(kept) < 400 - len(news)


def test_replay_offers_every_minute_to_every_configuration(spark, tmp_path):
    r = random.Random(11)
    start = datetime(2024, 1, 1)
    events = [(k, start + timedelta(minutes=5 * k), "view", round(100 + k / 20 + r.uniform(-3, 3), 2), f'{{"k": {r.choice([1, 2, 3, 5])}}}') for k in range(12 * 80)]
    spark.createDataFrame(events, "event_id long, ts timestamp, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    px, qty = [e[3] for e in events], [int(e[4][6:-1]) for e in events]
    hourly = px[11::12]

    def emas(period):
        out = [None] * (period - 1) + [sum(hourly[:period]) / period]
        for x in hourly[period:]:
            out.append(2 / (period + 1) * x + (1 - 2 / (period + 1)) * out[-1])
        return out

    want = {}
    for c in strategy.configurations():
        e = emas(c["ema_period"])
        for k in range(20, len(px) - 1):
            h = (5 * k + 1) // 60 - 1
            level, ratio = round(sum(px[k - 3 : k]) / 3 + 1e-9, 2), qty[k] * 20 / sum(qty[k - 20 : k])
            trend = h >= 3 and e[h] is not None and e[h - 3] is not None and hourly[h] > e[h] > e[h - 3]
            if trend and px[k] > level and px[k + 1] > level and ratio >= c["volume_ratio"]:
                want[c["config"], 5 * k + 1] = (round(level * (1 - 0.2 * c["stop_atr"]), 6), 15 * c["expiry_bars"])
    begin = int((start - datetime(1970, 1, 1)).total_seconds() * 1000)
    made = _replay_events(lambda name: spark.read.parquet(str(tmp_path / f"{name}.parquet")), 3_600_000).cache()
    got = {(x["config"], (x["minute_ms"] - begin) // 60_000): (round(x["stop"], 6), (x["expiry_ms"] - x["minute_ms"]) // 60_000) for x in made.where("side IS NOT NULL").collect()}
    assert made.count() == 11 * len(events) and len({c for c, _ in got}) == 11 and got == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        small = sorted(map(tuple, replay.replay(made).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert small and small == sorted(map(tuple, replay.replay(made).collect()))
    scenarios = spark.range(17).select(F.col("id").cast("string").alias("scenario"), *(F.lit(0.001).alias(c) for c in ("maker", "taker", "slip")))
    trades = replay.replay(made)
    assert replay.ledgers(trades, scenarios.limit(16)).count() == 16 * len(small)
    with pytest.raises(ValueError, match="scenarios"):
        replay.ledgers(trades, scenarios)
