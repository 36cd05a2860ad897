import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import indicators, replay, strategy, validation
from tidemark.streaming import decisions

BAR = "symbol string, start_ms long, open double, high double, low double, close double, volume double, turnover double"


def bars(spark, closes, starts=None):
    starts = starts or [60000 * i for i in range(len(closes))]
    return spark.createDataFrame([("A", s, c, c + 1.0, c - 1.0, c, 1.0, c) for s, c in zip(starts, closes, strict=True)], BAR)


def test_ema_seeds_and_resets(spark):
    closes = [float(x) for x in (1, 2, 3, 4, 5, 6, 7, 8)]
    starts = [60000 * i for i in (0, 1, 2, 3, 5, 6, 7, 8)]
    rows = indicators.ema(bars(spark, closes, starts), 60000, 3).orderBy("start_ms").collect()
    assert [r["ema"] for r in rows] == [None, None, 2.0, 3.0, None, None, 6.0, 7.0]
    again = indicators.chained_in_groups(bars(spark, closes, starts), 60000, 3).orderBy("start_ms").collect()
    assert [None if r["ema"] is None or r["ema"] != r["ema"] else r["ema"] for r in again] == [None, None, 2.0, 3.0, None, None, 6.0, 7.0]


def test_merge_levels(spark):
    rows = [("A", 0, "LONG", Decimal("10.00"), "PDH", Decimal("0.01")), ("A", 0, "LONG", Decimal("10.01"), "PWH", Decimal("0.01")), ("A", 0, "SHORT", Decimal("9.00"), "PDL", Decimal("0.01")), ("A", 0, "SHORT", Decimal("9.02"), "PWL", Decimal("0.01"))]
    out = {(r["side"], str(r["price"])): r["labels"] for r in strategy.merge_levels(spark.createDataFrame(rows, "symbol string, day_ms long, side string, price decimal(18,2), label string, tick decimal(6,2)")).collect()}
    assert out == {("LONG", "10.01"): ["PDH", "PWH"], ("SHORT", "9.00"): ["PDL"], ("SHORT", "9.02"): ["PWL"]}
    assert len(strategy.configurations()) == 11


def event(minute, symbol="A", o=100.0, h=100.0, low=100.0, **more):
    base = dict(config="BASE", minute_ms=minute * 60000, symbol=symbol, open=o, high=h, low=low, close_15m=None, session_end=False, blackout=False, funding_rate=None, mark=None, side=None, level=None, entry=None, stop=None, tp1=None, tp2=None, l_unit=None, be=None, qty_step=0.1, expiry_ms=10**12, turnover_sum=1.0, volume_ratio=2.0, delivery_known=False, settlement=None)
    return tuple((base | more).values())


CANDIDATE = dict(side="LONG", level=99.0, entry=99.0, stop=95.0, tp1=107.0, tp2=111.0, l_unit=4.1, be=99.2, o=100.0)


def trades(spark, events):
    out = replay.replay(spark.createDataFrame(events, replay.EVENTS)).collect()
    return [(r["exit_reason"], round(r["gross"] / r["qty"], 6)) for r in out]


def test_fill_needs_penetration_and_stop_needs_touch(spark):
    assert trades(spark, [event(1, **CANDIDATE), event(2, low=99.0, h=120.0)]) == []
    assert trades(spark, [event(1, **CANDIDATE), event(2, low=95.0, h=120.0)]) == [("EXIT_INITIAL_STOP", -4.0)]
    filled = [event(1, **CANDIDATE), event(2, low=98.9, h=120.0)]
    assert trades(spark, [*filled, event(3, low=95.0, h=120.0)]) == [("EXIT_INITIAL_STOP", -4.0)]
    assert trades(spark, [*filled, event(3, low=99.1, h=108.0)]) == [("EXIT_BE", 4.1)]
    assert trades(spark, [*filled, event(3, low=100.0, h=108.0), event(4, low=100.0, h=112.0)]) == [("EXIT_TP2", 10.0)]
    assert trades(spark, [*filled, event(3, o=98.0, low=98.0, h=99.0, close_15m=98.5)]) == [("EXIT_FALSE_BREAK", -1.0)]


def test_replay_ignores_row_order_and_partitions(spark):
    r = random.Random(3)
    rows = []
    for s in "ABC":
        price = 100.0
        for m in range(1, 300):
            nxt = price + r.uniform(-1, 1)
            more = dict(side="LONG", level=price - 0.3, entry=price - 0.3, stop=price - 2.0, tp1=price + 2.0, tp2=None, l_unit=1.8, be=price) if m % 17 == 0 else {}
            rows.append(event(m, s, price, max(price, nxt) + 0.2, min(price, nxt) - 0.2, **more))
            price = nxt
    whole = spark.createDataFrame(rows, replay.EVENTS)
    a = sorted(map(tuple, replay.replay(whole).collect()))
    r.shuffle(rows)
    assert a and a == sorted(map(tuple, replay.replay(spark.createDataFrame(rows, replay.EVENTS).repartition(5)).collect()))


def test_bootstrap_and_decisions(spark):
    weeks = spark.range(10).select(F.col("id").alias("week_no"))
    ci = validation.bootstrap(weeks.select("week_no", F.lit(2.0).alias("total"), F.lit(1).alias("n")), weeks, 200).first()
    assert (ci["ci_low"], ci["ci_high"]) == (2.0, 2.0)
    names = "config string, n int, mean_r double, total_r double, stress_mean_r double, stress_total_r double"
    case = lambda n, stress, good: validation.validation_decision(spark.createDataFrame([("BASE", n, 0.1, 12.0, stress, 1.0)] + [(f"n{i}", 90, 0.1 if i < good else -0.1, 1.0, 0.0, 0.0) for i in range(10)], names)).first()["decision"]
    assert [case(120, 0.0, 8), case(120, -0.1, 8), case(120, 0.0, 7), case(99, 0.0, 8), case(99, -0.1, 8)] == ["PASS", "FAIL_VALIDATION", "FAIL_VALIDATION", "INCONCLUSIVE_VALIDATION", "FAIL_VALIDATION"]


def test_streams(spark, tmp_path):
    rows = bars(spark, [float(i) for i in range(40)], [60000 * i for i in range(40) if i != 20] + [60000 * 41])
    rows.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    decisions.drain(decisions.closed_windows(stream), str(tmp_path / "out"), str(tmp_path / "c1"))
    assert {r["window_ms"]: r["available"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {0: True, 900000: False}
    decisions.drain(decisions.ema_chain(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), 60000, 5), str(tmp_path / "ema"), str(tmp_path / "c2"))
    want = {r["start_ms"]: r["ema"] for r in indicators.ema(rows, 60000, 5).collect()}
    got = {r["start_ms"]: r["ema"] for r in spark.read.parquet(str(tmp_path / "ema")).collect()}
    assert got.keys() == want.keys() and all((want[k] is None and (got[k] is None or got[k] != got[k])) or got[k] == pytest.approx(want[k]) for k in want)
