"""First passages through the block index against a walk over every trade."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import decimals
from tidemark.operators import passage, validation


def draw(seed):
    r = random.Random(seed)
    trades, asks = [], []
    for s in ("A", "B"):
        t, px = 0, 100.0
        for k in range(400):
            t += r.choice([0, 1, 3, 40])
            px += r.choice([-1, 0, 1])
            trades.append((s, t, k, px))
    for i in range(150):
        at = r.randint(-20, 5000)
        asks.append((i, r.choice(["A", "B", "C", None]), r.choice([100.0 + r.randint(-12, 12), None if r.random() < 0.1 else 99.0]), r.random() < 0.5, at, r.choice([None, r.randint(0, 400)]), at + r.choice([0, 1, 50, 900, 9000])))
    return trades, asks


def plain(trades, asks, strict):
    out = {}
    for i, s, level, falling, at, seq, until in asks:
        for symbol, t, k, px in sorted(trades, key=lambda x: (x[1], x[2])):
            after = t > at or (t == at and (seq is None or k > seq))
            if symbol == s and level is not None and after and t < until and (px == level and not strict or (px < level if falling else px > level)):
                out[i] = (t, k, px)
                break
    return out


@pytest.mark.parametrize(("fine", "coarse", "strict"), [(1, 1, True), (7, 21, False), (50, 400, True), (1000, 8000, False)])
def test_passages_equal_a_walk(spark, fine, coarse, strict):
    trades, asks = draw(fine)
    tape = spark.createDataFrame(trades, "symbol string, t long, seq long, px double")
    table = spark.createDataFrame(asks, "ask_id long, symbol string, level double, falling boolean, from_ms long, from_seq long, until_ms long")
    got = passage.first_passage(table, tape, passage.block_index(tape, fine), strict, fine, coarse).collect()
    assert {r["ask_id"]: (r["t"], r["seq"], r["px"]) for r in got} == plain(trades, asks, strict) and len(got) > 20


def test_coarse_blocks_hold_whole_fine_ones(spark):
    tape = spark.createDataFrame([("A", 1, 1, 1.0)], "symbol string, t long, seq long, px double")
    asks = spark.createDataFrame([(1, "A", 0.5, False, 0, None, 9)], "ask_id long, symbol string, level double, falling boolean, from_ms long, from_seq long, until_ms long")
    assert passage.first_passage(asks, tape, passage.block_index(tape, 20), True, 20, 200).count() == 1
    with pytest.raises(ValueError, match="whole fine blocks"):
        passage.first_passage(asks, tape, passage.block_index(tape, 20), True, 20, 30)


def test_slippage_of_stops(spark):
    flags = {f"{c}_ok": True for c in ("universe", "trend", "volume", "session", "news", "room", "grid")}
    setups = spark.createDataFrame([{"setup_id": "a", "symbol": "A", "side": "LONG", "entry": 100.0, "stop": 98.0, "active_ms": 10, **flags}, {"setup_id": "b", "symbol": "A", "side": "LONG", "entry": 90.0, "stop": 80.0, "active_ms": 10, **flags}, {"setup_id": "c", "symbol": "A", "side": "SHORT", "entry": 99.0, "stop": 101.0, "active_ms": 10, **{**flags, "news_ok": False}}])
    tape = spark.createDataFrame([("A", 5, 1, 97.0), ("A", 10, 2, 100.0), ("A", 20, 3, 99.5), ("A", 20, 4, 97.02)], "symbol string, t long, seq long, px double")
    (row,) = validation.slippage_events(setups, tape).collect()
    assert (row["setup_id"], row["stopped_ms"], round(row["bps"], 6)) == ("a", 20, 100.0)
    assert validation.slippage_events(setups.limit(0), tape).count() == 0 and validation.slippage_events(setups, tape.limit(0)).count() == 0


def test_slippage_of_a_stop_at_zero(spark):
    """Prices may reach 0: a stop there has no finite slippage, and does not fail the job."""
    flags = {f"{c}_ok": True for c in ("universe", "trend", "volume", "session", "news", "room", "grid")}
    setups = spark.createDataFrame([("z", "A", "LONG", 3.0, 0.0, 10, *flags.values()), ("n", "A", "LONG", 2.0, 1.0, 10, *flags.values())], f"setup_id string, symbol string, side string, entry double, stop double, active_ms long, {', '.join(f'{c} boolean' for c in flags)}")
    tape = spark.createDataFrame([("A", 20, 1, 1.5), ("A", 30, 2, 0.0)], "symbol string, t long, seq long, px double")
    got = {r["setup_id"]: r["bps"] for r in validation.slippage_events(setups, tape).collect()}
    assert math.isnan(got["z"]) and got["n"] == 10_000
    below = tape.limit(1).select(decimals.adverse_bps(F.lit("SHORT"), F.lit(1.0), F.lit(0.0)), decimals.adverse_bps(F.lit("LONG"), F.lit(1.0), F.lit(0.0))).first()
    assert tuple(below) == (math.inf, 0.0)
