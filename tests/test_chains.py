"""Chains in the state store against a plain fold, batch forms and restarts; segments by session windows."""

import random

from tidemark.operators import indicators
from tidemark.streaming import chains, decisions

STEP, SCHEMA = 60_000, "symbol string, start_ms long, high double, low double, close double, volume double"


def draw(seed, n=60, symbols=("A", "B", "C")):
    r, rows = random.Random(seed), []
    for s in symbols:
        t = 0
        for _ in range(n):
            t += STEP if r.random() < 0.9 else STEP * r.randint(2, 5)
            c = r.uniform(90, 110)
            rows.append((s, t, c + r.random(), c - r.random(), c, float(r.randint(1, 9))))
    return [*rows, ("D", STEP, 2.0, 1.0, 1.5, 1.0)]


def fold(rows, ema_period, atr_period):
    """Every symbol's values and last state, bar by bar."""
    out, last = {}, {}
    for s in {r[0] for r in rows}:
        state = chains._FRESH
        for _, t, high, low, close, _ in sorted(r for r in rows if r[0] == s):
            state = chains.advance(state, t, high, low, close, STEP, ema_period, atr_period)
            out[s, t] = (state[4], state[6])
        last[s] = state
    return out, last


def near(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-9)


def same(got, want):
    assert got.keys() == want.keys() and all(near(x, y) for k in got for x, y in zip(got[k], want[k], strict=True))


def test_fold_equals_batch_forms(spark):
    rows = draw(1)
    b = spark.createDataFrame(rows, SCHEMA)
    out, last = fold(rows, 5, 3)
    same({(r["symbol"], r["start_ms"]): (r["ema"],) for r in indicators.ema(b, STEP, 5).collect()}, {k: v[:1] for k, v in out.items()})
    atr = {(r["symbol"], r["start_ms"]): r["atr"] for r in indicators.atr(b, STEP, 3).collect()}
    assert all(near(atr.get(k), v[1]) for k, v in out.items())
    for ema_period, atr_period in ((5, 3), (50, 40)):  # the second seeds are not complete
        _, last = fold(rows, ema_period, atr_period)
        same({r["symbol"]: tuple(r)[1:] for r in chains.last_state(b, STEP, ema_period, atr_period).collect()}, last)


def test_restarts_late_bars_and_stored_state(spark, tmp_path):
    rows = draw(2)
    want, last = fold(rows, 5, 3)
    times = sorted({r[1] for r in rows})
    cuts = [times[len(times) // 3], times[2 * len(times) // 3]]
    parts = [[r for r in rows if r[1] < cuts[0]], [r for r in rows if cuts[0] <= r[1] < cuts[1]], [r for r in rows if r[1] >= cuts[1]]]
    parts[1] += parts[0][:7]  # bars again, later
    for part in parts:
        spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        decisions.drain(chains.chains(stream, STEP, 5, 3), str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) == len(want)
    same({(r["symbol"], r["start_ms"]): (r["ema"], r["atr"]) for r in got}, want)
    held = {r["symbol"]: tuple(r)[1:] for r in chains.stored_state(spark, str(tmp_path / "state")).collect()}
    same(held, last)


def test_stream_begins_where_a_batch_ended(spark, tmp_path):
    rows = draw(3)
    cut = sorted({r[1] for r in rows})[20]
    old, new = [r for r in rows if r[1] < cut], [r for r in rows if r[1] >= cut] + [("E", STEP, 2.0, 1.0, 1.5, 1.0)]
    for period in (5, 30):  # a seed that is complete, and one that spans both
        path = tmp_path / str(period)
        spark.createDataFrame(new, SCHEMA).write.parquet(str(path / "in"))
        start = chains.last_state(spark.createDataFrame(old, SCHEMA), STEP, period, 3)
        decisions.drain(chains.chains(spark.readStream.schema(SCHEMA).parquet(str(path / "in")), STEP, period, 3, start), str(path / "out"), str(path / "state"))
        want, _ = fold([*old, *new], period, 3)
        same({(r["symbol"], r["start_ms"]): (r["ema"], r["atr"]) for r in spark.read.parquet(str(path / "out")).collect()}, {(r[0], r[1]): want[r[0], r[1]] for r in new})


def test_segments_close_by_themselves(spark, tmp_path):
    rows = draw(4, 200)
    times = sorted({r[1] for r in rows})
    source, out, done = tmp_path / "in", tmp_path / "out", []
    for k in range(4):
        part = [r for r in rows if times[k * len(times) // 4] <= r[1] < (times[(k + 1) * len(times) // 4] if k < 3 else times[-1] + 1)]
        spark.createDataFrame(part + part[-2:], SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
        decisions.drain(chains.streamed_segments(spark.readStream.schema(SCHEMA).parquet(str(source)), STEP, "10 minutes"), str(out), str(tmp_path / "state"))
        done.append(spark.read.parquet(str(out)).count())
    want = {}
    for s in {r[0] for r in rows}:
        run = []
        for r in [*sorted(x for x in rows if x[0] == s), None]:
            if run and (r is None or r[1] != run[-1][1] + STEP):
                if run[-1][1] + STEP + 1 <= times[-1] - 600_000:
                    want[s, run[0][1]] = (run[-1][1], len(run), max(x[2] for x in run), min(x[3] for x in run), sum(x[5] for x in run))
                run = []
            run.append(r)
    got = {(r["symbol"], r["segment"]): tuple(r[c] for c in ("last_ms", "n", "high", "low", "volume")) for r in spark.read.parquet(str(out)).collect()}
    assert got == want and done[0] < done[1] < done[2] < done[3] == len(got)
