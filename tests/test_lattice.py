"""Price lattices over time against a plain fold."""

import math
import random

from tidemark.operators import indicators


def plain(rows, period, bits):
    out = []
    for s in sorted({r[0] for r in rows}):
        own = {}
        for _, t, px in (r for r in rows if r[0] == s and r[2] > 0):
            own.setdefault(t // period * period, []).append(round(px * 100))
        now = None
        for p in sorted(own):
            g, k = math.gcd(*own[p]), len(set(own[p]))
            if now is not None:
                d = math.gcd(now[2], g)
                coarser, finer = d == now[2] and g > now[2] and k * math.log2(g / now[2]) >= bits, d < now[2] and now[3] * math.log2(now[2] / d) >= bits
                if not (coarser or finer):
                    now = [now[0], p, d, now[3] + k, now[4] + len(own[p])]
                    continue
                out.append((s, *now))
            now = [p, p, g, k, len(own[p])]
        if now:
            out.append((s, *now))
    return out


def test_regimes_equal_a_fold(spark):
    r, rows = random.Random(5), []
    for s, ticks in (("A", (1, 5, 5, 2)), ("B", (10, 10, 1)), ("C", (25,)), ("D", (1, 100, 1))):
        for m, tick in enumerate(ticks):
            for _ in range(r.choice([2, 8, 60])):
                rows.append((s, m * 1000 + r.randint(0, 999), r.randint(1, 400) * tick / 100))
    rows += [("E", 5, 0.07), ("F", 5, 0.0)]
    table = spark.createDataFrame(rows, "symbol string, t long, px double")
    for period, bits in ((1000, 20), (100, 20), (1000, 3), (5000, 20)):
        got = sorted((x["symbol"], x["from_ms"], x["to_ms"] - period, x["tick_units"], x["prices"], x["trades"]) for x in indicators.lattice_regimes(table, period, 2, bits=bits).collect())
        assert got == plain(rows, period, bits)


def test_a_changed_tick_is_found_and_a_declared_one_checked(spark):
    rows = [("A", i * 10, (5 * i + 5) / 100) for i in range(100)] + [("A", 1000 + i * 10, (5 * i + 1 + i % 3) / 100) for i in range(100)]
    declared = spark.createDataFrame([("A", 5), ("Z", 1)], "symbol string, tick_units long")
    found = indicators.lattice_regimes(spark.createDataFrame([*rows, ("B", 1, 1.0)], "symbol string, t long, px double"), 500, 2, declared).orderBy("symbol", "from_ms").collect()
    assert [(x["symbol"], x["from_ms"], x["to_ms"], x["tick_units"], x["on_lattice"], x["on_declared"]) for x in found] == [("A", 0, 1000, 5, 1.0, 1.0), ("A", 1000, 2000, 1, 1.0, 0.0), ("B", 0, 500, 100, 1.0, None)]
    assert found[0]["confidence"] > 0.999999 and found[2]["confidence"] == 0.5
    assert indicators.lattice_regimes(spark.createDataFrame([], "symbol string, t long, px double"), 500).count() == 0
