"""The replay against a second, plain implementation of its contract, over random tapes."""

import random

import pytest

from tidemark.operators import replay

MINUTE, DAY = 60_000, 86_400_000
FIELDS = [c.split()[0] for c in replay.EVENTS.split(", ")]


def tape(seed, minutes=400, symbols="ABCD"):
    r, rows = random.Random(seed), []
    price = dict.fromkeys(symbols, 100.0)
    base = DAY - 150 * MINUTE  # a day ends on the way
    for m in range(1, minutes):
        for s in symbols:
            if r.random() < 0.05:
                continue  # a minute without trades
            p = price[s]
            q = p + r.uniform(-0.8, 0.8)
            row = dict.fromkeys(FIELDS) | {
                "config": f"X{seed}", "minute_ms": base + m * MINUTE, "symbol": s, "open": q, "high": max(p, q) + r.random() * 0.4, "low": min(p, q) - r.random() * 0.4, "close_15m": p + r.uniform(-0.5, 0.5) if m % 15 == 0 else None,
                "session_end": m % 170 == 0, "blackout": r.random() < 0.01, "funding_rate": r.choice([0.001, -0.001]) if m % 60 == 0 else None, "mark": p, "qty_step": 0.1, "expiry_ms": base + (m + r.randrange(1, 40)) * MINUTE,
                "turnover_sum": float(r.randrange(4)), "volume_ratio": float(r.randrange(3)), "delivery_known": s in "CD" and m % 200 > 60 and r.random() < 0.1, "settlement": 99.0 if s in "CD" and m % 23 == 0 else None,
            }
            if r.random() < 0.08:
                long = r.random() < 0.5
                sign, risk = (1, r.uniform(0.3, 1.5)) if long else (-1, r.uniform(0.3, 1.5))
                level = round(q - sign * r.uniform(-0.1, 0.4), 1)
                row |= {"side": "LONG" if long else "SHORT", "level": level, "entry": level, "stop": level - sign * risk, "tp1": level + sign * 2 * risk, "tp2": level + sign * 3 * risk if r.random() < 0.7 else None, "l_unit": risk * 1.1, "be": level + sign * 0.05}
            rows.append(tuple(row[f] for f in FIELDS))
            price[s] = q
    return rows


def plain(rows, equity=100_000.0):
    """Minute by minute: fills, stops, targets, funding, exits at the boundary, cancellations, then admissions."""
    by_minute, e0 = {}, rows[0][0]
    for row in rows:
        e = dict(zip(FIELDS, row))
        by_minute.setdefault(e["minute_ms"], {})[e["symbol"]] = e
    orders, open_, trades = {}, {}, []
    state = {"equity": equity, "day": None}

    def gain(amount):
        state["equity"] += amount
        state["pnl"] += amount
        if state["pnl"] <= -0.01 * state["start"]:
            state["stopped"] = True

    def take(p, price, part):
        won = (price - p["entry"]) * part * p["sign"]
        p["gross"] += won
        p["left"] -= part
        gain(won)

    def leave(s, price, at, why):
        p = open_.pop(s)
        take(p, price, p["left"])
        trades.append((e0, s, p["side"], p["level"], p["activated"], p["filled"], at, p["qty"], p["entry"], p["l_unit"], p["gross"], p["funding"], why))

    for at in sorted(by_minute):
        now = by_minute[at]
        if at // DAY != state["day"]:
            state |= {"day": at // DAY, "start": state["equity"], "pnl": 0.0, "stopped": False, "filled": 0}
            used = set()
        new = set()
        for s in sorted(orders):
            o, e = orders[s], now.get(s)
            if e and (e["low"] < o["entry"] if o["sign"] == 1 else e["high"] > o["entry"]):
                open_[s] = orders.pop(s) | {"filled": at - MINUTE}
                new.add(s)
                state["filled"] += 1
        hit = [s for s, p in open_.items() if s in now and (now[s]["low"] <= p["stop"] if p["sign"] == 1 else now[s]["high"] >= p["stop"])]
        for s in sorted(hit, key=lambda s: (open_[s]["sign"] * (open_[s]["stop"] - open_[s]["entry"]), s)):
            leave(s, open_[s]["stop"], at, "EXIT_BE" if open_[s]["half"] else "EXIT_INITIAL_STOP")
        for s in sorted(set(open_) & set(now) - new):
            p, e = open_[s], now[s]
            beyond = lambda goal, p=p, e=e: e["high"] > goal if p["sign"] == 1 else e["low"] < goal
            if not p["half"] and beyond(p["tp1"]):
                take(p, p["tp1"], p["qty"] / 2)
                p["half"], p["stop"] = True, p["be"]
                if e["low"] <= p["be"] if p["sign"] == 1 else e["high"] >= p["be"]:
                    leave(s, p["be"], at, "EXIT_BE")
                    continue
            if p["half"] and p["tp2"] is not None and beyond(p["tp2"]):
                leave(s, p["tp2"], at, "EXIT_TP2")
        for s in sorted(set(open_) & set(now)):
            p, e = open_[s], now[s]
            if e["funding_rate"] is not None:
                fee = p["sign"] * p["left"] * e["mark"] * e["funding_rate"]
                if fee > 0 or s not in new:
                    p["funding"] -= fee
                    gain(-fee)
        for s in sorted(set(open_) & set(now)):
            p, e = open_[s], now[s]
            if e["settlement"] is not None:
                leave(s, e["settlement"], at, "EXIT_DELIVERY")
            elif e["delivery_known"]:
                leave(s, e["open"], at, "EXIT_DELIVERY_RISK")
            elif e["session_end"]:
                leave(s, e["open"], at, "EXIT_SESSION_END")
            elif e["close_15m"] is not None and (e["close_15m"] < p["level"] if p["sign"] == 1 else e["close_15m"] > p["level"]):
                leave(s, e["open"], at, "EXIT_FALSE_BREAK")
        for s in list(orders):
            e = now.get(s)
            if state["stopped"] or at >= orders[s]["expiry_ms"] or (e and (e["blackout"] or e["session_end"] or e["delivery_known"] or e["settlement"] is not None)):
                del orders[s]
        wanted = []
        for s, e in now.items():
            if e["side"] is None or at >= e["expiry_ms"] or e["blackout"] or e["delivery_known"] or state["stopped"] or (s, e["side"], e["level"]) in used:
                continue
            if e["open"] > e["entry"] if e["side"] == "LONG" else e["open"] < e["entry"]:
                wanted.append(e)
        for e in sorted(wanted, key=lambda e: (-e["turnover_sum"], -e["volume_ratio"], e["symbol"])):
            held = [*orders.values(), *open_.values()]
            s, money = e["symbol"], state["equity"]
            if s in orders or s in open_ or len(held) == 2 or state["filled"] + len(orders) >= 3:
                continue
            risk, notional = 0.01 * money - sum(p["qty"] * p["l_unit"] for p in held), 3 * money - sum(p["qty"] * p["entry"] for p in held)
            if risk <= 0 or notional <= 0:
                continue
            qty = int(min(0.005 * money / e["l_unit"], risk / e["l_unit"], 2 * money / e["entry"], notional / e["entry"]) / 0.1 + 1e-9) * 0.1
            if qty > 0:
                used.add((s, e["side"], e["level"]))
                orders[s] = {k: e[k] for k in ("side", "level", "entry", "stop", "tp1", "tp2", "be", "l_unit", "expiry_ms")} | {"sign": 1 if e["side"] == "LONG" else -1, "qty": qty, "left": qty, "half": False, "gross": 0.0, "funding": 0.0, "activated": at}
    return trades


def test_replay_equals_the_plain_one(spark):
    tapes = [tape(seed) for seed in range(24)]
    want = sorted(t for rows in tapes for t in plain(rows))
    shuffled = [row for rows in tapes for row in rows]
    random.Random(1).shuffle(shuffled)
    got = sorted(map(tuple, replay.replay(spark.createDataFrame(shuffled, replay.EVENTS).repartition(3)).collect()))
    assert len(got) == len(want) > 80
    for a, b in zip(got, want):
        assert a[:7] == b[:7] and a[12] == b[12] and a[7:12] == pytest.approx(b[7:12], rel=1e-9, abs=1e-7)
    assert {t[12] for t in want} == {"EXIT_INITIAL_STOP", "EXIT_BE", "EXIT_TP2", "EXIT_FALSE_BREAK", "EXIT_SESSION_END", "EXIT_DELIVERY_RISK", "EXIT_DELIVERY"}


def test_ledgers_keep_the_path(spark):
    trades = spark.createDataFrame([("X", "A", "LONG", 1.0, 0, 0, 0, 2.0, 10.0, 0.5, 3.0, -0.25, "EXIT_TP2")], replay.TRADES)
    costs = spark.createDataFrame([("BASE", 0.001, 0.002, 0.003), ("STRESS", 0.001, 0.002, 0.012)], "scenario string, maker double, taker double, slip double")
    got = {r["scenario"]: (round(r["costs"], 9), round(r["net"], 9), round(r["net_r"], 9), r["gross"]) for r in replay.ledgers(trades, costs).collect()}
    assert got == {"BASE": (0.12, 2.63, 2.63, 3.0), "STRESS": (0.3, 2.45, 2.45, 3.0)}
