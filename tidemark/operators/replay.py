"""Deterministic replay of a portfolio, minute by minute, and its ledgers.

Everything that does not depend on the portfolio is joined beforehand, into one row a configuration, minute and symbol. What
remains is sequential by nature (orders, positions and equity depend on each other across symbols), so each
configuration is folded over its sorted minutes, batch by batch: only its book is kept between batches, never its tape.
Configurations run in parallel.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import DAY, MINUTE
from .strategy import PARAMETERS

EVENTS = "config string, minute_ms long, symbol string, open double, high double, low double, close_15m double, session_end boolean, blackout boolean, funding_rate double, mark double, side string, level double, entry double, stop double, tp1 double, tp2 double, l_unit double, be double, qty_step double, expiry_ms long, turnover_sum double, volume_ratio double, delivery_known boolean, settlement double"
TRADES = "config string, symbol string, side string, signal_level double, activated_ms long, filled_ms long, closed_ms long, qty double, entry double, l_unit double, gross double, funding double, exit_reason string"

MOST_SCENARIOS = 16


@dataclass
class _Position:
    symbol: str
    side: int
    level: float
    entry: float
    stop: float
    tp1: float
    tp2: float | None
    be: float
    qty: float
    l_unit: float
    expiry: int
    activated: int
    left: float
    filled: int | None = None
    after_tp1: bool = False
    gross: float = 0.0
    funding: float = 0.0


@dataclass
class _Book:
    """State of one configuration."""

    equity: float
    start: float
    day: int = -1
    pnl: float = 0.0
    latched: bool = False
    fills: int = 0
    consumed: set = field(default_factory=set)
    pending: dict = field(default_factory=dict)
    positions: dict = field(default_factory=dict)
    trades: list = field(default_factory=list)

    def new_day(self, day: int) -> None:
        self.day, self.start, self.pnl, self.latched, self.fills = day, self.equity, 0.0, False, 0
        self.consumed.clear()

    def realise(self, p: _Position, price: float, qty: float) -> None:
        gain = p.side * (price - p.entry) * qty
        p.gross, p.left = p.gross + gain, p.left - qty
        self.equity, self.pnl = self.equity + gain, self.pnl + gain
        if self.pnl <= -PARAMETERS["daily_stop"] * self.start:
            self.latched = True

    def close(self, p: _Position, price: float, at: int, why: str) -> None:
        self.realise(p, price, p.left)
        del self.positions[p.symbol]
        self.trades.append((p.symbol, "LONG" if p.side > 0 else "SHORT", p.level, p.activated, p.filled, at, p.qty, p.entry, p.l_unit, p.gross, p.funding, why))


def _minute(book: _Book, at: int, rows: dict) -> None:
    """Boundary ``at``: the minute [at - 60 s, at), then what is due at ``at``. ``rows``: symbol -> event row."""
    opened = set()
    for s, p in sorted(book.pending.items()):  # fills by strict penetration, before any cancellation
        r = rows.get(s)
        if r is not None and r.low is not None and (r.low < p.entry if p.side > 0 else r.high > p.entry):
            p.filled = at - MINUTE
            book.positions[s] = p
            book.fills += 1
            opened.add(s)
    for s in opened:
        del book.pending[s]
    stops, others = [], []
    for s, p in sorted(book.positions.items()):
        r = rows.get(s)
        if r is None or r.low is None:
            continue
        touched = r.low <= p.stop if p.side > 0 else r.high >= p.stop
        (stops if touched else others).append((p, r))
    for p, _ in sorted(stops, key=lambda x: (x[0].side * (x[0].stop - x[0].entry), x[0].symbol)):  # losses before profits
        book.close(p, p.stop, at, "EXIT_BE" if p.after_tp1 else "EXIT_INITIAL_STOP")
    through = lambda p, r, goal: r.high > goal if p.side > 0 else r.low < goal
    for p, r in others:
        if p.symbol in opened:  # no target in the entry minute
            continue
        if not p.after_tp1 and through(p, r, p.tp1):
            book.realise(p, p.tp1, p.qty * PARAMETERS["tp1_share"])
            p.after_tp1, p.stop = True, p.be
            if r.low <= p.be if p.side > 0 else r.high >= p.be:
                book.close(p, p.be, at, "EXIT_BE")
                continue
        if p.after_tp1 and p.tp2 is not None and through(p, r, p.tp2):
            book.close(p, p.tp2, at, "EXIT_TP2")
    for s, p in sorted(book.positions.items()):  # funding due at the boundary; credits are withheld where timing is unknown
        r = rows.get(s)
        if r is not None and r.funding_rate is not None and r.mark is not None:
            fee = p.side * p.left * r.mark * r.funding_rate
            if s not in opened or fee > 0:
                p.funding -= fee
                book.equity, book.pnl = book.equity - fee, book.pnl - fee
                book.latched |= book.pnl <= -PARAMETERS["daily_stop"] * book.start
    for s, p in sorted(book.positions.items()):
        r = rows.get(s)
        if r is None or (r.open is None and r.settlement is None):
            continue
        if r.settlement is not None:  # delivered: the position is settled at the official price
            book.close(p, r.settlement, at, "EXIT_DELIVERY")
            continue
        if r.delivery_known:  # known to end before the session does: out at the first open
            book.close(p, r.open, at, "EXIT_DELIVERY_RISK")
            continue
        false_break = r.close_15m is not None and (r.close_15m < p.level if p.side > 0 else r.close_15m > p.level)
        if r.session_end or false_break:
            book.close(p, r.open, at, "EXIT_SESSION_END" if r.session_end else "EXIT_FALSE_BREAK")
    for s, p in list(book.pending.items()):
        r = rows.get(s)
        if book.latched or at >= p.expiry or (r is not None and (r.blackout or r.session_end or r.delivery_known or r.settlement is not None)):
            del book.pending[s]


def _admit(book: _Book, at: int, rows: dict) -> None:
    """Candidates activated at ``at``: gates, then admission one by one in rank order."""
    ready = []
    for s, r in rows.items():
        if r.side is None or r.open is None or at >= r.expiry_ms or r.blackout or book.latched or r.delivery_known:
            continue
        side = 1 if r.side == "LONG" else -1
        if (s, r.side, r.level) in book.consumed or (r.open <= r.entry if side > 0 else r.open >= r.entry):
            continue
        ready.append((-r.turnover_sum, -r.volume_ratio, s, side, r))
    for _, _, s, side, r in sorted(ready, key=lambda x: x[:3]):
        held = [*book.pending.values(), *book.positions.values()]
        if s in book.pending or s in book.positions or len(held) >= PARAMETERS["slots"] or book.fills + len(book.pending) >= PARAMETERS["fills"]:
            continue
        risk_left = PARAMETERS["total_risk"] * book.equity - sum(p.qty * p.l_unit for p in held)
        notional_left = PARAMETERS["portfolio_notional"] * book.equity - sum(p.qty * p.entry for p in held)
        if risk_left <= 0 or notional_left <= 0 or r.l_unit <= 0:
            continue
        qty = min(PARAMETERS["risk"] * book.equity / r.l_unit, risk_left / r.l_unit, PARAMETERS["position_notional"] * book.equity / r.entry, notional_left / r.entry)
        qty = int(qty / r.qty_step + 1e-9) * r.qty_step
        if qty <= 0:
            continue
        book.consumed.add((s, r.side, r.level))
        book.pending[s] = _Position(s, side, r.level, r.entry, r.stop, r.tp1, r.tp2, r.be, qty, r.l_unit, int(r.expiry_ms), at, qty)


def replay(events: DataFrame, equity: float = 100_000.0) -> DataFrame:
    """Closed trades of each configuration, from ``events`` (columns and types as EVENTS): a row describes the minute that ends
    at minute_ms for OHLC of that minute, with ``open`` the open at the boundary, and a candidate (side, ...) activated then."""

    columns = [c.split()[0] for c in TRADES.split(", ")]

    def fold(batches):
        config = at = book = None
        rows, out = {}, []

        def step() -> None:
            if rows:
                if at // DAY != book.day:
                    book.new_day(at // DAY)
                _minute(book, at, rows)
                _admit(book, at, rows)
                out.extend((config, *x) for x in book.trades)
                book.trades.clear()
                rows.clear()

        for pdf in batches:
            for r in pdf.astype(object).where(pdf.notna(), None).itertuples(index=False):
                if r.config != config or r.minute_ms != at:
                    step()
                    if r.config != config:
                        book = _Book(equity, equity)
                    config, at = r.config, r.minute_ms
                rows[r.symbol] = r
            yield pd.DataFrame(out, columns=columns)
            out.clear()
        step()
        yield pd.DataFrame(out, columns=columns)

    return events.repartition(64, "config").sortWithinPartitions("config", "minute_ms", "symbol").mapInPandas(fold, TRADES)


def ledgers(trades: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Every trade under every cost scenario (scenario, maker, taker, slip): the path stays, costs and net R differ. The
    scenarios are a handful of rows, which become an array; more than MOST_SCENARIOS are refused."""
    known = scenarios.limit(MOST_SCENARIOS + 1).collect()
    if not 1 <= len(known) <= MOST_SCENARIOS:
        raise ValueError(f"needs 1 to {MOST_SCENARIOS} scenarios")
    each = F.explode(F.array(*(F.struct(*(F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in scenarios.schema)) for r in known)))
    paid = F.col("qty") * F.col("entry") * (F.col("maker") + F.col("taker") + F.col("slip"))
    net = F.col("gross") + F.col("funding") - paid
    return trades.withColumn("_s", each).select(*trades.columns, "_s.*").withColumn("costs", paid).withColumn("net", net).withColumn("net_r", net_r(F.col("net"), F.col("qty"), F.col("l_unit")))


def net_r(net: Column, qty: Column, l_unit: Column) -> Column:
    """A trade's result in units of what it risked."""
    return net / F.nullif(qty * l_unit, F.lit(0.0))
