"""Breakout signals: levels, crosses, gates, stops and targets, funnel, sizing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.decimals import GRID, floor_to_step, rounded_price
from ..functions.timeops import DAY
from .halo import framed

#: Parameters of the strategy, frozen before validation.
PARAMETERS = {"ema_period": 50, "slope_lag": 3, "volume_ratio": 1.5, "atr_period": 14, "stop_atr": 0.5, "expiry_bars": 8, "k_cost": 5, "risk": 0.005, "total_risk": 0.01, "slots": 2, "fills": 3, "daily_stop": 0.01, "position_notional": 2.0, "portfolio_notional": 3.0, "tp1_share": 0.5, "tp1_r": 2}
#: One factor at a time.
NEIGHBOURS = (("ema_period", 45), ("ema_period", 55), ("volume_ratio", 1.4), ("volume_ratio", 1.6), ("stop_atr", 0.4), ("stop_atr", 0.6), ("expiry_bars", 6), ("expiry_bars", 10), ("k_cost", 4), ("k_cost", 6))
#: Reason codes.
REASONS = (
    "REJECT_WRONG_LEVEL_DIRECTION",
    "REJECT_LEVEL_CONSUMED",
    "REJECT_TREND_ALT",
    "REJECT_TREND_BTC",
    "REJECT_VOLUME",
    "REJECT_SESSION",
    "REJECT_NEWS",
    "REJECT_COST_FLOOR",
    "REJECT_ROOM",
    "REJECT_SLOT_CAPACITY",
    "REJECT_RISK_CAPACITY",
    "REJECT_DAILY_TRADE_CAPACITY",
    "REJECT_DAILY_LOSS_STOP",
    "REJECT_NOTIONAL_MINIMUM",
    "REJECT_DATA_GAP",
    "REJECT_GRID_UNKNOWN",
    "REJECT_ACTIVATION_THROUGH_LEVEL",
    "REJECT_DELIVERY_RISK",
    "REJECT_DECISION_DATA_UNAVAILABLE",
    "ENTRY_EXPIRED",
    "ENTRY_CANCELLED_NEWS",
    "ENTRY_CANCELLED_DAILY_STOP",
    "ENTRY_FILLED",
    "EXIT_INITIAL_STOP",
    "EXIT_TP1",
    "EXIT_BE",
    "EXIT_TP2",
    "EXIT_FALSE_BREAK",
    "EXIT_SESSION_END",
    "EXIT_DELIVERY_RISK",
    "EXIT_DELIVERY",
)


def configurations() -> list[dict]:
    """The base parameters and the ten neighbours, each named."""
    return [{"config": "BASE", **PARAMETERS}] + [{"config": f"{k}={v}", **PARAMETERS, k: v} for k, v in NEIGHBOURS]


def merge_levels(levels: DataFrame) -> DataFrame:
    """Levels (symbol, day_ms, side, price, label, tick) of one side at most a tick apart become one: the highest for LONG,
    the lowest for SHORT, with all labels."""
    w = Window.partitionBy("symbol", "day_ms", "side").orderBy("price", "label")
    new = F.coalesce(F.col("price") - F.lag("price").over(w) > F.col("tick"), F.lit(True)).cast("int")
    grouped = levels.withColumn("cluster", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    price = F.when(F.col("side") == "LONG", F.max("price")).otherwise(F.min("price"))
    return grouped.groupBy("symbol", "day_ms", "side", "cluster").agg(price.alias("price"), F.array_sort(F.collect_list("label")).alias("labels")).drop("cluster")


def crosses(bars: DataFrame, levels: DataFrame, day: Column) -> DataFrame:
    """Crossed levels of each bar, the outermost as setup: symbol, start_ms, side, level, crossed (all of them)."""
    moved = framed(bars, ["symbol"], "start_ms", 1, lambda b, w: b.withColumn("previous_close", F.lag("close").over(w)), 30 * DAY).withColumn("day_ms", day)
    joined = moved.join(levels.select("symbol", "day_ms", "side", F.col("price").alias("level")), ["symbol", "day_ms"])
    up = (F.col("side") == "LONG") & (F.col("previous_close") <= F.col("level")) & (F.col("close") > F.col("level"))
    down = (F.col("side") == "SHORT") & (F.col("previous_close") >= F.col("level")) & (F.col("close") < F.col("level"))
    best = F.when(F.col("side") == "LONG", F.max("level")).otherwise(F.min("level"))
    return joined.where(up | down).groupBy("symbol", "start_ms", "side").agg(best.alias("level"), F.array_sort(F.collect_set("level")).alias("crossed"))


def trend_ok(side: Column, close: Column, ema: Column, rising: Column, falling: Column) -> Column:
    return F.coalesce(F.when(side == "LONG", (close > ema) & rising).otherwise((close < ema) & falling), F.lit(False))


def both_trends_ok(side: Column, alt: tuple[Column, Column, Column, Column], btc: tuple[Column, Column, Column, Column]) -> Column:
    """The trend gate asks both legs, the traded symbol and the market's leader; each is (close, ema, rising, falling)."""
    return trend_ok(side, *alt) & trend_ok(side, *btc)


def confirmed(crosses: DataFrame, ratios: DataFrame, least: float = 1.5) -> DataFrame:
    """Crosses (symbol, start_ms, ...) whose bar also has a volume ratio (symbol, start_ms, volume_ratio) of at least ``least``: a breakout
    needs both."""
    return crosses.join(ratios.select("symbol", "start_ms", "volume_ratio"), ["symbol", "start_ms"]).where(F.col("volume_ratio") >= least)


def setup_reason(**gates: Column) -> Column:
    """The first gate that refuses a setup, as its reason code, or null. ``gates`` are true where they pass, a null refuses; they
    are asked in the order data, session, grid, direction, trend_alt, trend_btc, volume, news, room, cost, delivery."""
    codes = {
        "data": "REJECT_DATA_GAP", "session": "REJECT_SESSION", "grid": "REJECT_GRID_UNKNOWN", "direction": "REJECT_WRONG_LEVEL_DIRECTION", "trend_alt": "REJECT_TREND_ALT", "trend_btc": "REJECT_TREND_BTC",
        "volume": "REJECT_VOLUME", "news": "REJECT_NEWS", "room": "REJECT_ROOM", "cost": "REJECT_COST_FLOOR", "delivery": "REJECT_DELIVERY_RISK",
    }
    return F.coalesce(*(F.when(~F.coalesce(gates[g], F.lit(False)), F.lit(code)) for g, code in codes.items() if g in gates), F.lit(None).cast("string"))


def priced(setups: DataFrame, stop_atr: float = 0.5, k_cost: int = 5) -> DataFrame:
    """Entry, stop, R and TP1 on the grid, and the cost floor, for setups (side, level, atr, tick, maker, taker, slip)."""
    raw = F.when(F.col("side") == "LONG", F.col("level") - F.col("atr") * stop_atr).otherwise(F.col("level") + F.col("atr") * stop_atr)
    out = setups.withColumn("entry", rounded_price(F.col("level"), F.col("tick"), F.col("side"), "entry")).withColumn("stop", rounded_price(raw, F.col("tick"), F.col("side"), "stop"))
    out = out.withColumn("r_price", F.abs(F.col("entry") - F.col("stop")).cast(GRID))
    goal = F.when(F.col("side") == "LONG", F.col("entry") + 2 * F.col("r_price")).otherwise(F.col("entry") - 2 * F.col("r_price"))
    out = out.withColumn("tp1", rounded_price(goal, F.col("tick"), F.col("side"), "target1"))
    money = lambda p, r: (F.col(p).cast("decimal(18,6)") * F.col(r).cast("decimal(12,8)")).cast(GRID)
    out = out.withColumn("c_stop", (money("entry", "maker") + money("stop", "taker") + money("stop", "slip")).cast(GRID))
    return out.withColumn("cost_floor_ok", F.col("r_price") >= k_cost * F.col("c_stop")).withColumn("l_unit", (F.col("r_price") + F.col("c_stop")).cast(GRID))


def room_ok(side: Column, entry: Column, target: Column, r_price: Column) -> Column:
    """Whether the next objective, if any, lies at least 2 R away."""
    distance = F.when(side == "LONG", target - entry).otherwise(entry - target)
    return F.coalesce(distance >= 2 * r_price, F.lit(True))


def sized(rows: DataFrame, risk: float = 0.005, total_risk: float = 0.01, position: float = 2.0, portfolio: float = 3.0) -> DataFrame:
    """Quantity: the least of risk, remaining risk, position notional and remaining portfolio notional, floored to the step.
    Needs equity, l_unit, entry, reserved_risk, reserved_notional, qty_step."""
    eq, unit, entry = F.col("equity").cast("decimal(18,4)"), F.col("l_unit").cast("decimal(14,6)"), F.col("entry").cast("decimal(14,6)")
    d = lambda x: F.lit(str(x)).cast("decimal(6,4)")
    left = lambda part, used: F.greatest(F.lit(0).cast("decimal(24,8)"), (eq * d(part)).cast("decimal(24,8)") - F.col(used).cast("decimal(24,8)"))
    ratio = lambda a, b: (a.cast("decimal(24,8)") / b).cast("decimal(28,12)")
    caps = {"qty_risk": ratio(eq * d(risk), unit), "qty_capacity": ratio(left(total_risk, "reserved_risk"), unit), "qty_position": ratio(eq * d(position), entry), "qty_portfolio": ratio(left(portfolio, "reserved_notional"), entry)}
    out = rows.withColumns(caps)
    out = out.withColumn("qty", floor_to_step(F.least(*caps), F.col("qty_step")))
    return out.withColumn("decision", F.when(F.col("qty_capacity") <= 0, "REJECT_RISK_CAPACITY").when(F.col("qty") <= 0, "REJECT_NOTIONAL_MINIMUM").otherwise("ACCEPT"))


def funnel(rows: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """How many rows pass each stage and all before it, and the share of the stage before."""
    passed, columns = F.lit(True), [F.count("*").alias("n_00_all")]
    for i, (name, ok) in enumerate(stages, 1):
        passed = passed & F.coalesce(ok, F.lit(False))
        columns.append(F.count_if(passed).alias(f"n_{i:02d}_{name}"))
    counts = rows.agg(*columns)
    names = counts.columns
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("stage_no"), F.lit(n[5:]).alias("stage"), F.col(n).alias("n"), F.col(names[max(0, i - 1)]).alias("before")) for i, n in enumerate(names))))
    return counts.select(each.alias("s")).select("s.stage_no", "s.stage", "s.n", F.when(F.col("s.before") > 0, F.round(100.0 * F.col("s.n") / F.col("s.before"), 3)).alias("pct"))
