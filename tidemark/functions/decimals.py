"""Exact decimals: grids, storage rules, canonical text, coverage percent, money formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stored values have 18 decimal places and at most 20 digits before them.
STORED = "decimal(38,18)"
#: Operands of grid and money formulas; wider ones would lose digits in Spark's result types.
GRID = "decimal(28,12)"


def floor_to_step(value: Column, step: Column) -> Column:
    """The largest multiple of ``step`` not above ``value``; a step of 0 or less raises. Division would round."""
    v, s = value.cast(GRID), step.cast(GRID)
    safe = F.when(s > 0, s).otherwise(F.raise_error(F.lit("step must be positive")).cast(GRID))
    return (v - F.pmod(v, safe)).cast(GRID)


def ceil_to_step(value: Column, step: Column) -> Column:
    return (-floor_to_step(-value, step)).cast(GRID)


def coverage_pct(actual: Column, expected: Column) -> Column:
    """Percent as text with three places, half to even; 0 where nothing is expected."""
    exact = actual.cast("decimal(20,0)") * 100 / F.nullif(expected, F.lit(0)).cast("decimal(20,0)")
    return F.when(expected <= 0, F.lit("0")).otherwise(F.bround(exact.cast("decimal(30,12)"), 3).cast("decimal(20,3)").cast("string"))


def stored(text: Column) -> Column:
    """Decimal text as DECIMAL(38,18); a value that is no finite number, or does not fit without rounding, raises."""
    value = F.try_to_number(text, F.lit("S99999999999999999999.999999999999999999"))
    value = F.coalesce(value, text.try_cast(STORED))
    places = F.length(F.regexp_extract(text, r"\.(\d*?)0*(?:[eE].*)?$", 1))
    bad = value.isNull() | (places > 18)
    return F.when(text.isNull(), F.lit(None).cast(STORED)).when(bad, F.raise_error(F.concat(F.lit("not storable: "), text)).cast(STORED)).otherwise(value.cast(STORED))


def canonical_text(value: Column) -> Column:
    """Plain text with 18 places."""
    return value.cast(STORED).cast("string")


def scaled_int(value: Column, scale: int = 10) -> Column:
    """value * 10^scale as an integer; inexact values raise."""
    wide = value.cast(STORED)
    kept = wide.cast(f"decimal({20 + scale},{scale})")
    digits = F.regexp_replace(kept.cast("string"), r"\.", "").cast("decimal(38,0)")
    return F.when(wide.isNull() | (wide == kept), digits).otherwise(F.raise_error(F.concat(F.lit("inexact at this scale: "), wide.cast("string"))).cast("decimal(38,0)"))


def from_scaled_int(value: Column, scale: int = 10) -> Column:
    return (value.cast("decimal(27,0)") * F.lit(f"1e-{scale}").cast(f"decimal(11,{scale})")).cast(f"decimal(38,{scale})")


def rounded_price(value: Column, tick: Column, side: Column, what: str) -> Column:
    """Prices on the grid by side (LONG or SHORT): entry, stop and target2 down for LONG, target1 and be up; mirrored."""
    down_for_long = what in ("entry", "stop", "target2")
    down = (side == "LONG") if down_for_long else (side == "SHORT")
    return F.when(down, floor_to_step(value, tick)).otherwise(ceil_to_step(value, tick))


def stop_cost(entry: Column, stop: Column, maker: Column, taker: Column, slip: Column) -> Column:
    """Expected cost per unit of being stopped: entry fee, exit fee, slippage."""
    money = lambda p, r: (p.cast("decimal(18,6)") * r.cast("decimal(12,8)")).cast(GRID)
    return (money(entry, maker) + money(stop, taker) + money(stop, slip)).cast(GRID)


def funding_fee(quantity: Column, mark: Column, rate: Column) -> Column:
    """Quote currency paid (positive) or received by a LONG position."""
    return (quantity.cast("decimal(14,4)") * mark.cast("decimal(14,6)") * rate.cast("decimal(10,8)")).cast("decimal(38,18)")


def adverse_bps(side: Column, fill: Column, reference: Column) -> Column:
    """Adverse slippage of an exit in basis points, 0 if favourable. Against a reference of 0 it is infinite, and not a number where the
    fill is 0 too."""
    worse = F.when(side == "LONG", reference - fill).otherwise(fill - reference).cast("double")
    by_zero = F.when(worse == 0, F.lit(float("nan"))).otherwise(F.signum(worse) * float("inf"))
    return F.greatest(F.lit(0.0), F.when(reference == 0, by_zero).otherwise(worse / F.nullif(reference.cast("double"), F.lit(0.0)) * 10_000))
