"""Indicators that reset at gaps, period levels, ranks of the universe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.shared import cut
from ..functions.timeops import DAY
from .bars import roll_up, segments
from .halo import framed


def _chained(rows: DataFrame, value: str, period: int, keep: float, gain: float, out: str, lag: int = 0, block: int = 512) -> DataFrame:
    """``rows`` (symbol, segment, pos from 1 in the segment) with a recursive mean ``out``: null before position ``period``, there the
    mean of the values so far, then keep * mean + gain * value. With ``lag``, ``before`` is the mean so many rows earlier.

    A step is an affine map, so blocks of a segment are folded apart, each from 0; what a block ends with and its length give
    the carry into the next one, and a row is its own fold plus keep^i times that carry. A row a block is what a
    segment gathers in one place, however long it is."""
    block = max(block, period, lag)
    keys = ["symbol", "segment"]
    item = F.struct(F.col("pos"), F.col(value).cast("double").alias("x"), F.struct(*rows.columns).alias("row"))
    dealt = rows.groupBy(*keys, F.floor((F.col("pos") - 1) / block).alias("_b")).agg(F.array_sort(F.collect_list(item)).alias("c"))
    fold = lambda first, rest: f"aggregate({rest}, array({first}), (r, y) -> concat(r, array({keep!r}D * element_at(r, -1) + {gain!r}D * y.x)))"
    seed = f"aggregate(slice(c, 1, {period}), 0D, (s, y) -> s + y.x) / {period}D"
    seeded = f"CASE WHEN size(c) < {period} THEN array_repeat(cast(NULL AS double), size(c)) ELSE concat(array_repeat(cast(NULL AS double), {period - 1}), {fold(seed, f'slice(c, {period + 1}, size(c))')}) END"
    dealt = dealt.withColumn("local", F.expr(f"CASE WHEN _b = 0 THEN {seeded} ELSE slice({fold('0D', 'c')}, 2, size(c)) END"))
    ends = dealt.select(*keys, F.struct("_b", F.size("c").alias("n"), F.element_at("local", -1).alias("m"), F.expr(f"slice(local, greatest(1, size(local) - {lag - 1}), {lag})" if lag else "cast(array() AS array<double>)").alias("tail")).alias("e"))
    carried = "named_struct('v', e.m + pow({k}D, e.n) * coalesce(a.v, 0D), 'tail', transform(e.tail, (m, i) -> m + pow({k}D, e.n - size(e.tail) + i + 1) * coalesce(a.v, 0D)), 'f', concat(a.f, array(named_struct('_b', e._b, 'carry', coalesce(a.v, 0D), 'tail', a.tail))))".format(k=repr(keep))
    start = "named_struct('v', cast(NULL AS double), 'tail', cast(array() AS array<double>), 'f', cast(array() AS array<struct<_b: bigint, carry: double, tail: array<double>>>))"
    links = ends.groupBy(*keys).agg(F.array_sort(F.collect_list("e")).alias("es")).select(*keys, F.expr(f"explode(aggregate(es, {start}, (a, e) -> {carried}, a -> a.f))").alias("l")).select(*keys, "l.*")
    whole = dealt.join(links, [*keys, "_b"]).withColumn("made", F.expr(f"transform(local, (m, i) -> m + pow({keep!r}D, i + 1) * carry)"))
    ext = "concat(tail, made)"
    parts = f"transform(c, (y, i) -> struct(y.row AS row, made[i] AS m, get({ext}, i + size(tail) - {lag}) AS before))"
    each = whole.select(F.explode(F.expr(parts)).alias("e"))
    return each.select("e.row.*", F.col("e.m").alias(out), *([F.col("e.before").alias("before")] if lag else []))


def ema(bars: DataFrame, step: int, period: int = 50, lag: int = 3, value: str = "close") -> DataFrame:
    """``ema`` (null before its seed) and ``ema_rising``, against ``lag`` bars before, within contiguous segments."""
    chained = _chained(segments(bars, step), value, period, 1 - 2 / (period + 1), 2 / (period + 1), "ema", lag)
    known = F.col("before").isNotNull()
    return chained.withColumn("ema_rising", F.when(known, F.col("ema") > F.col("before"))).withColumn("ema_falling", F.when(known, F.col("ema") < F.col("before"))).drop("before")


def chained_in_groups(bars: DataFrame, step: int, period: int = 50) -> DataFrame:
    """The same EMA by one pandas pass per segment, which is held whole: a plain form to compare with."""

    def one(pdf):
        pdf = pdf.sort_values("start_ms")
        x, out = pdf["close"].astype(float).to_numpy(), [None] * len(pdf)
        if len(x) >= period:
            m = sum(x[:period].tolist()) / period
            out[period - 1] = m
            alpha, rest = 2 / (period + 1), 1 - 2 / (period + 1)
            for i in range(period, len(x)):
                m = alpha * float(x[i]) + rest * m
                out[i] = m
        return pdf.assign(ema=out)[["symbol", "start_ms", "ema"]].astype({"ema": "float64"})

    return segments(bars, step).select("symbol", "segment", "start_ms", "close").groupBy("symbol", "segment").applyInPandas(one, "symbol string, start_ms long, ema double")


def atr(bars: DataFrame, step: int, period: int = 14) -> DataFrame:
    """Wilder's average true range; a segment's first bar only gives the previous close, which a join by the start before finds."""
    seg = segments(bars, step)
    closes = seg.select("symbol", (F.col("start_ms") + step).alias("start_ms"), F.col("close").alias("_before"))
    after = seg.where("pos > 1").join(closes, ["symbol", "start_ms"]).withColumn("pos", F.col("pos") - 1)
    tr = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("_before")), F.abs(F.col("low") - F.col("_before")))
    valid = after.withColumn("tr", tr.cast("double")).drop("_before").select(*seg.columns, "tr")
    return _chained(valid, "tr", period, (period - 1) / period, 1 / period, "atr")


def volume_ratio(bars: DataFrame, n: int = 20, width: int = DAY) -> DataFrame:
    """Volume over the mean of the ``n`` bars before it; null without that many, or where their mean is 0. Bars are dealt by ``width``."""

    def make(rows: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(-n, -1)
        mean = F.when(F.count("volume").over(frame) == n, F.avg(F.col("volume").cast("double")).over(frame))
        return rows.withColumn("volume_ratio", F.col("volume").cast("double") / F.nullif(mean, F.lit(0.0)))

    return framed(bars, ["symbol"], "start_ms", n, make, width)


def period_levels(bars: DataFrame, step: int, period_ms: int) -> DataFrame:
    """High and low of the period before, only if it was complete and directly precedes."""
    whole = roll_up(bars, step, period_ms)
    w = Window.partitionBy("symbol").orderBy("start_ms")
    adjacent = F.lag("start_ms").over(w) == F.col("start_ms") - period_ms
    return whole.select("symbol", "start_ms", F.when(adjacent, F.lag("high").over(w)).alias("previous_high"), F.when(adjacent, F.lag("low").over(w)).alias("previous_low"))


def universe(bars: DataFrame, cutoff: Column, step: int, n: int = 96, top_turnover: int = 20, top_volatility: int = 5) -> DataFrame:
    """Per day: of the symbols with ``n`` contiguous closed bars before the day's cutoff, the ``top_turnover`` by turnover, then the
    ``top_volatility`` by standard deviation of the n - 1 log returns; ties by turnover, then symbol."""
    day = F.col("start_ms") - F.pmod("start_ms", F.lit(DAY))

    def make(rows: DataFrame, w: WindowSpec) -> DataFrame:
        before = F.lag("close").over(w)
        follows = (F.lag("start_ms").over(w) == F.col("start_ms") - step) & (F.col("close") > 0) & (before > 0)
        with_return = rows.withColumn("ret", F.when(follows, F.log(F.col("close").cast("double") / before.cast("double"))))
        frame, inner = w.rowsBetween(-(n - 1), 0), w.rowsBetween(-(n - 2), 0)
        return with_return.withColumn("turnover_sum", F.sum("turnover").over(frame)).withColumn("rv", F.stddev_samp("ret").over(inner)).withColumn("n_ret", F.count("ret").over(inner))

    rolled = framed(bars, ["symbol"], "start_ms", n, make, max(DAY, n * step))
    closed = rolled.withColumn("day_ms", day).where((F.col("start_ms") + step <= cutoff) & (F.col("n_ret") == n - 1))
    last = closed.groupBy("symbol", "day_ms").agg(F.max_by(F.struct("turnover_sum", "rv"), "start_ms").alias("s")).select("symbol", "day_ms", "s.*")
    by_turnover = F.row_number().over(Window.partitionBy("day_ms").orderBy(F.desc("turnover_sum"), "symbol"))
    first = last.withColumn("turnover_rank", by_turnover).where(F.col("turnover_rank") <= top_turnover)
    by_rv = F.row_number().over(Window.partitionBy("day_ms").orderBy(F.desc("rv"), F.desc("turnover_sum"), "symbol"))
    return first.withColumn("rv_rank", by_rv).where(F.col("rv_rank") <= top_volatility)


def admission_rank() -> Column:
    return F.row_number().over(Window.partitionBy("activation_ms").orderBy(F.desc("turnover_sum"), F.desc("volume_ratio"), "symbol"))


def _gcd(a: str, b: str) -> str:
    return f"aggregate(sequence(1, 92), struct(cast({a} AS bigint) AS x, cast({b} AS bigint) AS y), (s, _i) -> CASE WHEN s.y = 0 THEN s ELSE struct(s.y AS x, s.x % s.y AS y) END, s -> s.x)"


def _divisors(units: DataFrame, keys: list[str]) -> DataFrame:
    """keys, g, k: the greatest common divisor of the distinct units u of a key, and their number. Units are reduced in partial groups before
    they meet."""
    fold = "aggregate({}, 0L, (a, b) -> " + _gcd("a", "b") + ")"
    parts = units.distinct().groupBy(*keys, F.pmod(F.xxhash64("u"), F.lit(64)).alias("_part")).agg(F.expr(fold.format("collect_list(u)")).alias("g"), F.count("*").alias("k"))
    return parts.groupBy(*keys).agg(F.expr(fold.format("collect_list(g)")).alias("g"), F.sum("k").alias("k"))


def _units(prices: DataFrame, places: int, *more: Column) -> DataFrame:
    return prices.select("symbol", F.round(F.col("px").cast("decimal(28,12)") * 10**places).cast("long").alias("u"), *more)


def tick_lattice(prices: DataFrame, places: int = 8) -> DataFrame:
    """symbol, tick_units: the greatest common divisor of a symbol's prices in units of 10^-places."""
    return _divisors(_units(prices, places), ["symbol"]).select("symbol", F.col("g").alias("tick_units"))


#: Bits of evidence that a change of the lattice needs: prices that would lie on the coarser lattice by chance with a probability of 2^-20 at most.
BITS = 20


def lattice_regimes(prices: DataFrame, period_ms: int, places: int = 8, declared: DataFrame | None = None, bits: int = BITS) -> DataFrame:
    """Price lattices of symbols over time: symbol, from_ms, to_ms, tick_units, prices (distinct ones by period), trades, on_lattice and confidence.

    Every period (from ``t`` of the prices: symbol, t, px) has the divisor of its own prices. Periods join their neighbours as long as the lattice
    holds; a regime ends where prices leave its lattice although ``bits`` speak for it, or keep to a coarser one for as much evidence. k prices lie on a
    lattice c times as coarse as the true one by chance with probability c^-k, so they give k log2(c) bits, and a regime of k prices has the
    confidence 1 - 2^-k. ``on_lattice`` is the share of the regime's trades on its lattice, counted again; with ``declared`` (symbol, tick_units) also
    ``on_declared``, which is null without such a row. What is gathered by symbol is a row a period. Prices that are not positive are left out."""
    units = _units(prices.where("px > 0"), places, (F.floor(F.col("t") / period_ms) * period_ms).alias("p"))
    each = _divisors(units, ["symbol", "p"])
    both = _gcd("r.g", "e.g")
    breaks = f"r.g > 0 AND ((d = r.g AND e.g > r.g AND e.k * log2(e.g / r.g) >= {bits}) OR (d < r.g AND r.k * log2(r.g / d) >= {bits}))"
    own = "struct(r.a AS a, r.z AS z, r.g AS g, r.k AS k)"
    step = f"transform(array({both}), d -> CASE WHEN {breaks} THEN struct(e.p AS a, e.p AS z, e.g AS g, e.k AS k, concat(r.done, array({own})) AS done) ELSE struct(coalesce(r.a, e.p) AS a, e.p AS z, d AS g, r.k + e.k AS k, r.done AS done) END)[0]"
    start = "struct(cast(NULL AS bigint) AS a, cast(NULL AS bigint) AS z, 0L AS g, 0L AS k, cast(array() AS array<struct<a: bigint, z: bigint, g: bigint, k: bigint>>) AS done)"
    ordered = each.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("p", "g", "k"))).alias("es"))
    regimes = ordered.select("symbol", F.explode(F.expr(f"aggregate(es, {start}, (r, e) -> {step}, r -> concat(r.done, array({own})))")).alias("r")).select("symbol", "r.*")
    regimes = cut(regimes)
    periods = each.select("symbol", "p").join(regimes, "symbol").where("p BETWEEN a AND z").select("symbol", "p", "a", "g")
    counted = units.groupBy("symbol", "p", "u").agg(F.count("*").alias("n")).join(periods, ["symbol", "p"])
    if declared is not None:
        counted = counted.join(declared.select("symbol", F.col("tick_units").alias("_said")), "symbol", "left")
    share = lambda g: F.round(F.sum(F.when(F.col("u") % F.col(g) == 0, F.col("n")).otherwise(F.when(F.col(g).isNotNull(), 0))) / F.sum("n"), 6)
    checked = counted.groupBy("symbol", "a").agg(F.sum("n").alias("trades"), share("g").alias("on_lattice"), *([share("_said").alias("on_declared")] if declared is not None else []))
    whole = regimes.join(checked, ["symbol", "a"])
    return whole.select(
        "symbol", F.col("a").alias("from_ms"), (F.col("z") + period_ms).alias("to_ms"), F.col("g").alias("tick_units"), F.col("k").alias("prices"), "trades", "on_lattice",
        *(["on_declared"] if declared is not None else []), F.round(1 - F.pow(F.lit(2.0), -F.col("k")), 9).alias("confidence"),
    )
