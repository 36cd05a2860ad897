"""Indicator chains and contiguous segments of a stream of bars.

EMA and ATR of a symbol are kept in one typed value of the state store. A stream goes on from its checkpoint after a restart, or begins where a
batch ended (``last_state`` is its initial state), so a chain is never seeded anew from a recent window; ``stored_state``
reads the values back as a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.bars import segments
from ..operators.indicators import atr, ema

#: What is kept of a symbol: its last bar, how many bars its segment has, and of either chain the sum of its seed and the mean.
STATE = "last_ms long, last_close double, n long, ema_sum double, ema double, tr_sum double, atr double"
_FRESH = (None, None, 0, 0.0, None, 0.0, None)
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def advance(state: tuple, t: int, high: float, low: float, close: float, step: int, ema_period: int, atr_period: int) -> tuple:
    """The state after one more bar; a bar that does not follow the last one begins a segment."""
    last, before, n, ema_sum, ema, tr_sum, atr = state
    if last is None or t != last + step:
        before, n, ema_sum, ema, tr_sum, atr = None, 0, 0.0, None, 0.0, None
    n += 1
    if n <= ema_period:
        ema_sum += close
        ema = ema_sum / ema_period if n == ema_period else None
    else:
        alpha = 2 / (ema_period + 1)
        ema = alpha * close + (1 - alpha) * ema
    if before is not None:
        tr, k = max(high - low, abs(high - before), abs(low - before)), n - 1
        if k <= atr_period:
            tr_sum += tr
            atr = tr_sum / atr_period if k == atr_period else None
        else:
            atr = ((atr_period - 1) * atr + tr) / atr_period
    return t, close, n, ema_sum, ema, tr_sum, atr


def _plain(values) -> tuple:
    """A state without NaN, which pandas puts for null."""
    last, before, n, ema_sum, ema, tr_sum, atr = (None if v is None or v != v else v for v in values)
    return None if last is None else int(last), before, int(n or 0), ema_sum or 0.0, ema, tr_sum or 0.0, atr


class Chains(StatefulProcessor):
    def __init__(self, step: int, ema_period: int, atr_period: int) -> None:
        self.step, self.ema_period, self.atr_period = step, ema_period, atr_period

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.chain = handle.getValueState("chain", STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        names = [c.split()[0] for c in STATE.split(", ")]
        for row in initialState[names].itertuples(index=False):
            self.chain.update(_plain(row))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        state = _plain(self.chain.get()) if self.chain.exists() else _FRESH
        batch = pd.concat(list(rows)).sort_values("start_ms", kind="stable")
        out = []
        for t, high, low, close in zip(batch["start_ms"].tolist(), *(batch[c].astype(float).tolist() for c in ("high", "low", "close")), strict=True):
            if state[0] is not None and t <= state[0]:
                continue
            state = advance(state, t, high, low, close, self.step, self.ema_period, self.atr_period)
            out.append((key[0], t, state[4], state[6]))
        self.chain.update(state)
        yield pd.DataFrame(out, columns=["symbol", "start_ms", "ema", "atr"]).astype({"symbol": "object", "start_ms": "int64", "ema": "float64", "atr": "float64"})


def chains(bars: DataFrame, step: int, ema_period: int = 50, atr_period: int = 14, start: DataFrame | None = None) -> DataFrame:
    """symbol, start_ms, ema, atr of a stream of bars (symbol, start_ms, high, low, close); null before a chain is seeded. Bars that are not later than a
    symbol's last one are ignored; a symbol's bars of one micro-batch are sorted together. ``start`` (symbol and STATE) is what chains begin from."""
    spark = bars.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    initial = None if start is None else start.groupBy("symbol")
    made = bars.select("symbol", "start_ms", "high", "low", "close").groupBy("symbol").transformWithStateInPandas(
        Chains(step, ema_period, atr_period), "symbol string, start_ms long, ema double, atr double", "Append", "None", initialState=initial,
    )
    return made.select("symbol", "start_ms", *(F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("ema", "atr")))


def last_state(bars: DataFrame, step: int, ema_period: int = 50, atr_period: int = 14) -> DataFrame:
    """symbol and STATE after the last of ``bars``, by the batch forms of the chains."""
    seg = segments(bars, step)
    ends = seg.groupBy("symbol").agg(F.max(F.struct("start_ms", "segment", "pos", "close")).alias("e")).select("symbol", "e.*")
    means = ema(bars, step, ema_period).select("symbol", "start_ms", "ema")
    ranges = atr(bars, step, atr_period).select("symbol", "start_ms", "segment", "pos", "tr", "atr")
    sums = seg.where(F.col("pos") <= ema_period).groupBy("symbol", "segment").agg(F.sum(F.col("close").cast("double")).alias("ema_sum"))
    tr_sums = ranges.where(F.col("pos") <= atr_period).groupBy("symbol", "segment").agg(F.sum("tr").alias("tr_sum"))
    whole = ends.join(means, ["symbol", "start_ms"], "left").join(ranges.select("symbol", "start_ms", "atr"), ["symbol", "start_ms"], "left")
    whole = whole.join(sums, ["symbol", "segment"], "left").join(tr_sums, ["symbol", "segment"], "left")
    return whole.select("symbol", F.col("start_ms").alias("last_ms"), F.col("close").cast("double").alias("last_close"), F.col("pos").alias("n"), F.coalesce("ema_sum", F.lit(0.0)).alias("ema_sum"), "ema", F.coalesce("tr_sum", F.lit(0.0)).alias("tr_sum"), "atr")


def stored_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """symbol and STATE as a stopped stream's checkpoint holds them."""
    rows = spark.read.format("statestore").option("stateVarName", "chain").load(checkpoint)
    return rows.select(F.col("key.symbol").alias("symbol"), "value.*")


def streamed_segments(bars: DataFrame, step: int, wait: str = "1 hour") -> DataFrame:
    """symbol, segment, last_ms, n, high, low, volume of the contiguous runs of a stream of bars, each once the watermark has passed its end: a
    session whose gap is a step. A bar that comes again before the watermark passes it counts once."""
    timed = bars.withColumn("at", F.timestamp_millis("start_ms")).withWatermark("at", wait).dropDuplicatesWithinWatermark(["symbol", "start_ms"])
    # a session is open to its end, so that the bar right at a step after the last one needs a gap of a millisecond more
    made = timed.groupBy("symbol", F.session_window("at", f"{step + 1} milliseconds").alias("w")).agg(
        F.min("start_ms").alias("segment"), F.max("start_ms").alias("last_ms"), F.count("*").alias("n"), F.max("high").alias("high"), F.min("low").alias("low"), F.sum("volume").alias("volume"),
    )
    return made.drop("w")
