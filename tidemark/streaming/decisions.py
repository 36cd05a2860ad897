"""Streaming decisions: 15-minute bars that are whole in time, telemetry of late bars, persistent indicator chains."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import MINUTE


def closed_windows(bars_1m: DataFrame, minutes: int = 15, wait: str = "60 seconds") -> DataFrame:
    """symbol, window_ms, n, available and OHLCV of each window, once the watermark passes it by ``wait``; a window without all
    its minutes is not available. ``bars_1m`` is a stream with start_ms; append mode."""
    timed = bars_1m.withColumn("close_time", F.timestamp_millis(F.col("start_ms") + MINUTE - 1))
    at = F.col("start_ms")
    made = timed.withWatermark("close_time", wait).groupBy("symbol", F.window("close_time", f"{minutes} minutes").alias("w")).agg(
        F.count("*").alias("n"), F.min_by("open", at).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", at).alias("close"), F.sum("volume").alias("volume"),
    )
    return made.select("symbol", F.unix_millis("w.start").alias("window_ms"), "n", (F.col("n") == minutes).alias("available"), "open", "high", "low", "close", "volume")


def counted_windows(trades: DataFrame, minutes: int = 15, wait: str = "60 seconds") -> DataFrame:
    """symbol, window_ms, trades and quantity of closed windows of a trade stream (symbol, ts, qty)."""
    made = trades.withWatermark("ts", wait).groupBy("symbol", F.window("ts", f"{minutes} minutes").alias("w")).agg(F.count("*").alias("trades"), F.sum("qty").alias("qty"))
    return made.select("symbol", F.unix_millis("w.start").alias("window_ms"), "trades", "qty")


def late_telemetry(native: DataFrame, decided: DataFrame, within: str = "30 minutes") -> DataFrame:
    """Native bars with the decision bar of the same time, where there is one: telemetry only. Both sides are streams with
    symbol, window_ms and an event time (native_time, decided_time)."""
    a = native.withWatermark("native_time", within).alias("a")
    b = decided.withWatermark("decided_time", within).alias("b")
    same = F.expr(f"a.symbol = b.symbol AND a.window_ms = b.window_ms AND b.decided_time BETWEEN a.native_time - INTERVAL {within} AND a.native_time + INTERVAL {within}")
    return a.join(b, same, "leftOuter").select("a.symbol", "a.window_ms", F.col("a.close").alias("native_close"), F.col("b.close").alias("decided_close"))


def ema_chain(bars: DataFrame, step: int, period: int = 50) -> DataFrame:
    """symbol, start_ms, ema of a stream of bars; the chain is kept per symbol in the state store and goes on after a restart.
    A gap starts a new chain; bars not later than the last one are ignored."""
    state = "last_ms long, seen long, total double, ema double"
    alpha = 2 / (period + 1)

    def update(key, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        last, seen, total, ema = held.get if held.exists else (None, 0, 0.0, None)
        rows = pd.concat(list(batches)).sort_values("start_ms")
        out = []
        for t, x in zip(rows["start_ms"].tolist(), rows["close"].astype(float).tolist(), strict=True):
            if last is not None and t <= last:
                continue
            if last is not None and t != last + step:
                seen, total, ema = 0, 0.0, None
            seen, last = seen + 1, t
            if seen <= period:
                total += x
                ema = total / period if seen == period else None
            else:
                ema = alpha * x + (1 - alpha) * ema
            out.append((key[0], t, ema))
        held.update((last, seen, total, ema))
        yield pd.DataFrame(out, columns=["symbol", "start_ms", "ema"]).astype({"ema": "float64"})

    return bars.groupBy("symbol").applyInPandasWithState(update, "symbol string, start_ms long, ema double", state, "append", "NoTimeout")


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write all that is available to Parquet and stop; the checkpoint lets the next call go on from there."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
