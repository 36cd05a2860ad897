"""Funding events: intervals, valuation against mark prices with fallbacks, cadence gate, delivery evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import sample_1_in
from ..functions.timeops import DAY, HOUR, MINUTE, is_aligned
from .halo import framed

LOOKBACK_MS = 120 * MINUTE


def distinct_events(rows: DataFrame) -> DataFrame:
    """By the texts of symbol, time and rate."""
    return rows.dropDuplicates(["symbol", "ts_text", "rate_text"])


def with_interval(events: DataFrame) -> DataFrame:
    """``events`` with the minutes since the symbol's event before."""
    since = lambda e, w: e.withColumn("interval_min", ((F.col("ts_ms") - F.lag("ts_ms").over(w)) / MINUTE).cast("long"))
    return framed(events, ["symbol"], "ts_ms", 1, since, 30 * DAY)


def intervals(events: DataFrame) -> DataFrame:
    """Sorted distinct gaps in minutes between a symbol's consecutive events."""
    return with_interval(events.select("symbol", "ts_ms").distinct()).groupBy("symbol").agg(F.array_sort(F.collect_set("interval_min")).alias("intervals_min"), F.min("interval_min").alias("min_interval_min"), F.count("*").alias("events"))


def value_events(events: DataFrame, marks_60m: DataFrame, marks_1m: DataFrame, denominator: int = 100) -> DataFrame:
    """Each event (symbol, ts_ms, rate) with a mark price: the hour's open, unless a sampled minute's open contradicts it,
    then the minute's open, then the close of the minute before (approximate), else none. Minute opens are looked
    at where there is no hourly one, and for a deterministic sample. The marks are joined by their own symbol and start, so canonical
    tables are read where they lie and only events are shuffled."""
    hour = marks_60m.select("symbol", F.col("start_ms").alias("ts_ms"), F.col("open").alias("mark_60m_open"))
    minute = marks_1m.select("symbol", F.col("start_ms").alias("ts_ms"), F.col("open").alias("minute_open"))
    previous = marks_1m.select("symbol", F.col("start_ms").alias("_before_ms"), F.col("close").alias("previous_close"))
    keys = ["symbol", "ts_ms"]
    joined = events.join(hour, keys, "left").join(minute, keys, "left").withColumn("_before_ms", F.col("ts_ms") - MINUTE).join(previous, ["symbol", "_before_ms"], "left")
    joined = joined.withColumn("hour_aligned", is_aligned(F.col("ts_ms"), HOUR)).withColumn("mark_60m_open", F.when(F.col("hour_aligned"), F.col("mark_60m_open")))
    checked = ~F.col("hour_aligned") | F.col("mark_60m_open").isNull() | sample_1_in(F.col("symbol"), F.col("ts_ms"), denominator)
    out = joined.withColumn("sampled_exact_1m", checked).withColumn("sampled_1m_open", F.when(F.col("sampled_exact_1m"), F.col("minute_open")))
    by_hour = F.col("mark_60m_open").isNotNull() & (F.col("sampled_1m_open").isNull() | (F.col("mark_60m_open") == F.col("sampled_1m_open")))
    source = F.when(by_hour, "MARK_60M_OPEN").when(F.col("sampled_1m_open").isNotNull(), "MARK_1M_OPEN").when(F.col("previous_close").isNotNull(), "MARK_PRICE_1M_APPROX").otherwise("MARK_PRICE_MISSING")
    price = F.when(by_hour, F.col("mark_60m_open")).otherwise(F.coalesce("sampled_1m_open", "previous_close"))
    return out.select(*events.columns, price.alias("mark_price"), source.alias("mark_source"), (source == "MARK_PRICE_1M_APPROX").alias("mark_approximate"), "hour_aligned", "sampled_exact_1m", "sampled_1m_open", "mark_60m_open", (F.col("mark_60m_open") == F.col("sampled_1m_open")).alias("sample_match"))


def mark_summary(valued: DataFrame, marks_60m: DataFrame | None = None) -> DataFrame:
    """Counters of valued events by symbol; with the hourly marks also their number, as mark_60m_rows."""
    source = lambda s: F.count_if(F.col("mark_source") == s)
    out = valued.groupBy("symbol").agg(
        F.count("*").alias("funding_event_count"), F.count_if("hour_aligned").alias("hour_aligned_count"), F.count_if("sampled_exact_1m").alias("exact_1m_checks"),
        F.count_if(F.col("sample_match")).alias("exact_1m_matches"), F.count_if(~F.col("sample_match")).alias("exact_1m_mismatches"), source("MARK_PRICE_MISSING").alias("missing_mark_count"),
        source("MARK_60M_OPEN").alias("canonical_60m_count"), source("MARK_1M_OPEN").alias("canonical_1m_count"), source("MARK_PRICE_1M_APPROX").alias("approximate_1m_count"),
    )
    if marks_60m is None:
        return out
    hours = marks_60m.groupBy("symbol").agg(F.count("*").alias("mark_60m_rows"))
    return out.join(hours, "symbol", "left").withColumn("mark_60m_rows", F.coalesce("mark_60m_rows", F.lit(0)))


def cadence_gate(events: DataFrame, compared: DataFrame, most_minutes: int = 240, least: int = 2) -> DataFrame:
    """Symbols of a short cadence whose comparison (symbol, complete, all_equal) is whole and equal, and whether there
    are enough of them."""
    good = intervals(events).where(F.col("min_interval_min") <= most_minutes).join(compared.where("complete AND all_equal"), "symbol")
    return good.agg(F.count("*").alias("qualified"), (F.count("*") >= least).alias("passed"))


def delivery_evidence(deliveries: DataFrame, index_bars: DataFrame, lookback_ms: int = LOOKBACK_MS) -> DataFrame:
    """Index bars of the last 120 minutes before each delivery (symbol, delivery_ms > 0), as one row a delivery."""
    aligned = F.col("delivery_ms") - F.pmod("delivery_ms", F.lit(MINUTE))
    last = F.when(aligned >= F.col("delivery_ms"), aligned - MINUTE).otherwise(aligned)
    windows = deliveries.where("delivery_ms > 0").withColumn("last", last).withColumn("first", F.greatest(F.lit(0), F.col("last") - lookback_ms + MINUTE)).where("last >= first")
    slots = windows.withColumn("start_ms", F.explode(F.sequence("first", "last", F.lit(MINUTE).cast("long"))))
    found = slots.join(index_bars, ["symbol", "start_ms"], "left")
    return found.groupBy("symbol", "delivery_ms", F.col("first").alias("index_window_start_ms"), (F.col("last") + MINUTE).alias("index_window_end_ms")).agg(F.count("close").alias("row_count"), F.array_sort(F.collect_list(F.when(F.col("close").isNotNull(), F.struct("start_ms", "open", "high", "low", "close")))).alias("candles"))
