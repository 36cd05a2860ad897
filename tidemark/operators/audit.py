"""Coverage audit: probe windows, classifications, launch quality, lifetimes, run summaries, comparison of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.decimals import coverage_pct
from ..functions.timeops import DAY, MINUTE, align_down, probe_window
from .asof import asof

#: A launch this long before the first trade is taken for a placeholder.
PLACEHOLDER_MS = 365 * DAY
#: Classes of a probe, launch qualities.
CLASSES = ("DATA_PRESENT", "PARTIAL_DATA", "BEFORE_LAUNCH", "BEFORE_FIRST_TRADE", "AFTER_DELIST", "EMPTY_DURING_LIFETIME", "LIFETIME_METADATA_CONFLICT", "FIRST_TRADE_NOT_FOUND", "NOT_APPLICABLE", "API_ERROR", "INTERNAL_ERROR")
QUALITIES = ("UNKNOWN", "PLACEHOLDER_SUSPECTED", "OBSERVED_METADATA")


def classify_empty(at: Column, launch: Column, first_trade: Column, delivery: Column) -> Column:
    return (
        F.when(at < launch, "BEFORE_LAUNCH").when(first_trade.isNotNull() & (at < first_trade), "BEFORE_FIRST_TRADE")
        .when((F.coalesce(delivery, F.lit(0)) > 0) & (at >= delivery), "AFTER_DELIST").otherwise("EMPTY_DURING_LIFETIME")
    )


def launch_quality(launch: Column, first_trade: Column) -> Column:
    return F.when(first_trade.isNull(), "UNKNOWN").when(first_trade - launch >= PLACEHOLDER_MS, "PLACEHOLDER_SUSPECTED").otherwise("OBSERVED_METADATA")


def lifetime_conflict(launch: Column, first_trade: Column, history_before: Column) -> Column:
    early = first_trade.isNotNull() & (first_trade < align_down(F.greatest(F.lit(0), launch), MINUTE))
    return early | F.coalesce(history_before, F.lit(False))


def funding_applicable(contract: Column) -> Column:
    return F.when(contract == "LinearPerpetual", "APPLICABLE").otherwise("NOT_APPLICABLE")


def coverage(probes: DataFrame, bars: DataFrame, step: int) -> DataFrame:
    """One row a probe (symbol, checkpoint, checkpoint_ms, start_ms, end_ms inclusive, launch_ms, first_trade_ms,
    delivery_ms): counts, percent, edges, gaps and class. Slots are exploded and joined by equality, not by range."""
    keys = ["symbol", "checkpoint", "checkpoint_ms", "window_start_ms", "window_end_ms", "launch_ms", "first_trade_ms", "delivery_ms"]
    named = probes.withColumnsRenamed({"start_ms": "window_start_ms", "end_ms": "window_end_ms"})
    slots = named.withColumn("slot", F.explode(F.sequence("window_start_ms", "window_end_ms", F.lit(step).cast("long"))))
    seen = bars.select("symbol", F.col("start_ms").alias("slot"), F.lit(True).alias("seen")).distinct()
    joined = slots.join(seen, ["symbol", "slot"], "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
    w = Window.partitionBy("symbol", "checkpoint", "window_start_ms").orderBy("slot")
    before = F.max(F.when(F.col("seen"), F.col("slot"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    joined = joined.withColumn("gap", F.col("seen") & before.isNotNull() & (before != F.col("slot") - step))
    out = joined.groupBy(*keys).agg(
        F.count("*").alias("expected_count"), F.count_if("seen").alias("candle_count"), F.count_if("gap").alias("gap_count"),
        F.bool_or((F.col("slot") == F.col("window_start_ms")) & ~F.col("seen")).alias("missing_at_start"), F.bool_or((F.col("slot") == F.col("window_end_ms")) & ~F.col("seen")).alias("missing_at_end"),
    ).withColumn("missing_expected_count", F.col("expected_count") - F.col("candle_count"))
    kind = F.when(F.col("candle_count") == 0, classify_empty(F.col("checkpoint_ms"), F.col("launch_ms"), F.col("first_trade_ms"), F.col("delivery_ms")))
    kind = kind.when((F.col("missing_expected_count") == 0) & (F.col("gap_count") == 0), "DATA_PRESENT").otherwise("PARTIAL_DATA")
    return out.withColumn("classification", kind).withColumn("coverage_pct", coverage_pct(F.col("candle_count"), F.col("expected_count"))).drop("launch_ms", "first_trade_ms", "delivery_ms")


def first_trades(bars: DataFrame) -> DataFrame:
    """First traded minute of each symbol; over stored data a minimum replaces a search by requests."""
    return bars.groupBy("symbol").agg(F.min("start_ms").alias("first_trade_ms"))


def prelaunch_history(daily: DataFrame, instruments: DataFrame, most_days: int = 1000) -> DataFrame:
    """Instruments with bars on full days before their launch day, at most ``most_days`` back. An instrument needs only the last bar
    before its launch day, which an as-of join finds without a range condition."""
    day = align_down(F.col("launch_ms"), DAY)
    bars = daily.select("symbol", F.col("start_ms").alias("_last")).distinct()
    found = asof(instruments.withColumn("_until", day - 1), bars, "symbol", "_until", "_last", ["_last"], suffix_days=366)
    return found.where(F.col("_last") >= day - most_days * DAY).select(*instruments.columns)


def _upper_median(rows: DataFrame, value: str, width: int = 1 << 20) -> DataFrame:
    """One row m: the value at place n // 2 in order. Values are counted first; sums of cells of ``width`` values show in which cell
    the place lies, and only that cell is sorted."""
    each = rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n"))
    cell = F.floor(F.col("v") / width)
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = each.groupBy(cell.alias("cell")).agg(F.sum("n").alias("n"))
    half = F.floor(F.sum("n").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) / 2)
    place = cells.withColumn("below", before(Window.orderBy("cell"))).withColumn("half", half).where("below <= half AND half < below + n").select("cell", "below", "half")
    inner = each.join(F.broadcast(place), cell == F.col("cell")).withColumn("below", F.col("below") + before(Window.orderBy("v")))  # one row is broadcast
    return inner.where("below <= half AND half < below + n").select(F.col("v").alias("m"))


def delay_summary(rows: DataFrame, delay: str = "delay_ms") -> DataFrame:
    """Smallest, largest, number and upper median of launch delays, with and without placeholders."""
    kept = F.when(F.col(delay) < PLACEHOLDER_MS, F.col(delay))
    name = lambda p, c: [F.min(c).alias(f"min_{p}"), F.max(c).alias(f"max_{p}"), F.count(c).alias(f"n_{p}")]
    out = rows.agg(*name("all", F.col(delay)), *name("observed", kept))
    for p, part in (("all", rows), ("observed", rows.where(F.col(delay) < PLACEHOLDER_MS))):
        out = out.join(_upper_median(part, delay).withColumnRenamed("m", f"median_{p}"), F.lit(True), "left")  # one row each
    return out


def funding_probes(instruments: DataFrame, events: DataFrame, now_ms: int, days: int = 4) -> DataFrame:
    """Funding events within ``days`` of the middle of each instrument's life (symbol, contract_type, launch_ms, first_trade_ms,
    delivery_ms): symbol, checkpoint_ms, event_count, classification. Both ends count."""
    origin, delivery = F.coalesce("first_trade_ms", "launch_ms"), F.coalesce("delivery_ms", F.lit(0))
    end = F.when(delivery > origin, delivery).otherwise(F.lit(now_ms))
    point = align_down(origin + F.floor(F.greatest(F.lit(0), end - origin) / 2).cast("long"), MINUTE)
    known = instruments.select("symbol", "contract_type", "launch_ms", "first_trade_ms", "delivery_ms", point.alias("checkpoint_ms"), origin.alias("_o"), end.alias("_e"))
    known = known.withColumn("_from", F.greatest("_o", F.col("checkpoint_ms") - days * DAY)).withColumn("_to", F.least(F.col("_e") - 1, F.col("checkpoint_ms") + days * DAY))
    dealt = known.where("_to >= _from").withColumn("_day", F.explode(F.sequence(F.floor(F.col("_from") / DAY), F.floor(F.col("_to") / DAY)))).select("symbol", "_from", "_to", "_day")
    seen = events.select("symbol", "ts_ms", F.floor(F.col("ts_ms") / DAY).alias("_day")).join(dealt, ["symbol", "_day"]).where("ts_ms BETWEEN _from AND _to").groupBy("symbol").agg(F.count("*").alias("n"))
    plain = funding_applicable(F.col("contract_type")) == "APPLICABLE"
    n = F.when(plain, F.coalesce("n", F.lit(0))).otherwise(F.lit(0))
    kind = F.when(~plain, "NOT_APPLICABLE").when(n > 0, "DATA_PRESENT").otherwise(classify_empty(F.col("checkpoint_ms"), F.col("launch_ms"), F.col("first_trade_ms"), F.col("delivery_ms")))
    return known.join(seen, "symbol", "left").select("symbol", "checkpoint_ms", n.alias("event_count"), kind.alias("classification"))


def missing_first_trades(instruments: DataFrame) -> DataFrame:
    """A probe row for each instrument (symbol, launch_ms, first_trade_ms) whose first trade is not known: it expects nothing."""
    point = align_down(F.col("launch_ms"), MINUTE)
    window = probe_window(point)
    nothing = F.lit(0).cast("long")
    return instruments.where("first_trade_ms IS NULL").select(
        "symbol", F.lit("first_trade_discovery").alias("checkpoint"), point.alias("checkpoint_ms"), window["start_ms"].alias("window_start_ms"), window["end_ms"].alias("window_end_ms"),
        *(nothing.alias(c) for c in ("expected_count", "candle_count", "gap_count")), F.lit(False).alias("missing_at_start"), F.lit(False).alias("missing_at_end"), nothing.alias("missing_expected_count"),
        F.lit("FIRST_TRADE_NOT_FOUND").alias("classification"), F.lit("0.000").alias("coverage_pct"),
    )


def failed_probes(probes: DataFrame, faults: DataFrame, step: int = MINUTE) -> DataFrame:
    """A row for each probe (symbol, checkpoint, checkpoint_ms, start_ms, end_ms) whose reading failed (symbol, checkpoint, error): all that
    was expected is missing, and the error is kept. Faults may have a ``kind``: INTERNAL_ERROR for what nobody foresaw, else API_ERROR. A probe that failed
    more than once has one row, with the last error in order."""
    kind = F.when(F.col("kind") == "INTERNAL_ERROR", F.col("kind")).otherwise("API_ERROR") if "kind" in faults.columns else F.lit("API_ERROR")
    faults = faults.groupBy("symbol", "checkpoint").agg(F.max(F.struct("error", kind.alias("kind"))).alias("f")).select("symbol", "checkpoint", "f.*")
    expected = (F.floor((F.col("end_ms") - F.col("start_ms")) / step) + 1).cast("long")
    return probes.join(faults, ["symbol", "checkpoint"]).select(
        "symbol", "checkpoint", "checkpoint_ms", F.col("start_ms").alias("window_start_ms"), F.col("end_ms").alias("window_end_ms"), expected.alias("expected_count"), F.lit(0).cast("long").alias("candle_count"),
        F.lit(0).cast("long").alias("gap_count"), F.lit(True).alias("missing_at_start"), F.lit(True).alias("missing_at_end"), expected.alias("missing_expected_count"), F.col("kind").alias("classification"), F.lit("0.000").alias("coverage_pct"), "error",
    )


def lifetime_report(instruments: DataFrame, history: DataFrame) -> DataFrame:
    """symbol, launch quality, delay to the first trade and whether metadata conflict with what was traded, for instruments (symbol,
    launch_ms, first_trade_ms) and the symbols with bars before their launch day (``history``)."""
    early = history.select("symbol", F.lit(True).alias("_early")).distinct()
    known = instruments.join(early, "symbol", "left")
    return known.select(
        "symbol", launch_quality(F.col("launch_ms"), F.col("first_trade_ms")).alias("launch_time_quality"), (F.col("first_trade_ms") - F.col("launch_ms")).alias("launch_to_first_trade_ms"),
        lifetime_conflict(F.col("launch_ms"), F.col("first_trade_ms"), F.col("_early")).alias("lifetime_metadata_conflict"),
    )


def run_rollup(partitions: DataFrame) -> DataFrame:
    """Totals of a run's partitions and whether none has missing minutes."""
    return partitions.agg(F.count("*").alias("partitions"), F.sum("actual").alias("actual"), F.sum("missing").alias("missing"), F.count_if(F.col("status") == "SEALED").alias("sealed"), F.bool_and(F.col("missing") == 0).alias("all_complete"), F.max("start_ms").alias("overlap_start_ms"), F.min("end_ms").alias("overlap_end_ms"))


def compare_runs(a: DataFrame, b: DataFrame, hashes: list[str], keys: list[str]) -> DataFrame:
    """Per partition whether each hash agrees; a partition of one run only agrees in none."""
    joined = a.alias("a").join(b.alias("b"), [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "full_outer")
    flags = [F.coalesce(F.col(f"a.{h}") == F.col(f"b.{h}"), F.lit(False)).alias(f"{h}_equal") for h in hashes]
    return joined.select(*(F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys), *flags)


def same_partitions(a: DataFrame, b: DataFrame, keys: list[str]) -> None:
    """Runs are only comparable if they have the same partitions; others raise, with their number."""
    odd = a.select(*keys).distinct().unionByName(b.select(*keys).distinct()).groupBy(*keys).count().where("count = 1").count()
    if odd:
        raise ValueError(f"the runs differ in {odd} partitions")


def compared(flags: DataFrame) -> DataFrame:
    names = [c for c in flags.columns if c.endswith("_equal")]
    return flags.agg(F.count("*").alias("partitions"), *(F.coalesce(F.bool_and(n), F.lit(True)).alias(f"all_{n}") for n in names))
