"""Bars: from a trade tape, rolled up under completeness rules, deduplicated, checked for gaps, reconciled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeops import align_down
from .halo import framed

FIELDS = ("open", "high", "low", "close", "volume", "turnover")


def tape_to_bars(tape: DataFrame, step: int) -> DataFrame:
    """symbol, start_ms and OHLCV from trades (symbol, t, px, qty, seq); intervals without trades have no bar."""
    at = F.struct("t", "seq")
    return tape.groupBy("symbol", align_down(F.col("t"), step).alias("start_ms")).agg(
        F.min_by("px", at).alias("open"), F.max("px").alias("high"), F.min("px").alias("low"), F.max_by("px", at).alias("close"),
        F.sum("qty").alias("volume"), F.sum(F.col("px") * F.col("qty")).alias("turnover"), F.count("*").alias("trades"),
    )


def roll_up(bars: DataFrame, from_step: int, to_step: int) -> DataFrame:
    """Complete buckets only: all ``to_step / from_step`` bars, the first and last at the bucket's ends."""
    bucket = align_down(F.col("start_ms"), to_step)
    made = bars.groupBy("symbol", bucket.alias("start_ms_")).agg(
        F.min_by("open", "start_ms").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "start_ms").alias("close"),
        F.sum("volume").alias("volume"), F.sum("turnover").alias("turnover"), F.count("*").alias("n"), F.min("start_ms").alias("first"), F.max("start_ms").alias("last"),
    )
    whole = (F.col("n") == to_step // from_step) & (F.col("first") == F.col("start_ms_")) & (F.col("last") == F.col("start_ms_") + to_step - from_step)
    return made.where(whole).drop("n", "first", "last").withColumnRenamed("start_ms_", "start_ms").select("symbol", "start_ms", *FIELDS)


def dedupe_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; ``duplicates`` counts the others."""
    least = F.min_by(F.struct(*rows.columns), F.struct(*order))
    return rows.groupBy(*keys).agg(least.alias("row"), (F.count("*") - 1).alias("duplicates")).select("row.*", "duplicates")


def dedupe_or_raise(rows: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row a key; a key whose rows differ in the text of any field raises."""
    texts = F.concat_ws("\t", *(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields))
    one = rows.withColumn("_text", texts).groupBy(*keys).agg(F.min("_text").alias("lo"), F.max("_text").alias("hi"), *(F.first(f).alias(f) for f in fields))
    return one.withColumn("_ok", F.when(F.col("lo") != F.col("hi"), F.raise_error(F.lit("conflicting rows of one key"))).otherwise(F.lit(True))).where("_ok").drop("lo", "hi", "_ok")


def conflicts(rows: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Keys whose rows differ, with their number of different rows."""
    return rows.groupBy(*keys).agg(F.count_distinct(F.struct(*fields)).alias("variants")).where("variants > 1")


def gaps(bars: DataFrame, step: int) -> DataFrame:
    """symbol, expected_ms, actual_ms wherever a bar does not follow the one before."""
    marked = framed(bars.select("symbol", "start_ms"), ["symbol"], "start_ms", 1, lambda b, w: b.withColumn("expected_ms", F.lag("start_ms").over(w) + step), 1000 * step)
    return marked.where("start_ms <> expected_ms").select("symbol", "expected_ms", F.col("start_ms").alias("actual_ms"))


def missing_slots(bars: DataFrame, ranges: DataFrame, step: int) -> DataFrame:
    """Slots of each symbol's range [from_ms, to_ms) without a bar; ranges are exploded on the executors."""
    slots = ranges.where(F.col("to_ms") > F.col("from_ms")).select("symbol", F.explode(F.sequence("from_ms", F.col("to_ms") - 1, F.lit(step).cast("long"))).alias("start_ms"))
    return slots.join(bars.select("symbol", "start_ms"), ["symbol", "start_ms"], "left_anti")


def page_stats(rows: DataFrame, step: int, now_ms: int) -> DataFrame:
    """Per symbol and page: raw rows, repeated starts, unfinished bars, oldest and newest start."""
    finished = F.col("start_ms") + step <= now_ms
    return rows.groupBy("symbol", "page").agg(
        F.count("*").alias("raw_rows"), (F.count_if(finished) - F.count_distinct(F.when(finished, F.col("start_ms")))).alias("duplicates"),
        F.count_if(~finished).alias("unfinished"), F.min("start_ms").alias("oldest_ms"), F.max("start_ms").alias("newest_ms"),
    )


def finished(rows: DataFrame, step: int, now_ms: int) -> DataFrame:
    return rows.where(F.col("start_ms") + step <= now_ms)


def reconcile(local: DataFrame, native: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Full outer comparison by symbol and start: side (both, local, native) and the names of differing fields."""
    a, b = local.alias("a"), native.alias("b")
    keys = ["symbol", "start_ms"]
    joined = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "full_outer")
    both = F.col("a.symbol").isNotNull() & F.col("b.symbol").isNotNull()
    side = F.when(both, "both").when(F.col("a.symbol").isNotNull(), "local").otherwise("native")
    differing = F.filter(F.array(*(F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields)), lambda x: x.isNotNull())
    return joined.select(*(F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys), side.alias("side"), F.when(both, differing).otherwise(F.array().cast("array<string>")).alias("differing"))


def first_mismatches(compared: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` mismatching bars by start: a report."""
    return compared.where("side = 'both' AND size(differing) > 0").orderBy("symbol", "start_ms").limit(n)


def first_missing(missing: DataFrame, n: int = 10_000) -> DataFrame:
    """The first ``n`` missing starts by symbol and start: a report."""
    return missing.select("symbol", "start_ms").orderBy("symbol", "start_ms").limit(n)


def segments(bars: DataFrame, step: int, bucket_bars: int = 1000) -> DataFrame:
    """Contiguous runs: ``segment`` is the start of the run's first bar, ``pos`` the bar's number in it from 1. Bars are dealt by
    symbol and time bucket; a row a bucket tells the next ones where the run that reaches into them began."""
    keys = ["symbol", "_bucket"]
    dealt = bars.withColumn("_bucket", F.floor(F.col("start_ms") / (step * bucket_bars))).repartition(*keys)
    w = Window.partitionBy(*keys).orderBy("start_ms")
    inner = dealt.withColumn("_start", F.when(F.lag("start_ms").over(w) != F.col("start_ms") - step, F.col("start_ms"))).withColumn("_own", F.last("_start", ignorenulls=True).over(w))
    edges = inner.groupBy(*keys).agg(F.min("start_ms").alias("_first"), F.max("start_ms").alias("_last"), F.max("_start").alias("_inside"))
    along = Window.partitionBy("symbol").orderBy("_bucket")
    opens = F.when(F.coalesce(F.lag("_last").over(along) != F.col("_first") - step, F.lit(True)), F.col("_first"))
    edges = edges.withColumn("_opens", opens).withColumn("_carried", F.coalesce("_opens", F.last(F.coalesce("_inside", "_opens"), ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))))
    out = inner.join(edges.select(*keys, "_carried"), keys).withColumn("segment", F.coalesce("_own", "_carried"))
    return out.select(*bars.columns, "segment", (((F.col("start_ms") - F.col("segment")) / step).cast("long") + 1).alias("pos"))
