"""As-of and interval joins without a nested loop."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, values: list[str], direction: str = "backward", suffix_days: int = 1) -> DataFrame:
    """``left`` with the ``values`` of the latest right row not after it (backward) or the earliest not before it
    (forward), by key ``on``. Both sides are sorted together and the last value is carried, in one shuffle by
    key and time range: rows are dealt by key and bucket of ``suffix_days`` days, and each bucket is given the
    value its predecessor ends with, so that a frequent key spreads over as many tasks as it has buckets. What a
    bucket ends with is read from the same shuffle, and is a row a bucket."""
    width = suffix_days * 86_400_000
    a = left.select(F.struct(*left.columns).alias("row"), F.col(on).alias("k"), F.col(left_time).alias("t"), F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("v"))
    b = right.select(F.lit(None).cast(a.schema["row"].dataType).alias("row"), F.col(on).alias("k"), F.col(right_time).alias("t"), F.struct(*values).alias("v"))
    both = a.unionByName(b).withColumn("bucket", F.floor(F.col("t") / width)).repartition("k", "bucket")
    back = direction == "backward"
    pick = F.max_by if back else F.min_by
    edge = both.groupBy("k", "bucket").agg(pick("v", F.when(F.col("v").isNotNull(), F.col("t"))).alias("edge"))
    frame = Window.partitionBy("k").orderBy(F.col("bucket").asc() if back else F.col("bucket").desc())
    known = edge.withColumn("carried", F.last("edge", ignorenulls=True).over(frame.rowsBetween(Window.unboundedPreceding, -1))).drop("edge")
    order = [F.col("t").asc() if back else F.col("t").desc(), F.col("row").isNotNull()]
    inside = F.last("v", ignorenulls=True).over(Window.partitionBy("k", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("found", inside).where("row IS NOT NULL").join(known, ["k", "bucket"], "left").withColumn("found", F.coalesce("found", "carried"))
    return out.select("row.*", *(F.col("found")[v].alias(v) for v in values))


def outside_intervals(rows: DataFrame, at: str, intervals: DataFrame, width_ms: int) -> DataFrame:
    """Rows whose time lies in none of the half-open intervals (from_ms, to_ms), each at most ``width_ms`` long. Intervals
    are dealt to the time buckets they touch, so the join is by equality."""
    bucket = F.floor(F.col(at) / width_ms)
    dealt = intervals.withColumn("_b", F.explode(F.sequence(F.floor(F.col("from_ms") / width_ms), F.floor((F.col("to_ms") - 1) / width_ms))))
    keyed = rows.withColumn("_b", bucket)
    inside = (keyed["_b"] == dealt["_b"]) & (F.col(at) >= F.col("from_ms")) & (F.col(at) < F.col("to_ms"))
    return keyed.join(dealt, inside, "left_anti").drop("_b")


def known_at(decisions: DataFrame, records: DataFrame) -> DataFrame:
    """Decisions (symbol, t) with the latest delisting record (known_at_ms, effective_ms) known by then."""
    return asof(decisions, records, "symbol", "t", "known_at_ms", ["known_at_ms", "effective_ms"])
