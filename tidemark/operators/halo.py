"""Window frames of bounded length without a window over a whole key.

Rows are dealt to time buckets of their key, and buckets that follow one another to groups of about ``rows_per_group`` rows; every group also gets
the ``n`` rows before it, so a frame that reaches back ``n`` rows at most is whole within its group. A key's rows spread over
as many tasks as it has groups, and a row goes to three of these at most.

What is gathered by key is a row a bucket: its count gives the number of rows before it, and so its group, and which
of the next groups begin within ``n`` rows after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def dealt(rows: DataFrame, keys: list[str], order: str, n: int, width: int, rows_per_group: int = 4096) -> DataFrame:
    """``rows`` by group (_group), once as its own (_own) and again wherever it is one of the ``n`` rows before a group; a group may get some more
    rows from before these. ``order`` is a number and not null; rows with equal ``order`` stay together. Null keys are a key."""
    size = max(rows_per_group, n)
    bucket = F.floor(F.col(order) / width)
    counts = rows.groupBy(*keys, bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    along = Window.partitionBy(*keys).orderBy("_bucket")
    before = F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counts.withColumn("_before", before).withColumn("_group", F.floor(F.col("_before") / size))
    placed = placed.withColumn("_start", F.min("_before").over(Window.partitionBy(*keys, "_group")))
    later = Window.partitionBy(*keys).orderBy(F.desc("_group")).rangeBetween(Window.unboundedPreceding, -1)
    # starts of groups lie ``size`` apart but for the next one, so a bucket's rows are among the n before two groups at most
    placed = placed.withColumn("_next", F.min(F.struct("_group", "_start")).over(later))
    placed = placed.withColumn("_after", F.min("_next").over(later))
    reached = lambda g: F.when(F.col(f"{g}._start") < F.col("_before") + F.col("_n") + n, F.col(f"{g}._group"))
    goals = F.filter(F.array(F.col("_group"), reached("_next"), reached("_after")), lambda g: g.isNotNull())
    table = placed.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_bucket", F.col("_group").alias("_home"), goals.alias("_goals"))
    same = F.col("_row_bucket") == F.col("_bucket")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    whole = rows.withColumn("_row_bucket", bucket).join(table, same).withColumn("_group", F.explode("_goals"))
    return whole.select(*rows.columns, "_group", (F.col("_group") == F.col("_home")).alias("_own"))


def framed(rows: DataFrame, keys: list[str], order: str, n: int, make: Callable[[DataFrame, WindowSpec], DataFrame], width: int, rows_per_group: int = 4096) -> DataFrame:
    """What ``make(rows, window)`` gives, as if the window were over whole keys: it may add columns by frames of ``window`` (of keys, ordered) that together
    reach back ``n`` rows at most, and never forward."""
    parts = dealt(rows, keys, order, n, width, rows_per_group)
    made = make(parts, Window.partitionBy(*keys, "_group").orderBy(order))
    return made.where("_own").drop("_group", "_own")
