"""Frames by groups of buckets against the plain window over a whole key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import halo


def rows_of(seed, n=500):
    r, out = random.Random(seed), []
    for s in ("A", "B", None):
        t = -50
        for _ in range(n if s else 40):
            t += r.choice([0, 1, 1, 1, 2, 40])
            out.append((s, t, r.random()))
    return [*out, ("C", 7, 1.0)]


@pytest.mark.parametrize("per_group", [1, 7, 64, 10_000])
@pytest.mark.parametrize(("n", "width"), [(1, 1), (5, 3), (20, 50)])
def test_frames_equal_plain_windows(spark, per_group, n, width):
    rows = spark.createDataFrame(rows_of(per_group + n), "symbol string, t long, x double").withColumn("_bucket", F.lit("clash"))

    def make(df, w):
        frame = w.rowsBetween(-n, -1)
        return df.withColumn("before", F.count("x").over(frame)).withColumn("reach", F.min("t").over(frame)).withColumn("last", F.lag("t", n).over(w))

    want = make(rows, Window.partitionBy("symbol").orderBy("t"))
    got = halo.framed(rows.drop("_bucket"), ["symbol"], "t", n, make, width, per_group)
    columns = ("symbol", "t", "x", "before", "reach", "last")
    plain = lambda df: sorted(([repr(r[c]) for c in columns if c not in ("x",)] for r in df.collect()))
    assert plain(got) == plain(want)


@pytest.mark.parametrize(("n", "per_group"), [(1, 1), (20, 7), (20, 64), (3, 1000)])
def test_a_row_goes_to_three_groups_at_most(spark, n, per_group):
    rows = spark.createDataFrame(rows_of(5), "symbol string, t long, x double").withColumn("id", F.monotonically_increasing_id())
    parts = halo.dealt(rows, ["symbol"], "t", n, 3, per_group)
    each = parts.groupBy("id").agg(F.count("*").alias("copies"), F.count_if("_own").alias("own")).collect()
    assert len(each) == rows.count() and all(r["own"] == 1 and r["copies"] <= 3 for r in each)
    sizes = parts.groupBy("symbol", "_group").count().collect()
    assert max(r["count"] for r in sizes) <= 2 * max(n, per_group) + 4 * 12 + n  # a group, a bucket of ties more, and what is before it


def test_empty_rows(spark):
    rows = spark.createDataFrame([], "symbol string, t long")
    assert halo.framed(rows, ["symbol"], "t", 3, lambda d, w: d.withColumn("b", F.lag("t").over(w)), 5).count() == 0


def test_no_window_over_a_whole_symbol(spark):
    from tidemark.operators import indicators

    bars = spark.createDataFrame([("A", i * 60_000, float(i), 1.0) for i in range(50)], "symbol string, start_ms long, close double, volume double")
    plan = indicators.volume_ratio(bars)._jdf.queryExecution().optimizedPlan().toString()
    over_rows = [line for line in plan.splitlines() if "Window [" in line and "volume" in line]
    assert over_rows and all("_group" in line.split("], [")[1] for line in over_rows)
