"""Exact quantiles against numpy, at all depths; rank errors of merged sketches; buckets that fall back."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles, validation

SHARES = (0.0, 0.25, 0.5, 0.95, 0.99, 1.0)


def draw(n=800):
    r = random.Random(3)
    return [(r.choice(["x", "y", None]), r.randint(0, 2), r.choice([None, 1.0, 1.0, r.gauss(0, 9), float(r.randint(0, 50))])) for _ in range(n)] + [("one", 9, 4.5), ("none", 9, None)]


@pytest.mark.parametrize("steps", [1, 512])
def test_exact_quantiles_at_all_depths(spark, steps):
    rows = draw() + [("wide", 1, v) for v in (1e300, -1e300, 5e-324, -5e-324, 0.0, -0.0, 3.0)]
    table = spark.createDataFrame(rows, "a string, b int, v double")
    got = {(r["depth"], r["a"], r["b"]): (r["n"], r["q"]) for r in quantiles.exact(table, ["a", "b"], "v", SHARES, (2, 1, 0), steps).collect()}
    want = {}
    for d in (2, 1, 0):
        for a, b, v in rows:
            if v is not None:
                want.setdefault((d, a if d > 0 else None, b if d > 1 else None), []).append(v)
    assert got.keys() == want.keys()
    for k, (n, q) in got.items():
        assert n == len(want[k]) and np.allclose(q, np.quantile(want[k], SHARES))
    assert quantiles.exact(table.limit(0), ["a"], "v", SHARES).count() == 0


def test_merged_sketches_keep_ranks(spark):
    r = np.random.default_rng(1)
    values = np.concatenate([r.normal(0, 1, 30_000), r.exponential(50, 20_000)])
    table = spark.createDataFrame([(int(i % 7), float(v)) for i, v in enumerate(values)], "part int, v double")
    parts = quantiles.sketch(table, ["part"], "v")
    row = quantiles.merge(parts, []).select("n", quantiles.estimated(SHARES[1:-1]).alias("q")).first()
    ordered = np.sort(values)
    errors = [abs(np.searchsorted(ordered, x) / len(values) - p) for x, p in zip(row["q"], SHARES[1:-1], strict=True)]
    assert row["n"] == len(values) and max(errors) < 0.01


def test_buckets_fall_back(spark):
    rows = [("x", 1, float(i)) for i in range(40)] + [("x", 2, 1000.0)] * 3 + [("y", 1, 7.0)]
    got = {(r["a"], r["b"]): (r["depth"], r["p75"], r["p99"]) for r in validation.slippage_quantiles(spark.createDataFrame(rows, "a string, b int, bps double"), ["a", "b"], least=30).collect()}
    x, every = [v for a, _, v in rows if a == "x"], [v for *_, v in rows]
    assert got == {("x", 1): (2, 29.25, round(float(np.quantile(range(40), 0.99)), 6)), ("x", 2): (1, float(np.quantile(x, 0.75)), float(np.quantile(x, 0.99))), ("y", 1): (0, float(np.quantile(every, 0.75)), float(np.quantile(every, 0.99)))}


def test_one_pass_and_no_percentile(spark):
    table = spark.createDataFrame(draw(50), "a string, b int, bps double").withColumn("bps", F.col("bps") + 1)
    plan = validation.slippage_quantiles(table, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan.lower() and "Expand" in plan
