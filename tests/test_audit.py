import pytest
from pyspark.sql import functions as F

from tidemark.functions import decimals, timeops
from tidemark.operators import asof, audit, funding, inventory, plan
from tidemark.plans import pipelines


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_classes(spark):
    rows = spark.createDataFrame([(999, None), (3000, None), (5000, None), (3000, 4000)], "at long, first long")
    got = [r[0] for r in rows.select(audit.classify_empty(F.col("at"), F.lit(1000), F.col("first"), F.lit(5000))).collect()]
    assert got == ["BEFORE_LAUNCH", "EMPTY_DURING_LIFETIME", "AFTER_DELIST", "BEFORE_FIRST_TRADE"]
    assert one(spark, audit.lifetime_conflict(F.lit(44000), F.lit(0).cast("long"), F.lit(False)), audit.lifetime_conflict(F.lit(120044), F.lit(0).cast("long"), F.lit(False)))[:] == (False, True)
    d = 86_400_000
    assert one(spark, audit.launch_quality(F.lit(0), F.lit(365 * d)), audit.launch_quality(F.lit(0), F.lit(10 * d)))[:] == ("PLACEHOLDER_SUSPECTED", "OBSERVED_METADATA")


def test_times(spark):
    assert one(spark, timeops.align_down(F.lit(123456), 60000), timeops.align_down(F.lit(86399999), 86400000), timeops.align_down(F.lit(-1), 60000))[:] == (120000, 0, -60000)
    with pytest.raises(Exception, match="unknown interval"):
        one(spark, timeops.interval_ms("7"))
    days = spark.createDataFrame([(d,) for d in ("2026-03-06", "2026-03-20", "2026-04-03", "2026-10-30", "2026-11-06")], "d string").withColumn("d", F.to_date("d"))
    hours = [r[0] for r in days.select((timeops.session_bounds(F.col("d"), "US")[0] - timeops.session_bounds(F.col("d"), "EU")[0]) / 3_600_000).collect()]
    assert hours == [5.5, 4.5, 5.5, 4.5, 5.5]
    w = one(spark, timeops.probe_window(F.lit(1234567)))[0]
    assert w["end_ms"] - w["start_ms"] == 29 * 60000 and w["start_ms"] % 60000 == 0
    start, end = timeops.month_start_ms(F.lit("2024-06")), timeops.month_end_ms(F.lit("2024-06"))
    windows = one(spark, timeops.page_windows(start, end, 60000))[0]
    assert len(windows) == 44 and sum((x["end_ms"] - x["start_ms"]) // 60000 + 1 for x in windows) == 43200
    assert one(spark, plan.seal_status(F.lit(0), 86_400_000 - 1), plan.seal_status(F.lit(0), 86_400_000))[:] == ("OPEN", "SEALED")


def test_decimals(spark):
    v, s = F.lit("100.057").cast("decimal(10,3)"), F.lit("0.01").cast("decimal(4,2)")
    assert [float(x) for x in one(spark, decimals.floor_to_step(v, s), decimals.ceil_to_step(v, s))] == [100.05, 100.06]
    assert int(one(spark, decimals.scaled_int(F.lit("0.1234567890").cast("decimal(38,18)")))[0]) == 1234567890
    with pytest.raises(Exception, match="inexact"):
        one(spark, decimals.scaled_int(F.lit("0.12345678901").cast("decimal(38,18)")))
    assert one(spark, decimals.coverage_pct(F.lit(1), F.lit(3)), decimals.coverage_pct(F.lit(1), F.lit(0)))[:] == ("33.333", "0")
    for bad in ("0.1234567890123456789", "123456789012345678901", "NaN", "x"):
        with pytest.raises(Exception, match="not storable|overflow|NUMERIC"):
            one(spark, decimals.stored(F.lit(bad)))


def test_eligibility_passes_unknown_flags(spark):
    rows = spark.createDataFrame([("", None, "Trading"), ("Innovation", False, "Closed"), ("commodity", None, "Trading"), ("", True, "Trading"), ("", None, "PendingOpen")], "kind string, pre boolean, status string")
    ok = inventory.eligible(F.lit("LinearPerpetual"), F.lit("USDT"), F.lit("USDT"), F.col("status"), F.col("pre"), F.lit(None).cast("string"), F.col("kind"))
    assert [r[0] for r in rows.select(ok).collect()] == [True, True, False, False, False]


def test_plan_and_split(spark):
    d, jan, feb = 86_400_000, 1_704_067_200_000, 1_706_745_600_000
    life = spark.createDataFrame([("A", jan + 60000, 0, True), ("B", jan, feb + 120000 - 5, True), ("C", jan, 0, False), ("D", None, 0, True)], "symbol string, first_trade_ms long, delivery_ms long, eligible boolean")
    tasks = [(r["month"], r["symbol"], r["data_start_ms"], r["data_end_ms"]) for r in plan.partition_plan(life, jan, jan + 60 * d).collect()]
    assert tasks == [("2024-01", "A", jan + 60000, feb), ("2024-01", "B", jan, feb), ("2024-02", "A", feb, jan + 60 * d), ("2024-02", "B", feb, feb + 120000)]
    events = spark.range(200).select(F.lit("A").alias("symbol"), (F.col("id") * 3_600_000).alias("ts_ms"))
    parts = plan.split_saturated(spark.createDataFrame([("A", 0, 200 * 3_600_000)], "symbol string, from_ms long, to_ms long"), events, 200).collect()
    assert len(parts) == 2 and sum(r["n"] for r in parts) == 200


def test_funding_fallbacks(spark):
    h = 3_600_000
    events = spark.createDataFrame([("A", h), ("A", 2 * h), ("A", 3 * h), ("A", 4 * h)], "symbol string, ts_ms long")
    hours = spark.createDataFrame([("A", h, 1.0)], "symbol string, start_ms long, open double")
    minutes = spark.createDataFrame([("A", h, 1.0, 1.0), ("A", 2 * h, 2.0, 2.0), ("A", 3 * h - 60000, 3.0, 3.5)], "symbol string, start_ms long, open double, close double")
    got = [(r["mark_source"], r["mark_price"]) for r in funding.value_events(events, hours, minutes, 1).orderBy("ts_ms").collect()]
    assert got == [("MARK_60M_OPEN", 1.0), ("MARK_1M_OPEN", 2.0), ("MARK_PRICE_1M_APPROX", 3.5), ("MARK_PRICE_MISSING", None)]


def test_asof_across_buckets(spark):
    left = spark.createDataFrame([("A", 5), ("A", 900_000_000), ("B", 1)], "k string, t long")
    right = spark.createDataFrame([("A", 5, "x"), ("A", 6, "y"), ("B", 2, "z")], "k string, at long, v string")
    back = {(r["k"], r["t"]): r["v"] for r in asof.asof(left, right, "k", "t", "at", ["v"]).collect()}
    assert back == {("A", 5): "x", ("A", 900_000_000): "y", ("B", 1): None}
    ahead = {(r["k"], r["t"]): r["v"] for r in asof.asof(left, right, "k", "t", "at", ["v"], "forward").collect()}
    assert ahead == {("A", 5): "x", ("A", 900_000_000): None, ("B", 1): "z"}


def test_run_comparison_codes(spark):
    a = spark.createDataFrame([("A", "2024-01", "h1"), ("B", "2024-01", "h2")], "symbol string, month string, logical_sha256 string")
    assert pipelines.compare(a, a)[1] == pipelines.DONE
    assert pipelines.compare(a, a.withColumn("logical_sha256", F.lit("h1")))[1] == pipelines.DRIFT
