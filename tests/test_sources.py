"""Readers and rules that refuse unsound input."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import timeops
from tidemark.plans import pipelines
from tidemark.sources import fetch, responses, store
from tidemark.streaming import decisions


def test_zoneless_times_are_refused(spark):
    rows = spark.range(1).select(F.current_timestamp().alias("t"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("n"))
    assert timeops.zoned(rows, "t") is rows
    with pytest.raises(ValueError, match="no zone"):
        timeops.zoned(rows, "t", "n")


def test_unsound_files_raise(spark, tmp_path):
    (tmp_path / "c.csv").write_text("family,event_ms,source\nCPI,5,agency\nGDP,6,agency\n")
    with pytest.raises(Exception, match="unsound calendar"):
        responses.calendar(spark, str(tmp_path / "c.csv")).collect()
    (tmp_path / "d.json").write_text(json.dumps({"symbol": "A", "known_at_ms": 5, "delivery_ms": 4, "source": "s"}) + "\n")
    with pytest.raises(Exception, match="unsound delisting"):
        responses.delistings(spark, str(tmp_path / "d.json")).collect()
    edge = {"left_symbol": "A", "right_symbol": "B", "relation": "renamed", "source_urls": ["u"], "automatic_stitching": True}
    (tmp_path / "i.json").write_text(json.dumps({"version": "1", "relationships": [edge]}))
    with pytest.raises(Exception, match="unsound identity"):
        responses.identity_edges(spark, str(tmp_path / "i.json")).collect()


def test_corrupt_entries_raise(spark, tmp_path):
    rows = spark.createDataFrame([("k", bytearray(b"x"), "0", 1)], "key string, raw binary, sha256 string, bytes int")
    rows.write.parquet(str(tmp_path / "cache"))
    with pytest.raises(Exception, match="corrupt cache"):
        store.cached(spark, str(tmp_path / "cache"), rows).collect()
    page = spark.createDataFrame([("A", "2024-01", "s", "k", 0, 1, bytearray(b"x"), "0")], "symbol string, month string, stream string, request_key string, range_start_ms long, range_end_ms long, raw binary, raw_sha256 string")
    page.write.parquet(str(tmp_path / "raw"))
    with pytest.raises(Exception, match="corrupt page"):
        store.stored(spark, str(tmp_path / "raw")).collect()


def test_series_goes_on_by_raw_rows_and_must_move(spark):
    step, now = 60000, 60000 * 100
    kind = "symbol string, asked_end_ms long, start_ms long, close double"
    first = [("A", 540000, 60000 * i, 1.0) for i in range(6, 10)]
    second = [("A", 300000, 60000 * i, 1.0) for i in range(3, 6)]
    stray = [("A", 100000, 0, 1.0)]  # no page leads to it: the second one ends at 180000
    bars, stats = responses.bar_series(spark.createDataFrame(first + second + stray, kind), 0, 540000, step, now)
    assert sorted(r["start_ms"] for r in bars.collect()) == [60000 * i for i in range(3, 10)]
    assert stats.first()["raw_rows"] == 7
    empty = [("A", 300000, None, None), ("A", 120000, 60000, 1.0)]  # an empty page ends the scan
    bars, stats = responses.bar_series(spark.createDataFrame(first + empty, kind), 0, 540000, step, now)
    assert stats.first()["raw_rows"] == 4
    unfinished, stats = responses.bar_series(spark.createDataFrame(first, kind), 0, 540000, step, 540000)
    assert unfinished.count() == 3 and stats.first()["unfinished"] == 1
    with pytest.raises(Exception, match="move backward"):
        responses.bar_series(spark.createDataFrame([("A", 540000, 660000, 1.0)], kind), 0, 540000, step, now)[1].collect()


def test_cursors(spark):
    pages = spark.createDataFrame([(None, "a"), ("a", "b"), ("b", ""), ("z", "")], "cursor string, next_cursor string")
    assert [(r["cursor"], r["page"]) for r in responses.pages_in_order(pages).orderBy("page").collect()] == [(None, 0), ("a", 1), ("b", 2)]
    with pytest.raises(Exception, match="cursor repeats"):
        responses.pages_in_order(spark.createDataFrame([(None, "a"), ("a", "a")], "cursor string, next_cursor string")).collect()


def test_long_listings(spark):
    """Beyond ``most`` pages the order comes from joins: a listing, one apart from it, a ring, and a page asked with a cursor of nobody."""
    own = [(None if i == 0 else f"c{i}", f"c{i + 1}" if i < 36 else "") for i in range(37)]
    pages = spark.createDataFrame([*own, ("x", "y"), ("y", ""), ("r", "s"), ("s", "r"), ("z", None)], "cursor string, next_cursor string")
    for most in (1000, 5):
        assert [(r["cursor"], r["page"]) for r in responses.pages_in_order(pages, most).orderBy("page").collect()] == [(c, i) for i, (c, _) in enumerate(own)]
    item = lambda k: {"symbol": f"S{k}", "launchTime": "1", "deliveryTime": "", "other": k}
    body = lambda k: json.dumps({"retCode": 0, "retMsg": "", "result": {"list": [item(k)], "nextPageCursor": f"c{k + 1}" if k < 1100 else ""}})
    found = responses.instruments(spark.createDataFrame([(None if k == 0 else f"c{k}", body(k)) for k in range(1101)], "cursor string, body string"))
    assert {(r["symbol"], json.loads(r["raw"])["other"]) for r in found.collect()} == {(f"S{k}", k) for k in range(1101)}


def test_inventory_hash_in_batches(spark):
    rows = spark.createDataFrame([(f"S{k:02}", "Trading", True, json.dumps({"b": k, "a": "é"})) for k in range(30)], "symbol string, status string, eligible boolean, raw string").repartition(7)
    flagged = [{"a": "é", "audit_sample_candidate": True, "b": k, "current_crypto_perpetual_eligible": True} for k in range(30)]
    want = lambda x: hashlib.sha256(json.dumps(x, separators=(",", ":")).encode()).hexdigest()
    hashed = pipelines.inventory_hash(rows)
    assert tuple(hashed.first()) == (want(flagged), 30) and tuple(pipelines.inventory_hash(rows.limit(0)).first()) == (want([]), 0)
    assert "collect_list" not in hashed._jdf.queryExecution().executedPlan().toString()


def test_coverage_reports_conflicts_and_faults(spark):
    day = 86_400_000
    known = spark.createDataFrame([("A", 10 * day + 5, 0), ("B", 10 * day, 0), ("C", 10 * day, 0)], "symbol string, launch_ms long, delivery_ms long")
    bars = spark.createDataFrame([(s, 11 * day + 60000 * i) for s in "AB" for i in range(40)], "symbol string, start_ms long")
    daily = spark.createDataFrame([("A", 8 * day), ("B", 10 * day), ("B", -1000 * day)], "symbol string, start_ms long")
    faults = spark.createDataFrame([("B", "mid_life", "timeout")], "symbol string, checkpoint string, error string")
    out = {(r["symbol"], r["checkpoint"]): r for r in pipelines.sample_coverage(known, bars, 20 * day, daily, faults).collect()}
    assert out["A", "near_first_trade"]["classification"] == "LIFETIME_METADATA_CONFLICT"
    assert out["B", "near_first_trade"]["classification"] != "LIFETIME_METADATA_CONFLICT"
    assert (out["B", "mid_life"]["classification"], out["B", "mid_life"]["error"], out["B", "mid_life"]["missing_expected_count"]) == ("API_ERROR", "timeout", 30)
    assert out["C", "first_trade_discovery"]["classification"] == "FIRST_TRADE_NOT_FOUND"
    assert len(out) == 10


def test_late_bars_are_telemetry(spark, tmp_path):
    minute = 60_000
    native = spark.createDataFrame([("A", 0, 1.5, 900_000), ("A", 900_000, 2.5, 1_800_000), ("A", 9_000_000, 0.0, 9_900_000)], "symbol string, window_ms long, close double, at long").withColumn("native_time", F.timestamp_millis("at")).drop("at")
    decided = spark.createDataFrame([("A", 0, 1.4, 900_000 + minute), ("A", 9_000_000, 0.0, 9_900_000)], "symbol string, window_ms long, close double, at long").withColumn("decided_time", F.timestamp_millis("at")).drop("at")
    native.write.parquet(str(tmp_path / "n"))
    decided.write.parquet(str(tmp_path / "d"))
    read = lambda rows, name: spark.readStream.schema(rows.schema).parquet(str(tmp_path / name))
    decisions.drain(decisions.late_telemetry(read(native, "n"), read(decided, "d")), str(tmp_path / "o"), str(tmp_path / "s"))
    got = {r["window_ms"]: (r["native_close"], r["decided_close"]) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got[0] == (1.5, 1.4) and got[900_000] == (2.5, None)


def test_errors_have_their_type(spark):
    body = lambda code, cells: json.dumps({"retCode": code, "retMsg": "m", "result": {"symbol": "A", "list": [cells]}})
    cases = [(body(10006, ["1"] * 7), fetch.RefusedError), (body(0, ["1"] * 3), fetch.UnsoundPayloadError), ("{", fetch.UnsoundPayloadError)]
    for text, kind in cases:
        with pytest.raises(kind), fetch.typed():
            responses.bars(spark.createDataFrame([(text,)], "body string")).collect()
    with pytest.raises(ZeroDivisionError), fetch.typed():
        1 / 0  # noqa: B018
