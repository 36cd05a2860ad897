import pytest
from pyspark.sql import functions as F

from tidemark.functions import hashing
from tidemark.operators import bars
from tidemark.sources import responses, store

BAR = "symbol string, page int, start_ms long, open decimal(38,18), high decimal(38,18), low decimal(38,18), close decimal(38,18), volume decimal(38,18), turnover decimal(38,18)"


def flat(spark, starts, price=lambda i: 1, volume=lambda i: 1, page=0, symbol="A"):
    from decimal import Decimal

    rows = [(symbol, page, s, *[Decimal(price(i))] * 4, Decimal(volume(i)), Decimal(1)) for i, s in enumerate(starts)]
    return spark.createDataFrame(rows, BAR)


def test_dedupe_sorts_and_counts(spark):
    rows = flat(spark, [120000, 60000, 60000, 0])
    out = bars.dedupe_first(rows, ["symbol", "start_ms"], [F.col("page")]).orderBy("start_ms").collect()
    assert [r["start_ms"] for r in out] == [0, 60000, 120000] and sum(r["duplicates"] for r in out) == 1
    assert bars.gaps(rows.dropDuplicates(["start_ms"]), 60000).count() == 0


def test_unfinished_and_gap(spark):
    rows = flat(spark, [120000, 60000])
    assert [r["start_ms"] for r in bars.finished(rows, 60000, 150000).collect()] == [60000]
    stats = bars.page_stats(rows, 60000, 150000).first()
    assert (stats["unfinished"], stats["duplicates"], stats["raw_rows"]) == (1, 0, 2)
    gap = bars.gaps(flat(spark, [120000, 0]), 60000).first()
    assert (gap["expected_ms"], gap["actual_ms"]) == (60000, 120000)


def test_rollup_needs_every_bar(spark):
    rows = flat(spark, [60000 * i for i in range(15)], lambda i: 100 + i, lambda i: 0 if i == 7 else 1)
    bar = bars.roll_up(rows, 60000, 900000).first()
    assert (bar["open"], bar["close"], bar["volume"]) == (100, 114, 14)
    assert bars.roll_up(rows.where("start_ms <> 420000"), 60000, 900000).count() == 0


def test_conflicting_pages_raise(spark):
    a = flat(spark, [0, 60000])
    assert bars.dedupe_or_raise(a.union(a), ["symbol", "start_ms"], ["open", "close"]).count() == 2
    with pytest.raises(Exception, match="conflicting"):
        bars.dedupe_or_raise(a.union(flat(spark, [60000], lambda i: 2)), ["symbol", "start_ms"], ["open", "close"]).collect()


def test_hash_ignores_order_and_keeps_digits(spark):
    rows = flat(spark, [0, 60000], volume=lambda i: "12345678901234567890.123456789012345678")
    a = hashing.logical_hash(rows, ["symbol"]).first()
    b = hashing.logical_hash(rows.orderBy(F.desc("start_ms")).repartition(3), ["symbol"]).first()
    assert a == b and a["row_count"] == 2


def test_segments_reset_at_gaps(spark):
    seg = {r["start_ms"]: (r["segment"], r["pos"]) for r in bars.segments(flat(spark, [0, 60000, 180000, 240000]), 60000).collect()}
    assert seg == {0: (0, 1), 60000: (0, 2), 180000: (180000, 1), 240000: (180000, 2)}


BODY = '{{"retCode": {}, "retMsg": "OK", "time": 5, "result": {{"symbol": "A", "category": "linear", "list": [["60000","1","2","0.5","1.5","10","15"],["0","1","2","0.5","0.1","10","15"]]}}}}'


def test_response_bodies(spark):
    good = spark.createDataFrame([(BODY.format(0),)], "body string")
    rows = responses.bars(good).orderBy("start_ms").collect()
    assert [r["start_ms"] for r in rows] == [0, 60000] and str(rows[0]["close"]) == "0.100000000000000000"
    with pytest.raises(Exception, match="refused"):
        responses.bars(spark.createDataFrame([(BODY.format(10006),)], "body string")).collect()
    f = '{"retCode":0,"retMsg":"OK","time":1,"result":{"category":"linear","list":[{"symbol":"A","fundingRate":"0.0001","fundingRateTimestamp":"3600000"}]}}'
    event = responses.funding(spark.createDataFrame([(f,)], "body string")).first()
    assert (event["ts_ms"], event["rate_text"]) == (3600000, "0.0001")


def test_payload_hash_ignores_time_and_key_order(spark):
    bodies = ['{"time":1,"retCode":0,"retMsg":"OK","result":{"b":1,"a":"é"}}', '{"retMsg":"OK","result":{"a":"é","b":1},"retCode":0,"time":9}', '{"retMsg":"OK","result":{"a":"é","b":2},"retCode":0}']
    got = [r[0] for r in spark.createDataFrame([(b,) for b in bodies], "body string").select(hashing.payload_hash("body")).collect()]
    assert got[0] == got[1] != got[2]


def test_store_first_write_wins(spark, tmp_path):
    path = str(tmp_path / "raw")
    page = lambda raw: spark.createDataFrame([("A", "1970-01", "bars:1", "k", 0, 120000, bytearray(raw.encode()))], "symbol string, month string, stream string, request_key string, range_start_ms long, range_end_ms long, raw binary")
    store.put(page(BODY.format(0)), path)
    store.put(page("other"), path, spark.read.parquet(path))
    kept = store.stored(spark, path)
    assert kept.count() == 1
    whole = store.rebuild_bars(kept, 0, 60000)
    assert [r["start_ms"] for r in whole.collect()] == [0]
    hashes = store.write_bars(whole.withColumn("month", F.lit("1970-01")), str(tmp_path / "bars"))
    assert hashes.first()["row_count"] == 1 and spark.read.parquet(str(tmp_path / "bars")).count() == 1


def test_reconcile_names_fields(spark):
    a, b = flat(spark, [0, 60000]), flat(spark, [0, 120000], lambda i: 2)
    out = {r["start_ms"]: (r["side"], r["differing"]) for r in bars.reconcile(a, b).collect()}
    assert out == {0: ("both", ["open", "high", "low", "close"]), 60000: ("local", []), 120000: ("native", [])}
