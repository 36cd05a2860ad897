import json

import pytest

from tidemark import cli
from tidemark.plans import pipelines


def listing(path, status, *symbols):
    item = lambda s: {"symbol": s, "contractType": "LinearPerpetual", "status": status, "baseCoin": s[:3], "quoteCoin": "USDT", "settleCoin": "USDT", "launchTime": "0", "deliveryTime": "" if status == "Trading" else "600000", "priceFilter": {"tickSize": "0.1"}, "lotSizeFilter": {"qtyStep": "1"}, "symbolType": "", "marketRegion": "", "extra": 1}
    path.write_text(json.dumps({"retCode": 0, "retMsg": "OK", "time": 1, "result": {"category": "linear", "list": [item(s) for s in symbols], "nextPageCursor": ""}}))
    return str(path)


def test_inventory_coverage_and_compare(spark, tmp_path):
    a, b = listing(tmp_path / "t.json", "Trading", "AAAUSDT"), listing(tmp_path / "c.json", "Closed", "OLDUSDT")
    assert cli.main(["inventory", "--trading", a, "--closed", b, "--out", str(tmp_path / "inv")]) == pipelines.DONE
    rows = {r["symbol"]: r for r in spark.read.parquet(str(tmp_path / "inv/instruments")).collect()}
    assert rows["AAAUSDT"]["eligible"] and json.loads(rows["OLDUSDT"]["raw"])["extra"] == 1 and rows["OLDUSDT"]["delivery_ms"] == 600000
    bars = spark.createDataFrame([("AAAUSDT", 60000 * i) for i in range(200)], "symbol string, start_ms long")
    bars.write.parquet(str(tmp_path / "bars"))
    assert cli.main(["sample-coverage", "--trading", a, "--closed", b, "--bars", str(tmp_path / "bars"), "--now-ms", str(60000 * 200), "--out", str(tmp_path / "cov")]) == pipelines.DONE
    report = spark.read.option("header", True).csv(str(tmp_path / "cov")).collect()
    assert len(report) == 7 and {r["classification"] for r in report if r["symbol"] == "AAAUSDT"} == {"DATA_PRESENT"}
    runs = spark.createDataFrame([("A", "2024-01", "x")], "symbol string, month string, logical_sha256 string")
    runs.write.parquet(str(tmp_path / "r1"))
    runs.replace("x", "y").write.parquet(str(tmp_path / "r2"))
    assert cli.main(["compare", "--a", str(tmp_path / "r1"), "--b", str(tmp_path / "r2"), "--out", str(tmp_path / "cmp")]) == pipelines.DRIFT


def test_inventory_conflict_and_guards(spark, tmp_path):
    a, b = listing(tmp_path / "t.json", "Trading", "AAAUSDT"), listing(tmp_path / "c.json", "Closed", "AAAUSDT")
    with pytest.raises(Exception, match="several inventories"):
        cli.main(["inventory", "--trading", a, "--closed", b, "--out", str(tmp_path / "inv")])
    with pytest.raises(ValueError):
        pipelines.guard_development(2, 1)
    assert pipelines.resumable({"data_version": 1}, {"data_version": 2}) == ["data_version"]


def page_body(symbol, starts, price="1"):
    return json.dumps({"retCode": 0, "retMsg": "OK", "time": 1, "result": {"symbol": symbol, "category": "linear", "list": [[str(s), price, price, price, price, "1", "1"] for s in starts]}})


def raw_pages(spark, path, pages):
    rows = [("AAAUSDT", month, "bars:1", key, starts[0], starts[-1], bytearray(page_body("AAAUSDT", starts).encode())) for month, key, starts in pages]
    from tidemark.sources import store

    store.put(spark.createDataFrame(rows, "symbol string, month string, stream string, request_key string, range_start_ms long, range_end_ms long, raw binary"), path)


def test_two_builds_keep_every_month(spark, tmp_path):
    """The first run may do one month; the second one does what remains, and what was there stays."""
    a, b = listing(tmp_path / "t.json", "Trading", "AAAUSDT"), listing(tmp_path / "c.json", "Closed", "OLDUSDT")
    jan, feb, mar = 1_704_067_200_000, 1_706_745_600_000, 1_709_251_200_000
    raw_pages(spark, str(tmp_path / "raw"), [("2024-01", "k1", [jan + 60000 * i for i in range(5)]), ("2024-02", "k2", [feb + 60000 * i for i in range(7)])])
    run = ["bulk-build", "--trading", a, "--closed", b, "--raw", str(tmp_path / "raw"), "--start-ms", str(jan), "--end-ms", str(mar), "--now-ms", str(mar + 86_400_000)]
    assert cli.main([*run, "--out", str(tmp_path / "out"), "--max-partitions", "1"]) == pipelines.DONE
    done = spark.read.parquet(str(tmp_path / "out/manifests"))
    first = {r["month"]: r["logical_sha256"] for r in done.collect()}
    assert list(first) == ["2024-01"]
    header = str(tmp_path / "out/header")
    assert cli.main([*run, "--out", str(tmp_path / "out"), "--manifests", str(tmp_path / "out/manifests"), "--header", header]) == pipelines.DONE
    rows = spark.read.parquet(str(tmp_path / "out/manifests")).collect()
    assert sorted((r["month"], r["actual"]) for r in rows) == [("2024-01", 5), ("2024-02", 7)]
    bars = spark.read.parquet(str(tmp_path / "out/bars"))
    assert {str(r["month"])[:7]: r["count"] for r in bars.groupBy("month").count().collect()} == {"2024-01": 5, "2024-02": 7}
    assert cli.main([*run[:-3], str(mar - 1), *run[-2:], "--out", str(tmp_path / "out2"), "--header", header]) == pipelines.DRIFT
    assert cli.main([*run, "--out", str(tmp_path / "clean")]) == pipelines.DONE
    clean = {r["month"]: r["logical_sha256"] for r in spark.read.parquet(str(tmp_path / "clean/manifests")).collect()}
    assert clean == {r["month"]: r["logical_sha256"] for r in rows} and clean["2024-01"] == first["2024-01"]


def test_boundary_pilot_and_aborts(spark, tmp_path):
    a, b = listing(tmp_path / "t.json", "Trading", "AAAUSDT", "BBBUSDT"), listing(tmp_path / "c.json", "Closed", "OLDUSDT")
    bars = [(s, 60000 * i, *[1.0] * 6) for s, n in (("AAAUSDT", range(0, 9)), ("BBBUSDT", range(3, 10)), ("OLDUSDT", range(2, 9))) for i in n]
    spark.createDataFrame(bars, "symbol string, start_ms long, open double, high double, low double, close double, volume double, turnover double").write.parquet(str(tmp_path / "bars"))
    run = ["boundary-pilot", "--trading", a, "--closed", b, "--bars", str(tmp_path / "bars"), "--start-ms", "0", "--end-ms", "900000"]
    assert cli.main([*run, "--symbols", "aaausdt,OLDUSDT", "--out", str(tmp_path / "p")]) == pipelines.DONE
    parts = {r["symbol"]: r for r in spark.read.json(str(tmp_path / "p/partitions")).collect()}
    assert (parts["OLDUSDT"]["data_start_ms"], parts["OLDUSDT"]["data_end_ms"], parts["OLDUSDT"]["actual"], parts["OLDUSDT"]["missing"]) == (120000, 600000, 7, 1)
    assert spark.read.json(str(tmp_path / "p/overlap")).first().asDict() == {"overlap_start_ms": 120000, "overlap_end_ms": 600000, "overlap_ms": 480000}
    for wrong in ("AAAUSDT", "AAAUSDT,NONEUSDT"):
        with pytest.raises(ValueError):
            cli.main([*run, "--symbols", wrong, "--out", str(tmp_path / "q")])
    with pytest.raises(ValueError, match="development"):
        cli.main([*run, "--symbols", "AAAUSDT,BBBUSDT", "--development-end-ms", "1", "--out", str(tmp_path / "q")])
    assert cli.main(["pilot", "--bars", str(tmp_path / "bars"), "--out", str(tmp_path / "r"), "--stop-early", "1"]) == pipelines.ABORTED
    assert not (tmp_path / "r").exists()


def test_funding_mark_gate(spark, tmp_path):
    hour = 3_600_000
    spark.createDataFrame([(s, hour * i) for s in "AB" for i in range(1, 5)], "symbol string, ts_ms long").write.parquet(str(tmp_path / "e"))
    marks = [(s, hour * i, 1.0, 1.0) for s in "AB" for i in range(1, 5)]
    spark.createDataFrame(marks, "symbol string, start_ms long, open double, close double").write.parquet(str(tmp_path / "m"))
    spark.createDataFrame([(s, t, 2.0 if s == "B" else o, c) for s, t, o, c in marks], "symbol string, start_ms long, open double, close double").write.parquet(str(tmp_path / "n"))
    run = lambda minutes, out: cli.main(["funding-mark", "--events", str(tmp_path / "e"), "--marks-60m", str(tmp_path / "m"), "--marks-1m", minutes, "--out", str(tmp_path / out)])
    assert (run(str(tmp_path / "m"), "o1"), run(str(tmp_path / "n"), "o2")) == (pipelines.DONE, pipelines.GATE_FAILED)


def test_runs_of_other_partitions_are_not_compared(spark):
    a = spark.createDataFrame([("A", "2024-01", "x")], "symbol string, month string, logical_sha256 string")
    with pytest.raises(ValueError, match="differ in 2"):
        pipelines.compare(a, a.replace("A", "B"))
