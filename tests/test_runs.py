"""Run status and its transitions, pilots that are stopped and go on, required symbols."""

import pytest

from tests.test_cli import listing, raw_pages
from tidemark import cli
from tidemark.operators import audit, inventory
from tidemark.plans import pipelines, runs

JAN, FEB, MAR, DAY = 1_704_067_200_000, 1_706_745_600_000, 1_709_251_200_000, 86_400_000


def test_status_of_builds(spark, tmp_path):
    a, b = listing(tmp_path / "t.json", "Trading", "AAAUSDT"), listing(tmp_path / "c.json", "Closed", "OLDUSDT")
    raw_pages(spark, str(tmp_path / "raw"), [("2024-01", "k1", [JAN + 60000 * i for i in range(5)]), ("2024-02", "k2", [FEB + 60000 * i for i in range(7)])])
    run = ["bulk-build", "--trading", a, "--closed", b, "--raw", str(tmp_path / "raw"), "--out", str(tmp_path / "out"), "--start-ms", str(JAN), "--end-ms", str(MAR)]
    status = lambda: runs.last_status(spark, str(tmp_path / "out/status")).first()
    more = ["--manifests", str(tmp_path / "out/manifests")]
    cli.main([*run, "--now-ms", str(MAR), "--max-partitions", "1"])
    assert (status()["status"], status()["planned"], status()["completed"]) == (runs.PARTIAL, 2, 1)
    cli.main([*run, *more, "--now-ms", str(MAR)])  # February is not sealed yet
    assert (status()["status"], status()["pending_open"]) == (runs.WAITING, 1)
    with pytest.raises(Exception):  # noqa: B017
        cli.main([*run, *more, "--now-ms", str(MAR + DAY), "--raw", str(tmp_path / "nowhere")])
    assert status()["status"] == runs.INTERRUPTED and "nowhere" in status()["last_error"]
    cli.main([*run, *more, "--now-ms", str(MAR + DAY)])
    assert (status()["status"], status()["completed"]) == (runs.COMPLETE, 2)
    lines = runs.transitions(spark, str(tmp_path / "out/status")).orderBy("at_ms", "seq").collect()
    assert [r["status"] for r in lines] == [runs.RUNNING, runs.PARTIAL, runs.RUNNING, runs.WAITING, runs.RUNNING, runs.INTERRUPTED, runs.RUNNING, runs.COMPLETE]


def test_a_stopped_pilot_goes_on(spark, tmp_path):
    bars = [(s, 60000 * i, *[float(n)] * 6) for n, s in enumerate("ABC") for i in range(60)]
    columns = "symbol string, start_ms long, open double, high double, low double, close double, volume double, turnover double"
    spark.createDataFrame(bars, columns).write.parquet(str(tmp_path / "bars"))
    native = [(s, 900_000 * i, *[float(n)] * 4, 15.0 * n, 15.0 * n) for n, s in enumerate("ABC") for i in range(4)] + [("A", 9_000_000, *[1.0] * 6)]
    spark.createDataFrame(native, columns).write.parquet(str(tmp_path / "n"))
    run = ["pilot", "--bars", str(tmp_path / "bars"), "--native-15", str(tmp_path / "n"), "--start-ms", "0", "--end-ms", "3600000", "--development-end-ms", "3600000"]
    out = str(tmp_path / "out")
    assert cli.main([*run, "--out", out, "--stop-after-symbols", "1"]) == pipelines.ABORTED
    assert [r["symbol"] for r in spark.read.parquet(f"{out}/parts").collect()] == ["A"] and not (tmp_path / "out/totals").exists()
    assert cli.main([*run, "--out", out, "--resume", "1", "--stop-after-symbols", "1"]) == pipelines.ABORTED
    assert cli.main([*run, "--out", out, "--resume", "1"]) == pipelines.DONE
    assert cli.main([*run, "--out", str(tmp_path / "clean"), "--stop-after-symbols", "9"]) == pipelines.DONE
    key = lambda p: sorted(map(tuple, spark.read.parquet(p).select("symbol", "step_ms", "common", "native_only", "mismatches", "logical_sha256").collect()))
    assert key(f"{out}/parts") == key(str(tmp_path / "clean/parts")) and [r[0] for r in key(f"{out}/parts")] == ["A", "B", "C"]
    total = spark.read.json(f"{out}/totals").first()
    assert (total["common"], total["native_only"], total["mismatches"]) == (12, 1, 0)


def test_required_symbols(spark):
    rows = [("BTCUSDT", "Trading"), ("ETHUSDT", "Trading"), ("OLDUSDT", "Closed")]
    make = lambda own: spark.createDataFrame(own, "symbol string, status string")
    assert sorted(r["symbol"] for r in inventory.pilot_selection(make(rows)).collect()) == ["BTCUSDT", "ETHUSDT", "OLDUSDT"]
    for own, said in ((rows[1:], "BTCUSDT is not"), (rows[:2], "no closed symbol"), ([], "BTCUSDT is not")):
        with pytest.raises(Exception, match=said):
            inventory.pilot_selection(make(own)).collect()


def test_unforeseen_failures_are_rows(spark):
    probes = spark.createDataFrame([("A", "x", 0, 0, 120_000), ("B", "x", 0, 0, 0)], "symbol string, checkpoint string, checkpoint_ms long, start_ms long, end_ms long")
    faults = spark.createDataFrame([("A", "x", "KeyError: boom", "INTERNAL_ERROR"), ("B", "x", "refused", None)], "symbol string, checkpoint string, error string, kind string")
    got = {r["symbol"]: (r["classification"], r["error"], r["missing_expected_count"]) for r in audit.failed_probes(probes, faults).collect()}
    assert got == {"A": ("INTERNAL_ERROR", "KeyError: boom", 3), "B": ("API_ERROR", "refused", 1)}
    assert {r["classification"] for r in audit.failed_probes(probes, faults.drop("kind")).collect()} == {"API_ERROR"}
