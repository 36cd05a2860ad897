"""The page store (two phases, bounds, streams) and page scans (retries, pacing, pushed filters, error rows)."""

import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import hashing
from tidemark.functions.timeops import page_windows
from tidemark.sources import fetch, page_scan, page_store

STEP = 60_000


def pages(spark, ids, raw="body"):
    rows = [(f"S{i % 3}", "bars", f"k{i}", i * STEP, i * STEP + STEP, f"{raw}{i}".encode()) for i in ids]
    return spark.createDataFrame(rows, page_store.SCHEMA)


def load(spark, path):
    return spark.read.format("page_store").load(str(path))


def test_pages_appear_at_once_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "s")
    page_store.register(spark)
    assert load(spark, path).count() == 0
    page_store.append(pages(spark, range(10)).unionByName(pages(spark, [3], "other")), path)
    page_store.append(pages(spark, range(5, 20), "late"), path)  # keys that are stored keep their body
    got = {r["request_key"]: bytes(r["raw"]).decode() for r in load(spark, path).collect()}
    assert got == {**{f"k{i}": f"late{i}" for i in range(10, 20)}, **{f"k{i}": f"body{i}" for i in range(10)}, "k3": got["k3"]} and got["k3"] in ("body3", "other3")
    # a task that writes files and dies with the job: files may lie there, no reader sees them
    lost = pages(spark, range(100, 120)).repartition(4, "request_key").withColumn("raw", F.when(F.col("request_key") == "k117", F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("raw")))
    with pytest.raises(PySparkException):
        lost.write.format("page_store").mode("append").option("pages_per_file", 2).save(path)
    assert load(spark, path).count() == 20
    files, root = page_store.place(path)
    page_store._Task(path, 4).write(iter(pages(spark, range(200, 210)).toArrow().to_batches()))  # a task whose job never commits
    assert load(spark, path).count() == 20 and len(page_store.manifests(files, root)) == 2
    assert page_store.vacuum(path) == 0 and page_store.vacuum(path, older_than_s=-1) >= 3
    assert load(spark, path).count() == 20


def test_manifests_are_never_replaced(tmp_path):
    files, root = page_store.place(f"file:{tmp_path}/s")
    assert page_store._publish(files, root, "000000000001", {"files": []}) and not page_store._publish(files, root, "000000000001", {"files": [1]})
    writer = page_store._Writer(root, 10)
    writer.commit([page_store.Written([{"name": "a", "rows": 1, "bounds": {}}]), None])
    assert [os.path.basename(m) for m in page_store.manifests(files, root)] == ["000000000001.json", "000000000002.json"] and len(page_store.committed(files, root)) == 1


def test_files_are_skipped_by_their_bounds(spark, tmp_path):
    path = str(tmp_path / "s")
    page_store.register(spark)
    pages(spark, range(60)).coalesce(1).sort("symbol", "range_start_ms").write.format("page_store").mode("append").option("pages_per_file", 10).save(path)
    spark.createDataFrame([(None, "bars", "none", None, None, None)], page_store.SCHEMA).write.format("page_store").mode("append").save(path)
    every = load(spark, path)
    assert every.count() == 61
    plain = spark.createDataFrame(every.collect(), page_store.SCHEMA)
    for condition in ("symbol = 'S1'", "symbol IN ('S0', 'S2')", f"range_start_ms >= {30 * STEP}", f"range_end_ms < {7 * STEP} AND symbol <> 'S1'", "symbol > 'S0' AND range_start_ms <= 240000", "symbol IS NULL", "request_key = 'k7'", "symbol = 'nothing'"):
        want = {r["request_key"] for r in plain.where(condition).collect()}
        assert {r["request_key"] for r in every.where(condition).collect()} == want, condition
    reader = page_store._Reader(path)
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual

    assert list(reader.pushFilters([EqualTo(("symbol",), "S1"), GreaterThanOrEqual(("range_start_ms",), 50 * STEP)])) == []
    assert len(reader.partitions()) == 1 < 7


def test_changed_bodies_are_noticed(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = tmp_path / "s"
    page_store.append(pages(spark, range(4)), str(path))
    (file,) = [f for f in (path / "_data").iterdir() if f.suffix == ".parquet"]
    table = pq.read_table(file)
    pq.write_table(table.set_column(table.schema.get_field_index("raw"), "raw", pa.array([b"changed"] * table.num_rows)), file)
    with pytest.raises(fetch.CorruptPageError), fetch.typed():
        load(spark, path).collect()


def test_stream_batches_are_written_once(spark, tmp_path):
    page_store.register(spark)
    source, path = str(tmp_path / "in"), str(tmp_path / "s")

    def run():
        stream = spark.readStream.schema(page_store.SCHEMA).parquet(source)
        stream.writeStream.format("page_store").option("path", path).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()

    pages(spark, range(4)).write.mode("append").parquet(source)
    run()
    pages(spark, range(4, 9)).write.mode("append").parquet(source)
    run()
    assert load(spark, path).count() == 9
    # the same batch again, as after a driver lost between its commit and the stream's own log
    writer = page_store._StreamWriter(path, 10, "stream")
    writer.commit([writer.write(iter(pages(spark, range(4)).toArrow().to_batches()))], 0)
    assert load(spark, path).count() == 9 and page_store.vacuum(path, older_than_s=-1) == 0
    with pytest.raises(PySparkException, match="takes the columns"):
        pages(spark, [1]).drop("raw").write.format("page_store").mode("append").save(path)


def scan(spark, transport, ranges, **options):
    page_scan.register(spark, transport)
    return spark.read.format("page_scan").options(**{"ranges": json.dumps(ranges), "step_ms": str(STEP), "page_size": "10", "per_second": "0", **options}).load()


def good(params):
    return page_scan.Answer(200, json.dumps({"retCode": 0, "retMsg": "OK", "result": {"symbol": params["symbol"], "list": []}}).encode())


def flaky(options):
    """The first answer of each request is a 429, the second one a passing code, the third one is good; S2 is refused, S3 breaks."""
    seen = {}

    def request(params):
        n = seen[json.dumps(params)] = seen.get(json.dumps(params), 0) + 1
        if params["symbol"] == "S2":
            return page_scan.Answer(200, b'{"retCode": 10001, "retMsg": "no such symbol"}')
        if params["symbol"] == "S3":
            raise KeyError("unforeseen")
        if params["symbol"] == "S4":
            raise ConnectionError("no route")
        if n < 3:
            return page_scan.Answer(429, b"", 2.0) if n == 1 else page_scan.Answer(200, b'{"retCode": 10006, "retMsg": "too many"}')
        return good(params)

    request.sleep = lambda s: None
    return request


def test_passing_faults_are_asked_again(spark):
    rows = scan(spark, flaky, [["S1", 0, 25 * STEP]], lanes="2").collect()
    assert [(r["range_start_ms"], r["range_end_ms"]) for r in sorted(rows, key=lambda r: r["range_start_ms"])] == [(0, 9 * STEP), (10 * STEP, 19 * STEP), (20 * STEP, 24 * STEP)]
    assert {(r["status"], r["attempts"], r["waited_s"], r["error"]) for r in rows} == {(200, 3, 3.0, None)}  # 2 s until the reset, then 1 s
    few = scan(spark, flaky, [["S1", 0, STEP]], retries="1", on_error="row").collect()
    assert [(r["attempts"], r["error"], r["raw"]) for r in few] == [(2, "API_ERROR", None)]


def test_lasting_faults_raise_or_are_rows(spark):
    for symbol, kind in (("S2", "no such symbol"), ("S3", "unforeseen"), ("S4", "no route")):
        with pytest.raises(PySparkException, match=kind):
            scan(spark, flaky, [[symbol, 0, STEP]], retries="2").collect()
    with pytest.raises(fetch.RefusedError), fetch.typed():
        scan(spark, flaky, [["S2", 0, STEP]]).collect()
    got = {r["symbol"]: (r["error"], r["attempts"], r["message"]) for r in scan(spark, flaky, [[f"S{i}", 0, STEP] for i in (1, 2, 3, 4)], retries="2", on_error="row").collect()}
    assert got == {"S1": (None, 3, None), "S2": ("API_ERROR", 1, "refused: 10001 no such symbol"), "S3": ("INTERNAL_ERROR", 1, "KeyError: 'unforeseen'"), "S4": ("API_ERROR", 3, "refused: no code no route")}


def test_scalar_rules_equal_column_rules(spark):
    cases = [(s, c) for s in (None, 200, 403, 429, 500, 503) for c in (None, 0, 10000, 10001, 10006, 10016)]
    rows = spark.createDataFrame(cases, "s int, c int").select("s", "c", F.coalesce(fetch.should_retry(F.col("s"), F.col("c")), F.lit(False)).alias("r")).collect()
    assert all(r["r"] == fetch.retries(r["s"], r["c"]) for r in rows)
    waits = spark.createDataFrame([(a, r) for a in range(7) for r in (None, 0.0, 0.3, 30.0, 60.0, 90.0)], "a int, r double").select("a", "r", fetch.wait_seconds(F.col("a"), F.col("r")).alias("w")).collect()
    assert all(abs(x["w"] - fetch.pause(x["a"], x["r"])) < 1e-12 for x in waits)
    params = {"category": "linear", "symbol": "Sé", "limit": "10"}
    column = spark.range(1).select(hashing.request_key(F.lit(page_scan.ENDPOINT), F.create_map(*[F.lit(x) for kv in params.items() for x in kv])).alias("k")).first()["k"]
    assert page_scan.request_key(params) == column


class Clock:
    """A transport whose time passes by sleeping only."""

    def __init__(self):
        self.now, self.starts = 0.0, []

    def __call__(self, params):
        self.starts.append(self.now)
        return good(params)

    def sleep(self, s):
        self.now += s

    def clock(self):
        return self.now


def reader(ranges, **options):
    clocks = []
    made = page_scan._Reader({"ranges": json.dumps(ranges), "step_ms": str(STEP), "page_size": "10", **options}, lambda _: clocks.append(Clock()) or clocks[-1])
    return made, clocks


def test_lanes_share_the_rate(spark):
    made, clocks = reader([["A", 0, 95 * STEP], ["B", STEP, STEP], ["C", 0, 120 * STEP]], per_second="8", lanes="4")
    lanes = made.partitions()
    assert len(lanes) == 4 and sum(s[2] for lane in lanes for s in lane.spans) == 10 + 12
    for lane in lanes:
        list(made.read(lane))
    assert all(b - a == pytest.approx(0.5) for c in clocks for a, b in zip(c.starts, c.starts[1:], strict=False))  # 2 a second in each of four lanes
    assert sorted(len(c.starts) for c in clocks) == [4, 6, 6, 6]
    plan = spark.createDataFrame([("A", 0, 95 * STEP), ("B", STEP, STEP), ("C", 0, 120 * STEP)], "symbol string, from_ms long, to_ms long")
    want = plan.select("symbol", F.explode(page_windows(F.col("from_ms"), F.col("to_ms"), STEP, 10)).alias("w")).select("symbol", "w.*").collect()
    asked = [(s, *made.window(a, b, k)) for lane in lanes for s, first, n, a, b in lane.spans for k in range(first, first + n)]
    assert sorted(asked) == sorted(map(tuple, want))
    said = sorted((r["start_s"], r["symbol"], r["start_ms"]) for r in page_scan.schedule(plan, STEP, 10, 8).collect())
    assert [s[0] for s in said] == [k / 8 for k in range(22)] and [s[1:] for s in said] == [a[:2] for a in sorted(asked)]


def test_filters_cut_the_plan(spark):
    ranges = [["A", 0, 95 * STEP], ["B", 30 * STEP, 300 * STEP], ["C", 0, 120 * STEP]]
    every = scan(spark, lambda options: good, ranges)
    whole = spark.createDataFrame(every.drop("raw").collect(), every.drop("raw").schema)
    for condition in ("symbol = 'B'", f"range_start_ms >= {45 * STEP}", f"range_end_ms < {39 * STEP} AND symbol IN ('A', 'C')", f"range_start_ms = {50 * STEP}", f"range_start_ms IN (0, {20 * STEP}) AND symbol <> 'A'", f"range_start_ms > {110 * STEP} AND range_end_ms <= {259 * STEP}", "symbol = 'Z'", f"range_end_ms = {94 * STEP}"):
        key = lambda r: (r["symbol"], r["range_start_ms"])
        assert sorted(map(key, every.where(condition).collect())) == sorted(map(key, whole.where(condition).collect())), condition
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual

    made, clocks = reader(ranges, lanes="1")
    assert list(made.pushFilters([EqualTo(("symbol",), "B"), GreaterThanOrEqual(("range_start_ms",), 200 * STEP)])) == []
    list(made.read(made.partitions()[0]))
    assert len(clocks[0].starts) == 10  # of 49 windows


def test_too_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(page_scan, "MOST_RANGES", 2)
    with pytest.raises(ValueError, match="too many ranges"):
        page_scan.plan_of(spark.range(3).selectExpr("cast(id AS string) symbol", "id from_ms", "id + 1 to_ms"))
