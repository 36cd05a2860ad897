"""Pages of bars asked for by a job, as a data source (``page_scan``): a request a window, retried and paced inside the reader.

The plan of windows is dealt to ``lanes``, which are the input partitions; each keeps to its share of the rate, so however many run at
once, the whole scan stays below ``per_second``. Filters on the symbol and on the windows' bounds cut the plan, so what is not
wanted is not asked for.

How a request is made is not this module's: ``source(transport)`` takes a factory, called with the options in the task that runs a
lane, that returns a function from the parameters of a request to an ``Answer``. ``stored`` answers from a page store.
"""

from __future__ import annotations

import hashlib
import json
import math
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..functions.timeops import page_windows
from . import fetch, page_store

ENDPOINT = "/v5/market/kline"
SCHEMA = "symbol string, range_start_ms bigint, range_end_ms bigint, request_key string, status int, attempts int, waited_s double, raw binary, error string, message string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.string(), pa.string()]
#: Ranges that a plan may have (a row a symbol's lifetime), as they pass through the driver.
MOST_RANGES = 100_000


@dataclass
class Answer:
    """Status and body of an answer, and seconds until the server's limit is reset. A transport that fails raises ``ConnectionError``."""

    status: int
    body: bytes
    reset_in: float | None = None


@dataclass
class Lane(InputPartition):
    """Spans of windows: symbol, number of the first window in its range, number of windows, and the range."""

    spans: list[tuple[str, int, int, int, int]]
    per_second: float


def request_key(params: dict[str, str]) -> str:
    """The key of ``hashing.request_key`` for one request."""
    return hashlib.sha256(f"{ENDPOINT}\n{json.dumps(params, ensure_ascii=False, sort_keys=True, separators=(',', ':'))}".encode()).hexdigest()


def _code(body: bytes) -> tuple[int | None, str]:
    """retCode and retMsg of a body; no code where it is no such JSON."""
    try:
        found = json.loads(body)
        return int(found["retCode"]), str(found.get("retMsg", ""))
    except (ValueError, KeyError, TypeError):
        return None, "no such JSON"


def ask(request: Callable[[dict], Answer], params: dict[str, str], retries: int, sleep: Callable[[float], None]) -> tuple:
    """status, attempts, waited_s, raw, error, message of one request under the rules of ``fetch``."""
    waited = 0.0
    for attempt in range(retries + 1):
        answer, reset_in, code, says = None, None, None, ""
        try:
            answer = request(params)
            reset_in = answer.reset_in
            code, says = _code(answer.body) if answer.status == 200 else (None, f"status {answer.status}")
            if answer.status == 200 and code == 0:
                return 200, attempt + 1, waited, answer.body, None, None
        except ConnectionError as e:
            says = str(e) or "no answer"
        if attempt == retries or not fetch.retries(answer and answer.status, code):
            break
        pause = fetch.pause(attempt, reset_in)
        sleep(pause)
        waited += pause
    return answer and answer.status, attempt + 1, waited, None, "API_ERROR", f"refused: {code if code is not None else 'no code'} {says}"


class _Reader(DataSourceReader):
    def __init__(self, options: dict, transport: Callable[[dict], Callable[[dict], Answer]]) -> None:
        self.transport, self.options, self.tests = transport, options, []
        get = options.get
        self.step, self.page_size = int(options["step_ms"]), int(get("page_size", "1000"))
        self.per_second, self.lanes, self.retries = float(get("per_second", "10")), int(get("lanes", "8")), int(get("retries", "5"))
        self.stream, self.on_error = get("stream", "bars"), get("on_error", "raise")
        self.ranges = [(str(s), int(a), int(b)) for s, a, b in json.loads(options["ranges"])]

    def pushFilters(self, filters):  # noqa: N802
        self.tests, rest = page_store.pushed(filters, ("symbol", "range_start_ms", "range_end_ms"))
        return rest

    def window(self, start: int, end: int, k: int) -> tuple[int, int]:
        """Window ``k`` of a range: its start and the start of its last bar."""
        first = start + k * self.page_size * self.step
        return first, min(end - self.step, first + (self.page_size - 1) * self.step)

    def wanted(self, symbol: str, start: int, end: int) -> tuple[int, int]:
        """The numbers [a, b) of a range's windows between which all lie that the pushed filters leave: starts and ends of windows only grow, so
        either bound is found by halving. What equalities leave out in between, ``read`` passes over."""
        if end - self.step < start or not page_store.may_hold({"symbol": [symbol, symbol]}, self.tests):
            return 0, 0
        n = -(-(end - start) // (self.page_size * self.step))

        def first(met: Callable[[int], bool], column: str) -> int:
            """The first window whose start (or end) meets a condition that all later ones meet."""
            at, a, b = ("range_start_ms", "range_end_ms").index(column), 0, n
            while a < b:
                mid = (a + b) // 2
                a, b = (a, mid) if met(self.window(start, end, mid)[at]) else (mid + 1, b)
            return a

        low, high = 0, n
        for kind, column, value in self.tests:
            if column == "symbol":
                continue
            least, most = (min(value), max(value)) if isinstance(value, tuple | list) else (value, value)
            if kind in (EqualTo, In, GreaterThan, GreaterThanOrEqual):
                low = max(low, first((lambda x: x > least) if kind is GreaterThan else (lambda x: x >= least), column))
            if kind in (EqualTo, In, LessThan, LessThanOrEqual):
                high = min(high, first((lambda x: x >= most) if kind is LessThan else (lambda x: x > most), column))
        return low, max(low, high)

    def partitions(self):
        spans = [(s, a, b - a, start, end) for s, start, end in self.ranges for a, b in [self.wanted(s, start, end)] if b > a]
        total = sum(x[2] for x in spans)
        lanes = max(1, min(self.lanes, total))
        share, out, room, held = -(-total // lanes), [], -(-total // lanes), []
        for symbol, first, n, start, end in spans:
            while n:
                take = min(n, room)
                held.append((symbol, first, take, start, end))
                first, n, room = first + take, n - take, room - take
                if not room:
                    out.append(Lane(held, self.per_second / lanes))
                    held, room = [], share
        return [*out, Lane(held, self.per_second / lanes)] if held or not out else out

    def read(self, partition: Lane) -> Iterator[pa.RecordBatch]:
        request = self.transport(self.options)
        sleep, clock = getattr(request, "sleep", time.sleep), getattr(request, "clock", time.monotonic)
        due, rows = clock(), []
        exact = [t for t in self.tests if t[1] != "symbol"]
        for symbol, first, n, start, end in partition.spans:
            for k in range(first, first + n):
                a, b = self.window(start, end, k)
                if not page_store.may_hold({"range_start_ms": [a, a], "range_end_ms": [b, b]}, exact):
                    continue
                if math.isfinite(partition.per_second) and partition.per_second > 0:
                    if (early := due - clock()) > 0:
                        sleep(early)
                    due = max(due, clock()) + 1 / partition.per_second
                params = {"category": "linear", "symbol": symbol, "interval": str(self.step // 60_000), "start": str(a), "end": str(b), "limit": str(self.page_size)}
                try:
                    found = ask(request, params, self.retries, sleep)
                except Exception as e:  # a row stands for what nobody foresaw, where rows are wanted
                    if self.on_error == "raise":
                        raise
                    found = (None, 1, 0.0, None, "INTERNAL_ERROR", f"{type(e).__name__}: {e}")
                if found[4] and self.on_error == "raise":
                    raise ConnectionError(found[5])
                rows.append((symbol, a, b, request_key(params), *found))
                if len(rows) == 64:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=COLUMNS)


def source(transport: Callable[[dict], Callable[[dict], Answer]]) -> type[DataSource]:
    """The data source over a transport. Options: ranges (JSON list of symbol, start, exclusive end), step_ms, page_size, per_second (0: not paced),
    lanes, retries, on_error (raise; or row: API_ERROR for refusals, INTERNAL_ERROR for what the transport raises besides), and the transport's own."""

    class PageScan(DataSource):
        @classmethod
        def name(cls) -> str:
            return "page_scan"

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return _Reader(dict(self.options), transport)

    return PageScan


def stored(options: dict) -> Callable[[dict], Answer]:
    """A transport that answers from the page store in option ``bodies``: the page of the same symbol and window, and where there is none,
    an empty page. It keeps the files' bounds, and one file's pages at a time are looked through."""
    files, root = page_store.place(options["bodies"])
    entries = page_store.committed(files, root)

    def request(params: dict) -> Answer:
        tests = [(EqualTo, "symbol", params["symbol"]), (EqualTo, "range_start_ms", int(params["start"])), (EqualTo, "range_end_ms", int(params["end"]))]
        for entry in entries:
            if page_store.may_hold(entry["bounds"], tests):
                for batch in page_store.read_file(files, f"{root}/{entry['name']}", tests):
                    return Answer(200, batch.column("raw")[0].as_py())
        empty = {"retCode": 0, "retMsg": "OK", "time": 0, "result": {"symbol": params["symbol"], "category": "linear", "list": []}}
        return Answer(200, json.dumps(empty).encode())

    return request


def plan_of(ranges: DataFrame) -> str:
    """Option ``ranges`` of rows symbol, from_ms, to_ms, one a symbol's lifetime; more than ``MOST_RANGES`` are an error."""
    rows = ranges.select("symbol", "from_ms", "to_ms").limit(MOST_RANGES + 1).collect()
    if len(rows) > MOST_RANGES:
        raise ValueError("too many ranges for one scan")
    return json.dumps(sorted([r["symbol"], r["from_ms"], r["to_ms"]] for r in rows))


def schedule(ranges: DataFrame, step: int, page_size: int = 1000, per_second: int = 10) -> DataFrame:
    """What a scan would ask for, without asking: symbol, start_ms, end_ms of each window, and when it may start at the earliest if
    requests are made in order of symbol and start. Numbers come from the counts of the ranges, so nothing is sorted but these."""
    made = ranges.select("symbol", "from_ms", F.posexplode(page_windows(F.col("from_ms"), F.col("to_ms"), step, page_size)).alias("k", "w"))
    own = ranges.select("symbol", "from_ms", F.size(page_windows(F.col("from_ms"), F.col("to_ms"), step, page_size)).cast("long").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("symbol", "from_ms").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = made.join(own.select("symbol", "from_ms", before.alias("before")), ["symbol", "from_ms"]).withColumn("n", F.col("before") + F.col("k"))
    return fetch.paced(numbered, per_second).select("symbol", "w.start_ms", "w.end_ms", "start_s")


def register(spark: SparkSession, transport: Callable[[dict], Callable[[dict], Answer]] = stored) -> None:
    """Make ``page_scan`` over this transport known to the session, and let filters reach its reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source(transport))
