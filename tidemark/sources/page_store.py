"""A store of response pages as a data source (``page_store``): writes in two phases, a log of manifests, files skipped by their bounds.

Tasks write files under ``_data`` that nothing refers to; the driver then publishes one manifest under ``_log`` that names them all, so the
pages of a job, or of a micro-batch, appear at once. What a killed, repeated or aborted task leaves is never named, and ``vacuum``
deletes it. Readers see named files only, and check every body against its hash.

    pages.write.format("page_store").mode("append").save(path)
    spark.read.format("page_store").load(path).where("symbol = 'X' AND range_start_ms >= 0")

Manifests are numbered and never replaced: of two jobs that publish one number at the same time the later one takes the next. A
micro-batch has its own name, so one that is written again changes nothing.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
    WriterCommitMessage,
)

#: A page; ``request_key`` identifies its request.
SCHEMA = "symbol string, stream string, request_key string, range_start_ms bigint, range_end_ms bigint, raw binary"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Columns whose bounds a manifest holds by file.
BOUNDED = ("symbol", "stream", "range_start_ms", "range_end_ms")
#: Pages of a file and of a row group.
PAGES_PER_FILE, PAGES_PER_GROUP = 4096, 64


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it of a folder's address, of any kind that Arrow knows; a plain path is a local, shared one."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


def manifests(files: fs.FileSystem, root: str) -> list[str]:
    found = files.get_file_info(fs.FileSelector(f"{root}/_log", allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.endswith(".json"))


def committed(files: fs.FileSystem, root: str) -> list[dict]:
    """Entries (name, rows, bounds) of all named files."""
    out = []
    for path in manifests(files, root):
        with files.open_input_stream(path) as f:
            out += json.loads(f.read())["files"]
    return out


def _publish(files: fs.FileSystem, root: str, name: str, entry: dict) -> bool:
    """Make a manifest appear whole under its name, or return False where the name is taken."""
    files.create_dir(f"{root}/_log", recursive=True)
    own, final = f"{root}/_log/.{uuid.uuid4().hex}", f"{root}/_log/{name}.json"
    with files.open_output_stream(own) as f:
        f.write(json.dumps(entry, sort_keys=True).encode())
    if isinstance(files, fs.LocalFileSystem):
        try:
            os.link(own, final)  # fails where the name is taken, also at the same moment
        except FileExistsError:
            return False
        finally:
            files.delete_file(own)
        return True
    if files.get_file_info(final).type != fs.FileType.NotFound:
        files.delete_file(own)
        return False
    files.move(own, final)
    return True


def _delete(files: fs.FileSystem, root: str, messages) -> None:
    for message in messages:
        for f in message.files if message else []:
            if files.get_file_info(f"{root}/{f['name']}").type != fs.FileType.NotFound:
                files.delete_file(f"{root}/{f['name']}")


class _Task:
    """Writes the pages of a task; used by both kinds of writer."""

    def __init__(self, path: str, pages_per_file: int) -> None:
        self.path, self.pages_per_file = path, pages_per_file

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = place(self.path)
        files.create_dir(f"{root}/_data", recursive=True)
        done: list[dict] = []
        held: list[pa.RecordBatch] = []
        n = 0

        def flush() -> None:
            nonlocal held, n
            if not n:
                return
            table = pa.Table.from_batches(held).select(COLUMNS).sort_by([(c, "ascending") for c in ("symbol", "stream", "range_start_ms", "request_key")])
            digests = [None if not raw.is_valid else hashlib.sha256(raw.as_buffer()).hexdigest() for raw in table.column("raw")]
            table = table.append_column("raw_sha256", pa.array(digests, pa.string()))
            name = f"_data/{uuid.uuid4().hex}.parquet"
            pq.write_table(table, f"{root}/{name}", filesystem=files, row_group_size=PAGES_PER_GROUP, compression="zstd")
            bounds = {}
            for c in BOUNDED:
                ends = pc.min_max(table.column(c)).as_py()
                bounds[c] = [ends["min"], ends["max"]]
            done.append({"name": name, "rows": table.num_rows, "bounds": bounds})
            held, n = [], 0

        for batch in iterator:
            for at in range(0, batch.num_rows, self.pages_per_file):
                part = batch.slice(at, self.pages_per_file)
                if n + part.num_rows > self.pages_per_file:
                    flush()
                held.append(part)
                n += part.num_rows
        flush()
        return Written(done)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, pages_per_file: int) -> None:
        self.path, self.task = path, _Task(path, pages_per_file)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.task.write(iterator)

    def commit(self, messages) -> None:
        files, root = place(self.path)
        entry = {"files": [f for m in messages if m for f in m.files]}
        found = manifests(files, root)
        number = 1 + max((int(n) for n in (os.path.basename(f)[:-5] for f in found) if n.isdigit()), default=0)
        while not _publish(files, root, f"{number:012d}", entry):
            number += 1

    def abort(self, messages) -> None:
        _delete(*place(self.path), messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, pages_per_file: int, stream: str) -> None:
        self.path, self.stream, self.task = path, stream, _Task(path, pages_per_file)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.task.write(iterator)

    def commit(self, messages, batchId: int) -> None:  # noqa: N803
        files, root = place(self.path)
        if not _publish(files, root, f"{self.stream}-{batchId:012d}", {"files": [f for m in messages if m for f in m.files]}):
            _delete(files, root, messages)

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        _delete(*place(self.path), messages)


@dataclass
class _File(InputPartition):
    name: str
    rows: int


#: Comparisons that a reader takes over: whether a file may hold such rows by its bounds, and the test of a row.
_TESTS = {
    EqualTo: (lambda lo, hi, v: lo <= v <= hi, lambda c, v: c == v),
    In: (lambda lo, hi, v: any(lo <= x <= hi for x in v), lambda c, v: c.isin(list(v))),
    GreaterThan: (lambda lo, hi, v: hi > v, lambda c, v: c > v),
    GreaterThanOrEqual: (lambda lo, hi, v: hi >= v, lambda c, v: c >= v),
    LessThan: (lambda lo, hi, v: lo < v, lambda c, v: c < v),
    LessThanOrEqual: (lambda lo, hi, v: lo <= v, lambda c, v: c <= v),
}


def pushed(filters, columns) -> tuple[list[tuple], list]:
    """(kind, column, value) of the comparisons of ``columns`` with values, and all other filters. IS NOT NULL goes where its column is compared."""
    kept, rest = [], []
    for f in filters:
        column, value = getattr(f, "attribute", None), getattr(f, "value", None)
        usable = type(f) in _TESTS and column is not None and len(column) == 1 and column[0] in columns and value is not None
        if usable and isinstance(value, tuple | list) and any(v is None for v in value):
            usable = False
        kept.append((type(f), column[0], value)) if usable else rest.append(f)
    compared = {c for _, c, _ in kept}
    return kept, [f for f in rest if not (isinstance(f, IsNotNull) and f.attribute[0] in compared)]


def may_hold(bounds: dict, tests: list[tuple]) -> bool:
    for kind, column, value in tests:
        lo, hi = bounds.get(column, (None, None))
        if column in bounds and (lo is None or not _TESTS[kind][0](lo, hi, value)):
            return False
    return True


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path
        self.tests: list[tuple] = []

    def pushFilters(self, filters):  # noqa: N802
        self.tests, rest = pushed(filters, (*BOUNDED, "request_key"))
        return rest

    def partitions(self):
        files, root = place(self.path)
        found = [_File(f["name"], f["rows"]) for f in committed(files, root) if may_hold(f["bounds"], self.tests)]
        return found or [_File("", 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        files, root = place(self.path)
        yield from read_file(files, f"{root}/{partition.name}", self.tests)


def read_file(files: fs.FileSystem, path: str, tests: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Pages of a file that meet ``tests``, a row group at a time; a body that does not match its hash raises."""
    condition = None
    for kind, column, value in tests:
        one = _TESTS[kind][1](ds.field(column), value)
        condition = one if condition is None else condition & one
    whole = ds.dataset(path, filesystem=files, format="parquet")
    for batch in whole.to_batches(filter=condition, batch_size=PAGES_PER_GROUP):
        for k, raw in enumerate(batch.column("raw")):
            if raw.is_valid and hashlib.sha256(raw.as_buffer()).hexdigest() != batch.column("raw_sha256")[k].as_py():
                raise ValueError(f"corrupt page {batch.column('request_key')[k].as_py()}")
        if batch.num_rows:
            yield batch.select(COLUMNS)


class PageStore(DataSource):
    """Options: path; pages_per_file; stream (name of a stream's batches, for streams)."""

    @classmethod
    def name(cls) -> str:
        return "page_store"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def _size(self) -> int:
        return int(self.options.get("pages_per_file", PAGES_PER_FILE))

    def _check(self, schema) -> None:
        if [f.name for f in schema.fields] != COLUMNS:
            raise ValueError(f"a page store takes the columns {', '.join(COLUMNS)}")

    def writer(self, schema, overwrite: bool):
        if overwrite:
            raise ValueError("a page store is appended to")
        self._check(schema)
        return _Writer(self.options["path"], self._size())

    def streamWriter(self, schema, overwrite: bool):  # noqa: N802
        self._check(schema)
        return _StreamWriter(self.options["path"], self._size(), self.options.get("stream", "stream"))


def register(spark: SparkSession) -> None:
    """Make ``page_store`` known to the session, and let filters reach its reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageStore)


def append(pages: DataFrame, path: str) -> None:
    """Add pages whose request is not stored, all at once; of new pages with one key the smallest range and hash wins."""
    spark = pages.sparkSession
    register(spark)
    present = spark.read.format("page_store").load(path).select("request_key")
    fresh = pages.select(*COLUMNS).join(present, "request_key", "left_anti")
    rest = [c for c in COLUMNS if c != "request_key"]
    one = fresh.groupBy("request_key").agg(F.min_by(F.struct(*rest), F.struct("range_start_ms", F.sha2("raw", 256))).alias("r")).select("request_key", "r.*")
    one.select(*COLUMNS).write.format("page_store").mode("append").save(path)


def vacuum(path: str, older_than_s: float = 86_400.0) -> int:
    """Delete files that no manifest names and that nothing has touched for a while (a running job may still name its own); how many."""
    files, root = place(path)
    named, n = {f["name"] for f in committed(files, root)}, 0
    for f in files.get_file_info(fs.FileSelector(f"{root}/_data", allow_not_found=True)):
        if f"_data/{f.base_name}" not in named and time.time() - f.mtime.timestamp() >= older_than_s:
            files.delete_file(f.path)
            n += 1
    return n
