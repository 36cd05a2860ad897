"""Reading tables, staging results in the cluster's shared folder, small column helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words: space and bytes 9 to 13.
WS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset, a local master gets a folder of its own (tests), and a
    cluster an error, as its executors do not share local folders."""
    sc = spark.sparkContext
    found, named = sc._jsc.sc().getCheckpointDir(), spark.conf.get("spark.checkpoint.dir", None)
    if not found.isDefined():
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batches_of(spark: SparkSession, rows: int | None):
    """Meanwhile a task passes at most ``rows`` rows to a Python worker at once: a batch lies in the memory of both, several times over
    while it is built and sent. A smaller number that the session has stays, and the session's comes back afterwards."""
    before = spark.conf.get(_BATCH)
    if rows and not 0 < int(before) <= rows:
        spark.conf.set(_BATCH, rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: lineage ends here, and a lost
    executor costs only a re-read. Python workers get ``rows`` rows at once at most. The files are deleted when the application ends, or by ``release``. Shuffle
    files that only the write needed are freed at once, as Spark frees them when its driver collects garbage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tidemark-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    with batches_of(spark, rows):
        df.write.parquet(path)
    files, place = _files(spark, path)
    files.deleteOnExit(place)
    spark.sparkContext._jvm.java.lang.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def release(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in staged:
        files, place = _files(df.sparkSession, df.staged_at)
        files.delete(place, True)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(key: str, divisor: int) -> Column:
    """crc32 of a key as text, modulo ``divisor``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")), F.lit(divisor))


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
