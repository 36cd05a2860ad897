"""Runs of a plan: their status and its transitions, kept as lines, and runs that are stopped and go on."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import plan
from ..sources import store

RUNNING, COMPLETE, PARTIAL, WAITING, INTERRUPTED = "RUNNING", "COMPLETE", "PARTIAL", "WAITING_FOR_OPEN_PARTITIONS", "INTERRUPTED_ERROR"
_LINE = "run_id string, seq long, at_ms long, status string, planned long, completed long, pending_open long, new long, last_error string"


def progress(tasks: DataFrame, manifests: DataFrame, now_ms: int, capped: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """by, planned, completed, pending_open, status of a plan (tasks) and what is done of it (manifests): COMPLETE if every partition has its manifest,
    WAITING_FOR_OPEN_PARTITIONS if some that have none are still open and the run was not ``capped``, else PARTIAL. A plan without partitions is complete."""
    keys = ["symbol", "month", "data_start_ms", "data_end_ms"]
    done = manifests.where(F.col("kind") == "FULL_HISTORICAL").select(*keys).distinct().withColumn("_done", F.lit(True))
    each = tasks.join(done, keys, "left").withColumn("_open", F.col("_done").isNull() & (plan.seal_status(F.col("month_end_ms"), now_ms) == "OPEN"))
    counted = each.groupBy(*by).agg(F.count("*").alias("planned"), F.count("_done").alias("completed"), F.count_if("_open").alias("pending_open"))
    status = F.when(F.col("completed") == F.col("planned"), COMPLETE).when((F.col("pending_open") > 0) & F.lit(not capped), WAITING).otherwise(PARTIAL)
    return counted.withColumn("status", status)


class Log:
    """The lines of a folder's runs; each append is a file of its own, so a line is there whole or not at all."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.run_id, self.seq = spark, path, uuid.uuid4().hex, 0

    def add(self, status: str, **said) -> None:
        row = {"run_id": self.run_id, "seq": self.seq, "at_ms": int(time.time() * 1000), "status": status, **said}
        names = [c.split()[0] for c in _LINE.split(", ")]
        store.append_lines(self.spark.createDataFrame([tuple(row.get(n) for n in names)], _LINE).coalesce(1), self.path)
        self.seq += 1


def transitions(spark: SparkSession, path: str) -> DataFrame:
    """run_id, seq, at_ms, status, counts and last_error of all runs."""
    return spark.read.schema(_LINE).json(path)


def last_status(spark: SparkSession, path: str) -> DataFrame:
    """The line that is the latest of all: one row, or none before the first run."""
    return transitions(spark, path).orderBy(F.desc("at_ms"), F.desc("seq")).limit(1)


@contextmanager
def logged(spark: SparkSession, path: str) -> Iterator[dict]:
    """RUNNING, then what the block puts into the dictionary (status and counts), or INTERRUPTED_ERROR with the error, which goes on."""
    log, said = Log(spark, path), {}
    log.add(RUNNING)
    try:
        yield said
    except Exception as e:
        log.add(INTERRUPTED, last_error=f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:1000])
        raise
    log.add(**said)
