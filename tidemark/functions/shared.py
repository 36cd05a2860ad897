"""Cutting lineage in the folder all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a local master gets a folder of its own (tests), and a cluster an
    error: its executors do not share local folders."""
    sc = spark.sparkContext
    found, named = sc._jsc.sc().getCheckpointDir(), spark.conf.get("spark.checkpoint.dir", None)
    if not found.isDefined():
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
