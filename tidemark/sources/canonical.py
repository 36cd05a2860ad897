"""Canonical tables that joins read without a shuffle: bucketed and sorted by symbol and start.

Rows are dealt to buckets by the hash of symbol and start, so a frequent symbol spreads over all buckets; a join on both columns finds the
rows of either side where they lie. A table is its folder: any session can open it with the number of buckets it was written with.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

KEYS = ("symbol", "start_ms")


def _name() -> str:
    return f"tidemark_{uuid.uuid4().hex}"


def write(rows: DataFrame, path: str, buckets: int = 64, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Write ``rows`` to a new folder, a file a bucket, and open it. Rows with equal keys lie together."""
    name = _name()
    dealt = rows.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def open_table(spark: SparkSession, path: str, schema: StructType, buckets: int = 64, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """A table that was written before, also by another session; ``buckets`` and ``keys`` must be those it was written with."""
    name, columns, by = _name(), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
