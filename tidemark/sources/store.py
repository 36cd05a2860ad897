"""Stored raw pages and canonical tables: first write wins, hashes are checked on reading, writes are ordered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.hashing import logical_hash
from ..operators.bars import dedupe_or_raise
from . import responses

KEYS = ["symbol", "month", "stream", "request_key"]
#: Writer options of canonical files.
PARQUET = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.enable.dictionary": "false", "parquet.writer.version": "v2", "parquet.block.row.count.limit": "65536"}


def stored(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages; a body that does not match its hash raises."""
    rows = spark.read.parquet(path)
    good = F.sha2("raw", 256) == F.col("raw_sha256")
    return rows.withColumn("_ok", F.when(good, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("corrupt page "), F.col("request_key"))).cast("boolean"))).where("_ok").drop("_ok")


def put(pages: DataFrame, path: str, present: DataFrame | None = None) -> DataFrame:
    """Append pages (KEYS, range_start_ms, range_end_ms, raw binary) whose key is not stored; of new pages with one key the first
    by range and hash wins. Returns what was written."""
    spark = pages.sparkSession
    fresh = pages.withColumn("raw_sha256", F.sha2("raw", 256))
    if present is not None:
        fresh = fresh.join(present.select(*KEYS), KEYS, "left_anti")
    one = fresh.groupBy(*KEYS).agg(F.min_by(F.struct(*[c for c in fresh.columns if c not in KEYS]), F.struct("range_start_ms", "raw_sha256")).alias("r")).select(*KEYS, "r.*")
    one.write.mode("append").partitionBy("symbol", "month").parquet(path)
    return spark.read.parquet(path)


def rebuild_bars(pages: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Bars of stored pages within [start, end); overlapping pages must agree in the text of every field."""
    parsed = responses.bars(pages.select(F.col("raw").cast("string").alias("body")))
    inside = parsed.where((F.col("start_ms") >= start_ms) & (F.col("start_ms") < end_ms))
    return dedupe_or_raise(inside, ["symbol", "start_ms"], ["open", "high", "low", "close", "volume", "turnover"])


def write_bars(bars: DataFrame, path: str, partitions: int | None = None, only: DataFrame | None = None) -> DataFrame:
    """Canonical bars (symbol, month, start_ms, ...) in files sorted by start. Only the symbol-months of ``bars`` are replaced, all others
    stay as they are. Returns the logical hash per symbol-month, read from the files: of those in ``only`` (symbol, month), or
    of all that the folder holds."""
    keys = ["symbol", "month"]
    dealt = bars.repartition(partitions, *keys) if partitions else bars.repartition(*keys)
    writer = dealt.sortWithinPartitions(*keys, "start_ms").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
    writer.options(**PARQUET).parquet(path)
    written = bars.sparkSession.read.schema(bars.schema).parquet(path)
    return logical_hash(written if only is None else written.join(only.select(*keys).distinct(), keys, "left_semi"), keys)


def first_starts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """symbol, first_trade_ms of a canonical table as ``write_bars`` writes it, from the footers of its files: the least start of every symbol-month is
    pushed into the scan, which reads no rows, and the least of these is a symbol's. (The session's files are read by the newer kind of
    source for this, and its aggregates are pushed.)"""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    kind = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(kind)
    spark.conf.set(kind, ",".join(x for x in before.split(",") if x != "parquet"))
    try:
        rows = spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(kind, before)
    return rows.groupBy("symbol", "month").agg(F.min("start_ms").alias("first")).groupBy("symbol").agg(F.min("first").alias("first_trade_ms"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes, file_sha256 of every file of a canonical table; a file is one symbol-month."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("file_sha256"))


def cached(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """key, raw of the cached bodies with these keys; a body that does not match its hash raises."""
    rows = spark.read.parquet(path).join(keys.select("key").distinct(), "key", "left_semi")
    fault = F.raise_error(F.concat(F.lit("corrupt cache entry "), F.col("key"))).cast("boolean")
    return rows.withColumn("_ok", F.when(F.sha2("raw", 256) == F.col("sha256"), F.lit(True)).otherwise(fault)).where("_ok").drop("_ok")


def cache(responses_: DataFrame, path: str) -> None:
    """Add bodies (key, raw) to the cache, with hash and size; keys that are there keep their body, and of new ones with one key the
    smallest hash wins."""
    spark = responses_.sparkSession
    fresh = responses_.select("key", "raw", F.sha2("raw", 256).alias("sha256"), F.octet_length("raw").alias("bytes"))
    if _exists(spark, path):
        fresh = fresh.join(spark.read.parquet(path).select("key"), "key", "left_anti")
    fresh.groupBy("key").agg(F.min_by(F.struct("raw", "sha256", "bytes"), "sha256").alias("r")).select("key", "r.*").write.mode("append").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def append_lines(rows: DataFrame, path: str) -> None:
    """Append rows as JSON lines; the committer makes each batch appear whole."""
    rows.write.mode("append").json(path, lineSep="\n")


def write_documents(rows: DataFrame, path: str) -> None:
    """A JSON document a row, its keys sorted; written as text, one line each."""
    rows.select(F.to_json(F.struct(*sorted(rows.columns))).alias("value")).write.mode("overwrite").text(path, lineSep="\n")


def write_report(probes: DataFrame, path: str) -> None:
    """CSV report, a line a probe, LF line ends."""
    probes.write.mode("overwrite").option("header", True).option("lineSep", "\n").csv(path)
