"""Commands of the audits over stored bodies and tables: python -m tidemark.cli COMMAND --help."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.timeops import DAY, HOUR, MINUTE
from .plans import pipelines, runs
from .sources import fetch, responses, store


def _instruments(spark: SparkSession, args) -> tuple[DataFrame, DataFrame]:
    return pipelines.inventory_report(responses.read_bodies(spark, args.trading), responses.read_bodies(spark, args.closed))


def inventory(spark: SparkSession, args) -> int:
    rows, counts = _instruments(spark, args)
    rows.write.mode("overwrite").parquet(f"{args.out}/instruments")
    store.write_documents(counts.coalesce(1), f"{args.out}/counts")
    store.write_documents(pipelines.inventory_hash(rows).coalesce(1), f"{args.out}/hash")
    return pipelines.DONE


def sample_coverage(spark: SparkSession, args) -> int:
    rows, _ = _instruments(spark, args)
    read = lambda p: spark.read.parquet(p) if p else None
    store.write_report(pipelines.sample_coverage(rows, spark.read.parquet(args.bars), args.now_ms, read(args.daily), read(args.faults)), args.out)
    return pipelines.DONE


def bulk_build(spark: SparkSession, args) -> int:
    rows, _ = _instruments(spark, args)
    done = spark.read.parquet(args.manifests) if args.manifests else None
    header = {"range_start_ms": args.start_ms, "range_end_ms": args.end_ms, "inventory_sha256": pipelines.inventory_hash(rows).first()["inventory_sha256"]}
    if args.header:  # of the run to be resumed
        drift = pipelines.resumable(responses.document(spark, args.header, "range_start_ms LONG, range_end_ms LONG, inventory_sha256 STRING").first().asDict(), header, tuple(header))
        if drift:
            print("differs in", *drift)
            return pipelines.DRIFT
    store.write_documents(spark.createDataFrame([header]), f"{args.out}/header")
    span = pipelines.Range(args.start_ms, args.end_ms)
    with runs.logged(spark, f"{args.out}/status") as said:
        made = pipelines.bulk_build(spark, args.raw, f"{args.out}/bars", rows, span, args.now_ms, done, args.max_symbols or None, args.max_partitions or None)
        made.write.mode("append").parquet(f"{args.out}/manifests")
        tasks = pipelines.planned(spark, args.raw, rows, span, args.max_symbols or None)
        state = runs.progress(tasks, spark.read.parquet(f"{args.out}/manifests"), args.now_ms, bool(args.max_partitions)).first()
        said.update(state.asDict())
    return pipelines.DONE


def pilot(spark: SparkSession, args) -> int:
    """Roll-ups of 1-minute bars against native bars; only months before the holdout may be looked at."""
    bars = spark.read.parquet(args.bars)
    pipelines.guard_development(args.end_ms, args.development_end_ms)
    if args.stop_early:  # an intended abort, before anything is computed
        return pipelines.ABORTED
    native = {step: spark.read.parquet(path) for step, path in ((15 * MINUTE, args.native_15), (HOUR, args.native_60), (DAY, args.native_d)) if path}
    if args.stop_after_symbols or args.resume:  # by symbol, in one folder, until all are done
        own = bars.where((F.col("start_ms") >= args.start_ms) & (F.col("start_ms") < args.end_ms))
        done = spark.read.parquet(f"{args.out}/parts") if args.resume else None
        pipelines.pilot_parts(own, native, done, args.stop_after_symbols or None).write.mode("append").parquet(f"{args.out}/parts")
        whole = spark.read.parquet(f"{args.out}/parts")
        if own.select("symbol").distinct().join(whole.select("symbol").distinct(), "symbol", "left_anti").limit(1).count():
            return pipelines.ABORTED
        totals = whole.groupBy("step_ms").agg(*(F.sum(c).alias(c) for c in ("common", "local_only", "native_only", "mismatches")))
        totals.coalesce(1).write.mode("overwrite").json(f"{args.out}/totals")
        return pipelines.DONE
    out = pipelines.pilot_diagnostics(bars.where((F.col("start_ms") >= args.start_ms) & (F.col("start_ms") < args.end_ms)), native)
    out.coalesce(1).write.mode("overwrite").json(args.out)
    return pipelines.DONE


def boundary_pilot(spark: SparkSession, args) -> int:
    """One month of two or more symbols (--symbols A,B), each clipped to its life, and the overlap of their ranges."""
    pipelines.guard_development(args.end_ms, args.development_end_ms)
    rows, _ = _instruments(spark, args)
    parts, overlap = pipelines.boundary_pilot(rows, spark.read.parquet(args.bars), args.start_ms, args.end_ms, [s.strip().upper() for s in args.symbols.split(",") if s.strip()])
    store.write_documents(parts, f"{args.out}/partitions")
    store.write_documents(overlap, f"{args.out}/overlap")
    return pipelines.DONE


def compare(spark: SparkSession, args) -> int:
    flags, code = pipelines.compare(spark.read.parquet(args.a), spark.read.parquet(args.b))
    flags.coalesce(1).write.mode("overwrite").json(args.out)
    return code


def funding_mark(spark: SparkSession, args) -> int:
    valued, code = pipelines.funding_mark_pilot(*(spark.read.parquet(p) for p in (args.events, args.marks_60m, args.marks_1m)))
    valued.write.mode("overwrite").parquet(args.out)
    return code


#: command: function, path arguments, number arguments.
COMMANDS = {
    "inventory": (inventory, ("trading", "closed", "out"), ()),
    "sample-coverage": (sample_coverage, ("trading", "closed", "bars", "daily", "faults", "out"), ("now_ms",)),
    "bulk-build": (bulk_build, ("trading", "closed", "raw", "out", "manifests", "header"), ("start_ms", "end_ms", "now_ms", "max_symbols", "max_partitions")),
    "boundary-pilot": (boundary_pilot, ("trading", "closed", "bars", "symbols", "out"), ("start_ms", "end_ms", "development_end_ms")),
    "pilot": (pilot, ("bars", "native_15", "native_60", "native_d", "out"), ("start_ms", "end_ms", "development_end_ms", "stop_early", "stop_after_symbols", "resume")),
    "compare": (compare, ("a", "b", "out"), ()),
    "funding-mark": (funding_mark, ("events", "marks_60m", "marks_1m", "out"), ()),
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (_, paths, numbers) in COMMANDS.items():
        sub = commands.add_parser(name)
        for p in paths:
            sub.add_argument(f"--{p.replace('_', '-')}", dest=p)
        for n in numbers:
            sub.add_argument(f"--{n.replace('_', '-')}", dest=n, type=int, default=0)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    with fetch.typed():
        return COMMANDS[args.command][0](spark, args)


if __name__ == "__main__":
    sys.exit(main())
