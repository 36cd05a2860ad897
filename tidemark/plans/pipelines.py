"""The audits as Spark jobs over stored pages: inventory, sampled coverage, bulk build, pilot, comparison, funding marks."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import canonical_json, logical_hash
from ..functions.shared import cut
from ..functions.timeops import MINUTE, probe_points, probe_window
from ..operators import audit, bars, funding, inventory, plan
from ..sources import responses, store

#: Exit codes of the commands.
DONE, ABORTED, DRIFT, GATE_FAILED = 0, 3, 4, 5


@dataclass(frozen=True)
class Range:
    start_ms: int
    end_ms: int


def inventory_report(trading: DataFrame, closed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All instruments of both listings (bodies), with eligibility; and counts by status."""
    rows = inventory.union_inventories(responses.instruments(trading), responses.instruments(closed))
    flag = inventory.eligible(*(F.col(c) for c in ("contract_type", "quote_coin", "settle_coin", "status", "is_pre_listing", "market_region", "symbol_type")))
    rows = rows.withColumn("eligible", flag)
    return rows, rows.groupBy("status").agg(F.count("*").alias("n"), F.count_if("eligible").alias("eligible"))


def inventory_hash(rows: DataFrame) -> DataFrame:
    """sha256 over the JSON array of the instruments' records, sorted by symbol, each with sorted keys and with the two flags of its
    row: eligible now, candidate of the audit. Such a hash goes on record by record, so the sorted records pass through one task in batches,
    which keeps its state only; they are made and flagged before that."""
    flags = F.concat(F.lit('{"audit_sample_candidate":'), inventory.audit_candidate(F.col("eligible"), F.col("symbol"), F.col("status")).cast("string"), F.lit(',"current_crypto_perpetual_eligible":'), F.col("eligible").cast("string"), F.lit(","))
    record = canonical_json(F.concat(flags, F.expr("substring(ltrim(raw), 2)")))
    lines = rows.select("symbol", record.alias("record")).repartition(1).sortWithinPartitions("symbol", "record")

    def digest(batches):
        state, n, link = hashlib.sha256(b"["), 0, b""
        for batch in batches:
            n += batch.num_rows
            for text in batch.column("record").drop_null():
                state.update(link + text.as_py().encode())
                link = b","
        state.update(b"]")
        yield pa.RecordBatch.from_pylist([{"sha": state.hexdigest(), "n": n}], pa.schema([("sha", pa.string()), ("n", pa.int64())]))

    whole = lines.mapInArrow(digest, "sha string, n long")
    nothing = hashlib.sha256(b"[]").hexdigest()  # where no task runs
    return whole.agg(F.coalesce(F.max("sha"), F.lit(nothing)).alias("inventory_sha256"), F.coalesce(F.sum("n"), F.lit(0)).alias("instruments"))


def boundary_pilot(instruments: DataFrame, bars_1m: DataFrame, month_start_ms: int, month_end_ms: int, symbols: list[str]) -> tuple[DataFrame, DataFrame]:
    """What two or more symbols have of one month, each clipped to its life: symbol, data_start_ms, data_end_ms, expected, actual, missing,
    logical_sha256; and the overlap of their ranges (nulls if there is none)."""
    if len(set(symbols)) < 2:
        raise ValueError("a boundary pilot needs two symbols or more")
    chosen = instruments.where(F.col("symbol").isin(*symbols))
    if {r["symbol"] for r in chosen.where("eligible").select("symbol").collect()} != set(symbols):
        raise ValueError("a symbol is not in the inventory, or not eligible")
    ranges = plan.partition_plan(lifetimes(chosen, bars_1m), month_start_ms, month_end_ms, False)
    own = bars_1m.join(ranges.select("symbol", "month", "data_start_ms", "data_end_ms"), "symbol").where("start_ms >= data_start_ms AND start_ms < data_end_ms")
    made = logical_hash(own, ["symbol", "month"])
    expected = ((F.col("data_end_ms") - F.col("data_start_ms")) / MINUTE).cast("long")
    parts = ranges.join(made, ["symbol", "month"], "left").select("symbol", "data_start_ms", "data_end_ms", expected.alias("expected"), F.coalesce("row_count", F.lit(0)).alias("actual"), "logical_sha256").withColumn("missing", F.col("expected") - F.col("actual"))
    span = parts.agg(F.max("data_start_ms").alias("a"), F.min("data_end_ms").alias("z"))
    met = F.col("z") > F.col("a")
    return parts, span.select(F.when(met, F.col("a")).alias("overlap_start_ms"), F.when(met, F.col("z")).alias("overlap_end_ms"), F.greatest(F.lit(0), F.col("z") - F.col("a")).alias("overlap_ms"))


def guard_development(end_ms: int, development_end_ms: int) -> None:
    """Tools that look at results may only see the development period."""
    if development_end_ms and end_ms > development_end_ms:
        raise ValueError("the range leaves the development period")


def resumable(header: dict, now: dict, keys: tuple[str, ...] = ("data_version", "range_start_ms", "range_end_ms", "inventory_sha256")) -> list[str]:
    """Names of header fields in which a run differs from the one to be resumed; empty if it may go on."""
    return [k for k in keys if header.get(k) != now.get(k)]


def sample_coverage(instruments: DataFrame, bars_1m: DataFrame, now_ms: int, daily: DataFrame | None = None, faults: DataFrame | None = None) -> DataFrame:
    """Three probe windows of each audited instrument, classified. With ``daily`` bars, instruments that were traded before their launch day
    have LIFETIME_METADATA_CONFLICT on their origin's probe; probes in ``faults`` (symbol, checkpoint, error) are reported as
    failed; instruments without any trade have a row that says so."""
    known = instruments.join(audit.first_trades(bars_1m), "symbol", "left")
    points = known.withColumn("p", F.explode(probe_points(F.col("launch_ms"), F.col("first_trade_ms"), F.col("delivery_ms"), now_ms)))
    window = probe_window(F.col("p.point_ms"))
    probes = points.select("symbol", F.col("p.label").alias("checkpoint"), F.col("p.point_ms").alias("checkpoint_ms"), window["start_ms"].alias("start_ms"), window["end_ms"].alias("end_ms"), "launch_ms", "first_trade_ms", "delivery_ms")
    failed = audit.failed_probes(probes, faults) if faults is not None else None
    if failed is not None:
        probes = probes.join(faults.select("symbol", "checkpoint"), ["symbol", "checkpoint"], "left_anti")
    out = audit.coverage(probes, bars_1m, MINUTE)
    if daily is not None:
        early = audit.prelaunch_history(daily, known).select("symbol").distinct()
        report = audit.lifetime_report(known, early).where("lifetime_metadata_conflict").select("symbol", F.lit(True).alias("_conflict"))
        origin = F.col("checkpoint").isin("near_first_trade", "near_launch") & F.coalesce("_conflict", F.lit(False))
        out = out.join(report, "symbol", "left").withColumn("classification", F.when(origin, "LIFETIME_METADATA_CONFLICT").otherwise(F.col("classification"))).drop("_conflict")
    out = out.unionByName(audit.missing_first_trades(known))
    return out.unionByName(failed, allowMissingColumns=True) if failed is not None else out


def lifetimes(instruments: DataFrame, bars_1m: DataFrame) -> DataFrame:
    return instruments.join(audit.first_trades(bars_1m), "symbol", "left").select("symbol", "status", "first_trade_ms", "launch_ms", "delivery_ms", "eligible")


def planned(spark: SparkSession, raw_path: str, instruments: DataFrame, span: Range, most_symbols: int | None = None) -> DataFrame:
    """All symbol-months of a build, done or not."""
    whole = store.rebuild_bars(store.stored(spark, raw_path).where("stream = 'bars:1'"), span.start_ms, span.end_ms)
    return plan.partition_plan(lifetimes(instruments, whole), span.start_ms, span.end_ms, False, most_symbols)


def bulk_build(spark: SparkSession, raw_path: str, out_path: str, instruments: DataFrame, span: Range, now_ms: int, manifests: DataFrame | None = None, most_symbols: int | None = None, most_partitions: int | None = None) -> DataFrame:
    """Canonical bars of every symbol-month that has no manifest, and the new manifests with counts, seal and logical hash. A
    month that is still open is deferred. Work is planned by an anti join, so a repeated call does what remains, and the
    months that are there stay. ``most_symbols`` and ``most_partitions`` cap a run."""
    pages = store.stored(spark, raw_path)
    whole = store.rebuild_bars(pages.where("stream = 'bars:1'"), span.start_ms, span.end_ms)
    tasks = plan.partition_plan(lifetimes(instruments, whole), span.start_ms, span.end_ms, False, most_symbols)
    if manifests is not None:
        tasks = plan.remaining(tasks, manifests)
    tasks = tasks.withColumn("status", plan.seal_status(F.col("month_end_ms"), now_ms)).where("status = 'SEALED'")
    if most_partitions is not None:
        tasks = tasks.orderBy("month_start_ms", "symbol").limit(most_partitions)
    tasks = cut(tasks)
    month = F.date_format(F.timestamp_millis("start_ms"), "yyyy-MM")
    own = whole.withColumn("month", month).join(tasks.select("symbol", "month", "data_start_ms", "data_end_ms"), ["symbol", "month"]).where("start_ms >= data_start_ms AND start_ms < data_end_ms")
    hashes = store.write_bars(own.drop("data_start_ms", "data_end_ms"), out_path, only=tasks)
    expected = ((F.col("data_end_ms") - F.col("data_start_ms")) / MINUTE).cast("long")
    out = tasks.join(hashes, ["symbol", "month"], "left").withColumn("actual", F.coalesce("row_count", F.lit(0)))
    return out.select(F.lit("FULL_HISTORICAL").alias("kind"), "symbol", "month", "data_start_ms", "data_end_ms", "status", expected.alias("expected"), "actual", (expected - F.col("actual")).alias("missing"), "logical_sha256")


def pilot_diagnostics(bars_1m: DataFrame, native: dict[int, DataFrame]) -> DataFrame:
    """Local roll-ups against native bars at each step: bars of both, of one side only, and mismatches."""
    out = None
    for step, rows in native.items():
        c = bars.reconcile(bars.roll_up(bars_1m, MINUTE, step), rows)
        n = c.agg(F.count_if(F.col("side") == "both").alias("common"), F.count_if(F.col("side") == "local").alias("local_only"), F.count_if(F.col("side") == "native").alias("native_only"), F.count_if(F.size("differing") > 0).alias("mismatches")).withColumn("step_ms", F.lit(step).cast("long"))
        out = n if out is None else out.unionByName(n)
    return out


def pilot_parts(bars_1m: DataFrame, native: dict[int, DataFrame], done: DataFrame | None = None, most_symbols: int | None = None) -> DataFrame:
    """The pilot by symbol: symbol, step_ms, common, local_only, native_only, mismatches and the logical hash of the symbol's own bars. Symbols that ``done`` has
    are passed over, so a run that was stopped after ``most_symbols`` (in order) goes on with the others."""
    names = bars_1m.select("symbol").distinct()
    if done is not None:
        names = names.join(done.select("symbol").distinct(), "symbol", "left_anti")
    if most_symbols is not None:
        names = names.orderBy("symbol").limit(most_symbols)
    names = cut(names)
    own, out = bars_1m.join(names, "symbol", "left_semi"), None
    for step, rows in native.items():
        c = bars.reconcile(bars.roll_up(own, MINUTE, step), rows.join(names, "symbol", "left_semi"))
        n = c.groupBy("symbol").agg(F.count_if(F.col("side") == "both").alias("common"), F.count_if(F.col("side") == "local").alias("local_only"), F.count_if(F.col("side") == "native").alias("native_only"), F.count_if(F.size("differing") > 0).alias("mismatches"))
        n = names.join(n, "symbol", "left").select("symbol", F.lit(step).cast("long").alias("step_ms"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("common", "local_only", "native_only", "mismatches")))
        out = n if out is None else out.unionByName(n)
    return out.join(logical_hash(own, ["symbol"]).select("symbol", "logical_sha256"), "symbol", "left")


def compare(a: DataFrame, b: DataFrame, hashes: tuple[str, ...] = ("logical_sha256",)) -> tuple[DataFrame, int]:
    """Agreement of two runs' manifests per partition, and the exit code."""
    flags = audit.compare_runs(a, b, list(hashes), ["symbol", "month"])
    audit.same_partitions(a, b, ["symbol", "month"])
    equal = audit.compared(flags).first()[f"all_{hashes[0]}_equal"]
    return flags, DONE if equal else DRIFT


def funding_mark_pilot(events: DataFrame, marks_60m: DataFrame, marks_1m: DataFrame) -> tuple[DataFrame, int]:
    """Valued events of short-cadence symbols, and whether the gate passes."""
    valued = funding.value_events(events, marks_60m, marks_1m, denominator=1)
    per = valued.groupBy("symbol").agg(F.bool_and(~F.col("hour_aligned") | F.col("sample_match").isNotNull()).alias("complete"), F.bool_and(F.coalesce("sample_match", F.lit(True))).alias("all_equal"))
    passed = funding.cadence_gate(events, per).first()["passed"]
    return valued, DONE if passed else GATE_FAILED
