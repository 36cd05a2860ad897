"""Queries over the data sources (pages written in two phases, scans that ask for pages by window) and over streams with kept state."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.timeops import DAY, HOUR, MINUTE
from .more_queries import bar_bodies, spark_of
from .operators import audit, bars, funding, indicators, inventory
from .plans import runs
from .queries import EMA, ORACLE_SQL, QUARTER, SHOWN, TAPE, Y2024, _funding_events, bars_sql, query, scratch, seg_sql, shown, tape
from .sources import canonical, page_scan, page_store, responses, store
from .streaming import chains, decisions


def bar_pages(t) -> DataFrame:
    """A page of a page store for each symbol and day."""
    start = F.col("day") * DAY
    key = F.sha2(F.concat_ws(":", "symbol", F.col("day").cast("string")), 256)
    return bar_bodies(t, bars.FIELDS).select(
        "symbol", F.lit("bars").alias("stream"), key.alias("request_key"), start.alias("range_start_ms"), (start + DAY - QUARTER).alias("range_end_ms"), F.encode("body", "UTF-8").alias("raw"),
    )


def parsed(pages: DataFrame) -> DataFrame:
    return responses.bars(pages.where("raw IS NOT NULL").select(F.col("raw").cast("string").alias("body")))


def _scan(t) -> DataFrame:
    spark, path = spark_of(t), f"{scratch(spark_of(t))}/pages"
    page_store.append(bar_pages(t), path)
    page_scan.register(spark)
    pages = spark.read.format("page_store").load(path)
    ranges = pages.groupBy("symbol").agg(F.min("range_start_ms").alias("from_ms"), (F.max("range_end_ms") + QUARTER).alias("to_ms"))
    options = {"bodies": path, "ranges": page_scan.plan_of(ranges), "step_ms": str(QUARTER), "page_size": str(DAY // QUARTER), "per_second": "0"}
    return spark.read.format("page_scan").options(**options).load()


@query(f"WITH {TAPE}, {bars_sql(QUARTER)} SELECT {SHOWN} FROM b")
def q83c_scanned_pages(t):
    return shown(parsed(_scan(t)))


@query(f"WITH {TAPE}, {bars_sql(QUARTER)}, m AS (SELECT arg_min(start_ms, start_ms) AS least FROM b) SELECT {SHOWN} FROM b, m WHERE symbol > 'p' AND start_ms >= least - least % {DAY} + {3 * DAY}")
def q83d_scan_with_filters(t):
    """Only the windows that the filters leave are asked for."""
    least = bars.tape_to_bars(tape(t), QUARTER).agg(F.min("start_ms")).first()[0]
    return shown(parsed(_scan(t).where((F.col("symbol") > "p") & (F.col("range_start_ms") >= least - least % DAY + 3 * DAY))))


@query(f"WITH {TAPE}, {bars_sql(QUARTER)} SELECT {SHOWN} FROM b")
def q89c_two_phase_writes(t):
    """Two commits, and a job between them that writes other bodies and fails: the store holds what the commits wrote."""
    spark, path = spark_of(t), f"{scratch(spark_of(t))}/pages"
    pages = bar_pages(t).withColumn("part", F.pmod(F.floor(F.col("range_start_ms") / DAY), F.lit(2)))
    page_store.append(pages.where("part = 0"), path)
    bad = F.when(F.col("raw").isNotNull(), F.raise_error(F.lit("the task is lost"))).cast("binary")
    broken = pages.withColumn("raw", F.when(F.col("range_start_ms") % (3 * DAY) == 0, bad).otherwise(F.encode(F.lit("{}"), "UTF-8")))
    try:
        broken.select(*page_store.COLUMNS).write.format("page_store").mode("append").save(path)
    except PySparkException:
        pass
    page_store.append(pages.where("part = 1"), path)
    return shown(parsed(spark.read.format("page_store").load(path)))


@query(f"WITH {TAPE}, {bars_sql(QUARTER)}, d AS (SELECT DISTINCT symbol, start_ms - start_ms % {DAY} AS day FROM b), r AS (SELECT symbol, min(day) AS a, max(day) AS z FROM d GROUP BY symbol), w AS (SELECT symbol, unnest(generate_series(a, z, {DAY})) AS start_ms FROM r) SELECT symbol, start_ms, start_ms + {DAY - QUARTER} AS end_ms, (row_number() OVER (ORDER BY symbol, start_ms) - 1) / 10.0::DOUBLE AS start_s FROM w")
def q82d_scan_schedule(t):
    own = bars.tape_to_bars(tape(t), QUARTER).withColumn("day", F.col("start_ms") - F.col("start_ms") % DAY)
    ranges = own.groupBy("symbol").agg(F.min("day").alias("from_ms"), (F.max("day") + DAY).alias("to_ms"))
    return page_scan.schedule(ranges, QUARTER, DAY // QUARTER)


#: EMA over 5 and ATR over 3 bars, whole, by symbol and start.
CHAINS = f"""{EMA}, t0 AS (SELECT *, lag(close) OVER (PARTITION BY symbol, segment ORDER BY start_ms) AS pc FROM g),
tn AS (SELECT *, row_number() OVER (PARTITION BY symbol, segment ORDER BY start_ms) AS k, CAST(greatest(high - low, abs(high - pc), abs(low - pc)) AS DOUBLE) AS x FROM t0 WHERE pc IS NOT NULL),
atr AS (SELECT symbol, segment, 3 AS k, list_sum(list(x ORDER BY k)) / 3 AS m FROM tn WHERE k <= 3 GROUP BY symbol, segment HAVING count(*) = 3
UNION ALL SELECT tn.symbol, tn.segment, tn.k::INTEGER, (atr.m * 2 + tn.x) / 3 FROM atr JOIN tn ON tn.symbol = atr.symbol AND tn.segment = atr.segment AND tn.k = atr.k + 1),
chains AS (SELECT n.symbol, n.start_ms, n.k, n.x, round(ema.m, 6) AS ema, round(atr.m, 6) AS atr FROM n LEFT JOIN ema ON ema.symbol = n.symbol AND ema.segment = n.segment AND ema.k = n.k
LEFT JOIN tn ON tn.symbol = n.symbol AND tn.start_ms = n.start_ms LEFT JOIN atr ON atr.symbol = n.symbol AND atr.segment = n.segment AND atr.k = tn.k)"""
MIDDLE = Y2024 + 15 * DAY


def _hours(t) -> DataFrame:
    return bars.tape_to_bars(tape(t), HOUR).select("symbol", "start_ms", "high", "low", "close", "volume")


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.select("symbol", "start_ms", F.round("ema", 6).alias("ema"), F.round("atr", 6).alias("atr"))


def _two_runs(t) -> str:
    """Both chains over the tape in two runs, the second one from the first one's checkpoint; the folder of output and state."""
    b, spark, path = _hours(t), spark_of(t), scratch(spark_of(t))
    for part in (F.col("start_ms") < MIDDLE, F.col("start_ms") >= MIDDLE):
        b.where(part).write.mode("append").parquet(f"{path}/in")
        decisions.drain(chains.chains(spark.readStream.schema(b.schema).parquet(f"{path}/in"), HOUR, 5, 3), f"{path}/out", f"{path}/state")
    return path


@query(f"WITH RECURSIVE {CHAINS} SELECT symbol, start_ms, ema, atr FROM chains")
def q60d_streamed_chains(t):
    """The stream is stopped in the middle, and goes on from its state."""
    return _rounded(spark_of(t).read.parquet(f"{_two_runs(t)}/out"))


@query(f"WITH RECURSIVE {CHAINS} SELECT symbol, max(start_ms) AS last_ms, arg_max(x, start_ms) AS last_close, arg_max(k, start_ms) AS n, arg_max(struct_pack(v := ema), start_ms).v AS ema, arg_max(struct_pack(v := atr), start_ms).v AS atr FROM chains GROUP BY symbol")
def q60e_chain_state(t):
    """The state of the stopped stream, read as a table."""
    state = chains.stored_state(spark_of(t), f"{_two_runs(t)}/state")
    return state.select("symbol", "last_ms", "last_close", "n", F.round("ema", 6).alias("ema"), F.round("atr", 6).alias("atr"))


@query(f"WITH RECURSIVE {CHAINS} SELECT symbol, start_ms, ema, atr FROM chains WHERE start_ms >= {MIDDLE}")
def q60f_chains_from_a_batch(t):
    """The first half is history, whose last state by the batch forms is where the stream begins."""
    b, spark, path = _hours(t), spark_of(t), scratch(spark_of(t))
    b.where(F.col("start_ms") >= MIDDLE).write.parquet(f"{path}/in")
    start = chains.last_state(b.where(F.col("start_ms") < MIDDLE), HOUR, 5, 3)
    decisions.drain(chains.chains(spark.readStream.schema(b.schema).parquet(f"{path}/in"), HOUR, 5, 3, start), f"{path}/out", f"{path}/state")
    return _rounded(spark.read.parquet(f"{path}/out"))


@query(f"WITH RECURSIVE {TAPE}, {bars_sql(HOUR)}, {seg_sql('b', HOUR)}, s AS (SELECT symbol, segment, max(start_ms) AS last_ms, count(*) AS n, CAST(max(high) AS VARCHAR) AS high, CAST(min(low) AS VARCHAR) AS low, CAST(sum(volume) AS BIGINT) AS volume FROM g GROUP BY ALL) SELECT * FROM s WHERE last_ms + {HOUR + 1} <= (SELECT max(start_ms) FROM b) - {HOUR}")
def q60g_streamed_segments(t):
    """Every bar comes twice; segments come once the watermark has passed their end."""
    b, spark, path = _hours(t), spark_of(t), scratch(spark_of(t))
    b.unionByName(b).write.parquet(f"{path}/in")
    decisions.drain(chains.streamed_segments(spark.readStream.schema(b.schema).parquet(f"{path}/in"), HOUR), f"{path}/out", f"{path}/state")
    return spark.read.parquet(f"{path}/out").select("symbol", "segment", "last_ms", "n", F.col("high").cast("string").alias("high"), F.col("low").cast("string").alias("low"), F.col("volume").cast("long").alias("volume"))


@query(ORACLE_SQL["q31_funding_mark_fallback"])
def q31c_marks_of_canonical_tables(t):
    """The marks are written as canonical tables, opened again, and joined where they lie."""
    spark, path, marks = spark_of(t), scratch(spark_of(t)), {}
    for step in (HOUR, MINUTE):
        b = bars.tape_to_bars(tape(t), step)
        canonical.write(b, f"{path}/{step}", 8)
        marks[step] = canonical.open_table(spark, f"{path}/{step}", b.schema, 8)
    v = funding.value_events(_funding_events(t), marks[HOUR], marks[MINUTE], 2)
    return v.select("symbol", "ts_ms", F.col("mark_price").cast("string").alias("mark_price"), "mark_source", "mark_approximate", "hour_aligned", "sampled_exact_1m", "sample_match")


@query(ORACLE_SQL["q04_rollup_vs_native_daily"])
def q04c_reconcile_canonical_tables(t):
    path = scratch(spark_of(t))
    local = canonical.write(bars.roll_up(bars.tape_to_bars(tape(t), HOUR), HOUR, DAY), f"{path}/local", 8)
    native = canonical.write(bars.tape_to_bars(tape(t), DAY), f"{path}/native", 8)
    return bars.reconcile(local, native).withColumn("differing", F.array_join("differing", ","))


@query("WITH names AS (SELECT DISTINCT split_part(text, ' ', 1) AS name FROM documents WHERE split_part(text, ' ', 1) <> '') SELECT doc_id, name FROM documents JOIN names ON contains(text, name)")
def q35b_names_in_texts(t):
    """The first word of every document, wherever it occurs in any."""
    docs = t("documents").where("text IS NOT NULL")
    names = docs.select(F.split("text", " ")[0].alias("name")).where("name <> ''").distinct()
    return inventory.names_in_texts(docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")), names).select(F.col("_id").alias("doc_id"), "name")


@query(f"""WITH RECURSIVE {TAPE}, c AS (SELECT symbol, t - t % {DAY} AS p, CASE WHEN t < {MIDDLE} THEN CAST(px * 100 AS BIGINT) ELSE CAST(px * 100 AS BIGINT) - CAST(px * 100 AS BIGINT) % 5 END AS u FROM tape),
v AS (SELECT * FROM c WHERE u > 0), k AS (SELECT DISTINCT symbol, p, u FROM v),
per AS (SELECT symbol, p, list_reduce(list(u ORDER BY u), lambda a, b: gcd(a, b)) AS g, count(*) AS k, row_number() OVER (PARTITION BY symbol ORDER BY p) AS i FROM k GROUP BY symbol, p),
f AS (SELECT symbol, i, p, 1 AS regime, g::BIGINT AS g, k::BIGINT AS k FROM per WHERE i = 1 UNION ALL
SELECT symbol, i, p, CASE WHEN brk THEN regime + 1 ELSE regime END, (CASE WHEN brk THEN eg ELSE d END)::BIGINT, (CASE WHEN brk THEN ek ELSE k + ek END)::BIGINT FROM (
SELECT per.symbol, per.i, per.p, regime, f.g, f.k, per.g AS eg, per.k AS ek, gcd(f.g, per.g) AS d, (d = f.g AND per.g > f.g AND per.k * log2(per.g / f.g::DOUBLE) >= 20) OR (d < f.g AND f.k * log2(f.g / d::DOUBLE) >= 20) AS brk FROM f JOIN per ON per.symbol = f.symbol AND per.i = f.i + 1)),
r AS (SELECT symbol, regime, min(p) AS a, max(p) AS z, arg_max(g, i) AS g, arg_max(k, i) AS k FROM f GROUP BY ALL)
SELECT r.symbol, a AS from_ms, z + {DAY} AS to_ms, g AS tick_units, k AS prices, count(*) AS trades, round(count_if(u % g = 0) / count(*), 6) AS on_lattice, round(count_if(u % 5 = 0) / count(*), 6) AS on_declared, round(1 - pow(2.0::DOUBLE, -k), 9) AS confidence
FROM r JOIN v ON v.symbol = r.symbol AND v.p BETWEEN a AND z GROUP BY ALL""")
def q63b_lattice_regimes(t):
    """From the middle of the tape on, prices keep to a lattice of five units; five are declared for the whole of it."""
    cents = (F.col("px") * 100).cast("long")
    coarse = F.when(F.col("t") < MIDDLE, cents).otherwise(cents - cents % 5)
    rows = tape(t).withColumn("px", (coarse / F.lit(100).cast("decimal(10,0)")).cast("decimal(18,2)"))
    return indicators.lattice_regimes(rows, DAY, 2, rows.select("symbol", F.lit(5).cast("long").alias("tick_units")).distinct())


@query(f"""WITH o AS (SELECT DISTINCT 'C' || o_custkey AS symbol, strftime(o_orderdate, '%Y-%m') AS month, epoch_ms(date_trunc('month', o_orderdate)::TIMESTAMP) AS a, epoch_ms(date_trunc('month', o_orderdate)::TIMESTAMP + INTERVAL 1 MONTH) AS z FROM orders),
p AS (SELECT *, a < 852076800000 AND (symbol LIKE '%1' OR a < 825638400000) AS done, z + {DAY} > 852076800000 AS still FROM o)
SELECT symbol, count(*) AS planned, count_if(done) AS completed, count_if(still AND NOT done) AS pending_open, CASE WHEN bool_and(done) THEN 'COMPLETE' WHEN bool_or(still AND NOT done) THEN 'WAITING_FOR_OPEN_PARTITIONS' ELSE 'PARTIAL' END AS status FROM p GROUP BY symbol""")
def q90b_run_status(t):
    """Months of orders as partitions; those before 1997 of some customers, and all of the first two months of 1996 and before, have manifests."""
    day = F.trunc(F.col("o_orderdate").cast("date"), "month")
    begin, end = F.unix_millis(day.cast("timestamp")), F.unix_millis(F.add_months(day, 1).cast("timestamp"))
    tasks = t("orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), F.date_format(day, "yyyy-MM").alias("month"), begin.alias("data_start_ms"), end.alias("data_end_ms"), end.alias("month_end_ms")).distinct()
    done = tasks.where((F.col("data_start_ms") < 852_076_800_000) & (F.col("symbol").endswith("1") | (F.col("data_start_ms") < 825_638_400_000))).withColumn("kind", F.lit("FULL_HISTORICAL"))
    return runs.progress(tasks, done, 852_076_800_000, by=("symbol",))


@query("SELECT 'C' || c_custkey AS symbol, CASE WHEN c_custkey % 3 = 0 THEN 'INTERNAL_ERROR' ELSE 'API_ERROR' END AS classification, CAST((c_custkey % 30) + 1 AS BIGINT) AS missing_expected_count, CASE WHEN c_custkey % 3 = 0 THEN 'KeyError' ELSE 'refused' END AS error FROM customer WHERE c_custkey % 2 = 0")
def q74c_failed_readings(t):
    """Half of all probes fail, some by what nobody foresaw; some fail twice."""
    k = F.col("c_custkey")
    name = F.concat(F.lit("C"), k.cast("string")).alias("symbol")
    probes = t("customer").select(name, F.lit("mid_life").alias("checkpoint"), (k * MINUTE).alias("checkpoint_ms"), (k * MINUTE).alias("start_ms"), ((k + k % 30) * MINUTE).alias("end_ms"))
    faults = t("customer").where(k % 2 == 0).select(name, F.lit("mid_life").alias("checkpoint"), F.when(k % 3 == 0, "KeyError").otherwise("refused").alias("error"), F.when(k % 3 == 0, "INTERNAL_ERROR").alias("kind"))
    return audit.failed_probes(probes, faults.unionByName(faults.where("length(symbol) % 2 = 0"))).select("symbol", "classification", "missing_expected_count", "error")


@query(f"WITH {TAPE}, {bars_sql(QUARTER)} SELECT symbol, min(start_ms) AS first_trade_ms FROM b GROUP BY symbol")
def q40b_first_trade_of_files(t):
    """From the footers of a canonical table's files."""
    spark, path = spark_of(t), f"{scratch(spark_of(t))}/bars"
    b = bars.tape_to_bars(tape(t), QUARTER).drop("trades").withColumn("month", F.date_format(F.timestamp_millis("start_ms"), "yyyy-MM"))
    store.write_bars(b, path)
    return store.first_starts(spark, path, b.schema)
