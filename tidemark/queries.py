"""Queries over the driver's tables, one or more per operator, with the SQL that must give the same rows.

The tables hold no market data, so inputs are derived: an event type is a symbol, an event a trade, orders and customers
give lifetimes and instruments. Money leaves as text of a fixed scale, times as milliseconds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import decimals, hashing, timeops
from .functions.shared import shared_dir
from .functions.timeops import DAY, HOUR, MINUTE
from .operators import asof, audit, bars, funding, indicators, inventory, plan, replay, strategy, validation
from .streaming import decisions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
QUARTER = 15 * MINUTE
#: 2024-01-01 and 1996-01-01 in milliseconds.
Y2024, Y1996, Y1999 = 1_704_067_200_000, 820_454_400_000, 915_148_800_000


def query(sql: str | None = None):
    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark-{spark.sparkContext.applicationId}/query-{uuid.uuid4().hex}"


def text(c: Column | str, scale: int = 2) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal(38,{scale})").cast("string")


def ms(c: str) -> Column:
    return timeops.utc_ms(F.col(c))


def tape(t) -> DataFrame:
    return t("events").select(F.col("event_type").alias("symbol"), ms("ts").alias("t"), F.col("value").cast("decimal(18,2)").alias("px"), F.get_json_object("props", "$.k").cast("int").alias("qty"), F.col("event_id").alias("seq"))


def shown(b: DataFrame) -> DataFrame:
    return b.select("symbol", "start_ms", *(text(c).alias(c) for c in ("open", "high", "low", "close", "turnover")), F.col("volume").cast("long").alias("volume"))


TAPE = "tape AS (SELECT event_type AS symbol, (epoch_us(ts) // 1000) AS t, CAST(value AS DECIMAL(18,2)) AS px, CAST(json_extract_string(props, '$.k') AS INTEGER) AS qty, event_id AS seq FROM events)"
SHOWN = "symbol, start_ms, CAST(CAST(open AS DECIMAL(38,2)) AS VARCHAR) AS open, CAST(CAST(high AS DECIMAL(38,2)) AS VARCHAR) AS high, CAST(CAST(low AS DECIMAL(38,2)) AS VARCHAR) AS low, CAST(CAST(close AS DECIMAL(38,2)) AS VARCHAR) AS close, CAST(CAST(turnover AS DECIMAL(38,2)) AS VARCHAR) AS turnover, CAST(volume AS BIGINT) AS volume"


def bars_sql(step: int, name: str = "b") -> str:
    return f"{name} AS (SELECT symbol, t - t % {step} AS start_ms, arg_min(px, (t, seq)) AS open, max(px) AS high, min(px) AS low, arg_max(px, (t, seq)) AS close, sum(qty) AS volume, sum(px * qty) AS turnover, count(*) AS trades FROM tape GROUP BY ALL)"


def roll_sql(source: str, a: int, b: int, name: str = "r") -> str:
    return f"{name} AS (SELECT symbol, start_ms - start_ms % {b} AS bucket, arg_min(open, start_ms) AS open, max(high) AS high, min(low) AS low, arg_max(close, start_ms) AS close, sum(volume) AS volume, sum(turnover) AS turnover FROM {source} GROUP BY ALL HAVING count(*) = {b // a} AND min(start_ms) = min(start_ms - start_ms % {b}) AND max(start_ms) = min(start_ms - start_ms % {b}) + {b - a})"


def seg_sql(source: str, step: int, name: str = "g") -> str:
    return f"{name} AS (SELECT *, last_value(CASE WHEN brk THEN start_ms END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY start_ms ROWS UNBOUNDED PRECEDING) AS segment FROM (SELECT *, coalesce(start_ms <> lag(start_ms) OVER (PARTITION BY symbol ORDER BY start_ms) + {step}, true) AS brk FROM {source}))"


@query(f"WITH {TAPE}, {bars_sql(MINUTE)} SELECT {SHOWN} FROM b")
def q01_tape_bars_1m(t):
    return shown(bars.tape_to_bars(tape(t), MINUTE))


@query(f"WITH {TAPE}, {bars_sql(4 * HOUR)}, {roll_sql('b', 4 * HOUR, DAY)} SELECT {SHOWN} FROM (SELECT *, bucket AS start_ms FROM r)")
def q02_rollup_4h_to_1d_complete(t):
    return shown(bars.roll_up(bars.tape_to_bars(tape(t), 4 * HOUR), 4 * HOUR, DAY))


@query(f"WITH {TAPE}, {bars_sql(HOUR)}, {roll_sql('b', HOUR, DAY)} SELECT {SHOWN} FROM (SELECT *, bucket AS start_ms FROM r)")
def q03_rollup_1h_to_1d_complete(t):
    return shown(bars.roll_up(bars.tape_to_bars(tape(t), HOUR), HOUR, DAY))


@query(f"""WITH {TAPE}, {bars_sql(HOUR)}, {roll_sql('b', HOUR, DAY)}, {bars_sql(DAY, 'n')}
SELECT coalesce(r.symbol, n.symbol) AS symbol, coalesce(bucket, start_ms) AS start_ms, CASE WHEN bucket IS NULL THEN 'native' WHEN start_ms IS NULL THEN 'local' ELSE 'both' END AS side,
CASE WHEN bucket IS NULL OR start_ms IS NULL THEN '' ELSE array_to_string(list_filter([CASE WHEN r.open <> n.open THEN 'open' END, CASE WHEN r.high <> n.high THEN 'high' END, CASE WHEN r.low <> n.low THEN 'low' END, CASE WHEN r.close <> n.close THEN 'close' END, CASE WHEN r.volume <> n.volume THEN 'volume' END, CASE WHEN r.turnover <> n.turnover THEN 'turnover' END], lambda x: x IS NOT NULL), ',') END AS differing
FROM r FULL JOIN n ON r.symbol = n.symbol AND r.bucket = n.start_ms""")
def q04_rollup_vs_native_daily(t):
    local = bars.roll_up(bars.tape_to_bars(tape(t), HOUR), HOUR, DAY)
    return bars.reconcile(local, bars.tape_to_bars(tape(t), DAY)).withColumn("differing", F.array_join("differing", ","))


@query(f"WITH {TAPE}, {bars_sql(QUARTER)} SELECT symbol, expected_ms, start_ms AS actual_ms FROM (SELECT symbol, start_ms, lag(start_ms) OVER (PARTITION BY symbol ORDER BY start_ms) + {QUARTER} AS expected_ms FROM b) WHERE expected_ms <> start_ms")
def q05_gap_list(t):
    return bars.gaps(bars.tape_to_bars(tape(t), QUARTER), QUARTER)


@query(f"WITH {TAPE}, {bars_sql(QUARTER)}, s AS (SELECT symbol, unnest(generate_series(min(start_ms), max(start_ms), {QUARTER})) AS start_ms FROM b GROUP BY symbol) SELECT symbol, start_ms FROM s ANTI JOIN b USING (symbol, start_ms)")
def q06_missing_slots(t):
    b = bars.tape_to_bars(tape(t), QUARTER)
    ranges = b.groupBy("symbol").agg(F.min("start_ms").alias("from_ms"), (F.max("start_ms") + QUARTER).alias("to_ms"))
    return bars.missing_slots(b, ranges, QUARTER)


@query(f"""WITH {TAPE}, {bars_sql(QUARTER)},
days AS (SELECT DISTINCT symbol, start_ms - start_ms % {DAY} AS d FROM b UNION SELECT DISTINCT symbol, {Y2024 - 2 * DAY} FROM b),
slots AS (SELECT symbol, d, unnest(generate_series(d, d + {DAY - QUARTER}, {QUARTER})) AS slot FROM days),
j AS (SELECT s.*, b.start_ms IS NOT NULL AS seen FROM slots s LEFT JOIN b ON b.symbol = s.symbol AND b.start_ms = s.slot),
k AS (SELECT *, seen AND coalesce(max(CASE WHEN seen THEN slot END) OVER (PARTITION BY symbol, d ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <> slot - {QUARTER}, false) AS gap FROM j),
a AS (SELECT symbol, d, count(*) AS e, count_if(seen) AS c, count_if(gap) AS g, bool_or(slot = d AND NOT seen) AS ms, bool_or(slot = d + {DAY - QUARTER} AND NOT seen) AS me FROM k GROUP BY ALL)
SELECT symbol, 'day' AS checkpoint, d + {DAY // 2} AS checkpoint_ms, d AS window_start_ms, d + {DAY - QUARTER} AS window_end_ms, e AS expected_count, CAST(c AS BIGINT) AS candle_count, CAST(g AS BIGINT) AS gap_count, ms AS missing_at_start, me AS missing_at_end, CAST(e - c AS BIGINT) AS missing_expected_count,
CASE WHEN c = 0 THEN CASE WHEN d + {DAY // 2} < {Y2024 - DAY} THEN 'BEFORE_LAUNCH' WHEN d + {DAY // 2} < {Y2024} THEN 'BEFORE_FIRST_TRADE' ELSE 'EMPTY_DURING_LIFETIME' END WHEN e = c AND g = 0 THEN 'DATA_PRESENT' ELSE 'PARTIAL_DATA' END AS classification,
CAST(round_even(CAST(100 * c AS DECIMAL(30,12)) / e, 3)::DECIMAL(20,3) AS VARCHAR) AS coverage_pct FROM a""")
def q07_coverage_by_window(t):
    b = bars.tape_to_bars(tape(t), QUARTER)
    day = b.select("symbol", timeops.align_down(F.col("start_ms"), DAY).alias("start_ms")).union(b.select("symbol", F.lit(Y2024 - 2 * DAY))).distinct()
    probes = day.select("symbol", F.lit("day").alias("checkpoint"), (F.col("start_ms") + DAY // 2).alias("checkpoint_ms"), "start_ms", (F.col("start_ms") + DAY - QUARTER).alias("end_ms"), F.lit(Y2024 - DAY).alias("launch_ms"), F.lit(Y2024).alias("first_trade_ms"), F.lit(0).cast("long").alias("delivery_ms"))
    return audit.coverage(probes, b, QUARTER)


def _life(t) -> DataFrame:
    """Lifetimes of customers: launch, first order, delivery."""
    first = t("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.min(ms("o_orderdate")).alias("first_trade_ms"), F.max(ms("o_orderdate")).alias("last_ms"))
    return first.select("id", F.concat(F.lit("C"), F.col("id").cast("string")).alias("symbol"), (F.lit(Y1996) + (F.col("id") % 700) * DAY).alias("launch_ms"), F.when(F.col("id") % 7 != 0, F.col("first_trade_ms")).alias("first_trade_ms"), F.when(F.col("id") % 3 == 0, F.col("last_ms") + 12_345).otherwise(F.lit(0)).alias("delivery_ms"), (F.col("id") % 5 != 0).alias("eligible"))


LIFE = f"life AS (SELECT o_custkey AS id, 'C' || o_custkey AS symbol, {Y1996} + (o_custkey % 700) * {DAY} AS launch_ms, CASE WHEN o_custkey % 7 <> 0 THEN min(epoch_ms(o_orderdate)) END AS first_trade_ms, CASE WHEN o_custkey % 3 = 0 THEN max(epoch_ms(o_orderdate)) + 12345 ELSE 0 END AS delivery_ms, o_custkey % 5 <> 0 AS eligible FROM orders GROUP BY o_custkey)"


@query(f"""WITH {LIFE} SELECT o_orderkey, CASE WHEN epoch_ms(o_orderdate) < launch_ms THEN 'BEFORE_LAUNCH' WHEN first_trade_ms IS NOT NULL AND epoch_ms(o_orderdate) < first_trade_ms + {100 * DAY} THEN 'BEFORE_FIRST_TRADE'
WHEN delivery_ms > 0 AND epoch_ms(o_orderdate) >= delivery_ms - {200 * DAY} THEN 'AFTER_DELIST' ELSE 'EMPTY_DURING_LIFETIME' END AS classification FROM orders JOIN life ON id = o_custkey""")
def q08_classify_empty_windows(t):
    j = t("orders").join(_life(t), F.col("id") == F.col("o_custkey"))
    ended = F.when(F.col("delivery_ms") > 0, F.col("delivery_ms") - 200 * DAY).otherwise(F.lit(0))
    return j.select("o_orderkey", audit.classify_empty(ms("o_orderdate"), F.col("launch_ms"), F.col("first_trade_ms") + 100 * DAY, ended).alias("classification"))


@query(f"""WITH {LIFE} SELECT id, CASE WHEN first_trade_ms IS NULL THEN 'UNKNOWN' WHEN first_trade_ms - launch_ms >= {365 * DAY} THEN 'PLACEHOLDER_SUSPECTED' ELSE 'OBSERVED_METADATA' END AS quality,
coalesce(first_trade_ms < launch_ms - launch_ms % 60000, false) OR id % 11 = 0 AS conflict, CASE WHEN id % 2 = 0 THEN 'APPLICABLE' ELSE 'NOT_APPLICABLE' END AS funding FROM life""")
def q09_launch_quality_and_conflict(t):
    contract = F.when(F.col("id") % 2 == 0, "LinearPerpetual").otherwise("LinearFutures")
    return _life(t).select("id", audit.launch_quality(F.col("launch_ms"), F.col("first_trade_ms")).alias("quality"), audit.lifetime_conflict(F.col("launch_ms"), F.col("first_trade_ms"), F.col("id") % 11 == 0).alias("conflict"), audit.funding_applicable(contract).alias("funding"))


@query(f"""WITH {LIFE}, d AS (SELECT first_trade_ms - {Y1996 - 365 * DAY} AS x FROM life WHERE first_trade_ms IS NOT NULL), o AS (SELECT x FROM d WHERE x < {365 * DAY})
SELECT (SELECT min(x) FROM d) AS min_all, (SELECT max(x) FROM d) AS max_all, (SELECT count(*) FROM d) AS n_all, (SELECT list_sort(list(x))[count(*) // 2 + 1] FROM d) AS median_all,
(SELECT min(x) FROM o) AS min_observed, (SELECT max(x) FROM o) AS max_observed, (SELECT count(*) FROM o) AS n_observed, (SELECT list_sort(list(x))[count(*) // 2 + 1] FROM o) AS median_observed""")
def q10_launch_delay_stats(t):
    return audit.delay_summary(_life(t).where("first_trade_ms IS NOT NULL").select((F.col("first_trade_ms") - (Y1996 - 365 * DAY)).alias("delay_ms")))


@query("SELECT l_orderkey, l_linenumber, l_partkey, duplicates FROM (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY l_orderkey) - 1 AS duplicates FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)) WHERE rn = 1")
def q11_dedupe_first_wins(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return bars.dedupe_first(rows, ["l_orderkey"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]).select("l_orderkey", "l_linenumber", "l_partkey", "duplicates")


@query("SELECT l_orderkey, count(DISTINCT (l_returnflag, l_linestatus)) AS variants FROM lineitem GROUP BY 1 HAVING variants > 1")
def q12_dedupe_conflicts(t):
    return bars.conflicts(t("lineitem"), ["l_orderkey"], ["l_returnflag", "l_linestatus"])


@query("SELECT DISTINCT event_type AS symbol, CAST(user_id AS VARCHAR) AS ts_text, json_extract_string(props, '$.k') AS rate_text FROM events")
def q13_distinct_events(t):
    rows = t("events").select(F.col("event_type").alias("symbol"), F.col("user_id").cast("string").alias("ts_text"), F.get_json_object("props", "$.k").alias("rate_text"))
    return funding.distinct_events(rows)


@query("""WITH i AS (SELECT c_custkey, c_name AS symbol, CASE WHEN c_nationkey % 4 = 0 THEN 'LinearFutures' ELSE 'LinearPerpetual' END AS contract, CASE c_custkey % 3 WHEN 0 THEN 'Trading' WHEN 1 THEN 'Closed' ELSE 'PendingOpen' END AS status,
CASE c_custkey % 4 WHEN 0 THEN NULL ELSE c_custkey % 4 = 1 END AS pre, CASE WHEN c_nationkey = 7 THEN 'EU' END AS region, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN 'Innovation' ELSE lower(c_mktsegment) END AS kind FROM customer),
e AS (SELECT *, contract = 'LinearPerpetual' AND status IN ('Trading', 'Closed') AND pre IS NOT TRUE AND coalesce(region, '') = '' AND lower(coalesce(kind, '')) IN ('', 'innovation') AS eligible FROM i)
SELECT c_custkey, eligible, eligible OR contains(upper(symbol), 'OLD') OR status NOT IN ('Trading', 'Closed') AS audited FROM e""")
def q14_eligibility_filter(t):
    k, n, seg = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    contract = F.when(n % 4 == 0, "LinearFutures").otherwise("LinearPerpetual")
    status = F.when(k % 3 == 0, "Trading").when(k % 3 == 1, "Closed").otherwise("PendingOpen")
    pre, region = F.when(k % 4 != 0, k % 4 == 1), F.when(n == 7, "EU")
    kind = F.when(seg == "MACHINERY", "Innovation").when(seg != "BUILDING", F.lower(seg))
    ok = inventory.eligible(contract, F.lit("USDT"), F.lit("USDT"), status, pre, region, kind)
    return t("customer").select("c_custkey", ok.alias("eligible"), inventory.audit_candidate(ok, F.col("c_name"), status).alias("audited"))


@query("SELECT s AS o_orderstatus, count(o_orderkey) AS n FROM (VALUES ('O'), ('F'), ('P'), ('X')) d(s) LEFT JOIN orders ON o_orderstatus = s GROUP BY s")
def q15_status_counts_with_zeros(t):
    rows = t("orders")
    return inventory.counts_with_zeros(rows, rows.sparkSession.createDataFrame([(s,) for s in "OFPX"], "o_orderstatus string"), "o_orderstatus")


@query(f"WITH {TAPE}, {bars_sql(QUARTER)} SELECT symbol, count_if(start_ms + {QUARTER} <= {Y2024 + 10 * DAY + 1}) AS kept, count_if(start_ms + {QUARTER} > {Y2024 + 10 * DAY + 1}) AS unfinished, max(start_ms) FILTER (start_ms + {QUARTER} <= {Y2024 + 10 * DAY + 1}) AS newest FROM b GROUP BY symbol")
def q16_unfinished_filter(t):
    b, now = bars.tape_to_bars(tape(t), QUARTER), Y2024 + 10 * DAY + 1
    kept = bars.finished(b, QUARTER, now).groupBy("symbol").agg(F.count("*").alias("kept"), F.max("start_ms").alias("newest"))
    return kept.join(b.groupBy("symbol").agg(F.count_if(~timeops.is_closed(F.col("start_ms"), QUARTER, now)).alias("unfinished")), "symbol").select("symbol", "kept", "unfinished", "newest")


@query(f"SELECT event_id, x - ((x % s) + s) % s AS aligned, x - ((x % s) + s) % s + s AS close_ms, x % s = 0 AS on_grid FROM (SELECT event_id, (epoch_us(ts) // 1000) - {Y2024 + 15 * DAY} AS x, CASE event_id % 3 WHEN 0 THEN 60000 WHEN 1 THEN 900000 ELSE 86400000 END AS s FROM events)")
def q17_align_and_close(t):
    code = F.when(F.col("event_id") % 3 == 0, "1").when(F.col("event_id") % 3 == 1, "15").otherwise("D")
    rows = t("events").select("event_id", (ms("ts") - (Y2024 + 15 * DAY)).alias("x"), timeops.interval_ms(code).alias("s"))
    down = timeops.align_down(F.col("x"), F.col("s"))
    return rows.select("event_id", down.alias("aligned"), timeops.close_ms(down, F.col("s")).alias("close_ms"), timeops.is_aligned(F.col("x"), F.col("s")).alias("on_grid"))


@query("""WITH e AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, epoch_ms(o_orderdate) + (o_orderkey % 1440) * 60000 AS c FROM orders),
s AS (SELECT *, epoch_ms(timezone('Europe/Amsterdam', d + TIME '09:00:00')) AS e0, epoch_ms(timezone('Europe/Amsterdam', d + TIME '12:00:00')) AS e1, epoch_ms(timezone('America/New_York', d + TIME '08:30:00')) AS u0, epoch_ms(timezone('America/New_York', d + TIME '13:00:00')) AS u1 FROM e)
SELECT o_orderkey, c >= e0 AND c < e1 AS in_eu, c >= u0 AND c < u1 AS in_us, c < e0 AS before_cutoff, e0 AS eu_start_ms, u0 AS us_start_ms FROM s""")
def q18_session_membership(t):
    rows = t("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), (ms("o_orderdate") + (F.col("o_orderkey") % 1440) * MINUTE).alias("c"))
    d, c = F.col("d"), F.col("c")
    return rows.select("o_orderkey", timeops.in_session(c, d, "EU").alias("in_eu"), timeops.in_session(c, d, "US").alias("in_us"), (c < timeops.universe_cutoff(d)).alias("before_cutoff"), timeops.session_bounds(d, "EU")[0].alias("eu_start_ms"), timeops.session_bounds(d, "US")[0].alias("us_start_ms"))


@query("SELECT epoch_ms(date_trunc('week', o_orderdate)::TIMESTAMP) AS week_ms, count(*) AS n FROM orders GROUP BY 1")
def q19_week_bucket_monday(t):
    return t("orders").groupBy(timeops.week_start_ms(ms("o_orderdate")).alias("week_ms")).agg(F.count("*").alias("n"))


PLAN = f"""{LIFE}, alive AS (SELECT *, greatest({Y1996}, first_trade_ms) AS a, least({Y1999}, CASE WHEN delivery_ms <= 0 THEN {Y1999} WHEN delivery_ms % 60000 = 0 THEN delivery_ms ELSE delivery_ms - delivery_ms % 60000 + 60000 END) AS z FROM life WHERE eligible AND first_trade_ms IS NOT NULL),
months AS (SELECT strftime(m, '%Y-%m') AS month, epoch_ms(m) AS m0, epoch_ms(m + INTERVAL 1 MONTH) AS m1 FROM (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1998-12-01', INTERVAL 1 MONTH)) AS m)),
tasks AS (SELECT id, symbol, month, m0 AS month_start_ms, m1 AS month_end_ms, greatest(a, m0) AS data_start_ms, least(z, m1) AS data_end_ms, delivery_ms FROM alive JOIN months ON greatest(a, m0) < least(z, m1))"""


@query(f"WITH {PLAN} SELECT symbol, month, month_start_ms, month_end_ms, data_start_ms, data_end_ms, delivery_ms FROM tasks")
def q20_month_plan(t):
    return plan.partition_plan(_life(t), Y1996, Y1999)


@query("""WITH m AS (SELECT DISTINCT date_trunc('month', o_orderdate)::TIMESTAMP AS m FROM orders), r AS (SELECT epoch_ms(m) AS a, epoch_ms(m + INTERVAL 1 MONTH) - 60000 AS z FROM m), s AS (SELECT z, unnest(generate_series(a, z, 60000000)) AS s FROM r)
SELECT s AS start_ms, least(s + 59940000, z) AS end_ms FROM s""")
def q21_page_windows(t):
    """Of every month with orders."""
    month = t("orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("m")).distinct()
    return month.select(F.explode(timeops.page_windows(timeops.month_start_ms(F.col("m")), timeops.month_end_ms(F.col("m")), MINUTE)).alias("w")).select("w.*")


@query("SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month, CASE WHEN 915235200000 >= epoch_ms(date_trunc('month', o_orderdate)::TIMESTAMP + INTERVAL 1 MONTH) + 86400000 THEN 'SEALED' ELSE 'OPEN' END AS status FROM orders")
def q22_seal_status(t):
    months = t("orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()
    return months.select("month", plan.seal_status(timeops.month_end_ms(F.col("month")), Y1999 + DAY).alias("status"))


@query(f"WITH {PLAN} SELECT symbol, month, data_start_ms, data_end_ms FROM tasks WHERE NOT (id % 4 = 1 AND substr(month, 6) <> '07')")
def q23_remaining_partitions(t):
    p = plan.partition_plan(_life(t), Y1996, Y1999)
    number = F.substring("symbol", 2, 20).cast("long")
    done = p.where(number % 4 == 1).select(F.lit("FULL_HISTORICAL").alias("kind"), "symbol", "month", "data_start_ms", (F.col("data_end_ms") - (F.substring("month", 6, 2) == "07").cast("long")).alias("data_end_ms"))
    return plan.remaining(p, done).select("symbol", "month", "data_start_ms", "data_end_ms")


@query("""WITH p AS (SELECT p_partkey, CAST(p_retailprice AS DECIMAL(28,12)) AS v, CAST((p_size % 7 + 1) AS DECIMAL(28,12)) / 100 AS s0 FROM part), q AS (SELECT p_partkey, v, CAST(s0 AS DECIMAL(18,12)) AS s FROM p)
SELECT p_partkey, CAST(CAST(v - v % s AS DECIMAL(38,12)) AS VARCHAR) AS lo, CAST(CAST(CASE WHEN v % s = 0 THEN v ELSE v - v % s + s END AS DECIMAL(38,12)) AS VARCHAR) AS hi FROM q""")
def q24_floor_ceil_to_step(t):
    step = ((F.col("p_size") % 7 + 1).cast("decimal(28,12)") / 100).cast(decimals.GRID)
    v = F.col("p_retailprice").cast(decimals.GRID)
    return t("part").select("p_partkey", text(decimals.floor_to_step(v, step), 12).alias("lo"), text(decimals.ceil_to_step(v, step), 12).alias("hi"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS VARCHAR) AS price, CAST(CAST(CAST(l_discount AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS VARCHAR) AS discount, CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 10000000000 AS DECIMAL(38,0)) AS VARCHAR) AS scaled FROM lineitem")
def q25_canonical_decimal_text(t):
    p = F.col("l_extendedprice").cast("decimal(18,2)")
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", decimals.canonical_text(p).alias("price"), decimals.canonical_text(decimals.stored(F.col("l_discount").cast("string"))).alias("discount"), decimals.scaled_int(p).cast("string").alias("scaled"))


_LINE = "symbol || chr(9) || start_ms || chr(9) || " + " || chr(9) || ".join(f"CAST(CAST({c} AS DECIMAL(38,18)) AS VARCHAR)" for c in hashing.PRICES) + " || chr(10)"


@query(f"WITH {TAPE}, {bars_sql(QUARTER)} SELECT symbol, start_ms // {DAY} AS day, sha256(string_agg({_LINE}, '' ORDER BY start_ms)) AS logical_sha256, count(*) AS row_count FROM b GROUP BY symbol, start_ms // {DAY}")
def q26_logical_hash_per_partition(t):
    b = bars.tape_to_bars(tape(t), QUARTER).withColumn("day", F.floor(F.col("start_ms") / DAY))
    return hashing.logical_hash(b, ["symbol", "day"])


@query("""SELECT n_nationkey, sha256('/market/bars' || chr(10) || '{"limit":"1000","symbol":"' || n_name || '"}') AS request_key, sha256('{"method":"GET","params":{"limit":"1000","symbol":"' || n_name || '"},"path":"/market/bars","url":"https://host","version":"1"}') AS cache_key FROM nation""")
def q27_request_key_hash(t):
    params = F.create_map(F.lit("symbol"), F.col("n_name"), F.lit("limit"), F.lit("1000"))
    return t("nation").select("n_nationkey", hashing.request_key(F.lit("/market/bars"), params).alias("request_key"), hashing.cache_key(F.lit("https://host"), F.lit("GET"), F.lit("/market/bars"), params, F.lit("1")).alias("cache_key"))


@query("""SELECT event_id, sha256('{"result":{"a":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '},"retCode":0,"retMsg":"OK"}') AS payload_sha256 FROM events""")
def q28_payload_semantic_hash(t):
    body = F.concat(F.lit('{"time": '), ms("ts").cast("string"), F.lit(', "retMsg": "OK", "result": {"k": '), F.get_json_object("props", "$.k"), F.lit(', "a": "'), F.col("event_type"), F.lit('"}, "retCode": 0}'))
    return t("events").select("event_id", hashing.payload_hash(body).alias("payload_sha256"))


@query("SELECT event_id FROM events WHERE CAST('0x' || substr(sha256(event_type || ':' || (epoch_us(ts) // 1000)), 1, 16) AS UBIGINT) % 100 = 0")
def q29_deterministic_sample(t):
    return t("events").where(hashing.sample_1_in(F.col("event_type"), ms("ts"))).select("event_id")


def _funding_events(t) -> DataFrame:
    at = F.when(F.col("seq") % 2 == 0, timeops.align_down(F.col("t"), HOUR)).otherwise(timeops.align_down(F.col("t"), MINUTE))
    return tape(t).select("symbol", at.alias("ts_ms")).distinct()


FUND = f"f AS (SELECT DISTINCT symbol, CASE WHEN seq % 2 = 0 THEN t - t % {HOUR} ELSE t - t % 60000 END AS ts_ms FROM tape)"


@query(f"WITH {TAPE}, {FUND}, g AS (SELECT symbol, (ts_ms - lag(ts_ms) OVER (PARTITION BY symbol ORDER BY ts_ms)) // 60000 AS i FROM f) SELECT symbol, array_to_string(list_sort(list(DISTINCT i) FILTER (i IS NOT NULL)), ',') AS intervals_min, min(i) AS min_interval_min, count(*) AS events FROM g GROUP BY symbol")
def q30_funding_intervals(t):
    return funding.intervals(_funding_events(t)).withColumn("intervals_min", F.array_join(F.col("intervals_min").cast("array<string>"), ","))


VALUED = f"""{TAPE}, {FUND}, {bars_sql(HOUR, 'h')}, {bars_sql(MINUTE, 'm')},
v0 AS (SELECT f.*, ts_ms % {HOUR} = 0 AS hour_aligned, CASE WHEN ts_ms % {HOUR} = 0 THEN h.open END AS h60, m.open AS o1, p.close AS c1 FROM f LEFT JOIN h ON h.symbol = f.symbol AND h.start_ms = ts_ms LEFT JOIN m ON m.symbol = f.symbol AND m.start_ms = ts_ms LEFT JOIN m p ON p.symbol = f.symbol AND p.start_ms = ts_ms - 60000),
v1 AS (SELECT *, NOT hour_aligned OR h60 IS NULL OR CAST('0x' || substr(sha256(symbol || ':' || ts_ms), 1, 16) AS UBIGINT) % 2 = 0 AS s FROM v0), v2 AS (SELECT *, CASE WHEN s THEN o1 END AS x1 FROM v1),
v AS (SELECT *, CASE WHEN h60 IS NOT NULL AND (x1 IS NULL OR h60 = x1) THEN 'MARK_60M_OPEN' WHEN x1 IS NOT NULL THEN 'MARK_1M_OPEN' WHEN c1 IS NOT NULL THEN 'MARK_PRICE_1M_APPROX' ELSE 'MARK_PRICE_MISSING' END AS src FROM v2)"""


@query(f"WITH {VALUED} SELECT symbol, ts_ms, CAST(CASE src WHEN 'MARK_60M_OPEN' THEN h60 WHEN 'MARK_1M_OPEN' THEN x1 WHEN 'MARK_PRICE_1M_APPROX' THEN c1 END AS VARCHAR) AS mark_price, src AS mark_source, src = 'MARK_PRICE_1M_APPROX' AS mark_approximate, hour_aligned, s AS sampled_exact_1m, h60 = x1 AS sample_match FROM v")
def q31_funding_mark_fallback(t):
    v = funding.value_events(_funding_events(t), bars.tape_to_bars(tape(t), HOUR), bars.tape_to_bars(tape(t), MINUTE), 2)
    return v.select("symbol", "ts_ms", F.col("mark_price").cast("string").alias("mark_price"), "mark_source", "mark_approximate", "hour_aligned", "sampled_exact_1m", "sample_match")


@query(f"""WITH {VALUED} SELECT symbol, count(*) AS funding_event_count, count_if(hour_aligned) AS hour_aligned_count, count_if(s) AS exact_1m_checks, count_if(h60 = x1) AS exact_1m_matches, count_if(h60 <> x1) AS exact_1m_mismatches,
count_if(src = 'MARK_PRICE_MISSING') AS missing_mark_count, count_if(src = 'MARK_60M_OPEN') AS canonical_60m_count, count_if(src = 'MARK_1M_OPEN') AS canonical_1m_count, count_if(src = 'MARK_PRICE_1M_APPROX') AS approximate_1m_count, (SELECT count(*) FROM h WHERE h.symbol = v.symbol) AS mark_60m_rows FROM v GROUP BY symbol""")
def q31b_mark_summary(t):
    hours = bars.tape_to_bars(tape(t), HOUR)
    return funding.mark_summary(funding.value_events(_funding_events(t), hours, bars.tape_to_bars(tape(t), MINUTE), 2), hours)


@query(f"WITH {TAPE}, {FUND}, g AS (SELECT symbol, (ts_ms - lag(ts_ms) OVER (PARTITION BY symbol ORDER BY ts_ms)) // 60000 AS i FROM f), k AS (SELECT symbol FROM g GROUP BY symbol HAVING min(i) <= 240 AND symbol <> 'view') SELECT count(*) AS qualified, count(*) >= 2 AS passed FROM k")
def q32_cadence_gate(t):
    e = _funding_events(t)
    compared = e.select("symbol").distinct().select("symbol", (F.col("symbol") != "view").alias("complete"), F.lit(True).alias("all_equal"))
    return funding.cadence_gate(e, compared)


@query(f"""WITH {TAPE}, {bars_sql(MINUTE)}, d AS (SELECT symbol, max(t) AS delivery_ms FROM tape GROUP BY symbol), w AS (SELECT *, CASE WHEN delivery_ms % 60000 = 0 THEN delivery_ms - 60000 ELSE delivery_ms - delivery_ms % 60000 END AS z FROM d)
SELECT w.symbol, delivery_ms, z - 7140000 AS index_window_start_ms, z + 60000 AS index_window_end_ms, count(b.close) AS row_count, sha256(coalesce(string_agg(b.start_ms || ':' || CAST(b.close AS VARCHAR), ',' ORDER BY b.start_ms), '')) AS candles_sha256
FROM w LEFT JOIN b ON b.symbol = w.symbol AND b.start_ms BETWEEN z - 7140000 AND z GROUP BY ALL""")
def q33_delivery_window(t):
    e = funding.delivery_evidence(tape(t).groupBy("symbol").agg(F.max("t").alias("delivery_ms")), bars.tape_to_bars(tape(t), MINUTE))
    joined = F.array_join(F.transform("candles", lambda c: F.concat_ws(":", c["start_ms"].cast("string"), c["close"].cast("string"))), ",")
    return e.withColumn("candles_sha256", F.sha2(joined, 256)).drop("candles")


@query(f"""WITH {LIFE}, i AS (SELECT * FROM life WHERE id % 4 <> 0), e AS (SELECT 'C' || c_custkey AS l, 'C' || (c_custkey + 1) AS r FROM customer)
SELECT l AS left_symbol, r AS right_symbol, 'renamed' AS relation, a.id IS NOT NULL AS left_present, b.id IS NOT NULL AS right_present, a.launch_ms AS left_launch_ms, a.delivery_ms AS left_delivery_ms, b.launch_ms AS right_launch_ms, b.delivery_ms AS right_delivery_ms,
CASE WHEN a.id IS NULL OR b.id IS NULL OR (coalesce(a.delivery_ms, 0) <= 0 AND coalesce(b.delivery_ms, 0) <= 0) THEN NULL ELSE greatest(0, least(CASE WHEN a.delivery_ms > 0 THEN a.delivery_ms ELSE 9e18::BIGINT END, CASE WHEN b.delivery_ms > 0 THEN b.delivery_ms ELSE 9e18::BIGINT END) - greatest(a.launch_ms, b.launch_ms)) END AS metadata_overlap_ms, false AS automatic_stitching
FROM e LEFT JOIN i a ON a.symbol = l LEFT JOIN i b ON b.symbol = r WHERE a.id IS NOT NULL OR b.id IS NOT NULL""")
def q34_identity_overlap(t):
    name = lambda c: F.concat(F.lit("C"), c.cast("string"))
    edges = t("customer").select(name(F.col("c_custkey")).alias("left_symbol"), name(F.col("c_custkey") + 1).alias("right_symbol"), F.lit("renamed").alias("relation"))
    return inventory.identity_overlap(edges, _life(t).where("id % 4 <> 0"))


_COINS = (("MITUSDT", "MIT", 5), ("AVECUSDT", "AVEC", 6), ("PARAUSDT", "PARA", 0), ("THTUSDT", "THTH", 9))


@query("""WITH a AS (SELECT doc_id, substr(text, 1, 40) AS title, text AS description, CASE WHEN doc_id % 3 = 0 THEN 'soon' ELSE CAST(doc_id AS VARCHAR) END AS p, upper(substr(text, 1, 40) || chr(10) || text) AS x FROM documents),
i(symbol, base_coin, delivery_ms) AS (VALUES ('MITUSDT', 'MIT', 5), ('AVECUSDT', 'AVEC', 6), ('THTUSDT', 'THTH', 9))
SELECT symbol, base_coin, CAST(delivery_ms AS BIGINT) AS delivery_ms, CASE WHEN contains(x, symbol) THEN 'EXACT_SYMBOL' ELSE 'BASE_COIN_CANDIDATE' END AS match_kind, md5(description) AS text_md5, coalesce(TRY_CAST(p AS BIGINT), 0) AS publish_time_ms
FROM a JOIN i ON contains(x, symbol) OR contains(x, base_coin) WHERE contains(x, 'FOR') OR contains(x, 'WITH')""")
def q35_announcement_match(t):
    docs = t("documents").select(F.substring("text", 1, 40).alias("title"), F.col("text").alias("description"), F.when(F.col("doc_id") % 3 == 0, "soon").otherwise(F.col("doc_id").cast("string")).alias("publish_time"))
    coins = docs.sparkSession.createDataFrame(_COINS, "symbol string, base_coin string, delivery_ms long")
    found = inventory.delisting_candidates(docs, coins, ("for", "with"))
    return found.select("symbol", "base_coin", "delivery_ms", "match_kind", F.md5("description").alias("text_md5"), "publish_time_ms")


_RUN = "(SELECT o_custkey % 200 AS symbol, strftime(o_orderdate, '%Y') AS month, sha256(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey)) AS h FROM orders WHERE {} GROUP BY ALL)"


@query(f"SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.month, b.month) AS month, coalesce(a.h = b.h, false) AS logical_equal FROM {_RUN.format('o_orderkey % 400 <> 0')} a FULL JOIN {_RUN.format('o_custkey % 200 <> 7')} b ON a.symbol = b.symbol AND a.month = b.month")
def q36_run_compare(t):
    def run(rows):
        rows = rows.select((F.col("o_custkey") % 200).alias("symbol"), F.date_format("o_orderdate", "yyyy").alias("month"), "o_orderkey")
        ordered = F.array_join(F.array_sort(F.collect_list("o_orderkey")).cast("array<string>"), ",")
        return rows.groupBy("symbol", "month").agg(F.sha2(ordered, 256).alias("logical"))

    return audit.compare_runs(run(t("orders").where("o_orderkey % 400 <> 0")), run(t("orders").where("o_custkey % 200 <> 7")), ["logical"], ["symbol", "month"])


@query(f"""WITH {TAPE}, {bars_sql(QUARTER)}, p AS (SELECT symbol, start_ms // {DAY} AS d, count(*) AS actual, 96 - count(*) AS missing, min(start_ms) AS a, max(start_ms) + {QUARTER} AS z FROM b GROUP BY ALL)
SELECT count(*) AS partitions, CAST(sum(actual) AS BIGINT) AS actual, CAST(sum(missing) AS BIGINT) AS missing, count_if(d % 2 = 0) AS sealed, bool_and(missing = 0) AS all_complete, max(a) AS overlap_start_ms, min(z) AS overlap_end_ms FROM p""")
def q37_run_rollup(t):
    b = bars.tape_to_bars(tape(t), QUARTER).withColumn("d", F.floor(F.col("start_ms") / DAY))
    p = b.groupBy("symbol", "d").agg(F.count("*").alias("actual"), F.min("start_ms").alias("start_ms"), (F.max("start_ms") + QUARTER).alias("end_ms"))
    return audit.run_rollup(p.withColumn("missing", 96 - F.col("actual")).withColumn("status", F.when(F.col("d") % 2 == 0, "SEALED").otherwise("OPEN")))


@query("SELECT k AS symbol, count(*) AS n FROM (SELECT c_custkey AS k FROM customer UNION ALL SELECT s_suppkey FROM supplier) GROUP BY k HAVING count(*) > 1")
def q38_duplicate_conflict_check(t):
    both = t("customer").select(F.col("c_custkey").alias("symbol")).unionByName(t("supplier").select(F.col("s_suppkey").alias("symbol")))
    return inventory.duplicates(both)


@query("""WITH p AS (SELECT 'P' || p_partkey AS symbol, CASE WHEN p_size % 10 = 0 THEN 'Closed' ELSE 'Trading' END AS status FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY status ORDER BY symbol <> 'P44', symbol) AS k FROM p),
c AS (SELECT *, CASE WHEN status = 'Trading' AND list_contains(['P5', 'P17', 'P3', 'P1', 'P90', 'P2'], symbol) THEN 0 WHEN status = 'Closed' AND k <= 3 THEN 1 WHEN status = 'Trading' THEN 2 END AS g FROM r),
o AS (SELECT *, row_number() OVER (ORDER BY g, CASE g WHEN 0 THEN list_position(['P5', 'P17', 'P3', 'P1', 'P90', 'P2'], symbol) WHEN 1 THEN CASE WHEN symbol = 'P44' THEN 0 ELSE 1 END ELSE 1 END, symbol) AS position FROM c WHERE g IS NOT NULL)
SELECT symbol, status, CAST(position AS INTEGER) AS position FROM o WHERE position <= 9""")
def q39_default_selection(t):
    rows = t("part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"), F.when(F.col("p_size") % 10 == 0, "Closed").otherwise("Trading").alias("status"))
    return inventory.default_selection(rows, ("P5", "P17", "P3", "P1", "P90", "P2"), "P44")


@query("SELECT o_custkey AS symbol, min(epoch_ms(o_orderdate)) AS first_trade_ms FROM orders GROUP BY 1")
def q40_first_trade(t):
    return audit.first_trades(t("orders").select(F.col("o_custkey").alias("symbol"), ms("o_orderdate").alias("start_ms")))


@query(f"WITH {TAPE}, {bars_sql(HOUR)}, {seg_sql('b', HOUR)} SELECT symbol, start_ms, segment, (start_ms - segment) // {HOUR} + 1 AS pos FROM g")
def q41_contiguous_segments(t):
    return bars.segments(bars.tape_to_bars(tape(t), HOUR), HOUR).select("symbol", "start_ms", "segment", "pos")


EMA = f"""{TAPE}, {bars_sql(HOUR)}, {seg_sql('b', HOUR)}, n AS (SELECT *, row_number() OVER (PARTITION BY symbol, segment ORDER BY start_ms) AS k, CAST(close AS DOUBLE) AS x FROM g),
ema AS (SELECT symbol, segment, 5 AS k, list_sum(list(x ORDER BY k)) / 5 AS m FROM n WHERE k <= 5 GROUP BY symbol, segment HAVING count(*) = 5
UNION ALL SELECT n.symbol, n.segment, n.k::INTEGER, {2 / 6!r} * n.x + {1 - 2 / 6!r} * ema.m FROM ema JOIN n ON n.symbol = ema.symbol AND n.segment = ema.segment AND n.k = ema.k + 1)"""


@query(f"WITH RECURSIVE {EMA} SELECT n.symbol, n.start_ms, round(m, 6) AS ema, m > lag(m, 3) OVER (PARTITION BY n.symbol, n.segment ORDER BY n.start_ms) AS rising FROM n LEFT JOIN ema ON ema.symbol = n.symbol AND ema.segment = n.segment AND ema.k = n.k")
def q42_ema_seeded(t):
    return indicators.ema(bars.tape_to_bars(tape(t), HOUR), HOUR, 5).select("symbol", "start_ms", F.round("ema", 6).alias("ema"), F.col("ema_rising").alias("rising"))


@query(ORACLE_SQL["q42_ema_seeded"].replace(", m > lag(m, 3) OVER (PARTITION BY n.symbol, n.segment ORDER BY n.start_ms) AS rising", ""))
def q42b_ema_in_groups(t):
    return indicators.chained_in_groups(bars.tape_to_bars(tape(t), HOUR), HOUR, 5).select("symbol", "start_ms", F.round("ema", 6).alias("ema"))


@query(f"""WITH RECURSIVE {TAPE}, {bars_sql(HOUR)}, {seg_sql('b', HOUR)}, t0 AS (SELECT *, lag(close) OVER (PARTITION BY symbol, segment ORDER BY start_ms) AS pc FROM g),
n AS (SELECT *, row_number() OVER (PARTITION BY symbol, segment ORDER BY start_ms) AS k, CAST(greatest(high - low, abs(high - pc), abs(low - pc)) AS DOUBLE) AS x FROM t0 WHERE pc IS NOT NULL),
a AS (SELECT symbol, segment, 3 AS k, list_sum(list(x ORDER BY k)) / 3 AS m FROM n WHERE k <= 3 GROUP BY symbol, segment HAVING count(*) = 3
UNION ALL SELECT n.symbol, n.segment, n.k::INTEGER, (a.m * 2 + n.x) / 3 FROM a JOIN n ON n.symbol = a.symbol AND n.segment = a.segment AND n.k = a.k + 1)
SELECT n.symbol, n.start_ms, round(x, 6) AS tr, round(m, 6) AS atr FROM n LEFT JOIN a ON a.symbol = n.symbol AND a.segment = n.segment AND a.k = n.k""")
def q43_atr_wilder(t):
    return indicators.atr(bars.tape_to_bars(tape(t), HOUR), HOUR, 3).select("symbol", "start_ms", F.round("tr", 6).alias("tr"), F.round("atr", 6).alias("atr"))


@query(f"WITH {TAPE}, {bars_sql(QUARTER)} SELECT symbol, start_ms, round(CAST(volume AS DOUBLE) / nullif(CASE WHEN count(*) OVER w = 20 THEN avg(CAST(volume AS DOUBLE)) OVER w END, 0), 6) AS volume_ratio FROM b WINDOW w AS (PARTITION BY symbol ORDER BY start_ms ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)")
def q44_volume_ratio(t):
    return indicators.volume_ratio(bars.tape_to_bars(tape(t), QUARTER)).select("symbol", "start_ms", F.round("volume_ratio", 6).alias("volume_ratio"))


@query(f"WITH {TAPE}, {bars_sql(4 * HOUR)}, {roll_sql('b', 4 * HOUR, DAY)} SELECT symbol, bucket AS start_ms, CAST(CASE WHEN lag(bucket) OVER w = bucket - {DAY} THEN lag(high) OVER w END AS VARCHAR) AS previous_high, CAST(CASE WHEN lag(bucket) OVER w = bucket - {DAY} THEN lag(low) OVER w END AS VARCHAR) AS previous_low FROM r WINDOW w AS (PARTITION BY symbol ORDER BY bucket)")
def q45_prev_period_levels(t):
    p = indicators.period_levels(bars.tape_to_bars(tape(t), 4 * HOUR), 4 * HOUR, DAY)
    return p.select("symbol", "start_ms", F.col("previous_high").cast("string").alias("previous_high"), F.col("previous_low").cast("string").alias("previous_low"))


@query(f"""WITH {TAPE}, {bars_sql(4 * HOUR)}, x AS (SELECT *, CASE WHEN lag(start_ms) OVER w = start_ms - {4 * HOUR} AND close > 0 AND lag(close) OVER w > 0 THEN ln(CAST(close AS DOUBLE) / CAST(lag(close) OVER w AS DOUBLE)) END AS ret FROM b WINDOW w AS (PARTITION BY symbol ORDER BY start_ms)),
y AS (SELECT *, sum(turnover) OVER (PARTITION BY symbol ORDER BY start_ms ROWS 11 PRECEDING) AS ts, stddev_samp(ret) OVER (PARTITION BY symbol ORDER BY start_ms ROWS 10 PRECEDING) AS rv, count(ret) OVER (PARTITION BY symbol ORDER BY start_ms ROWS 10 PRECEDING) AS n FROM x),
z AS (SELECT symbol, start_ms - start_ms % {DAY} AS day_ms, arg_max(struct_pack(ts := ts, rv := rv), start_ms) AS s FROM y WHERE start_ms % {DAY} + {4 * HOUR} <= {12 * HOUR} AND n = 11 GROUP BY ALL),
a AS (SELECT symbol, day_ms, s.ts AS ts, s.rv AS rv, row_number() OVER (PARTITION BY day_ms ORDER BY s.ts DESC, symbol) AS tr FROM z),
c AS (SELECT *, row_number() OVER (PARTITION BY day_ms ORDER BY rv DESC, ts DESC, symbol) AS rr FROM a WHERE tr <= 4)
SELECT symbol, day_ms, CAST(CAST(ts AS DECIMAL(38,2)) AS VARCHAR) AS turnover, round(rv, 6) AS rv, CAST(tr AS INTEGER) AS turnover_rank, CAST(rr AS INTEGER) AS rv_rank FROM c WHERE rr <= 2""")
def q46_universe_top_turnover_vol(t):
    b = bars.tape_to_bars(tape(t), 4 * HOUR)
    cutoff = timeops.align_down(F.col("start_ms"), DAY) + 12 * HOUR
    u = indicators.universe(b, cutoff, 4 * HOUR, 12, 4, 2)
    return u.select("symbol", "day_ms", text("turnover_sum").alias("turnover"), F.round("rv", 6).alias("rv"), "turnover_rank", "rv_rank")


def _levels(t) -> DataFrame:
    """Previous day's extremes as levels of both sides, with a second pair a step away."""
    p = indicators.period_levels(bars.tape_to_bars(tape(t), 4 * HOUR), 4 * HOUR, DAY).where("previous_high IS NOT NULL")
    d = lambda side, c, plus, label: p.select("symbol", F.col("start_ms").alias("day_ms"), F.lit(side).alias("side"), (F.col(c) / 2 + F.lit(plus).cast("decimal(6,2)")).cast("decimal(18,2)").alias("price"), F.lit(label).alias("label"), F.lit("0.01").cast("decimal(6,2)").alias("tick"))
    return d("LONG", "previous_high", "0", "PDH").unionByName(d("LONG", "previous_high", "0.01", "PWH")).unionByName(d("SHORT", "previous_low", "30", "PDL")).unionByName(d("SHORT", "previous_low", "31", "PWL"))


LEVELS = f"""{TAPE}, {bars_sql(4 * HOUR)}, {roll_sql('b', 4 * HOUR, DAY)}, pl AS (SELECT symbol, bucket AS day_ms, lag(high) OVER w AS ph, lag(low) OVER w AS pl FROM r WINDOW w AS (PARTITION BY symbol ORDER BY bucket) QUALIFY lag(bucket) OVER w = bucket - {DAY}),
lv AS (SELECT symbol, day_ms, 'LONG' AS side, CAST(ph * 0.5 AS DECIMAL(18,2)) AS price, 'PDH' AS label FROM pl UNION ALL SELECT symbol, day_ms, 'LONG', CAST(ph * 0.5 + 0.01 AS DECIMAL(18,2)), 'PWH' FROM pl UNION ALL SELECT symbol, day_ms, 'SHORT', CAST(pl * 0.5 + 30 AS DECIMAL(18,2)), 'PDL' FROM pl UNION ALL SELECT symbol, day_ms, 'SHORT', CAST(pl * 0.5 + 31 AS DECIMAL(18,2)), 'PWL' FROM pl),
cl AS (SELECT *, sum(CASE WHEN brk THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, day_ms, side ORDER BY price, label) AS c FROM (SELECT *, coalesce(price - lag(price) OVER (PARTITION BY symbol, day_ms, side ORDER BY price, label) > 0.01, true) AS brk FROM lv)),
ml AS (SELECT symbol, day_ms, side, CASE WHEN side = 'LONG' THEN max(price) ELSE min(price) END AS price, array_to_string(list_sort(list(label)), ',') AS labels FROM cl GROUP BY symbol, day_ms, side, c)"""


@query(f"WITH {LEVELS} SELECT symbol, day_ms, side, CAST(price AS VARCHAR) AS price, labels FROM ml")
def q47_merged_levels(t):
    return strategy.merge_levels(_levels(t)).select("symbol", "day_ms", "side", F.col("price").cast("string").alias("price"), F.array_join("labels", ",").alias("labels"))


@query(f"""WITH {LEVELS}, {bars_sql(HOUR, 'hb')}, mv AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY start_ms) AS pc, start_ms - start_ms % {DAY} AS d FROM hb)
SELECT mv.symbol, start_ms, side, CAST(CASE WHEN side = 'LONG' THEN max(price) ELSE min(price) END AS VARCHAR) AS level, count(DISTINCT price) AS crossed FROM mv JOIN ml ON ml.symbol = mv.symbol AND ml.day_ms = d
WHERE (side = 'LONG' AND pc <= price AND close > price) OR (side = 'SHORT' AND pc >= price AND close < price) GROUP BY mv.symbol, start_ms, side""")
def q47b_level_cross(t):
    c = strategy.crosses(bars.tape_to_bars(tape(t), HOUR), strategy.merge_levels(_levels(t)), timeops.align_down(F.col("start_ms"), DAY))
    return c.select("symbol", "start_ms", "side", F.col("level").cast("string").alias("level"), F.size("crossed").cast("long").alias("crossed"))


@query(f"""WITH RECURSIVE {EMA}, e AS (SELECT n.symbol, n.start_ms + {HOUR} AS close_ms, n.x, m, m > lag(m, 3) OVER (PARTITION BY n.symbol, n.segment ORDER BY n.start_ms) AS up FROM n LEFT JOIN ema ON ema.symbol = n.symbol AND ema.segment = n.segment AND ema.k = n.k)
SELECT seq, e.close_ms, coalesce(e.x > e.m AND up, false) AS trend_long FROM tape LEFT JOIN LATERAL (SELECT * FROM e WHERE false) z ON true ASOF LEFT JOIN e ON e.symbol = tape.symbol AND e.close_ms <= tape.t""".replace(" LEFT JOIN LATERAL (SELECT * FROM e WHERE false) z ON true", ""))
def q48_trend_asof(t):
    e = indicators.ema(bars.tape_to_bars(tape(t), HOUR), HOUR, 5).select("symbol", (F.col("start_ms") + HOUR).alias("close_ms"), F.col("close").cast("double").alias("x"), F.col("ema").alias("m"), F.col("ema_rising").alias("up"), F.col("ema_falling").alias("down"))
    j = asof.asof(tape(t), e, "symbol", "t", "close_ms", ["close_ms", "x", "m", "up", "down"])
    return j.select("seq", "close_ms", strategy.trend_ok(F.lit("LONG"), F.col("x"), F.col("m"), F.col("up"), F.col("down")).alias("trend_long"))


@query(f"WITH {TAPE}, s AS (SELECT t FROM tape WHERE symbol = 'signup') SELECT seq FROM tape ANTI JOIN s ON tape.t >= s.t - {30 * MINUTE} AND tape.t < s.t + {30 * MINUTE}")
def q49_blackout_filter(t):
    news = tape(t).where("symbol = 'signup'").select((F.col("t") - 30 * MINUTE).alias("from_ms"), (F.col("t") + 30 * MINUTE).alias("to_ms"))
    return asof.outside_intervals(tape(t), "t", news, HOUR).select("seq")


@query(f"WITH {TAPE}, s AS (SELECT t FROM tape WHERE symbol = 'signup') SELECT seq FROM tape ANTI JOIN s ON tape.t >= s.t - {MINUTE // 2} AND tape.t < s.t + {MINUTE // 2}")
def q49b_blackout_in_dense_news(t):
    """Half a minute on either side of every signup, so that something is left however dense they are."""
    news = tape(t).where("symbol = 'signup'").select((F.col("t") - MINUTE // 2).alias("from_ms"), (F.col("t") + MINUTE // 2).alias("to_ms"))
    return asof.outside_intervals(tape(t), "t", news, HOUR).select("seq")


@query("""WITH c AS (SELECT count(*) AS n0, count_if(value > 5) AS n1, count_if(value > 5 AND user_id % 3 <> 0) AS n2, count_if(value > 5 AND user_id % 3 <> 0 AND event_type IN ('click', 'purchase')) AS n3 FROM events)
SELECT 0 AS stage_no, 'all' AS stage, n0 AS n, 100.0::DOUBLE AS pct FROM c UNION ALL SELECT 1, 'priced', n1, round(100.0::DOUBLE * n1 / n0, 3) FROM c UNION ALL SELECT 2, 'known', n2, round(100.0::DOUBLE * n2 / n1, 3) FROM c UNION ALL SELECT 3, 'signal', n3, round(100.0::DOUBLE * n3 / n2, 3) FROM c""")
def q50_funnel_counts(t):
    return strategy.funnel(t("events"), [("priced", F.col("value") > 5), ("known", F.col("user_id") % 3 != 0), ("signal", F.col("event_type").isin("click", "purchase"))])


@query("""WITH x AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,4)) AS eq, CAST((o_custkey % 50 + 1) AS DECIMAL(14,6)) AS u, CAST((o_custkey % 900 + 100) AS DECIMAL(14,6)) AS en, CAST(o_totalprice * (o_orderkey % 12) / 1000 AS DECIMAL(24,4)) AS rr, CAST(o_totalprice * (o_orderkey % 4) AS DECIMAL(24,4)) AS rn FROM orders),
y AS (SELECT o_orderkey, eq::DOUBLE * 0.005 / u::DOUBLE AS a, greatest(0, CAST(eq * CAST(0.01 AS DECIMAL(6,4)) AS DECIMAL(24,8)) - rr)::DOUBLE / u::DOUBLE AS b, eq::DOUBLE * 2 / en::DOUBLE AS c, greatest(0, eq::DOUBLE * 3 - rn::DOUBLE) / en::DOUBLE AS d FROM x)
SELECT o_orderkey, CAST(floor(least(a, b, c, d) * 10 + 1e-7) AS BIGINT) AS steps, CASE WHEN b <= 0 THEN 'REJECT_RISK_CAPACITY' WHEN floor(least(a, b, c, d) * 10 + 1e-7) <= 0 THEN 'REJECT_NOTIONAL_MINIMUM' ELSE 'ACCEPT' END AS decision FROM y""")
def q51_sizing_caps(t):
    k, o, p = F.col("o_custkey"), F.col("o_orderkey"), F.col("o_totalprice")
    rows = t("orders").select("o_orderkey", p.cast("decimal(18,4)").alias("equity"), (k % 50 + 1).alias("l_unit"), (k % 900 + 100).alias("entry"), (p * (o % 12) / 1000).cast("decimal(24,4)").alias("reserved_risk"), (p * (o % 4)).cast("decimal(24,4)").alias("reserved_notional"), F.lit("0.1").cast("decimal(4,1)").alias("qty_step"))
    return strategy.sized(rows).select("o_orderkey", (F.col("qty") * 10).cast("long").alias("steps"), "decision")


@query("""WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'LONG' ELSE 'SHORT' END AS side, CAST(p_retailprice AS DECIMAL(18,6)) AS l, CAST(p_size AS DECIMAL(18,6)) * 0.5 AS h, CAST(0.05 AS DECIMAL(18,6)) AS tk FROM part),
y AS (SELECT *, CASE WHEN side = 'LONG' THEN l - l % tk ELSE CASE WHEN l % tk = 0 THEN l ELSE l - l % tk + tk END END AS entry, CASE WHEN side = 'LONG' THEN l - h ELSE l + h END AS raw FROM x),
z AS (SELECT *, CASE WHEN side = 'LONG' THEN raw - raw % tk ELSE CASE WHEN raw % tk = 0 THEN raw ELSE raw - raw % tk + tk END END AS stop FROM y)
SELECT p_partkey, side, CAST(CAST(entry AS DECIMAL(38,2)) AS VARCHAR) AS entry, CAST(CAST(stop AS DECIMAL(38,2)) AS VARCHAR) AS stop, CAST(CAST(abs(entry - stop) AS DECIMAL(38,2)) AS VARCHAR) AS r_price, CAST(CAST(CASE WHEN side = 'LONG' THEN entry + 2 * abs(entry - stop) ELSE entry - 2 * abs(entry - stop) END AS DECIMAL(38,2)) AS VARCHAR) AS tp1,
abs(entry - stop) >= 5 * (entry * 0.0002 + stop * 0.0006 + stop * 0.0004) AS cost_floor_ok FROM z""")
def q52_stop_and_r(t):
    rate = lambda x: F.lit(x).cast("decimal(12,8)")
    rows = t("part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, "LONG").otherwise("SHORT").alias("side"), F.col("p_retailprice").cast("decimal(18,6)").alias("level"), F.col("p_size").cast("decimal(18,6)").alias("atr"), F.lit("0.05").cast("decimal(18,6)").alias("tick"), rate("0.0002").alias("maker"), rate("0.0006").alias("taker"), rate("0.0004").alias("slip"))
    p = strategy.priced(rows)
    return p.select("p_partkey", "side", text("entry").alias("entry"), text("stop").alias("stop"), text("r_price").alias("r_price"), text("tp1").alias("tp1"), "cost_floor_ok")


#: The symbol whose trend every setup needs besides its own.
LEADER = "view"


def _replay_events(t, trend_ms: int = 4 * HOUR) -> DataFrame:
    """Minute rows of each symbol under each configuration, with a candidate at every minute that crosses the mean of the three
    rows before and passes the gates: the EMA of the symbol and of LEADER, the volume ratio and the cost floor. A fifth of
    the level is its ATR. Funding falls due with the events of _funding_events, at their mark prices."""
    configs = strategy.configurations()
    h = bars.tape_to_bars(tape(t), trend_ms)
    trend = h.select("symbol", "start_ms", (F.col("start_ms") + trend_ms).alias("close_ms"), F.col("close").cast("double").alias("x"))
    periods = sorted({c["ema_period"] for c in configs})
    for p in periods:
        trend = trend.join(indicators.ema(h, trend_ms, p, strategy.PARAMETERS["slope_lag"]).select("symbol", "start_ms", F.col("ema").alias(f"ema{p}"), F.col("ema_rising").alias(f"up{p}")), ["symbol", "start_ms"])
    w = Window.partitionBy("symbol").orderBy("start_ms")
    day = F.pmod("start_ms", F.lit(DAY))
    mean = F.avg(F.col("close").cast("double")).over(w.rowsBetween(-3, -1))
    d = lambda c: F.col(c).cast("double")
    rows = indicators.volume_ratio(bars.tape_to_bars(tape(t), MINUTE)).withColumn("mean", F.round(mean, 2)).withColumn("next_open", F.lead(d("open")).over(w)).withColumn("minute_ms", F.col("start_ms") + MINUTE)
    rows = asof.asof(rows, trend, "symbol", "minute_ms", "close_ms", ["x", *(f"{c}{p}" for p in periods for c in ("ema", "up"))])
    factor = lambda c: F.struct(*(F.lit(v if k in ("config", "ema_period", "expiry_bars") else float(v)).alias(k) for k, v in c.items() if k in ("config", "ema_period", "volume_ratio", "stop_atr", "expiry_bars", "k_cost")))
    lead = trend.where(F.col("symbol") == LEADER).select(F.lit("lead").alias("_k"), F.col("close_ms").alias("lead_ms"), F.col("x").alias("lead_x"), *(F.col(f"{c}{p}").alias(f"lead_{c}{p}") for p in periods for c in ("ema", "up")))
    rows = asof.asof(rows.withColumn("_k", F.lit("lead")), lead, "_k", "minute_ms", "lead_ms", [c for c in lead.columns if c not in ("_k", "lead_ms")]).drop("_k")
    # the first signup of a day is its news; the tape of a symbol ends with its delivery, known a day before
    news = tape(t).where("symbol = 'signup'").groupBy(timeops.align_down(F.col("t"), DAY).alias("day")).agg(F.min("t").alias("t")).select((F.col("t") - 30 * MINUTE).alias("from_ms"), (F.col("t") + 30 * MINUTE).alias("to_ms"))
    clear = asof.outside_intervals(rows.select("minute_ms").distinct(), "minute_ms", news, HOUR).select("minute_ms", F.lit(False).alias("blackout"))
    rows = rows.join(clear, "minute_ms", "left").withColumn("blackout", F.coalesce("blackout", F.lit(True)))
    ends = bars.tape_to_bars(tape(t), MINUTE).groupBy("symbol").agg(F.max("start_ms").alias("last_ms"))
    rows = rows.join(F.broadcast(ends), "symbol")  # a row a symbol
    valued = funding.value_events(_funding_events(t), bars.tape_to_bars(tape(t), HOUR), bars.tape_to_bars(tape(t), MINUTE), 2).select("symbol", F.col("ts_ms").alias("minute_ms"), F.col("mark_price").cast("double").alias("mark"))
    rows = rows.join(valued, ["symbol", "minute_ms"], "left")
    rows = rows.withColumn("c", F.explode(F.array(*map(factor, configs))))
    entry, r = F.col("mean"), F.col("mean") * 0.2 * F.col("c.stop_atr")
    up = (F.col("close") > F.col("mean")) & (F.col("next_open") > F.col("mean"))
    leg = lambda before, p: (F.col(f"{before}x"), F.col(f"{before}ema{p}"), F.col(f"{before}up{p}"), F.lit(False))
    with_trend = F.coalesce(*(F.when(F.col("c.ema_period") == p, strategy.both_trends_ok(F.lit("LONG"), leg("", p), leg("lead_", p))) for p in periods))
    ending = F.col("minute_ms") >= F.col("last_ms") - DAY
    dear = r < F.col("c.k_cost") * (entry * 0.0002 + (entry - r) * (0.00055 + 0.0002))
    return rows.select(
        "c.config", "minute_ms", "symbol", F.col("next_open").alias("open"), d("high").alias("high"), d("low").alias("low"), F.when(F.pmod("minute_ms", F.lit(QUARTER)) == 0, d("close")).alias("close_15m"),
        (day + MINUTE >= 22 * HOUR).alias("session_end"), "blackout", F.when(F.col("mark").isNotNull(), F.lit(0.0001)).alias("funding_rate"), "mark", F.when(up & with_trend & (F.col("volume_ratio") >= F.col("c.volume_ratio")) & ~dear, "LONG").alias("side"),
        entry.alias("level"), entry.alias("entry"), (entry - r).alias("stop"), (entry + 2 * r).alias("tp1"), (entry + 3 * r).alias("tp2"), (r * 1.1).alias("l_unit"), (entry * 1.01).alias("be"), F.lit(0.1).alias("qty_step"), (F.col("minute_ms") + F.col("c.expiry_bars") * QUARTER).alias("expiry_ms"),
        d("turnover").alias("turnover_sum"), "volume_ratio", ending.alias("delivery_known"), F.when(F.col("minute_ms") == F.col("last_ms"), d("close")).alias("settlement"),
    )


@query()
def q53_replay_trades(t):
    return replay.replay(_replay_events(t))


@query()
def q54_scenario_ledgers(t):
    trades = replay.replay(_replay_events(t))
    scenarios = trades.sparkSession.createDataFrame([("BASE", 0.0002, 0.00055, 0.0002), ("STRESS", 0.0002, 0.00055, 0.0008), ("SEVERE", 0.0002, 0.00055, 0.002)], "scenario string, maker double, taker double, slip double")
    return replay.ledgers(trades, scenarios)


_TRADES = "tr AS (SELECT o_orderkey AS trade_id, o_orderpriority AS grp, epoch_ms(o_orderdate) AS t, (CAST(o_totalprice * 100 AS BIGINT) % 701 - 340) / 100.0::DOUBLE AS r FROM orders)"


def _trades(t) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return t("orders").select(F.col("o_orderkey").alias("trade_id"), F.col("o_orderpriority").alias("grp"), ms("o_orderdate").alias("closed_ms"), ((cents % 701 - 340) / F.lit(100.0)).alias("net_r"))


@query(f"""WITH {_TRADES}, a AS (SELECT *, sum(r) OVER w AS cum, CASE WHEN r < 0 THEN 1 ELSE 0 END AS l FROM tr WINDOW w AS (PARTITION BY grp ORDER BY t, trade_id ROWS UNBOUNDED PRECEDING)),
b AS (SELECT *, greatest(0.0, max(cum) OVER w) AS peak, sum(1 - l) OVER w AS sid FROM a WINDOW w AS (PARTITION BY grp ORDER BY t, trade_id ROWS UNBOUNDED PRECEDING)), c AS (SELECT *, sum(l) OVER (PARTITION BY grp, sid ORDER BY t, trade_id ROWS UNBOUNDED PRECEDING) AS st FROM b)
SELECT grp, count(*) AS n, round(sum(r), 6) AS total_r, round(avg(r), 6) AS mean_r, round(median(r), 6) AS median_r, round(avg(CASE WHEN r > 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS win_rate, round(sum(r) FILTER (r > 0) / -sum(r) FILTER (r < 0), 6) AS profit_factor, round(max(peak - cum), 6) AS max_drawdown, CAST(max(st) AS BIGINT) AS longest_losing_streak FROM c GROUP BY grp""")
def q55_trade_stats(t):
    return validation.trade_stats(_trades(t), ["grp"])


@query(f"""WITH {_TRADES}, wk AS (SELECT (t - 788918400000) // {7 * DAY} AS w, sum(r) AS total, count(*) AS n FROM tr GROUP BY 1), span AS (SELECT min(w) AS a, max(w) - min(w) + 1 AS n FROM wk), weeks AS (SELECT unnest(generate_series(0, n - 1)) AS w, a FROM span),
k AS (SELECT weeks.w, coalesce(total, 0) AS total, coalesce(n, 0) AS n FROM weeks LEFT JOIN wk ON wk.w = weeks.w + a),
d AS (SELECT b, CAST('0x' || substr(sha256('bootstrap:' || b || ':' || i), 1, 8) AS BIGINT) % n AS w FROM (SELECT unnest(generate_series(0, 19999)) AS b), (SELECT unnest(generate_series(0, n - 1)) AS i, n FROM span)),
m AS (SELECT b, sum(total) / nullif(sum(n), 0) AS mean FROM d JOIN k USING (w) GROUP BY b) SELECT count(mean) AS resamples, round(quantile_cont(mean, 0.025), 6) AS ci_low, round(quantile_cont(mean, 0.975), 6) AS ci_high FROM m""")
def q56_block_bootstrap_ci(t):
    week = F.floor((F.col("closed_ms") - 788_918_400_000) / (7 * DAY))
    weekly = _trades(t).groupBy(week.alias("week")).agg(F.sum("net_r").alias("total"), F.count("*").alias("n"))
    span = weekly.agg(F.min("week").alias("first"), F.max("week").alias("last"))
    weeks = span.select(F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("last") - F.col("first"), F.lit(0)))).alias("week_no"))
    return validation.bootstrap(weekly.crossJoin(F.broadcast(span)).select((F.col("week") - F.col("first")).alias("week_no"), "total", "n"), weeks)


_SLIP = "s AS (SELECT l_returnflag AS a, l_linestatus AS b, l_partkey % 40 AS c, CAST(l_extendedprice * 100 AS BIGINT) % 997 / 10.0::DOUBLE AS bps FROM lineitem)"


@query(f"""WITH {_SLIP}, q AS (SELECT a, b, c, count(*) AS n, grouping_id(a, b, c) AS g, quantile_cont(bps, [0.75, 0.95, 0.99]) AS q FROM s GROUP BY GROUPING SETS ((a, b, c), (a, b), (a), ())), k AS (SELECT DISTINCT a, b, c FROM s),
j AS (SELECT k.*, q3.q AS q3, q2.q AS q2, q1.q AS q1, q0.q AS q0 FROM k LEFT JOIN q q3 ON q3.g = 0 AND q3.a = k.a AND q3.b = k.b AND q3.c = k.c AND q3.n >= 260 LEFT JOIN q q2 ON q2.g = 1 AND q2.a = k.a AND q2.b = k.b AND q2.n >= 260 LEFT JOIN q q1 ON q1.g = 3 AND q1.a = k.a AND q1.n >= 260 JOIN q q0 ON q0.g = 7),
z AS (SELECT *, coalesce(q3, q2, q1, q0) AS v, CASE WHEN q3 IS NOT NULL THEN 3 WHEN q2 IS NOT NULL THEN 2 WHEN q1 IS NOT NULL THEN 1 ELSE 0 END AS depth FROM j) SELECT a, b, c, depth, round(v[1], 6) AS p75, round(v[2], 6) AS p95, round(v[3], 6) AS p99 FROM z""")
def q57_slippage_quantiles(t):
    bps = F.round(F.col("l_extendedprice") * 100).cast("long") % 997 / F.lit(10.0)
    rows = t("lineitem").select(F.col("l_returnflag").alias("a"), F.col("l_linestatus").alias("b"), (F.col("l_partkey") % 40).alias("c"), bps.alias("bps"))
    return validation.slippage_quantiles(rows, ["a", "b", "c"], least=260)


@query("""WITH s AS (SELECT l_returnflag AS exit_class, epoch_ms(l_shipdate) AS t, l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey AS id, CAST(l_extendedprice * 100 AS BIGINT) % 997 / 10.0::DOUBLE AS bps FROM lineitem),
m AS (SELECT *, CASE WHEN count(*) OVER w = 20 THEN median(bps) OVER w END AS md FROM s WINDOW w AS (PARTITION BY exit_class ORDER BY t, id, bps ROWS 19 PRECEDING)) SELECT exit_class, id, bps, round(md, 6) AS median_bps, coalesce(md > greatest(1.25 * 40, 42.0), false) AS blocked FROM m""")
def q58_drift_gate(t):
    bps = F.round(F.col("l_extendedprice") * 100).cast("long") % 997 / F.lit(10.0)
    rows = t("lineitem").select(F.col("l_returnflag").alias("exit_class"), ms("l_shipdate").alias("t"), (F.col("l_orderkey") * 1_000_000 + F.col("l_linenumber") * 100_000 + F.col("l_partkey")).alias("id"), bps.alias("bps"))
    return validation.drift_gate(rows, F.lit(40.0)).select("exit_class", "id", "bps", "median_bps", "blocked")


@query("""WITH r AS (SELECT o_custkey AS symbol, epoch_ms(o_orderdate) AS k, max(o_orderkey) AS e FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL), d AS (SELECT o_orderkey, o_custkey AS symbol, epoch_ms(o_orderdate) AS t FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderkey, r.k AS known_at_ms, r.e AS effective_ms FROM d ASOF LEFT JOIN r ON r.symbol = d.symbol AND r.k <= d.t""")
def q59_bitemporal_delisting(t):
    o = t("orders").select("o_orderkey", F.col("o_custkey").alias("symbol"), ms("o_orderdate").alias("t"), "o_orderstatus")
    records = o.where("o_orderstatus = 'F'").groupBy("symbol", F.col("t").alias("known_at_ms")).agg(F.max("o_orderkey").alias("effective_ms"))
    return asof.known_at(o.where("o_orderstatus = 'O'").drop("o_orderstatus"), records).select("o_orderkey", "known_at_ms", "effective_ms")


@query("""WITH r AS (SELECT o_custkey AS symbol, epoch_ms(o_orderdate) AS k, max(o_orderkey) AS e FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL), d AS (SELECT o_orderkey, o_custkey AS symbol, epoch_ms(o_orderdate) AS t FROM orders WHERE o_orderstatus = 'P')
SELECT o_orderkey, r.k AS at_ms, r.e AS trade FROM d ASOF LEFT JOIN r ON r.symbol = d.symbol AND r.k >= d.t""")
def q59b_first_trade_after_trigger(t):
    o = t("orders").select("o_orderkey", F.col("o_custkey").alias("symbol"), ms("o_orderdate").alias("t"), "o_orderstatus")
    trades = o.where("o_orderstatus = 'F'").groupBy("symbol", F.col("t").alias("at_ms")).agg(F.max("o_orderkey").alias("trade"))
    return asof.asof(o.where("o_orderstatus = 'P'"), trades, "symbol", "t", "at_ms", ["at_ms", "trade"], "forward", 200).select("o_orderkey", "at_ms", "trade")


@query(f"WITH {TAPE}, e AS (SELECT min(t) - min(t) % {HOUR} AS a, max(t) AS z FROM tape) SELECT count(*) AS evaluations, round(count_if(NOT ok) / count(*)::DOUBLE, 6) AS rate, count_if(NOT ok) / count(*)::DOUBLE <= 0.001 AND (max(s) - min(s)) / 86400000.0 >= 30 AND count(*) >= 3000 AS passed FROM (SELECT s, s IN (SELECT t - t % {HOUR} FROM tape) AS ok FROM (SELECT unnest(generate_series(a, z, {HOUR})) AS s FROM e))")
def q61_unavailability_gate(t):
    b = bars.tape_to_bars(tape(t).withColumn("symbol", F.lit("all")), HOUR)
    span = b.groupBy("symbol").agg(F.min("start_ms").alias("a"), F.max("start_ms").alias("z"))
    slots = span.select("symbol", F.explode(F.sequence("a", "z", F.lit(HOUR).cast("long"))).alias("start_ms"))
    seen = slots.join(b.select("symbol", "start_ms", F.lit(True).alias("available")), ["symbol", "start_ms"], "left")
    return validation.unavailability(seen.select(F.col("start_ms").alias("t"), F.coalesce("available", F.lit(False)).alias("available")))


@query(f"""WITH {TAPE}, p AS (SELECT symbol, seq % 10 AS page, t - t % {QUARTER} AS s FROM tape) SELECT symbol, page, count(*) AS raw_rows, CAST(count_if(s + {QUARTER} <= {Y2024 + 20 * DAY}) - count(DISTINCT s) FILTER (s + {QUARTER} <= {Y2024 + 20 * DAY}) AS BIGINT) AS duplicates, count_if(s + {QUARTER} > {Y2024 + 20 * DAY}) AS unfinished, min(s) AS oldest_ms, max(s) AS newest_ms FROM p GROUP BY ALL""")
def q62_page_stats(t):
    rows = tape(t).select("symbol", (F.col("seq") % 10).alias("page"), timeops.align_down(F.col("t"), QUARTER).alias("start_ms"))
    return bars.page_stats(rows, QUARTER, Y2024 + 20 * DAY)


@query(f"WITH {TAPE}, u AS (SELECT symbol, CAST(px * 100 AS BIGINT) AS u FROM tape) SELECT symbol, list_reduce(list(u ORDER BY u), lambda a, b: gcd(a, b)) * 1000000 AS tick_units FROM u GROUP BY symbol")
def q63_tick_lattice(t):
    return indicators.tick_lattice(tape(t).where("px > 0"))


@query("""SELECT c_custkey, status IS NULL OR status = 429 OR status >= 500 OR (status = 200 AND code IN (10000, 10006, 10016)) AS retry, CASE WHEN reset > 0 AND reset < 60 THEN greatest(w, reset) ELSE w END AS wait_s
FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 200 WHEN 1 THEN 429 WHEN 2 THEN 503 WHEN 3 THEN 403 END AS status, 10000 + c_custkey % 8 AS code, least(8.0::DOUBLE, 0.5 * pow(2, c_custkey % 6)) AS w, (c_custkey % 90)::DOUBLE AS reset FROM customer)""")
def q64_retry_policy(t):
    from .sources import fetch

    k = F.col("c_custkey")
    status = F.when(k % 5 == 0, 200).when(k % 5 == 1, 429).when(k % 5 == 2, 503).when(k % 5 == 3, 403)
    return t("customer").select("c_custkey", F.coalesce(fetch.should_retry(status, 10_000 + k % 8), F.lit(False)).alias("retry"), fetch.wait_seconds((k % 6).cast("double"), (k % 90).cast("double")).alias("wait_s"))


@query(f"""WITH {LIFE}, p AS (SELECT symbol, coalesce(first_trade_ms, launch_ms) AS o, first_trade_ms IS NOT NULL AS h, delivery_ms FROM life), e AS (SELECT *, CASE WHEN delivery_ms > o THEN delivery_ms ELSE {Y1999 + 1000 * DAY} END AS z FROM p),
q AS (SELECT symbol, CASE WHEN h THEN 'near_first_trade' ELSE 'near_launch' END AS label, least(z - 120000, o + 3600000) AS point_ms FROM e UNION ALL SELECT symbol, 'mid_life', o + greatest(0, z - o) // 2 FROM e UNION ALL SELECT symbol, 'near_end', greatest(o + 120000, z - 3600000) FROM e)
SELECT symbol, label, point_ms, point_ms - point_ms % 60000 - 900000 AS start_ms, point_ms - point_ms % 60000 + 840000 AS end_ms FROM q""")
def q65_probe_windows(t):
    p = _life(t).withColumn("p", F.explode(timeops.probe_points(F.col("launch_ms"), F.col("first_trade_ms"), F.col("delivery_ms"), Y1999 + 1000 * DAY)))
    w = timeops.probe_window(F.col("p.point_ms"))
    return p.select("symbol", "p.label", "p.point_ms", w["start_ms"].alias("start_ms"), w["end_ms"].alias("end_ms"))


SPLIT = f"""{TAPE}, c0 AS (SELECT symbol, t AS ts_ms, count(*) AS n FROM tape GROUP BY ALL), sums AS (SELECT symbol, list(ts_ms ORDER BY ts_ms) AS ts, list(n ORDER BY ts_ms) AS ns FROM c0 GROUP BY symbol),
r(symbol, a, z, n) AS (
  SELECT symbol, {Y2024}, {Y2024 + 32 * DAY}, list_sum(list_filter(ns, lambda x, i: ts[i] >= {Y2024} AND ts[i] < {Y2024 + 32 * DAY})) FROM sums
  UNION ALL
  SELECT symbol, lo, hi, coalesce(list_sum(list_filter(ns, lambda x, i: ts[i] >= lo AND ts[i] < hi)), 0)
  FROM (SELECT r.symbol, ts, ns, CASE h WHEN 0 THEN a ELSE m END AS lo, CASE h WHEN 0 THEN m ELSE z END AS hi
        FROM (SELECT *, (a + z) // 2 - ((a + z) // 2) % {HOUR} AS m FROM r WHERE n >= 400) r JOIN sums ON sums.symbol = r.symbol, (VALUES (0), (1)) v(h)) x),
parts AS (SELECT symbol, a AS from_ms, z AS to_ms, CAST(n AS BIGINT) AS n FROM r WHERE n < 400)"""


def _saturated(t) -> tuple[DataFrame, DataFrame]:
    e = tape(t).select("symbol", F.col("t").alias("ts_ms"), F.col("qty").cast("string").alias("rate_text"))
    return plan.split_saturated(e.select("symbol").distinct().select("symbol", F.lit(Y2024).alias("from_ms"), F.lit(Y2024 + 32 * DAY).alias("to_ms")), e, 400), e


@query(f"WITH RECURSIVE {SPLIT} SELECT * FROM parts")
def q66_split_saturated(t):
    return _saturated(t)[0]


@query(f"WITH RECURSIVE {SPLIT} SELECT DISTINCT tape.symbol, tape.t AS ts_ms, CAST(qty AS VARCHAR) AS rate_text FROM tape JOIN parts ON parts.symbol = tape.symbol AND t >= from_ms AND t < to_ms")
def q66b_merged_halves(t):
    parts, e = _saturated(t)
    return plan.merged_events(parts, e, ["symbol", "ts_ms", "rate_text"])


@query(f"SELECT symbol, c AS chunk_start_ms, least(c + {7 * DAY}, z) AS chunk_end_ms FROM (SELECT symbol, z, unnest(generate_series(a, z - 1, {7 * DAY})) AS c FROM (SELECT event_type AS symbol, min((epoch_us(ts) // 1000)) AS a, max((epoch_us(ts) // 1000)) + 1 AS z FROM events GROUP BY 1))")
def q67_weekly_chunks(t):
    return plan.chunks(tape(t).groupBy("symbol").agg(F.min("t").alias("from_ms"), (F.max("t") + 1).alias("to_ms")))


@query(f"WITH {TAPE}, w AS (SELECT symbol, t - t % {QUARTER} AS window_ms, count(*) AS trades, CAST(sum(qty) AS BIGINT) AS qty FROM tape GROUP BY ALL) SELECT * FROM w WHERE window_ms + {QUARTER} <= (SELECT max(t) FROM tape) - 60000")
def q60_streaming_15m(t):
    raw = t("events")
    spark, paths = raw.sparkSession, raw.inputFiles()
    stream = spark.readStream.schema(raw.schema).parquet(paths[0].rpartition("/")[0] + "/events.parquet*")
    rows = stream.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.get_json_object("props", "$.k").cast("long").alias("qty"))
    place = scratch(spark)
    decisions.drain(decisions.counted_windows(rows), f"{place}/out", f"{place}/state")
    return spark.read.parquet(f"{place}/out")


from . import more_queries  # noqa: E402, F401  (registers the queries over single rows, stored bodies and files)
from . import source_queries  # noqa: E402, F401  (queries over the data sources)
