"""Queries over operators of single rows, stored bodies and files. What a reader reads, the query writes to the shared folder first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .functions import decimals, hashing, timeops
from .functions.timeops import DAY, HOUR, MINUTE
from .operators import audit, bars, funding, indicators, inventory, plan, strategy, validation
from .plans import pipelines
from .queries import _LINE, EMA, LEVELS, ORACLE_SQL, LIFE, QUARTER, SHOWN, TAPE, Y2024, _levels, _life, bars_sql, ms, query, scratch, seg_sql, shown, tape, text
from .sources import fetch, responses, store
from .streaming import decisions


def spark_of(t):
    return t("region").sparkSession


def json_lines(rows: DataFrame, spark) -> str:
    """Path of a folder with the column value of ``rows`` as lines."""
    path = scratch(spark)
    rows.select("value").coalesce(1).write.text(path)
    return path


# single rows


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(CAST(l_quantity AS DECIMAL(14,4)) * CAST(l_extendedprice AS DECIMAL(14,6)) * CAST((l_partkey % 7 - 3) * 0.0001 AS DECIMAL(10,8)) AS DECIMAL(38,18)) AS VARCHAR) AS fee FROM lineitem")
def q68_funding_fee(t):
    rate = ((F.col("l_partkey") % 7 - 3) * F.lit("0.0001").cast("decimal(10,8)")).cast("decimal(10,8)")
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", decimals.funding_fee(F.col("l_quantity"), F.col("l_extendedprice"), rate).cast("string").alias("fee"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(greatest(0, CASE WHEN l_partkey % 2 = 0 THEN l_extendedprice - l_extendedprice * (0.99 + l_suppkey % 5 / 200.0::DOUBLE) ELSE l_extendedprice * (0.99 + l_suppkey % 5 / 200.0::DOUBLE) - l_extendedprice END / l_extendedprice * 10000), 4) AS bps FROM lineitem")
def q69_adverse_bps(t):
    side = F.when(F.col("l_partkey") % 2 == 0, "LONG").otherwise("SHORT")
    fill = F.col("l_extendedprice") * (0.99 + F.col("l_suppkey") % 5 / 200.0)
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(decimals.adverse_bps(side, fill, F.col("l_extendedprice")), 4).alias("bps"))


@query("SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY epoch_ms(o_orderdate) ORDER BY o_totalprice DESC, o_custkey % 7 DESC, lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS INTEGER) AS rank FROM orders")
def q70_admission_rank(t):
    rows = t("orders").select("o_orderkey", ms("o_orderdate").alias("activation_ms"), F.col("o_totalprice").alias("turnover_sum"), (F.col("o_custkey") % 7).alias("volume_ratio"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("symbol"))
    return rows.select("o_orderkey", indicators.admission_rank().alias("rank"))


@query("SELECT 'P' || p_partkey AS symbol, p_size * 60 AS funding_interval FROM part WHERE p_size * 60 <= 240 ORDER BY funding_interval, symbol LIMIT 2")
def q71_fast_funding(t):
    return inventory.fast_funding(t("part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"), (F.col("p_size") * 60).alias("funding_interval")))


@query("SELECT o_orderkey, o + 60000 AS activation_ms, least(o + 7200000, o - o % 86400000 + 46800000) AS expiry_ms FROM (SELECT o_orderkey, epoch_ms(o_orderdate) + (o_orderkey % 780) * 60000 AS o FROM orders)")
def q77_activation_expiry(t):
    rows = t("orders").select("o_orderkey", (ms("o_orderdate") + (F.col("o_orderkey") % 780) * MINUTE).alias("o"))
    return rows.select("o_orderkey", timeops.activation_ms(F.col("o")).alias("activation_ms"), timeops.expiry_ms(F.col("o"), timeops.align_down(F.col("o"), DAY) + 13 * HOUR).alias("expiry_ms"))


_CONFIGS = "m AS (SELECT CASE WHEN o_custkey % 11 = 0 THEN 'BASE' ELSE 'n' || (o_custkey % 11) END AS config, count(*) AS n, avg(x) AS mean_r, sum(x) AS total_r, avg(x - 0.01) AS stress_mean_r, sum(x - 0.01) AS stress_total_r FROM (SELECT o_custkey, (CAST(o_totalprice AS BIGINT) % 101 - 45) / 100.0::DOUBLE AS x FROM orders) GROUP BY 1)"


def _configs(t) -> DataFrame:
    x = (F.floor(F.rint("o_totalprice")).cast("long") % 101 - 45) / F.lit(100.0)
    config = F.when(F.col("o_custkey") % 11 == 0, "BASE").otherwise(F.concat(F.lit("n"), (F.col("o_custkey") % 11).cast("string")))
    return t("orders").groupBy(config.alias("config")).agg(F.count("*").alias("n"), F.avg(x).alias("mean_r"), F.sum(x).alias("total_r"), F.avg(x - 0.01).alias("stress_mean_r"), F.sum(x - 0.01).alias("stress_total_r"))


@query(f"""WITH {_CONFIGS}, g AS (SELECT count_if(mean_r > 0) AS k FROM m WHERE config <> 'BASE') SELECT n, round(mean_r, 6) AS mean_r, round(total_r, 4) AS total_r, k AS good_neighbours,
CASE WHEN NOT (mean_r > 0 AND total_r > 0 AND stress_mean_r >= 0 AND stress_total_r >= 0 AND k >= 8) THEN 'FAIL_VALIDATION' WHEN n < 100 THEN 'INCONCLUSIVE_VALIDATION' ELSE 'PASS' END AS decision FROM m, g WHERE config = 'BASE'""")
def q78_validation_decision(t):
    d = validation.validation_decision(_configs(t))
    return d.withColumn("mean_r", F.round("mean_r", 6)).withColumn("total_r", F.round("total_r", 4))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 OR c_custkey % 11 < 8 THEN 'FAIL' WHEN c_custkey < 200 OR c_nationkey <= 3 THEN 'INCONCLUSIVE' ELSE 'PASS' END AS decision FROM customer")
def q78b_final_decision(t):
    k = F.col("c_custkey")
    return t("customer").select("c_custkey", validation.final_decision(k, k % 5 != 0, k % 11, F.col("c_nationkey") - 3).alias("decision"))


@query("SELECT c_custkey, a <= c AS covers, CASE WHEN c % 60000 <> 0 THEN NULL ELSE true END AS aligned, c <= 1700000000000 - 86400000 AND n > 0 AND n % 3 <> 0 AS cacheable FROM (SELECT c_custkey, c_custkey % 50 AS n, 1699900000000 + c_custkey * 1000000 AS c, 1699900000000 AS a FROM customer)")
def q82_cache_admission(t):
    k = F.col("c_custkey")
    end = F.lit(1_699_900_000_000) + k * 1_000_000
    on_grid = F.when(timeops.is_aligned(end, MINUTE), responses.aligned_request(timeops.align_down(end, MINUTE), timeops.align_down(end, MINUTE), MINUTE))
    return t("customer").select("c_custkey", inventory.covers_month(F.lit(1_699_900_000_000), F.lit(0), F.lit(1_699_900_000_000), end).alias("covers"), on_grid.alias("aligned"), responses.cacheable(end, end, k % 50, k % 50 % 3 != 0, 1_700_000_000_000).alias("cacheable"))


@query("SELECT c_custkey, c_custkey / 10.0::DOUBLE AS start_s FROM customer")
def q82b_paced_requests(t):
    return fetch.paced(t("customer").select("c_custkey", F.col("c_custkey").alias("n"))).select("c_custkey", "start_s")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(38,10)) AS VARCHAR) AS back FROM lineitem")
def q82c_scaled_int_round_trip(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", decimals.from_scaled_int(decimals.scaled_int(F.col("l_extendedprice").cast("decimal(18,2)"))).cast("string").alias("back"))


@query("""WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity > 2 AS a, l_discount < 0.1 AS b, l_tax < 0.07 AS c, l_returnflag <> 'R' AS d, l_linestatus = 'O' AS e, l_partkey % 3 <> 0 AS f, l_suppkey % 5 <> 0 AS v, l_orderkey % 7 <> 0 AS n, l_extendedprice > 5000 AS r, l_quantity < 45 AS k FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN NOT a THEN 'REJECT_DATA_GAP' WHEN NOT b THEN 'REJECT_SESSION' WHEN NOT c THEN 'REJECT_GRID_UNKNOWN' WHEN NOT d THEN 'REJECT_WRONG_LEVEL_DIRECTION' WHEN NOT e THEN 'REJECT_TREND_ALT' WHEN NOT f THEN 'REJECT_TREND_BTC' WHEN NOT v THEN 'REJECT_VOLUME' WHEN NOT n THEN 'REJECT_NEWS' WHEN NOT r THEN 'REJECT_ROOM' WHEN NOT k THEN 'REJECT_COST_FLOOR' END AS reason FROM g""")
def q92_setup_reason(t):
    c = F.col
    reason = strategy.setup_reason(data=c("l_quantity") > 2, session=c("l_discount") < 0.1, grid=c("l_tax") < 0.07, direction=c("l_returnflag") != "R", trend_alt=c("l_linestatus") == "O", trend_btc=c("l_partkey") % 3 != 0, volume=c("l_suppkey") % 5 != 0, news=c("l_orderkey") % 7 != 0, room=c("l_extendedprice") > 5000, cost=c("l_quantity") < 45)
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", reason.alias("reason"))


@query("SELECT p_partkey, coalesce(CASE WHEN p_partkey % 2 = 0 THEN goal - p_retailprice ELSE p_retailprice - goal END >= 2 * p_size, true) AS room, round(p_retailprice * 0.0002 + (p_retailprice - p_size) * (0.0006 + 0.0004), 6) AS cost FROM (SELECT *, CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice + (p_partkey % 200 - 100) END AS goal FROM part)")
def q92b_room_and_cost(t):
    k, price = F.col("p_partkey"), F.col("p_retailprice")
    side, goal = F.when(k % 2 == 0, "LONG").otherwise("SHORT"), F.when(k % 5 != 0, price + (k % 200 - 100))
    rate = lambda x: F.lit(x).cast("decimal(12,8)")
    cost = decimals.stop_cost(price, price - F.col("p_size"), rate("0.0002"), rate("0.0006"), rate("0.0004"))
    return t("part").select("p_partkey", strategy.room_ok(side, price, goal, F.col("p_size").cast("double")).alias("room"), F.round(cost.cast("double"), 6).alias("cost"))


@query("WITH v(code) AS (VALUES " + ", ".join(f"('{r}')" for r in strategy.REASONS) + f"), r AS ({ORACLE_SQL['q92_setup_reason']}) SELECT code, count(reason) AS n FROM v LEFT JOIN r ON reason = code GROUP BY code")
def q92c_reason_codes(t):
    """How many setups each code refuses; codes that refuse none have 0."""
    codes = spark_of(t).createDataFrame([(r,) for r in strategy.REASONS], "code string")
    refused = q92_setup_reason(t).where("reason IS NOT NULL").groupBy(F.col("reason").alias("code")).agg(F.count("*").alias("n"))
    return codes.join(refused, "code", "left").select("code", F.coalesce("n", F.lit(0)).alias("n"))


# bars, signals, audits


@query(f"""WITH RECURSIVE {EMA}, e AS (SELECT n.symbol, n.start_ms, n.x, m, m > lag(m, 3) OVER (PARTITION BY n.symbol, n.segment ORDER BY n.start_ms) AS up FROM n LEFT JOIN ema ON ema.symbol = n.symbol AND ema.segment = n.segment AND ema.k = n.k)
SELECT a.symbol, a.start_ms, coalesce(a.x > a.m AND a.up, false) AND coalesce(b.x > b.m AND b.up, false) AS both_long FROM e a LEFT JOIN e b ON b.symbol = 'view' AND b.start_ms = a.start_ms""")
def q93_both_trends(t):
    e = indicators.ema(bars.tape_to_bars(tape(t), HOUR), HOUR, 5).select("symbol", "start_ms", F.col("close").cast("double").alias("x"), "ema", "ema_rising", "ema_falling")
    lead = e.where("symbol = 'view'").select("start_ms", *(F.col(c).alias(f"b_{c}") for c in ("x", "ema", "ema_rising", "ema_falling")))
    leg = lambda p: tuple(F.col(p + c) for c in ("x", "ema", "ema_rising", "ema_falling"))
    return e.join(lead, "start_ms", "left").select("symbol", "start_ms", strategy.both_trends_ok(F.lit("LONG"), leg(""), leg("b_")).alias("both_long"))


@query(f"""WITH {LEVELS}, {bars_sql(HOUR, 'hb')}, mv AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY start_ms) AS pc, start_ms - start_ms % {DAY} AS d, CASE WHEN count(*) OVER w = 20 THEN avg(CAST(volume AS DOUBLE)) OVER w END AS av FROM hb WINDOW w AS (PARTITION BY symbol ORDER BY start_ms ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
SELECT mv.symbol, start_ms, side, CAST(CASE WHEN side = 'LONG' THEN max(price) ELSE min(price) END AS VARCHAR) AS level FROM mv JOIN ml ON ml.symbol = mv.symbol AND ml.day_ms = d
WHERE ((side = 'LONG' AND pc <= price AND close > price) OR (side = 'SHORT' AND pc >= price AND close < price)) AND CAST(volume AS DOUBLE) / nullif(av, 0) >= 1.5 GROUP BY mv.symbol, start_ms, side""")
def q94_confirmed_breakouts(t):
    h = bars.tape_to_bars(tape(t), HOUR)
    c = strategy.crosses(h, strategy.merge_levels(_levels(t)), timeops.align_down(F.col("start_ms"), DAY))
    return strategy.confirmed(c, indicators.volume_ratio(h)).select("symbol", "start_ms", "side", F.col("level").cast("string").alias("level"))


_SETUPS = f"s AS (SELECT symbol || ':' || start_ms AS setup_id, symbol, CASE WHEN start_ms % 7200000 = 0 THEN 'LONG' ELSE 'SHORT' END AS side, close AS entry, CASE WHEN start_ms % 7200000 = 0 THEN close - 3 ELSE close + 3 END AS stop, start_ms + {HOUR} AS a FROM b WHERE volume > 5)"


@query(f"""WITH {TAPE}, {bars_sql(HOUR)}, {_SETUPS}, n AS (SELECT s.*, t, seq, px FROM s JOIN tape USING (symbol) WHERE t >= a AND t < a + {DAY}),
f AS (SELECT setup_id, min((t, seq)) AS f FROM n WHERE CASE side WHEN 'LONG' THEN px < entry ELSE px > entry END GROUP BY setup_id),
h AS (SELECT setup_id, any_value(side) AS side, any_value(stop) AS stop, arg_min(t, (t, seq)) AS stopped_ms, arg_min(px, (t, seq)) AS px FROM n JOIN f USING (setup_id) WHERE (t, seq) > f AND CASE side WHEN 'LONG' THEN px <= stop ELSE px >= stop END GROUP BY setup_id)
SELECT setup_id, stopped_ms, round(greatest(0, CASE side WHEN 'LONG' THEN stop - px ELSE px - stop END)::DOUBLE / stop::DOUBLE * 10000, 4) AS bps FROM h""")
def q95_slippage_events(t):
    b = bars.tape_to_bars(tape(t), HOUR)
    long = F.col("start_ms") % 7_200_000 == 0
    flags = [(F.col("volume") > 5).alias("volume_ok"), *(F.lit(True).alias(f"{c}_ok") for c in ("universe", "trend", "session", "news", "room", "grid"))]
    setups = b.select(F.concat_ws(":", "symbol", F.col("start_ms").cast("string")).alias("setup_id"), "symbol", F.when(long, "LONG").otherwise("SHORT").alias("side"), F.col("close").alias("entry"), F.when(long, F.col("close") - 3).otherwise(F.col("close") + 3).alias("stop"), (F.col("start_ms") + HOUR).alias("active_ms"), *flags)
    return validation.slippage_events(setups, tape(t)).withColumn("bps", F.round("bps", 4))


@query(f"""WITH {LIFE}, d AS (SELECT o_custkey AS id, epoch_ms(o_orderdate) - epoch_ms(o_orderdate) % {DAY} AS day FROM orders GROUP BY ALL) SELECT symbol FROM life WHERE id IN (SELECT d.id FROM d JOIN life l ON l.id = d.id WHERE day < l.launch_ms - l.launch_ms % {DAY} AND day >= l.launch_ms - l.launch_ms % {DAY} - {300 * DAY})""")
def q72_prelaunch_history(t):
    daily = t("orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), timeops.align_down(ms("o_orderdate"), DAY).alias("start_ms"))
    return audit.prelaunch_history(daily, _life(t), 300).select("symbol")


@query(f"""WITH {LIFE}, e AS (SELECT *, coalesce(first_trade_ms, launch_ms) AS o, CASE WHEN delivery_ms > coalesce(first_trade_ms, launch_ms) THEN delivery_ms ELSE {Y2024} END AS z FROM life), p AS (SELECT *, o + greatest(0, z - o) // 2 - (o + greatest(0, z - o) // 2) % 60000 AS p FROM e),
n AS (SELECT p.symbol, count(o_orderkey) AS n FROM p LEFT JOIN orders ON o_custkey = id AND epoch_ms(o_orderdate) BETWEEN greatest(o, p - {40 * DAY}) AND least(z - 1, p + {40 * DAY}) GROUP BY p.symbol)
SELECT symbol, p AS checkpoint_ms, CASE WHEN id % 2 = 0 THEN n ELSE 0 END AS event_count, CASE WHEN id % 2 <> 0 THEN 'NOT_APPLICABLE' WHEN n > 0 THEN 'DATA_PRESENT' WHEN p < launch_ms THEN 'BEFORE_LAUNCH' WHEN first_trade_ms IS NOT NULL AND p < first_trade_ms THEN 'BEFORE_FIRST_TRADE' WHEN delivery_ms > 0 AND p >= delivery_ms THEN 'AFTER_DELIST' ELSE 'EMPTY_DURING_LIFETIME' END AS classification FROM p JOIN n USING (symbol)""")
def q73_funding_probes(t):
    life = _life(t).withColumn("contract_type", F.when(F.col("id") % 2 == 0, "LinearPerpetual").otherwise("LinearFutures"))
    events = t("orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), ms("o_orderdate").alias("ts_ms"))
    return audit.funding_probes(life, events, Y2024, 40)


@query(f"""WITH {LIFE} SELECT symbol, CASE WHEN first_trade_ms IS NULL THEN 'UNKNOWN' WHEN first_trade_ms - launch_ms >= {365 * DAY} THEN 'PLACEHOLDER_SUSPECTED' ELSE 'OBSERVED_METADATA' END AS launch_time_quality, first_trade_ms - launch_ms AS launch_to_first_trade_ms,
coalesce(first_trade_ms < launch_ms - launch_ms % 60000, false) OR id % 13 = 0 AS lifetime_metadata_conflict FROM life""")
def q74_lifetime_report(t):
    life = _life(t)
    return audit.lifetime_report(life, life.where("id % 13 = 0"))


@query(f"""WITH {LIFE} SELECT symbol, launch_ms - launch_ms % 60000 AS checkpoint_ms, 'FIRST_TRADE_NOT_FOUND' AS classification, 0::BIGINT AS expected_count, NULL AS error FROM life WHERE first_trade_ms IS NULL
UNION ALL SELECT symbol, launch_ms, 'API_ERROR', 30, 'timeout ' || id FROM life WHERE id % 17 = 0""")
def q74b_error_rows(t):
    life = _life(t)
    w = timeops.probe_window(F.col("launch_ms"))
    probes = life.select("symbol", F.lit("near_launch").alias("checkpoint"), F.col("launch_ms").alias("checkpoint_ms"), w["start_ms"].alias("start_ms"), w["end_ms"].alias("end_ms"))
    faults = life.where("id % 17 = 0").select("symbol", F.lit("near_launch").alias("checkpoint"), F.concat(F.lit("timeout "), F.col("id").cast("string")).alias("error"))
    both = audit.missing_first_trades(life).unionByName(audit.failed_probes(probes, faults), allowMissingColumns=True)
    return both.select("symbol", "checkpoint_ms", "classification", "expected_count", "error")


@query(f"WITH {TAPE}, {bars_sql(QUARTER)}, s AS (SELECT symbol, unnest(generate_series(min(start_ms), max(start_ms), {QUARTER})) AS start_ms FROM b GROUP BY symbol) SELECT symbol, start_ms FROM s ANTI JOIN b USING (symbol, start_ms) ORDER BY symbol, start_ms LIMIT 10000")
def q91_first_missing(t):
    b = bars.tape_to_bars(tape(t), QUARTER)
    ranges = b.groupBy("symbol").agg(F.min("start_ms").alias("from_ms"), (F.max("start_ms") + QUARTER).alias("to_ms"))
    return bars.first_missing(bars.missing_slots(b, ranges, QUARTER))


@query(f"WITH {TAPE}, {bars_sql(QUARTER)}, o AS (SELECT symbol, start_ms, open FROM b WHERE start_ms % 3 = 0 OR trades > 1) SELECT symbol, start_ms FROM o WHERE open <> round(open) ORDER BY symbol, start_ms LIMIT 100")
def q91b_first_mismatches(t):
    b = bars.tape_to_bars(tape(t), QUARTER).where("start_ms % 3 = 0 OR trades > 1")
    found = bars.reconcile(b, b.withColumn("open", F.round("open").cast(b.schema["open"].dataType)))
    return bars.first_mismatches(found).select("symbol", "start_ms")


@query("SELECT 'C' || c_custkey AS symbol, CASE c_custkey % 2 WHEN 0 THEN 'Trading' ELSE 'Closed' END AS status FROM customer")
def q98_union_inventories(t):
    rows = t("customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"), F.when(F.col("c_custkey") % 2 == 0, "Trading").otherwise("Closed").alias("status"))
    return inventory.union_inventories(rows.where("status = 'Trading'"), rows.where("status = 'Closed'"))


@query("SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 1 OR o_orderstatus = 'P'")
def q90_pages_missing(t):
    pages = t("orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    return plan.planned_pages_missing(pages, pages.where("k % 3 = 1 AND o_orderstatus <> 'P'"), ["k"]).select("k")


# stored bodies


def envelope(result: Column) -> Column:
    return F.to_json(F.struct(F.lit(0).alias("retCode"), F.lit("OK").alias("retMsg"), F.lit(5).cast("long").alias("time"), result.alias("result")))


def bar_bodies(t, fields: tuple[str, ...], step: int = QUARTER) -> DataFrame:
    """A page a symbol and day: symbol, day, body."""
    b = bars.tape_to_bars(tape(t), step)
    cell = F.array(F.col("start_ms").cast("string"), *(F.col(c).cast("string") for c in fields))
    pages = b.groupBy("symbol", F.floor(F.col("start_ms") / DAY).alias("day")).agg(F.sort_array(F.collect_list(F.struct("start_ms", cell.alias("c"))), asc=False).alias("rows"))
    return pages.select("symbol", "day", envelope(F.struct(F.col("symbol"), F.lit("linear").alias("category"), F.transform("rows", lambda r: r["c"]).alias("list"))).alias("body"))


@query(f"WITH {TAPE}, {bars_sql(QUARTER)} SELECT {SHOWN} FROM b")
def q83_bar_pages(t):
    return shown(responses.bars(bar_bodies(t, bars.FIELDS).select("body")))


@query(f"WITH {TAPE}, {bars_sql(HOUR)} SELECT symbol, start_ms, CAST(CAST(open AS DECIMAL(38,2)) AS VARCHAR) AS open, CAST(CAST(close AS DECIMAL(38,2)) AS VARCHAR) AS close FROM b")
def q83b_mark_pages(t):
    return responses.mark_or_index_bars(bar_bodies(t, ("open", "high", "low", "close"), HOUR).select("body")).select("symbol", "start_ms", text("open").alias("open"), text("close").alias("close"))


@query("SELECT event_type AS symbol, (epoch_us(ts) // 1000) AS ts_ms, CAST(CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS VARCHAR) AS rate FROM events")
def q84_funding_pages(t):
    item = F.struct("symbol", F.col("px").cast("string").alias("fundingRate"), F.col("t").cast("string").alias("fundingRateTimestamp"))
    pages = tape(t).groupBy("symbol", F.col("seq") % 10).agg(F.collect_list(item).alias("list")).select(envelope(F.struct(F.lit("linear").alias("category"), F.col("list"))).alias("body"))
    return responses.funding(pages).select("symbol", "ts_ms", F.col("rate").cast("string").alias("rate"))


@query("""WITH r AS (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 20 + 1 AS page, count(*) OVER () AS total FROM documents) SELECT page, md5(coalesce(substr(text, 1, 60), '')) AS title_md5, CAST(doc_id AS VARCHAR) AS publish_time FROM r""")
def q84b_announcement_scan(t):
    docs = t("documents")
    w = Window.partitionBy("cell").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    cells = docs.withColumn("cell", F.floor(F.col("doc_id") / 1000))
    before = cells.groupBy("cell").count().withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("cell", "before")
    numbered = cells.withColumn("n", F.count("*").over(w)).join(before, "cell").select(F.floor((F.col("before") + F.col("n") - 1) / 20).alias("page0"), "doc_id", F.coalesce(F.substring("text", 1, 60), F.lit("")).alias("title"))
    item = F.struct("title", F.lit("").alias("description"), F.lit("u").alias("url"), F.col("doc_id").cast("string").alias("publishTime"), F.lit("0").alias("dateTimestamp"))
    total = docs.count()
    pages = numbered.groupBy((F.col("page0") + 1).alias("page")).agg(F.collect_list(item).alias("list")).select("page", envelope(F.struct(F.lit(total).cast("long").alias("total"), F.col("list"))).alias("body"))
    assert responses.announcement_pages(total, most=10**9) == -(-total // 20)
    found = responses.announcement_scan(pages, most=10**9)
    return found.select("page", F.md5("title").alias("title_md5"), "publish_time")


_RECORD = """'{"audit_sample_candidate":true,"baseCoin":"B","contractType":"LinearPerpetual","current_crypto_perpetual_eligible":true,"deliveryTime":"' || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END || '","launchTime":"' || c_custkey * 1000 || '","lotSizeFilter":{"qtyStep":"0.1"},"marketRegion":"","priceFilter":{"tickSize":"0.01"},"quoteCoin":"USDT","settleCoin":"USDT","status":"' || CASE WHEN c_custkey % 2 = 0 THEN 'Trading' ELSE 'Closed' END || '","symbol":"' || c_name || '","symbolType":""}'"""


def _listing(t) -> DataFrame:
    """Pages of 100 instruments, each asked with the cursor that the page before returns, and one that no cursor leads to."""
    s = lambda x: F.lit(x)
    k = F.col("c_custkey")
    item = F.struct(
        F.col("c_name").alias("symbol"), s("LinearPerpetual").alias("contractType"), F.when(k % 2 == 0, "Trading").otherwise("Closed").alias("status"), s("B").alias("baseCoin"), s("USDT").alias("quoteCoin"), s("USDT").alias("settleCoin"), (k * 1000).cast("string").alias("launchTime"),
        F.when(k % 2 == 0, "").otherwise(k.cast("string")).alias("deliveryTime"), F.struct(s("0.01").alias("tickSize")).alias("priceFilter"), F.struct(s("0.1").alias("qtyStep")).alias("lotSizeFilter"), s("").alias("symbolType"), s("").alias("marketRegion"),
    )
    rows = t("customer").select(F.floor(k / 100).alias("p"), item.alias("x"))
    last = rows.agg(F.max("p").alias("last"))
    pages = rows.groupBy("p").agg(F.collect_list("x").alias("list")).join(F.broadcast(last))  # one row
    follow = F.when(F.col("p") < F.col("last"), F.concat(F.lit("c"), (F.col("p") + 1).cast("string"))).otherwise("")
    asked = F.when(F.col("p") > 0, F.concat(F.lit("c"), F.col("p").cast("string")))
    made = pages.select(asked.alias("cursor"), envelope(F.struct(s("linear").alias("category"), F.col("list"), follow.alias("nextPageCursor"))).alias("body"))
    stray = made.where("cursor IS NULL").select(F.lit("zz").alias("cursor"), F.regexp_replace("body", '"nextPageCursor":"[^"]*"', '"nextPageCursor":""').alias("body"))
    return made.unionByName(stray)


@query("SELECT c_name AS symbol, CASE WHEN c_custkey % 2 = 0 THEN 'Trading' ELSE 'Closed' END AS status, c_custkey * 1000 AS launch_ms, CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE c_custkey END AS delivery_ms, '0.010000000000000000' AS tick_size FROM customer")
def q85_instrument_pages(t):
    return responses.instruments(_listing(t)).select("symbol", "status", "launch_ms", "delivery_ms", F.col("tick_size").cast("string").alias("tick_size"))


@query(f"SELECT sha256('[' || string_agg({_RECORD}, ',' ORDER BY c_name) || ']') AS inventory_sha256, count(*) AS instruments FROM customer")
def q75_inventory_hash(t):
    return pipelines.inventory_hash(responses.instruments(_listing(t)).withColumn("eligible", F.lit(True)))


_END = Y2024 + 40 * DAY - QUARTER


@query(f"WITH {TAPE}, {bars_sql(QUARTER)} SELECT symbol, count(*) AS raw_rows, 0::BIGINT AS duplicates, count_if(start_ms + {QUARTER} > {Y2024 + 20 * DAY}) AS unfinished, min(start_ms) AS oldest_ms, max(start_ms) AS newest_ms, count_if(start_ms + {QUARTER} <= {Y2024 + 20 * DAY}) AS bars FROM b GROUP BY symbol")
def q86_bar_series(t):
    b = bars.tape_to_bars(tape(t), QUARTER).select("symbol", "start_ms", "close")
    w = Window.partitionBy("symbol").orderBy(F.desc("start_ms"))
    paged = b.withColumn("page", F.floor((F.row_number().over(w) - 1) / 100))
    ends = paged.groupBy("symbol", "page").agg(F.min("start_ms").alias("oldest"))
    ends = ends.withColumn("asked_end_ms", F.coalesce(F.lag("oldest").over(Window.partitionBy("symbol").orderBy("page")) - QUARTER, F.lit(_END))).drop("oldest")
    pages = paged.join(ends, ["symbol", "page"]).drop("page")
    stray = pages.withColumn("asked_end_ms", F.lit(-5).cast("long")).where("start_ms % 7 = 0")  # asked with an end that no page leads to
    found, stats = responses.bar_series(pages.unionByName(stray), 0, _END, QUARTER, Y2024 + 20 * DAY)
    return stats.join(found.groupBy("symbol").agg(F.count("*").alias("bars")), "symbol", "left").withColumn("bars", F.coalesce("bars", F.lit(0)))


def _store(t) -> tuple[DataFrame, str]:
    """Raw pages written twice: what is stored first stays. Returns what is stored, and a folder."""
    spark = spark_of(t)
    path = scratch(spark)
    pages = bar_bodies(t, bars.FIELDS).select(
        "symbol", F.date_format(F.timestamp_millis(F.col("day") * DAY), "yyyy-MM").alias("month"), F.lit("bars:1").alias("stream"), F.sha2(F.concat_ws(":", "symbol", F.col("day").cast("string")), 256).alias("request_key"),
        (F.col("day") * DAY).alias("range_start_ms"), (F.col("day") * DAY + DAY).alias("range_end_ms"), F.encode("body", "UTF-8").alias("raw"),
    )
    store.put(pages, f"{path}/raw")
    store.put(pages.withColumn("raw", F.encode(F.lit("{}"), "UTF-8")), f"{path}/raw", spark.read.parquet(f"{path}/raw"))
    return store.stored(spark, f"{path}/raw"), path


@query(f"WITH {TAPE}, {bars_sql(QUARTER)} SELECT {SHOWN} FROM b")
def q87_stored_pages(t):
    return shown(store.rebuild_bars(_store(t)[0], 0, 1 << 60))


@query(f"WITH {TAPE}, {bars_sql(QUARTER)} SELECT symbol, strftime(make_timestamp(start_ms * 1000), '%Y-%m') AS month, sha256(string_agg({_LINE}, '' ORDER BY start_ms)) AS logical_sha256, count(*) AS row_count FROM b GROUP BY ALL")
def q88_canonical_files(t):
    """Months are written one call after the other, and the first one twice; all must be there at the end."""
    pages, path = _store(t)
    whole = store.rebuild_bars(pages, 0, 1 << 60).withColumn("month", F.date_format(F.timestamp_millis("start_ms"), "yyyy-MM"))
    for part in ("2024-01", "", "2024-01"):
        own = whole.where(F.col("month") == part) if part else whole.where("month <> '2024-01'")
        store.write_bars(own, f"{path}/bars", only=own.select("symbol", "month").distinct())
    return hashing.logical_hash(whole.sparkSession.read.schema(whole.schema).parquet(f"{path}/bars"), ["symbol", "month"])


@query(f"WITH {TAPE}, {bars_sql(QUARTER)}, f AS (SELECT DISTINCT symbol, strftime(make_timestamp(start_ms * 1000), '%Y-%m') AS month FROM b) SELECT count(*) AS files, true AS hashed FROM f")
def q88b_file_hashes(t):
    pages, path = _store(t)
    store.write_bars(store.rebuild_bars(pages, 0, 1 << 60).withColumn("month", F.date_format(F.timestamp_millis("start_ms"), "yyyy-MM")), f"{path}/bars")
    return store.file_hashes(spark_of(t), f"{path}/bars").agg(F.count("*").alias("files"), F.bool_and(F.length("file_sha256") == 64).alias("hashed"))


@query("SELECT md5(c_name) AS key, sha256(c_name) AS sha256, octet_length(encode(c_name)) AS bytes FROM customer WHERE c_custkey % 3 = 0")
def q81_response_cache(t):
    path = f"{scratch(spark_of(t))}/cache"
    rows = t("customer").select("c_custkey", F.md5("c_name").alias("key"), F.encode("c_name", "UTF-8").alias("raw"))
    store.cache(rows.where("c_custkey % 2 = 0"), path)
    store.cache(rows.where("c_custkey % 2 = 1").unionByName(rows.withColumn("raw", F.encode(F.lit("later"), "UTF-8")).where("c_custkey % 2 = 0")), path)
    return store.cached(spark_of(t), path, rows.where("c_custkey % 3 = 0")).select("key", "sha256", F.col("bytes").cast("long").alias("bytes"))


@query("SELECT 'C' || c_custkey AS symbol, CASE WHEN c_custkey % 4 = 0 THEN c_custkey * 10 ELSE c_custkey END AS first_trade_ms FROM customer")
def q79_checkpoint_lines(t):
    spark = spark_of(t)
    line = lambda v: F.to_json(F.struct(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"), v.alias("first_trade_ms")))
    rows = t("customer").select(F.lit(0).alias("o"), line(F.col("c_custkey")).alias("value")).union(t("customer").where("c_custkey % 4 = 0").select(F.lit(1), line(F.col("c_custkey") * 10))).union(spark.range(3).select(F.lit(2), F.lit("  ")))
    path = json_lines(rows.repartition(1).sortWithinPartitions("o"), spark)
    return responses.checkpoints(spark, path, "symbol STRING, first_trade_ms LONG", "symbol")


@query("SELECT 'v1' AS version, n_name AS left_symbol, 'X' || n_name AS right_symbol, 'renamed' AS relation, 's' || n_nationkey AS source FROM nation")
def q80_identity_document(t):
    spark = spark_of(t)
    edge = F.struct(F.col("n_name").alias("left_symbol"), F.concat(F.lit("X"), F.col("n_name")).alias("right_symbol"), F.lit("renamed").alias("relation"), F.lit("high").alias("confidence"), F.array(F.concat(F.lit("s"), F.col("n_nationkey").cast("string"))).alias("source_urls"), F.lit("").alias("evidence_notes"), F.lit(False).alias("automatic_stitching"))
    doc = t("nation").agg(F.collect_list(edge).alias("relationships")).select(F.to_json(F.struct(F.lit("v1").alias("version"), "relationships")).alias("value"))
    return responses.identity_edges(spark, json_lines(doc, spark)).select("version", "left_symbol", "right_symbol", "relation", F.col("source_urls")[0].alias("source"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q89_lines_and_reports(t):
    """Appended as JSON lines, read, written as sorted documents and as a CSV report, and read again."""
    spark, path = spark_of(t), scratch(spark_of(t))
    rows = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    kind = "n_nationkey INT, n_name STRING, n_regionkey INT"
    store.append_lines(rows.where("n_nationkey < 10"), f"{path}/lines")
    store.append_lines(rows.where("n_nationkey >= 10"), f"{path}/lines")
    store.write_documents(spark.read.schema(kind).json(f"{path}/lines"), f"{path}/documents")
    store.write_report(spark.read.schema(kind).json(f"{path}/documents"), f"{path}/report")
    types = {f.name: f.dataType for f in rows.schema}
    return spark.read.option("header", True).csv(f"{path}/report").select(*(F.col(c).cast(types[c]).alias(c) for c in rows.columns))


@query("SELECT event_type AS symbol, (epoch_us(ts) // 1000) AS t, CAST(CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS VARCHAR) AS px, CASE WHEN event_id % 2 = 0 THEN 'Buy' ELSE 'Sell' END AS side FROM events")
def q24b_trade_tape_files(t):
    path = scratch(spark_of(t))
    rows = tape(t).select((F.col("t") / F.lit(1000).cast("decimal(5,0)")).cast("decimal(20,6)").alias("timestamp"), "symbol", F.when(F.col("seq") % 2 == 0, "Buy").otherwise("Sell").alias("side"), F.col("qty").alias("size"), F.col("px").alias("price"))
    rows.write.option("header", True).csv(path)
    return responses.trade_tape(spark_of(t), path).select("symbol", "t", F.col("px").cast("string").alias("px"), "side")


@query(f"SELECT CASE o_orderkey % 3 WHEN 0 THEN 'CPI' WHEN 1 THEN 'NFP' ELSE 'FOMC' END AS family, epoch_ms(o_orderdate) AS event_ms, epoch_ms(o_orderdate) - {30 * MINUTE} AS from_ms, epoch_ms(o_orderdate) + {30 * MINUTE} AS to_ms FROM orders")
def q25b_calendar_and_delistings(t):
    path = scratch(spark_of(t))
    k = F.col("o_orderkey")
    t("orders").select(F.when(k % 3 == 0, "CPI").when(k % 3 == 1, "NFP").otherwise("FOMC").alias("family"), ms("o_orderdate").alias("event_ms"), F.lit("agency").alias("source")).write.option("header", True).csv(path)
    return responses.calendar(spark_of(t), path)


@query("SELECT 'C' || o_custkey AS symbol, epoch_ms(o_orderdate) AS known_at_ms, epoch_ms(o_orderdate) + CASE WHEN o_orderkey % 2 = 0 THEN 86400000 ELSE 172800000 END AS effective_ms, CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS VARCHAR) AS settlement_price FROM orders")
def q25c_delisting_records(t):
    path = scratch(spark_of(t))
    at = ms("o_orderdate")
    t("orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), at.alias("known_at_ms"), (at + 2 * DAY).alias("delivery_ms"), F.when(F.col("o_orderkey") % 2 == 0, at + DAY).alias("entry_restriction_ms"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("settlement_price"), F.lit("notice").alias("source")).write.json(path)
    return responses.delistings(spark_of(t), path).select("symbol", "known_at_ms", "effective_ms", F.col("settlement_price").cast("string").alias("settlement_price"))


# hashes of stored pages and events


_PAGE_FIELDS = {
    "logical": ("endpoint", "page_end_ms", "page_start_ms", "params_json", "payload_sha256", "raw_bytes", "raw_rows", "raw_sha256"), "payload": ("endpoint", "page_end_ms", "page_start_ms", "params_json", "payload_sha256", "raw_rows"),
    "aux": ("endpoint", "params_json", "payload_sha256", "range_end_ms", "range_start_ms", "raw_bytes", "raw_rows", "raw_sha256", "request_key", "stream"), "aux_payload": ("endpoint", "params_json", "payload_sha256", "range_end_ms", "range_start_ms", "raw_rows", "request_key", "stream"),
}
_NUMBERS = ("page_end_ms", "page_start_ms", "raw_bytes", "raw_rows", "range_end_ms", "range_start_ms")


def _index_sql(kind: str) -> str:
    cells = " || ',' || ".join(f"""'"{f}":' || {f}""" if f in _NUMBERS else f"""'"{f}":"' || {f} || '"'""" for f in _PAGE_FIELDS[kind])
    order = "stream, range_start_ms, endpoint, params_json" if kind.startswith("aux") else "page_start_ms"
    return f"SELECT '{kind}' AS kind, k, sha256(string_agg('{{' || {cells} || '}}' || chr(10), '' ORDER BY {order})) AS index_sha256 FROM p GROUP BY k"


@query(
    "WITH p AS (SELECT o_custkey % 50 AS k, o_orderkey AS page_start_ms, o_orderkey + 9 AS page_end_ms, o_orderkey AS range_start_ms, o_orderkey + 9 AS range_end_ms, '/v/x' AS endpoint, 'p' || o_orderkey AS params_json, sha256('r' || o_orderkey) AS raw_sha256, sha256('p' || o_orderkey) AS payload_sha256, o_orderkey % 100 AS raw_bytes, o_orderkey % 7 AS raw_rows, 'q' || o_orderkey AS request_key, o_orderstatus AS stream FROM orders) "
    + " UNION ALL ".join(map(_index_sql, _PAGE_FIELDS))
)
def q76_index_hashes(t):
    o, s = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    named = lambda p: F.concat(F.lit(p), s)
    pages = t("orders").select(
        (F.col("o_custkey") % 50).alias("k"), o.alias("page_start_ms"), (o + 9).alias("page_end_ms"), o.alias("range_start_ms"), (o + 9).alias("range_end_ms"), F.lit("/v/x").alias("endpoint"), named("p").alias("params_json"), F.sha2(named("r"), 256).alias("raw_sha256"), F.sha2(named("p"), 256).alias("payload_sha256"),
        (o % 100).alias("raw_bytes"), (o % 7).alias("raw_rows"), named("q").alias("request_key"), F.col("o_orderstatus").alias("stream"),
    )
    out = None
    for kind in hashing.INDEXES:
        one = hashing.index_hash(pages, ["k"], kind).select(F.lit(kind).alias("kind"), "k", "index_sha256")
        out = one if out is None else out.unionByName(one)
    return out


@query("""WITH r AS (SELECT o_custkey % 50 AS k, o_orderkey AS ts, '{"funding_rate":"0.0001","funding_rate_timestamp_ms":' || o_orderkey || ',"hour_aligned":' || (o_orderkey % 2 = 0) || ',"mark_60m_open":null,"mark_approximate":false,"mark_price":"' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '","mark_source":"MARK_1M_OPEN","sample_match":null,"sampled_1m_open":null,"sampled_exact_1m":true,"symbol":"S"}' AS j FROM orders)
SELECT k, sha256('[' || string_agg(j, ',' ORDER BY ts) || ']') AS funding_sha256, count(*) AS funding_rows FROM r GROUP BY k""")
def q76b_funding_hash(t):
    none = F.lit(None).cast("string")
    rows = t("orders").select(
        (F.col("o_custkey") % 50).alias("k"), F.lit("S").alias("symbol"), F.col("o_orderkey").alias("funding_rate_timestamp_ms"), F.lit("0.0001").alias("funding_rate"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("mark_price"), F.lit("MARK_1M_OPEN").alias("mark_source"), F.lit(False).alias("mark_approximate"),
        (F.col("o_orderkey") % 2 == 0).alias("hour_aligned"), F.lit(True).alias("sampled_exact_1m"), none.alias("sampled_1m_open"), none.alias("mark_60m_open"), none.cast("boolean").alias("sample_match"),
    )
    return hashing.funding_hash(rows, ["k"])


# streams


def _stream(t, rows: DataFrame) -> tuple[DataFrame, str]:
    path = scratch(spark_of(t))
    rows.write.parquet(f"{path}/in")
    return spark_of(t).readStream.schema(rows.schema).parquet(f"{path}/in"), path


@query(f"WITH {TAPE}, {bars_sql(MINUTE)}, w AS (SELECT symbol, start_ms - start_ms % {QUARTER} AS window_ms, count(*) AS n, CAST(arg_min(open, start_ms) AS VARCHAR) AS open, CAST(arg_max(close, start_ms) AS VARCHAR) AS close FROM b GROUP BY ALL) SELECT symbol, window_ms, n, n = 15 AS available, open, close FROM w WHERE window_ms + {QUARTER} <= (SELECT max(start_ms) FROM b) + 59999 - 60000")
def q60b_streamed_windows(t):
    stream, path = _stream(t, bars.tape_to_bars(tape(t), MINUTE).select("symbol", "start_ms", "open", "high", "low", "close", "volume"))
    decisions.drain(decisions.closed_windows(stream), f"{path}/out", f"{path}/state")
    return spark_of(t).read.parquet(f"{path}/out").select("symbol", "window_ms", "n", "available", F.col("open").cast("string").alias("open"), F.col("close").cast("string").alias("close"))


@query(f"WITH RECURSIVE {EMA} SELECT n.symbol, n.start_ms, round(m, 6) AS ema FROM n LEFT JOIN ema ON ema.symbol = n.symbol AND ema.segment = n.segment AND ema.k = n.k")
def q60c_streamed_ema(t):
    """The chain is kept per symbol; the second half of the tape comes to a second run, which goes on from the state of the first."""
    b = bars.tape_to_bars(tape(t), HOUR).select("symbol", "start_ms", "close")
    spark, path = spark_of(t), scratch(spark_of(t))
    for part in (F.col("start_ms") < Y2024 + 15 * DAY, F.col("start_ms") >= Y2024 + 15 * DAY):
        b.where(part).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(b.schema).parquet(f"{path}/in")
        decisions.drain(decisions.ema_chain(stream, HOUR, 5), f"{path}/out", f"{path}/state")
    return spark.read.parquet(f"{path}/out").select("symbol", "start_ms", F.when(~F.isnan("ema"), F.round("ema", 6)).alias("ema"))


@query(f"WITH RECURSIVE {TAPE}, {bars_sql(HOUR)}, {seg_sql('b', HOUR)} SELECT count(*) AS n, count(DISTINCT (symbol, segment)) AS segments FROM g")
def q41b_segment_totals(t):
    s = bars.segments(bars.tape_to_bars(tape(t), HOUR), HOUR, 24)
    return s.agg(F.count("*").alias("n"), F.count_distinct(F.struct("symbol", "segment")).alias("segments"))
