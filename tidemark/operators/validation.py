"""Validation statistics: trades, drawdowns, block bootstrap, slippage quantiles, drift gate, decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.decimals import adverse_bps
from ..functions.hashing import sha256
from ..functions.shared import cut
from ..functions.timeops import DAY
from .passage import block_index, first_passage
from .quantiles import exact


def trade_stats(trades: DataFrame, by: list[str], r: str = "net_r", order: str = "closed_ms", width_ms: int = 7 * DAY) -> DataFrame:
    """Per group: number, total, mean, median, win rate, profit factor, largest drawdown, longest losing streak. What depends on the
    order is computed in time buckets of a group, each with the sums, peak and wins of the buckets before it."""
    cell = [*by, "_bucket"]
    run = Window.partitionBy(*cell).orderBy(order, "trade_id").rowsBetween(Window.unboundedPreceding, 0)
    t = trades.withColumn("_bucket", F.floor(F.col(order) / width_ms)).repartition(*cell)
    t = t.withColumn("_cum", F.sum(r).over(run)).withColumn("_wins", F.coalesce(F.sum((F.col(r) >= 0).cast("long")).over(run), F.lit(0))).withColumn("_peak", F.max("_cum").over(run))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    b = t.groupBy(*cell).agg(F.sum(r).alias("_sum"), F.max("_cum").alias("_hi"), F.min("_cum").alias("_lo"), F.max(F.col("_peak") - F.col("_cum")).alias("_dd"), F.max("_wins").alias("_won"))
    b = b.withColumn("_sum", F.coalesce(F.sum("_sum").over(before), F.lit(0.0))).withColumn("_won", F.coalesce(F.sum("_won").over(before), F.lit(0)))
    b = b.withColumn("_top", F.greatest(F.lit(0.0), F.max(F.col("_sum") + F.col("_hi")).over(before)))
    drawdown = b.groupBy(*by).agg(F.round(F.max(F.greatest("_dd", F.col("_top") - F.col("_sum") - F.col("_lo"))), 6).alias("max_drawdown"))
    runs = t.where(F.col(r) < 0).groupBy(*cell, "_wins").agg(F.count("*").alias("_n")).join(b.select(*cell, "_won"), cell)
    streaks = runs.groupBy(*by, (F.col("_wins") + F.col("_won")).alias("_id")).agg(F.sum("_n").alias("_n")).groupBy(*by).agg(F.max("_n").alias("_streak"))
    lost = -F.sum(F.when(F.col(r) < 0, F.col(r)))
    plain = trades.groupBy(*by).agg(
        F.count("*").alias("n"), F.round(F.sum(r), 6).alias("total_r"), F.round(F.avg(r), 6).alias("mean_r"),
        F.round(F.avg((F.col(r) > 0).cast("double")), 6).alias("win_rate"), F.round(F.sum(F.when(F.col(r) > 0, F.col(r))) / F.nullif(lost, F.lit(0.0)), 6).alias("profit_factor"),
    )
    median = exact(trades, by, r, (0.5,)).select(*by, F.round(F.col("q")[0], 6).alias("median_r"))
    return plain.join(median, by, "left").join(drawdown, by, "left").join(streaks, by, "left").withColumn("longest_losing_streak", F.coalesce("_streak", F.lit(0))).drop("_streak")


def bootstrap(weekly: DataFrame, weeks: DataFrame, resamples: int = 20_000, seed: str = "bootstrap") -> DataFrame:
    """Percentile interval of the mean result of a trade over resampled weeks. ``weeks`` (week_no from 0) lists all weeks, empty ones
    too; ``weekly`` has week_no, total, n. Draws come from sha256, so that any engine repeats them."""
    spark = weekly.sparkSession
    n = weeks.count()
    known = F.broadcast(weeks.join(weekly, "week_no", "left").select("week_no", F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce("n", F.lit(0)).alias("n")))  # a row a week
    draws = spark.range(resamples).withColumnRenamed("id", "b").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    head = F.conv(F.substring(sha256(F.concat_ws(":", F.lit(seed), "b", "i")), 1, 8), 16, 10).cast("long")
    drawn = draws.withColumn("week_no", F.pmod(head, F.lit(n))).join(known, "week_no")
    means = drawn.groupBy("b").agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("mean"))
    p = F.percentile("mean", F.array(F.lit(0.025), F.lit(0.975)))
    return means.agg(F.count("mean").alias("resamples"), F.round(p[0], 6).alias("ci_low"), F.round(p[1], 6).alias("ci_high"))


def slippage_quantiles(rows: DataFrame, buckets: list[str], value: str = "bps", least: int = 30) -> DataFrame:
    """p75, p95 and p99 of each bucket; a bucket with fewer than ``least`` values takes those of the next broader one. All depths come from one pass,
    and a bucket looks its broader ones up by their keys."""
    levels = exact(rows, buckets, value, (0.75, 0.95, 0.99), tuple(range(len(buckets), -1, -1))).where((F.col("n") >= least) | (F.col("depth") == 0))
    named = levels.select(F.struct("depth", *buckets).alias("_at"), "q")
    own = rows.select(*buckets).distinct()
    tries = F.array(*(F.struct(F.lit(d).alias("depth"), *(F.col(b) if i < d else F.lit(None).cast(rows.schema[b].dataType).alias(b) for i, b in enumerate(buckets))) for d in range(len(buckets), -1, -1)))
    each = own.withColumn("_own", F.struct(*buckets)).withColumn("_at", F.explode(tries)).join(named, "_at")
    best = each.groupBy("_own").agg(F.max_by(F.struct("_at.depth", "q"), "_at.depth").alias("b"))
    return best.select("_own.*", "b.depth", *(F.round(F.col("b.q")[i], 6).alias(n) for i, n in enumerate(("p75", "p95", "p99"))))


def drift_gate(exits: DataFrame, expected_bps: Column, n: int = 20, block: int = 10_000) -> DataFrame:
    """Median of the last ``n`` standard exits of a class (by t, id), once there are so many, and whether it blocks. Exits are
    numbered by class and day, with the counts of earlier days before them, and dealt in blocks of numbers; each block
    also gets the ``n`` - 1 exits before it, so that a frequent class spreads over as many tasks as it has blocks."""
    exits = exits.withColumn("_day", F.floor(F.col("t") / 86_400_000))
    earlier = Window.partitionBy("exit_class").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    before = exits.groupBy("exit_class", "_day").count().withColumn("_before", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    before = before.select(F.col("exit_class").alias("_class"), F.col("_day").alias("_date"), "_before")
    numbered = exits.withColumn("_no", F.row_number().over(Window.partitionBy("exit_class", "_day").orderBy("t", "id", "bps")))
    numbered = numbered.join(before, F.col("exit_class").eqNullSafe(F.col("_class")) & F.col("_day").eqNullSafe(F.col("_date")))
    numbered = numbered.withColumn("_no", F.col("_no") + F.col("_before") - 1)
    own = F.floor(F.col("_no") / block)
    dealt = numbered.withColumn("_block", F.explode(F.sequence(own, F.floor((F.col("_no") + (n - 1)) / block))))
    w = Window.partitionBy("exit_class", "_block").orderBy("_no").rowsBetween(-(n - 1), 0)
    median = F.when(F.count("bps").over(w) == n, F.percentile("bps", 0.5).over(w))
    out = dealt.withColumn("median_bps", F.round(median, 6)).where(F.col("_block") == own).drop("_day", "_class", "_date", "_before", "_no", "_block")
    return out.withColumn("blocked", F.coalesce(F.col("median_bps") > F.greatest(1.25 * expected_bps, expected_bps + 2.0), F.lit(False)))


def unavailability(evaluations: DataFrame, most: float = 0.001, least_days: int = 30, least: int = 3000) -> DataFrame:
    """Share of decisions without data, and whether it passes over enough days and evaluations (t, available)."""
    rate = F.count_if(~F.col("available")) / F.count("*")
    days = (F.max("t") - F.min("t")) / 86_400_000
    return evaluations.agg(F.count("*").alias("evaluations"), F.round(rate, 6).alias("rate"), ((rate <= most) & (days >= least_days) & (F.count("*") >= least)).alias("passed"))


def validation_decision(metrics: DataFrame) -> DataFrame:
    """The validation gate on metrics (config, n, mean_r, total_r, stress_mean_r, stress_total_r): PASS, FAIL_VALIDATION where a sign is
    wrong or fewer than 8 neighbours are positive, INCONCLUSIVE_VALIDATION where only the sample is too small."""
    neighbours = metrics.where("config <> 'BASE'").agg(F.count_if(F.col("mean_r") > 0).alias("good_neighbours"))
    base = metrics.where("config = 'BASE'").join(neighbours, F.lit(True), "left")  # one row each
    signs = (F.col("mean_r") > 0) & (F.col("total_r") > 0) & (F.col("stress_mean_r") >= 0) & (F.col("stress_total_r") >= 0) & (F.col("good_neighbours") >= 8)
    decision = F.when(~F.coalesce(signs, F.lit(False)), "FAIL_VALIDATION").when(F.col("n") < 100, "INCONCLUSIVE_VALIDATION").otherwise("PASS")
    return base.select("n", "mean_r", "total_r", "good_neighbours", decision.alias("decision"))


def final_decision(n: Column, signs: Column, good_neighbours: Column, ci_low: Column) -> Column:
    """PASS, FAIL or INCONCLUSIVE of the combined sample; ``signs`` says whether every required sign holds."""
    return F.when(~F.coalesce(signs, F.lit(False)) | (good_neighbours < 8), "FAIL").when((n < 200) | ~F.coalesce(ci_low > 0, F.lit(False)), "INCONCLUSIVE").otherwise("PASS")


def slippage_events(setups: DataFrame, tape: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Slippage of stops, whatever the cost model: for each structural setup (setup_id, symbol, side, entry, stop, active_ms, level, and the
    flags universe_ok, trend_ok, volume_ok, session_ok, news_ok, room_ok, grid_ok) the first trade beyond the stop after its entry was
    penetrated, and its adverse distance in basis points. Cost floor, sizing and capacity take no part.

    ``tape`` has symbol, t, px, seq. Both trades are first passages, found through an index of the tape's blocks (``index``, or made here), so a setup
    reads the trades of four blocks at most, not those of a day."""
    sound = F.col("universe_ok") & F.col("trend_ok") & F.col("volume_ok") & F.col("session_ok") & F.col("news_ok") & F.col("room_ok") & F.col("grid_ok")
    index = cut(block_index(tape)) if index is None else index
    kept = setups.where(sound).select(F.col("setup_id").alias("ask_id"), "symbol", "side", "entry", "stop", (F.col("side") == "LONG").alias("falling"), (F.col("active_ms") + DAY).alias("until_ms"), "active_ms")
    filled = first_passage(kept.select("*", F.col("entry").alias("level"), F.col("active_ms").alias("from_ms"), F.lit(None).cast("long").alias("from_seq")), tape, index)
    open_ = kept.join(filled.select("ask_id", F.col("t").alias("from_ms"), F.col("seq").alias("from_seq")), "ask_id").withColumn("level", F.col("stop"))
    hit = first_passage(open_, tape, index, strict=False).join(kept.select("ask_id", "side", "stop"), "ask_id")
    return hit.select(F.col("ask_id").alias("setup_id"), F.col("t").alias("stopped_ms"), adverse_bps(F.col("side"), F.col("px"), F.col("stop")).alias("bps"))
