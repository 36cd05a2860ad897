"""First trades beyond a price, found through an index of the least and greatest prices of time blocks.

The index has two levels. Of an ask's time, the coarse blocks that can hold a trade beyond its level are found first, then the fine ones
inside these, and only the trades of two fine blocks at most are read: the one the ask begins in, of which a part only counts, and the
first whole one that holds such a trade.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import HOUR, MINUTE

FINE, COARSE = 15 * MINUTE, 4 * HOUR


def block_index(tape: DataFrame, fine: int = FINE) -> DataFrame:
    """symbol, block, low, high of each block of ``fine`` ms with trades (symbol, t, px)."""
    return tape.groupBy("symbol", F.floor(F.col("t") / fine).alias("block")).agg(F.min("px").alias("low"), F.max("px").alias("high"))


def _beyond(low: Column, high: Column, strict: bool) -> Column:
    level = F.col("level")
    if strict:
        return F.when(F.col("falling"), low < level).otherwise(high > level)
    return F.when(F.col("falling"), low <= level).otherwise(high >= level)


def first_passage(asks: DataFrame, tape: DataFrame, index: DataFrame, strict: bool = True, fine: int = FINE, coarse: int = COARSE) -> DataFrame:
    """ask_id, t, seq, px of the first trade of each ask that has one.

    An ask is ask_id, symbol, level, falling (a trade is beyond below the level, else above; at it only if not ``strict``), from_ms, from_seq (trades
    after this one; a null seq: from the millisecond on), until_ms (exclusive). ``tape`` has symbol, t, seq, px, ``index`` is its ``block_index``. Ties of time go
    by seq. Nulls in an ask, or a time that is empty, find nothing."""
    if coarse % fine:
        raise ValueError("a coarse block holds whole fine blocks")
    kept = asks.where("until_ms > from_ms").select("ask_id", "symbol", "level", "falling", "from_ms", "from_seq", "until_ms")
    kept = kept.withColumn("first", F.floor(F.col("from_ms") / fine)).withColumn("last", F.floor((F.col("until_ms") - 1) / fine))
    per = coarse // fine
    wide = index.groupBy("symbol", F.floor(F.col("block") / per).alias("wide")).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    near = kept.withColumn("wide", F.explode(F.sequence(F.floor(F.col("first") / per), F.floor(F.col("last") / per))))
    near = near.join(wide, ["symbol", "wide"]).where(_beyond(F.col("low"), F.col("high"), strict))
    own = F.floor(F.col("first") / per)
    ask = [c for c in kept.columns if c != "ask_id"]
    # the block that an ask begins in may hold its trade before the ask, so the next one that holds one is looked into besides
    found = near.groupBy("ask_id").agg(F.first(F.struct(*ask)).alias("a"), F.min(F.when(F.col("wide") == own, F.col("wide"))).alias("here"), F.min(F.when(F.col("wide") > own, F.col("wide"))).alias("then"))
    found = found.select("ask_id", "a.*", F.explode(F.filter(F.array("here", "then"), lambda w: w.isNotNull())).alias("wide"))
    inner = found.withColumn("block", F.explode(F.sequence(F.col("wide") * per, F.col("wide") * per + per - 1))).where("block BETWEEN first AND last")
    inner = inner.join(index, ["symbol", "block"]).where(_beyond(F.col("low"), F.col("high"), strict))
    blocks = inner.groupBy("ask_id").agg(F.first(F.struct(*ask)).alias("a"), F.min(F.when(F.col("block") == F.col("first"), F.col("block"))).alias("here"), F.min(F.when(F.col("block") > F.col("first"), F.col("block"))).alias("then"))
    blocks = blocks.select("ask_id", "a.*", F.explode(F.filter(F.array("here", "then"), lambda b: b.isNotNull())).alias("block"))
    trades = tape.select("symbol", "t", "seq", "px", F.floor(F.col("t") / fine).alias("block"))
    after = (F.col("t") > F.col("from_ms")) | ((F.col("t") == F.col("from_ms")) & F.coalesce(F.col("seq") > F.col("from_seq"), F.col("from_seq").isNull()))
    hits = blocks.join(trades, ["symbol", "block"]).where(after & (F.col("t") < F.col("until_ms")) & _beyond(F.col("px"), F.col("px"), strict))
    return hits.groupBy("ask_id").agg(F.min(F.struct("t", "seq", "px")).alias("hit")).select("ask_id", "hit.*")
