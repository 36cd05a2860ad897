"""Instruments: eligibility, conflicts, counts, default selections, identity edges, delisting announcements."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import substrings
from ..functions.shared import cut

#: Words that make an announcement a delisting candidate; symbols a pilot prefers, in order; the
#: closed symbol it wants.
KEYWORDS = ("delist", "migration", "migrate", "conversion", "upgrade")
PREFERRED = ("BTCUSDT", "ETHUSDT", "SOLUSDT", "XRPUSDT", "DOGEUSDT", "ADAUSDT")
WANTED_CLOSED = "MATICUSDT"


def eligible(contract: Column, quote: Column, settle: Column, status: Column, pre_listing: Column, region: Column, kind: Column) -> Column:
    """Linear USDT perpetuals of a plain kind, trading or closed, outside pre-listing; an unknown flag passes."""
    plain = F.lower(F.coalesce(kind, F.lit(""))).isin("", "innovation")
    return (contract == "LinearPerpetual") & (quote == "USDT") & (settle == "USDT") & status.isin("Trading", "Closed") & ~pre_listing.eqNullSafe(F.lit(True)) & (F.coalesce(region, F.lit("")) == "") & plain


def audit_candidate(is_eligible: Column, symbol: Column, status: Column) -> Column:
    return is_eligible | F.upper(symbol).contains("OLD") | ~status.isin("Trading", "Closed")


def union_inventories(*parts: DataFrame, ordered: bool = True) -> DataFrame:
    """Union of inventories by status, sorted by symbol if ``ordered``; a symbol in several raises."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    twice = duplicates(whole).select("symbol", F.lit(True).alias("_twice"))
    checked = whole.join(twice, "symbol", "left").withColumn("_ok", F.when(F.col("_twice"), F.raise_error(F.concat(F.lit("symbol in several inventories: "), F.col("symbol")))).otherwise(F.lit(True)))
    out = checked.where("_ok").drop("_twice", "_ok")
    return out.orderBy("symbol") if ordered else out


def duplicates(rows: DataFrame, key: str = "symbol") -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def counts_with_zeros(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows of each value of a dimension, 0 where there is none."""
    return dimension.join(rows.groupBy(key).agg(F.count("*").alias("n")), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def covers_month(launch: Column, delivery: Column, start: Column, end: Column) -> Column:
    """Whether a lifetime covers [start, end) whole: launched by its start, not delivered before its end."""
    return (launch <= start) & ((F.coalesce(delivery, F.lit(0)) <= 0) | (delivery >= end))


def default_selection(rows: DataFrame, preferred: tuple[str, ...] = PREFERRED, wanted_closed: str = WANTED_CLOSED, target: int = 9, closed: int = 3) -> DataFrame:
    """symbol, position: preferred trading symbols in their order, the wanted closed one, closed ascending until there are
    ``closed``, trading ascending; the first ``target``. ``rows`` are eligible instruments (symbol, status)."""
    order = F.array_position(F.array(*map(F.lit, preferred)), F.col("symbol"))
    is_closed = F.col("status") == "Closed"
    by_symbol = Window.partitionBy("status").orderBy(F.col("symbol") != wanted_closed, "symbol")
    ranked = rows.withColumn("rank", F.row_number().over(by_symbol)).withColumn(
        "class", F.when(~is_closed & (order > 0), 0).when(is_closed & (F.col("rank") <= closed), 1).when(~is_closed, 2)
    )
    place = F.when(F.col("class") == 0, order.cast("long")).when((F.col("class") == 1) & (F.col("symbol") == wanted_closed), F.lit(0)).otherwise(F.lit(1))
    picked = ranked.where("class IS NOT NULL").withColumn("place", place).orderBy("class", "place", "symbol").limit(target)
    return picked.select("symbol", "status", F.row_number().over(Window.orderBy("class", "place", "symbol")).alias("position"))


def pilot_selection(rows: DataFrame, required: str = PREFERRED[0], **options) -> DataFrame:
    """``default_selection``, or an error where ``required`` or every closed symbol is absent from it."""
    picked = default_selection(rows, **options)
    said = picked.agg(F.count_if(F.col("symbol") == required).alias("_there"), F.count_if(F.col("status") == "Closed").alias("_closed"))
    error = lambda text: F.raise_error(F.lit(text)).cast("boolean")
    # the condition reads both sides, so that no empty side lets the join, and with it the error, go
    sound = F.when(F.col("_there") == 0, error(f"{required} is not among the eligible symbols")).when(F.col("_closed") == 0, error("no closed symbol is eligible")).otherwise(F.col("symbol").isNotNull())
    return said.join(picked, F.lit(True), "left").where(sound).select(*picked.columns)  # one row on the left


def fast_funding(rows: DataFrame, count: int = 2, most_minutes: int = 240) -> DataFrame:
    """The ``count`` instruments of the shortest funding intervals, at most ``most_minutes``; ties by symbol."""
    return rows.where(F.col("funding_interval") <= most_minutes).orderBy("funding_interval", "symbol").limit(count)


def identity_overlap(edges: DataFrame, instruments: DataFrame) -> DataFrame:
    """Edges (left_symbol, right_symbol, relation) with the lifetimes of both sides and their overlap; an edge without
    either side goes. Identities are never stitched. The overlap is null where a launch or every delivery is missing."""
    side = lambda p: instruments.select(F.col("symbol").alias(f"{p}_symbol"), F.col("launch_ms").alias(f"{p}_launch_ms"), F.coalesce("delivery_ms", F.lit(0)).alias(f"{p}_delivery_ms"))
    joined = edges.join(side("left"), "left_symbol", "left").join(side("right"), "right_symbol", "left")
    joined = joined.where("left_launch_ms IS NOT NULL OR right_launch_ms IS NOT NULL")
    ends = [F.when(F.col(f"{p}_delivery_ms") > 0, F.col(f"{p}_delivery_ms")) for p in ("left", "right")]
    start = F.when(F.col("left_launch_ms").isNotNull() & F.col("right_launch_ms").isNotNull(), F.greatest("left_launch_ms", "right_launch_ms"))
    end = F.least(*ends)  # skips nulls
    overlap = F.when(start.isNotNull() & end.isNotNull(), F.greatest(F.lit(0), end - start))
    return joined.select("left_symbol", "right_symbol", "relation", F.col("left_launch_ms").isNotNull().alias("left_present"), F.col("right_launch_ms").isNotNull().alias("right_present"), "left_launch_ms", "left_delivery_ms", "right_launch_ms", "right_delivery_ms", overlap.alias("metadata_overlap_ms"), F.lit(False).alias("automatic_stitching"))


#: Names that are compared with every text one by one; names that go to all tasks, some 100 bytes each; bits of the bitmap for a
#: name, and the power of two of all its bits at most (32 MB).
FEW_NAMES, MOST_NAMES, NAME_BITS, MOST_POWER = 64, 1 << 18, 128, 28


def _name_filter(names: DataFrame, n_names: int) -> substrings.Names:
    """A bitmap of ``names``, made by the tasks; its words, of which there are at most 2^22, come to the driver."""
    power = min(MOST_POWER, max(16, (NAME_BITS * n_names - 1).bit_length()))

    def bits(batches):
        for batch in batches:
            yield pa.record_batch([substrings.bits_of(batch.column(0), power)], ["bit"])

    words = names.mapInArrow(bits, "bit long").groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")).toArrow()
    bitmap = np.zeros(1 << power - 6, "<i8")
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    return substrings.Names(bitmap.view(np.uint8), power, sorted(r[0] for r in names.select(F.octet_length("name")).distinct().collect()))


def names_in_texts(texts: DataFrame, names: DataFrame, few: int = FEW_NAMES, most: int = MOST_NAMES) -> DataFrame:
    """_id, name of every name (a column of distinct, not empty texts) that occurs anywhere in a text (_id, _text, and columns that stay).

    Up to ``few`` names are looked for one by one. With more, the substrings of a text that a bitmap of the names does not rule out are told
    where the text is read, each once, and are held against the names, which go to all tasks up to ``most``. Beyond that the texts
    are read twice: the distinct substrings are joined with the names first, and the few that are none go to all tasks. So neither texts
    nor rows of the result are shuffled, and neither all names nor all texts are in one place. Only where more than ``most`` substrings
    are no names, which takes many millions of names, the rows are."""
    kept = [c for c in texts.columns if c != "_text"]
    names = cut(names.select("name"))
    n_names = names.count()
    if n_names <= few:
        known = F.array(*(F.lit(r["name"]) for r in names.collect())).cast("array<string>")
        found = F.transform(F.array("_text"), lambda t: F.filter(known, lambda n: t.contains(n)))[0]  # the array: a text is made once
        return texts.select(*kept, F.explode_outer(found).alias("name")).where("name IS NOT NULL")
    sent = texts.sparkSession.sparkContext.broadcast(_name_filter(names, n_names))

    def told(batches):
        for batch in batches:
            for found in substrings.held(batch.column(len(kept)), sent.value):
                for some in found.to_batches(1 << 16):
                    own = batch.select(kept).take(some.column("owner"))
                    yield pa.record_batch([*own.columns, some.column("name").cast(pa.string())], [*kept, "name"])

    rows = texts.select(*kept, "_text")
    maybe = rows.mapInArrow(told, T.StructType([*rows.schema.fields[:-1], T.StructField("name", T.StringType())]))
    if n_names <= most:
        return maybe.join(F.broadcast(names), "name", "left_semi").select(*kept, "name")
    wrong = cut(maybe.select("name").distinct().join(names, "name", "left_anti"))
    return maybe.join(F.broadcast(wrong) if wrong.count() <= most else wrong, "name", "left_anti").select(*kept, "name")


def delisting_candidates(announcements: DataFrame, instruments: DataFrame, keywords: tuple[str, ...] = KEYWORDS, ordered: bool = True) -> DataFrame:
    """Announcements with a keyword that name a delivered instrument by symbol or base coin, anywhere in the text."""
    text = F.upper(F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit(""))))

    def hit(text: Column) -> Column:
        out = F.lit(False)
        for k in keywords:
            out = out | text.contains(k.upper())
        return out

    named = announcements.where(F.exists(F.array(text), hit)).select("title", "description", "publish_time", text.alias("_text"), F.monotonically_increasing_id().alias("_id"))
    closed = instruments.where(F.coalesce("delivery_ms", F.lit(0)) > 0).select("symbol", "base_coin", "delivery_ms", F.upper("symbol").alias("_symbol"), F.upper("base_coin").alias("_coin"))
    by_name = closed.select("*", F.explode(F.array_distinct(F.array("_symbol", "_coin"))).alias("name")).where("name <> ''").withColumn("_exact", F.coalesce(F.col("name") == F.col("_symbol"), F.lit(False)))
    found = names_in_texts(named, by_name.select("name").distinct())
    # by its coin an instrument is found only where its symbol is not
    other = ~F.coalesce(text.contains(F.nullif(F.col("_symbol"), F.lit(""))), F.lit(False))
    joined = found.join(by_name, "name").where(F.col("_exact") | other)
    published = F.coalesce(F.col("publish_time").try_cast("long"), F.lit(0))
    kind = F.when(F.col("_exact"), "EXACT_SYMBOL").otherwise("BASE_COIN_CANDIDATE")
    out = joined.select("symbol", "base_coin", "delivery_ms", kind.alias("match_kind"), "title", "description", published.alias("publish_time_ms"))
    return out.orderBy("symbol", "publish_time_ms", "title") if ordered else out
