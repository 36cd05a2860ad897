"""Captured response bodies as rows: bars, funding, instruments, announcements, checkpoints, configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.decimals import STORED
from ..functions.shared import cut
from ..functions.timeops import DAY, is_aligned

ENVELOPE = "retCode INT, retMsg STRING, time BIGINT"
_BAR_LIST = f"{ENVELOPE}, result STRUCT<symbol: STRING, category: STRING, list: ARRAY<ARRAY<STRING>>>"
_FUNDING = f"{ENVELOPE}, result STRUCT<category: STRING, list: ARRAY<STRUCT<symbol: STRING, fundingRate: STRING, fundingRateTimestamp: STRING>>>"
_ANNOUNCED = f"{ENVELOPE}, result STRUCT<total: BIGINT, list: ARRAY<STRUCT<title: STRING, description: STRING, url: STRING, publishTime: STRING, dateTimestamp: STRING>>>"
_INSTRUMENT = "STRUCT<symbol: STRING, contractType: STRING, status: STRING, baseCoin: STRING, quoteCoin: STRING, settleCoin: STRING, launchTime: STRING, deliveryTime: STRING, priceFilter: STRUCT<tickSize: STRING, minPrice: STRING, maxPrice: STRING>, lotSizeFilter: STRUCT<qtyStep: STRING, minOrderQty: STRING, minNotionalValue: STRING, maxOrderQty: STRING, maxMktOrderQty: STRING>, fundingInterval: INT, symbolType: STRING, marketRegion: STRING, isPreListing: BOOLEAN, preListingInfo: STRING>"
_INSTRUMENTS = f"{ENVELOPE}, result STRUCT<category: STRING, list: ARRAY<{_INSTRUMENT}>, nextPageCursor: STRING>"


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: file and body."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))


def _checked(bodies: DataFrame, schema: str) -> DataFrame:
    """``bodies`` with the decoded envelope r; malformed JSON and refusals raise."""
    r = F.from_json("body", schema, {"mode": "FAILFAST"})
    fault = F.concat(F.lit("refused: "), F.coalesce(F.col("r.retCode").cast("string"), F.lit("no code")), F.lit(" "), F.coalesce(F.col("r.retMsg"), F.lit("")))
    return bodies.withColumn("r", r).withColumn("_ok", F.when(F.col("r.retCode").eqNullSafe(F.lit(0)), F.lit(True)).otherwise(F.raise_error(fault).cast("boolean"))).where("_ok").drop("_ok")


def _cells(bodies: DataFrame, least: int, names: tuple[str, ...]) -> DataFrame:
    rows = _checked(bodies, _BAR_LIST).select(*bodies.columns, F.col("r.result.symbol").alias("symbol"), F.posexplode("r.result.list").alias("pos", "cells"))
    wide = F.when(F.size("cells") >= least, F.col("cells")).otherwise(F.raise_error(F.lit("a bar has too few fields")).cast("array<string>"))
    rows = rows.withColumn("cells", wide)
    return rows.select(*[c for c in bodies.columns if c != "body"], "symbol", "pos", F.col("cells")[0].cast("long").alias("start_ms"), *(F.col("cells")[i].cast(STORED).alias(n) for i, n in enumerate(names, 1)))


def bars(bodies: DataFrame) -> DataFrame:
    """symbol, pos, start_ms, OHLCV and turnover as exact decimals, in the order of the page."""
    return _cells(bodies, 7, ("open", "high", "low", "close", "volume", "turnover"))


def mark_or_index_bars(bodies: DataFrame) -> DataFrame:
    return _cells(bodies, 5, ("open", "high", "low", "close"))


def bar_series(pages: DataFrame, start_ms: int, end_ms: int, step: int, now_ms: int) -> tuple[DataFrame, DataFrame]:
    """A multi-page scan over stored pages (symbol, asked_end_ms: the inclusive end a page was asked with; start_ms ... of its raw
    bars; a page without bars has one row with a null start_ms). It goes from the newest page on by the oldest raw start, finished or
    not, and ends at an empty page or at ``start_ms``. Returns the distinct finished bars, and by symbol raw_rows, duplicates,
    unfinished, oldest_ms, newest_ms. A page that holds bars after its own end does not move back, and raises."""
    page = pages.groupBy("symbol", "asked_end_ms").agg(F.min("start_ms").alias("oldest"), F.max("start_ms").alias("newest"))
    page = page.withColumn("next_end", F.col("oldest") - step)
    along = Window.partitionBy("symbol").orderBy(F.desc("asked_end_ms"))
    # a page is reached if its end is the one the page before leads to, and so is every page between it and the first
    led = F.when(F.row_number().over(along) == 1, F.col("asked_end_ms") == end_ms).otherwise((F.col("asked_end_ms") == F.lag("next_end").over(along)) & (F.lag("oldest").over(along) > start_ms))
    page = page.withColumn("led", F.coalesce(led, F.lit(False))).withColumn("reached", F.min("led").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    stuck = F.raise_error(F.lit("the scan does not move backward")).cast("boolean")
    moves = F.when((F.col("oldest") > start_ms) & (F.col("next_end") >= F.col("asked_end_ms")), stuck).otherwise(F.lit(True))
    page = page.where("reached").withColumn("moves", moves).where("moves")
    rows = pages.join(page.select("symbol", "asked_end_ms"), ["symbol", "asked_end_ms"]).where("start_ms IS NOT NULL")
    closed = F.col("start_ms") + step <= now_ms
    stats = rows.groupBy("symbol").agg(F.count("*").alias("raw_rows"), (F.count_if(closed) - F.count_distinct(F.when(closed, F.col("start_ms")))).alias("duplicates"), F.count_if(~closed).alias("unfinished"), F.min("start_ms").alias("oldest_ms"), F.max("start_ms").alias("newest_ms"))
    first = F.min_by(F.struct(*[c for c in rows.columns if c not in ("symbol", "start_ms")]), F.struct(-F.col("asked_end_ms"), *(c for c in ("pos",) if c in rows.columns)))
    return rows.where(closed).groupBy("symbol", "start_ms").agg(first.alias("r")).select("symbol", "start_ms", "r.*"), stats


def funding(bodies: DataFrame) -> DataFrame:
    """symbol, ts_ms, rate and the texts of time and rate, which identify an event."""
    rows = _checked(bodies, _FUNDING).select(F.explode("r.result.list").alias("e"))
    return rows.select("e.symbol", F.col("e.fundingRateTimestamp").cast("long").alias("ts_ms"), F.col("e.fundingRateTimestamp").alias("ts_text"), F.col("e.fundingRate").alias("rate_text"), F.col("e.fundingRate").cast(STORED).alias("rate"))


def announcement_pages(total: int, page_size: int = 20, most: int = 1000) -> int:
    """Pages to ask for; more than ``most`` is an error."""
    pages = -(-total // page_size)
    if pages > most:
        raise ValueError("too many announcement pages")
    return pages


def announcement_scan(bodies: DataFrame, page_size: int = 20, most: int = 1000) -> DataFrame:
    """Announcements of stored pages (page from 1, body): up to the first empty page, or the one that reaches the total it names;
    a page beyond ``most`` raises."""
    r = _checked(bodies, _ANNOUNCED).select("page", F.col("r.result.total").alias("total"), F.col("r.result.list").alias("list"))
    r = r.withColumn("list", F.when(F.col("page") > most, F.raise_error(F.lit("too many announcement pages")).cast(r.schema["list"].dataType)).otherwise(F.col("list")))
    ends = (F.size("list") == 0) | (F.col("page") * page_size >= F.col("total"))
    last = r.agg(F.min(F.when(ends, F.col("page"))).alias("last"))
    kept = r.join(F.broadcast(last), F.col("last").isNull() | (F.col("page") <= F.col("last")))  # one row
    return kept.select("page", F.explode("list").alias("a")).select("page", "a.title", "a.description", "a.url", F.col("a.publishTime").alias("publish_time"), F.col("a.dateTimestamp").alias("date_timestamp"))


def _cursors_once(pages: DataFrame) -> DataFrame:
    """``pages``; a next_cursor that two of them return raises."""
    again = F.count("*").over(Window.partitionBy("next_cursor"))
    fault = F.raise_error(F.lit("a cursor repeats")).cast("boolean")
    return pages.withColumn("_ok", F.when((F.coalesce("next_cursor", F.lit("")) != "") & (again > 1), fault).otherwise(F.lit(True))).where("_ok").drop("_ok")


def _places(links: DataFrame, n: int) -> DataFrame:
    """_c, page: the place of every cursor that the first one leads to. A cursor has one page before it at most, so each looks twice as far
    back in every round, until it sees the first."""
    before = links.where("next <> ''").select(F.col("next").alias("_c"), F.col("_c").alias("far"), F.lit(1).alias("page"))
    places = cut(links.select("_c").distinct().join(before, "_c", "left").where("_c = '' OR far IS NOT NULL").select("_c", F.when(F.col("_c") != "", F.col("far")).alias("far"), F.when(F.col("_c") != "", F.col("page")).otherwise(0).alias("page")))
    for _ in range(n.bit_length()):
        if not places.where("far <> ''").limit(1).count():
            break
        there = places.select(F.col("_c").alias("far"), F.col("far").alias("_far"), F.col("page").alias("_page"))
        # the first cursor has nothing before it; what leads to no page at all, or round and round, never sees it
        seen = places.where("far <> ''").join(there, "far").select("_c", F.col("_far").alias("far"), (F.col("page") + F.col("_page")).alias("page"))
        places = cut(places.where("far IS NULL OR far = ''").unionByName(seen))
    return places.where("far IS NULL OR far = ''").select("_c", "page")


def pages_in_order(pages: DataFrame, most: int = 1000) -> DataFrame:
    """Pages (cursor: the one asked with, null for the first; next_cursor; ...) of one listing, numbered along their cursors from
    the first until an empty one. A cursor that two pages return raises; pages that no cursor leads to do not come. A listing of up to
    ``most`` pages is walked page by page, a longer one by joins that double their reach, as many as its length has bits."""
    named = lambda c: F.coalesce(c, F.lit("")).alias(c)
    links = cut(_cursors_once(pages.select(named("cursor"), named("next_cursor")))).select(F.col("cursor").alias("_c"), F.col("next_cursor").alias("next"))
    n = links.count()
    if n > most:
        return pages.join(_places(links, n), F.coalesce("cursor", F.lit("")) == F.col("_c")).drop("_c")
    known = {r["_c"]: r["next"] for r in links.collect()}
    order, at = [], ""
    while at in known and len(order) < len(known):
        order.append((at, len(order)))
        at = known[at]
        if not at:
            break
    numbered = pages.sparkSession.createDataFrame(order, "_c string, page int")
    return pages.join(F.broadcast(numbered), F.coalesce("cursor", F.lit("")) == F.col("_c")).drop("_c")  # at most ``most`` rows


def instruments(bodies: DataFrame) -> DataFrame:
    """Flat instrument rows; the whole record stays in ``raw``, with fields this schema does not name. A cursor that two
    pages repeat raises. With a column ``cursor``, the one each page was asked with, only pages that the cursors lead to count."""
    pages = _checked(bodies, _INSTRUMENTS).withColumn("next_cursor", F.col("r.result.nextPageCursor"))
    pages = pages_in_order(pages) if "cursor" in bodies.columns else _cursors_once(pages)
    raw = F.from_json(F.get_json_object("body", "$.result.list"), "array<string>")
    rows = pages.select(F.explode(F.arrays_zip(F.col("r.result.list").alias("x"), raw.alias("raw"))).alias("e")).select("e.x", "e.raw")
    fields = {"symbol": "symbol", "contractType": "contract_type", "status": "status", "baseCoin": "base_coin", "quoteCoin": "quote_coin", "settleCoin": "settle_coin", "symbolType": "symbol_type", "marketRegion": "market_region", "isPreListing": "is_pre_listing", "fundingInterval": "funding_interval"}
    return rows.select(
        *(F.col(f"x.{a}").alias(b) for a, b in fields.items()), F.col("x.launchTime").cast("long").alias("launch_ms"), F.coalesce(F.nullif(F.col("x.deliveryTime"), F.lit("")).cast("long"), F.lit(0)).alias("delivery_ms"),
        F.col("x.priceFilter.tickSize").cast(STORED).alias("tick_size"), F.col("x.lotSizeFilter.qtyStep").cast(STORED).alias("qty_step"), "raw",
    )


def checkpoints(spark: SparkSession, path: str, schema: str, key: str | None = None) -> DataFrame:
    """JSON lines, blank ones skipped; with ``key`` the last record of each key in file order."""
    rows = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at")).where(F.trim("value") != "")
    rows = rows.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"), "file", "at")
    if key is None:
        return rows.select("r.*")
    return rows.groupBy(F.col(f"r.{key}")).agg(F.max_by("r", F.struct("file", "at")).alias("r")).select("r.*")


def document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def identity_edges(spark: SparkSession, path: str) -> DataFrame:
    """Identity relations; every edge must forbid stitching, and name its sources."""
    edge = "left_symbol STRING, right_symbol STRING, relation STRING, confidence STRING, source_urls ARRAY<STRING>, evidence_notes STRING, automatic_stitching BOOLEAN"
    rows = document(spark, path, f"version STRING, relationships ARRAY<STRUCT<{edge}>>").select("version", F.explode("relationships").alias("e")).select("version", "e.*")
    sound = F.col("left_symbol").isNotNull() & F.col("right_symbol").isNotNull() & F.col("relation").isNotNull() & (F.size("source_urls") > 0) & ~F.coalesce("automatic_stitching", F.lit(False))
    return rows.withColumn("_ok", F.when(sound, F.lit(True)).otherwise(F.raise_error(F.lit("unsound identity relation")).cast("boolean"))).where("_ok").drop("_ok")


def cacheable(start_ms: Column, end_ms: Column, rows: Column, all_closed: Column, now_ms: int) -> Column:
    """Whether a page may be kept: it is a day old, not empty, and all its bars are closed."""
    return (end_ms <= now_ms - DAY) & (rows > 0) & F.coalesce(all_closed, F.lit(False)) & (end_ms >= start_ms)


def aligned_request(start_ms: Column, end_ms: Column, step: int) -> Column:
    """True, or an error for bounds off the grid or reversed."""
    good = is_aligned(start_ms, step) & is_aligned(end_ms, step) & (end_ms >= start_ms)
    return F.when(good, F.lit(True)).otherwise(F.raise_error(F.lit("request bounds must be aligned")).cast("boolean"))


def trade_tape(spark: SparkSession, path: str) -> DataFrame:
    """Archived public trades, CSV files with a header (symbol, timestamp in seconds, price, size, side): symbol, t in ms, px, qty, seq, side.
    ``seq`` follows the order of the lines of a file, and the file's name."""
    rows = spark.read.option("header", True).option("mode", "FAILFAST").schema("timestamp DECIMAL(20,6), symbol STRING, side STRING, size STRING, price STRING").csv(path)
    exact = lambda c: F.col(c).cast(STORED)
    return rows.select("symbol", F.floor(F.col("timestamp") * 1000).cast("long").alias("t"), exact("price").alias("px"), exact("size").alias("qty"), F.monotonically_increasing_id().alias("seq"), "side")


def calendar(spark: SparkSession, path: str, before_ms: int = 30 * 60_000, after_ms: int = 30 * 60_000) -> DataFrame:
    """News calendar, CSV with a header (family, event_ms, source): family, event_ms and the blackout [from_ms, to_ms). A row without a source,
    or of an unknown family, raises."""
    rows = spark.read.option("header", True).schema("family STRING, event_ms LONG, source STRING").csv(path)
    good = F.col("family").isin("CPI", "NFP", "FOMC") & (F.coalesce("source", F.lit("")) != "") & F.col("event_ms").isNotNull()
    checked = rows.withColumn("_ok", F.when(good, F.lit(True)).otherwise(F.raise_error(F.lit("unsound calendar row")).cast("boolean"))).where("_ok").drop("_ok")
    return checked.select("family", "event_ms", (F.col("event_ms") - before_ms).alias("from_ms"), (F.col("event_ms") + after_ms).alias("to_ms"))


def delistings(spark: SparkSession, path: str) -> DataFrame:
    """Delisting records, JSON lines: symbol, known_at_ms, effective_ms (the entry restriction, or else the delivery), settlement_price, source.
    A record that becomes known after it takes effect, or names no source, raises."""
    rows = spark.read.schema("symbol STRING, known_at_ms LONG, delivery_ms LONG, entry_restriction_ms LONG, settlement_price STRING, source STRING").option("mode", "FAILFAST").json(path)
    good = F.col("symbol").isNotNull() & F.col("known_at_ms").isNotNull() & (F.col("delivery_ms") >= F.col("known_at_ms")) & (F.coalesce("source", F.lit("")) != "")
    checked = rows.withColumn("_ok", F.when(F.coalesce(good, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit("unsound delisting record")).cast("boolean"))).where("_ok")
    return checked.select("symbol", "known_at_ms", F.coalesce("entry_restriction_ms", "delivery_ms").alias("effective_ms"), F.col("settlement_price").cast(STORED).alias("settlement_price"), "source")
