"""Times as integer UTC milliseconds: intervals, alignment, sessions, months, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000
#: Bar codes and their lengths in milliseconds; W is seven days from the epoch, see week_start_ms.
INTERVALS = {"1": 60_000, "3": 180_000, "5": 300_000, "15": 900_000, "30": 1_800_000, "60": 3_600_000, "120": 7_200_000, "240": 14_400_000, "360": 21_600_000, "720": 43_200_000, "D": 86_400_000, "W": 604_800_000}
#: Sessions by local wall clock (zone, start, end), half-open.
SESSIONS = {"EU": ("Europe/Amsterdam", "09:00:00", "12:00:00"), "US": ("America/New_York", "08:30:00", "13:00:00")}


def interval_ms(code: Column | str) -> Column:
    """Length of a bar code; an unknown code raises."""
    code = F.lit(code) if isinstance(code, str) else code
    table = F.create_map(*(F.lit(x) for kv in INTERVALS.items() for x in kv))
    return F.coalesce(F.try_element_at(table, code), F.raise_error(F.concat(F.lit("unknown interval "), F.coalesce(code, F.lit("NULL")))).cast("long"))


def align_down(t: Column, step: Column | int) -> Column:
    return t - F.pmod(t, step if isinstance(step, Column) else F.lit(step))


def is_aligned(t: Column, step: Column | int) -> Column:
    return F.pmod(t, step if isinstance(step, Column) else F.lit(step)) == 0


def close_ms(start: Column, step: Column | int) -> Column:
    return start + step


def is_closed(start: Column, step: Column | int, now_ms: Column | int) -> Column:
    return close_ms(start, step) <= now_ms


def utc_ms(ts: Column) -> Column:
    """Milliseconds of a timestamp, rounded down. A column of timestamps without zone is refused by ``zoned``."""
    return F.unix_millis(ts.cast("timestamp"))


def zoned(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows``, if these columns hold points in time: a timestamp without zone raises."""
    for c in columns:
        if rows.schema[c].dataType.typeName() != "timestamp":
            raise ValueError(f"{c} has no zone")
    return rows


def local_ms(day: Column, zone: str, clock: str) -> Column:
    return F.unix_millis(F.to_utc_timestamp(F.to_timestamp(F.concat_ws(" ", day.cast("string"), F.lit(clock))), zone))


def session_bounds(day: Column, name: str) -> tuple[Column, Column]:
    zone, start, end = SESSIONS[name]
    return local_ms(day, zone, start), local_ms(day, zone, end)


def in_session(close: Column, day: Column, name: str) -> Column:
    """Half-open by the bar's close."""
    start, end = session_bounds(day, name)
    return (close >= start) & (close < end)


def universe_cutoff(day: Column) -> Column:
    return local_ms(day, *SESSIONS["EU"][:2])


def month_start_ms(label: Column) -> Column:
    """Start of a YYYY-MM month; another form raises."""
    good = label.rlike(r"^\d{4}-(0[1-9]|1[0-2])$")
    day = F.to_date(F.concat(F.when(good, label), F.lit("-01")))
    return F.when(good, F.unix_millis(day.cast("timestamp"))).otherwise(F.raise_error(F.lit("month must use YYYY-MM")).cast("long"))


def month_end_ms(label: Column) -> Column:
    return F.unix_millis(F.add_months(F.timestamp_millis(month_start_ms(label)).cast("date"), 1).cast("timestamp"))


def months_between(start_ms: Column, end_ms: Column) -> Column:
    """First days (dates) of the months that meet [start, end)."""
    first = F.trunc(F.timestamp_millis(start_ms).cast("date"), "month")
    last = F.trunc(F.timestamp_millis(end_ms - 1).cast("date"), "month")
    return F.when(end_ms > start_ms, F.sequence(first, last, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


def page_windows(start_ms: Column, end_ms: Column, step: int, page_size: int = 1000) -> Column:
    """Windows of at most ``page_size`` bars over [start, end): structs of start and inclusive last bar start."""
    last = end_ms - step
    starts = F.sequence(start_ms, last, F.lit(page_size * step).cast("long"))
    made = F.transform(starts, lambda s: F.struct(s.alias("start_ms"), F.least(last, s + (page_size - 1) * step).alias("end_ms")))
    return F.when(last >= start_ms, made).otherwise(F.array().cast("array<struct<start_ms: bigint, end_ms: bigint>>"))


def delivery_end(delivery_ms: Column, range_end_ms: int) -> Column:
    """Exclusive end of data: the range's end without delivery, else delivery rounded up to a minute."""
    up = align_down(delivery_ms, MINUTE) + MINUTE
    return F.when(F.coalesce(delivery_ms, F.lit(0)) <= 0, F.lit(range_end_ms)).when(is_aligned(delivery_ms, MINUTE), delivery_ms).otherwise(up)


def probe_window(point_ms: Column, count: int = 30) -> Column:
    start = align_down(point_ms, MINUTE) - (count // 2) * MINUTE
    return F.struct(start.alias("start_ms"), (start + (count - 1) * MINUTE).alias("end_ms"))


def probe_points(launch_ms: Column, first_trade_ms: Column, delivery_ms: Column, now_ms: int) -> Column:
    """Three labelled points of a lifetime: near its origin, its middle, near its end."""
    origin, delivery = F.coalesce(first_trade_ms, launch_ms), F.coalesce(delivery_ms, F.lit(0))
    end = F.when(delivery > origin, delivery).otherwise(F.lit(now_ms))
    label = F.when(first_trade_ms.isNotNull(), "near_first_trade").otherwise("near_launch")
    near = F.least(end - 2 * MINUTE, origin + 60 * MINUTE)
    middle = origin + F.floor(F.greatest(F.lit(0), end - origin) / 2).cast("long")
    late = F.greatest(origin + 2 * MINUTE, end - 60 * MINUTE)
    return F.array(*(F.struct(n.alias("label"), p.cast("long").alias("point_ms")) for n, p in ((label, near), (F.lit("mid_life"), middle), (F.lit("near_end"), late))))


def week_start_ms(t: Column) -> Column:
    """Start of the UTC week from Monday."""
    return align_down(t - 4 * DAY, 7 * DAY) + 4 * DAY


def activation_ms(signal_ms: Column) -> Column:
    """A candidate becomes active a minute after the close that signals it."""
    return signal_ms + MINUTE


def expiry_ms(signal_ms: Column, session_end_ms: Column, bars: int = 8) -> Column:
    """Orders live for ``bars`` 15-minute bars, and not beyond the session."""
    return F.least(signal_ms + bars * INTERVALS["15"], session_end_ms)
