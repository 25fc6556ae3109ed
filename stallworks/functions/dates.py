"""Day arithmetic and the date encodings configuration tables use.

Epoch conversions count days from 1970-01-01 and so do not depend on the session
time zone; a zone shift is an explicit argument.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .values import ColumnLike, as_col

#: Accepted text layouts, tried in this order.
DAY_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
)
#: Day zero of spreadsheet serials, and the serial of 9999-12-31, their last day.
SERIAL_ORIGIN = "1899-12-30"
SERIAL_LAST = 2_958_465
#: Fixed value: epochs up to this are seconds, above it milliseconds.
SECONDS_LIMIT = 9_999_999_999
MILLIS_PER_DAY = 86_400_000
MILLIS_PER_HOUR = 3_600_000

_UNIX_DAY = "1970-01-01"


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def parse_day(c: ColumnLike) -> Column:
    """Text in any accepted layout to a date; anything else is null."""
    text = F.trim(as_col(c).cast("string"))
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in DAY_FORMATS])


def serial_to_day(c: ColumnLike) -> Column:
    """Spreadsheet serial to a date; outside the calendar of serials it is null."""
    n = as_col(c)
    ok = (n > 0) & (n < SERIAL_LAST + 1)
    return F.when(ok, F.date_add(_day(SERIAL_ORIGIN), F.floor(n).cast("int")))


def day_to_serial(c: ColumnLike) -> Column:
    return F.datediff(as_col(c).cast("date"), _day(SERIAL_ORIGIN))


def millis_to_day(c: ColumnLike, tz_offset_hours: int = 0) -> Column:
    """Epoch milliseconds to the calendar day ``tz_offset_hours`` east of UTC."""
    ms = as_col(c).cast("bigint") + F.lit(tz_offset_hours * MILLIS_PER_HOUR)
    return F.date_add(_day(_UNIX_DAY), F.floor(ms / F.lit(MILLIS_PER_DAY)).cast("int"))


def millis_to_timestamp(c: ColumnLike) -> Column:
    """Epoch milliseconds to a zone-free UTC timestamp."""
    ms = as_col(c).cast("bigint")
    origin = F.lit(f"{_UNIX_DAY} 00:00:00").cast("timestamp_ntz")
    return origin + F.make_dt_interval(secs=(ms / F.lit(1000)).cast("decimal(18,6)"))


def day_to_millis(c: ColumnLike) -> Column:
    """Date to epoch milliseconds of its UTC midnight."""
    days = F.datediff(as_col(c).cast("date"), _day(_UNIX_DAY))
    return days.cast("bigint") * F.lit(MILLIS_PER_DAY)


def epoch_to_millis(c: ColumnLike) -> Column:
    """Number holding epoch seconds or milliseconds to milliseconds."""
    n = as_col(c)
    thousand = F.lit(1000).cast("bigint")
    return F.when(n > SECONDS_LIMIT, n.cast("bigint")).otherwise((n * thousand).cast("bigint"))


def value_to_millis(c: ColumnLike, data_type: T.DataType) -> Column:
    """Date-like value of any type to the milliseconds a date field stores."""
    col = as_col(c)
    if isinstance(data_type, T.NumericType):
        return epoch_to_millis(col)
    if isinstance(data_type, T.StringType):
        return day_to_millis(parse_day(col))
    return day_to_millis(col)


def normalise_day(c: ColumnLike, data_type: T.DataType) -> Column:
    """Date-like value of any type to a date: serials, text, dates and timestamps."""
    col = as_col(c)
    if isinstance(data_type, T.NumericType):
        return serial_to_day(col)
    if isinstance(data_type, T.StringType):
        return parse_day(col)
    return col.cast("date")


def reformat(c: ColumnLike, data_type: T.DataType, pattern: str) -> Column:
    """Date-time value to text in ``pattern``; unparseable text is null."""
    col = as_col(c)
    if isinstance(data_type, T.StringType):
        text = F.trim(col)
        col = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DAY_FORMATS])
    return F.date_format(col, pattern)


def month_key(c: ColumnLike) -> Column:
    """First day of the month as text."""
    return F.date_format(as_col(c), "yyyy-MM-01")


def is_month_end(c: ColumnLike) -> Column:
    day = as_col(c).cast("date")
    return F.when(F.last_day(day) == day, F.lit(1)).otherwise(F.lit(0))


def covers(start: ColumnLike, end: ColumnLike, day: object) -> Column:
    """Validity range ``start <= day <= end`` on date parts.

    Open ends do not match, and neither does text that is no day in any accepted layout:
    the row is left out, the job goes on.
    """
    d = day if isinstance(day, Column) else F.lit(day)

    def read(c: ColumnLike) -> Column:
        return F.coalesce(as_col(c).try_cast("date"), parse_day(c))

    return (read(start) <= d) & (read(end) >= d)
