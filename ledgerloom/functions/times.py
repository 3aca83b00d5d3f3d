"""Dates and times. Relative dates take an explicit ``as_of``."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

from ledgerloom.functions.fixed_values import CUTOFF_HOUR, LOCAL_ZONE

Moment = date | datetime | str


def moment(value: Moment) -> datetime:
    if isinstance(value, str):
        return datetime.fromisoformat(value)
    if isinstance(value, datetime):
        return value
    return datetime(value.year, value.month, value.day)


def timestamp_literal(value: Moment) -> Column:
    """A literal that compares with stored timestamps without casting the column."""
    return F.lit(moment(value).isoformat(sep=" ")).cast("timestamp_ntz")


def date_literal(value: Moment) -> Column:
    return F.lit(moment(value).date())


def in_range(col: Column, start: Moment, end: Moment) -> Column:
    """``start <= col < end``, in a form the file reader can skip by."""
    return (col >= timestamp_literal(start)) & (col < timestamp_literal(end))


def on_day(col: Column, day: Moment) -> Column:
    first = moment(moment(day).date())
    return in_range(col, first, first + timedelta(days=1))


def on_previous_day(col: Column, as_of: Moment) -> Column:
    return on_day(col, moment(as_of) - timedelta(days=1))


def in_month_of_previous_day(col: Column, as_of: Moment) -> Column:
    """The calendar month that holds the day before ``as_of``."""
    first = moment((moment(as_of) - timedelta(days=1)).date().replace(day=1))
    following = (first + timedelta(days=32)).replace(day=1)
    return in_range(col, first, following)


def hours_before(col: Column, as_of: Moment, start: int, end: int = 0) -> Column:
    """From ``start`` to ``end`` hours before ``as_of``, end excluded."""
    now = moment(as_of)
    return in_range(col, now - timedelta(hours=start), now - timedelta(hours=end))


def since_hours(col: Column, as_of: Moment, hours: int) -> Column:
    return col >= timestamp_literal(moment(as_of) - timedelta(hours=hours))


def to_second(col: Column) -> Column:
    return F.date_trunc("second", col)


def minute_text(col: Column) -> Column:
    return F.date_format(col, "dd-MM-yyyy HH:mm")


def month_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def age_years(born: Column, as_of: Moment) -> Column:
    """Whole years counted as days div 365."""
    return (F.datediff(date_literal(as_of), born) / F.lit(365)).cast("int")


def business_day(ts: Column, cutoff_hour: int = CUTOFF_HOUR) -> Column:
    """From the cut-off hour on, a row counts for the next day."""
    return F.when(F.hour(ts) >= cutoff_hour, ts + F.expr("interval 1 day")).otherwise(ts)


def local_time(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC wall time to the wall time of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def mixed_timestamp(col: Column) -> Column:
    """Text that holds either epoch milliseconds or an ISO date and time."""
    return F.coalesce(F.timestamp_millis(col.try_cast("long")), col.try_cast("timestamp"))


def compact_date(col: Column) -> Column:
    """``yyyymmdd`` text to a date."""
    return F.to_date(col, "yyyyMMdd")
