"""Date helpers: day numbers, age buckets, text reformatting, calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ymd_to_date(c) -> Column:
    """``yyyyMMdd`` text -> date (null for unparsable text)."""
    return F.try_to_timestamp(_c(c), F.lit("yyyyMMdd")).cast("date")


def _day(c, fmt: str | None) -> Column:
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("date") if fmt else F.to_date(_c(c))


def days_since(c, origin: str, fmt: str | None = "yyyyMMdd") -> Column:
    """whole days from ``origin`` (yyyy-MM-dd) to the day in ``c``.

    ``c`` is ``yyyyMMdd`` text by default; pass ``fmt=None`` for date/timestamp
    columns; text that is no such day gives null.
    """
    d = _day(c, fmt)
    return F.datediff(d, F.lit(origin).cast("date"))


def age_bucket(c, reference: str, width: int = 90, fmt: str | None = "yyyyMMdd") -> Column:
    """days from the day in ``c`` to ``reference``, integer-divided by ``width``.

    The division truncates toward zero (like ``div``), as the reference does.
    """
    d = _day(c, fmt)
    days = F.datediff(F.lit(reference).cast("date"), d)
    return (days / F.lit(width)).cast("long")


def reformat_ymd(c, out_fmt: str = "yyyy/MM/dd") -> Column:
    """``yyyyMMdd`` text -> another text layout."""
    return F.date_format(ymd_to_date(c), out_fmt)


def add_days_ymd(start: str, offset: Column, out_fmt: str = "yyyyMMdd") -> Column:
    """``start`` (yyyy-MM-dd) plus ``offset`` days, formatted."""
    return F.date_format(F.date_add(F.lit(start).cast("date"), offset.cast("int")), out_fmt)


def season(month: Column) -> Column:
    """Season number from a month: 1 winter (Dec-Feb), 2 spring, 3 summer, 4 autumn."""
    return (F.pmod(month, F.lit(12)) / 3).cast("int") + 1


def calendar_parts(ts, prefix: str = "") -> list[Column]:
    """Year, Month, Day, WeekNum, HourOfDay, Weekend, Season, WeekDay.

    WeekNum is the ISO week, WeekDay is 1 = Sunday .. 7 = Saturday and
    Weekend is 1 for Saturday/Sunday, else 0.
    """
    t = _c(ts)  # no cast: a timestamp_ntz keeps its wall clock in any session zone
    month = F.month(t)
    dow = F.dayofweek(t)
    return [
        F.year(t).alias(prefix + "year"),
        month.alias(prefix + "month"),
        F.dayofmonth(t).alias(prefix + "day"),
        F.weekofyear(t).alias(prefix + "week_num"),
        F.hour(t).alias(prefix + "hour_of_day"),
        F.when(dow.isin(1, 7), 1).otherwise(0).alias(prefix + "weekend"),
        season(month).alias(prefix + "season"),
        dow.alias(prefix + "week_day"),
    ]


def parse_local_timestamp(c, fmt: str = "MM/dd/yyyy hh:mm:ss a", zone: str | None = None) -> Column:
    """Timestamp text in ``fmt``; when ``zone`` is given the text is wall time there."""
    t = F.to_timestamp(_c(c), fmt)
    return F.to_utc_timestamp(t, zone) if zone else t
