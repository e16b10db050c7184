"""Date and time column functions."""

from pyspark.sql import Column, functions as F


def from_millis(c) -> Column:
    """Epoch milliseconds to a timestamp, milliseconds kept."""
    return F.timestamp_millis(c)


def from_millis_whole_seconds(c) -> Column:
    """Epoch milliseconds to a timestamp cut to the whole second."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_seconds(F.floor(c / 1000))


def weekday(c, convention="mon0") -> Column:
    """Day of the week under one of four conventions.

    ``mon0`` Monday = 0, ``sun0`` Sunday = 0, ``iso`` Monday = 1, ``name``
    short English name.
    """
    if convention == "mon0":
        return F.weekday(c)
    if convention == "sun0":
        return F.dayofweek(c) - 1
    if convention == "iso":
        return F.weekday(c) + 1
    if convention == "name":
        return F.date_format(c, "E")
    raise ValueError(f"unknown weekday convention {convention!r}")


def is_weekend(c) -> Column:
    return F.weekday(c) >= 5


def date_key(c) -> Column:
    """Integer ``yyyymmdd``."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def time_parts(c, convention="mon0") -> dict[str, Column]:
    """The columns of a time dimension, by name."""
    return {
        "hour": F.hour(c),
        "day": F.dayofmonth(c),
        "week": F.weekofyear(c),
        "month": F.month(c),
        "year": F.year(c),
        "weekday": weekday(c, convention),
    }


def month_start_before(as_of, months) -> Column:
    """First day of the month that lies ``months`` before ``as_of``."""
    return F.trunc(F.add_months(as_of, -months), "month")


def days_late(start, end, allowed) -> Column:
    """Whole days kept beyond the allowed days, never negative."""
    return F.greatest(F.date_diff(end, start) - allowed, F.lit(0))


def iso_week_text(c) -> Column:
    """ISO week number as two digits."""
    return F.lpad(F.weekofyear(c).cast("string"), 2, "0")


def log_time(c) -> Column:
    """Access-log time text such as ``01/Aug/1995:00:00:01 -0400``."""
    return F.try_to_timestamp(c, F.lit("dd/MMM/yyyy:HH:mm:ss Z"))


def day_number_date(c) -> Column:
    """Days counted from 1960-01-01 to a date."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_add(F.lit("1960-01-01").cast("date"), c.cast("int"))
