"""Time text and hour-slot expressions. The session time zone decides the calendar
unless a zone is given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = "yyyy-MM-dd HH:mm:ss"
HOUR_START = "yyyy-MM-dd HH:00:00"
HOUR_END = "yyyy-MM-dd HH:59:59"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of_text(c) -> Column:
    """First ten characters: ``2024-01-05 08:00:00`` -> ``2024-01-05``."""
    return F.substring(_col(c), 1, 10)


def in_zone(seconds: Column, zone: str) -> Column:
    """Epoch seconds (with fraction) on the clock of ``zone``, whatever the session's."""
    clock = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), clock)


def hour_of(c) -> Column:
    """Two-character hour of a time stamp."""
    return F.date_format(_col(c), "HH")


def leading_digit(c) -> Column:
    """First character as an integer; null when it is not a digit."""
    return F.substring(_col(c), 1, 1).try_cast("int")


def epoch_seconds(c) -> Column:
    """Epoch seconds, number or text, as a time stamp."""
    return F.timestamp_seconds(_col(c).try_cast("bigint"))


def epoch_text(c, zone: str | None = None) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` in ``zone`` (else the session's)."""
    if zone:
        return F.date_format(in_zone(_col(c).try_cast("bigint"), zone), STAMP)
    return F.date_format(epoch_seconds(c), STAMP)


def stamp_day(c) -> Column:
    """Day of a time text; null when the text is not a time."""
    return F.date_format(F.try_to_timestamp(_col(c), F.lit(STAMP)), "yyyy-MM-dd")


def dotnet_hour(c, zone: str | None = None) -> Column:
    """``/Date(1675310400000)/`` as text, floored to the hour, in ``zone`` (else the
    session's). Times before 1970 are negative."""
    millis = F.regexp_extract(_col(c), r"(-?\d+)", 1).try_cast("bigint")
    if zone:
        return F.date_format(in_zone(millis / F.lit(1000), zone), HOUR_START)
    return F.date_format(F.timestamp_millis(millis), HOUR_START)


def iso_stamp(c) -> Column:
    """``2022-01-01T05:00:00...`` -> ``2022-01-01 05:00:00``."""
    c = _col(c)
    return F.concat(F.substring(c, 1, 10), F.lit(" "), F.substring(c, 12, 8))


def reformat(c, pattern: str) -> Column:
    """Text in ``pattern`` as ``yyyy-MM-dd HH:mm:ss``; null when it does not fit."""
    return F.date_format(F.try_to_timestamp(_col(c), F.lit(pattern)), STAMP)


def slash_stamp(c) -> Column:
    return reformat(c, "yyyy/M/d HH:mm")


def loose_stamp(c) -> Column:
    return reformat(c, "yyyy-M-d H:m:s")


def shift_hour_start(c, hours: int) -> Column:
    """Hour of ``c`` moved by ``hours``, as ``HH:00:00`` text."""
    return F.date_format(plus_hours(F.date_trunc("hour", _col(c)), hours), HOUR_START)


def shift_hour_end(c, hours: int) -> Column:
    """Hour of ``c`` moved by ``hours``, as ``HH:59:59`` text."""
    return F.date_format(plus_hours(F.date_trunc("hour", _col(c)), hours), HOUR_END)


def plus_hours(c, hours: int | Column) -> Column:
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return _col(c) + F.make_dt_interval(F.lit(0), hours)


def shift_day(c, days: int) -> Column:
    return F.date_format(F.date_add(_col(c).cast("date"), days), "yyyy-MM-dd")


def parts_stamp(c, century: int = 0) -> Column:
    """``[y, mo, d, h, mi, s]`` as text. The year is taken as it stands (23 is
    the year 23) unless ``century`` is added."""
    c = _col(c)
    part = [F.get(c, i) for i in range(6)]
    made = F.try_make_timestamp(part[0] + F.lit(century), *part[1:5], part[5].cast("decimal(8,6)"))
    return F.date_format(made, STAMP)
