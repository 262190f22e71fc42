"""Hour and day grids as rows, so one job covers every slot."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airway.functions.times import HOUR_END, HOUR_START, plus_hours

_TEXT = "%Y-%m-%d %H:%M:%S"


@dataclass(frozen=True)
class HourRange:
    """Hours ``first`` to ``last`` inclusive (``yyyy-MM-dd HH:00:00`` text). The
    slot of an hour covers ``span`` hours and is published ``ahead`` hours later."""

    first: str
    last: str
    ahead: int = 0
    span: int = 1

    def _moved(self, text: str, hours: int) -> str:
        return (datetime.strptime(text, _TEXT) + timedelta(hours=hours)).strftime(_TEXT)

    @property
    def covers(self) -> tuple[str, str]:
        """Half-open time window all slots together read."""
        return self.first, self._moved(self.last, self.span)

    @property
    def published(self) -> tuple[str, str]:
        """First and last publication hour, both included."""
        return self._moved(self.first, self.ahead), self._moved(self.last, self.ahead)

    def in_window(self, time: Column | str) -> Column:
        time = F.col(time) if isinstance(time, str) else time
        start, end = self.covers
        return (time >= F.lit(start)) & (time < F.lit(end))

    def is_published(self, time: Column | str) -> Column:
        """On a publication hour exactly."""
        time = F.col(time) if isinstance(time, str) else time
        first, last = self.published
        stamp = time.try_cast("timestamp")
        return (time >= F.lit(first)) & (time <= F.lit(last)) & (stamp == F.date_trunc("hour", stamp))

    def slots(self) -> Column:
        """Array of every publication hour."""
        first, last = (F.to_timestamp(F.lit(t)) for t in self.published)
        return F.sequence(first, last, F.expr("interval 1 hour"))


def into_slots(df: DataFrame, time: str, hours: HourRange, name: str = "published_at") -> DataFrame:
    """Rows of the window with the publication hour of each slot they fall in."""
    rows = df.where(hours.in_window(time))
    hour = F.date_trunc("hour", F.col(time).try_cast("timestamp"))
    if hours.span == 1:
        return rows.withColumn(name, plus_hours(hour, hours.ahead)).where(F.col(name).isNotNull())
    back = F.explode(F.sequence(F.lit(0), F.lit(hours.span - 1)))
    first, last = (F.to_timestamp(F.lit(t)) for t in (hours.first, hours.last))
    return (
        rows.withColumn("_back", back)
        .withColumn("_start", plus_hours(hour, -F.col("_back")))
        .where(F.col("_start").between(first, last))
        .withColumn(name, plus_hours("_start", hours.ahead))
        .drop("_back", "_start")
    )


def hour_grid(bounds: DataFrame, first: str, last: str, ahead: int = 0, span: int = 1) -> DataFrame:
    """One row per hour from ``first`` to ``last`` inclusive of each bounds row."""
    hours = F.sequence(
        F.date_trunc("hour", F.col(first)), F.date_trunc("hour", F.col(last)), F.expr("interval 1 hour")
    )
    rows = bounds.select(F.explode(hours).alias("_hour"))
    published = plus_hours("_hour", ahead)
    return rows.select(
        F.date_format(published, HOUR_START).alias("published_at"),
        F.date_format("_hour", HOUR_START).alias("start"),
        F.date_format(plus_hours("_hour", span - 1), HOUR_END).alias("end"),
        F.date_format(published, "yyyy-MM-dd").alias("published_date"),
        F.date_format("_hour", "HH").alias("hour"),
    )


def day_grid(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day, both ends included: ``day`` and ``next_day``."""
    days = F.sequence(F.col(first).cast("date"), F.col(last).cast("date"), F.expr("interval 1 day"))
    rows = bounds.select(F.explode(days).alias("_day"))
    return rows.select(
        F.date_format("_day", "yyyy-MM-dd").alias("day"),
        F.date_format(F.date_add("_day", 1), "yyyy-MM-dd").alias("next_day"),
    )


def day_hour_grid(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Every day with each of its 24 hours."""
    return day_grid(bounds, first, last).select(
        F.col("day").alias("publish_date"),
        F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"),
    ).select("publish_date", F.lpad(F.col("_h").cast("string"), 2, "0").alias("hour"))
