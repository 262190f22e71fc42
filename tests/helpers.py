"""Plain-Python versions of what the operators compute, and row comparison."""

import datetime
import decimal
import math


def metres(lon1, lat1, lon2, lat2):
    r1, r2 = math.radians(lat1), math.radians(lat2)
    b = math.radians(lon1) - math.radians(lon2)
    chord = math.sin((r1 - r2) / 2) ** 2 + math.cos(r1) * math.cos(r2) * math.sin(b / 2) ** 2
    return math.floor(math.floor(2 * math.asin(math.sqrt(chord)) * 6371393 * 10000 + 0.5) / 10000)


def rows(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
