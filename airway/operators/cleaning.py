"""Column mapping, null handling and duplicate removal."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The mark a feed puts where a measurement is missing.
MISSING_MARK = "—"


def blank_marks(df: DataFrame, columns: Iterable[str], mark: str = MISSING_MARK) -> DataFrame:
    """Turn the missing mark into null."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(mark)) for c in columns})


def null_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Add (or replace) typed-null string columns."""
    return df.withColumns({c: F.lit(None).cast("string") for c in columns})


def within(c: Column | str, start: str, end: str, closed: bool = False) -> Column:
    """``start <= c < end``, or ``<= end`` when closed. Bounds are text, so the
    predicate reaches the scan for string and for both timestamp types."""
    c = F.col(c) if isinstance(c, str) else c
    return (c >= F.lit(start)) & ((c <= F.lit(end)) if closed else (c < F.lit(end)))


def all_nonzero(record: Column, names: Iterable[str]) -> Column:
    """True when every named field of a struct is present and not zero.

    The struct is bound once by a lambda, so a filter does not repeat the
    expression that makes it (a JSON parse) for each field."""

    def check(r: Column) -> Column:
        result = F.lit(True)
        for name in names:
            result = result & F.coalesce(r[name] != F.lit(0.0), F.lit(False))
        return result

    return F.exists(F.array(record), check)


def sortable(df: DataFrame, column: str) -> Column:
    """The column, or its JSON text where its type has no order (maps)."""
    kind = df.schema[column].dataType
    ordered = "map<" not in kind.simpleString() and "variant" not in kind.simpleString()
    return F.col(column) if ordered else F.to_json(F.struct(column))


def one_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None, last: bool = False) -> DataFrame:
    """One whole row per key: the first (or last) by ``order``, remaining columns
    breaking ties. Spark keeps one row per key and task before the shuffle."""
    order = order or []
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*keys).distinct()
    by = [sortable(df, c) for c in [*order, *rest]]
    window = Window.partitionBy(*keys).orderBy(*[c.desc() if last else c.asc() for c in by])
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")
