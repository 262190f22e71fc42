"""Equi-joins against lookup tables whose size is checked before a broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows take about this many times their Parquet bytes in the driver and in executors, those of tables
# of keys more: a key is a byte or two on disk, a row of keys 50 bytes and more in a hash table. A
# broadcast may take this many times spark.sql.autoBroadcastJoinThreshold (160 MB by default).
MEMORY_PER_DISK_BYTE, MORE_FOR_KEYS = 16, 4
THRESHOLDS_IN_MEMORY = 16


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan; runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame, copies: int = 1) -> bool:
    """Whether ``df``, each row grown to ``copies`` rows, stays within the memory
    bound. A threshold of -1 turns broadcasts off here too."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) * copies * MEMORY_PER_DISK_BYTE <= limit * THRESHOLDS_IN_MEMORY


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str] | str | Column,
    how: str = "inner",
    size_of: DataFrame | None = None,
    copies: int = 1,
    as_read: bool = False,
) -> DataFrame:
    """Join ``facts`` to ``lookup`` without shuffling ``facts`` when the lookup is small.

    A lookup whose known size fits is broadcast. Otherwise the join is left as it is:
    adaptive execution still broadcasts a side that turns out small (a frame without
    statistics, the few keys left by a filter on counts) and splits hot keys of one
    that does not. ``size_of`` names the frame the lookup was grown from by ``copies``
    rows per row (an ``explode`` does not show in Catalyst's estimate).

    ``as_read`` tells that the lookup is a whole table of keys, be it staged. Its rows are then many more than
    Catalyst's bytes let expect, and the driver, which builds every broadcast, would hold them all: the
    bound is tighter, and beyond it Spark is kept from broadcasting by its own estimate.
    """
    fits = fits_broadcast(size_of if size_of is not None else lookup, copies * (MORE_FOR_KEYS if as_read else 1))
    if as_read and not fits:
        return facts.join(lookup.hint("merge"), on, how)
    return facts.join(F.broadcast(lookup) if fits else lookup, on, how)
