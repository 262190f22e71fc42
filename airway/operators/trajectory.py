"""Ordered operations along a track, safe for a vehicle that owns most rows.

A track is cut into time chunks; windows run per (vehicle, chunk), and only the
rows at chunk edges are compared across chunks. Where a vehicle has very many rows
within a chunk's time, :func:`chunk_bounds` cuts it further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airway.operators.cleaning import sortable
from airway.operators.joining import lookup_join
from airway.sources.staging import Work, staged

CHUNK_SECONDS = 3600
# Rows of a vehicle that one chunk should hold, and how many parts a chunk is cut into at most.
CHUNK_ROWS, MOST_CUTS = 1_000_000, 1_000


def _clock(df: DataFrame, time: str) -> tuple[DataFrame, Column]:
    """``df`` with its time read as one, and the microseconds of it.

    A time without zone is counted on its own calendar, so that no clock change
    of the session zone can reorder chunks. Text is read as such a time."""
    kind = df.schema[time].dataType
    if isinstance(kind, T.StringType):
        df = df.withColumn(time, F.col(time).try_cast("timestamp_ntz"))
        kind = T.TimestampNTZType()
    at = F.col(time)
    if isinstance(kind, T.TimestampNTZType):
        clock = F.hour(at) * 3600 + F.minute(at) * 60
        second = (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("bigint")
        return df, (F.unix_date(at.cast("date")).cast("bigint") * 86400 + clock) * 1_000_000 + second
    return df, F.unix_micros(at.cast("timestamp"))


def _in_chunks(df: DataFrame, key: str, time: str, seconds: int, bounds: DataFrame | None) -> DataFrame:
    """All rows with the ``_chunk`` of their time, which rises with it; ``bounds`` cut chunks."""
    df, micros = _clock(df, time)
    chunk = F.floor(micros / F.lit(seconds * 1_000_000))
    if bounds is None:
        return df.withColumn("_chunk", chunk)
    cuts = bounds.select(F.col("key").alias("_key"), F.col("chunk").alias("_of"), "cuts")
    df = df.withColumns({"_chunk": chunk, "_micros": micros})
    found = lookup_join(df, cuts, (F.col(key) == F.col("_key")) & (F.col("_chunk") == F.col("_of")), "left")
    passed = F.size(F.filter(F.coalesce("cuts", F.array().cast("array<bigint>")), lambda c: c <= F.col("_micros")))
    return found.withColumn("_chunk", F.struct(F.col("_chunk").alias("time"), passed.alias("part"))).drop("_key", "_of", "cuts", "_micros")


def chunk_bounds(
    df: DataFrame, key: str, time: str, chunk_seconds: int = CHUNK_SECONDS, rows: int = CHUNK_ROWS, work: Work | None = None
) -> DataFrame:
    """``key, chunk, cuts``: where to cut the chunks that hold more than ``rows`` rows, staged;
    runs jobs. For use as ``bounds`` of the operations below.

    A first aggregate counts the rows of every vehicle and chunk; for the few with too many a
    second one takes quantiles of their times. Bounds decide where rows are worked on and never
    what comes out, so they may be taken from any frame with about the same rows, such as the
    table before a join. Rows of one moment stay together."""
    df, micros = _clock(df.select(key, time), time)
    timed = df.select(F.col(key).alias("key"), F.floor(micros / F.lit(chunk_seconds * 1_000_000)).alias("chunk"), micros.alias("micros"))
    counts = timed.groupBy("key", "chunk").agg(F.count("*").alias("n"))
    crowded = staged(counts.where((F.col("n") > rows) & F.col("key").isNotNull() & F.col("chunk").isNotNull()), "crowded", work)
    most = crowded.agg(F.max("n")).first()[0] or 0
    parts = max(2, min(MOST_CUTS, -(-most // rows)))
    inside = lookup_join(timed, crowded.select("key", "chunk"), ["key", "chunk"], "left_semi")
    quantiles = F.percentile_approx("micros", [k / parts for k in range(1, parts)], 10 * MOST_CUTS)
    return staged(inside.groupBy("key", "chunk").agg(F.array_sort(F.array_distinct(quantiles)).alias("cuts")), "cuts", work)


def neighbours(
    df: DataFrame,
    key: str,
    time: str,
    value: str,
    tie_break: list[str] | None = None,
    chunk_seconds: int = CHUNK_SECONDS,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Add ``{value}_lag`` and ``{value}_lead``: the value before and after along
    the track, null at its ends. Rows without key or time (or with a time text that is
    none, see :func:`unplaced_rows`) are on no track: they stay, without neighbours."""
    # All columns break ties: both parts of the result must see one order.
    order = [time, *(tie_break or [])]
    order = [*order, *[sortable(df, c) for c in df.columns if c not in (key, *order)]]
    lag, lead = f"{value}_lag", f"{value}_lead"
    chunked = _in_chunks(df, key, time, chunk_seconds, bounds)
    placed = F.col(key).isNotNull() & F.col(time).isNotNull()
    kind = df.schema[value].dataType
    aside = chunked.where(~placed).drop("_chunk").withColumns({lag: F.lit(None).cast(kind), lead: F.lit(None).cast(kind)})
    chunked = chunked.where(placed)
    inner = Window.partitionBy(key, "_chunk").orderBy(*order)
    marked = chunked.withColumns(
        {
            lag: F.lag(value).over(inner),
            lead: F.lead(value).over(inner),
            "_first": F.lag(F.lit(True)).over(inner).isNull(),
            "_last": F.lead(F.lit(True)).over(inner).isNull(),
        }
    )
    # Rows at the edges of chunks are few and meet along the vehicle; all others stay where
    # the first exchange put them, which both parts of the union read.
    edge = F.col("_first") | F.col("_last")
    outer = Window.partitionBy(key).orderBy(*order)
    edges = marked.where(edge).withColumns(
        {
            lag: F.when(F.col("_first"), F.lag(value).over(outer)).otherwise(F.col(lag)),
            lead: F.when(F.col("_last"), F.lead(value).over(outer)).otherwise(F.col(lead)),
        }
    )
    return marked.where(~edge).unionByName(edges).drop("_chunk", "_first", "_last").unionByName(aside)


def unplaced_rows(df: DataFrame, key: str, time: str) -> DataFrame:
    """Rows that are on no track, as they came: no key, no time, or a text that is none."""
    at = F.col(time)
    if isinstance(df.schema[time].dataType, T.StringType):
        at = at.try_cast("timestamp_ntz")
    return df.where(F.col(key).isNull() | at.isNull())


def boundaries(
    df: DataFrame,
    key: str,
    time: str,
    place: str,
    tie_break: list[str] | None = None,
    chunk_seconds: int = CHUNK_SECONDS,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Rows where a stay begins (``enters``) or ends (``leaves``). Rows without key or
    time are on no track and bound no stay (see :func:`unplaced_rows`)."""
    # A struct is null only where there is no row, not where the place is null.
    spot = df.withColumn("_spot", F.struct(F.col(place).alias("at")))
    near = neighbours(spot, key, time, "_spot", tie_break, chunk_seconds, bounds)
    near = near.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    flags = {
        "enters": ~F.col("_spot").eqNullSafe(F.col("_spot_lag")),
        "leaves": ~F.col("_spot").eqNullSafe(F.col("_spot_lead")),
    }
    return near.withColumns(flags).where(F.col("enters") | F.col("leaves")).drop("_spot", "_spot_lag", "_spot_lead")


def stays(
    df: DataFrame,
    key: str,
    time: str,
    place: str,
    tie_break: list[str] | None = None,
    chunk_seconds: int = CHUNK_SECONDS,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """One row per unbroken stay: ``key, place, {in, out} time, points``.

    Rows without key or time are on no track (see :func:`unplaced_rows`).
    Runs are found per (vehicle, chunk) and reduced to one row each; the runs at
    chunk edges are then glued along the vehicle.
    """
    order = [time, *(tie_break or [])]
    chunked = _in_chunks(df.select(*dict.fromkeys([key, place, *order])), key, time, chunk_seconds, bounds)
    chunked = chunked.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    inner = Window.partitionBy(key, "_chunk").orderBy(*order)
    starts = F.lag(F.lit(True)).over(inner).isNull() | ~F.lag(place).over(inner).eqNullSafe(F.col(place))
    runs = (
        chunked.withColumn("_starts", starts.cast("int"))
        .withColumn("_run", F.sum("_starts").over(inner))
        .groupBy(key, "_chunk", "_run", place)
        .agg(F.min(time).alias("_in"), F.max(time).alias("_out"), F.count("*").alias("points"))
    )
    by_chunk = Window.partitionBy(key, "_chunk").orderBy("_run")
    runs = runs.withColumns(
        {"_first": F.col("_run") == F.lit(1), "_last": F.lead("_run").over(by_chunk).isNull()}
    ).withColumn("_group", F.when(~F.col("_first") & ~F.col("_last"), F.col("_chunk")))
    edge = Window.partitionBy(key, "_group").orderBy("_chunk", "_run")
    continues = (
        F.col("_first") & F.coalesce(F.lag("_last").over(edge), F.lit(False)) & F.lag(place).over(edge).eqNullSafe(F.col(place))
    )
    return (
        runs.withColumn("_new", F.when(continues, 0).otherwise(1))
        .withColumn("_stay", F.sum("_new").over(edge))
        .groupBy(key, "_group", "_stay", place)
        .agg(
            F.min("_in").alias(f"{time}_in"),
            F.max("_out").alias(f"{time}_out"),
            F.sum("points").alias("points"),
        )
        .drop("_group", "_stay")
    )
