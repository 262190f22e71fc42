"""Landed files processed as they arrive, with the same transformations as the
batch jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from airway.sources.scans import HOUR_KEYS
from airway.sources.sinks import upsert_partitions


def upsert_new_files(
    spark: SparkSession,
    source: str,
    schema: str | T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    progress: str,
    keys: list[str],
    partitions: tuple[str, ...] = HOUR_KEYS,
    order: list[str] | None = None,
) -> None:
    """Read the Parquet files that appeared under ``source`` since the last run,
    transform them and upsert the rows into ``target``; then stop.

    ``progress`` keeps which files are done. A batch that is repeated after a
    failure replaces its own rows, so the target comes out the same.
    """

    def write(batch: DataFrame, _epoch: int) -> None:
        upsert_partitions(transform(batch), target, keys, partitions, order)

    query = (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
