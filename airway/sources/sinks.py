"""Partitioned, positional and keyed writes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airway.operators.cleaning import one_per_key
from airway.operators.joining import lookup_join
from airway.operators.merging import upsert, upsert_json
from airway.sources.key_index import KeyIndex
from airway.sources.scans import HOUR_KEYS, read_partitioned, stored_or_none
from airway.sources.staging import Work
from airway.sources.swaps import BIN, Swap, listed_files, recover, same_form, with_files

# Size merged files aim at, and the mean size below which files are merged.
MERGED_FILE_BYTES, SMALL_FILE_BYTES = 256_000_000, 134_217_728


@contextmanager
def file_size(spark: SparkSession, target_bytes: int) -> Iterator[None]:
    """Let gathered writes aim at files of about this size, and read such files
    whole."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": target_bytes,
        "spark.sql.files.maxPartitionBytes": 2 * target_bytes,
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def write_partitions(
    df: DataFrame,
    path: str,
    keys: tuple[str, ...] = HOUR_KEYS,
    overwrite: bool = False,
    derived: Mapping[str, Column] | None = None,
    compression: str | None = None,
) -> None:
    """Append to, or replace, the partitions present in ``df``.

    Rows of a partition are brought together, so a small one becomes one file;
    a large one is split by size rather than left to a single task. ``derived`` columns are
    computed from the gathered rows, so they are not shuffled and do not count as their size.
    ``compression`` is the session's unless given.
    """
    gathered = df.hint("rebalance", *[F.col(k) for k in keys]).withColumns(dict(derived or {}))
    _write(gathered, path, keys, overwrite, compression)


def _write(df: DataFrame, path: str, keys: tuple[str, ...], overwrite: bool, compression: str | None) -> None:
    writer = df.write.mode("overwrite" if overwrite else "append").option("partitionOverwriteMode", "dynamic")
    if compression:
        writer = writer.option("compression", compression)
    writer.partitionBy(*keys).parquet(path)


def insert_positional(
    df: DataFrame, table: str, columns: list[str], keys: tuple[str, ...] = (), overwrite: bool = False
) -> None:
    """Insert by position: ``columns`` in the table's order, partition columns
    (``keys``) last. Rows of a partition are brought together first."""
    rows = df.select(*columns)
    if keys:
        rows = rows.hint("rebalance", *[F.col(k) for k in keys])
    rows.write.insertInto(table, overwrite=overwrite)


# Fixed value: rows per insert batch of a database sink.
JDBC_BATCH_ROWS = 20_000


def append_jdbc(df: DataFrame, options: Mapping[str, str], writers: int = 8) -> None:
    """Append to a database table in batches over a bounded number of connections.

    For a keyed upsert let the target be a landing table that the database merges
    by its unique key."""
    settings = {"batchsize": str(JDBC_BATCH_ROWS), "numPartitions": str(writers), **options}
    df.write.format("jdbc").options(**settings).mode("append").save()


def create_partitioned_table(spark: SparkSession, table: str, schema: str, keys: tuple[str, ...], path: str) -> None:
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet PARTITIONED BY ({', '.join(keys)}) LOCATION '{path}'")


def upsert_partitions(
    new: DataFrame,
    path: str,
    keys: list[str],
    partitions: tuple[str, ...] = HOUR_KEYS,
    order: list[str] | None = None,
    payload: str | None = None,
    key_buckets: int | None = None,
) -> None:
    """Keyed upsert into a partitioned dataset; only touched partitions are
    rewritten. With ``payload`` the JSON objects of a key met again are merged, stored
    members winning.

    The keys must determine the partition, unless ``key_buckets`` is given: then an index
    from keys to partitions, in so many buckets, lies beside the data and finds the keys that
    are stored in another partition than now; they leave it. Every upsert of that dataset must
    pass the same number. Rows that others wrote since are found by their files, and the
    index is made anew.

    The result is staged and swapped in by a journal (:mod:`airway.sources.swaps`): a run that
    dies before the journal is whole changed nothing, one that dies later is finished by the
    next. Files that land in a touched partition meanwhile stay.
    """
    spark = new.sparkSession
    recover(spark, path)
    with Work(spark) as owner, Swap(spark, path) as swap, file_size(spark, MERGED_FILE_BYTES):
        new = owner.stage(new, "new")
        if new.isEmpty():
            return
        stored = stored_or_none(spark, path)
        index = KeyIndex(spark, path, keys, partitions, key_buckets) if key_buckets else None
        if stored is None:
            write_partitions(one_per_key(new, keys, order, last=True), swap.data, partitions)
            gone = spark.createDataFrame([], "_file string")
            swap.commit(index.write(swap, new, None, gone) if index else gone)
            return
        new = new.select(*stored.columns)
        places = new.select(*partitions).distinct()
        known = index.current(stored, owner) if index else None
        if index:
            places = owner.stage(places.unionByName(index.places_of(new, known)).distinct(), "places")
        affected = _touched(with_files(stored), places, partitions)
        gone = affected.select("_file").distinct()
        rows = affected.select(*stored.columns)
        merged = upsert_json(new, rows, keys, payload, order) if payload else upsert(new, rows, keys, order)
        write_partitions(merged, swap.data, partitions)
        swap.commit(index.write(swap, new, known, owner.stage(gone, "gone")) if index else gone)


def _touched(stored: DataFrame, touched: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """Stored rows of the given partitions. The range of the first partition column prunes
    the scan at run time."""
    lead = F.col(partitions[0])
    span = touched.agg(F.min(lead).alias("low"), F.max(lead).alias("high"))
    near = stored.where((lead >= span.select("low").scalar()) & (lead <= span.select("high").scalar()))
    return lookup_join(near, touched, list(partitions), "left_semi").select(*stored.columns)


def insert_missing(
    df: DataFrame, table: str, columns: list[str], partitions: tuple[str, ...], identity: list[str]
) -> None:
    """Insert by position the rows whose ``identity`` (with the partition) the table lacks, so
    an import can be repeated. Only partitions that occur in ``df`` are compared; of new rows
    of one identity the first by all columns stays. Null equals null."""
    spark, keys = df.sparkSession, [*dict.fromkeys([*identity, *partitions])]
    with Work(spark) as owner:
        new = owner.stage(one_per_key(df.select(*columns), keys), "new")
        stored = _touched(spark.table(table), new.select(*partitions).distinct(), partitions)
        there = stored.select(*[F.col(k).alias(f"_there_{k}") for k in keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_there_{k}")) for k in keys]
        missing = owner.stage(new.join(there, same, "left_anti"), "missing")
        insert_positional(missing, table, columns, partitions)


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    pick: Callable[[DataFrame], DataFrame],
    partitions: tuple[str, ...] = HOUR_KEYS,
    target_bytes: int = MERGED_FILE_BYTES,
) -> int:
    """Rewrite the picked partitions of ``source`` into ``target`` (which may be
    the same path) with few files; returns the row count.

    ``pick`` narrows the frame to partitions, e.g. by a predicate on partition
    columns. Partitions that do not exist are simply not there. The files that were read
    are swapped for the new ones by a journal: a run that dies can be repeated, and files that
    land while it is at work are not touched. The staged rows are counted against the files.
    """
    for root in {source, target}:
        recover(spark, root)
    chosen = with_files(pick(read_partitioned(spark, source)))
    with Work(spark) as owner, Swap(spark, target) as swap, file_size(spark, target_bytes):
        files = owner.stage(chosen.groupBy("_file").agg(F.count("*").alias("n")), "files")
        if files.isEmpty():
            return 0
        write_partitions(chosen.drop("_file"), swap.data, partitions)
        written = _checked(swap, files, target)
        if source.rstrip("/") == target.rstrip("/"):
            gone = files
        else:
            old = stored_or_none(spark, target)
            places = read_partitioned(spark, swap.data).select(*partitions).distinct()
            gone = files.limit(0) if old is None else _touched(with_files(old), places, partitions)
        swap.commit(gone.select("_file"))
    return written


def _checked(swap: Swap, files: DataFrame, target: str) -> int:
    """The staged rows, which must be as many as those of the files read (``n``)."""
    expected, written = files.agg(F.sum("n")).first()[0], read_partitioned(swap.spark, swap.data).count()
    if expected != written:
        raise RuntimeError(f"staged {written} of {expected} rows; {target} left as it was")
    return written


def merge_plan(files: DataFrame, partitions: tuple[str, ...], below: int, target_bytes: int) -> DataFrame:
    """Which files to merge: ``_file, bytes``, the partition columns and ``_bin``.

    ``files`` is a listing (:func:`airway.sources.swaps.listed_files`). A partition is picked if
    its mean file is smaller than ``below``. In it files under half of ``target_bytes`` are taken
    in the order of their names, and a new bin begins with every half of ``target_bytes``, so a
    bin holds less than ``target_bytes``. Files alone in their bin stay as they are."""
    place = Window.partitionBy(*partitions)
    half = target_bytes // 2
    small = files.withColumn("_mean", F.avg("bytes").over(place)).where((F.col("_mean") < below) & (F.col("bytes") < half))
    before = F.sum("bytes").over(place.orderBy("_file")) - F.col("bytes")
    binned = small.withColumn(BIN, F.floor(before / half))
    together = F.count("*").over(Window.partitionBy(*partitions, BIN)) > 1
    return binned.withColumn("_some", together).where("_some").drop("_some", "_mean")


def merge_small_files(
    spark: SparkSession,
    path: str,
    pick: Callable[[DataFrame], DataFrame] = lambda files: files,
    partitions: tuple[str, ...] = HOUR_KEYS,
    below: int = SMALL_FILE_BYTES,
    target_bytes: int = MERGED_FILE_BYTES,
) -> int:
    """Merge the small files of partitions whose mean file is below a size; returns how many
    files went. Which ones is planned from the listing (:func:`merge_plan`); nothing else is
    read or written. ``pick`` narrows the listing by partition columns. Swapped by a journal as
    in :func:`compact`, with the same promises; a repeated run finds nothing to do."""
    recover(spark, path)
    if stored_or_none(spark, path) is None:
        return 0
    with Work(spark) as owner, Swap(spark, path) as swap:
        plan = owner.stage(merge_plan(pick(listed_files(spark, path, partitions)), partitions, below, target_bytes), "plan")
        if plan.isEmpty():
            return 0
        largest = F.col("_metadata.file_size") < target_bytes // 2
        rows = with_files(read_partitioned(spark, path).where(largest))
        planned = plan.select(same_form(F.col("_file")).alias("_of"), BIN)
        rows = lookup_join(rows, planned, same_form(F.col("_file")) == F.col("_of"))
        files = owner.stage(rows.groupBy("_file").agg(F.count("*").alias("n")), "files")
        gathered = rows.drop("_file", "_of").repartition(*partitions, BIN)
        gathered.write.partitionBy(*partitions, BIN).parquet(swap.data)
        _checked(swap, files, path)
        swap.commit(files.select("_file"))
        return files.count()
