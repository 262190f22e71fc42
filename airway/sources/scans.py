"""Table, partition, text and JSON readers."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airway.operators.cleaning import within
from airway.operators.hours import HourRange
from airway.operators.joining import lookup_join
from airway.sources.staging import staged
from airway.sources.swaps import listed_files, same_form, with_files

HOUR_KEYS = ("publish_date", "hour")


@dataclass
class Tables:
    """Resolves table names to DataFrames.

    ``paths`` maps a name to a Parquet path; ``jdbc`` maps a name to reader
    options (``url``, ``dbtable`` and, for a parallel read, ``partitionColumn``,
    ``lowerBound``, ``upperBound``, ``numPartitions``); any other name is looked
    up in the catalog. Filters and projections belong on the returned frame:
    Spark pushes them into the scan of each of the three.
    """

    spark: SparkSession
    paths: Mapping[str, str] = field(default_factory=dict)
    jdbc: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def __call__(self, name: str) -> DataFrame:
        if name in self.paths:
            return read_partitioned(self.spark, self.paths[name])
        if name in self.jdbc:
            return self.spark.read.format("jdbc").options(**self.jdbc[name]).load()
        return self.spark.table(name)

    def window(self, name: str, time: str, start: str, end: str) -> DataFrame:
        """Rows of a table in the half-open window."""
        return self(name).where(within(time, start, end))


def read_partitioned(spark: SparkSession, root: str, skip_unreadable: bool = False) -> DataFrame:
    """A partitioned Parquet dataset with its partition columns as text, so that
    hour ``00`` is not read as the number 0. ``skip_unreadable`` leaves out files
    that are broken or vanish instead of failing."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        skip = {"ignoreCorruptFiles": skip_unreadable, "ignoreMissingFiles": skip_unreadable}
        return spark.read.options(**skip).parquet(root)
    finally:
        spark.conf.set(key, before)


def stored_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The dataset at ``path``, or None before its first write."""
    try:
        return read_partitioned(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def slot_text() -> Column:
    """``yyyy-MM-dd HH`` of the partition columns, be they text or typed."""
    day, hour = HOUR_KEYS
    return F.concat_ws(" ", day, F.lpad(F.col(hour).cast("string"), 2, "0"))


def in_hours(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of the date/hour partitions from ``first`` to ``last`` inclusive. The
    predicates are on partition columns only, so other folders are not read."""
    day = F.col(HOUR_KEYS[0]).between(first[:10], last[:10])
    return df.where(day & slot_text().between(first[:13], last[:13]))


def read_hours(spark: SparkSession, root: str, hours: HourRange, skip_unreadable: bool = False) -> DataFrame:
    """Rows of the hour partitions in the range. Absent partitions give no rows.

    The root is still listed; a catalog table (:class:`Tables`) saves that.
    """
    return in_hours(read_partitioned(spark, root, skip_unreadable), hours.first, hours.last)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as ``value``, the first line of each file dropped; all others
    stay, blank ones too. Rows of a file's first split come in their order."""

    def without_first(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        last = None
        for batch in batches:
            lines, paths, starts = batch.columns
            names = paths.to_pylist()
            opens = [s == 0 and p != q for p, q, s in zip(names, [last, *names[:-1]], starts.to_pylist(), strict=True)]
            last = names[-1] if names else last
            kept = lines.filter(pc.invert(pa.array(opens, pa.bool_())))
            yield pa.RecordBatch.from_arrays([kept], names=["value"])

    rows = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    return rows.mapInArrow(without_first, "value string")


def files_without_rows(spark: SparkSession, root: str) -> DataFrame:
    """``path`` of the Parquet files below ``root`` that give no row when unreadable files
    are skipped: what :func:`read_partitioned` with ``skip_unreadable`` leaves out."""
    shape = F.regexp_replace("path", "^([a-z0-9]+:)/+", "$1/").alias("path")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    listed = reader.load(root).select(shape)
    read = read_partitioned(spark, root, skip_unreadable=True).select(F.col("_metadata.file_path").alias("path")).distinct()
    return listed.join(read.select(shape), "path", "left_anti")


def broken_files(spark: SparkSession, root: str, partitions: tuple[str, ...] = HOUR_KEYS) -> DataFrame:
    """The partition columns and ``path`` of files that are no readable Parquet.

    Row counts are read from all footers in tasks. Only files that give no row are looked at
    whole: those that are valid and hold no rows are left out. Their names pass the driver, as
    those of any file that Spark reads. Files of no bytes are not listed; Spark never reads them."""
    read = with_files(read_partitioned(spark, root, skip_unreadable=True)).select(same_form(F.col("_file")).alias("_read")).distinct()
    listed = listed_files(spark, root, partitions).withColumn("path", same_form(F.col("_file")))
    silent = listed.join(read, F.col("path") == F.col("_read"), "left_anti")
    names = [row["_file"] for row in silent.select("_file").toLocalIterator()]

    def valid(batches):
        import io

        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    empty = pq.ParquetFile(io.BytesIO(content)).metadata.num_rows == 0
                except (pa.ArrowException, OSError):
                    empty = False
                if empty:
                    yield pa.RecordBatch.from_pydict({"_empty": [path]})

    if not names:
        return silent.select(*partitions, "path")
    empty = spark.read.format("binaryFile").load(names).select("path", "content").mapInArrow(valid, "_empty string")
    return silent.join(empty.select(same_form(F.col("_empty")).alias("_empty")), F.col("path") == F.col("_empty"), "left_anti").select(*partitions, "path")


def read_whole_partitions(spark: SparkSession, root: str, partitions: tuple[str, ...] = HOUR_KEYS) -> tuple[DataFrame, DataFrame]:
    """Rows of the partitions without any broken file, and the report of those with one
    (:func:`broken_files`). Half a partition is worse than none, so such a partition is left
    out with its readable files too."""
    report = staged(broken_files(spark, root, partitions), "broken")
    bad = report.select(*[F.col(k).alias(f"_bad_{k}") for k in partitions]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_bad_{k}")) for k in partitions])
    rows = read_partitioned(spark, root, skip_unreadable=True)
    return lookup_join(rows, bad, same, "left_anti"), report


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_json_documents(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Landed API responses, one JSON object or array per line. Without a schema
    Spark infers one in an extra pass."""
    reader = spark.read
    return (reader.schema(schema) if schema else reader).json(path)


def inline_records(df: DataFrame, payload: str, names: list[str]) -> DataFrame:
    """Records of a JSON-array text column: the named fields as text, absent
    ones null."""
    record = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return df.select(F.inline(F.from_json(payload, T.ArrayType(record))))
