"""Tables written once to the shared work folder, and who removes them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from airway.session import work_root


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared work folder."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


class Work:
    """Owner of staged tables. ``close`` (or leaving a ``with`` block) removes them;
    until then frames that read them stay valid."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def path(self, name: str) -> str:
        self.paths.append(staging_path(self.spark, name))
        return self.paths[-1]

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once and read back: cuts the lineage of a frame that is
        used several times, and lets Catalyst see its true size."""
        return staged_at(df, self.path(name))

    def close(self) -> None:
        while self.paths:
            unstage(self.spark, self.paths.pop())

    def __enter__(self) -> Work:
        return self

    def __exit__(self, *_) -> None:
        self.close()


_SESSION_WORK: dict[str, Work] = {}


def session_work(spark: SparkSession) -> Work:
    """The owner of what lazy results still read; ``release`` closes it."""
    app = spark.sparkContext.applicationId
    if app not in _SESSION_WORK:
        _SESSION_WORK[app] = Work(spark)
    return _SESSION_WORK[app]


def release(spark: SparkSession) -> None:
    """Remove every table staged for results that have been read by now."""
    session_work(spark).close()


def staged(df: DataFrame, name: str, work: Work | None = None) -> DataFrame:
    """``df`` staged with ``work``, or with the session until ``release``."""
    return (work or session_work(df.sparkSession)).stage(df, name)


def staged_at(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back; the caller removes it."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession, path: str) -> None:
    """Remove a staged table that is no longer read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Until the block ends every job's shuffle files go when it ends, not when the driver next
    collects its garbage: for jobs that stage what they make."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
