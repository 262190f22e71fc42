"""Files of a partitioned dataset replaced by staged ones, so that no row is lost.

New files are staged below the dataset, in a folder that readers pass over. Then a journal
names every file that comes and every file that goes; once it is whole the swap is as good as
done, for whoever touches the dataset next carries it out again from the start. Files are
named one by one, so files that land meanwhile are in no journal and stay. Renames and
deletes are the driver's, as those of Spark's own commits; file names are streamed to it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_swaps"
# Says that the journal beside it is whole.
WHOLE = "journal-is-whole"
# A column of this name splits staged files and is no partition of the dataset.
BIN = "_bin"


def plain_path(encoded: Column) -> Column:
    """A path as the file system writes it, from ``_metadata.file_path``."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def same_form(path: Column) -> Column:
    """Paths of one file alike, however many slashes follow the scheme."""
    return F.regexp_replace(path, "^([a-z0-9]+:)/+", "$1/")


def with_files(df: DataFrame) -> DataFrame:
    """The rows of a dataset with their ``_file``."""
    return df.select("*", plain_path(F.col("_metadata.file_path")).alias("_file"))


def listed_files(spark: SparkSession, root: str, partitions: tuple[str, ...]) -> DataFrame:
    """``_file, bytes`` and the partition columns, as text, of all Parquet files; a listing only."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    values = F.str_to_map(F.array_join(F.slice(F.split("path", "/"), -len(partitions) - 1, len(partitions)), "/"), F.lit("/"), F.lit("="))
    files = reader.load(root).select(F.col("path").alias("_file"), F.col("length").alias("bytes"), values.alias("_values"))
    shown = {k: F.nullif(plain_path(F.col("_values")[k]), F.lit("__HIVE_DEFAULT_PARTITION__")) for k in partitions}
    return files.select("_file", "bytes", *[value.alias(k) for k, value in shown.items()])


class Swap:
    """Write to ``data`` as if it were the dataset, then ``commit`` what goes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = f"{self.root}/{FOLDER}/{uuid.uuid4().hex}"
        self.data = f"{self.folder}/data"
        self.kept = [self.data]

    def hidden(self, name: str) -> str:
        """A folder for a side table of the dataset (a hidden name) within the swap."""
        self.kept.append(f"{self.data}/{name}")
        return self.kept[-1]

    def added(self) -> DataFrame:
        """``_file`` of everything staged so far."""
        reader = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        return reader.load([f for f in self.kept if _exists(self.spark, f)]).select(F.col("path").alias("_file"))

    def commit(self, gone: DataFrame) -> None:
        """Put the staged files in place and remove the files ``_file`` of ``gone``."""
        self.promise(gone)
        replay(self.spark, self.folder)

    def promise(self, gone: DataFrame) -> None:
        """Write the journal of :meth:`commit`; from here on ``recover`` finishes the swap."""
        place = F.regexp_replace("_file", f"/{FOLDER}/[0-9a-f]{{32}}/data/", "/")
        comes = self.added().select("_file", F.regexp_replace(place, f"/{BIN}=[0-9]+/", "/").alias("target"))
        goes = gone.select("_file", F.lit(None).cast("string").alias("target")).distinct()
        comes.unionByName(goes).write.parquet(f"{self.folder}/journal")
        whole, fs = _path(self.spark, f"{self.folder}/{WHOLE}")
        fs.createNewFile(whole)

    def abandon(self) -> None:
        """Remove what is staged, unless a journal already names it."""
        folder, fs = _path(self.spark, self.folder)
        if not _exists(self.spark, f"{self.folder}/{WHOLE}"):
            fs.delete(folder, True)

    def __enter__(self) -> Swap:
        return self

    def __exit__(self, *_) -> None:
        self.abandon()


def recover(spark: SparkSession, root: str) -> int:
    """Carry out the swaps of ``root`` whose journal is whole; returns their number. What a
    run left without journal changes nothing; it may belong to a run at work, so it stays."""
    folder, fs = _path(spark, f"{root.rstrip('/')}/{FOLDER}")
    found = [str(s.getPath()) for s in fs.listStatus(folder)] if fs.exists(folder) else []
    whole = [f for f in found if _exists(spark, f"{f}/{WHOLE}")]
    for swap in whole:
        replay(spark, swap)
    return len(whole)


def replay(spark: SparkSession, folder: str) -> None:
    """What comes first, what goes afterwards; every step may be there already."""
    journal = spark.read.schema("_file string, target string").parquet(f"{folder}/journal")
    for row in journal.where("target IS NOT NULL").toLocalIterator():
        (source, fs), (target, _) = _path(spark, row["_file"]), _path(spark, row["target"])
        if fs.exists(source):
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise RuntimeError(f"{source} cannot be moved to {target}; {folder} can be replayed")
        elif not fs.exists(target):
            raise RuntimeError(f"{target} is lost: {source} is not there either")
    for row in journal.where("target IS NULL").toLocalIterator():
        source, fs = _path(spark, row["_file"])
        fs.delete(source, False)
    path, fs = _path(spark, folder)
    fs.delete(path, True)


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, name: str) -> bool:
    path, fs = _path(spark, name)
    return fs.exists(path)


def write_bytes(spark: SparkSession, name: str, content: bytes) -> None:
    """A small file as it is."""
    path, fs = _path(spark, name)
    out = fs.create(path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
