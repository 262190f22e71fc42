"""Rows through Python in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Characters that separate words, as regular expressions of the contracts give them.
_UPPER = bytes(range(65, 91))
_PLAIN = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if b in _UPPER else 32 for b in range(256))


def space_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space (``[^\\x20\\x09-\\x0D]+``) of UTF-8 text."""
    return text.split()


def plain_words(text: bytes) -> list[bytes]:
    """Words of ASCII letters and digits and of all other than ASCII, A-Z lower-cased."""
    return text.translate(_PLAIN).split()


def code_points(text: bytes) -> int:
    """Code points of UTF-8 text: its bytes without continuation bytes."""
    return len(text.decode("utf-8", "replace"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many leading underscores as make it unlike any column."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def as_bytes(column: str, name: str | None = None):
    """A text column as its UTF-8 bytes; null stays null."""
    return F.col(column).cast("binary").alias(name or column)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that only few texts at a time are Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_batches(df: DataFrame, start: Callable[[], Callable[[list[list]], list]], schema: str) -> DataFrame:
    """``df`` through a Python function. ``start()`` runs once per task and returns a
    function from the columns of a batch, as lists, to the output columns, as lists or
    Arrow arrays. Batches without output rows are skipped."""
    wanted = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(wanted)
        work = start()
        for batch in slices(batches):
            made = work([c.to_pylist() for c in batch.columns])
            arrays = [
                x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(made, kinds, strict=True)
            ]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=kinds)

    return df.mapInArrow(run, wanted)
