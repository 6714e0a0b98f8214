"""Table sinks. A table is replaced by one that is whole, never written over."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from siftwork.sources.storage import Storage

# Spark's listings pass over names that start with an underscore.
_BESIDE, _REPLACED = "_siftwork_", "_replaced"
_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_table(df: DataFrame, uri: str, fmt: str = "csv") -> str:
    """Write ``df`` to ``uri``, replacing what is there, and return the URI.

    The rows go to a folder beside ``uri`` first. Once all are written the old table is moved
    out of the way, the new one moved in, and the old one deleted. If the write fails the old table
    has not been touched; if the job dies between the moves, the next write or
    ``restore_table`` puts the old table back. ``df`` may read from ``uri`` itself.

    CSV keeps blanks at cell ends and doubles quotes inside quoted cells, so that a
    later ``scan_csv`` gives back the same text.
    """
    uri = uri.rstrip("/")
    storage = Storage(df.sparkSession)
    restore_table(df.sparkSession, uri)
    parent, _, name = uri.rpartition("/")
    beside = f"{parent}/{_BESIDE}{uuid.uuid4().hex}_{name}"
    writer = df.write.options(**_CSV) if fmt == "csv" else df.write
    try:
        writer.format(fmt).save(beside)
    except BaseException:
        storage.delete(beside)
        raise
    _swap(storage, beside, uri)
    return uri


def _swap(storage: Storage, new: str, uri: str) -> None:
    old = new + _REPLACED
    had_one = storage.exists(uri)
    if had_one:
        storage.rename(uri, old)
    try:
        storage.rename(new, uri)
    except BaseException:
        if had_one:
            storage.rename(old, uri)
        storage.delete(new)
        raise
    if had_one:
        storage.delete(old)


def restore_table(spark: SparkSession, uri: str) -> bool:
    """Put back the table that a job moved out of the way and did not live to replace.

    True if there was one. A table that is in its place is left alone.
    """
    storage = Storage(spark)
    parent, _, name = uri.rstrip("/").rpartition("/")
    if storage.exists(uri):
        return False
    left = [x for x in storage.names(parent) if x.startswith(_BESIDE) and x.endswith(f"_{name}{_REPLACED}")]
    if left:
        storage.rename(f"{parent}/{left[0]}", uri)
    return bool(left)


def read_table(spark: SparkSession, uri: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """A table as ``write_table`` left it, in the types it was written with."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        # Cells may hold line breaks; so a file is read as a whole. A null is an empty cell, which the
        # parser turns into the mark; an empty text is a quoted one and stays.
        reader = reader.options(**_CSV, multiLine=True, mode="FAILFAST", nullValue="\x01")
    return reader.format(fmt).load(uri)
