"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.plans.stage import Stage

# ASCII white space, the only characters that separate words here.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator needs, null texts as empty ones, under fixed names.

    All other columns stay behind, so their names can't clash with those of an operator.
    """
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def repeats_ids(docs: DataFrame, id_col: str = "doc_id") -> bool:
    """Whether rows share an id or have none; ids alone are read and merged on the map side."""
    ids = docs.select(docs[id_col].cast("bigint").alias("id")).groupBy("id").count()
    return bool(ids.filter("count > 1 or id is null").head(1))


def as_binary(column: pa.Array) -> pa.Array:
    """A string column's UTF-8 bytes, without a copy."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        return column.cast(pa.large_binary())
    return column.cast(pa.binary())


def small(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that what is made of one takes little memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def give_back() -> None:
    """Return freed memory that this worker's allocators keep: workers wait for further tasks, of any stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def records(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    """(doc_id, UTF-8 bytes of the text) of batches with the columns of ``id_and_text``."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = as_binary(batch.column(1))
        for i, doc_id in enumerate(ids):
            yield doc_id, texts[i].as_py()


def batches_of(
    rows: Iterable[tuple], schema: pa.Schema, size: int = 1024
) -> Iterator[pa.RecordBatch]:
    """Row tuples as record batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, schema)],
        schema=schema,
    )


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class RollingHashes:
    """64-bit hashes of all stretches of a sequence of unit hashes, from weighted prefix sums.

    The hash of units i..i+w is the sum of unit times base**(position - i) modulo 2**64. Unit
    hashes must be random 64-bit values, and the base odd.
    """

    def __init__(self, base: int):
        self.base = base
        self.powers = np.ones(1, dtype=np.uint64)
        self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) >= n:
            return
        n = max(2 * len(self.powers), n, 4096)
        inverse = pow(self.base, -1, 1 << 64)
        for name, base in (("powers", self.base), ("inverses", inverse)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, units: np.ndarray) -> np.ndarray:
        self._grow(len(units) + 1)
        out = np.zeros(len(units) + 1, dtype=np.uint64)
        np.cumsum(units * self.powers[: len(units)], dtype=np.uint64, out=out[1:])
        return out

    def windows(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all stretches of ``width`` units."""
        n = len(sums) - width
        return mixed((sums[width:] - sums[:n]) * self.inverses[:n])

    def stretches(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - starts).astype(np.uint64)
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts] + length)


_seeded = np.random.Generator(np.random.PCG64(20240229))
#: A random 64-bit value for each byte, and the same with letters A-Z as a-z.
BYTE_VALUES = _seeded.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_VALUES = BYTE_VALUES[[c + 32 if 65 <= c <= 90 else c for c in range(256)]]
IS_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
_letters = RollingHashes(0x5851F42D4C957F2D)


def word_hashes(text: bytes, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, computed from bytes at once."""
    data = np.frombuffer(text, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sums = _letters.sums((LOWER_VALUES if lower else BYTE_VALUES)[data])
    return _letters.stretches(sums, starts, ends)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of equal neighbours."""
    if not len(values):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate(([0], cuts)), np.concatenate((cuts, [len(values)]))


def union_length(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` units lie in at least one of the stretches."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def repeated_cells(cells: DataFrame, width_bits: int, stage: Stage) -> np.ndarray:
    """A bit for each cell of a count-min row: set if its count over all partitions exceeds one.

    ``cells`` has a column ``cell``, below 2**width_bits, once for each counted item. Partitions
    count their own cells and the counts are summed by cell, so no cell has a hot task. The
    bitmap has a fixed size of 2**width_bits / 8 bytes, whatever the corpus holds.
    """
    if not 6 <= width_bits <= 30:
        raise ValueError("width_bits must lie between 6 and 30")
    counted = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    return cell_bitmap(counted, width_bits, stage)


def cell_bitmap(cells: DataFrame, width_bits: int, stage: Stage) -> np.ndarray:
    """2**width_bits bits, set where ``cells`` has the number in its column ``cell``.

    The words of the bitmap are written first, so that the shuffles behind them are dropped.
    """
    words = cells.groupBy(F.shiftright("cell", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("bits")
    )
    written = stage.table(words, "cells", "zstd")
    words = written.toArrow()
    stage.drop_table(written)
    bitmap = np.zeros(1 << (width_bits - 6), dtype=np.uint64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bitmap


def flagged(bitmap: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bitmap[cells >> np.uint64(6)] >> (cells & np.uint64(63))) & np.uint64(1) == 1


def hex_sha(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)
