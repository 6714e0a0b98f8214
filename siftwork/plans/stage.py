"""Written intermediate tables in the folder the cluster shares for checkpoints."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from siftwork.sources.storage import Storage

CHECKPOINT_SETTING = "spark.checkpoint.dir"
JOBS_AT_ONCE = 8


def shared_folder(spark: SparkSession) -> str:
    """The folder set by ``spark.checkpoint.dir``; a temporary one for local sessions only."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"Set {CHECKPOINT_SETTING} to a folder that all executors can reach.")
    return tempfile.mkdtemp(prefix="siftwork-")


def run_together(jobs: Iterable[Callable[[], object]]) -> list:
    """Run independent jobs side by side, so that the tail of one leaves no executor idle."""
    jobs = list(jobs)
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(max_workers=min(len(jobs), JOBS_AT_ONCE)) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def joins_by_shuffle(df: DataFrame) -> bool:
    """Whether the plan, as made from the sizes known now, shuffles rows for a join."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


_SHUFFLE_FILES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writing: dict[str, list] = {}


@contextmanager
def _without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """While a staged table is written, Spark drops the shuffle files of a write at its end.

    The table stands in for them. The session's own setting comes back after the last write.
    """
    held = _writing.setdefault(spark.sparkContext.applicationId, [0, None])
    with _lock:
        if not held[0]:
            held[1] = spark.conf.get(_SHUFFLE_FILES, None)
            spark.conf.set(_SHUFFLE_FILES, "true")
        held[0] += 1
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(_SHUFFLE_FILES, held[1] or "false")


class Stage:
    """A folder of Parquet tables for one run.

    Writing a table cuts the lineage, so a lost executor costs a re-read and not a
    recomputation. It also gives the optimizer the true size of the table, which is what
    decides between a broadcast and a shuffle join when the table is used.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.uri = f"{(folder or shared_folder(spark)).rstrip('/')}/siftwork-{uuid.uuid4().hex}"
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def path(self, name: str) -> str:
        return f"{self.uri}/{name}_{uuid.uuid4().hex[:8]}"

    def table(
        self, df: DataFrame, name: str, compression: str = "snappy", partition_by: str | None = None
    ) -> DataFrame:
        """Write ``df`` and return a scan of the written table."""
        path = self.path(name)
        writer = df.write.option("compression", compression)
        with _without_shuffle_files(self.spark):
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        written = self.spark.read.schema(df.schema).parquet(path)
        # The frame is held with its path, so that its identity stays its own.
        self._paths[id(written)] = written, path
        return written

    def tables(
        self, frames: Mapping[str, DataFrame], compression: str = "snappy"
    ) -> dict[str, DataFrame]:
        """Write several tables side by side."""
        written = run_together(
            [
                lambda name=name, df=df: self.table(df, name, compression=compression)
                for name, df in frames.items()
            ]
        )
        return dict(zip(frames, written))

    def key_sets(self, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Write sets of unique keys, uncompressed so that file size tells memory size.

        The broadcast threshold is compared with the size of the files.
        """
        return self.tables(frames, compression="uncompressed")

    def drop(self) -> None:
        """Delete the run's tables; call it once no DataFrame reads them any more."""
        Storage(self.spark).delete(self.uri)

    def drop_table(self, *tables: DataFrame) -> None:
        """Delete single tables of ``table`` that no DataFrame reads any more."""
        storage = Storage(self.spark)
        for table in tables:
            storage.delete(self._paths.pop(id(table))[1])
