"""Files and folders on whatever storage a URI names: look, rename, delete."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    """Hadoop's file systems, as the session is set up for them.

    Data never passes here, only names; this needs a session with its own JVM (not Spark Connect).
    """

    def __init__(self, spark: SparkSession):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, uri: str):
        path = self._path(uri)
        return path.getFileSystem(self._conf), path

    def exists(self, uri: str) -> bool:
        system, path = self._at(uri)
        return system.exists(path)

    def names(self, uri: str) -> list[str]:
        """Names of what lies right below a folder."""
        system, path = self._at(uri)
        return [status.getPath().getName() for status in system.listStatus(path)] if system.exists(path) else []

    def delete(self, uri: str) -> None:
        system, path = self._at(uri)
        system.delete(path, True)

    def rename(self, source: str, target: str) -> None:
        """Rename within one storage; an error if the target exists or the storage refuses."""
        system, path = self._at(source)
        if system.exists(self._path(target)) or not system.rename(path, self._path(target)):
            raise OSError(f"Could not rename {source} to {target}.")
