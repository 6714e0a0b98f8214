"""Storage zones: fixed folders below one root on any Hadoop-readable storage."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.sources.csv_files import csv_header, scan_csv
from siftwork.sources.sinks import write_table

# The zones of a storage root.
ZONES = ("raw", "processed", "rejected", "reports")
#: Headers that are read side by side.
HEADERS_AT_ONCE = 8


@dataclass(frozen=True)
class ZoneTable:
    """A table found in a zone: its name, its header, and what to scan for its rows."""

    name: str
    columns: tuple[str, ...]
    uri: str


def zone_uri(root: str, zone: str, name: str | None = None) -> str:
    if zone not in ZONES:
        raise ValueError(f"Unknown zone '{zone}', expected one of {list(ZONES)}.")
    parts = [root.rstrip("/"), zone] + ([name] if name else [])
    return "/".join(parts)


def list_zone(spark: SparkSession, root: str, zone: str, pattern: str = "*.csv") -> list[ZoneTable]:
    """The tables of a zone, by name.

    Files called ``part-...`` are what a job wrote: those of one folder are one table, named like
    the folder. Any other file is a table of its own, named like the file without its suffix.
    Empty files are no tables. Files are listed and put together by Spark; the driver gets one
    row for each table, and a table's header comes from one of its files.
    """
    uri = zone_uri(root, zone)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    try:
        files = listing.option("recursiveFileLookup", True).load(uri).select("path", "length")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Nothing to scan at {uri}") from error
        raise
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    is_part = F.regexp_extract("path", r"([^/]*)$", 1).startswith("part-")
    found = (
        files.filter("length > 0")
        .groupBy(F.when(is_part, folder).otherwise(F.col("path")).alias("location"), is_part.alias("is_part"))
        .agg(F.min("path").alias("first"))
        .orderBy("location")
        .collect()
    )
    below = "/" + re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", uri).strip("/") + "/"

    def table(row) -> ZoneTable:
        name = row.location.partition(below)[2] or zone
        columns = tuple(csv_header(spark, row.first))
        if row.is_part:
            return ZoneTable(name, columns, f"{row.location}/part-*")
        return ZoneTable(re.sub(r"\.[^./]*$", "", name), columns, row.location)

    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        return list(pool.map(table, found))


def scan_zone_tables(
    spark: SparkSession, root: str, zone: str, pattern: str = "*.csv", **options: object
) -> dict[str, DataFrame]:
    """A lazy scan of each table of a zone, by name; ``options`` are those of ``scan_csv``."""
    tables = list_zone(spark, root, zone, pattern)
    return {t.name: scan_csv(spark, t.uri, pattern=pattern, **options) for t in tables}


def scan_zone_by_header(
    spark: SparkSession, root: str, zone: str, pattern: str = "*.csv", **options: object
) -> dict[tuple[str, ...], DataFrame]:
    """One lazy scan for each header that the tables of a zone have, over all tables with it."""
    uris: dict[tuple[str, ...], list[str]] = {}
    for table in list_zone(spark, root, zone, pattern):
        uris.setdefault(table.columns, []).append(table.uri)
    return {columns: scan_csv(spark, found, pattern=pattern, **options) for columns, found in uris.items()}


def scan_zone(
    spark: SparkSession,
    root: str,
    zone: str,
    name: str | None = None,
    pattern: str = "*.csv",
    **options: object,
) -> DataFrame:
    """Scan one named folder of a zone, or all of a zone whose tables have one header."""
    if name is not None:
        return scan_csv(spark, zone_uri(root, zone, name), pattern=pattern, recursive=True, **options)
    kinds = scan_zone_by_header(spark, root, zone, pattern, **options)
    if not kinds:
        raise FileNotFoundError(f"No tables in {zone_uri(root, zone)}")
    if len(kinds) > 1:
        said = "; ".join(", ".join(columns) for columns in kinds)
        raise ValueError(f"{zone_uri(root, zone)} has tables with different headers, name one or scan them one by one: {said}")
    return next(iter(kinds.values()))


def publish_to_zone(df: DataFrame, root: str, zone: str, name: str, fmt: str = "csv") -> str:
    """Write a table straight into a zone, replacing an earlier version."""
    return write_table(df, zone_uri(root, zone, name), fmt)
