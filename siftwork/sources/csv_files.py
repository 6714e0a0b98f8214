"""CSV scans. Every column is read as text; types come later, from explicit casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siftwork.sources.contract import EXPECTED_COLUMNS, check_columns, text_schema

CORRUPT_COLUMN = "_corrupt_record"
PAD = "PAD"
_ROW_END = "\x01end of row"

# Cell texts that stand for a missing value.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def missing_to_null(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn the missing-value tokens of all text columns into null."""
    if not tokens:
        return df
    return df.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(*tokens), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, StringType) and f.name != CORRUPT_COLUMN
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def csv_header(spark: SparkSession, uri: str, escape: str = '"') -> list[str]:
    """Column names in the first line of a CSV file."""
    return spark.read.option("header", True).option("escape", escape).csv(uri).columns


def scan_csv(
    spark: SparkSession,
    uri: str | Sequence[str],
    *,
    schema: StructType | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    mode: str = PAD,
    pattern: str | None = None,
    recursive: bool = False,
    multi_line: bool = False,
    escape: str = '"',
) -> DataFrame:
    """Scan headed CSV from any storage URI; a file, a folder or several of them.

    Columns take their names from the header, and each file's header is checked against
    the first, so files with shuffled columns fail instead of being read askew.

    With PAD a row with too few fields is filled up with nulls and one with too many ends
    the job. With FAILFAST both end the job. With PERMISSIVE both are read, padded or cut,
    and their text is kept in ``_corrupt_record``. ``multi_line`` allows line breaks
    inside quotes, at the price of one task per file.
    """
    keeps_text = mode.upper() in (PAD, "PERMISSIVE")
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE" if keeps_text else mode)
        .option("escape", escape)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", recursive)
        # Column pruning would hide rows with too many fields from a narrow query.
        .option("columnPruning", False)
    )
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        if schema is None:
            header = reader.csv(uri).columns
            if not header:
                raise ValueError(f"No header line in {uri}; an empty file has no columns.")
            schema = StructType([StructField(name, StringType(), True) for name in header])
        if keeps_text:
            schema = StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        scanned = reader.schema(schema).csv(uri)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Nothing to scan at {uri}") from error
        raise
    if mode.upper() == PAD:
        scanned = scanned.filter(_is_whole_or_short(scanned, escape)).drop(CORRUPT_COLUMN)
    return missing_to_null(scanned, null_tokens)


def _is_whole_or_short(scanned: DataFrame, escape: str) -> Column:
    """True for rows to keep; raises an error for a malformed row that is not just short.

    The text of a malformed row is parsed once more with a mark behind it. In a short row
    the mark lands in one of the columns.
    """
    names = [name for name in scanned.columns if name != CORRUPT_COLUMN]
    text = F.col(CORRUPT_COLUMN)
    fields = F.from_csv(
        F.concat(text, F.lit(f",{_ROW_END}")),
        ", ".join(f"c{i} string" for i in range(len(names))),
        {"mode": "PERMISSIVE", "escape": escape},
    )
    is_short = F.exists(
        F.array(fields),
        lambda row: F.array_contains(
            F.array(*[F.coalesce(row[f"c{i}"], F.lit("")) for i in range(len(names))]), _ROW_END
        ),
    )
    # The message names a column because Spark refuses scans of the text column alone,
    # which is all that a count would otherwise read.
    first = F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))
    too_long = F.raise_error(
        F.concat(F.lit(f"Expected {len(names)} fields, in the row of '"), first, F.lit("': "), text)
    )
    return F.when(text.isNull() | is_short, True).otherwise(too_long.cast("boolean"))


def scan_dataset_by_position(
    spark: SparkSession, dataset: str, uri: str, **options: object
) -> DataFrame:
    """Scan with the dataset's fixed all-text schema; the header has to agree with it.

    Only empty cells are missing here, other tokens are kept as they stand.
    """
    options.setdefault("null_tokens", ())
    return scan_csv(spark, uri, schema=text_schema(dataset), **options)


def load_dataset(
    spark: SparkSession,
    dataset: str,
    uri: str,
    contract: Mapping[str, Sequence[str]] = EXPECTED_COLUMNS,
    **options: object,
) -> DataFrame:
    """Scan one dataset and check its column contract."""
    return check_columns(scan_csv(spark, uri, **options), dataset, contract)


def load_datasets(
    spark: SparkSession,
    root: str,
    contract: Mapping[str, Sequence[str]] = EXPECTED_COLUMNS,
    **options: object,
) -> dict[str, DataFrame]:
    """Scan ``<root>/<dataset>.csv`` for every dataset of the contract."""
    return {
        name: load_dataset(spark, name, f"{root.rstrip('/')}/{name}.csv", contract, **options)
        for name in contract
    }
