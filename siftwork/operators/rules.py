"""Validation rules: what they are called, what they say and which rows break them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from siftwork.functions import is_blank, is_malformed_email, to_date, to_number
from siftwork.functions.casts import DEFAULT_DATE_FORMATS

ERROR = "ERROR"
WARNING = "WARNING"

REQUIRED = "required_column"
UNIQUE = "unique_column"
DATE = "date_format"
EMAIL = "email_format"
NUMERIC = "numeric_min_value"
FOREIGN_KEY = "foreign_key"

# Sections of a rules document in the order they run, with the rule each
# section states and that rule's severity where the document names none.
SECTIONS: dict[str, tuple[str, str]] = {
    "required_columns": (REQUIRED, ERROR),
    "unique_columns": (UNIQUE, ERROR),
    "date_columns": (DATE, ERROR),
    "email_columns": (EMAIL, WARNING),
    "numeric_rules": (NUMERIC, ERROR),
    "foreign_keys": (FOREIGN_KEY, ERROR),
}

# The message of each rule.
MESSAGES: dict[str, str] = {
    REQUIRED: "Column '{column}' is required and cannot be null or empty.",
    UNIQUE: "Column '{column}' must contain unique values.",
    DATE: "Column '{column}' contains invalid date values.",
    EMAIL: "Column '{column}' contains invalid email format.",
    NUMERIC: "Column '{column}' must be numeric and >= {min_value}.",
    FOREIGN_KEY: (
        "Column '{column}' contains values not found in {reference_dataset}.{reference_column}."
    ),
}

# Helper columns start like this; input columns may not.
RESERVED = "__siftwork_"
# Date text kept beside a parsed date column has this before its name; the date rule prefers it.
DATE_TEXT = RESERVED + "text_"


def check_reserved(df: DataFrame) -> None:
    """Raise an error for input columns that are called like helper columns."""
    taken = [name for name in df.columns if name.startswith(RESERVED)]
    if taken:
        raise ValueError(f"Names that start with '{RESERVED}' are reserved: {taken}")


@dataclass(frozen=True)
class Rule:
    """One rule on one column.

    ``parsed_column`` names a column that holds the parsed number or date of ``column``
    already, so that the rule need not parse it again. With ``missing_repeats`` several rows
    without a key repeat each other; without it a missing key is never a duplicate.
    """

    name: str
    column: str
    severity: str = ERROR
    min_value: float | None = None
    reference_dataset: str | None = None
    reference_column: str | None = None
    date_formats: tuple[str, ...] = DEFAULT_DATE_FORMATS
    parsed_column: str | None = None
    missing_repeats: bool = True

    @property
    def message(self) -> str:
        return MESSAGES[self.name].format(**vars(self))


def rules_from_document(
    document: Mapping[str, Mapping[str, Sequence[Mapping[str, Any]]]],
    date_formats: Sequence[str] = DEFAULT_DATE_FORMATS,
) -> dict[str, list[Rule]]:
    """Turn a rules document into ordered rules per dataset."""
    return {
        dataset: [
            Rule(
                name=name,
                column=entry["column"],
                severity=entry.get("severity", severity),
                min_value=entry["min_value"] if name == NUMERIC else None,
                reference_dataset=entry["reference_dataset"] if name == FOREIGN_KEY else None,
                reference_column=entry["reference_column"] if name == FOREIGN_KEY else None,
                date_formats=tuple(date_formats),
            )
            for section, (name, severity) in SECTIONS.items()
            for entry in sections.get(section) or []
        ]
        for dataset, sections in document.items()
    }


def row_violation(df: DataFrame, rule: Rule) -> Column:
    """Condition for rules that look at nothing but the row itself. Never null."""
    if rule.name == DATE and rule.parsed_column:
        return F.col(f"`{rule.column}`").isNotNull() & F.col(f"`{rule.parsed_column}`").isNull()
    judged = rule.parsed_column or rule.column
    column = F.col(f"`{judged}`")
    data_type = df.schema[judged].dataType
    is_text = isinstance(data_type, StringType)
    has_nan = isinstance(data_type, (DoubleType, FloatType))

    if rule.name == REQUIRED:
        if is_text:
            return is_blank(column)
        return column.isNull() | F.isnan(column) if has_nan else column.isNull()
    if rule.name == EMAIL:
        return is_malformed_email(column.cast("string"))
    if rule.name == NUMERIC:
        number = to_number(column) if is_text else column
        fine = number >= F.lit(rule.min_value)
        # NaN is above every bound in Spark.
        return ~F.coalesce(fine & ~F.isnan(number) if has_nan else fine, F.lit(False))
    if rule.name == DATE:
        if DATE_TEXT + rule.column in df.columns:
            column, is_text = F.col(f"`{DATE_TEXT}{rule.column}`"), True
        if not is_text:
            return F.lit(False)
        return column.isNotNull() & to_date(column, rule.date_formats).isNull()
    raise ValueError(f"Rule '{rule.name}' needs more than the row it looks at.")
