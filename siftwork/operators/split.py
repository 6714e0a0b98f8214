"""Clean and rejected rows of an annotated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.operators.annotate import ISSUES
from siftwork.operators.rules import Rule


def is_rejected(rules: Sequence[Rule], reject_on: Sequence[str] | None = None) -> Column:
    """True for rows with any issue, or with one of the given severities."""
    if reject_on is None:
        return F.size(ISSUES) > 0
    positions = [i for i, rule in enumerate(rules) if rule.severity in reject_on]
    if not positions:
        return F.lit(False)
    if len(positions) == len(rules):
        return F.size(ISSUES) > 0
    return F.arrays_overlap(ISSUES, F.array(*[F.lit(i) for i in positions]))


def clean_rows(
    annotated: DataFrame, rules: Sequence[Rule], reject_on: Sequence[str] | None = None
) -> DataFrame:
    return annotated.filter(~is_rejected(rules, reject_on)).drop(ISSUES)


def rejected_rows(
    annotated: DataFrame, rules: Sequence[Rule], reject_on: Sequence[str] | None = None
) -> DataFrame:
    """Rejected rows, each once, however many rules it breaks."""
    return annotated.filter(is_rejected(rules, reject_on)).drop(ISSUES)
