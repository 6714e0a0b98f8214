"""Issue reports and the quality summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.operators.annotate import ISSUES, annotate
from siftwork.operators.rules import (
    DATE,
    EMAIL,
    ERROR,
    FOREIGN_KEY,
    NUMERIC,
    REQUIRED,
    UNIQUE,
    WARNING,
    Rule,
)
from siftwork.plans.stage import Stage

ISSUE_COLUMNS = ("dataset_name", "rule_name", "column_name", "severity", "message")


def issue_report(annotated: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per issue: the offending row's columns and what is wrong with it."""
    names = [F.col(f"`{name}`") for name in annotated.columns if name != ISSUES]
    if not rules:
        texts = [F.lit(None).cast("string").alias(name) for name in ISSUE_COLUMNS]
        return annotated.filter(F.lit(False)).select(*names, *texts)
    described = F.array(
        *[
            F.struct(
                F.lit(dataset).alias("dataset_name"),
                F.lit(rule.name).alias("rule_name"),
                F.lit(rule.column).alias("column_name"),
                F.lit(rule.severity).alias("severity"),
                F.lit(rule.message).alias("message"),
            )
            for rule in rules
        ]
    )
    return (
        annotated.select(*names, F.explode(ISSUES).alias("__position"))
        .withColumn("__issue", F.get(described, F.col("__position")))
        .select(*names, *[F.col(f"__issue.{name}").alias(name) for name in ISSUE_COLUMNS])
    )


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    """All reports in one table; columns that a report lacks are null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), reports)


def quality_summary(
    annotated: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]
) -> DataFrame:
    """Issues, errors and warnings per dataset; datasets without any count zero."""
    parts = []
    for name, df in annotated.items():
        own_rules = rules.get(name, ())
        parts.append(
            df.agg(
                F.coalesce(F.sum(F.size(ISSUES)), F.lit(0)).alias("issue_count"),
                _count_severity(own_rules, ERROR).alias("error_count"),
                _count_severity(own_rules, WARNING).alias("warning_count"),
            ).select(F.lit(name).alias("dataset_name"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


def _count_severity(rules: Sequence[Rule], severity: str) -> Column:
    """Sum of the issues of one severity, as bigint."""
    positions = [i for i, rule in enumerate(rules) if rule.severity == severity]
    if len(positions) == len(rules):
        return F.coalesce(F.sum(F.size(ISSUES)), F.lit(0))
    hits = [F.array_contains(ISSUES, i).cast("bigint") for i in positions]
    return F.coalesce(F.sum(reduce(Column.__add__, hits, F.lit(0).cast("bigint"))), F.lit(0))


def required_issues(
    df: DataFrame, dataset: str, column: str, stage: Stage, severity: str = ERROR
) -> DataFrame:
    return _single(df, dataset, Rule(REQUIRED, column, severity), {}, stage)


def unique_issues(
    df: DataFrame, dataset: str, column: str, stage: Stage, severity: str = ERROR
) -> DataFrame:
    return _single(df, dataset, Rule(UNIQUE, column, severity), {}, stage)


def date_issues(
    df: DataFrame, dataset: str, column: str, stage: Stage, severity: str = ERROR
) -> DataFrame:
    return _single(df, dataset, Rule(DATE, column, severity), {}, stage)


def numeric_min_issues(
    df: DataFrame,
    dataset: str,
    column: str,
    min_value: float,
    stage: Stage,
    severity: str = ERROR,
) -> DataFrame:
    return _single(df, dataset, Rule(NUMERIC, column, severity, min_value=min_value), {}, stage)


def email_issues(
    df: DataFrame, dataset: str, column: str, stage: Stage, severity: str = WARNING
) -> DataFrame:
    return _single(df, dataset, Rule(EMAIL, column, severity), {}, stage)


def foreign_key_issues(
    df: DataFrame,
    reference: DataFrame,
    dataset: str,
    column: str,
    reference_column: str,
    reference_dataset: str,
    stage: Stage,
    severity: str = ERROR,
) -> DataFrame:
    rule = Rule(
        FOREIGN_KEY,
        column,
        severity,
        reference_dataset=reference_dataset,
        reference_column=reference_column,
    )
    return _single(df, dataset, rule, {reference_dataset: reference}, stage)


def _single(
    df: DataFrame, dataset: str, rule: Rule, references: Mapping[str, DataFrame], stage: Stage
) -> DataFrame:
    return issue_report(annotate(df, [rule], references, stage), dataset, [rule])
