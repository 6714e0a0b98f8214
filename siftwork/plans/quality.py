"""Validate and split: scan, normalise, check, split, report, sum up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siftwork.functions.casts import DEFAULT_DATE_FORMATS, VOTE
from siftwork.operators.annotate import ISSUES, annotate_all, split_once
from siftwork.operators.normalize import normalize, voted_formats
from siftwork.operators.presets import preset_rules
from siftwork.operators.reports import issue_report, quality_summary, union_reports
from siftwork.operators.rules import DATE, Rule
from siftwork.operators.split import clean_rows, rejected_rows
from siftwork.plans.stage import Stage, run_together
from siftwork.sources import load_dataset, write_table, zone_uri

@dataclass
class QualityRun:
    """What a run wrote, and how many rows of each dataset were clean and rejected."""

    outputs: dict[str, str] = field(default_factory=dict)
    row_counts: dict[str, dict[str, int]] = field(default_factory=dict)


def counted(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that comes along with its write."""
    rows = Observation(label)
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def write_all(
    results: Mapping[str, tuple[DataFrame, str]], output: str, fmt: str
) -> dict[str, str]:
    """Write each result into its zone below ``output``, side by side."""
    uris = run_together(
        [
            lambda df=df, name=name, zone=zone: write_table(df, zone_uri(output, zone, name), fmt)
            for name, (df, zone) in results.items()
        ]
    )
    return dict(zip(results, uris))


def _in_forms(rules: Sequence[Rule], forms: Mapping[str, Sequence[str]]) -> list[Rule]:
    """The rules, with date rules in the forms found for their columns."""
    return [
        replace(rule, date_formats=tuple(forms[rule.column])) if rule.name == DATE and rule.column in forms else rule
        for rule in rules
    ]


def run_quality_pipeline(
    spark: SparkSession,
    inputs: Mapping[str, str | DataFrame],
    output: str,
    rules: Mapping[str, Sequence[Rule]] | None = None,
    *,
    fmt: str = "csv",
    reject_on: Sequence[str] | None = None,
    check_date_text: bool = False,
    date_formats: Sequence[str] | str = DEFAULT_DATE_FORMATS,
    text_keys: bool = False,
    stage: Stage | None = None,
    **scan_options: object,
) -> QualityRun:
    """Run the whole quality job and write its outputs below ``output``.

    ``inputs`` gives a CSV location or a DataFrame of text columns for each dataset. Dates
    are parsed before the rules run, so an unreadable date is missing and passes the date
    rule; ``check_date_text`` makes the rule judge the text instead. With ``date_formats="vote"``
    each date column is read in the form that reads most of its values, for one more scan of these.

    Outputs: ``processed/clean_<dataset>``, ``rejected/rejected_<dataset>``,
    ``reports/<dataset>_validation_report``, ``reports/all_issues_validation_report`` and
    ``reports/quality_summary``.
    """
    rules = preset_rules() if rules is None else rules
    own_stage = stage is None
    stage = stage or Stage(spark)
    run = QualityRun()
    try:
        raw = {
            name: source if isinstance(source, DataFrame) else load_dataset(spark, name, source, **scan_options)
            for name, source in inputs.items()
        }
        forms: dict[str, object] = {name: date_formats for name in raw}
        if date_formats == VOTE:
            forms = {name: voted_formats(df, name) for name, df in raw.items()}
            rules = {name: _in_forms(own, forms.get(name, {})) for name, own in rules.items()}
        # Text is parsed once; key sets then read single columns of the staged tables.
        normal = stage.tables(
            {
                name: normalize(
                    df,
                    name,
                    date_formats=forms[name],
                    text_keys=text_keys,
                    keep_date_text=check_date_text,
                )
                for name, df in raw.items()
            }
        )
        annotated = annotate_all(normal, rules, stage)

        halves = dict(
            zip(
                annotated,
                run_together(
                    [lambda df=df, name=name: split_once(df, stage, name) for name, df in annotated.items()]
                ),
            )
        )
        results: dict[str, tuple[DataFrame, str]] = {}
        counts: dict[str, tuple[Observation, Observation]] = {}
        with_issues: dict[str, DataFrame] = {}
        reports: dict[str, DataFrame] = {}
        for name, (faultless, faulty) in halves.items():
            own_rules = rules.get(name, ())
            with_issues[name] = faulty
            reports[name] = issue_report(faulty, name, own_rules)
            passed = faultless.drop(ISSUES)
            if reject_on is not None:
                # Some of the rows with issues are tolerated.
                passed = passed.unionByName(clean_rows(faulty, own_rules, reject_on))
            clean, clean_count = counted(passed, f"clean_{name}")
            rejected, rejected_count = counted(
                rejected_rows(faulty, own_rules, reject_on), f"rejected_{name}"
            )
            results[f"clean_{name}"] = (clean, "processed")
            results[f"rejected_{name}"] = (rejected, "rejected")
            counts[name] = (clean_count, rejected_count)
        reports["all_issues"] = union_reports(list(reports.values()))
        for name, report in reports.items():
            results[f"{name}_validation_report"] = (report, "reports")
        results["quality_summary"] = (quality_summary(with_issues, rules).coalesce(1), "reports")
        run.outputs = write_all(results, output, fmt)
        for name, (clean_count, rejected_count) in counts.items():
            run.row_counts[name] = {
                "clean": clean_count.get["rows"],
                "rejected": rejected_count.get["rows"],
            }
        return run
    finally:
        if own_stage:
            stage.drop()
