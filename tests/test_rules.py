from __future__ import annotations

import datetime
import re

import pytest

from siftwork.operators import reports
from siftwork.operators.annotate import ISSUES, annotate, annotate_all
from siftwork.operators.presets import RULES_DOCUMENT, preset_rules
from siftwork.operators.rules import MESSAGES, Rule, rules_from_document
from siftwork.operators.split import clean_rows, rejected_rows
from siftwork.sources import load_rules_document


def frame(spark, values, schema):
    return spark.createDataFrame([(v,) for v in values], schema)


TEXTS = ["Lisbon", None, "\t ", "", "0", " x "]
AMOUNTS = ["12", "0.49", "0.5", "-7e2", "ten", "NaN", None, "", " 3 ", "1e400"]
DAYS = ["2019-02-28", "2019-02-29", "28.02.2019", "2020-2-29", "", None, "2019-02-28x"]
MAILS = ["a@b.cd", "a@b", "@b.cd", "a b@c.de", "", None, " a@b.cd ", "a@b@c.de", "ü@ñ.pt"]


def _blank(text):
    return not (text or "").strip()


def _small(text):
    try:
        return not float(text) >= 0.5
    except (TypeError, ValueError):
        return True


def _no_day(text):
    match = re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", text or "")
    try:
        return text is not None and not (match and datetime.date(*map(int, match.groups())))
    except ValueError:
        return True


def _no_mail(text):
    return not _blank(text) and not re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s]+", text.strip())


@pytest.mark.parametrize(
    "name, severity, found, values, wrong, options",
    [
        ("required_column", "ERROR", reports.required_issues, TEXTS, _blank, []),
        ("numeric_min_value", "ERROR", reports.numeric_min_issues, AMOUNTS, _small, [0.5]),
        ("date_format", "ERROR", reports.date_issues, DAYS, _no_day, []),
        ("email_format", "WARNING", reports.email_issues, MAILS, _no_mail, []),
    ],
)
def test_rules_on_one_value(spark, stage, name, severity, found, values, wrong, options):
    df = spark.createDataFrame(list(enumerate(values)), "place int, v string")
    issues = found(df, "things", "v", *options, stage).collect()
    assert sorted(row.place for row in issues) == [i for i, v in enumerate(values) if wrong(v)]
    about = {(row.dataset_name, row.rule_name, row.column_name, row.severity) for row in issues}
    assert about == {("things", name, "v", severity)}
    wanted = MESSAGES[name].format(column="v", min_value=0.5)
    assert {row.message for row in issues} == {wanted}


def test_repeated_keys_against_a_count(spark, stage):
    keys = [k * k % 11 for k in range(9)] + [100]
    df = frame(spark, keys, "k bigint")
    found = sorted(row.k for row in reports.unique_issues(df, "t", "k", stage).collect())
    assert found == sorted(k for k in keys if keys.count(k) > 1)


@pytest.mark.parametrize("nulls, expected", [(1, 0), (2, 2), (3, 3)])
def test_missing_keys_repeat_each_other(spark, stage, nulls, expected):
    df = frame(spark, [1, 2] + [None] * nulls, "k bigint")
    assert reports.unique_issues(df, "t", "k", stage).count() == expected


def test_date_rule_has_nothing_to_say_about_dates(spark, stage):
    df = frame(spark, ["2023-08-01", None], "s string").selectExpr("cast(s as date) d")
    assert reports.date_issues(df, "orders", "d", stage).count() == 0


def test_numbers_that_are_nan(spark, stage):
    df = frame(spark, [float("nan"), 3.0, 1.0], "v double")
    assert reports.numeric_min_issues(df, "t", "v", 2, stage).count() == 2


def test_foreign_keys_against_a_set(spark, stage):
    used, known = [None, 14, 3, 14, 8, 21], [8, 8, None, 3]
    issues = reports.foreign_key_issues(
        frame(spark, used, "ref bigint"), frame(spark, known, "id bigint"), "uses", "ref", "id", "things", stage
    ).collect()
    wanted = [k for k in used if k is None or k not in known]
    assert sorted(row.ref or 0 for row in issues) == sorted(k or 0 for k in wanted)
    assert {row.message for row in issues} == {
        MESSAGES["foreign_key"].format(column="ref", reference_dataset="things", reference_column="id")
    }


def test_foreign_key_across_types(spark, stage):
    orders = frame(spark, [40, 41, 3], "customer_id bigint")
    customers = frame(spark, ["41", "x", "40"], "customer_id string")
    issues = reports.foreign_key_issues(
        orders, customers, "orders", "customer_id", "customer_id", "customers", stage
    )
    assert [row.customer_id for row in issues.collect()] == [3]


def test_text_keys(spark, stage):
    orders = frame(spark, ["n/4", "n/7", "q"], "customer_id string")
    customers = frame(spark, ["q", "n/7"], "customer_id string")
    issues = reports.foreign_key_issues(
        orders, customers, "orders", "customer_id", "customer_id", "customers", stage
    )
    assert [row.customer_id for row in issues.collect()] == ["n/4"]


def test_annotation_keeps_every_row_and_lists_issues_in_rule_order(spark, stage):
    df = spark.createDataFrame(
        [(1, "a", 5.0), (1, "", -1.0), (2, None, 3.0), (3, "x", None)], "id bigint, s string, n double"
    )
    rules = [
        Rule("required_column", "s"),
        Rule("unique_column", "id"),
        Rule("numeric_min_value", "n", severity="WARNING", min_value=0),
    ]
    annotated = annotate(df, rules, {}, stage)
    assert annotated.columns == ["id", "s", "n", ISSUES]
    found = sorted((row.id, row.s or "", tuple(row[ISSUES])) for row in annotated.collect())
    assert found == [(1, "", (0, 1, 2)), (1, "a", (1,)), (2, "", (0,)), (3, "x", (2,))]
    assert clean_rows(annotated, rules).count() == 0
    assert rejected_rows(annotated, rules).count() == 4
    assert [row.id for row in clean_rows(annotated, rules, ["ERROR"]).collect()] == [3]
    summary = reports.quality_summary({"t": annotated}, {"t": rules}).collect()
    assert [tuple(row) for row in summary] == [("t", 6, 4, 2)]


def test_dataset_without_rules_is_clean(spark, stage):
    df = frame(spark, [1, 1], "id bigint")
    annotated = annotate_all({"t": df}, {}, stage)["t"]
    assert clean_rows(annotated, []).count() == 2
    assert rejected_rows(annotated, []).columns == ["id"]
    assert rejected_rows(annotated, []).count() == 0
    report = reports.issue_report(annotated, "t", [])
    assert report.count() == 0
    assert report.columns == ["id", *reports.ISSUE_COLUMNS]
    assert [tuple(r) for r in reports.quality_summary({"t": annotated}, {}).collect()] == [("t", 0, 0, 0)]


def test_rules_for_an_unknown_dataset_are_an_error(spark, stage):
    with pytest.raises(KeyError):
        annotate_all({}, {"nowhere": [Rule("required_column", "x")]}, stage)


def test_rules_document_from_yaml(spark, tmp_path):
    path = tmp_path / "rules.yaml"
    path.write_text(
        """
t:
  foreign_keys:
    - {column: other, reference_dataset: u, reference_column: id, severity: WARNING}
  email_columns:
    - column: mail
  numeric_rules:
    - {column: n, min_value: 1.5}
  required_columns:
    - column: a
  date_columns:
u:
  unique_columns:
    - {column: id, severity: ERROR}
"""
    )
    rules = rules_from_document(load_rules_document(spark, str(path)))
    assert [(r.name, r.column, r.severity) for r in rules["t"]] == [
        ("required_column", "a", "ERROR"),
        ("email_format", "mail", "WARNING"),
        ("numeric_min_value", "n", "ERROR"),
        ("foreign_key", "other", "WARNING"),
    ]
    assert rules["t"][2].message == "Column 'n' must be numeric and >= 1.5."
    assert [r.name for r in rules["u"]] == ["unique_column"]


def test_rules_document_must_be_a_mapping(spark, tmp_path):
    path = tmp_path / "rules.yaml"
    path.write_text("- a\n- b\n")
    with pytest.raises(ValueError):
        load_rules_document(spark, str(path))


def test_preset_has_its_sections_and_twenty_rules():
    assert set(RULES_DOCUMENT) == {"customers", "products", "orders"}
    assert sum(len(rules) for rules in preset_rules().values()) == 20
    assert {"required_columns", "unique_columns", "date_columns", "email_columns"} == set(
        RULES_DOCUMENT["customers"]
    )


def test_union_of_reports_fills_missing_columns_with_null(spark, stage):
    left = reports.required_issues(frame(spark, [""], "a string"), "x", "a", stage)
    right = reports.required_issues(frame(spark, [None], "b string"), "y", "b", stage)
    both = reports.union_reports([left, right])
    assert both.columns == ["a", *reports.ISSUE_COLUMNS, "b"]
    assert both.count() == 2
