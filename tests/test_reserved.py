"""Names, severities and keys that an earlier version got wrong."""

from __future__ import annotations

import pytest

from siftwork.operators.annotate import annotate
from siftwork.operators.normalize import normalize
from siftwork.operators.rules import DATE, NUMERIC, RESERVED, UNIQUE, Rule
from siftwork.operators.split import clean_rows, rejected_rows
from siftwork.sources import load_rules_document


@pytest.mark.parametrize("name", ["memo__text", "issues", "row_count", "known_key", "d__text"])
def test_a_column_of_any_other_name_passes(spark, stage, name):
    df = spark.createDataFrame([("a", "2024-02-03", "x"), ("a", "?", "y")], f"k string, d string, {name} string")
    rules = [Rule(UNIQUE, "k"), Rule(DATE, "d")]
    annotated = annotate(df, rules, {}, stage)
    rows = rejected_rows(annotated, rules).collect()
    assert sorted(row[name] for row in rows) == ["x", "y"]
    only_date = [Rule(DATE, "d")]
    kept = clean_rows(annotate(df, only_date, {}, stage), only_date).collect()
    assert [row[name] for row in kept] == ["x"]


def test_reserved_names_are_an_error(spark, stage):
    df = spark.createDataFrame([("a", "b")], f"k string, {RESERVED}issues string")
    with pytest.raises(ValueError, match="reserved"):
        annotate(df, [Rule(UNIQUE, "k")], {}, stage)
    products = spark.createDataFrame([("1", "a", "b", "2", "c")], f"product_id string, product_name string, category string, price string, {RESERVED}text_x string")
    with pytest.raises(ValueError, match="reserved"):
        normalize(products, "products")


def test_any_severity_rejects_unless_some_are_named(spark, stage):
    df = spark.createDataFrame([(1, -5.0), (2, 7.0)], "k int, v double")
    rules = [Rule(NUMERIC, "v", severity="CRITICAL", min_value=0)]
    annotated = annotate(df, rules, {}, stage)
    assert [row.k for row in rejected_rows(annotated, rules).collect()] == [1]
    assert [row.k for row in clean_rows(annotated, rules).collect()] == [2]
    assert clean_rows(annotated, rules, reject_on=("ERROR",)).count() == 2


@pytest.mark.parametrize("repeats, rejected", [(True, [None, None, 4, 4]), (False, [4, 4])])
def test_missing_keys_repeat_each_other_only_if_asked(spark, stage, repeats, rejected):
    df = spark.createDataFrame([(None,), (None,), (4,), (4,), (5,)], "k int")
    rules = [Rule(UNIQUE, "k", missing_repeats=repeats)]
    rows = rejected_rows(annotate(df, rules, {}, stage), rules).collect()
    assert sorted((row.k for row in rows), key=str) == sorted(rejected, key=str)


def test_several_rules_documents_are_an_error(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / f"{name}.yaml").write_text("orders: {}")
    with pytest.raises(ValueError, match="Several"):
        load_rules_document(spark, str(tmp_path))
    assert load_rules_document(spark, str(tmp_path / "one.yaml")) == {"orders": {}}
