"""The jobs on the sample tables, against what plain Python makes of them."""

from __future__ import annotations

import datetime
import pathlib
from collections import Counter

import pytest
import samples
from pyspark.errors import PySparkException

from siftwork.__main__ import main
from siftwork.operators.normalize import normalize_all
from siftwork.plans.orders import run_orders_job
from siftwork.plans.quality import run_quality_pipeline
from siftwork.plans.serving import publish_serving
from siftwork.plans.stage import Stage
from siftwork.sources import load_datasets, scan_csv, scan_zone


FAILURES = PySparkException


def ids(spark, uri, column):
    return sorted(row[0] for row in scan_csv(spark, uri).select(column).collect())


def sample_ids(rows, column):
    return sorted(row[column] for row in rows)


def rules_hit(df):
    rows = df.groupBy("rule_name", "column_name").count().collect()
    return {(row.rule_name, row.column_name): row["count"] for row in rows}


KEYS = {"customers": "customer_id", "products": "product_id", "orders": "order_id"}


@pytest.mark.parametrize("date_text, errors_only", [(False, False), (True, False), (False, True)])
def test_quality_job(spark, sample_inputs, tmp_path, date_text, errors_only):
    output = str(tmp_path / "out")
    run = run_quality_pipeline(
        spark,
        sample_inputs,
        output,
        check_date_text=date_text,
        reject_on=("ERROR",) if errors_only else None,
    )
    names = [f"{kind}_{n}" for kind in ("clean", "rejected") for n in KEYS]
    names += [f"{n}_validation_report" for n in (*KEYS, "all_issues")]
    assert set(run.outputs) == {*names, "quality_summary"}
    for uri in run.outputs.values():
        assert pathlib.Path(uri, "_SUCCESS").exists()

    summary = {}
    for name, key in KEYS.items():
        clean, rejected = samples.split(name, errors_only, date_text)
        assert clean and rejected
        assert ids(spark, run.outputs[f"clean_{name}"], key) == sample_ids(clean, key)
        assert ids(spark, run.outputs[f"rejected_{name}"], key) == sample_ids(rejected, key)
        assert run.row_counts[name] == {"clean": len(clean), "rejected": len(rejected)}
        hits = samples.rule_counts(name, date_text)
        # A tolerated issue is still reported.
        assert rules_hit(scan_csv(spark, run.outputs[f"{name}_validation_report"])) == hits
        warnings = sum(n for (rule, _), n in hits.items() if rule == "email_format")
        summary[name] = (str(hits.total()), str(hits.total() - warnings), str(warnings))
        assert scan_csv(spark, run.outputs[f"clean_{name}"]).columns == samples.COLUMNS[name]
    written = scan_zone(spark, output, "reports", "quality_summary")
    assert written.columns == ["dataset_name", "issue_count", "error_count", "warning_count"]
    assert {row[0]: tuple(row)[1:] for row in written.collect()} == summary
    issues = scan_csv(spark, run.outputs["all_issues_validation_report"])
    assert issues.count() == sum(int(counts[0]) for counts in summary.values())
    about = ["dataset_name", "rule_name", "column_name", "severity", "message"]
    first = [*samples.COLUMNS["customers"], *about, *samples.COLUMNS["products"], *samples.COLUMNS["orders"]]
    assert issues.columns == list(dict.fromkeys(first))


def test_clean_rows_are_tidied(spark, sample_inputs, tmp_path):
    run = run_quality_pipeline(spark, sample_inputs, str(tmp_path / "out"))
    customers = {tuple(row) for row in scan_csv(spark, run.outputs["clean_customers"]).collect()}
    assert customers == {
        (
            row["customer_id"],
            row["full_name"].strip(),
            row["email"].lower(),
            row["country"].upper(),
            str(day) if (day := samples.day(row["registration_date"])) else None,
        )
        for row in samples.split("customers")[0]
    }
    categories = {row.category for row in scan_csv(spark, run.outputs["clean_products"]).collect()}
    assert categories == {"Garden Tools", "Books"}


ORDERS = "order_id string, customer_id string, product_id string, order_date string, quantity string, total_amount string, currency string"
CUSTOMERS = "customer_id string, full_name string, email string, country string, registration_date string"
PRODUCTS = "product_id string, product_name string, category string, price string"


@pytest.mark.parametrize("text_keys", [False, True])
def test_ids_that_are_no_numbers(spark, tmp_path, text_keys):
    orders = [
        ("uuid-b", "n/1", "0012", "2021-06-01", "2", "8", "eur"),
        ("uuid-a", "5.0", "0012", "2021-06-01", "1", "4", "eur"),
        ("3.0", "elsewhere", "12.5", None, "1", "4", "eur"),
    ]
    customers = [("n/1", "Noor", "n@o.or", "pt", "2020-01-01"), ("5", "Vic", None, "se", None)]
    inputs = {
        "customers": spark.createDataFrame(customers, CUSTOMERS),
        "products": spark.createDataFrame([("0012", "Rake", "garden", "9")], PRODUCTS),
        "orders": spark.createDataFrame(orders, ORDERS),
    }
    run = run_quality_pipeline(spark, inputs, str(tmp_path / "out"), text_keys=text_keys, fmt="parquet")
    clean = {name: spark.read.parquet(run.outputs[f"clean_{name}"]) for name in KEYS}
    found = sorted((row.order_id, row.customer_id) for row in clean["orders"].collect())
    # As text, 5.0 and 5 are two customers.
    assert found == ([("uuid-b", "n/1")] if text_keys else [("uuid-a", "5"), ("uuid-b", "n/1")])
    report = spark.read.parquet(run.outputs["orders_validation_report"])
    assert set(rules_hit(report)) == {("foreign_key", "customer_id"), ("foreign_key", "product_id")}
    rejected = spark.read.parquet(run.outputs["rejected_orders"]).collect()
    whole = {(row.order_id, row.customer_id, row.product_id) for row in rejected}
    assert ("3.0" if text_keys else "3", "elsewhere", "12.5") in whole

    with pytest.raises(FAILURES, match="publish ids as text"):
        publish_serving(spark, clean, folder=str(tmp_path / "numbers"))
    publish_serving(spark, clean, folder=str(tmp_path / "serving"), text_keys=True)
    rows = {tuple(row) for row in spark.sql("SELECT * FROM customer_country_summary").collect()}
    assert rows == ({("PT", 1, 1, 8.0)} if text_keys else {("PT", 1, 1, 8.0), ("SE", 1, 1, 4.0)})


def test_a_failing_scan_fails_the_job(spark, sample_inputs, tmp_path):
    broken = tmp_path / "orders.csv"
    broken.write_text("order_id,customer_id\n1,2\n")
    with pytest.raises(ValueError, match="lacks"):
        run_quality_pipeline(spark, {**sample_inputs, "orders": str(broken)}, str(tmp_path / "out"))


def test_orders_job(spark, sample_inputs, tmp_path):
    run = run_orders_job(spark, sample_inputs, str(tmp_path / "out"), fmt="parquet")
    results = {name: spark.read.parquet(uri) for name, uri in run.outputs.items()}
    reasons = {(row["order_id"], why) for row in samples.TABLES["orders"] for why in samples.order_reasons(row)}
    passed = [row for row in samples.TABLES["orders"] if not samples.order_reasons(row)]
    clean = results["spark_clean_orders"]
    assert sorted(row.order_id for row in clean.collect()) == sample_ids(passed, "order_id")
    assert clean.columns[: len(samples.COLUMNS["orders"])] == samples.COLUMNS["orders"]
    assert len(clean.columns) == len(samples.COLUMNS["orders"]) + 6
    rejected = results["spark_rejected_orders"]
    assert rejected.columns[-1] == "rejection_reason"
    assert Counter((r.order_id, r.rejection_reason) for r in rejected.collect()) == Counter(reasons)
    assert run.row_counts == {"orders": {"clean": len(passed), "rejected": len(reasons)}}

    daily = samples.sales((samples.day(row["order_date"]), row) for row in passed)
    assert {tuple(row) for row in results["spark_daily_sales_kpi"].collect()} == {
        (day, *totals) for day, totals in daily.items()
    }
    # Products as scanned: a repeated one counts its orders again.
    by_category = samples.sales(
        (product["category"], row)
        for row in passed
        for product in samples.TABLES["products"]
        if product["product_id"] == row["product_id"]
    )
    assert {tuple(row) for row in results["spark_category_sales_summary"].collect()} == {
        (category, *totals) for category, totals in by_category.items()
    }
    counts = Counter(why for _, why in reasons)
    assert len(counts) == 6
    assert {tuple(row) for row in results["spark_rejection_reason_summary"].collect()} == set(counts.items())


@pytest.mark.parametrize("orders_unique", [False, True])
@pytest.mark.parametrize("in_catalog", [False, True])
def test_serving_tables_and_views(spark, sample_inputs, tmp_path, orders_unique, in_catalog):
    run = run_quality_pipeline(spark, sample_inputs, str(tmp_path / "out"))
    clean = {name: scan_csv(spark, run.outputs[f"clean_{name}"]) for name in sample_inputs}
    publish_serving(
        spark,
        clean,
        folder=None if in_catalog else str(tmp_path / "serving"),
        orders_unique=orders_unique,
        text_keys=True,
    )
    assert dict(spark.table("clean_orders").dtypes)["order_date"] == "date"
    assert dict(spark.table("clean_orders").dtypes)["order_id"] == "string"
    kept = {name: samples.split(name)[0] for name in KEYS}
    days = samples.sales((samples.day(row["order_date"]), row) for row in kept["orders"])
    found = [tuple(row) for row in spark.sql("SELECT * FROM daily_sales_kpi").collect()]
    first = datetime.date.min
    assert found == [(day, *days[day]) for day in sorted(days, key=lambda day: day or first)]

    categories = {row["product_id"]: row["category"].title() for row in kept["products"]}
    by_category = samples.sales(
        (categories[row["product_id"]], row) for row in kept["orders"] if row["product_id"] in categories
    )
    found = [tuple(row) for row in spark.sql("SELECT * FROM category_sales_summary").collect()]
    assert sorted(found) == sorted((name, *totals) for name, totals in by_category.items())
    assert [row[3] for row in found] == sorted((row[3] for row in found), reverse=True)

    countries = {row["customer_id"]: row["country"].upper() for row in kept["customers"]}
    placed = [(countries[row["customer_id"]], row) for row in kept["orders"] if row["customer_id"] in countries]
    by_country = {
        (name, n, len({row["customer_id"] for place, row in placed if place == name}), revenue)
        for name, (n, _, revenue) in samples.sales(placed).items()
    }
    found = spark.sql("SELECT * FROM customer_country_summary").collect()
    assert {tuple(row) for row in found} == by_country
    for table in ("clean_customers", "clean_products", "clean_orders"):
        if in_catalog:
            spark.sql(f"DROP TABLE {table}")
        else:
            spark.catalog.dropTempView(table)


def test_stage_uses_the_shared_folder_and_cleans_up(spark):
    stage = Stage(spark)
    assert stage.uri.startswith(spark.conf.get("spark.checkpoint.dir"))
    stage.table(spark.range(3), "numbers")
    assert pathlib.Path(stage.uri).exists()
    stage.drop()
    assert not pathlib.Path(stage.uri).exists()


def test_jobs_leave_no_staged_tables(spark, sample_inputs, tmp_path):
    folder = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    run_orders_job(spark, sample_inputs, str(tmp_path / "out"))
    assert set(folder.iterdir()) == before


def test_normalised_types(spark, sample_folder):
    tables = normalize_all(load_datasets(spark, sample_folder))
    assert dict(tables["orders"].dtypes) == {
        "order_id": "string",
        "customer_id": "string",
        "product_id": "string",
        "order_date": "date",
        "quantity": "double",
        "total_amount": "double",
        "currency": "string",
    }
    assert {row.currency for row in tables["orders"].collect()} == {"EUR"}


def test_command_line(spark, sample_folder, tmp_path, capsys):
    output = str(tmp_path / "out")
    rules = tmp_path / "rules.yaml"
    rules.write_text(
        "orders:\n  foreign_keys:\n    - {column: customer_id, reference_dataset: customers, "
        "reference_column: customer_id}\n"
    )
    orders = samples.TABLES["orders"]
    orphans = sum(("foreign_key", "customer_id") in samples.broken_rules("orders", row) for row in orders)
    main(["quality", sample_folder, output, "--rules", str(rules)])
    assert f"orders: {len(orders) - orphans} clean, {orphans} rejected" in capsys.readouterr().out
    main(["orders", sample_folder, output])
    passed = sum(not samples.order_reasons(row) for row in orders)
    assert f"orders: {passed} clean" in capsys.readouterr().out

    options = ["--format", "parquet", "--check-date-text", "--text-keys", "--reject-on", "ERROR"]
    main(["quality", sample_folder, output, *options])
    clean, rejected = samples.split("customers", errors_only=True, date_text=True)
    assert f"customers: {len(clean)} clean, {len(rejected)} rejected" in capsys.readouterr().out
    main(["quality", sample_folder, output, "--date-format", "dd/MM/yy", *options])
    unread = [row for row in samples.TABLES["orders"]]
    assert f"orders: 0 clean, {len(unread)} rejected" in capsys.readouterr().out
    main(["quality", sample_folder, output, *options])
    main(["serving", output, "--format", "parquet", "--text-keys"])
    assert spark.table("clean_customers").count() == len(clean)
    for table in ("clean_customers", "clean_products", "clean_orders"):
        spark.sql(f"DROP TABLE {table}")
