"""Plans: what is scanned, what is broadcast, and what happens to hot keys."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from siftwork.operators import kpi, order_checks
from siftwork.operators.annotate import ISSUES, annotate
from siftwork.operators.rules import Rule
from siftwork.plans.orders import run_orders_job
from siftwork.plans.quality import run_quality_pipeline
from siftwork.plans.stage import Stage

RULES = [
    Rule("unique_column", "id"),
    Rule("foreign_key", "ref", reference_dataset="refs", reference_column="id"),
    Rule("numeric_min_value", "n", min_value=0),
]


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue()


@pytest.fixture()
def settings(spark):
    changed = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def skewed(spark, stage, rows=60_000):
    """A third of the rows share one id, a third one dangling reference, some ids are null."""
    df = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 11 != 0, F.col("id") + 1000)
        .alias("id"),
        F.when(F.col("id") % 3 == 1, -1).otherwise(F.col("id") % 500).alias("ref"),
        (F.col("id") % 100 - 1).cast("double").alias("n"),
        F.repeat(F.lit("x"), 40).alias("payload"),
    )
    refs = spark.range(400).select(F.col("id"))
    return stage.table(df, "facts"), stage.table(refs, "refs")


def expected_counts(df, refs):
    return (
        df.join(df.groupBy(F.col("id").alias("k")).count(), F.expr("id <=> k")).filter("count > 1").count(),
        df.join(refs.withColumnRenamed("id", "r"), F.expr("ref = r"), "left_anti").count(),
        df.filter("n < 0").count(),
    )


def issue_counts(annotated):
    row = annotated.agg(
        *[F.count_if(F.array_contains(ISSUES, i)).alias(str(i)) for i in range(3)],
        F.count(F.lit(1)).alias("rows"),
    ).first()
    return tuple(row)[:3], row["rows"]


def test_small_key_sets_are_broadcast_and_rows_stay_in_place(spark, stage):
    df, refs = skewed(spark, stage)
    annotated = annotate(df, RULES, {"refs": refs}, stage)
    text = plan(annotated)
    assert text.count("BroadcastHashJoin") == 2
    assert "hashpartitioning" not in text
    assert "SortMergeJoin" not in text
    counts, rows = issue_counts(annotated)
    assert rows == 60_000
    assert counts == expected_counts(df, refs)


def test_large_key_sets_are_joined_by_shuffle_and_hot_keys_are_split(spark, stage, settings):
    df, refs = skewed(spark, stage)
    expected = expected_counts(df, refs)
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="32KB",
        shuffle__partitions="16",
    )
    annotated = annotate(df, RULES, {"refs": refs}, Stage(spark))
    counts, rows = issue_counts(annotated)
    assert rows == 60_000
    assert counts == expected
    done = annotated.select("id", "payload", ISSUES)
    executed = done._jdf.queryExecution()
    done.collect()
    assert "skew=true" in executed.executedPlan().toString()


def test_key_sets_read_key_columns_only(spark, stage):
    df, refs = skewed(spark, stage)
    from siftwork.operators.keys import duplicate_keys, orphan_keys

    for keys in (duplicate_keys(df, "id"), orphan_keys(df, "ref", refs, "id")):
        text = plan(keys)
        assert "payload" not in text
        assert "partial_count" in text or text.count("HashAggregate") >= 2


def test_annotation_stays_in_generated_code(spark, stage):
    df, refs = skewed(spark, stage)
    annotated = annotate(df, RULES, {"refs": refs}, stage)
    annotated.collect()
    executed = annotated._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in executed.splitlines() if "concat(" in line]
    assert any(line.lstrip(" +-:").startswith("*(") for line in steps)
    assert "python" not in executed.lower()


def test_orders_are_added_up_before_they_meet_the_dimension(spark):
    orders = spark.range(10).selectExpr(
        "id order_id", "id customer_id", "id product_id", "'d' order_date",
        "1.0D quantity", "2.0D total_amount",
    )
    products = spark.range(10).selectExpr("id product_id", "'c' category")
    customers = spark.range(10).selectExpr("id customer_id", "'c' country")
    for df in (
        kpi.category_sales_summary(orders, products, orders_unique=True),
        kpi.customer_country_summary(orders, customers, orders_unique=True),
    ):
        text = plan(df)
        join = text.index("Join")
        assert "partial_try_sum" in text[join:]
        assert "Expand" not in text


def test_rejected_orders_keep_one_row_per_id_and_reason(spark, stage):
    """Brute force over copies: a third of the orders are copies of one row, some have no id."""
    rows = [("1", "9", "9", "bad", "0", "1", "x")] * 30
    rows += [(None, "1", "9", "2023-01-01", "0", str(i % 3), "x") for i in range(10)]
    rows += [(str(i), "1", "1", "2023-01-01", str(i % 2), "-1", "x") for i in range(100, 150)]
    names = ["order_id", "customer_id", "product_id", "order_date", "quantity", "total_amount", "currency"]
    orders = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    keys = {
        "customers": spark.createDataFrame([("1",)], "customer_id string"),
        "products": spark.createDataFrame([("1",)], "product_id string"),
    }
    checked = order_checks.check_orders(
        {"orders": order_checks.typed(orders, "orders"), **keys}, stage
    )
    checked = checked.select(*names, ISSUES)
    got = sorted(str(tuple(row)) for row in order_checks.rejected_orders(checked).collect())

    kept = {}
    for row in rows:
        reasons = ["invalid_quantity"] if float(row[4]) < 1 else []
        reasons += ["invalid_total_amount"] if float(row[5]) < 0 else []
        reasons += ["invalid_order_date"] if row[3] == "bad" else []
        reasons += ["invalid_customer_fk"] if row[1] != "1" else []
        reasons += ["invalid_product_fk"] if row[2] != "1" else []
        same = sum(r[0] == row[0] for r in rows) if row[0] is not None else 1
        reasons += ["duplicate_order_id"] if same > 1 else []
        for reason in reasons:
            kept[row[0], reason] = min(kept.get((row[0], reason), row), row, key=str)
    assert got == sorted(str((*row, reason)) for (_, reason), row in kept.items())
    assert order_checks.clean_orders(checked).count() == sum(
        1 for row in rows if not any(k[0] == row[0] for k in kept)
    )


def recorded(monkeypatch):
    """Names and columns of the tables that get staged."""
    staged = []
    table = Stage.table

    def record(self, df, name, *args, **kwargs):
        staged.append((name, df.columns))
        return table(self, df, name, *args, **kwargs)

    monkeypatch.setattr(Stage, "table", record)
    return staged


def order_tables(spark, rows=4000):
    orders = spark.range(rows).selectExpr(
        "cast(if(id % 3 = 0, 7, id) as string) AS order_id", "cast(id % 50 as string) AS customer_id",
        "cast(id % 30 as string) AS product_id", "'2024-01-02' AS order_date", "cast(id % 5 as string) AS quantity",
        "'1.5' AS total_amount", "'eur' AS currency", "repeat('x', 50) AS payload",
    )
    customers = spark.range(45).selectExpr(
        "cast(id as string) AS customer_id", "'n' AS full_name", "'a@b.c' AS email", "'pt' AS country", "'2024-01-01' AS registration_date"
    )
    products = spark.range(30).selectExpr("cast(id as string) AS product_id", "'p' AS product_name", "'c' AS category", "'1' AS price")
    return {"orders": orders, "customers": customers, "products": products}


def test_whole_orders_are_written_once(spark, tmp_path, monkeypatch):
    staged = recorded(monkeypatch)
    run = run_orders_job(spark, order_tables(spark), str(tmp_path / "out"))
    # Of the staged tables, only those of rejected rows hold whole orders.
    assert [name for name, columns in staged if "payload" in columns] == ["faulty_orders", "rejected"]
    assert run.row_counts["orders"]["clean"] > 0


@pytest.mark.parametrize("job", ["orders", "quality"])
def test_shuffled_rows_are_annotated_once(spark, tmp_path, monkeypatch, settings, job):
    tables = order_tables(spark)
    run_job = run_orders_job if job == "orders" else run_quality_pipeline
    expected = run_job(spark, tables, str(tmp_path / "a")).row_counts
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    staged, written = recorded(monkeypatch), []
    write = DataFrameWriter.save

    def record(self, path=None, *args, **kwargs):
        written.append((path.rpartition("_")[2], plan(self._df)))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "save", record)
    assert run_job(spark, tables, str(tmp_path / "b")).row_counts == expected
    assert [name for name, columns in staged if "payload" in columns and name.startswith("marked")] == ["marked_orders"]
    # The outputs with whole rows read both halves from there and join nothing.
    halves = [text for name, text in written if name == "orders"]
    assert len(halves) == 2 and not any("Join" in text for text in halves)


def test_a_hot_product_is_one_row_per_task_without_unique_ids(spark):
    orders = spark.range(9000).selectExpr(
        "id AS order_id", "if(id % 3 = 0, 1, id) AS product_id", "1.0D AS quantity", "2.0D AS total_amount"
    )
    products = spark.range(9000).selectExpr("id AS product_id", "'c' AS category")
    text = plan(kpi.category_sales_summary(orders, products))
    for part in text.split("Join")[1:]:
        # What meets the dimension has been added up or made distinct before.
        assert "HashAggregate" in part
    assert "Expand" not in text
