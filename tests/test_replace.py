"""Tables that are replaced, zones with several kinds of files, views of a catalog, voted dates."""

from __future__ import annotations

import pathlib

import pytest
import samples
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siftwork.functions import vote_date_formats
from siftwork.operators import kpi, kpi_views
from siftwork.operators.normalize import normalize, voted_formats
from siftwork.plans.quality import run_quality_pipeline
from siftwork.plans.serving import publish_serving, replace_catalog_table
from siftwork.sources import (
    list_zone,
    publish_to_zone,
    read_table,
    restore_table,
    scan_csv,
    scan_zone,
    scan_zone_by_header,
    scan_zone_tables,
    sinks,
    write_table,
)


def failing(spark, ok=3):
    """Rows of which a late one ends the job."""
    said = F.raise_error(F.lit("no more rows")).cast("bigint")
    return spark.range(0, 50, 1, 5).select(F.when(F.col("id") < 40 + ok, F.col("id")).otherwise(said).alias("id"))


def numbers(df):
    return sorted(int(row[0]) for row in df.collect())


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_failed_write_leaves_the_old_table(spark, tmp_path, fmt):
    uri = str(tmp_path / "zone" / "table")
    schema = spark.range(1).schema
    write_table(spark.range(3), uri, fmt)
    with pytest.raises(PySparkException, match="no more rows"):
        write_table(failing(spark), uri, fmt)
    assert numbers(read_table(spark, uri, schema, fmt)) == [0, 1, 2]
    write_table(spark.range(5), uri, fmt)
    assert numbers(read_table(spark, uri, schema, fmt)) == [0, 1, 2, 3, 4]
    # A table may be made from itself.
    write_table(read_table(spark, uri, schema, fmt).filter("id > 2"), uri, fmt)
    assert numbers(read_table(spark, uri, schema, fmt)) == [3, 4]
    assert [p.name for p in (tmp_path / "zone").iterdir()] == ["table"]


def test_a_switch_that_fails_or_stops_half_way(spark, tmp_path, monkeypatch):
    uri = str(tmp_path / "table")
    write_table(spark.range(2), uri, "parquet")
    rename = sinks.Storage.rename

    def refuses(self, source, target):
        if target == uri and not source.endswith("_replaced"):
            raise OSError("refused")
        rename(self, source, target)

    monkeypatch.setattr(sinks.Storage, "rename", refuses)
    with pytest.raises(OSError, match="refused"):
        write_table(spark.range(9), uri, "parquet")
    assert spark.read.parquet(uri).count() == 2
    monkeypatch.undo()
    assert [p.name for p in tmp_path.iterdir()] == ["table"]

    # As a job leaves it that died between the two moves.
    (tmp_path / "table").rename(tmp_path / "_siftwork_0a_table_replaced")
    assert restore_table(spark, uri) and not restore_table(spark, uri)
    assert spark.read.parquet(uri).count() == 2


def test_a_written_table_is_read_in_its_types(spark, tmp_path):
    rows = [("", 1.5, "a\nb"), (None, None, ' "q" '), ("x", float("inf"), "\\")]
    df = spark.createDataFrame(rows, "s string, d double, t string")
    got = read_table(spark, write_table(df, str(tmp_path / "t")), df.schema)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))


def test_zone_with_several_kinds_of_files(spark, sample_inputs, tmp_path):
    root = str(tmp_path / "out")
    run_quality_pipeline(spark, sample_inputs, root)
    tables = scan_zone_tables(spark, root, "processed")
    assert set(tables) == {f"clean_{name}" for name in samples.COLUMNS}
    for name, columns in samples.COLUMNS.items():
        assert tables[f"clean_{name}"].columns == columns
        assert tables[f"clean_{name}"].count() == len(samples.split(name)[0])
    with pytest.raises(ValueError, match="different headers"):
        scan_zone(spark, root, "processed")

    # Loose files beside folders, one of them empty, and a table of the same header.
    zone = pathlib.Path(root, "raw")
    zone.mkdir()
    (zone / "plain.csv").write_text("a,b\n1,2\n3,4\n")
    (zone / "void.csv").write_text("")
    (zone / "notes.txt").write_text("no table\n")
    (zone / "deep").mkdir()
    (zone / "deep" / "more.csv").write_text("a,b\n5,6\n")
    publish_to_zone(spark.range(40).select(F.col("id").alias("n")).repartition(3), root, "raw", "numbers")
    found = {t.name: t.columns for t in list_zone(spark, root, "raw")}
    assert found == {"plain": ("a", "b"), "deep/more": ("a", "b"), "numbers": ("n",)}
    by_header = scan_zone_by_header(spark, root, "raw")
    assert {columns: df.count() for columns, df in by_header.items()} == {("a", "b"): 3, ("n",): 40}
    assert scan_zone_tables(spark, root, "raw")["deep/more"].collect()[0].a == "5"
    assert list_zone(spark, root, "rejected", "*.none") == []
    for nothing in (tmp_path / "nowhere", root):
        with pytest.raises(FileNotFoundError):
            scan_zone(spark, str(nothing), "rejected", pattern="*.none")


@pytest.fixture()
def database(spark, tmp_path):
    name = f"serving_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / 'db'}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_catalog_tables_are_switched_as_a_whole(spark, database):
    table = f"{database}.facts"
    replace_catalog_table(spark.range(3), "facts", database)
    with pytest.raises(PySparkException, match="no more rows"):
        replace_catalog_table(failing(spark), "facts", database)
    assert spark.table(table).count() == 3
    reading = spark.table(table)
    replace_catalog_table(spark.range(7), "facts", database)
    # Who began to read before still finds its files.
    assert reading.count() == 3 and spark.table(table).count() == 7
    replace_catalog_table(spark.range(8), "facts", database)
    folder = pathlib.Path(spark.catalog.getDatabase(database).locationUri.removeprefix("file:"))
    assert len([p for p in folder.iterdir() if p.name.startswith("facts__")]) == 2
    replace_catalog_table(spark.range(2).selectExpr("cast(id as string) AS id"), "facts", database)
    assert dict(spark.table(table).dtypes) == {"id": "string"} and spark.table(table).count() == 2


VIEWS = ("daily_sales_kpi", "category_sales_summary", "customer_country_summary")


@pytest.mark.parametrize("unique", [False, True])
def test_views_outlive_the_session(spark, sample_inputs, tmp_path, database, unique):
    run = run_quality_pipeline(spark, sample_inputs, str(tmp_path / "out"))
    clean = {name: scan_csv(spark, run.outputs[f"clean_{name}"]) for name in sample_inputs}
    tables = publish_serving(spark, clean, database=database, orders_unique=unique, text_keys=True)
    expected = {
        "daily_sales_kpi": kpi.daily_sales_kpi(tables["clean_orders"]),
        "category_sales_summary": kpi.category_sales_summary(tables["clean_orders"], tables["clean_products"]),
        "customer_country_summary": kpi.customer_country_summary(tables["clean_orders"], tables["clean_customers"]),
    }
    other = spark.newSession()
    for view in VIEWS:
        got = other.sql(f"SELECT * FROM {database}.{view}")
        assert got.collect() == expected[view].collect() and got.count() > 0
        assert [kind for _, kind in got.dtypes] == [kind for _, kind in expected[view].dtypes]
    # The views follow the tables; a session that has read them keeps its version until it refreshes.
    publish_serving(spark, {**clean, "orders": clean["orders"].limit(0)}, database=database, text_keys=True)
    assert other.table(f"{database}.daily_sales_kpi").count() > 0
    other.catalog.refreshTable(f"{database}.clean_orders")
    for session in (other, spark.newSession()):
        assert all(session.table(f"{database}.{view}").count() == 0 for view in VIEWS)


def dirty_orders(spark):
    """Repeated ids, ids with several keys, missing ids and keys, inexact and infinite amounts."""
    rows = [(str(i % 37), str(i % 5), str(i % 7), "d", float(i % 4), i * 0.1 if i % 9 else 1e300) for i in range(400)]
    rows += [(None, "1", "1", "d", 1.0, 2.0), ("a", None, None, "e", None, None), ("a", "9", "9", None, 1.0, None)]
    rows += [("u", "1", "3", "d", 1.0, float("inf"))] * 3
    return spark.createDataFrame(
        rows, "order_id string, customer_id string, product_id string, order_date string, quantity double, total_amount double"
    )


def test_kpis_without_unique_ids_against_plain_joins(spark):
    orders = dirty_orders(spark)
    products = spark.createDataFrame(
        [("1", "x"), ("2", "x"), ("3", "y"), ("3", "z"), ("3", "z"), ("4", None), ("9", "w")], "product_id string, category string"
    )
    customers = products.toDF("customer_id", "country")
    plain = {}
    for key, place, dimension in (("product_id", "category", products), ("customer_id", "country", customers)):
        joined = orders.join(dimension, key).groupBy(place).agg(
            F.count_distinct("order_id").alias("order_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum("quantity").alias("total_quantity"),
            F.sum("total_amount").alias("total_revenue"),
        )
        plain[place] = {row[place]: row for row in joined.collect()}
    for name, df, texts in (
        ("category", kpi.category_sales_summary(orders, products), kpi_views.category_sales_sql("o", "p")),
        ("country", kpi.customer_country_summary(orders, customers), kpi_views.customer_country_sql("o", "c")),
    ):
        orders.createOrReplaceTempView("o")
        products.createOrReplaceTempView("p")
        customers.createOrReplaceTempView("c")
        for got in (df.collect(), spark.sql(texts).collect()):
            assert len(got) == len(plain[name])
            for row in got:
                expected = plain[name][row[name]]
                for column in row.asDict():
                    same = expected[column]
                    if column.startswith("total") and same is not None:
                        same = pytest.approx(same, rel=1e-12)
                    assert row[column] == same, (name, column)
    for view in "opc":
        spark.catalog.dropTempView(view)


def test_columns_vote_for_their_date_form(spark):
    rows = [("31/12/2020", "12/31/2020", "2020-1-5", "03.04.2020", None)] + [("01/02/2021", "01/02/2021", "x", "", None)] * 5
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string")
    assert vote_date_formats(df, df.columns) == {
        "a": ("d/M/yyyy",), "b": ("M/d/yyyy",), "c": ("yyyy-M-d",), "d": ("d.M.yyyy",), "e": ("yyyy-M-d",)
    }
    assert vote_date_formats(df, []) == {} and vote_date_formats(df.limit(0), ["a"]) == {"a": ("yyyy-M-d",)}


def test_the_job_with_voted_dates(spark, sample_inputs, tmp_path):
    orders = scan_csv(spark, sample_inputs["orders"])
    turned = F.date_format(F.try_to_date("order_date", "yyyy-MM-dd"), "dd.MM.yyyy")
    turned = orders.withColumn("order_date", F.coalesce(turned, "order_date"))
    expected = normalize(orders, "orders").collect()
    assert normalize(turned, "orders", date_formats=voted_formats(turned, "orders")).collect() == expected
    plain = run_quality_pipeline(spark, sample_inputs, str(tmp_path / "a"), check_date_text=True)
    voted = run_quality_pipeline(
        spark, {**sample_inputs, "orders": turned}, str(tmp_path / "b"), check_date_text=True, date_formats="vote"
    )
    assert voted.row_counts == plain.row_counts
