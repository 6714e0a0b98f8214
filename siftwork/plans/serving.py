"""Serving: typed tables of the clean rows and KPI views over them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.functions import to_key
from siftwork.operators.kpi import (
    category_sales_summary,
    customer_country_summary,
    daily_sales_kpi,
)
from siftwork.operators.kpi_views import category_sales_sql, customer_country_sql, daily_sales_sql
from siftwork.plans.stage import run_together
from siftwork.sources import write_table
from siftwork.sources.storage import Storage

# The serving tables and the types of their columns.
SERVING_TABLES: dict[str, dict[str, str]] = {
    "clean_customers": {
        "customer_id": "bigint",
        "full_name": "string",
        "email": "string",
        "country": "string",
        "registration_date": "date",
    },
    "clean_products": {
        "product_id": "bigint",
        "product_name": "string",
        "category": "string",
        "price": "double",
    },
    "clean_orders": {
        "order_id": "bigint",
        "customer_id": "bigint",
        "product_id": "bigint",
        "order_date": "date",
        "quantity": "double",
        "total_amount": "double",
        "currency": "string",
    },
}


def _whole_id(column: Column) -> Column:
    """The id as bigint; an error for one that is no whole number, which would get lost."""
    whole, text = to_key(column), column.cast("string")
    said = F.concat(F.lit("Not a whole number, so publish ids as text (text_keys): "), text)
    return F.when(whole.isNull() & text.isNotNull(), F.raise_error(said).cast("bigint")).otherwise(whole)


def serving_frame(df: DataFrame, table: str, text_keys: bool = False) -> DataFrame:
    """The columns of a serving table in their declared types; ``text_keys`` leaves ids text."""
    columns = []
    for name, kind in SERVING_TABLES[table].items():
        if not name.endswith("_id"):
            columns.append(F.col(name).try_cast(kind).alias(name))
        elif text_keys:
            columns.append(F.col(name).cast("string").alias(name))
        else:
            columns.append(_whole_id(F.col(name)).alias(name))
    return df.select(*columns)


def create_kpi_views(
    spark: SparkSession, tables: Mapping[str, DataFrame], orders_unique: bool = False
) -> None:
    """Define the KPI views for this session, over any tables."""
    orders = tables["clean_orders"]
    views = {
        "daily_sales_kpi": daily_sales_kpi(orders, orders_unique),
        "category_sales_summary": category_sales_summary(
            orders, tables["clean_products"], orders_unique
        ),
        "customer_country_summary": customer_country_summary(
            orders, tables["clean_customers"], orders_unique
        ),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def create_catalog_views(
    spark: SparkSession, database: str | None = None, orders_unique: bool = False
) -> list[str]:
    """Define the KPI views in the catalog, over the serving tables there; names of the views.

    Their text is SQL over qualified names, so every session on the catalog can read them.
    """
    database = database or spark.catalog.currentDatabase()
    orders, products, customers = (
        f"`{database}`.clean_{name}" for name in ("orders", "products", "customers")
    )
    views = {
        "daily_sales_kpi": daily_sales_sql(orders, orders_unique),
        "category_sales_summary": category_sales_sql(orders, products, orders_unique),
        "customer_country_summary": customer_country_sql(orders, customers, orders_unique),
    }
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.{name} AS {text}")
        # A view of this session would hide the one in the catalog.
        spark.catalog.dropTempView(name)
    return [f"{database}.{name}" for name in views]


def replace_catalog_table(df: DataFrame, table: str, database: str | None = None) -> str:
    """Write ``df`` as a new version of a catalog table and switch the table to it; its full name.

    The version is a folder of its own in the database's location. Until it is whole nothing
    changes; then the table is pointed to it by one change in the catalog. Readers that still scan
    the version before may finish: it stays until the next one is published. A session that has
    read the table before keeps its version until it refreshes the table. Only a table whose
    columns change is dropped and created, its files untouched.
    """
    spark = df.sparkSession
    storage = Storage(spark)
    database = database or spark.catalog.currentDatabase()
    name = f"`{database}`.{table}"
    folder = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    version = f"{table}__{uuid.uuid4().hex}"
    try:
        df.write.parquet(f"{folder}/{version}")
    except BaseException:
        storage.delete(f"{folder}/{version}")
        raise
    before = None
    if spark.catalog.tableExists(f"{database}.{table}"):
        described = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        before = described["Location"].rstrip("/").rpartition("/")[2]
        if spark.table(name).schema.simpleString() == df.schema.simpleString():
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}/{version}'")
        else:
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(f"{database}.{table}"):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{folder}/{version}'")
    for old in storage.names(folder):
        if old.startswith(f"{table}__") and old not in (version, before):
            storage.delete(f"{folder}/{old}")
    return name


def publish_serving(
    spark: SparkSession,
    clean: Mapping[str, DataFrame],
    *,
    folder: str | None = None,
    database: str | None = None,
    orders_unique: bool = False,
    text_keys: bool = False,
) -> dict[str, DataFrame]:
    """Replace the serving tables and define the KPI views over them.

    ``clean`` maps ``customers``, ``products`` and ``orders`` to their clean rows. Tables and views
    go to ``database`` or the current one of the catalog, or tables to Parquet below ``folder`` with views of
    this session on top. An old table stays readable until its successor is whole.
    """

    def publish(table: str) -> DataFrame:
        df = serving_frame(clean[table.removeprefix("clean_")], table, text_keys)
        if folder is None:
            name = replace_catalog_table(df, table, database)
            spark.catalog.dropTempView(table)
            return spark.table(name)
        uri = write_table(df, f"{folder.rstrip('/')}/{table}", "parquet")
        return spark.read.schema(df.schema).parquet(uri)

    published = run_together([lambda table=table: publish(table) for table in SERVING_TABLES])
    tables = dict(zip(SERVING_TABLES, published))
    if folder is None:
        create_catalog_views(spark, database, orders_unique)
        return tables
    for table, df in tables.items():
        df.createOrReplaceTempView(table)
    create_kpi_views(spark, tables, orders_unique)
    return tables
