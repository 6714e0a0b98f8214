"""Dirty customers, products and orders, derived from the clean test tables.

Every table states its defects by key, so each engine can derive the same rows. The Spark
text repeats rows in one scan; the oracle text does it with a union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CUSTOMER_BASE = """
  SELECT c_custkey AS k,
    CASE WHEN c_custkey % 73 = 11 THEN concat('C-', CAST(c_custkey AS STRING))
         ELSE CAST(c_custkey AS STRING) END AS customer_id,
    CASE WHEN c_custkey % 50 = 7 THEN NULL WHEN c_custkey % 50 = 8 THEN '   '
         ELSE concat('  ', c_name, ' ') END AS full_name,
    CASE WHEN c_custkey % 40 = 1 THEN concat('User', CAST(c_custkey AS STRING), '@mail')
         WHEN c_custkey % 40 = 2 THEN NULL
         ELSE concat('User', CAST(c_custkey AS STRING), '@Mail.com') END AS email,
    CASE WHEN c_custkey % 60 = 5 THEN NULL ELSE lower(n_name) END AS country,
    CASE WHEN c_custkey % 30 = 9 THEN 'not a day'
         ELSE CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INT) AS STRING)
         END AS registration_date
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""

PRODUCT_BASE = """
  SELECT p_partkey AS k,
    CAST(p_partkey AS STRING) AS product_id,
    p_name AS product_name,
    CASE WHEN p_partkey % 45 = 4 THEN NULL ELSE lower(p_type) END AS category,
    CASE WHEN p_partkey % 33 = 6 THEN '-12.75' WHEN p_partkey % 33 = 7 THEN NULL
         WHEN p_partkey % 33 = 8 THEN 'n.a'
         ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) END AS price
  FROM {part}"""

ORDER_BASE = """
  SELECT o_orderkey AS k,
    CASE WHEN o_orderkey % 211 = 10 THEN NULL
         WHEN o_orderkey % 67 = 13 THEN concat('web/', CAST(o_orderkey AS STRING)) ELSE CAST(o_orderkey AS STRING) END AS order_id,
    CASE WHEN o_orderkey % 41 = 0 THEN '99999999' WHEN o_orderkey % 83 = 5 THEN NULL
         WHEN o_custkey % 73 = 11 THEN concat('C-', CAST(o_custkey AS STRING))
         ELSE CAST(o_custkey AS STRING) END AS customer_id,
    CASE WHEN o_orderkey % 43 = 1 THEN '99999999'
         ELSE CAST(o_orderkey % (SELECT count(*) FROM {part}) AS STRING) END AS product_id,
    CASE WHEN o_orderkey % 37 = 6 THEN 'not a day' WHEN o_orderkey % 53 = 7 THEN NULL
         ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
    CASE WHEN o_orderkey % 31 = 3 THEN '-1' WHEN o_orderkey % 31 = 7 THEN NULL
         WHEN o_orderkey % 31 = 8 THEN 'two'
         ELSE CAST(1 + o_orderkey % 50 AS STRING) END AS quantity,
    CASE WHEN o_orderkey % 29 = 3 THEN '-12.75' WHEN o_orderkey % 29 = 8 THEN NULL
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS total_amount,
    'usd ' AS currency
  FROM {orders}"""

SPARK_SQL = {
    "customers": f"""
SELECT customer_id, CASE WHEN copy = 1 THEN concat(full_name, ' II') ELSE full_name END AS full_name,
       email, country, registration_date
FROM ({CUSTOMER_BASE})
LATERAL VIEW explode(
  IF(k % 97 = 3 AND full_name IS NOT NULL, array(0, 1), array(0))) AS copy""",
    "products": f"""
SELECT product_id,
       CASE WHEN copy = 1 THEN concat(product_name, ' (again)') ELSE product_name END
         AS product_name,
       category, price
FROM ({PRODUCT_BASE})
LATERAL VIEW explode(IF(k % 89 = 2, array(0, 1), array(0))) AS copy""",
    "orders": f"""
SELECT order_id, customer_id, product_id, order_date, quantity, total_amount, currency
FROM ({ORDER_BASE})
LATERAL VIEW explode(IF(k % 101 = 9, array(0, 1), array(0))) AS copy""",
}

_PLAIN = dict(customer="customer", nation="nation", part="part", orders="orders")

ORACLE_CTES = f"""
customer_base AS ({CUSTOMER_BASE}),
product_base AS ({PRODUCT_BASE}),
order_base AS ({ORDER_BASE}),
raw_customers AS (
  SELECT customer_id, full_name, email, country, registration_date FROM customer_base
  UNION ALL
  SELECT customer_id, concat(full_name, ' II'), email, country, registration_date
  FROM customer_base WHERE k % 97 = 3 AND full_name IS NOT NULL),
raw_products AS (
  SELECT product_id, product_name, category, price FROM product_base
  UNION ALL
  SELECT product_id, concat(product_name, ' (again)'), category, price
  FROM product_base WHERE k % 89 = 2),
raw_orders AS (
  SELECT order_id, customer_id, product_id, order_date, quantity, total_amount, currency
  FROM order_base
  UNION ALL
  SELECT order_id, customer_id, product_id, order_date, quantity, total_amount, currency
  FROM order_base WHERE k % 101 = 9)""".format(**_PLAIN)


# Stated schemas spare each scan the job that would read a file footer for them.
SCHEMAS = {
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def raw_table(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    text = SPARK_SQL[dataset]
    used = {name: source(spark, folder, name) for name in _PLAIN if f"{{{name}}}" in text}
    return spark.sql(text, **used)


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: raw_table(spark, folder, name) for name in SPARK_SQL}
