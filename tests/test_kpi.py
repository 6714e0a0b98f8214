"""KPIs against brute force in pandas, on tables with repeated and missing keys."""

from __future__ import annotations

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siftwork.operators import kpi
from siftwork.operators.totals import partial_total, total, weighted_total


def tables(spark, seed, repeat_orders):
    rng = random.Random(seed)
    pick = lambda values: rng.choice(values)
    numbers = list(range(1, 400))
    orders = [
        (
            pick(numbers + [None]) if repeat_orders else n,
            # A third of the orders belong to one customer and name one product.
            1 if n % 3 == 0 else pick([2, 3, 4, 5, None]),
            11 if n % 3 == 1 else pick([12, 13, 14, None]),
            pick(["2023-01-01", "2023-01-02", None]),
            pick([1.0, 2.5, None]),
            pick([10.25, 0.1, 0.2, 1e15, None]),
        )
        for n in numbers
    ]
    products = [(11, "a"), (11, "a"), (11, "b"), (12, "b"), (13, None), (15, "c"), (None, "a")]
    customers = [(1, "x"), (1, "x"), (2, "y"), (3, "x"), (4, None), (None, "y")]
    return (
        spark.createDataFrame(
            orders,
            "order_id bigint, customer_id bigint, product_id bigint, order_date string, "
            "quantity double, total_amount double",
        ),
        spark.createDataFrame(products, "product_id bigint, category string"),
        spark.createDataFrame(customers, "customer_id bigint, country string"),
    )


def as_pandas(df):
    rows = [tuple(row) for row in df.collect()]
    return pd.DataFrame(rows, columns=df.columns, dtype=object)


def brute(frame, key, distinct, sums, count="nunique"):
    result = {}
    for value, group in frame.groupby(frame[key].map(lambda v: "null" if pd.isna(v) else v)):
        cells = [group[c].dropna().astype(object).agg(count if c == "order_id" else "nunique") for c in distinct]
        for column in sums:
            values = [v for v in group[column] if not pd.isna(v)]
            cells.append(math.fsum(values) if values else None)
        result[value] = tuple(cells)
    return result


def close(got, expected):
    assert set(got) == set(expected)
    for key, cells in expected.items():
        for a, b in zip(got[key], cells, strict=True):
            assert (a is None) == (b is None)
            assert a is None or math.isclose(a, b, rel_tol=1e-12), (key, a, b)


def keyed(df):
    return {"null" if row[0] is None else row[0]: tuple(row)[1:] for row in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("unique", [True, False])
def test_kpis_equal_brute_force(spark, seed, unique):
    orders, products, customers = tables(spark, seed, repeat_orders=not unique)
    o, p, c = as_pandas(orders), as_pandas(products), as_pandas(customers)
    by_product = o[o.product_id.notna()].merge(p[p.product_id.notna()], on="product_id")
    by_customer = o[o.customer_id.notna()].merge(c[c.customer_id.notna()], on="customer_id")
    sums = ["quantity", "total_amount"]
    close(keyed(kpi.daily_sales_kpi(orders, unique)), brute(o, "order_date", ["order_id"], sums))
    close(
        keyed(kpi.category_sales_summary(orders, products, unique)),
        brute(by_product, "category", ["order_id"], sums),
    )
    close(
        keyed(kpi.customer_country_summary(orders, customers, unique)),
        brute(by_customer, "country", ["order_id", "customer_id"], ["total_amount"]),
    )
    close(keyed(kpi.daily_sales(orders)), brute(o, "order_date", ["order_id"], sums, "count"))
    close(
        keyed(kpi.category_sales(orders, products)),
        brute(by_product, "category", ["order_id"], sums, "count"),
    )


def test_results_come_sorted(spark):
    orders, products, _ = tables(spark, 3, repeat_orders=False)
    revenue = [row.total_revenue for row in kpi.category_sales(orders, products).collect()]
    assert revenue == sorted(revenue, reverse=True)
    days = [row.order_date for row in kpi.daily_sales(orders).collect()]
    assert days == sorted(days, key=lambda day: day or "")


def test_totals_are_exact_and_survive_odd_values(spark):
    rows = [("exact", v) for v in [0.1] * 10]
    rows += [("fine", 1e-9), ("fine", 2e-9), ("huge", 1e300), ("huge", 1.0)]
    rows += [("none", None), ("inf", float("inf")), ("inf", 1.0), ("mixed", None), ("mixed", 2.5)]
    df = spark.createDataFrame(rows, "g string, v double")
    direct = {row.g: row.t for row in df.groupBy("g").agg(total("v", "t")).collect()}
    assert direct.pop("fine") == pytest.approx(3e-9, rel=1e-12)
    assert direct == {
        "exact": 1.0, "huge": 1e300, "none": None, "inf": float("inf"), "mixed": 2.5,
    }
    twice = (
        df.repartition(5).groupBy("g").agg(*partial_total("v", "t"))
        .withColumn("w", F.lit(3).cast("bigint")).groupBy("g").agg(weighted_total("t", "w"))
    )
    weighted = {row.g: row.t for row in twice.collect()}
    assert weighted["exact"] == 3.0
    assert weighted["none"] is None
    assert weighted["huge"] == 3e300
    assert math.isclose(weighted["fine"], 9e-9)


def test_totals_beyond_the_decimal_range_fall_back_to_doubles(spark):
    df = spark.range(2000).select(F.lit("g").alias("g"), F.lit(9e17).alias("v"))
    assert df.groupBy("g").agg(total("v", "t")).first().t == pytest.approx(1.8e21)
    heavy = df.groupBy("g").agg(*partial_total("v", "t")).withColumn("w", F.lit(10**15))
    assert heavy.groupBy("g").agg(weighted_total("t", "w")).first().t == pytest.approx(1.8e36)
