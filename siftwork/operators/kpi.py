"""Sales KPIs by day, category and country.

Orders are added up per product or customer before they meet the dimension table. A
product or customer that a large share of the orders names is then one row per map task,
and the join moves one row per key instead of one per order.

``orders_unique`` states that no order id repeats, as holds for the clean rows of a rule
set with uniqueness on it. Distinct orders are then plain counts and need no shuffle by
order id. Without it each order id is first reduced to the least and the greatest key it names. Where
both are one, as for most, it is counted with that key before the join; only ids that name
several keys meet the dimension one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.operators.totals import partial_total, total, weighted_total


def daily_sales(
    orders: DataFrame,
    date: str = "order_date",
    quantity: str = "quantity",
    amount: str = "total_amount",
) -> DataFrame:
    """Rows with an order id, quantity and revenue per day, by day."""
    return (
        orders.groupBy(date)
        .agg(
            F.count("order_id").alias("order_count"),
            total(quantity, "total_quantity"),
            total(amount, "total_revenue"),
        )
        .orderBy(date)
    )


def daily_sales_kpi(orders: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Distinct orders, quantity and revenue per day, by day."""
    if orders_unique:
        return daily_sales(orders)
    return (
        orders.groupBy("order_date")
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            total("quantity", "total_quantity"),
            total("total_amount", "total_revenue"),
        )
        .orderBy("order_date")
    )


def category_sales(
    orders: DataFrame,
    products: DataFrame,
    quantity: str = "quantity",
    amount: str = "total_amount",
) -> DataFrame:
    """Joined rows, quantity and revenue per category, highest revenue first.

    A product listed several times counts its orders as many times.
    """
    joined = _per_product(orders, quantity, amount).join(_categories(products), "product_id")
    return _by_revenue(
        joined.groupBy("category").agg(
            F.sum(F.col("orders") * F.col("listed")).alias("order_count"),
            weighted_total("total_quantity", "listed"),
            weighted_total("total_revenue", "listed"),
        ),
        "category",
    )


def category_sales_summary(
    orders: DataFrame, products: DataFrame, orders_unique: bool = False
) -> DataFrame:
    """Distinct orders, quantity and revenue per category, highest revenue first."""
    if orders_unique:
        joined = _per_product(orders, "quantity", "total_amount").join(
            _categories(products), "product_id"
        )
        # A product appears once per category here, so its orders are counted once.
        grouped = joined.groupBy("category").agg(
            F.sum("orders").alias("order_count"),
            weighted_total("total_quantity", "listed"),
            weighted_total("total_revenue", "listed"),
        )
    else:
        grouped = _with_distinct_orders(
            _per_product(orders, "quantity", "total_amount")
            .join(_categories(products), "product_id")
            .groupBy("category")
            .agg(
                weighted_total("total_quantity", "listed"),
                weighted_total("total_revenue", "listed"),
            ),
            distinct_orders(orders, products, "product_id", "category"),
            "category",
        ).select("category", "order_count", "total_quantity", "total_revenue")
    return _by_revenue(grouped, "category")


def customer_country_summary(
    orders: DataFrame, customers: DataFrame, orders_unique: bool = False
) -> DataFrame:
    """Distinct orders, distinct customers and revenue per country, highest revenue first."""
    per_customer = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"), *partial_total("total_amount", "total_revenue")
    )
    countries = customers.groupBy("customer_id", "country").agg(F.count(F.lit(1)).alias("listed"))
    # Each customer is one row per country here.
    grouped = (
        per_customer.join(countries, "customer_id")
        .groupBy("country")
        .agg(
            F.sum("orders").alias("order_count"),
            F.count("customer_id").alias("unique_customers"),
            weighted_total("total_revenue", "listed"),
        )
    )
    if not orders_unique:
        grouped = _with_distinct_orders(
            grouped.drop("order_count"),
            distinct_orders(orders, customers, "customer_id", "country"),
            "country",
        ).select("country", "order_count", "unique_customers", "total_revenue")
    return _by_revenue(grouped, "country")


def distinct_orders(orders: DataFrame, dimension: DataFrame, key: str, group: str) -> DataFrame:
    """(group, order_count): different order ids per ``group`` of the dimension that ``key`` leads to.

    Ids are reduced on the map side, so a hot id or key is one row per task; an order that names several
    keys counts once in each of their groups.
    """
    ids = orders.select("order_id", key).filter(F.col("order_id").isNotNull() & F.col(key).isNotNull())
    per_order = ids.groupBy("order_id").agg(F.min(key).alias("least"), F.max(key).alias("greatest"))
    places = dimension.select(key, group).distinct()
    single = (
        per_order.filter("least = greatest")
        .groupBy(F.col("least").alias(key))
        .agg(F.count(F.lit(1)).alias("n"))
        .join(places, key)
        .groupBy(group)
        .agg(F.sum("n").alias("n"))
    )
    several = per_order.filter("least <> greatest").select("order_id")
    apart = (
        ids.join(several, "order_id", "left_semi")
        .distinct()
        .join(places, key)
        .select("order_id", group)
        .distinct()
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return single.unionByName(apart).groupBy(group).agg(F.sum("n").alias("order_count"))


def _with_distinct_orders(totals: DataFrame, counts: DataFrame, group: str) -> DataFrame:
    counts = counts.select(F.col(group).alias("counted_group"), F.col("order_count").alias("counted"))
    joined = totals.join(counts, F.col(group).eqNullSafe(F.col("counted_group")), "left")
    return joined.withColumn("order_count", F.coalesce("counted", F.lit(0)))


def _per_product(orders: DataFrame, quantity: str, amount: str) -> DataFrame:
    return orders.groupBy("product_id").agg(
        F.count("order_id").alias("orders"),
        *partial_total(quantity, "total_quantity"),
        *partial_total(amount, "total_revenue"),
    )


def _categories(products: DataFrame) -> DataFrame:
    return products.groupBy("product_id", "category").agg(F.count(F.lit(1)).alias("listed"))


def _by_revenue(grouped: DataFrame, key: str) -> DataFrame:
    return grouped.orderBy(F.col("total_revenue").desc(), F.col(key).asc())
