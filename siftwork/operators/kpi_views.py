"""The sales KPIs as SQL text, for views that live in a catalog and outlast the session.

The statements follow ``kpi``: orders are added up per product or customer before they meet the
dimension, totals are exact sums of decimals where the values allow it, and distinct orders are counted
from the orders of one product (or customer) and, apart, those of several.
"""

from __future__ import annotations

_EXACT = "decimal(24,6)"


def _partial(column: str, name: str) -> str:
    exact = f"try_cast({column} AS {_EXACT})"
    return (
        f"try_sum({exact}) AS {name}__exact, sum({column}) AS {name}__float, "
        f"count_if({column} IS NOT NULL AND NOT coalesce(CAST({exact} AS double) = {column}, false)) "
        f"+ CASE WHEN try_sum({exact}) IS NULL AND count({exact}) > 0 THEN 1 ELSE 0 END AS {name}__inexact"
    )


def _weighted(name: str) -> str:
    times = f"try_multiply({name}__exact, listed)"
    inexact = f"sum({name}__inexact) + count_if({times} IS NULL AND {name}__exact IS NOT NULL)"
    return (
        f"CASE WHEN {inexact} = 0 AND try_sum({times}) IS NOT NULL THEN CAST(try_sum({times}) AS double) "
        f"ELSE sum({name}__float * listed) END AS {name}"
    )


def _total(column: str, name: str) -> str:
    exact = f"try_cast({column} AS {_EXACT})"
    inexact = f"count_if({column} IS NOT NULL AND NOT coalesce(CAST({exact} AS double) = {column}, false))"
    return (
        f"CASE WHEN {inexact} = 0 AND try_sum({exact}) IS NOT NULL THEN CAST(try_sum({exact}) AS double) "
        f"ELSE sum({column}) END AS {name}"
    )


def daily_sales_sql(orders: str, orders_unique: bool = False) -> str:
    ids = "order_id" if orders_unique else "DISTINCT order_id"
    return f"""
SELECT order_date, count({ids}) AS order_count, {_total("quantity", "total_quantity")},
  {_total("total_amount", "total_revenue")}
FROM {orders} GROUP BY order_date ORDER BY order_date"""


def _by_dimension(
    orders: str, dimension: str, key: str, group: str, amounts: tuple, orders_unique: bool, more: str
) -> str:
    """Orders, ``more`` and totals per ``group`` of a dimension table, which ``key`` leads to."""
    partials = ", ".join(_partial(*c) for c in amounts)
    totals = ", ".join(_weighted(name) for _, name in amounts)
    parts = [
        f"per_key AS (SELECT {key}, count(order_id) AS orders, {partials} FROM {orders} GROUP BY {key})",
        f"places AS (SELECT {key}, {group}, count(*) AS listed FROM {dimension} GROUP BY {key}, {group})",
    ]
    if orders_unique:
        return f"""
WITH {', '.join(parts)}
SELECT {group}, sum(orders) AS order_count, {more}{totals}
FROM per_key JOIN places USING ({key}) GROUP BY {group} ORDER BY total_revenue DESC, {group} ASC"""
    return f"""
WITH {', '.join(parts)},
ids AS (SELECT order_id, {key} FROM {orders} WHERE order_id IS NOT NULL AND {key} IS NOT NULL),
per_order AS (SELECT order_id, min({key}) AS least, max({key}) AS greatest FROM ids GROUP BY order_id),
single AS (SELECT least AS {key}, count(*) AS n FROM per_order WHERE least = greatest GROUP BY least),
several AS (SELECT DISTINCT order_id, {key} FROM ids
  WHERE order_id IN (SELECT order_id FROM per_order WHERE least <> greatest)),
apart AS (
  SELECT {group}, sum(n) AS n FROM single JOIN places USING ({key}) GROUP BY {group}
  UNION ALL
  SELECT {group}, count(*) FROM (SELECT DISTINCT order_id, {group} FROM several JOIN places USING ({key})) GROUP BY {group}),
counted AS (SELECT {group} AS place, sum(n) AS order_count FROM apart GROUP BY {group}),
summed AS (SELECT {group}, {more}{totals} FROM per_key JOIN places USING ({key}) GROUP BY {group})
SELECT {group}, coalesce(order_count, 0) AS order_count, summed.* EXCEPT ({group})
FROM summed LEFT JOIN counted ON {group} <=> place ORDER BY total_revenue DESC, {group} ASC"""


def category_sales_sql(orders: str, products: str, orders_unique: bool = False) -> str:
    amounts = (("quantity", "total_quantity"), ("total_amount", "total_revenue"))
    return _by_dimension(orders, products, "product_id", "category", amounts, orders_unique, "")


def customer_country_sql(orders: str, customers: str, orders_unique: bool = False) -> str:
    amounts = (("total_amount", "total_revenue"),)
    # Each customer is one row per country where orders meet the places.
    more = "count(customer_id) AS unique_customers, "
    return _by_dimension(orders, customers, "customer_id", "country", amounts, orders_unique, more)
