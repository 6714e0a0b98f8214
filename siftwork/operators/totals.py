"""Sums of doubles that do not depend on the order of the rows.

A value with at most six decimals is summed as a decimal, exactly. Where a group holds a
value that is no such decimal (too large, too fine, infinite), the plain sum of doubles
is its total. The partial columns can be summed again, so totals work in two steps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scale six survives a multiplication by a row count; see the decimal rules of Spark SQL.
_EXACT = "decimal(24,6)"


def partial_total(column: str, name: str) -> list[Column]:
    """Aggregates that hold the state of a total over ``column``."""
    value = F.col(column)
    exact = value.try_cast(_EXACT)
    is_exact = exact.cast("double") == value
    overflown = F.try_sum(exact).isNull() & (F.count(exact) > 0)
    return [
        F.try_sum(exact).alias(f"{name}__exact"),
        F.sum(value).alias(f"{name}__float"),
        (
            F.count_if(value.isNotNull() & ~F.coalesce(is_exact, F.lit(False)))
            + F.when(overflown, 1).otherwise(0)
        ).alias(f"{name}__inexact"),
    ]


def weighted_total(name: str, weight: str) -> Column:
    """Total over partial states that each count ``weight`` times."""
    times = F.col(weight)
    exact = F.try_multiply(F.col(f"{name}__exact"), times)
    overflown = exact.isNull() & F.col(f"{name}__exact").isNotNull()
    inexact = F.sum(F.col(f"{name}__inexact")) + F.count_if(overflown)
    return _choose(F.try_sum(exact), F.sum(F.col(f"{name}__float") * times), inexact).alias(name)


def total(column: str, name: str) -> Column:
    """Total over the rows of a group."""
    exact, floating, inexact = partial_total(column, name)
    return _choose(exact, floating, inexact).alias(name)


def _choose(exact: Column, floating: Column, inexact: Column) -> Column:
    return F.when((inexact == 0) & exact.isNotNull(), exact.cast("double")).otherwise(floating)
