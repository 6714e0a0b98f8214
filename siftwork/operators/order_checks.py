"""The orders check: typed columns beside the text, one rejected row per order and reason."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.functions import to_date, to_integer, to_number
from siftwork.operators.annotate import ISSUES, annotate
from siftwork.operators.rules import DATE, FOREIGN_KEY, NUMERIC, UNIQUE, Rule
from siftwork.operators.split import clean_rows
from siftwork.plans.stage import Stage

# Fixed value: the only date form that the orders check accepts.
ORDER_DATE_FORMATS = ("yyyy-MM-dd",)

# The reasons for which an order is rejected, with the rule behind each.
REASONS: dict[str, Rule] = {
    "duplicate_order_id": Rule(UNIQUE, "order_id", missing_repeats=False),
    "invalid_quantity": Rule(NUMERIC, "quantity", min_value=1, parsed_column="quantity_double"),
    "invalid_total_amount": Rule(
        NUMERIC, "total_amount", min_value=0, parsed_column="total_amount_double"
    ),
    "invalid_order_date": Rule(DATE, "order_date", parsed_column="order_date_parsed"),
    "invalid_customer_fk": Rule(
        FOREIGN_KEY, "customer_id", reference_dataset="customers", reference_column="customer_id"
    ),
    "invalid_product_fk": Rule(
        FOREIGN_KEY, "product_id", reference_dataset="products", reference_column="product_id"
    ),
}
ORDER_RULES = list(REASONS.values())


def typed(df: DataFrame, dataset: str) -> DataFrame:
    """Add the typed columns of a dataset; the text columns stay as read."""
    if dataset == "orders":
        return df.withColumns(
            {
                "order_id_int": to_integer(F.col("order_id")),
                "customer_id_int": to_integer(F.col("customer_id")),
                "product_id_int": to_integer(F.col("product_id")),
                "order_date_parsed": to_date(F.col("order_date"), ORDER_DATE_FORMATS),
                "quantity_double": to_number(F.col("quantity")),
                "total_amount_double": to_number(F.col("total_amount")),
            }
        )
    if dataset == "customers":
        return df.withColumns({"customer_id_int": to_integer(F.col("customer_id"))})
    if dataset == "products":
        return df.withColumns(
            {
                "product_id_int": to_integer(F.col("product_id")),
                "price_double": to_number(F.col("price")),
            }
        )
    raise KeyError(dataset)


def check_orders(
    datasets: Mapping[str, DataFrame], stage: Stage, keys: DataFrame | None = None
) -> DataFrame:
    """Typed orders annotated with the positions in ``REASONS`` of the checks they fail."""
    return annotate(datasets["orders"], ORDER_RULES, datasets, stage, keys)


def clean_orders(checked: DataFrame) -> DataFrame:
    """Orders with no reason against them.

    Every row of a repeated order id is rejected, so this leaves no row whose order id
    occurs among the rejected ones; no join is needed to keep them out.
    """
    return clean_rows(checked, ORDER_RULES)


def rejected_orders(checked: DataFrame) -> DataFrame:
    """One row per order id and reason, with the smallest row standing for several.

    Only rows of a repeated or missing order id can share id and reason. All others pass straight
    through, and the repeated ones are reduced on the map side before they shuffle.
    """
    names = [name for name in checked.columns if name != ISSUES]
    reasons = F.array(*[F.lit(reason) for reason in REASONS])
    repeated = F.array_contains(ISSUES, list(REASONS).index("duplicate_order_id"))
    # Missing ids are no duplicates of each other, yet they share one row for each reason.
    repeated = repeated | F.col("order_id").isNull()
    by_reason = checked.select(
        *names, repeated.alias("__repeated"), F.explode(ISSUES).alias("__position")
    ).withColumn("rejection_reason", F.get(reasons, F.col("__position")))

    single = by_reason.filter(~F.col("__repeated")).select(*names, "rejection_reason")
    merged = (
        by_reason.filter("__repeated")
        .groupBy("order_id", "rejection_reason")
        .agg(F.min(F.struct(*names)).alias("__row"))
        .select(*[F.col(f"__row.{name}").alias(name) for name in names], "rejection_reason")
    )
    return single.unionByName(merged)


def rejection_reason_summary(rejected: DataFrame) -> DataFrame:
    """Rejected orders per reason, most frequent first; missing order ids do not count."""
    return (
        rejected.groupBy("rejection_reason")
        .agg(F.count("order_id").alias("rejected_record_count"))
        .orderBy(F.col("rejected_record_count").desc(), F.col("rejection_reason").asc())
    )
