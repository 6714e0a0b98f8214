"""The orders job: check orders, split them by reason and write their KPIs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from siftwork.operators.annotate import ISSUES, split_once
from siftwork.operators.kpi import category_sales, daily_sales
from siftwork.operators.order_checks import (
    check_orders,
    rejected_orders,
    rejection_reason_summary,
    typed,
)
from siftwork.plans.quality import QualityRun, counted, write_all
from siftwork.plans.stage import Stage
from siftwork.sources import read_table, scan_dataset_by_position

# The outputs of the job and their zones.
OUTPUTS = {
    "spark_clean_orders": "processed",
    "spark_rejected_orders": "rejected",
    "spark_daily_sales_kpi": "processed",
    "spark_category_sales_summary": "processed",
    "spark_rejection_reason_summary": "processed",
}
#: What the checks and the category summary read of each dataset apart from the rows themselves.
NARROW = {
    "orders": ("order_id", "customer_id", "product_id"),
    "customers": ("customer_id",),
    "products": ("product_id", "category"),
}


def run_orders_job(
    spark: SparkSession,
    inputs: Mapping[str, str | DataFrame],
    output: str,
    *,
    fmt: str = "csv",
    stage: Stage | None = None,
    **scan_options: object,
) -> QualityRun:
    """Check the orders, write clean and rejected rows and three summaries of them.

    Whole orders are written once, as clean orders; only keys and rejected rows are staged, unless
    the key sets are too large to broadcast (``split_once``). The summaries read the clean
    orders as written. The category summary joins the products as scanned, repeated ids
    included. In the row counts a rejected order counts once per reason.
    """
    own_stage = stage is None
    stage = stage or Stage(spark)
    try:
        scanned = {
            name: source
            if isinstance(source, DataFrame)
            else scan_dataset_by_position(spark, name, source, **scan_options)
            for name, source in inputs.items()
        }
        narrow = stage.tables({name: scanned[name].select(*NARROW[name]) for name in NARROW})
        datasets = {**narrow, "orders": typed(scanned["orders"], "orders")}
        checked = check_orders(datasets, stage, keys=narrow["orders"])
        faultless, faulty = split_once(checked, stage, "orders")
        clean, clean_count = counted(faultless.drop(ISSUES), "clean_orders")
        rejected = stage.table(rejected_orders(faulty), "rejected")
        rejected_counted, rejected_count = counted(rejected, "rejected_orders")

        def written(**results: DataFrame) -> dict[str, str]:
            return write_all({name: (df, OUTPUTS[name]) for name, df in results.items()}, output, fmt)

        uris = written(
            spark_clean_orders=clean,
            spark_rejected_orders=rejected_counted,
            spark_rejection_reason_summary=rejection_reason_summary(rejected),
        )
        kept = read_table(spark, uris["spark_clean_orders"], clean.schema, fmt)
        uris |= written(
            spark_daily_sales_kpi=daily_sales(
                kept, "order_date_parsed", "quantity_double", "total_amount_double"
            ),
            spark_category_sales_summary=category_sales(
                kept, narrow["products"], "quantity_double", "total_amount_double"
            ),
        )
        run = QualityRun({name: uris[name] for name in OUTPUTS})
        run.row_counts["orders"] = {
            "clean": clean_count.get["rows"],
            "rejected": rejected_count.get["rows"],
        }
        return run
    finally:
        if own_stage:
            stage.drop()
