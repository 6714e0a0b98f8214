"""Run the jobs with ``python -m siftwork`` or hand this file to ``spark-submit``.

  quality  <raw folder> <output root> [--rules rules.yaml] [--date-format F ...] [--text-keys]
           [--check-date-text] [--reject-on SEVERITY ...] [--format csv|parquet]
  orders   <raw folder> <output root> [--format csv|parquet]
  serving  <output root of quality> [--text-keys] [--format csv|parquet]
"""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import SparkSession

from siftwork.functions.casts import DEFAULT_DATE_FORMATS, VOTE
from siftwork.operators.presets import RULES_DOCUMENT
from siftwork.operators.rules import rules_from_document
from siftwork.plans.orders import run_orders_job
from siftwork.plans.quality import run_quality_pipeline
from siftwork.plans.serving import SERVING_TABLES, publish_serving
from siftwork.sources import EXPECTED_COLUMNS, load_rules_document, scan_csv, zone_uri


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="siftwork", description="Table validation and KPIs")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("quality", "orders"):
        job = jobs.add_parser(name)
        job.add_argument("raw", help="folder with customers.csv, products.csv, orders.csv")
        job.add_argument("output", help="root of the output zones")
    quality = jobs.choices["quality"]
    quality.add_argument("--rules", help="rules document in YAML")
    quality.add_argument("--date-format", action="append", help="Spark date pattern, tried in order; vote: each column's own")
    quality.add_argument("--check-date-text", action="store_true", help="unreadable dates are issues")
    quality.add_argument("--reject-on", action="append", metavar="SEVERITY", help="default: any issue")
    jobs.add_parser("serving").add_argument("output", help="root of the quality job's zones")
    for name, job in jobs.choices.items():
        job.add_argument("--format", choices=("csv", "parquet"), default="csv", help="of the outputs")
        if name != "orders":
            job.add_argument("--text-keys", action="store_true", help="leave ids exactly as written")
    chosen = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"siftwork {chosen.job}").getOrCreate()
    if chosen.job == "serving":
        read = spark.read.parquet if chosen.format == "parquet" else partial(scan_csv, spark)
        clean = {
            table.removeprefix("clean_"): read(zone_uri(chosen.output, "processed", table))
            for table in SERVING_TABLES
        }
        publish_serving(spark, clean, text_keys=chosen.text_keys)
        for view in ("daily_sales_kpi", "category_sales_summary", "customer_country_summary"):
            spark.table(view).show()
        return
    inputs = {name: f"{chosen.raw.rstrip('/')}/{name}.csv" for name in EXPECTED_COLUMNS}
    if chosen.job == "orders":
        run = run_orders_job(spark, inputs, chosen.output, fmt=chosen.format)
    else:
        formats = chosen.date_format or DEFAULT_DATE_FORMATS
        voted = formats == [VOTE]
        document = load_rules_document(spark, chosen.rules) if chosen.rules else RULES_DOCUMENT
        run = run_quality_pipeline(
            spark,
            inputs,
            chosen.output,
            rules_from_document(document, DEFAULT_DATE_FORMATS if voted else formats),
            fmt=chosen.format,
            reject_on=chosen.reject_on,
            check_date_text=chosen.check_date_text,
            date_formats=VOTE if voted else formats,
            text_keys=chosen.text_keys,
        )
    for dataset, counts in run.row_counts.items():
        print(f"{dataset}: {counts['clean']} clean, {counts['rejected']} rejected")


if __name__ == "__main__":
    main()
