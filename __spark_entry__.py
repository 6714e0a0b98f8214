
from __future__ import annotations

import importlib.util
import pathlib
import sys
from collections.abc import Callable
from functools import reduce

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The driver may load this file from elsewhere.
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from dirty_tables import raw_table, raw_tables, source
from oracle_queries import ORACLE
from siftwork.operators import kpi, order_checks, reports
from siftwork.operators.annotate import annotate_all
from siftwork.operators.keys import duplicate_keys, rows_holding
from siftwork.operators.normalize import normalize, normalize_all, voted_formats
from siftwork.operators.order_checks import typed
from siftwork.operators.presets import RULES_DOCUMENT, preset_rules
from siftwork.operators.rules import NUMERIC, Rule, rules_from_document
from siftwork.operators.split import clean_rows, is_rejected, rejected_rows
from siftwork.plans.orders import run_orders_job
from siftwork.plans.quality import run_quality_pipeline
from siftwork.plans.serving import publish_serving
from siftwork.plans.stage import Stage
from siftwork.sources import (
    load_dataset,
    load_datasets,
    load_rules_document,
    read_table,
    scan_zone,
    scan_zone_tables,
    write_table,
)

# The operators for training data are optional: without their folder the rest works.
# Only their absence is passed over; a package that they lack is an error.
llm_queries = corpus_pipeline = None
if importlib.util.find_spec("siftwork.llm") and importlib.util.find_spec("siftwork.llm.queries"):
    from siftwork.llm import queries as llm_queries
if importlib.util.find_spec("corpus_pipeline"):
    import corpus_pipeline

Query = Callable[[SparkSession, str], DataFrame]

RULES = preset_rules()


# --- single rules on the raw text -------------------------------------------------------


def required_issues(spark: SparkSession, folder: str) -> DataFrame:
    df = raw_table(spark, folder, "customers")
    return reports.required_issues(df, "customers", "full_name", Stage(spark))


def unique_issues(spark: SparkSession, folder: str) -> DataFrame:
    df = raw_table(spark, folder, "orders")
    return reports.unique_issues(df, "orders", "order_id", Stage(spark))


def date_issues(spark: SparkSession, folder: str) -> DataFrame:
    df = raw_table(spark, folder, "orders")
    return reports.date_issues(df, "orders", "order_date", Stage(spark))


def numeric_issues(spark: SparkSession, folder: str) -> DataFrame:
    df = raw_table(spark, folder, "orders")
    return reports.numeric_min_issues(df, "orders", "quantity", 1, Stage(spark))


def email_issues(spark: SparkSession, folder: str) -> DataFrame:
    df = raw_table(spark, folder, "customers")
    return reports.email_issues(df, "customers", "email", Stage(spark))


def fk_customer_issues(spark: SparkSession, folder: str) -> DataFrame:
    return reports.foreign_key_issues(
        raw_table(spark, folder, "orders"),
        raw_table(spark, folder, "customers"),
        "orders",
        "customer_id",
        "customer_id",
        "customers",
        Stage(spark),
    )


def fk_product_issues(spark: SparkSession, folder: str) -> DataFrame:
    return reports.foreign_key_issues(
        raw_table(spark, folder, "orders"),
        raw_table(spark, folder, "products"),
        "orders",
        "product_id",
        "product_id",
        "products",
        Stage(spark),
    )


def numeric_min_acctbal(spark: SparkSession, folder: str) -> DataFrame:
    df = source(spark, folder, "customer")
    return reports.numeric_min_issues(df, "customer", "c_acctbal", 0, Stage(spark))


def unique_lineitem_key(spark: SparkSession, folder: str) -> DataFrame:
    key = ("l_orderkey", "l_linenumber")
    df = source(spark, folder, "lineitem").select(*key, "l_partkey", "l_suppkey", "l_quantity")
    repeated = Stage(spark).key_sets({"repeated": duplicate_keys(df, *key)})["repeated"]
    return rows_holding(df, repeated, *key)


# --- normalised tables and typed columns ------------------------------------------------


def _normalized(dataset: str) -> Query:
    return lambda spark, folder: normalize(raw_table(spark, folder, dataset), dataset)


def _typed(dataset: str) -> Query:
    return lambda spark, folder: typed(raw_table(spark, folder, dataset), dataset)


# --- the rule set as a whole ------------------------------------------------------------


def _annotated(spark: SparkSession, folder: str, **options: object) -> dict[str, DataFrame]:
    return annotate_all(
        normalize_all(raw_tables(spark, folder), **options), RULES, Stage(spark)
    )


def _annotated_one(
    spark: SparkSession, folder: str, dataset: str, **options: object
) -> DataFrame:
    """One dataset annotated, with the others at hand for its foreign keys."""
    tables = normalize_all(raw_tables(spark, folder), **options)
    return annotate_all(tables, {dataset: RULES[dataset]}, Stage(spark))[dataset]


def _issues(dataset: str, **options: object) -> Query:
    return lambda spark, folder: reports.issue_report(
        _annotated_one(spark, folder, dataset, **options), dataset, RULES[dataset]
    )


def issues_all(spark: SparkSession, folder: str) -> DataFrame:
    return reports.union_reports(
        [
            reports.issue_report(df, name, RULES[name])
            for name, df in _annotated(spark, folder).items()
        ]
    )


def preset_issues(spark: SparkSession, folder: str) -> DataFrame:
    """The preset rules on the tables as read, before any normalisation."""
    annotated = annotate_all(raw_tables(spark, folder), RULES, Stage(spark))
    return reports.union_reports(
        [reports.issue_report(df, name, RULES[name]) for name, df in annotated.items()]
    )


def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.quality_summary(_annotated(spark, folder), RULES)


def quality_summary_date_text(spark: SparkSession, folder: str) -> DataFrame:
    return reports.quality_summary(_annotated(spark, folder, keep_date_text=True), RULES)


def _clean(dataset: str) -> Query:
    return lambda spark, folder: clean_rows(
        _annotated_one(spark, folder, dataset), RULES[dataset]
    )


def _rejected(dataset: str) -> Query:
    return lambda spark, folder: rejected_rows(
        _annotated_one(spark, folder, dataset), RULES[dataset]
    )


def clean_customers_errors_only(spark: SparkSession, folder: str) -> DataFrame:
    """Customers whose warnings are tolerated."""
    annotated = _annotated_one(spark, folder, "customers")
    return clean_rows(annotated, RULES["customers"], reject_on=("ERROR",))


def rejected_orders_other_severity(spark: SparkSession, folder: str) -> DataFrame:
    """A rule of a severity of one's own rejects like any other."""
    rules = [Rule(NUMERIC, "quantity", severity="CRITICAL", min_value=1)]
    orders = normalize(raw_table(spark, folder, "orders"), "orders")
    return rejected_rows(annotate_all({"orders": orders}, {"orders": rules}, Stage(spark))["orders"], rules)


def extra_columns_pass_through(spark: SparkSession, folder: str) -> DataFrame:
    """Columns beyond the contract stay, whatever they are called."""
    extra = {"memo__text": "m", "issues": "i", "row_count": 1, "known_key": 2}
    tables = raw_tables(spark, folder)
    tables["orders"] = tables["orders"].withColumns({k: F.lit(v) for k, v in extra.items()})
    rules = {"orders": RULES["orders"]}
    annotated = annotate_all(normalize_all(tables), rules, Stage(spark))
    return clean_rows(annotated["orders"], RULES["orders"])


# --- KPIs over the clean rows of all datasets -------------------------------------------


def _clean_all(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """The clean rows of the named datasets, or of all; only their rules are run."""
    tables = normalize_all(raw_tables(spark, folder))
    rules = {name: RULES[name] for name in names or RULES}
    annotated = annotate_all(tables, rules, Stage(spark))
    return {name: clean_rows(annotated[name], RULES[name]) for name in rules}


def daily_sales_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.daily_sales_kpi(_clean("orders")(spark, folder), orders_unique=True)


def category_sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    clean = _clean_all(spark, folder, "orders", "products")
    return kpi.category_sales_summary(clean["orders"], clean["products"], orders_unique=True)


def customer_country_summary(spark: SparkSession, folder: str) -> DataFrame:
    clean = _clean_all(spark, folder, "orders", "customers")
    return kpi.customer_country_summary(clean["orders"], clean["customers"], orders_unique=True)


def raw_daily_sales_kpi(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct counts on rows that were not checked."""
    return kpi.daily_sales_kpi(normalize(raw_table(spark, folder, "orders"), "orders"))


def raw_category_sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    tables = normalize_all(raw_tables(spark, folder))
    return kpi.category_sales_summary(tables["orders"], tables["products"])


def raw_customer_country_summary(spark: SparkSession, folder: str) -> DataFrame:
    tables = normalize_all(raw_tables(spark, folder))
    return kpi.customer_country_summary(tables["orders"], tables["customers"])


# --- the orders check -------------------------------------------------------------------


def _checked_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    tables = {name: typed(df, name) for name, df in raw_tables(spark, folder).items()}
    return order_checks.check_orders(tables, Stage(spark)), tables["products"]


def clean_orders_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return order_checks.clean_orders(_checked_orders(spark, folder)[0])


def rejected_by_reason_rows(spark: SparkSession, folder: str) -> DataFrame:
    checked, _ = _checked_orders(spark, folder)
    # The rejected rows are read twice from here on, so they are checked and written once.
    failed = checked.filter(is_rejected(order_checks.ORDER_RULES))
    return order_checks.rejected_orders(Stage(spark).table(failed, "failed"))


def rejection_reason_summary(spark: SparkSession, folder: str) -> DataFrame:
    return order_checks.rejection_reason_summary(rejected_by_reason_rows(spark, folder))


def daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.daily_sales(
        clean_orders_by_id(spark, folder),
        "order_date_parsed",
        "quantity_double",
        "total_amount_double",
    )


def category_sales(spark: SparkSession, folder: str) -> DataFrame:
    checked, products = _checked_orders(spark, folder)
    return kpi.category_sales(
        order_checks.clean_orders(checked), products, "quantity_double", "total_amount_double"
    )


# --- whole jobs, through files ----------------------------------------------------------


def csv_roundtrip_clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Clean orders written as CSV, scanned again with their contract and typed again."""
    uri = Stage(spark).path("clean_orders")
    write_table(_clean("orders")(spark, folder), uri)
    return normalize(load_dataset(spark, "orders", uri), "orders")


def csv_quality_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The quality job from raw CSV to the summary it leaves in the reports zone."""
    stage = Stage(spark)
    raw = {
        name: write_table(df, stage.path(f"raw_{name}"))
        for name, df in raw_tables(spark, folder).items()
    }
    output = stage.path("output")
    run_quality_pipeline(spark, raw, output, stage=stage)
    summary = scan_zone(spark, output, "reports", "quality_summary")
    counts = ["issue_count", "error_count", "warning_count"]
    return summary.select("dataset_name", *[F.col(n).cast("bigint").alias(n) for n in counts])


def orders_job_category_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The orders job on DataFrames, and the category summary it writes."""
    stage = Stage(spark)
    run = run_orders_job(
        spark, raw_tables(spark, folder), stage.path("output"), fmt="parquet", stage=stage
    )
    return spark.read.parquet(run.outputs["spark_category_sales_summary"])


def serving_country_view(spark: SparkSession, folder: str) -> DataFrame:
    """Serving tables of the clean rows, asked through a KPI view."""
    clean = _clean_all(spark, folder)
    publish_serving(spark, clean, folder=Stage(spark).path("serving"), orders_unique=True, text_keys=True)
    return spark.sql("SELECT * FROM customer_country_summary")


def _published(view: str) -> Query:
    """A KPI view of a database of its own, over serving tables that were published twice."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        uri = Stage(spark).path("database")
        database = uri.rpartition("/")[2]
        spark.sql(f"CREATE DATABASE {database} LOCATION '{uri}'")
        clean = _clean_all(spark, folder)
        first = {name: df.limit(5) for name, df in clean.items()}
        for tables in (first, clean):
            publish_serving(spark, tables, database=database, text_keys=True)
        return spark.table(f"{database}.{view}")

    return query


def _raw_files(spark: SparkSession, folder: str, stage: Stage) -> dict[str, str]:
    root = stage.path("raw")
    return {name: write_table(df, f"{root}/{name}.csv") for name, df in raw_tables(spark, folder).items()}


def zone_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The processed zone as the quality job leaves it: its tables, found and scanned one by one."""
    stage = Stage(spark)
    output = stage.path("output")
    run_quality_pipeline(spark, raw_tables(spark, folder), output, stage=stage)
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(df.columns[0]).alias("n_ids")).select(
            F.lit(name).alias("table_name"), F.lit(",".join(df.columns)).alias("header"), "*"
        )
        for name, df in scan_zone_tables(spark, output, "processed").items()
    ]
    return reduce(DataFrame.unionByName, parts)


_ISSUES_DDL = (
    "customer_id string, full_name string, email string, country string, registration_date date, "
    "dataset_name string, rule_name string, column_name string, severity string, message string, "
    "product_id string, product_name string, category string, price double, order_id string, "
    "order_date date, quantity double, total_amount double, currency string"
)


def csv_all_issues_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report on all issues, read back from its CSV files."""
    stage = Stage(spark)
    run = run_quality_pipeline(spark, raw_tables(spark, folder), stage.path("output"), stage=stage)
    schema = StructType.fromDDL(_ISSUES_DDL)
    return read_table(spark, run.outputs["all_issues_validation_report"], schema)


def quality_run_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each half, as the run counted them while it wrote."""
    stage = Stage(spark)
    run = run_quality_pipeline(
        spark, raw_tables(spark, folder), stage.path("output"), fmt="parquet", stage=stage
    )
    rows = [(name, n["clean"], n["rejected"]) for name, n in run.row_counts.items()]
    return spark.createDataFrame(rows, "dataset_name string, clean bigint, rejected bigint")


def _orders_job_output(name: str, ddl: str) -> Query:
    """An output of the orders job from CSV with fixed schemas to CSV, read back."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        stage = Stage(spark)
        run = run_orders_job(spark, _raw_files(spark, folder, stage), stage.path("output"), stage=stage)
        return read_table(spark, run.outputs[name], StructType.fromDDL(ddl))

    return query


_TYPED_ORDERS_DDL = (
    "order_id string, customer_id string, product_id string, order_date string, quantity string, "
    "total_amount string, currency string, order_id_int bigint, customer_id_int bigint, "
    "product_id_int bigint, order_date_parsed date, quantity_double double, total_amount_double double"
)
_DAILY_DDL = "order_date_parsed date, order_count bigint, total_quantity double, total_revenue double"


def yaml_rules_issues(spark: SparkSession, folder: str) -> DataFrame:
    """All issues by the rules of a YAML document."""
    stage = Stage(spark)
    uri = stage.path("rules")
    text = yaml.safe_dump(RULES_DOCUMENT, sort_keys=False)
    spark.createDataFrame([(text,)], "document string").coalesce(1).write.text(uri)
    rules = rules_from_document(load_rules_document(spark, uri))
    annotated = annotate_all(normalize_all(raw_tables(spark, folder)), rules, stage)
    return reports.union_reports(
        [reports.issue_report(df, name, rules[name]) for name, df in annotated.items()]
    )


def loaded_datasets_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The quality summary of all datasets below one root, each scanned by its contract."""
    stage = Stage(spark)
    root = _raw_files(spark, folder, stage)["orders"].rpartition("/")[0]
    tables = normalize_all(load_datasets(spark, root))
    return reports.quality_summary(annotate_all(tables, RULES, stage), RULES)


def null_tokens_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders from CSV in which words stand for missing values."""
    tokens = {"product_id": ("1", "NULL"), "quantity": ("3", "n/a"), "order_date": ("5", "<NA>"), "currency": ("7", "NaN")}
    ends = lambda digit: F.coalesce(F.endswith("order_id", F.lit(digit)), F.lit(False))
    orders = raw_table(spark, folder, "orders").withColumns(
        {name: F.when(ends(digit), token).otherwise(F.col(name)) for name, (digit, token) in tokens.items()}
    )
    uri = Stage(spark).path("orders")
    return normalize(load_dataset(spark, "orders", write_table(orders, uri)), "orders")


def normalize_orders_other_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose dates are written day first, in the form that the column votes for."""
    orders = raw_table(spark, folder, "orders")
    slashed = F.date_format(F.try_to_date("order_date", "yyyy-MM-dd"), "dd/MM/yyyy")
    orders = orders.withColumn("order_date", F.coalesce(slashed, "order_date"))
    return normalize(orders, "orders", date_formats=voted_formats(orders, "orders"))


def entry(spark: SparkSession) -> DataFrame:
    """Daily sales of the orders that pass every check."""
    return daily_sales(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    out = core_queries()
    if llm_queries is not None:
        out |= llm_queries.queries()
    if corpus_pipeline is not None:
        out["pipeline"] = corpus_pipeline.run
    return out


def core_queries() -> dict[str, Query]:
    return {
        "required_issues": required_issues,
        "unique_issues": unique_issues,
        "unique_lineitem_key": unique_lineitem_key,
        "date_issues": date_issues,
        "numeric_issues": numeric_issues,
        "numeric_min_acctbal": numeric_min_acctbal,
        "email_issues": email_issues,
        "fk_customer_issues": fk_customer_issues,
        "fk_product_issues": fk_product_issues,
        "normalize_customers": _normalized("customers"),
        "normalize_products": _normalized("products"),
        "normalize_orders": _normalized("orders"),
        "typed_customers": _typed("customers"),
        "typed_products": _typed("products"),
        "typed_orders": _typed("orders"),
        "issues_customers": _issues("customers"),
        "issues_products": _issues("products"),
        "issues_orders": _issues("orders"),
        "issues_orders_date_text": _issues("orders", keep_date_text=True),
        "issues_all": issues_all,
        "preset_issues": preset_issues,
        "quality_summary": quality_summary,
        "quality_summary_date_text": quality_summary_date_text,
        "clean_customers": _clean("customers"),
        "clean_customers_errors_only": clean_customers_errors_only,
        "clean_products": _clean("products"),
        "clean_orders": _clean("orders"),
        "rejected_customers": _rejected("customers"),
        "rejected_products": _rejected("products"),
        "rejected_orders": _rejected("orders"),
        "rejected_orders_other_severity": rejected_orders_other_severity,
        "extra_columns_pass_through": extra_columns_pass_through,
        "daily_sales_kpi": daily_sales_kpi,
        "category_sales_summary": category_sales_summary,
        "customer_country_summary": customer_country_summary,
        "raw_daily_sales_kpi": raw_daily_sales_kpi,
        "raw_category_sales_summary": raw_category_sales_summary,
        "raw_customer_country_summary": raw_customer_country_summary,
        "clean_orders_by_id": clean_orders_by_id,
        "rejected_by_reason_rows": rejected_by_reason_rows,
        "rejection_reason_summary": rejection_reason_summary,
        "daily_sales": daily_sales,
        "category_sales": category_sales,
        "csv_roundtrip_clean_orders": csv_roundtrip_clean_orders,
        "csv_quality_run_summary": csv_quality_run_summary,
        "orders_job_category_sales": orders_job_category_sales,
        "serving_country_view": serving_country_view,
        "zone_tables": zone_tables,
        "catalog_daily_view": _published("daily_sales_kpi"),
        "catalog_category_view": _published("category_sales_summary"),
        "catalog_country_view": _published("customer_country_summary"),
        "csv_all_issues_report": csv_all_issues_report,
        "quality_run_row_counts": quality_run_row_counts,
        "csv_job_clean_orders": _orders_job_output("spark_clean_orders", _TYPED_ORDERS_DDL),
        "csv_job_rejected_orders": _orders_job_output(
            "spark_rejected_orders", _TYPED_ORDERS_DDL + ", rejection_reason string"
        ),
        "csv_job_daily_sales": _orders_job_output("spark_daily_sales_kpi", _DAILY_DDL),
        "csv_job_reason_summary": _orders_job_output(
            "spark_rejection_reason_summary", "rejection_reason string, rejected_record_count bigint"
        ),
        "yaml_rules_issues": yaml_rules_issues,
        "loaded_datasets_summary": loaded_datasets_summary,
        "null_tokens_orders": null_tokens_orders,
        "normalize_orders_other_dates": normalize_orders_other_dates,
    }


def oracle_sql() -> dict[str, str]:
    out = dict(ORACLE)
    if llm_queries is not None:
        out |= llm_queries.oracle_sql()
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
