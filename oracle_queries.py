"""The registered queries as SQL over the same tables, written independently for DuckDB."""

from __future__ import annotations

from dirty_tables import ORACLE_CTES

COLUMNS = {
    "customers": "customer_id, full_name, email, country, registration_date",
    "products": "product_id, product_name, category, price",
    "orders": "order_id, customer_id, product_id, order_date, quantity, total_amount, currency",
}


def _strip(name: str) -> str:
    return rf"regexp_replace({name}, '^\s+|\s+$', '', 'g')"


def _date(name: str) -> str:
    return f"CAST(try_strptime({name}, '%Y-%m-%d') AS DATE)"


def _number(name: str) -> str:
    return f"try_cast({name} AS DOUBLE)"


def _key(name: str) -> str:
    return f"try_cast({name} AS BIGINT)"


def _id(name: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({name}, '[+-]?[0-9]+([.]0*)?') "
        f"THEN coalesce(CAST(try_cast({name} AS BIGINT) AS VARCHAR), {name}) ELSE {name} END"
    )


_TITLE = (
    rf"array_to_string(list_transform(regexp_extract_all(lower({_strip('category')}), "
    r"'\p{L}+|\P{L}+'), lambda x: concat(upper(x[1]), x[2:])), '')"
)

NORMALIZED = f"""
norm_customers AS (
  SELECT {_id('customer_id')} AS customer_id, {_strip('full_name')} AS full_name,
         lower({_strip('email')}) AS email, upper({_strip('country')}) AS country,
         {_date('registration_date')} AS registration_date, registration_date AS date_text
  FROM raw_customers),
norm_products AS (
  SELECT {_id('product_id')} AS product_id, {_strip('product_name')} AS product_name,
         {_TITLE} AS category, {_number('price')} AS price, NULL AS date_text
  FROM raw_products),
norm_orders AS (
  SELECT {_id('order_id')} AS order_id, {_id('customer_id')} AS customer_id,
         {_id('product_id')} AS product_id, {_date('order_date')} AS order_date,
         {_number('quantity')} AS quantity, {_number('total_amount')} AS total_amount,
         upper({_strip('currency')}) AS currency, order_date AS date_text
  FROM raw_orders)"""

_EMAIL = r"'[^@\s]+@[^@\s]+\.[^@\s]+'"


def _blank(name: str) -> str:
    return f"({name} IS NULL OR {_strip(f'CAST({name} AS VARCHAR)')} = '')"


def _repeated(name: str) -> str:
    return f"(count(*) OVER (PARTITION BY {name}) > 1)"


def _bad_email(name: str) -> str:
    text = _strip(f"coalesce({name}, '')")
    return f"({text} <> '' AND NOT regexp_full_match({text}, {_EMAIL}))"


def _below(name: str, bound: int) -> str:
    number = _number(name)
    return f"({number} IS NULL OR {number} < {bound})"


def _bad_date(name: str) -> str:
    return f"({name} IS NOT NULL AND {_date(name)} IS NULL)"


def _orphan(name: str, table: str) -> str:
    return f"(NOT EXISTS (SELECT 1 FROM {table} r WHERE r.{name} = t.{name}))"


_REQUIRED = "Column ''{0}'' is required and cannot be null or empty."
_UNIQUE = "Column ''{0}'' must contain unique values."
_DATES = "Column ''{0}'' contains invalid date values."
_EMAILS = "Column ''{0}'' contains invalid email format."
_BOUND = "Column ''{0}'' must be numeric and >= {1}."
_FOREIGN = "Column ''{0}'' contains values not found in {1}.{0}."


def _checks(dataset: str, form: str) -> list[tuple[str, str, str, str, str]]:
    """Condition, rule, column, severity and message of each check.

    ``form`` is ``norm`` (dates already parsed, nothing left to object to), ``text`` (dates
    judged by their text) or ``raw`` (everything as read).
    """
    date = {"norm": lambda name: "FALSE", "text": lambda name: _bad_date("date_text"), "raw": _bad_date}
    bad_date = date[form]

    def required(name):
        return (_blank(name), "required_column", name, "ERROR", _REQUIRED.format(name))

    def unique(name):
        return (_repeated(name), "unique_column", name, "ERROR", _UNIQUE.format(name))

    def dates(name):
        return (bad_date(name), "date_format", name, "ERROR", _DATES.format(name))

    def below(name, bound):
        return (_below(name, bound), "numeric_min_value", name, "ERROR", _BOUND.format(name, bound))

    def orphan(name, other):
        table = ("raw_" if form == "raw" else "norm_") + other
        return (_orphan(name, table), "foreign_key", name, "ERROR", _FOREIGN.format(name, other))

    return {
        "customers": lambda: [
            required("customer_id"),
            required("full_name"),
            required("country"),
            unique("customer_id"),
            dates("registration_date"),
            (_bad_email("email"), "email_format", "email", "WARNING", _EMAILS.format("email")),
        ],
        "products": lambda: [
            required("product_id"),
            required("product_name"),
            required("category"),
            unique("product_id"),
            below("price", 0),
        ],
        "orders": lambda: [
            required("order_id"),
            required("customer_id"),
            required("product_id"),
            unique("order_id"),
            dates("order_date"),
            below("quantity", 1),
            below("total_amount", 0),
            orphan("customer_id", "customers"),
            orphan("product_id", "products"),
        ],
    }[dataset]()


def _flagged(dataset: str, form: str) -> str:
    table = ("raw_" if form == "raw" else "norm_") + dataset
    flags = ", ".join(f"{c[0]} AS v{i}" for i, c in enumerate(_checks(dataset, form)))
    return f"{form}_flags_{dataset} AS (SELECT t.*, {flags} FROM {table} t)"


def _issue_rows(dataset: str, form: str, only: tuple[str, str] | None = None) -> str:
    parts = []
    for i, (_, rule, column, severity, message) in enumerate(_checks(dataset, form)):
        if only is None or only == (rule, column):
            parts.append(
                f"SELECT {COLUMNS[dataset]}, '{dataset}' AS dataset_name, '{rule}' AS rule_name, "
                f"'{column}' AS column_name, '{severity}' AS severity, '{message}' AS message "
                f"FROM {form}_flags_{dataset} WHERE v{i}"
            )
    return "\nUNION ALL\n".join(parts)


def _rejected(dataset: str, form: str = "norm", errors_only: bool = False) -> str:
    hits = [
        f"v{i}"
        for i, check in enumerate(_checks(dataset, form))
        if not errors_only or check[3] == "ERROR"
    ]
    return "(" + " OR ".join(hits) + ")"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join((ORACLE_CTES, *ctes)) + "\n"


def _norm(body: str, *datasets: str, form: str = "norm") -> str:
    return _with(NORMALIZED, *[_flagged(name, form) for name in datasets]) + body


def _raw(body: str, *datasets: str) -> str:
    return _with(*[_flagged(name, "raw") for name in datasets]) + body


def _all_issues(form: str) -> str:
    return "\nUNION ALL BY NAME\n".join(f"({_issue_rows(name, form)})" for name in COLUMNS)


def _summary(form: str) -> str:
    parts = []
    for name in COLUMNS:
        checks = _checks(name, form)
        hits = {
            level: " + ".join(
                f"CAST(v{i} AS BIGINT)" for i, c in enumerate(checks) if level in ("ALL", c[3])
            )
            or "0"
            for level in ("ALL", "ERROR", "WARNING")
        }
        parts.append(
            f"SELECT '{name}' AS dataset_name, CAST(sum({hits['ALL']}) AS BIGINT) AS issue_count, "
            f"CAST(sum({hits['ERROR']}) AS BIGINT) AS error_count, "
            f"CAST(sum({hits['WARNING']}) AS BIGINT) AS warning_count FROM {form}_flags_{name}"
        )
    return "\nUNION ALL\n".join(parts)


def _sum(column: str, name: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(24,6))) AS DOUBLE) AS {name}"


_SALES = f"{_sum('quantity', 'total_quantity')}, {_sum('total_amount', 'total_revenue')}"


def _clean_cte(dataset: str) -> str:
    return (
        f"clean_{dataset} AS (SELECT {COLUMNS[dataset]} FROM norm_flags_{dataset} "
        f"WHERE NOT {_rejected(dataset)})"
    )


def _on_clean(body: str) -> str:
    names = list(COLUMNS)
    return (
        _with(
            NORMALIZED,
            *[_flagged(name, "norm") for name in names],
            *[_clean_cte(name) for name in names],
        )
        + body
    )


def _daily(orders: str) -> str:
    return (
        f"SELECT order_date, count(DISTINCT order_id) AS order_count, {_SALES} "
        f"FROM {orders} GROUP BY order_date"
    )


def _category(orders: str, products: str) -> str:
    return (
        f"SELECT category, count(DISTINCT order_id) AS order_count, {_SALES} "
        f"FROM {orders} o JOIN {products} p ON o.product_id = p.product_id GROUP BY category"
    )


def _country(orders: str, customers: str) -> str:
    return (
        "SELECT country, count(DISTINCT order_id) AS order_count, "
        "count(DISTINCT o.customer_id) AS unique_customers, "
        f"{_sum('total_amount', 'total_revenue')} "
        f"FROM {orders} o JOIN {customers} c ON o.customer_id = c.customer_id GROUP BY country"
    )


_TYPED_ORDERS = f"""
typed_orders AS (
  SELECT *, {_key('order_id')} AS order_id_int, {_key('customer_id')} AS customer_id_int,
         {_key('product_id')} AS product_id_int, {_date('order_date')} AS order_date_parsed,
         {_number('quantity')} AS quantity_double, {_number('total_amount')} AS total_amount_double
  FROM raw_orders)"""

_REASONS = {
    "duplicate_order_id": f"(order_id IS NOT NULL AND {_repeated('order_id')})",
    "invalid_quantity": _below("quantity", 1),
    "invalid_total_amount": _below("total_amount", 0),
    "invalid_order_date": _bad_date("order_date"),
    "invalid_customer_fk": _orphan("customer_id", "raw_customers"),
    "invalid_product_fk": _orphan("product_id", "raw_products"),
}

_CHECKED = (
    "checked AS (SELECT t.*, "
    + ", ".join(f"{condition} AS {reason}" for reason, condition in _REASONS.items())
    + " FROM typed_orders t)"
)
_TYPED_NAMES = (
    COLUMNS["orders"] + ", order_id_int, customer_id_int, product_id_int, "
    "order_date_parsed, quantity_double, total_amount_double"
)
_REASON_ROWS = (
    "reason_rows AS ("
    + " UNION ALL ".join(
        f"SELECT {_TYPED_NAMES}, '{reason}' AS rejection_reason FROM checked WHERE {reason}"
        for reason in _REASONS
    )
    + ")"
)
_FIRST_ROW = (
    "first_rows AS (SELECT * FROM reason_rows QUALIFY row_number() OVER ("
    "PARTITION BY order_id, rejection_reason ORDER BY "
    + ", ".join(f"{name} ASC NULLS FIRST" for name in COLUMNS["orders"].split(", "))
    + ") = 1)"
)
_PASSED = f"passed AS (SELECT {_TYPED_NAMES} FROM checked WHERE NOT ({' OR '.join(_REASONS)}))"
_TYPED_SALES = (
    f"{_sum('quantity_double', 'total_quantity')}, {_sum('total_amount_double', 'total_revenue')}"
)


def _on_checked(body: str) -> str:
    return _with(_TYPED_ORDERS, _CHECKED, _REASON_ROWS, _FIRST_ROW, _PASSED) + body


_CATEGORY_SALES = _on_checked(
    f"SELECT category, count(order_id) AS order_count, {_TYPED_SALES} "
    "FROM passed o JOIN raw_products p ON o.product_id = p.product_id GROUP BY category"
)


def _raw_issues(dataset: str, rule: str, column: str) -> str:
    return _raw(_issue_rows(dataset, "raw", (rule, column)), dataset)


ORACLE = {
    "required_issues": _raw_issues("customers", "required_column", "full_name"),
    "unique_issues": _raw_issues("orders", "unique_column", "order_id"),
    "unique_lineitem_key": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE (l_orderkey, l_linenumber) IN (
  SELECT (l_orderkey, l_linenumber) FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
    "date_issues": _raw_issues("orders", "date_format", "order_date"),
    "numeric_issues": _raw_issues("orders", "numeric_min_value", "quantity"),
    "numeric_min_acctbal": """
SELECT *, 'customer' AS dataset_name, 'numeric_min_value' AS rule_name,
       'c_acctbal' AS column_name, 'ERROR' AS severity,
       'Column ''c_acctbal'' must be numeric and >= 0.' AS message
FROM customer WHERE c_acctbal IS NULL OR isnan(c_acctbal) OR c_acctbal < 0""",
    "email_issues": _raw_issues("customers", "email_format", "email"),
    "fk_customer_issues": _raw_issues("orders", "foreign_key", "customer_id"),
    "fk_product_issues": _raw_issues("orders", "foreign_key", "product_id"),
    **{
        f"normalize_{name}": _norm(f"SELECT {COLUMNS[name]} FROM norm_{name}") for name in COLUMNS
    },
    "typed_customers": _with(NORMALIZED)
    + f"SELECT *, {_key('customer_id')} AS customer_id_int FROM raw_customers",
    "typed_products": _with(NORMALIZED)
    + f"SELECT *, {_key('product_id')} AS product_id_int, {_number('price')} AS price_double "
    "FROM raw_products",
    "typed_orders": _with(_TYPED_ORDERS) + "SELECT * FROM typed_orders",
    **{f"issues_{name}": _norm(_issue_rows(name, "norm"), name) for name in COLUMNS},
    "issues_orders_date_text": _norm(_issue_rows("orders", "text"), "orders", form="text"),
    "issues_all": _norm(_all_issues("norm"), *COLUMNS),
    "preset_issues": _raw(_all_issues("raw"), *COLUMNS),
    "quality_summary": _norm(_summary("norm"), *COLUMNS),
    "quality_summary_date_text": _norm(_summary("text"), *COLUMNS, form="text"),
    **{
        f"clean_{name}": _norm(
            f"SELECT {COLUMNS[name]} FROM norm_flags_{name} WHERE NOT {_rejected(name)}", name
        )
        for name in COLUMNS
    },
    "clean_customers_errors_only": _norm(
        f"SELECT {COLUMNS['customers']} FROM norm_flags_customers "
        f"WHERE NOT {_rejected('customers', errors_only=True)}",
        "customers",
    ),
    **{
        f"rejected_{name}": _norm(
            f"SELECT {COLUMNS[name]} FROM norm_flags_{name} WHERE {_rejected(name)}", name
        )
        for name in COLUMNS
    },
    "daily_sales_kpi": _on_clean(_daily("clean_orders")),
    "category_sales_summary": _on_clean(_category("clean_orders", "clean_products")),
    "customer_country_summary": _on_clean(_country("clean_orders", "clean_customers")),
    "raw_daily_sales_kpi": _norm(_daily("norm_orders")),
    "raw_category_sales_summary": _norm(_category("norm_orders", "norm_products")),
    "raw_customer_country_summary": _norm(_country("norm_orders", "norm_customers")),
    "clean_orders_by_id": _on_checked("SELECT * FROM passed"),
    "rejected_by_reason_rows": _on_checked("SELECT * FROM first_rows"),
    "rejection_reason_summary": _on_checked(
        "SELECT rejection_reason, count(order_id) AS rejected_record_count "
        "FROM first_rows GROUP BY rejection_reason"
    ),
    "daily_sales": _on_checked(
        f"SELECT order_date_parsed, count(order_id) AS order_count, {_TYPED_SALES} "
        "FROM passed GROUP BY order_date_parsed"
    ),
    "category_sales": _CATEGORY_SALES,
    "csv_roundtrip_clean_orders": _on_clean("SELECT * FROM clean_orders"),
    "csv_quality_run_summary": _norm(_summary("norm"), *COLUMNS),
    "orders_job_category_sales": _CATEGORY_SALES,
    "serving_country_view": _on_clean(_country("clean_orders", "clean_customers")),
}

ORACLE["rejected_orders_other_severity"] = f"""
SELECT * FROM ({ORACLE["normalize_orders"]}) AS orders WHERE quantity IS NULL OR quantity < 1"""

ORACLE["extra_columns_pass_through"] = f"""
SELECT *, 'm' AS memo__text, 'i' AS issues, 1 AS row_count, 2 AS known_key
FROM ({ORACLE["clean_orders"]}) AS orders"""

_ALL = list(COLUMNS)
ORACLE |= {
    "zone_tables": _on_clean(
        " UNION ALL ".join(
            f"SELECT 'clean_{name}' AS table_name, '{COLUMNS[name].replace(', ', ',')}' AS header, "
            f"count(*) AS n_rows, count(DISTINCT {COLUMNS[name].split(', ')[0]}) AS n_ids FROM clean_{name}"
            for name in _ALL
        )
    ),
    "catalog_daily_view": ORACLE["daily_sales_kpi"],
    "catalog_category_view": ORACLE["category_sales_summary"],
    "catalog_country_view": ORACLE["customer_country_summary"],
    "csv_all_issues_report": ORACLE["issues_all"],
    "quality_run_row_counts": _norm(
        " UNION ALL ".join(
            f"SELECT '{name}' AS dataset_name, count(*) FILTER (WHERE NOT {_rejected(name)}) AS clean, "
            f"count(*) FILTER (WHERE {_rejected(name)}) AS rejected FROM norm_flags_{name}"
            for name in _ALL
        ),
        *_ALL,
    ),
    "csv_job_clean_orders": ORACLE["clean_orders_by_id"],
    "csv_job_rejected_orders": ORACLE["rejected_by_reason_rows"],
    "csv_job_daily_sales": ORACLE["daily_sales"],
    "csv_job_reason_summary": ORACLE["rejection_reason_summary"],
    "yaml_rules_issues": ORACLE["issues_all"],
    "loaded_datasets_summary": ORACLE["quality_summary"],
    "null_tokens_orders": _norm(
        "SELECT order_id, customer_id, CASE WHEN order_id LIKE '%1' THEN NULL ELSE product_id END AS product_id, "
        "CASE WHEN order_id LIKE '%5' THEN NULL ELSE order_date END AS order_date, "
        "CASE WHEN order_id LIKE '%3' THEN NULL ELSE quantity END AS quantity, total_amount, "
        "CASE WHEN order_id LIKE '%7' THEN NULL ELSE currency END AS currency FROM norm_orders"
    ),
    "normalize_orders_other_dates": ORACLE["normalize_orders"],
}
