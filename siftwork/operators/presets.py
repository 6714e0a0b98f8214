"""The built-in rules for customers, products and orders."""

from __future__ import annotations

from typing import Any

from siftwork.operators.rules import Rule, rules_from_document

# The checks that hold when no rules document is given.
RULES_DOCUMENT: dict[str, dict[str, list[dict[str, Any]]]] = {
    "customers": {
        "required_columns": [
            {"column": "customer_id"},
            {"column": "full_name"},
            {"column": "country"},
        ],
        "unique_columns": [{"column": "customer_id"}],
        "date_columns": [{"column": "registration_date"}],
        "email_columns": [{"column": "email"}],
    },
    "products": {
        "required_columns": [
            {"column": "product_id"},
            {"column": "product_name"},
            {"column": "category"},
        ],
        "unique_columns": [{"column": "product_id"}],
        "numeric_rules": [{"column": "price", "min_value": 0}],
    },
    "orders": {
        "required_columns": [
            {"column": "order_id"},
            {"column": "customer_id"},
            {"column": "product_id"},
        ],
        "unique_columns": [{"column": "order_id"}],
        "date_columns": [{"column": "order_date"}],
        "numeric_rules": [
            {"column": "quantity", "min_value": 1},
            {"column": "total_amount", "min_value": 0},
        ],
        "foreign_keys": [
            {
                "column": "customer_id",
                "reference_dataset": "customers",
                "reference_column": "customer_id",
            },
            {
                "column": "product_id",
                "reference_dataset": "products",
                "reference_column": "product_id",
            },
        ],
    },
}


def preset_rules() -> dict[str, list[Rule]]:
    return rules_from_document(RULES_DOCUMENT)
