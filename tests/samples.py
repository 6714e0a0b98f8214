"""Sample tables made by a rule, and what is wrong with them, worked out in plain Python."""

from __future__ import annotations

import csv
import datetime
import io
from collections import Counter

COLUMNS = {
    "customers": ["customer_id", "full_name", "email", "country", "registration_date"],
    "products": ["product_id", "product_name", "category", "price"],
    "orders": [
        "order_id", "customer_id", "product_id", "order_date", "quantity", "total_amount", "currency",
    ],
}


def _customer_id(i):
    i -= i % 10 == 9  # every tenth repeats the one before
    return f"K{i}" if i % 9 == 4 else str(4000 + 7 * i)


def _product_id(i):
    return str(60 + 3 * (10 if i == 14 else i))


def _customer(i):
    return {
        "customer_id": _customer_id(i),
        "full_name": None if i % 11 == 3 else f" Person no. {i}" + " " * (i % 2),
        "email": f"p{i}(at)mail" if i % 5 == 3 else f"P{i}@Box.example",
        "country": None if i % 7 == 3 else ("pt", "se", "jp")[i % 3],
        "registration_date": "31/12/20" if i % 8 == 6 else f"2019-{1 + i % 12:02}-11",
    }


def _product(i):
    return {
        "product_id": _product_id(i),
        "product_name": f"Article {i}",
        "category": None if i % 8 == 7 else ("garden tools", "books")[i % 2],
        "price": "-4.5" if i % 6 == 5 else "cheap" if i % 7 == 2 else str(2.5 * i),
    }


def _order(i):
    own = i - (i in (21, 33))  # two orders repeat the one before
    return {
        "order_id": f"R-{own}" if own % 12 == 7 else str(9 * own + 2),
        "customer_id": "31" if i % 13 == 6 else _customer_id(i * 5 % 24),
        "product_id": None if i % 17 == 9 else _product_id(i * 4 % 15),
        "order_date": "soon" if i % 14 == 5 else f"2024-02-{1 + i % 6:02}",
        "quantity": "0" if i % 15 == 8 else None if i % 19 == 10 else str(1 + i % 4),
        "total_amount": "-1" if i % 16 == 8 else str(12.5 * i),
        "currency": ("eur", " EUR ")[i % 2],
    }


TABLES = {
    "customers": [_customer(i) for i in range(24)],
    "products": [_product(i) for i in range(15)],
    "orders": [_order(i) for i in range(40)],
}


def as_csv(name):
    out = io.StringIO()
    writer = csv.DictWriter(out, COLUMNS[name], lineterminator="\n")
    writer.writeheader()
    writer.writerows(TABLES[name])
    return out.getvalue()


def number(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def day(text):
    try:
        return datetime.date.fromisoformat(text)
    except (TypeError, ValueError):
        return None


def below(text, bound):
    return number(text) is None or number(text) < bound


def values(name, column):
    return [row[column] for row in TABLES[name]]


def _found(name, row, column, other):
    return row[column] in values(other, column)


def broken_rules(name, row, date_text=False):
    """The (rule, column) pairs of the built-in rules that a sample row breaks."""
    required = {
        "customers": ["customer_id", "full_name", "country"],
        "products": ["product_id", "product_name", "category"],
        "orders": ["order_id", "customer_id", "product_id"],
    }[name]
    key = required[0]
    broken = [("required_column", c) for c in required if not (row[c] or "").strip()]
    if values(name, key).count(row[key]) > 1:
        broken.append(("unique_column", key))
    if name == "customers":
        if date_text and day(row["registration_date"]) is None:
            broken.append(("date_format", "registration_date"))
        if "@" not in row["email"]:
            broken.append(("email_format", "email"))
    if name == "products" and below(row["price"], 0):
        broken.append(("numeric_min_value", "price"))
    if name == "orders":
        if date_text and day(row["order_date"]) is None:
            broken.append(("date_format", "order_date"))
        for column, bound in (("quantity", 1), ("total_amount", 0)):
            if below(row[column], bound):
                broken.append(("numeric_min_value", column))
        for column, other in (("customer_id", "customers"), ("product_id", "products")):
            if not _found(name, row, column, other):
                broken.append(("foreign_key", column))
    return broken


def split(name, errors_only=False, date_text=False):
    """Clean and rejected sample rows."""
    clean, rejected = [], []
    for row in TABLES[name]:
        rules = {rule for rule, _ in broken_rules(name, row, date_text)}
        (rejected if rules - ({"email_format"} if errors_only else set()) else clean).append(row)
    return clean, rejected


def rule_counts(name, date_text=False):
    return Counter(hit for row in TABLES[name] for hit in broken_rules(name, row, date_text))


def order_reasons(row):
    """The reasons for which the orders job rejects a sample order."""
    checks = {
        "duplicate_order_id": values("orders", "order_id").count(row["order_id"]) > 1,
        "invalid_quantity": below(row["quantity"], 1),
        "invalid_total_amount": below(row["total_amount"], 0),
        "invalid_order_date": day(row["order_date"]) is None,
        "invalid_customer_fk": not _found("orders", row, "customer_id", "customers"),
        "invalid_product_fk": not _found("orders", row, "product_id", "products"),
    }
    return [reason for reason, hit in checks.items() if hit]


def sales(pairs):
    """{group: (orders, quantity, revenue)} of (group, order) pairs."""
    totals = {}
    for group, row in pairs:
        n, quantity, revenue = totals.get(group, (0, 0.0, 0.0))
        totals[group] = (n + 1, quantity + float(row["quantity"]), revenue + float(row["total_amount"]))
    return totals
