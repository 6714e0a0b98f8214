"""Normalisers: tidy text, typed numbers, dates and keys, in place."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions import lower, strip, title_case, to_date, to_id, to_number, upper, vote_date_formats
from siftwork.functions.casts import DEFAULT_DATE_FORMATS
from siftwork.operators.rules import DATE_TEXT, check_reserved

Cleaner = Callable[[Column], Column]


def _strip_lower(column: Column) -> Column:
    return lower(strip(column))


def _strip_upper(column: Column) -> Column:
    return upper(strip(column))


def _strip_title(column: Column) -> Column:
    return title_case(strip(column))


TEXT_CLEANERS: dict[str, dict[str, Cleaner]] = {
    "customers": {"full_name": strip, "email": _strip_lower, "country": _strip_upper},
    "products": {"product_name": strip, "category": _strip_title, "price": to_number},
    "orders": {"currency": _strip_upper, "quantity": to_number, "total_amount": to_number},
}
DATE_COLUMNS = {"customers": ["registration_date"], "products": [], "orders": ["order_date"]}
KEY_COLUMNS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id", "customer_id", "product_id"],
}


def normalize(
    df: DataFrame,
    dataset: str,
    *,
    date_formats: Sequence[str] | Mapping[str, Sequence[str]] = DEFAULT_DATE_FORMATS,
    text_keys: bool = False,
    keep_date_text: bool = False,
) -> DataFrame:
    """Normalise one dataset read as text. Further columns pass through as they are.

    Keys are text and none is lost: whole numbers in their plain form, all others, and with
    ``text_keys`` every one, as written. With ``keep_date_text`` the text
    of each date stays beside it, so that the date rule can judge what was written; without
    it an unreadable date is simply missing. ``date_formats`` may name forms by column, as
    ``voted_formats`` finds them.
    """
    check_reserved(df)
    changed = {name: clean(F.col(name)) for name, clean in TEXT_CLEANERS[dataset].items()}
    for name in DATE_COLUMNS[dataset]:
        formats = date_formats[name] if isinstance(date_formats, Mapping) else date_formats
        changed[name] = to_date(F.col(name), formats)
        if keep_date_text:
            changed[DATE_TEXT + name] = F.col(name)
    if not text_keys:
        changed.update({name: to_id(F.col(name)) for name in KEY_COLUMNS[dataset]})
    return df.withColumns(changed)


def voted_formats(df: DataFrame, dataset: str, **options: object) -> dict[str, tuple[str]]:
    """The form of each date column of a dataset, as its values vote for it."""
    return vote_date_formats(df, DATE_COLUMNS[dataset], **options)


def normalize_all(datasets: Mapping[str, DataFrame], **options: object) -> dict[str, DataFrame]:
    return {name: normalize(df, name, **options) for name, df in datasets.items()}
