from siftwork.functions.casts import (
    to_date,
    to_id,
    to_integer,
    to_key,
    to_number,
    vote_date_formats,
)
from siftwork.functions.text import (
    is_blank,
    is_malformed_email,
    lower,
    strip,
    title_case,
    upper,
)

__all__ = [
    "is_blank",
    "is_malformed_email",
    "lower",
    "strip",
    "title_case",
    "to_date",
    "to_id",
    "to_integer",
    "to_key",
    "to_number",
    "upper",
    "vote_date_formats",
]
