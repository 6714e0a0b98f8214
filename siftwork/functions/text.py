"""Text columns: stripping, letter case, blank and email tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the accepted email shape. Java's Unicode white space lacks \x1c to \x1f.
# The Unicode flag costs a tenth of what spelling out WHITESPACE in the brackets does.
EMAIL_SHAPE = r"[^@\s\x1c-\x1f]+@[^@\s\x1c-\x1f]+\.[^@\s\x1c-\x1f]+"

_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"
_CASED_RUNS = rf"([{_CASED}]+|[^{_CASED}]+)"


def strip(column: Column) -> Column:
    """Remove white space of any kind from both ends; null stays null."""
    return F.btrim(column, F.lit(WHITESPACE))


def lower(column: Column) -> Column:
    return F.lower(column)


def upper(column: Column) -> Column:
    return F.upper(column)


def title_case(column: Column) -> Column:
    """Capitalise every run of letters, so that ``don't o2b`` gives ``Don'T O2B``.

    ``initcap`` alone restarts after blanks only, hence the split into runs.
    """
    runs = F.regexp_extract_all(column, F.lit(_CASED_RUNS), 1)
    return F.array_join(F.transform(runs, F.initcap), "")


def is_blank(column: Column) -> Column:
    """True for null and for text that holds nothing but white space."""
    return F.coalesce(strip(column.cast("string")) == "", F.lit(True))


def is_malformed_email(column: Column) -> Column:
    """True for text that is neither blank nor an email address; false for null."""
    fine = strip(column).rlike(rf"(?U)^(?:|{EMAIL_SHAPE})$")
    return ~F.coalesce(fine, F.lit(True))
