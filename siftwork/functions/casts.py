"""Casts from text that give null, never an error, for unreadable values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_DATE_FORMATS = ("yyyy-M-d",)
#: In place of date formats: find each column's own among the candidates.
VOTE = "vote"
#: Forms that a column may vote for, the more usual ones first.
DATE_FORM_CANDIDATES = ("yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "d.M.yyyy", "yyyy/M/d", "yyyyMMdd", "d-M-yyyy")

_ASCII_BLANKS = "\t\n\x0b\x0c\r "
# try_cast also reads Java forms such as 1d, 0x1p3 or NaN; these are not numbers here.
_NUMBER_LETTERS = "0123456789+-.eE" + _ASCII_BLANKS
_INFINITIES = [sign + word for sign in ("", "+", "-") for word in ("inf", "infinity")]
_WHOLE_NUMBER = r"^([+-]?[0-9]+)\.0*$"

# A shape test and a cast take half the time of a parse by format.
_ISO_SHAPES = {
    "yyyy-M-d": r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$",
    "yyyy-MM-dd": r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}$",
}


def to_number(column: Column) -> Column:
    """Text to double. Junk and NaN give null, literals beyond all doubles give infinity."""
    only_numeric = F.translate(column, _NUMBER_LETTERS, "") == ""
    infinite = F.lower(F.btrim(column, F.lit(_ASCII_BLANKS))).isin(_INFINITIES)
    return F.when(only_numeric | infinite, column).try_cast("double")


def to_integer(column: Column) -> Column:
    """Text to bigint; ``1.0`` and junk give null."""
    return column.try_cast("bigint")


def to_key(column: Column) -> Column:
    """Text to a bigint key; ``7.0`` is the key 7, as tables with gaps print it."""
    whole = F.regexp_extract(F.btrim(column, F.lit(_ASCII_BLANKS)), _WHOLE_NUMBER, 1)
    return F.coalesce(to_integer(column), to_integer(whole))


def to_id(column: Column) -> Column:
    """Ids as text: whole numbers in their plain form, so that ``7.0`` meets 7, others as written."""
    return F.coalesce(to_key(column).cast("string"), column.cast("string"))


def to_date(column: Column, formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """Text to date by the first of ``formats`` that fits the whole value."""
    return F.coalesce(*[_parse_date(column, fmt) for fmt in formats])


def vote_date_formats(
    df: DataFrame, columns: Sequence[str], candidates: Sequence[str] = DATE_FORM_CANDIDATES
) -> dict[str, tuple[str]]:
    """Per text column, the one form that reads most of its values; ties go to the earlier one.

    A single aggregate over all rows, merged on the map side. A column that no form reads gets
    the first one.
    """
    if not columns:
        return {}
    read = df.agg(
        *[
            F.count(_parse_date(F.col(f"`{name}`"), fmt)).alias(f"{i}_{j}")
            for i, name in enumerate(columns)
            for j, fmt in enumerate(candidates)
        ]
    ).first()
    votes = {name: [read[f"{i}_{j}"] for j in range(len(candidates))] for i, name in enumerate(columns)}
    return {name: (candidates[counts.index(max(counts))],) for name, counts in votes.items()}


def _parse_date(column: Column, fmt: str) -> Column:
    if fmt in _ISO_SHAPES:
        return F.when(column.rlike(_ISO_SHAPES[fmt]), column).try_cast("date")
    return F.try_to_date(column, fmt)
