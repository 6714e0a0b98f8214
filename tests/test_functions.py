from __future__ import annotations

import math
import re

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from siftwork.functions import (
    is_blank,
    is_malformed_email,
    strip,
    title_case,
    to_date,
    to_integer,
    to_key,
    to_number,
)
from siftwork.functions.text import WHITESPACE


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string").coalesce(1)
    rows = df.select("i", expression(F.col("s")).alias("r")).collect()
    return [row.r for row in sorted(rows, key=lambda row: row.i)]


def test_whitespace_is_all_white_space():
    assert sorted(WHITESPACE) == [chr(c) for c in range(0x110000) if chr(c).isspace()]


def test_strip_removes_every_kind_of_white_space(spark):
    values = [f"{c}a {c} b{c}" for c in WHITESPACE] + ["", " \t\n", "x", None, "​x​"]
    assert column(spark, values, strip) == [v if v is None else v.strip() for v in values]


def test_title_case_restarts_after_any_other_character(spark):
    values = ["home-goods don't o2b", "ELECTRONICS", "a_b  c", "", None, "straße ßa ﬁx", "ǆabc x中b"]
    assert column(spark, values, title_case) == [v if v is None else v.title() for v in values]


def test_title_case_over_many_characters(spark):
    # Letters that every supported Java version knows.
    values = [f"x{chr(c)}Yz {chr(c)}Ab'c" for c in range(1, 0x1C80) if c not in (0x19B, 0x264, 0x10FC)]
    expected = [v.title() for v in values]
    wrong = [v for v, a, b in zip(values, column(spark, values, title_case), expected) if a != b]
    assert wrong == []


def test_blank(spark):
    values = ["", "  ", "　", "a", None]
    assert column(spark, values, is_blank) == [True, True, True, False, True]


def test_email_shape_agrees_with_the_regular_expression(spark):
    shape = re.compile(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")
    values = ["a@b.c", "a@b", "a@@b.c", "@b.c", "a@.c", "a@b.", "a@b..c", "", "  ", " a@b.c ", None]
    values += [f"a{c}b@c.d" for c in WHITESPACE] + [f"ab@c.d{c}" for c in WHITESPACE]
    expected = [
        v is not None and v.strip() != "" and not shape.match(v.strip()) for v in values
    ]
    assert column(spark, values, is_malformed_email) == expected


NUMBERS = (
    "inf Infinity -inf iNf +inf nan NaN 1d 1f 1_0 1,000 1e 1e5 1E+5 . -.5 +5 5. 0x10 0x1p3 --1 "
    "True 1e5.5 1 -0 007 1.5.2 1e-3 two n.a Inf1 १"
).split() + ["", " ", " 1", "1 ", "\t1\n", "\xa01", "- 1", "1 2", None]


def same_numbers(got, expected):
    """Equal up to the last bits, which the parser of pandas gets wrong for some exponents."""
    return all(
        pd.isna(b) if a is None else not pd.isna(b) and math.isclose(a, b, rel_tol=1e-14)
        for a, b in zip(got, expected, strict=True)
    )


def test_numbers_agree_with_pandas(spark):
    expected = pd.to_numeric(pd.Series(NUMBERS + ["x"], dtype=object), errors="coerce")
    assert same_numbers(column(spark, NUMBERS, to_number), list(expected)[:-1])


@settings(max_examples=5, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet="0123456789+-.eEdf xn", max_size=8), min_size=50, max_size=200))
def test_random_number_texts_agree_with_pandas(spark, values):
    values = [v for v in values if not re.search(r"[eE]\d{3}", v)]
    expected = pd.to_numeric(pd.Series(values + ["x"], dtype=object), errors="coerce")
    assert same_numbers(column(spark, values, to_number), list(expected)[:-1])


def test_keys_and_integers(spark):
    values = ["7", "7.0", " 7 ", "7.5", "x", "", None, "-3", "9223372036854775808", "7.", "+4"]
    assert column(spark, values, to_key) == [7, 7, 7, None, None, None, None, -3, None, 7, 4]
    assert column(spark, ["7", "7.0", "x"], to_integer) == [7, None, None]


def test_dates(spark):
    values = ["2023-08-01", "2023-8-1", "2023-02-30", "2023-08-01 10:00", " 2023-08-01", "x", None]
    values += ["0000-01-01", "20230801", "2023-08", "2023-08-01T10:00:00", "2024-02-29"]
    lenient = [str(d) if d else None for d in column(spark, values, to_date)]
    assert lenient == ["2023-08-01", "2023-08-01"] + [None] * 9 + ["2024-02-29"]
    strict = column(spark, values, lambda c: to_date(c, ("yyyy-MM-dd",)))
    assert [str(d) if d else None for d in strict] == ["2023-08-01"] + [None] * 10 + ["2024-02-29"]
    several = column(
        spark, ["01/02/2023", "2023-02-01"], lambda c: to_date(c, ("yyyy-M-d", "dd/MM/yyyy"))
    )
    assert [str(d) for d in several] == ["2023-02-01", "2023-02-01"]


def test_shape_and_cast_agree_with_a_parse_by_format(spark):
    values = [f"20{y:02d}-{m}-{d}" for y in (0, 23, 24) for m in range(14) for d in range(33)]
    values += [f"20{y:02d}-{m:02d}-{d:02d}" for y in (0, 23) for m in range(14) for d in range(33)]
    for fmt in ("yyyy-M-d", "yyyy-MM-dd"):
        assert column(spark, values, lambda c: to_date(c, (fmt,))) == column(
            spark, values, lambda c: F.try_to_date(c, fmt)
        )
