from __future__ import annotations

from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.functions import money, parse
from tallybook.functions.text import canon, is_blank, trim_field


def evaluate(spark, values, *columns):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    found = rows.select("i", *[column.alias(f"x{n}") for n, column in enumerate(columns)]).orderBy("i").collect()
    return [tuple(row)[1] if len(columns) == 1 else tuple(row)[1:] for row in found]


C = "c"


def test_trim_and_canon(spark):
    values = ["  Debito\t", "\x00\x1f CREDITO \r\n", "a b", "", " \t ", None, "ÁRBOL "]
    assert evaluate(spark, values, trim_field(F.col(C))) == ["Debito", "CREDITO", "a b", "", "", None, "ÁRBOL"]
    assert evaluate(spark, values, canon(F.col(C))) == ["debito", "credito", "a b", "", "", None, "árbol"]


def test_blank_includes_wide_white_space(spark):
    values = [None, "", " \t", " ", " x", "x", " "]
    assert evaluate(spark, values, is_blank(F.col(C))) == [True, True, True, True, False, False, False]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-05", date(2024, 1, 5)),
        ("2024/01/05", date(2024, 1, 5)),
        ("2024/01-05", date(2024, 1, 5)),
        ("  2024-01-05 \t", date(2024, 1, 5)),
        ("2024-02-29", date(2024, 2, 29)),
        ("2023-02-29", None),
        ("2024-02-30", None),
        ("2024-1-5", None),
        ("2024-01", None),
        ("2024-01-05T10:00", None),
        ("05-01-2024", None),
        ("20240105", None),
        ("", None),
        (None, None),
        ("x", None),
    ],
)
def test_parse_date(spark, text, expected):
    assert evaluate(spark, [text], parse.parse_date(trim_field(F.col(C)))) == [expected]


def test_parse_whole_numbers(spark):
    values = ["5", "+5", "-5", " 5 ", "5.0", "5x", "", None, "9223372036854775808", "2147483648"]
    assert evaluate(spark, values, parse.parse_long(trim_field(F.col(C)))) == [5, 5, -5, 5, None, None, None, None, None, 2147483648]
    assert evaluate(spark, values, parse.parse_int(trim_field(F.col(C)))) == [5, 5, -5, 5, None, None, None, None, None, None]


def test_parse_amount(spark):
    values = ["100", "1E2", "-5.50", ".5", "1.", "+3", "abc", "", None, "1,5", "0.123456789", "1E-9", "1.500000000"]
    expected = [100, 100, Decimal("-5.5"), Decimal("0.5"), 1, 3, None, None, None, None]
    expected += [Decimal("0.123456789"), Decimal("1E-9"), Decimal("1.5")]
    assert evaluate(spark, values, parse.parse_amount(F.col(C))) == expected
    assert evaluate(spark, ["1e", "e1", ".", "+", "1e99999999999", "NaN"], parse.parse_amount(F.col(C))) == [None] * 6


@pytest.mark.parametrize(
    "text",
    [
        "0.00499999999999999999999",
        "0.00500000000000000000001",
        "-0.005000000000000000000",
        "-0.00500000000000000000001",
        "12345.67499999999999999999e-2",
        "0.000000000000000000000000000000001",
        "-1e-400",
        "1.0049999999999999999999999999999999999999999999",
        "123456789012345678901e-23",
        "7.5e-30",
    ],
)
def test_long_amounts_round_and_compare_as_a_whole(spark, text):
    value = parse.parse_amount(F.col(C))
    cents, sign = evaluate(spark, [text], F.round(value, 2), F.signum(value))[0]
    number = Decimal(text)
    assert cents == number.quantize(Decimal("0.01"), ROUND_HALF_UP) and sign == (number > 0) - (number < 0)


def test_amounts_too_large_for_the_type(spark):
    values = ["1" * 24, "-1e30", "1e16", "9999999999999999", "-" + "9" * 30 + "." + "1" * 40]
    large = Decimal(parse.TOO_LARGE)
    assert evaluate(spark, values, parse.parse_amount(F.col(C))) == [
        large, large.copy_negate(), large, 9999999999999999, large.copy_negate()
    ]


def test_value_and_scale_tell_literals_apart(spark):
    values = ["700", "0700", "700.00", "+700", "1E2", "100", "-0", "0", "0.0", "-.50", "1.e1", "1E+2"]
    found = evaluate(spark, values, parse.parse_amount(F.col(C)), parse.amount_scale(F.col(C)))
    assert found == [
        (700, 0), (700, 0), (700, 2), (700, 0), (100, -2), (100, 0),
        (0, 0), (0, 0), (0, 1), (Decimal("-0.5"), 2), (10, -1), (100, -2),
    ]


number_text = st.builds(
    lambda sign, whole, frac, exp: f"{sign}{whole}{'.' + frac if frac is not None else ''}{exp}",
    st.sampled_from(["", "+", "-"]),
    st.from_regex(r"[0-9]{1,9}", fullmatch=True),
    st.none() | st.from_regex(r"[0-9]{0,8}", fullmatch=True),
    st.sampled_from(["", "E0", "e1", "E+2", "e-1", "E-3"]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(number_text, min_size=40, max_size=40))
def test_value_and_scale_match_decimal(spark, texts):
    found = evaluate(spark, texts, F.col(C).try_cast("decimal(38,14)"), parse.amount_scale(F.col(C)))
    for text, (value, scale) in zip(texts, found, strict=True):
        number = Decimal(text)
        assert (value, -scale) == (number, number.as_tuple().exponent), text


@pytest.mark.parametrize(
    "balance, rate, interest, total",
    [
        ("0.50", "0.0100", "0.01", "0.51"),
        ("3.00", "0.0150", "0.05", "3.05"),
        ("0.4999", "0.0100", "0.00", "0.50"),
        ("5000", "0.0100", "50.00", "5050.00"),
        ("1.005", "0.0100", "0.01", "1.02"),
    ],
)
def test_interest_rounds_half_up(spark, balance, rate, interest, total):
    row = spark.range(1).select(
        money.interest(F.lit(Decimal(balance)), F.lit(Decimal(rate))).alias("i"),
        money.balance_after(F.lit(Decimal(balance)), F.lit(Decimal(rate))).alias("t"),
    )
    assert tuple(row.first()) == (Decimal(interest), Decimal(total))
