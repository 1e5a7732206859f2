"""Field parsers: trimmed text in, typed column out, null where the text does not fit the type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The most fraction digits with which an amount times a rate of decimal(5,4) is still exact.
AMOUNT_TYPE = T.DecimalType(32, 16)
TOO_LARGE = "9" * 16 + "." + "9" * 16
LITERAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_text(text: Column) -> Column:
    return text


def parse_long(text: Column) -> Column:
    return text.try_cast("bigint")


def parse_int(text: Column) -> Column:
    return text.try_cast("int")


def parse_date(text: Column) -> Column:
    """Strict year-month-day; a slash counts as a dash.

    The pattern guard is needed because a plain cast also takes ``2024-1-5`` or ``2024-01``.
    """
    date = F.translate(text, "/", "-")
    return F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}$"), date.try_cast("date"))


def parse_amount(text: Column) -> Column:
    """The decimal of any well-formed literal, null for other text.

    A literal with more fraction digits than the type holds is cut, not rounded, and its last digit made odd-sided
    where something was cut off: so it compares with zero, and rounds half up to fewer digits, as the whole literal
    does. One too large for the type becomes the largest value of its sign, which no table column holds.
    """
    places = amount_scale(text)
    exact = F.when(places <= AMOUNT_TYPE.scale, text.try_cast(AMOUNT_TYPE))
    cut = F.when(places > AMOUNT_TYPE.scale, _cut(text).try_cast(AMOUNT_TYPE))
    largest = F.concat(_sign(text), F.lit(TOO_LARGE)).cast(AMOUNT_TYPE)
    return F.when(text.rlike(LITERAL) & places.isNotNull(), F.coalesce(exact, cut, largest))


def _sign(text: Column) -> Column:
    return F.when(F.left(text, F.lit(1)) == "-", "-").otherwise("")


def _cut(text: Column) -> Column:
    """A long literal as text without exponent, cut to the fraction digits of the type."""
    number, exponent = _split_exponent(text)
    number = F.translate(number, "+-", "")
    whole = F.substring_index(number, ".", 1)
    digits = F.translate(number, ".", "")
    point = F.length(whole) + exponent
    # digits beyond the places kept only matter by being there, so more zeros than this change nothing
    zeros = F.repeat(F.lit("0"), F.least(F.greatest(-point, F.lit(0)), F.lit(2 * AMOUNT_TYPE.scale)))
    at = F.greatest(point, F.lit(0))
    left = F.when(at > 0, F.substring(digits, F.lit(1), at)).otherwise("0")
    fraction = F.concat(zeros, F.substring(digits, at + 1, F.length(digits)))
    kept, last = F.left(fraction, F.lit(AMOUNT_TYPE.scale - 1)), F.substring(fraction, AMOUNT_TYPE.scale, 1)
    more = F.substring(fraction, F.lit(AMOUNT_TYPE.scale + 1), F.length(fraction)).rlike("[1-9]")
    last = F.when(more & last.isin("0", "5"), (last.cast("int") + 1).cast("string")).otherwise(last)
    return F.concat(_sign(text), left, F.lit("."), kept, last)


def _split_exponent(text: Column) -> tuple[Column, Column]:
    mark = F.instr(F.lower(text), "e")
    exponent = F.substring(text, mark + 1, F.length(text)).try_cast("int")
    return F.when(mark == 0, text).otherwise(F.left(text, mark - 1)), F.when(mark == 0, 0).otherwise(exponent)


def amount_scale(text: Column) -> Column:
    """Fraction digits of the literal, less its exponent: ``1.50`` has 2, ``1E2`` has -2.

    Value and scale together tell literals apart as their text does, up to leading zeros and a plus sign.
    """
    number, exponent = _split_exponent(text)
    return (_fraction_digits(number).cast("bigint") - exponent).try_cast("int")


def _fraction_digits(number: Column) -> Column:
    point = F.instr(number, ".")
    return F.when(point > 0, F.length(number) - point).otherwise(0)
