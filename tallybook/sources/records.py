"""Typed job records, from raw text fields or from a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.parse import amount_scale, parse_text
from tallybook.functions.text import is_blank, trim_field
from tallybook.sources.delimited import BROKEN_LINE, ORDER

READ_ERROR = "read_error"
RAW = "raw"
SCALE = "_scale"


@dataclass(frozen=True)
class Field:
    """One input column: its name and how its trimmed text becomes a value.

    ``optional`` lets a blank through as null. ``amount`` adds the scale of the number as written
    (``<name>_scale``) for keys that tell ``700`` from ``700.00``.
    """

    name: str
    parse: Callable[[Column], Column] = parse_text
    optional: bool = False
    amount: bool = False


def parse_records(lines: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Raw text columns to typed columns plus ``read_error`` (a code or null) and ``raw`` (the bad record)."""
    names = [field.name for field in fields]
    broken = F.col(BROKEN_LINE) if BROKEN_LINE in lines.columns else F.lit(None).cast("string")
    texts = lines.select(ORDER, *[trim_field(F.col(name)).alias(name) for name in names], broken.alias(BROKEN_LINE))
    # Parsing one struct per line and unfolding it keeps Spark from repeating the parsers inside every filter
    # on their results.
    values = [field.parse(F.col(field.name)).alias(f"_{field.name}") for field in fields]
    values += [amount_scale(F.col(field.name)).alias(field.name + SCALE) for field in fields if field.amount]
    parsed = texts.select("*", F.inline(F.array(F.struct(*values))))
    checks = [F.when(F.col(BROKEN_LINE).isNotNull(), "UNREADABLE_LINE")]
    for field in fields:
        if field.parse is not parse_text:
            bad = F.col(f"_{field.name}").isNull()
            if field.optional:
                bad = bad & ~is_blank(F.col(field.name))
            checks.append(F.when(bad, f"UNREADABLE_{field.name.upper()}"))
    judged = parsed.withColumn(READ_ERROR, F.coalesce(*checks))
    bad_record = F.coalesce(BROKEN_LINE, F.to_json(F.struct(*names)))
    return judged.select(
        ORDER,
        *[F.col(f"_{name}").alias(name) for name in names],
        *[field.name + SCALE for field in fields if field.amount],
        READ_ERROR,
        F.when(F.col(READ_ERROR).isNotNull(), bad_record).alias(RAW),
    )


def table_records(table: DataFrame, order: str, columns: Mapping[str, Column]) -> DataFrame:
    """Typed columns of a table as job records; ``order`` names a unique column that gives the record order.

    They have no scales of amounts: all values of a typed column are written with the same fraction digits.
    """
    nothing = F.lit(None).cast("string")
    return table.select(
        F.col(order).alias(ORDER),
        *[column.alias(name) for name, column in columns.items()],
        nothing.alias(READ_ERROR),
        nothing.alias(RAW),
    )
