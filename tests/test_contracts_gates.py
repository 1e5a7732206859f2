from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.contracts import (
    ColumnContract,
    TableContract,
    contract_violations,
    repeated_primary_keys,
)
from tallybook.operators.gates import (
    ContractBroken,
    RejectLimitExceeded,
    UnreadableInput,
    before,
    check_counts,
    prefix_end,
)

CONTRACT = TableContract(
    "t",
    (
        ColumnContract("k", T.LongType(), required=True),
        ColumnContract("s", T.StringType(), max_length=3),
        ColumnContract("d", T.DecimalType(5, 2), required=True),
        ColumnContract("b", T.BooleanType(), required=True, default=False),
    ),
    primary_key=("k",),
)
ROWS = [
    (1, "abc", Decimal("999.99"), True),
    (None, "añó", Decimal("1"), None),
    (2, "abcd", Decimal("999.994"), None),
    (3, None, Decimal("999.995"), False),
    (3, "long", None, False),
    (3, "x", Decimal("-1000"), False),
]
SCHEMA = "k long, s string, d decimal(30,8), b boolean"


def test_contract_violations(spark):
    found = contract_violations(spark.createDataFrame(ROWS, SCHEMA), CONTRACT).collect()
    assert sorted(map(tuple, found)) == [
        ("d", "NULL_VALUE", 1),
        ("d", "OVERFLOW", 2),
        ("k", "NULL_VALUE", 1),
        ("s", "TOO_LONG", 2),
    ]


def test_first_breach_and_stored_values(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    values = {name: F.col(name) for name in df.columns}
    stored = [column.stored(values[column.name]).alias(column.name) for column in CONTRACT.columns]
    rows = df.select(CONTRACT.breach(values).alias("breach"), *stored).collect()
    assert [row.breach for row in rows] == [
        None, "NULL_VALUE:k", "TOO_LONG:s", "OVERFLOW:d", "TOO_LONG:s", "OVERFLOW:d",
    ]
    assert [row.d for row in rows] == [Decimal("999.99"), Decimal("1.00"), Decimal("999.99"), None, None, None]
    assert [row.b for row in rows] == [True, False, False, False, False, False]


def test_decimals_are_stored_half_up(spark):
    column = ColumnContract("d", T.DecimalType(15, 2))
    rows = spark.createDataFrame([(Decimal(x),) for x in ("700.005", "-0.005", "0.125", "2.675")], "d decimal(30,8)")
    found = [row[0] for row in rows.select(column.stored(F.col("d"))).collect()]
    assert found == [Decimal(x) for x in ("700.01", "-0.01", "0.13", "2.68")]


def test_repeated_primary_keys(spark):
    found = repeated_primary_keys(spark.createDataFrame(ROWS, SCHEMA), ["k"]).collect()
    assert [tuple(row) for row in found] == [(3, 3)]


@pytest.mark.parametrize(
    "skipped, unreadable, violations, limit, failure",
    [
        (50, 0, 0, 50, None),
        (51, 0, 0, 50, RejectLimitExceeded),
        (51, 0, 0, None, None),
        (0, 1, 0, None, UnreadableInput),
        (0, 0, 1, 50, ContractBroken),
    ],
)
def test_check_counts(skipped, unreadable, violations, limit, failure):
    counts = {"skipped": skipped, "unreadable": unreadable, "violations": violations}
    found = check_counts(counts, limit)
    assert found is None if failure is None else isinstance(found, failure)


def verdict_table(spark, outcomes):
    """Rows by order: A accepted, S skipped, F filtered, R unreadable, V breaks the contract, P repeats key 0."""
    names = {"S": "SKIPPED", "F": "FILTERED", "R": "READ_ERROR"}
    rows = []
    for i, letter in enumerate(outcomes):
        outcome = names.get(letter, "ACCEPTED")
        reason = "BAD" if letter in names else None
        rows.append((i, outcome, reason, "X:k" if letter == "V" else None, 0 if letter == "P" else i))
    return spark.createDataFrame(rows, "ord long, outcome string, reason string, violation string, k long")


@pytest.mark.parametrize(
    "outcomes, limit, end",
    [
        ("AASSA", 2, None),
        ("AASSSA", 2, 4),
        ("AFFFFS", 0, 5),
        ("ASRA", 2, 2),
        ("ASARA", 0, 1),
        ("AAVAR", 5, 2),
        ("AAPAP", 5, 2),
        ("ASSA", None, None),
    ],
)
def test_prefix_end(spark, outcomes, limit, end):
    verdicts = verdict_table(spark, outcomes)
    found = prefix_end(verdicts, ["k"], limit)
    assert found == end
    kept = before(verdicts, found).count()
    assert kept == (len(outcomes) if end is None else end)
