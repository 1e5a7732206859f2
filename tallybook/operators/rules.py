"""Ordered validation rules: the first one that fails decides."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.text import is_blank

ACCEPTED = "ACCEPTED"
SKIPPED = "SKIPPED"
FILTERED = "FILTERED"
READ_ERROR = "READ_ERROR"
DUPLICATE = "DUPLICATE"


@dataclass(frozen=True)
class Rule:
    """Records for which a test is true get ``reason``; ``detail`` tells the offending value.

    ``fails`` is one test, or several of which any decides.
    """

    reason: str
    fails: Column | Sequence[Column]
    outcome: str = SKIPPED
    detail: Column | None = None

    @property
    def tests(self) -> Sequence[Column]:
        return [self.fails] if isinstance(self.fails, Column) else self.fails

    @property
    def test(self) -> Column:
        return reduce(or_, self.tests)


def classify(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reason``: that of the first failing rule, null when none fails. One projection, no shuffle."""
    reasons = [F.when(rule.test, F.lit(rule.reason)) for rule in rules]
    return df.withColumn("reason", F.coalesce(*reasons, F.lit(None).cast("string")))


def outcome(rules: Sequence[Rule], reason: Column, unreadable: Column) -> Column:
    """The outcome that belongs to a reason."""
    filtered = [rule.reason for rule in rules if rule.outcome == FILTERED]
    choice = F.when(unreadable, READ_ERROR).when(reason.isNull(), ACCEPTED)
    if filtered:
        choice = choice.when(reason.isin(filtered), FILTERED)
    return choice.otherwise(SKIPPED)


def detail(rules: Sequence[Rule], reason: Column) -> Column:
    """The detail text of the rule that decided."""
    texts = [F.when(reason == rule.reason, rule.detail) for rule in rules if rule.detail is not None]
    return F.coalesce(*texts, F.lit(None).cast("string"))


def missing(*columns: str, text: Sequence[str] = ()) -> tuple[list[Column], Column]:
    """Tests and detail text for required columns; those in ``text`` must not be blank either."""
    tests = {name: F.col(name).isNull() for name in columns} | {name: is_blank(F.col(name)) for name in text}
    names = F.concat_ws(", ", *[F.when(test, F.lit(name)) for name, test in tests.items()])
    return list(tests.values()), F.concat(F.lit("missing: "), names)
