"""Quality gates: what makes a run fail, and where a failed run would have stopped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tallybook.operators.numbering import number_rows
from tallybook.operators.repeats import mark_repeats
from tallybook.operators.rules import ACCEPTED, READ_ERROR, SKIPPED

MAX_REJECTS = 50

# Up to this limit the skips before a position are found by a top-n, which holds that many positions in one task.
TOP_SKIPS = 100_000


class GateFailure(Exception):
    """A run that must not be published."""


class UnreadableInput(GateFailure):
    pass


class ContractBroken(GateFailure):
    pass


class RejectLimitExceeded(GateFailure):
    pass


def check_counts(counts: dict[str, int], max_rejects: int | None) -> GateFailure | None:
    """The failure that the counters of a run show, if any; filtered records are not rejects."""
    if counts["unreadable"]:
        return UnreadableInput(f"{counts['unreadable']} unreadable records")
    if counts["violations"]:
        return ContractBroken(f"{counts['violations']} accepted records break the table contract")
    if max_rejects is not None and counts["skipped"] > max_rejects:
        return RejectLimitExceeded(f"{counts['skipped']} records skipped, limit {max_rejects}")
    return None


def prefix_end(verdicts: DataFrame, primary_key: Sequence[str], max_rejects: int | None) -> object | None:
    """The position of the record that fails the run, null when none does.

    That is the least of: the first unreadable record, the first skip beyond the limit, the first accepted
    record that breaks the contract or repeats a primary key. One position of each kind reaches the driver.
    """
    ends = []
    stops = (F.col("outcome") == READ_ERROR) | F.col("violation").isNotNull()
    ends += _first(verdicts.where(stops))
    if max_rejects is not None:
        ends += _skip_beyond(verdicts.where(F.col("outcome") == SKIPPED).select("ord"), max_rejects)
    if primary_key:
        accepted = verdicts.where(F.col("outcome") == ACCEPTED).select("ord", "reason", *primary_key)
        repeats = mark_repeats(accepted, primary_key, "ord", measure=True).where(F.col("first_ord").isNotNull())
        ends += _first(repeats)
    return min(ends, default=None)


def _skip_beyond(skips: DataFrame, limit: int) -> list:
    """The position of the first skip beyond the limit, if there are so many."""
    if limit >= TOP_SKIPS:
        return _first(number_rows(skips, "ord", "place").where(F.col("place") == limit + 1))
    last = skips.orderBy("ord").limit(limit + 1).agg(F.max("ord").alias("ord"), F.count(F.lit(1)).alias("skips")).first()
    return [last.ord] if last.skips > limit else []


def before(df: DataFrame, end: object | None) -> DataFrame:
    """The rows before a position."""
    if end is None:
        return df
    return df.where(F.col("ord") < _literal(end))


def _first(df: DataFrame) -> list:
    return [row.ord for row in df.select("ord").orderBy("ord").limit(1).collect()]


def _literal(position: object):
    if isinstance(position, Row):
        return F.struct(*[F.lit(value).alias(name) for name, value in position.asDict().items()])
    return F.lit(position)
