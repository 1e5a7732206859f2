"""A job as data: how records are checked, keyed and turned into table rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators import rules as R
from tallybook.operators.contracts import TableContract
from tallybook.operators.repeats import keep_first, mark_repeats
from tallybook.operators.rules import Rule
from tallybook.operators.sinks import settle
from tallybook.sources.delimited import ORDER, scan_delimited
from tallybook.sources.records import RAW, READ_ERROR, SCALE, Field, parse_records


@dataclass(frozen=True)
class Job:
    """``prepare`` adds columns the rules need, ``key`` names those that make a repeat, ``values`` fills the table.

    ``rules`` may be replaced or extended by the caller (``dataclasses.replace``).
    """

    name: str
    table: TableContract
    fields: Sequence[Field]
    rules: Sequence[Rule]
    values: Mapping[str, Column]
    prepare: Callable[[DataFrame], DataFrame]
    key: Sequence[str] = ()
    reports: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def read(self, spark: SparkSession, path: str | Sequence[str], stage: bool = True) -> DataFrame:
        """Records of delimited files, parsed once into the shared folder.

        Repeats and ids take several passes, which must agree on the order of records. The order of a file scan
        depends on how its files are split, and that may change with the number of executors between two passes.
        ``stage=False`` gives the scan itself, for work in a single pass (``accepted``, ``outcome_counts``).
        """
        records = parse_records(scan_delimited(spark, path, [item.name for item in self.fields]), self.fields)
        return settle(records, "records") if stage else records

    def repeat_key(self, rows: DataFrame) -> list[str]:
        """The columns that make a repeat; scales of amounts only where the records have them."""
        return [name for name in self.key if name in rows.columns or not name.endswith(SCALE)]

    def classified(self, records: DataFrame) -> DataFrame:
        """Records with ``reason``, before repeats are looked for; no shuffle."""
        unreadable = F.col(READ_ERROR).isNotNull()
        by_rule = R.classify(self.prepare(records), self.rules)
        return by_rule.withColumn("reason", F.when(unreadable, F.col(READ_ERROR)).otherwise(F.col("reason")))

    def valid(self, records: DataFrame) -> DataFrame:
        """The records that pass all rules, repeats included.

        The same as those without a ``reason``, but written as one filter per test: Spark can then simplify them
        and push parts into the scan, where a filter on ``reason`` would evaluate the whole rule list again.
        """
        rows = self.prepare(records).where(F.col(READ_ERROR).isNull())
        for rule in self.rules:
            for test in rule.tests:
                rows = rows.where(~F.coalesce(test, F.lit(False)))
        return rows

    def verdicts(self, records: DataFrame, measure: bool = False) -> DataFrame:
        """Every record once: ``ord, outcome, reason, detail, record, violation`` and the table columns.

        The table columns are null for records that are not accepted. ``detail`` is null for those that are, ``record``
        for those of them that keep the table contract. ``measure`` counts the repeated keys first (see ``mark_repeats``); without it the
        method is lazy.
        """
        rows = self.classified(records)
        if self.key:
            rows = mark_repeats(rows, self.repeat_key(rows), ORDER, measure)
        else:
            rows = rows.withColumn("first_ord", F.lit(None).cast("string"))
        repeats = F.col("first_ord").isNotNull()
        reason = F.when(repeats, R.DUPLICATE).otherwise(F.col("reason"))
        rows = rows.withColumn("reason", reason).withColumn(
            "outcome", R.outcome(self.rules, F.col("reason"), F.col(READ_ERROR).isNotNull())
        )
        accepted = F.col("outcome") == R.ACCEPTED
        detail = F.when(repeats, F.concat(F.lit("repeats the record at "), F.col("first_ord").cast("string")))
        detail = F.coalesce(detail, R.detail(self.rules, F.col("reason")))
        record = F.coalesce(F.col(RAW), F.to_json(F.struct(*[item.name for item in self.fields])))
        violation = F.when(accepted, self.table.breach(self.values))
        return rows.select(
            ORDER,
            "outcome",
            "reason",
            detail.alias("detail"),
            F.when(~accepted | violation.isNotNull(), record).alias("record"),
            violation.alias("violation"),
            *[
                F.when(accepted, column.stored(self.values[column.name])).alias(column.name)
                for column in self.table.given
            ],
        )

    def accepted(self, records: DataFrame) -> DataFrame:
        """The table rows alone, for callers that want no rejects: filters first, one pruned shuffle."""
        rows = self.valid(records)
        if self.key:
            rows = keep_first(rows, self.repeat_key(rows), ORDER)
        return rows.select(
            ORDER, *[column.stored(self.values[column.name]).alias(column.name) for column in self.table.given]
        )

    def rejects(self, records: DataFrame) -> DataFrame:
        """The skip log: everything that is not accepted."""
        return reject_log(self.name, self.verdicts(records))

    def outcome_counts(self, records: DataFrame) -> DataFrame:
        """``(outcome, reason, records)`` by aggregation alone: of n equal keys one is accepted, n - 1 repeat.

        Counts per key are combined before the shuffle, so neither a hot key nor a join matters.
        """
        rows = self.classified(records)
        outcome = R.outcome(self.rules, F.col("reason"), F.col(READ_ERROR).isNotNull())
        rows = rows.withColumn("outcome", outcome)
        if not self.key:
            return rows.groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("records"))
        names = self.repeat_key(rows)
        key = [F.when(F.col("reason").isNull(), F.col(name)).alias(name) for name in names]
        groups = rows.select("outcome", "reason", *key).groupBy("outcome", "reason", *names)
        groups = groups.agg(F.count(F.lit(1)).alias("copies"))
        totals = groups.groupBy("outcome", "reason").agg(
            F.sum("copies").alias("records"), F.count(F.lit(1)).alias("keys")
        )
        kept = F.col("reason").isNull()
        first = F.struct(
            "outcome", "reason", F.when(kept, F.col("keys")).otherwise(F.col("records")).alias("records")
        )
        again = F.struct(
            F.lit(R.SKIPPED).alias("outcome"),
            F.lit(R.DUPLICATE).alias("reason"),
            F.when(kept, F.col("records") - F.col("keys")).otherwise(0).alias("records"),
        )
        return totals.select(F.inline(F.array(first, again))).where("records > 0")


# When a record left the run: while it was read, by a rule, or on its way into the table.
READ, PROCESS, WRITE = "read", "process", "write"
REFUSED = "REFUSED"
REPEATED_KEY = "REPEATED_KEY"
LOG_COLUMNS = (ORDER, "phase", "outcome", "reason", "detail", "record")


def reject_log(job: str, verdicts: DataFrame) -> DataFrame:
    """Everything that is not accepted, with the phase it left in."""
    phase = F.when(F.col("outcome") == R.READ_ERROR, READ).otherwise(PROCESS)
    rows = verdicts.where(F.col("outcome") != R.ACCEPTED).withColumn("phase", phase)
    return rows.select(F.lit(job).alias("job"), *LOG_COLUMNS)


def write_rejects(job: Job, verdicts: DataFrame) -> DataFrame:
    """Accepted records that the table refuses: for breaking its contract, else for repeating the key of an earlier one.

    ``reason`` is the first rule that a record breaks, ``detail`` the column or the record whose key it repeats, and
    ``record`` what was read or, for a repeated key, the row as it would be written. Every record has one entry.
    """
    accepted = verdicts.where(F.col("outcome") == R.ACCEPTED)
    broken = F.col("violation").isNotNull()
    rule, column = (F.split_part("violation", F.lit(":"), F.lit(part)) for part in (1, 2))
    log = accepted.where(broken).select(
        ORDER, rule.alias("reason"), F.concat(F.lit("column: "), column).alias("detail"), "record"
    )
    key = job.table.primary_key
    if key:
        row = F.to_json(F.struct(*[column.name for column in job.table.given]))
        named = accepted.select(ORDER, "reason", broken.alias("broken"), *key, row.alias("row"))
        repeats = mark_repeats(named, key, ORDER, measure=True).where(F.col("first_ord").isNotNull() & ~F.col("broken"))
        text = F.concat(F.lit("repeats the key of the record at "), F.col("first_ord").cast("string"))
        log = log.unionByName(
            repeats.select(ORDER, F.lit(REPEATED_KEY).alias("reason"), text.alias("detail"), F.col("row").alias("record"))
        )
    log = log.withColumns({"phase": F.lit(WRITE), "outcome": F.lit(REFUSED)})
    return log.select(F.lit(job.name).alias("job"), *LOG_COLUMNS)


def skip_log(job: Job, verdicts: DataFrame) -> DataFrame:
    """The whole log of a run: what was not read, what a rule rejected, what the table refuses."""
    return reject_log(job.name, verdicts).unionByName(write_rejects(job, verdicts))


def table_rows(job: Job, verdicts: DataFrame) -> DataFrame:
    return verdicts.where(F.col("outcome") == R.ACCEPTED).select(
        ORDER, *[column.name for column in job.table.given]
    )
