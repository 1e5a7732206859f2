"""Run jobs: classify, stage, gate, publish, report. Only counters reach the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators import rules as R
from tallybook.operators.contracts import repeated_primary_keys
from tallybook.operators.gates import MAX_REJECTS, before, check_counts, prefix_end
from tallybook.operators.numbering import number_rows
from tallybook.operators.sinks import Sink, reset, settle
from tallybook.plans.job import Job, reject_log, skip_log, table_rows
from tallybook.session import release, run_folder
from tallybook.sources.delimited import input_files

COMPLETED = "COMPLETED"
FAILED = "FAILED"
REJECTS_SUFFIX = "_rechazos"
COMMITS = ("atomic", "prefix")

STATUS_SCHEMA = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("records_read", T.LongType()),
        T.StructField("records_written", T.LongType()),
        T.StructField("records_filtered", T.LongType()),
        T.StructField("records_skipped", T.LongType()),
        T.StructField("failure", T.StringType()),
    ]
)

LOG_SCHEMA = "job string, phase string, outcome string, reason string, detail string, record string"


@dataclass(frozen=True)
class JobResult:
    """What a run did.

    ``verdicts`` holds every record with its outcome, ``table`` and ``rejects`` what was published. After a
    failure ``reports`` is empty, and ``failed_log`` is the log kept of the failed run: with it the records that the
    table refuses, by the rule that each breaks. Under atomic commit there is no table then, and ``rejects`` is that
    log too. ``unread`` names input files that were not opened, as the run could not pass any more. A job that broke
    off with an error has neither counts nor verdicts.
    """

    job: str
    status: str
    counts: Mapping[str, int] = field(default_factory=dict)
    verdicts: DataFrame | None = None
    table: DataFrame | None = None
    rejects: DataFrame | None = None
    reports: Mapping[str, DataFrame] = field(default_factory=dict)
    failure: Exception | None = None
    folder: str | None = None
    failed_log: DataFrame | None = None
    unread: Sequence[str] = ()

    def require_success(self) -> JobResult:
        if self.failure is not None:
            raise self.failure
        return self

    def release(self, spark: SparkSession) -> JobResult:
        """Delete the intermediate data of the run, ``verdicts`` included."""
        if self.folder is not None:
            release(spark, self.folder)
        return replace(self, verdicts=None, folder=None)


def run_job(
    spark: SparkSession,
    job: Job,
    records: DataFrame,
    sink: Sink,
    max_rejects: int | None = MAX_REJECTS,
    commit: str = "atomic",
) -> JobResult:
    """Publish the accepted rows and the skip log, unless a gate fails.

    The verdicts are written once to the shared folder, split by outcome, and counted by that write; the gates and both
    tables read them back. ``commit='atomic'`` publishes nothing on failure and keeps the skip log apart,
    ``'prefix'`` publishes what came before the record that failed the run. ``max_rejects=None`` lifts the reject
    limit. ``counts['written']`` is counted from the published table.
    """
    if commit not in COMMITS:
        raise ValueError(f"commit must be one of {COMMITS}")
    with run_folder(spark) as folder:
        return replace(_run(spark, job, records, sink, max_rejects, commit), folder=folder)


def run_files(
    spark: SparkSession,
    job: Job,
    path: str | Sequence[str],
    sink: Sink,
    max_rejects: int | None = MAX_REJECTS,
    commit: str = "atomic",
    slice_files: int | None = None,
) -> JobResult:
    """``run_job`` over delimited files, which opens no further files once the run cannot pass.

    The files are read in their order, in slices that double from ``slice_files`` (by default one file per core). The
    skips within a slice are skips of the whole run, as records of other slices only add repeats. When these, over all
    slices so far, exceed the limit, or a record is unreadable, the run goes on with the files read: the record that
    fails it is among them, so what a prefix commit publishes is the same as over all files. ``counts`` and the logs
    cover the files read.
    """
    if commit not in COMMITS:
        raise ValueError(f"commit must be one of {COMMITS}")
    files = input_files(spark, path)
    with run_folder(spark) as folder:
        parts: list[DataFrame] = []
        opened = skipped = unreadable = 0
        for own in _slices(files, slice_files or spark.sparkContext.defaultParallelism):
            parts.append(job.read(spark, own))
            opened += len(own)
            if opened == len(files):
                break
            for row in job.outcome_counts(parts[-1]).groupBy("outcome").agg(F.sum("records").alias("records")).collect():
                skipped += row.records if row.outcome == R.SKIPPED else 0
                unreadable += row.records if row.outcome == R.READ_ERROR else 0
            if unreadable or (max_rejects is not None and skipped > max_rejects):
                break
        records = reduce(DataFrame.unionByName, parts) if parts else job.read(spark, path)
        result = _run(spark, job, records, sink, max_rejects, commit)
        return replace(result, folder=folder, unread=tuple(files[opened:]))


def _slices(files: Sequence[str], size: int) -> Iterator[Sequence[str]]:
    at = 0
    while at < len(files):
        yield files[at : at + size]
        at, size = at + size, 2 * size


def _run(
    spark: SparkSession, job: Job, records: DataFrame, sink: Sink, max_rejects: int | None, commit: str
) -> JobResult:
    verdicts, counts = settle_counted(job, job.verdicts(records, measure=True))
    failure = check_counts(counts, max_rejects)
    name = job.table.name + REJECTS_SUFFIX
    failed_log = None
    if failure is not None:
        log = skip_log(job, verdicts) if counts["violations"] else reject_log(job.name, verdicts)
        failed_log = sink.keep_failed(log, name)
    if failure is not None and commit == "atomic":
        return JobResult(job.name, FAILED, counts, verdicts, rejects=failed_log, failure=failure, failed_log=failed_log)

    published = verdicts
    if failure is not None:
        published = before(verdicts, prefix_end(verdicts, job.table.primary_key, max_rejects))
    table, rejects = _publish(spark, job, published, sink)
    counts = {**counts, "written": table.count()}
    if failure is not None:
        return JobResult(job.name, FAILED, counts, verdicts, table, rejects, failure=failure, failed_log=failed_log)
    reports = {name: report(table) for name, report in job.reports.items()}
    return JobResult(job.name, COMPLETED, counts, verdicts, table, rejects, reports)


def settle_counted(job: Job, verdicts: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Store the verdicts, and the counters of ``count_outcomes``, which the same write observes.

    Spark takes the counts of a task into account once, when it succeeds, however often it runs.
    """
    counters = _counters(job)
    observed = Observation("verdicts")
    columns = [counter.alias(f"n{at}") for at, counter in enumerate(counters.values())]
    verdicts = settle(verdicts.observe(observed, *columns), "verdicts", "outcome")
    found = observed.get
    counts = {name: int(found.get(f"n{at}") or 0) for at, name in enumerate(counters)}
    counts = {name: count for name, count in counts.items() if count or not name.startswith("skipped ")}
    if job.table.primary_key:
        accepted = verdicts.where(F.col("outcome") == R.ACCEPTED)
        counts["violations"] += repeated_primary_keys(accepted, job.table.primary_key).count()
    return verdicts, counts


def _counters(job: Job) -> dict[str, Column]:
    def outcome(name: str) -> Column:
        return F.col("outcome") == name

    reasons = [rule.reason for rule in job.rules if rule.outcome == R.SKIPPED] + [R.DUPLICATE] * bool(job.key)
    return {
        "read": F.count(F.lit(1)),
        "accepted": F.count_if(outcome(R.ACCEPTED)),
        "skipped": F.count_if(outcome(R.SKIPPED)),
        "filtered": F.count_if(outcome(R.FILTERED)),
        "unreadable": F.count_if(outcome(R.READ_ERROR)),
        "violations": F.count("violation"),
        **{f"skipped {reason}": F.count_if(outcome(R.SKIPPED) & (F.col("reason") == reason)) for reason in reasons},
    }


Records = DataFrame | Callable[[], DataFrame]


def run_all(
    spark: SparkSession,
    runs: Sequence[tuple[Job, Records]],
    sink: Sink,
    max_rejects: int | None | Mapping[str, int | None] = MAX_REJECTS,
    commit: str = "atomic",
) -> tuple[DataFrame, list[JobResult]]:
    """Run the jobs one after the other; one that fails, or whose input cannot be read, does not stop the next.

    Each run takes its records, or a function that opens them when their turn comes. A run that publishes nothing
    leaves empty tables, as every run starts from empty ones. Returns one status row per run, and the results in order;
    intermediate data is released, so these have no verdicts.
    """
    results = []
    for job, records in runs:
        limit = max_rejects.get(job.name, MAX_REJECTS) if isinstance(max_rejects, Mapping) else max_rejects
        with run_folder(spark) as folder:
            try:
                opened = records if isinstance(records, DataFrame) else records()
                result = run_job(spark, job, opened, sink, limit, commit)
            except Exception as error:  # the next jobs run whatever happened in this one
                result = JobResult(job.name, FAILED, failure=error)
        release(spark, folder)
        if result.table is None:
            reset(spark, sink, _schemas(job))
        results.append(replace(result, verdicts=None, folder=None))
    rows = [
        (
            result.job,
            result.status,
            *[result.counts.get(name, 0) for name in ("read", "written", "filtered", "skipped")],
            None if result.failure is None else type(result.failure).__name__,
        )
        for result in results
    ]
    return spark.createDataFrame(rows, STATUS_SCHEMA), results


def _schemas(job: Job) -> dict[str, T.StructType]:
    return {job.table.name: job.table.schema, job.table.name + REJECTS_SUFFIX: T.StructType.fromDDL(LOG_SCHEMA)}


def _publish(spark: SparkSession, job: Job, verdicts: DataFrame, sink: Sink) -> tuple[DataFrame, DataFrame]:
    rows = table_rows(job, verdicts)
    if job.table.generated:
        rows = number_rows(rows, "ord", job.table.generated)
    log, name = reject_log(job.name, verdicts), job.table.name + REJECTS_SUFFIX
    sink.publish(spark, {job.table.name: rows.select(*job.table.schema.fieldNames()), name: log})
    return sink.read(spark, job.table.name, job.table.schema), sink.read(spark, name, log.schema)


def count_outcomes(verdicts: DataFrame, primary_key: Sequence[str] = ()) -> dict[str, int]:
    """Counters by outcome and reason; the rows collected number at most outcomes x reasons.

    Repeated primary keys of accepted records count as violations.
    """
    groups = (
        verdicts.groupBy("outcome", "reason")
        .agg(F.count(F.lit(1)).alias("records"), F.count("violation").alias("violations"))
        .collect()
    )

    def total(outcome: str) -> int:
        return sum(row.records for row in groups if row.outcome == outcome)

    violations = sum(row.violations for row in groups)
    if primary_key:
        accepted = verdicts.where(F.col("outcome") == R.ACCEPTED)
        violations += repeated_primary_keys(accepted, primary_key).count()
    return {
        "read": sum(row.records for row in groups),
        "accepted": total(R.ACCEPTED),
        "skipped": total(R.SKIPPED),
        "filtered": total(R.FILTERED),
        "unreadable": total(R.READ_ERROR),
        "violations": violations,
        **{f"skipped {row.reason}": row.records for row in groups if row.outcome == R.SKIPPED},
    }
