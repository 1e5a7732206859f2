"""The log of a run with what the table refuses, files that are not opened, and counters of the write."""

from __future__ import annotations

import json
import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybook import annual_statements, daily_transactions, monthly_interest, run_job
from tallybook.operators import gates
from tallybook.operators.gates import ContractBroken, RejectLimitExceeded, UnreadableInput, prefix_end
from tallybook.operators.sinks import FolderSink
from tallybook.plans.run import COMPLETED, count_outcomes, run_files, settle_counted
from tallybook.sources import adapters

GOOD = "{},2024-01-01,{},debito"
BAD = "{},2024-01-01,1,otro"
SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture
def sink(tmp_path):
    return FolderSink(str(tmp_path / "tables"))


@pytest.fixture
def files(csv):
    """Several files of one input, in the order of their names; returns their folder."""

    def write(*contents):
        for at, lines in enumerate(contents):
            path = csv(lines, f"input/part-{at:03d}.csv")
        return str(Path(path).parent)

    return write


def run(spark, csv, sink, lines, job=None, **options):
    job = job or daily_transactions()
    return run_job(spark, job, job.read(spark, csv(lines)), sink, **options)


def entries(log):
    return sorted((json.loads(row.record)["id"], row.phase, row.outcome, row.reason, row.detail) for row in log.collect())


def position(detail):
    return detail.split(" at ")[0]


# The write phase


def test_each_refused_record_is_logged_by_its_rule(spark, csv, sink):
    lines = [
        GOOD.format(1, 5), BAD.format(2), GOOD.format(3, 12345678901234.5), GOOD.format(1, 7), GOOD.format(1, 98765432109876.5),
        GOOD.format(4, 8), GOOD.format(1, 9),
    ]
    result = run(spark, csv, sink, lines, max_rejects=None)
    assert isinstance(result.failure, ContractBroken)
    found = [(i, phase, outcome, reason, detail and position(detail)) for i, phase, outcome, reason, detail in entries(result.rejects)]
    repeats = (1, "write", "REFUSED", "REPEATED_KEY", "repeats the key of the record")
    assert found == [
        (1, "write", "REFUSED", "OVERFLOW", "column: monto"),
        repeats,
        repeats,
        (2, "process", "SKIPPED", "BAD_TYPE", "type: otro"),
        (3, "write", "REFUSED", "OVERFLOW", "column: monto"),
    ]
    amounts = {json.loads(row.record)["monto"] for row in result.rejects.where("reason = 'OVERFLOW'").collect()}
    assert {int(float(amount)) for amount in amounts} == {12345678901234, 98765432109876}


def test_the_log_of_a_prefix_commit_names_the_record_that_failed(spark, csv, sink):
    lines = [GOOD.format(1, 5), BAD.format(2), GOOD.format(1, 6), GOOD.format(3, 7)]
    result = run(spark, csv, sink, lines, max_rejects=None, commit="prefix")
    assert [row.id for row in result.table.collect()] == [1]
    assert [entry[:2] for entry in entries(result.rejects)] == [(2, "process")]
    assert [(entry[0], entry[3]) for entry in entries(result.failed_log)] == [(1, "REPEATED_KEY"), (2, "BAD_TYPE")]


def test_unreadable_lines_belong_to_the_read_phase(spark, csv, sink):
    result = run(spark, csv, sink, [GOOD.format(1, 5), "x,2024-01-01,1,debito", BAD.format(3)])
    assert {(row.phase, row.reason) for row in result.rejects.collect()} == {("read", "UNREADABLE_ID"), ("process", "BAD_TYPE")}


def test_a_run_without_faults_has_no_failed_log(spark, csv, sink):
    result = run(spark, csv, sink, [GOOD.format(1, 5), BAD.format(2)])
    assert result.status == COMPLETED and result.failed_log is None
    assert [row.phase for row in result.rejects.collect()] == ["process"]


def test_a_table_without_key_refuses_by_its_contract_alone(spark, csv, sink):
    long = f"1,2024-01-01,deposito,5,{'d' * 300}"
    result = run(spark, csv, sink, [long, "1,2024-01-01,deposito,5,x", "1,2024-01-01,deposito,5,x"], annual_statements())
    assert [(row.phase, row.reason, row.detail) for row in result.rejects.collect()] == [("write", "TOO_LONG", "column: descripcion")]


# Files that are not opened


def test_later_files_are_not_read_once_the_limit_is_passed(spark, files, sink):
    first = [GOOD.format(1, 5), *[BAD.format(i) for i in range(100, 140)]]
    second = [GOOD.format(2, 6), *[BAD.format(i) for i in range(140, 180)]]
    path = files(first, second, ["not a record"], ["nor this"], ["nor that"])
    result = run_files(spark, daily_transactions(), path, sink, commit="prefix", slice_files=1)
    # slices of one, two and four files: the limit is passed in the second, with the unreadable third file
    assert [Path(name).name for name in result.unread] == ["part-003.csv", "part-004.csv"]
    published = sorted(map(tuple, result.table.collect()))
    rejected = result.rejects.count()
    assert [row[0] for row in published] == [1, 2]
    whole = run_job(spark, daily_transactions(), daily_transactions().read(spark, path), sink, commit="prefix")
    assert sorted(map(tuple, whole.table.collect())) == published and whole.rejects.count() == rejected


def test_what_is_not_read_cannot_fail(spark, files, sink):
    path = files([BAD.format(i) for i in range(60)], ["not a record"], ["nor this"])
    result = run_files(spark, daily_transactions(), path, sink, slice_files=1)
    assert isinstance(result.failure, RejectLimitExceeded) and result.counts["read"] == 60 and len(result.unread) == 2


def test_an_unreadable_record_ends_the_reading_without_a_limit(spark, files, sink):
    path = files(["not a record"], [GOOD.format(1, 5)])
    result = run_files(spark, daily_transactions(), path, sink, max_rejects=None, slice_files=1)
    assert isinstance(result.failure, UnreadableInput) and len(result.unread) == 1


def test_repeats_of_other_slices_still_count(spark, files, sink):
    same = [GOOD.format(i, 5) for i in range(40)]
    path = files(same, [GOOD.format(i + 100, 5) for i in range(40)])
    result = run_files(spark, daily_transactions(), path, sink, slice_files=1)
    assert isinstance(result.failure, RejectLimitExceeded)
    assert (result.counts["skipped"], result.unread) == (79, ())


def test_a_run_that_passes_reads_every_file(spark, files, sink):
    path = files([GOOD.format(1, 5)], [GOOD.format(2, 6)], [GOOD.format(3, 7), BAD.format(4)])
    result = run_files(spark, daily_transactions(), path, sink, slice_files=1)
    assert result.status == COMPLETED and result.unread == ()
    assert sorted(row.id for row in result.table.collect()) == [1, 2, 3] and result.counts["read"] == 4


def test_names_of_files_may_hold_blanks(spark, csv, sink):
    path = csv([GOOD.format(1, 5)], "a b/c d%20e.csv")
    assert run_files(spark, daily_transactions(), str(Path(path).parent), sink).table.count() == 1


# The skip that fails a run


@pytest.mark.parametrize("limit", [0, 1, 49, 79, 80, 1000])
def test_the_first_skip_beyond_the_limit_by_either_way(spark, csv, limit, monkeypatch):
    job = daily_transactions()
    lines = [line.format(i, 5 + i) for i in range(80) for line in (BAD, GOOD)]
    verdicts = job.verdicts(job.read(spark, csv(lines)))
    found = prefix_end(verdicts, (), limit)
    monkeypatch.setattr(gates, "TOP_SKIPS", 0)
    assert found == prefix_end(verdicts, (), limit) and (found is None) == (limit >= 80)


def test_the_top_skips_are_found_without_a_range_sort(spark):
    skips = daily_transactions().verdicts(adapters.transactions(spark, SAMPLE)).where("outcome = 'SKIPPED'").select("ord")
    top = skips.orderBy("ord").limit(51).agg(F.max("ord"), F.count(F.lit(1)))
    text = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


# Counters of the write


@pytest.mark.parametrize(
    "job, records",
    [
        (daily_transactions, adapters.transactions),
        (lambda: replace(daily_transactions(), key=()), lambda *at: adapters.transactions(*at).withColumn("id", F.col("id") % 90)),
        (monthly_interest, adapters.incomplete_accounts),
        (annual_statements, adapters.movements),
        (annual_statements, lambda *at: adapters.movements(*at).limit(0)),
    ],
)
def test_the_write_counts_what_a_second_pass_would(spark, job, records):
    verdicts, counts = settle_counted(job(), job().verdicts(records(spark, SAMPLE)))
    assert counts == count_outcomes(verdicts, job().table.primary_key)


RETRIED = """
import sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import functions as F
from tallybook import daily_transactions, get_session
from tallybook.plans.run import settle_counted
from tallybook.sources import adapters

spark = get_session("retries", "local[2,3]", **{{"spark.checkpoint.dir": {scratch!r}, "spark.sql.shuffle.partitions": "3"}})
spark.sparkContext.setLogLevel("OFF")
records = adapters.transactions(spark, {sample!r})

def fails_once(batches):
    for at, batch in enumerate(batches):
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")

job = daily_transactions()
_, calm = settle_counted(job, job.verdicts(records))
verdicts = job.verdicts(records)
_, counts = settle_counted(job, verdicts.mapInArrow(fails_once, verdicts.schema))
assert calm == counts and counts["read"] == records.count(), (calm, counts)
print("equal counts", counts["read"])
"""


def test_a_task_that_runs_twice_counts_once(tmp_path):
    code = RETRIED.format(root=str(Path(__file__).resolve().parent.parent), scratch=str(tmp_path / "scratch"), sample=SAMPLE)
    done = subprocess.run([sys.executable, "-B", "-c", code], capture_output=True, text=True, timeout=240)
    assert "equal counts" in done.stdout, done.stderr[-2000:]
