from __future__ import annotations

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallybook import annual_statements, daily_transactions, monthly_interest, run_all, run_job
from tallybook.operators.gates import ContractBroken, RejectLimitExceeded, UnreadableInput
from tallybook.operators.sinks import CatalogSink, FolderSink
from tallybook.plans.jobs import TRANSACTIONS_TABLE

GOOD = "{},2024-01-01,{},debito"
BAD = "{},2024-01-01,1,otro"


@pytest.fixture
def sink(tmp_path):
    return FolderSink(str(tmp_path / "tables"))


def run(spark, csv, sink, lines, job=None, **options):
    job = job or daily_transactions("literal")
    return run_job(spark, job, job.read(spark, csv(lines)), sink, **options)


def published(spark, sink, name="transacciones_diarias"):
    try:
        return sink.read(spark, name, TRANSACTIONS_TABLE.schema)
    except LookupError:
        return None


def test_fifty_skips_pass(spark, csv, sink):
    result = run(spark, csv, sink, [*[BAD.format(i) for i in range(50)], GOOD.format(99, 5)])
    assert result.status == "COMPLETED" and result.failure is None
    assert [row.id for row in result.table.collect()] == [99]
    assert result.counts["read"] == 51 and result.counts["skipped"] == 50 and result.counts["written"] == 1
    assert result.counts["skipped BAD_TYPE"] == 50
    assert result.rejects.count() == 50
    assert set(result.reports) == {"summary", "report"}
    assert tuple(result.reports["summary"].first()) == (1, 0)
    assert result.require_success() is result


def test_the_next_skip_fails_and_nothing_is_written(spark, csv, sink):
    lines = [GOOD.format(1000, 5), *[BAD.format(i) for i in range(51)], GOOD.format(2000, 6)]
    result = run(spark, csv, sink, lines)
    assert result.status == "FAILED" and result.table is None and result.reports == {}
    assert published(spark, sink) is None
    assert result.rejects.count() == 51 and "_failed" in result.rejects.inputFiles()[0]
    with pytest.raises(RejectLimitExceeded):
        result.require_success()


def test_prefix_commit_keeps_what_came_before(spark, csv, sink):
    lines = [GOOD.format(1000, 5), *[BAD.format(i) for i in range(51)], GOOD.format(2000, 6)]
    result = run(spark, csv, sink, lines, commit="prefix")
    assert result.status == "FAILED" and result.reports == {}
    assert [row.id for row in result.table.collect()] == [1000]
    assert result.rejects.count() == 50
    assert result.counts["written"] == 1


def test_no_limit(spark, csv, sink):
    result = run(spark, csv, sink, [BAD.format(i) for i in range(60)], max_rejects=None)
    assert result.status == "COMPLETED" and result.table.count() == 0


def test_filtered_records_do_not_count(spark, csv, sink):
    job = monthly_interest("literal")
    result = run(spark, csv, sink, [f"{i},N{i},10,30,hipoteca" for i in range(60)], job)
    assert result.status == "COMPLETED"
    assert (result.counts["filtered"], result.counts["skipped"]) == (60, 0)
    assert result.rejects.where("outcome = 'FILTERED'").count() == 60


@pytest.mark.parametrize(
    "line, failure",
    [
        ("x,2024-01-01,1,debito", UnreadableInput),
        ("7,2024-01-01,1", UnreadableInput),
        ("7,2024-01-01,12345678901234.5,debito", ContractBroken),
        ("1,2024-01-09,1,debito", ContractBroken),
    ],
)
def test_failures_that_no_limit_lifts(spark, csv, sink, line, failure):
    lines = [GOOD.format(1, 5), GOOD.format(2, 6), line, GOOD.format(3, 7)]
    result = run(spark, csv, sink, lines, max_rejects=None)
    assert isinstance(result.failure, failure) and published(spark, sink) is None
    kept = run(spark, csv, sink, lines, max_rejects=None, commit="prefix")
    assert sorted(row.id for row in kept.table.collect()) == [1, 2]


def test_too_long_text_breaks_the_contract(spark, csv, sink):
    result = run(spark, csv, sink, [f"1,{'n' * 101},5,30,ahorro"], monthly_interest("literal"))
    assert isinstance(result.failure, ContractBroken)
    assert result.verdicts.first().violation == "TOO_LONG:nombre"


def test_statements_get_dense_ids_in_line_order(spark, csv, sink):
    lines = ["9,2024-01-01,Deposito,10,a", "8,2024-01-01,otro,1,b", "7,2024/01/02,retiro,4.25,", "9,2024-01-01,compra,1,c"]
    result = run(spark, csv, sink, lines, annual_statements())
    found = result.table.orderBy("id").collect()
    assert [(row.id, row.cuenta_id, row.descripcion) for row in found] == [(1, 9, "a"), (2, 7, "Sin descripcion"), (3, 9, "c")]
    assert result.table.columns == ["id", "cuenta_id", "fecha", "transaccion", "monto", "descripcion", "clasificacion"]
    accounts = [(row.cuenta_id, row.movimientos, str(row.total)) for row in result.reports["accounts"].collect()]
    assert accounts == [(7, 1, "4.25"), (9, 2, "11.00")]


def test_a_second_run_replaces_the_first(spark, csv, sink):
    run(spark, csv, sink, [GOOD.format(1, 5), GOOD.format(2, 6)])
    result = run(spark, csv, sink, [GOOD.format(3, 5)])
    assert [row.id for row in result.table.collect()] == [3]


def test_tables_of_the_catalog(spark, csv):
    run(spark, csv, CatalogSink(), [GOOD.format(7, 5)])
    result = run(spark, csv, CatalogSink(), [GOOD.format(1, 5), BAD.format(2)])
    CatalogSink().expire(spark, "transacciones_diarias")
    versions = [table.name for table in spark.catalog.listTables() if table.name.startswith("transacciones_diarias__")]
    assert len(versions) == 1 and [row.id for row in result.table.collect()] == [1]
    assert [row.id for row in spark.table("transacciones_diarias").collect()] == [1]
    assert result.reports["report"].count() == 1
    assert spark.table("transacciones_diarias_rechazos").first().reason == "BAD_TYPE"


def test_a_failed_job_does_not_stop_the_next(spark, csv, sink):
    transactions, accounts, statements = daily_transactions("literal"), monthly_interest("literal"), annual_statements()
    run(spark, csv, sink, [GOOD.format(1, 5)], transactions)
    runs = [
        (transactions, transactions.read(spark, csv([BAD.format(i) for i in range(51)], "t.csv"))),
        (accounts, accounts.read(spark, csv(["1,Ana,100,30,ahorro", "2,Ana,100,30,hipoteca"], "a.csv"))),
        (statements, statements.read(spark, csv(["1,2024-01-01,deposito,5,x", "1,2024-01-01,deposito,0,x"], "s.csv"))),
    ]
    status, results = run_all(spark, runs, sink)
    assert [tuple(row) for row in status.collect()] == [
        ("daily_transactions", "FAILED", 51, 0, 0, 51, "RejectLimitExceeded"),
        ("monthly_interest", "COMPLETED", 2, 1, 1, 0, None),
        ("annual_statements", "COMPLETED", 2, 1, 0, 1, None),
    ]
    assert published(spark, sink).count() == 0
    assert results[1].reports["report"].count() == 1
    assert [result.job for result in results] == ["daily_transactions", "monthly_interest", "annual_statements"]


def broken(df):
    """The rows with a column that fails when it is evaluated."""
    return df.withColumn("detail", F.when(F.col("reason").isNotNull(), F.raise_error(F.lit("no space"))))


def test_a_failed_write_leaves_the_old_table_and_its_log(spark, csv, sink, monkeypatch):
    from tallybook.plans import run as plans_run

    run(spark, csv, sink, [GOOD.format(1, 5), BAD.format(2)])
    real = plans_run.reject_log
    monkeypatch.setattr(plans_run, "reject_log", lambda name, verdicts: broken(real(name, verdicts)))
    with pytest.raises(Exception, match="no space"):
        run(spark, csv, sink, [GOOD.format(3, 5), BAD.format(4)])
    assert [row.id for row in published(spark, sink).collect()] == [1]
    log = sink.read(spark, "transacciones_diarias_rechazos", "record string")
    assert [json.loads(row.record)["id"] for row in log.collect()] == [2]


def test_an_error_in_one_run_does_not_stop_the_next(spark, csv, sink, tmp_path):
    job = daily_transactions()
    good = csv([GOOD.format(1, 5)], "g.csv")
    failing = replace(job, values={**job.values, "observacion": F.raise_error(F.lit("no")).cast("string")})
    runs = [
        (job, lambda: job.read(spark, str(tmp_path / "nowhere.csv"))),
        (failing, lambda: failing.read(spark, good)),
        (job, lambda: job.read(spark, good)),
    ]
    status, results = run_all(spark, runs, sink)
    assert [row.status for row in status.collect()] == ["FAILED", "FAILED", "COMPLETED"]
    assert [row.failure for row in status.collect()][0] == "AnalysisException" and len(results) == 3
    assert [row.id for row in published(spark, sink).collect()] == [1]


def test_runs_release_their_intermediate_data(spark, csv, sink):
    from pathlib import Path

    base = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(base.glob("tallybook-*"))
    job = daily_transactions()
    path = csv([GOOD.format(1, 5), BAD.format(2)])
    run_all(spark, [(job, lambda: job.read(spark, path))], sink)
    records = job.read(spark, path, stage=False)
    run_job(spark, job, records, sink).release(spark)
    assert set(base.glob("tallybook-*")) == before


def test_old_versions_go_after_the_switch(spark, csv, sink):
    from pathlib import Path

    for at in range(3):
        result = run(spark, csv, sink, [GOOD.format(at, 5)])
    assert len(list(Path(sink.root, "transacciones_diarias").iterdir())) == 1
    assert [row.id for row in result.table.collect()] == [2]


def test_commit_is_checked(spark, csv, sink):
    with pytest.raises(ValueError, match="commit"):
        run(spark, csv, sink, [GOOD.format(1, 5)], commit="some")


def test_shared_folder_needs_a_setting(spark):
    from tallybook.session import shared_folder

    class Bare:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Bare, "x")
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
