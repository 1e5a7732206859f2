"""The jobs and operators as queries over the star-schema tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import parse
from tallybook.functions.text import canon, is_blank, trim_field
from tallybook.operators.contracts import (
    ColumnContract,
    TableContract,
    contract_violations,
    repeated_primary_keys,
)
from tallybook.operators.gates import MAX_REJECTS, before, check_counts, prefix_end
from tallybook.operators.numbering import number_rows, number_scanned
from tallybook.operators.repeats import keep_first, mark_repeats, mark_repeats_by_bitmap
from tallybook.operators.rules import ACCEPTED, FILTERED, Rule
from tallybook.operators.sinks import FolderSink, publish_months, read_months, settle
from tallybook.plans import reports
from tallybook.plans.job import Job, table_rows
from tallybook.plans.jobs import RATES, annual_statements, daily_transactions, monthly_interest
from tallybook.plans.run import COMPLETED, FAILED, count_outcomes, run_all, run_files, run_job
from tallybook.session import shared_folder
from tallybook.sources import adapters
from tallybook.sources.records import parse_records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__.rstrip("_")] = build
    return build


def _rejects(job: Job, records: DataFrame) -> DataFrame:
    return job.rejects(records).select("ord", "outcome", "reason", "detail")


# Daily transactions


@query
def tx_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.transaction_report(daily_transactions().accepted(adapters.transactions(spark, folder)))


@query
def tx_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return _rejects(daily_transactions(), adapters.transactions(spark, folder))


@query
def tx_outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    return daily_transactions().outcome_counts(adapters.transactions(spark, folder))


@query
def tx_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.transaction_totals(daily_transactions().accepted(adapters.transactions(spark, folder)))


@query
def tx_dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    """First record per key alone, all others dropped."""
    job, records = daily_transactions(), adapters.transactions(spark, folder)
    firsts = keep_first(job.valid(records), job.repeat_key(records), "ord")
    return firsts.select("id", "fecha", "monto", F.col("kind").alias("tipo"))


@query
def tx_dedup_skew_safe(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows by aggregate and join, which also finds the repeats."""
    job, records = daily_transactions(), adapters.transactions(spark, folder)
    marked = mark_repeats(job.classified(records), job.repeat_key(records), "ord")
    firsts = marked.where(F.col("reason").isNull() & F.col("first_ord").isNull())
    return firsts.select("id", "fecha", "monto", F.col("kind").alias("tipo"))


@query
def tx_dedup_bitmap(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows once more: only records that may repeat, by a bit of their key's hash, are shuffled."""
    job, records = daily_transactions(), adapters.transactions(spark, folder)
    marked = mark_repeats_by_bitmap(job.classified(records), job.repeat_key(records), "ord")
    firsts = marked.where(F.col("reason").isNull() & F.col("first_ord").isNull())
    return firsts.select("id", "fecha", "monto", F.col("kind").alias("tipo"))


@query
def tx_hot_key_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Repeats of (type) alone: two keys hold all valid records, so each is hot."""
    job, records = daily_transactions(), adapters.transactions(spark, folder)
    marked = mark_repeats(job.classified(records), ["kind"], "ord")
    return marked.where(F.col("first_ord").isNotNull()).select("id", F.col("kind").alias("tipo"), "first_ord")


@query
def tx_literal_key_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Text amounts, where 700 and 700.00 are different keys."""
    job = daily_transactions("literal")
    records = parse_records(adapters.transaction_text(spark, folder), job.fields)
    return job.accepted(records).select("id", "fecha", "monto", "tipo")


@query
def tx_caller_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules that a caller adds: one rejects, one leaves records out without counting them as rejects."""
    amount = F.col("monto")
    more = (
        Rule("TOO_LARGE", amount > 100, detail=F.concat(F.lit("amount: "), amount.cast("string"))),
        Rule("WEEKEND", F.dayofweek("fecha").isin(1, 7), FILTERED),
    )
    job = daily_transactions()
    job = replace(job, rules=(job.rules[0], more[0], *job.rules[1:], more[1]))
    return job.verdicts(adapters.transactions(spark, folder)).select("ord", "outcome", "reason", "detail", "monto")


@query
def tx_default_flag(spark: SparkSession, folder: str) -> DataFrame:
    """A job that leaves the flag of some rows open: the table's default takes its place."""
    job = daily_transactions()
    unknown = F.col("id") % 3 == 0
    job = replace(job, values={**job.values, "anomalia": F.when(~unknown, job.values["anomalia"])})
    return job.accepted(adapters.transactions(spark, folder)).drop("ord")


# Monthly interest


@query
def acct_interest(spark: SparkSession, folder: str) -> DataFrame:
    return monthly_interest().accepted(adapters.accounts(spark, folder)).drop("ord")


@query
def acct_interest_cents(spark: SparkSession, folder: str) -> DataFrame:
    return monthly_interest().accepted(adapters.accounts_in_cents(spark, folder)).drop("ord")


@query
def acct_interest_rate_table(spark: SparkSession, folder: str) -> DataFrame:
    """Rates from a table instead of a mapping."""
    job = monthly_interest(rates=_rate_table(spark))
    return job.accepted(adapters.accounts_in_cents(spark, folder)).drop("ord")


@query
def acct_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.account_report(monthly_interest().accepted(adapters.accounts(spark, folder)))


@query
def acct_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return _rejects(monthly_interest(), adapters.accounts(spark, folder))


@query
def acct_outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    return monthly_interest().outcome_counts(adapters.accounts(spark, folder))


@query
def acct_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.account_totals(monthly_interest().accepted(adapters.accounts(spark, folder)))


@query
def acct_not_eligible(spark: SparkSession, folder: str) -> DataFrame:
    """Valid accounts of a type without a rate, as an anti join with the rate table."""
    rows = monthly_interest().classified(adapters.accounts(spark, folder))
    valid = rows.where(F.col("reason").isNull() | (F.col("reason") == "NOT_ELIGIBLE"))
    rates = F.broadcast(_rate_table(spark).select(F.col("tipo").alias("kind")))
    return valid.join(rates, "kind", "left_anti").select("cuenta_id", F.col("kind").alias("tipo"))


def _rate_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RATES.items()), "tipo string, tasa decimal(5,4)")


# Annual statements


@query
def mov_statement(spark: SparkSession, folder: str) -> DataFrame:
    return annual_statements().accepted(adapters.movements(spark, folder)).drop("ord")


@query
def mov_statement_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = annual_statements().accepted(adapters.movements(spark, folder))
    return number_rows(rows, "ord", "id").drop("ord")


@query
def mov_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return _rejects(annual_statements(), adapters.movements(spark, folder))


@query
def mov_outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    return annual_statements().outcome_counts(adapters.movements(spark, folder))


@query
def mov_total(spark: SparkSession, folder: str) -> DataFrame:
    return reports.statement_totals(annual_statements().accepted(adapters.movements(spark, folder)))


@query
def mov_account_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.account_movements(annual_statements().accepted(adapters.movements(spark, folder)))


# Text fields and files


@query
def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    text = trim_field(F.col("fecha"))
    return adapters.messy_dates(spark, folder).select("event_id", parse.parse_date(text).alias("fecha"))


@query
def parse_numbers(spark: SparkSession, folder: str) -> DataFrame:
    number, amount = trim_field(F.col("cuenta_id")), trim_field(F.col("saldo"))
    value = parse.parse_amount(amount)
    return adapters.messy_accounts(spark, folder).select(
        "c_custkey",
        parse.parse_long(number).alias("as_long"),
        parse.parse_int(number).alias("as_int"),
        value.alias("as_amount"),
        F.when(value.isNotNull(), parse.amount_scale(amount)).alias("scale"),
        is_blank(amount).alias("blank"),
    )


@query
def canon_text(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("tipo")
    return adapters.messy_accounts(spark, folder).select(
        "c_custkey", canon(kind).alias("canon"), is_blank(kind).alias("blank")
    )


@query
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Typed records of delimited files, with the read error of each bad one."""
    records = daily_transactions().read(spark, adapters.transaction_files(spark, folder), stage=False)
    broken = F.when(F.col("read_error") == "UNREADABLE_LINE", F.col("raw")).alias("broken_line")
    return records.select("id", "fecha", "monto", "tipo", "read_error", broken)


@query
def csv_tx_report(spark: SparkSession, folder: str) -> DataFrame:
    """Daily transactions from delimited files: the order of lines decides which repeat is the first."""
    job = daily_transactions("literal")
    return reports.transaction_report(job.accepted(job.read(spark, adapters.transaction_files(spark, folder))))


@query
def csv_default_key(spark: SparkSession, folder: str) -> DataFrame:
    """Records that repeat in the lines as they are written: 700 and 700.00 are different keys by default."""
    job = daily_transactions()
    records = job.read(spark, adapters.two_spellings(spark, folder))
    return job.accepted(records).select("id", "fecha", "monto", "tipo")


@query
def mov_dedup_nullable_key(spark: SparkSession, folder: str) -> DataFrame:
    """Movements with a repeat key of account, kind and a description that may be null; nulls are equal."""
    job = replace(annual_statements(), key=("cuenta_id", "kind", "descripcion"))
    verdicts = job.verdicts(adapters.movements(spark, folder))
    return verdicts.select("ord", "outcome", "reason", "detail")


@query
def csv_outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    job = daily_transactions("literal")
    return job.outcome_counts(job.read(spark, adapters.transaction_files(spark, folder), stage=False))


@query
def csv_wide_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts of any length: they round as a whole; one too large breaks the contract if its record is accepted."""
    job = replace(daily_transactions(), key=())
    verdicts = job.verdicts(job.read(spark, adapters.wide_amount_files(spark, folder), stage=False))
    key = F.when(F.col("outcome") == ACCEPTED, F.col("id")).otherwise(F.get_json_object("record", "$.id").cast("bigint"))
    return verdicts.select(key.alias("id"), "outcome", "reason", "monto", "anomalia", "violation")


@query
def csv_acct_interest(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly interest from delimited files."""
    job = monthly_interest()
    return job.accepted(job.read(spark, adapters.account_files(spark, folder))).drop("ord")


@query
def csv_acct_outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    job = monthly_interest("literal")
    return job.outcome_counts(job.read(spark, adapters.account_files(spark, folder), stage=False))


@query
def csv_mov_statement_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Annual statements from delimited files, numbered in line order without a shuffle of the rows."""
    job = annual_statements()
    rows = job.accepted(job.read(spark, adapters.movement_files(spark, folder), stage=False))
    return number_scanned(rows, "ord", "id").drop("ord")


@query
def csv_mov_outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    job = annual_statements()
    return job.outcome_counts(job.read(spark, adapters.movement_files(spark, folder), stage=False))


# Contracts, gates and runs


@query
def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_primary_keys(adapters.load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def contract_violations_(spark: SparkSession, folder: str) -> DataFrame:
    contract = TableContract(
        "part",
        (
            ColumnContract("p_partkey", T.LongType(), required=True),
            ColumnContract("p_name", T.StringType(), required=True, max_length=9),
            ColumnContract("p_brand", T.StringType(), max_length=7),
            ColumnContract("p_type", T.StringType(), max_length=20),
            ColumnContract("p_retailprice", T.DecimalType(5, 2), required=True),
        ),
    )
    part = adapters.load(spark, folder, "part")
    return contract_violations(part.withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(15,2)")), contract)


@query
def contract_violations_accounts(spark: SparkSession, folder: str) -> DataFrame:
    contract = TableContract(
        "accounts",
        (
            ColumnContract("saldo", T.DecimalType(5, 2), required=True),
            ColumnContract("tipo", T.StringType(), required=True, max_length=9),
        ),
    )
    text = adapters.messy_accounts(spark, folder)
    return contract_violations(text.withColumn("saldo", parse.parse_amount(trim_field(F.col("saldo")))), contract)


@query
def gate_skip_limit(spark: SparkSession, folder: str) -> DataFrame:
    """The default limit, and the two limits around the number of skipped records."""
    counts = count_outcomes(daily_transactions().verdicts(adapters.transactions(spark, folder)))
    rows = []
    for name, limit in (
        ("default", MAX_REJECTS),
        ("one below", counts["skipped"] - 1),
        ("exact", counts["skipped"]),
        ("none", None),
    ):
        status = FAILED if check_counts(counts, limit) else COMPLETED
        rows.append((name, limit, counts["skipped"], status))
    return spark.createDataFrame(rows, "gate string, max_rejects bigint, skipped bigint, status string")


@query
def tx_commit_prefix(spark: SparkSession, folder: str) -> DataFrame:
    """The rows a failing run keeps under prefix commit: those before the 51st skip."""
    job = daily_transactions()
    verdicts = settle(job.verdicts(adapters.transactions(spark, folder), measure=True), "verdicts", "outcome")
    end = prefix_end(verdicts, job.table.primary_key, MAX_REJECTS)
    return table_rows(job, before(verdicts, end)).drop("ord")


@query
def csv_commit_prefix(spark: SparkSession, folder: str) -> DataFrame:
    """The same from files, which are opened in order and no further than the run can still pass."""
    files = adapters.readable_transaction_files(spark, folder)
    return run_files(spark, daily_transactions(), files, _sink(spark), commit="prefix", slice_files=1).release(spark).table


def _three_runs(spark: SparkSession, folder: str) -> list:
    return [
        (daily_transactions(), adapters.transactions(spark, folder)),
        (monthly_interest(), adapters.accounts(spark, folder)),
        (annual_statements(), adapters.movements(spark, folder)),
    ]


LIMITS = {"monthly_interest": None, "annual_statements": None}


@query
def run_all_(spark: SparkSession, folder: str) -> DataFrame:
    """The three jobs in a row, written to tables; the first one fails at the default limit."""
    return run_all(spark, _three_runs(spark, folder), _sink(spark), LIMITS)[0]


@query
def run_all_with_missing_input(spark: SparkSession, folder: str) -> DataFrame:
    """The second input does not exist: that job fails, the others run."""
    runs = _three_runs(spark, folder)
    runs[1] = (monthly_interest(), lambda: adapters.accounts(spark, folder + "/nowhere"))
    status, _ = run_all(spark, runs, _sink(spark), dict.fromkeys([job.name for job, _ in runs]))
    return status


# Published tables, as readers find them


def _sink(spark: SparkSession) -> FolderSink:
    return FolderSink(shared_folder(spark, "tables"))


def _published(spark: SparkSession, job: Job, records: DataFrame, **options):
    """Run twice over an earlier version, so that what is read back went through a switch."""
    sink = _sink(spark)
    run_job(spark, job, records.limit(1), sink, None).release(spark)
    return run_job(spark, job, records, sink, **{"max_rejects": None, **options}).release(spark)


@query
def tx_published(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, daily_transactions(), adapters.transactions(spark, folder)).table


@query
def tx_published_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The skip log beside the table, with the record as it was read."""
    log = _published(spark, daily_transactions(), adapters.transactions(spark, folder)).rejects
    fields = [F.get_json_object("record", f"$.{name}").alias(name) for name in ("id", "fecha", "monto", "tipo")]
    log = log.select("job", "ord", "outcome", "reason", "detail", *fields)
    return log.withColumn("monto", F.col("monto").cast("decimal(15,2)"))


@query
def tx_failed_run_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The skip log that a run keeps which failed at the default limit."""
    result = _published(spark, daily_transactions(), adapters.transactions(spark, folder), max_rejects=MAX_REJECTS)
    return result.rejects.select("job", "ord", "outcome", "reason", "detail")


@query
def tx_refused_records(spark: SparkSession, folder: str) -> DataFrame:
    """The log of a run that the table fails: rejected records, amounts too large for it, and ids that repeat."""
    records = adapters.transactions(spark, folder)
    large = F.when(F.col("id") % 100 == 77, F.col("monto").cast("decimal(32,2)") + 10**14)
    records = records.withColumns({"monto": F.coalesce(large, "monto"), "id": F.col("id") % 700})
    result = run_job(spark, replace(daily_transactions(), key=()), records, _sink(spark), None)
    record = F.from_json("record", "id bigint, fecha string, monto decimal(32,2)").alias("record")
    log = result.release(spark).rejects.select("job", "ord", "phase", "outcome", "reason", "detail", record)
    return log.select("job", "ord", "phase", "outcome", "reason", "detail", "record.*")


@query
def acct_published(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, monthly_interest(), adapters.accounts(spark, folder)).table


@query
def mov_published(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, annual_statements(), adapters.movements(spark, folder)).table


@query
def mov_republished_months(spark: SparkSession, folder: str) -> DataFrame:
    """Statements by month: the second half of 1995 is published again with other amounts, a report reads that year."""
    rows = annual_statements().accepted(adapters.movements(spark, folder))
    path = shared_folder(spark, "months")
    publish_months(rows, path, "fecha")
    again = rows.where(F.col("fecha").between("1995-07-01", "1995-12-31"))
    publish_months(again.withColumn("monto", (F.col("monto") + 1).cast("decimal(15,2)")), path, "fecha")
    year = read_months(spark, path, rows.schema, "1995-01", "1995-12")
    month = F.date_format("fecha", "yyyy-MM").alias("mes")
    totals = (F.count(F.lit(1)).alias("movimientos"), F.sum("monto").cast("decimal(38,2)").alias("total"))
    return year.groupBy(month, "clasificacion").agg(*totals)


@query
def mov_published_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, annual_statements(), adapters.movements(spark, folder)).reports["accounts"]


@query
def acct_published_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of a run over records some of which are incomplete; ``written`` counts the published rows."""
    counts = _published(spark, monthly_interest(), adapters.incomplete_accounts(spark, folder)).counts
    return spark.createDataFrame(sorted(counts.items()), "counter string, records bigint")


# Gates


def _gate(spark: SparkSession, job: Job, records: DataFrame) -> DataFrame:
    """How a run without a reject limit ends, and what a prefix commit publishes."""
    result = run_job(spark, job, records, _sink(spark), None, "prefix")
    rows = [(type(result.failure).__name__, result.counts["unreadable"], result.counts["violations"], result.counts["written"])]
    result.release(spark)
    return spark.createDataFrame(rows, "failure string, unreadable bigint, violations bigint, written bigint")


@query
def gate_read_error(spark: SparkSession, folder: str) -> DataFrame:
    job = replace(daily_transactions(), table=replace(daily_transactions().table, primary_key=()))
    return _gate(spark, job, job.read(spark, adapters.transaction_files(spark, folder)))


@query
def gate_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts too large for the table."""
    records = adapters.transactions(spark, folder)
    large = F.when(F.col("id") % 1000 == 77, F.col("monto").cast("decimal(32,2)") + 10**14)
    return _gate(spark, daily_transactions(), records.withColumn("monto", F.coalesce(large, "monto")))


@query
def gate_primary_key(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that repeat after 4000 records."""
    records = adapters.transactions(spark, folder).withColumn("id", F.col("id") % 4000)
    return _gate(spark, replace(daily_transactions(), key=()), records)


@query
def acct_incomplete_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return _rejects(monthly_interest(), adapters.incomplete_accounts(spark, folder))


@query
def mov_incomplete_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return _rejects(annual_statements(), adapters.incomplete_movements(spark, folder))
