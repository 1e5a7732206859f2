"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest

from tallybook import annual_statements, daily_transactions, monthly_interest
from tallybook.queries import QUERIES
from tallybook.sources import adapters

SAMPLE = "/root/testdata/sf0.001"

# Reports sort by key and small summaries end in one task; these plans move one row per task there.
SINGLE_ROW_RESULTS = {"tx_summary", "acct_summary", "mov_total", "contract_violations", "contract_violations_accounts"}
NUMBERED = {"mov_statement_ids", "csv_mov_statement_ids"}
# Rows made on the driver from counters; their plans are local tables.
COUNTERS = {"run_all", "run_all_with_missing_input", "gate_skip_limit", "gate_read_error", "gate_contract",
            "gate_primary_key", "acct_published_counters"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def initial(df):
    text = plan(df)
    return text.split("== Initial Plan ==")[-1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - COUNTERS))
def test_no_plan_crosses_tables_or_leaves_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SAMPLE))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text
    if name not in SINGLE_ROW_RESULTS | NUMBERED:
        assert "SinglePartition" not in text


def test_classification_needs_no_shuffle(spark):
    for job, records in (
        (daily_transactions(), adapters.transactions(spark, SAMPLE)),
        (monthly_interest(), adapters.accounts(spark, SAMPLE)),
    ):
        assert "Exchange" not in plan(job.classified(records))
    assert "Exchange" not in plan(annual_statements().verdicts(adapters.movements(spark, SAMPLE)))


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(annual_statements().accepted(adapters.movements(spark, SAMPLE)).select("cuenta_id", "monto"))
    columns = re.search(r"FileScan parquet \[(.*?)\]", text).group(1)
    assert "o_custkey" in columns and "o_orderkey" not in columns
    assert "props" not in plan(daily_transactions().verdicts(adapters.transactions(spark, SAMPLE)))
    assert "c_name" not in plan(monthly_interest().accepted(adapters.accounts(spark, SAMPLE)))


def test_first_record_is_chosen_before_the_shuffle(spark):
    text = initial(daily_transactions().accepted(adapters.transactions(spark, SAMPLE)))
    below_shuffle = text.split("Exchange hashpartitioning")[1]
    assert text.count("Exchange") == 1
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_repeats_aggregate_once_before_the_shuffle(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    # the smallest sample holds no repeats, and Spark would drop the empty join
    df = daily_transactions().verdicts(adapters.transactions(spark, "/root/testdata/sf0.01"))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "partial_min" in final and "ReusedExchange" in final
    assert final.count("Scan parquet") == 2
    # rejected records and hot keys are spread by their slot, which must stay a join key
    assert re.search(r"SortMergeJoin \[[^\]]*_slot", final)
    assert "Window" not in final


def test_few_repeated_keys_need_no_shuffle_of_the_records(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    text = plan(daily_transactions().verdicts(adapters.transactions(spark, SAMPLE), measure=True))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_outcome_counts_join_nothing(spark):
    text = plan(daily_transactions().outcome_counts(adapters.transactions(spark, SAMPLE)))
    assert "Join" not in text and "partial_count" in text


def test_account_sums_combine_before_the_shuffle(spark):
    assert "partial_sum" in plan(QUERIES["mov_account_summary"](spark, SAMPLE))


def test_numbering_of_file_scans_counts_per_split(spark, csv):
    from tallybook.operators.numbering import number_rows

    job = annual_statements()
    df = number_rows(job.accepted(job.read(spark, csv(["1,2024-01-01,deposito,5,x"]))), "ord", "id")
    text = initial(df)
    assert "rangepartitioning" not in text.lower().split("window")[-1]
    assert "partial_count" in text
