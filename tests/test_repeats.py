"""First-wins against a plain loop, on data where one key holds a third of all records."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallybook.operators import repeats
from tallybook.operators.repeats import keep_first, mark_repeats, repeated_keys


def ledger(seed=3, size=3000):
    chance = random.Random(seed)
    rows = []
    for i in range(size):
        key = ("hot", 0) if chance.random() < 0.35 else (f"k{chance.randint(1, 300)}", chance.randint(0, 3))
        reason = "BAD" if chance.random() < 0.2 else None
        rows.append((i, *key, reason))
    rows.append((size, None, 1, "BAD"))
    chance.shuffle(rows)
    return rows


def expected(rows):
    first, found = {}, {}
    for order, name, number, reason in sorted(rows, key=lambda row: row[0]):
        if reason is None:
            start = first.setdefault((name, number), order)
            if start != order:
                found[order] = start
    return found, sorted(first.values())


@pytest.fixture
def table(spark):
    rows = ledger()
    return rows, spark.createDataFrame(rows, "ord long, name string, number int, reason string").repartition(6)


def found_repeats(df):
    assert df.columns == ["ord", "name", "number", "reason", "first_ord"]
    rows = df.collect()
    return len(rows), {row.ord: row.first_ord for row in rows if row.first_ord is not None}


@pytest.mark.parametrize("hot_keys", [1, 7, 1000])
@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_shuffled_join(table, settings, monkeypatch, hot_keys, broadcast):
    rows, df = table
    settings(autoBroadcastJoinThreshold=broadcast)
    monkeypatch.setattr(repeats, "HOT_KEYS", hot_keys)
    assert found_repeats(mark_repeats(df, ["name", "number"], "ord")) == (len(rows), expected(rows)[0])


def test_long_keys_stay_out_of_the_broadcast(table, settings, monkeypatch):
    rows, df = table
    settings(autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(repeats, "HOT_KEY_BYTES", 3)
    assert found_repeats(mark_repeats(df, ["name", "number"], "ord")) == (len(rows), expected(rows)[0])


@pytest.mark.parametrize("rows_limit, bytes_limit", [(500_000, 1 << 25), (1, 1 << 25), (500_000, 1)])
def test_measured_join_takes_either_way(table, monkeypatch, rows_limit, bytes_limit):
    rows, df = table
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", rows_limit)
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", bytes_limit)
    marked = mark_repeats(df, ["name", "number"], "ord", measure=True)
    assert found_repeats(marked) == (len(rows), expected(rows)[0])
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert ("_hot_first" in plan) == (rows_limit == 1 or bytes_limit == 1)


def test_keep_first(table):
    rows, df = table
    kept = keep_first(df.where(F.col("reason").isNull()), ["name", "number"], "ord")
    assert sorted(row.ord for row in kept.collect()) == expected(rows)[1]


def test_repeated_keys_counts_copies(table):
    rows, df = table
    found = {(row.name, row.number): row.copies for row in repeated_keys(df, ["name", "number"], "ord").collect()}
    counts = {}
    for _, name, number, reason in rows:
        counts[name, number] = counts.get((name, number), 0) + (reason is None)
    assert found == {key: n for key, n in counts.items() if n > 1}


@pytest.mark.parametrize("measure", [False, True])
def test_null_parts_of_a_key_are_equal(spark, measure):
    """Rejected records add nothing to any key; a null is a value of its own."""
    rows = [(1, "", 0, "BAD"), (2, None, 0, None), (3, "", 0, None), (4, "", None, None), (5, "", 0, None)]
    rows += [(6, None, 0, None), (7, None, None, "BAD"), (8, None, None, None), (9, None, None, None), (10, "", None, None)]
    df = spark.createDataFrame(rows, "ord long, name string, number int, reason string")
    found = {5: 3, 6: 2, 9: 8, 10: 4}
    assert found_repeats(mark_repeats(df, ["name", "number"], "ord", measure)) == (10, found)
    kept = keep_first(df.where("reason IS NULL"), ["name", "number"], "ord")
    assert sorted(row.ord for row in kept.collect()) == [2, 3, 4, 8]
    assert expected(rows) == (found, [2, 3, 4, 8])


@pytest.mark.parametrize("kind", ["binary", "array<int>", "struct<a:int>"])
def test_keys_of_any_type(spark, kind):
    value = {"binary": "binary('x')", "array<int>": "array(1, null)", "struct<a:int>": "struct(1 AS a)"}[kind]
    df = spark.range(4).selectExpr("id AS ord", f"IF(id % 2 = 0, {value}, null) AS k", "CAST(null AS string) AS reason")
    rows = mark_repeats(df, ["k"], "ord").collect()
    assert {row.ord: row.first_ord for row in rows} == {0: None, 1: None, 2: 0, 3: 1}


def test_outcome_does_not_depend_on_the_partitioning(spark):
    rows = ledger(11)
    results = []
    for parts in (1, 3, 17):
        df = spark.createDataFrame(rows, "ord long, name string, number int, reason string").repartition(parts)
        results.append(found_repeats(mark_repeats(df, ["name", "number"], "ord"))[1])
    assert results[0] == results[1] == results[2] == expected(rows)[0]


def test_no_records(spark):
    df = spark.createDataFrame([], "ord long, name string, number int, reason string")
    for measure in (False, True):
        assert found_repeats(mark_repeats(df, ["name", "number"], "ord", measure)) == (0, {})
