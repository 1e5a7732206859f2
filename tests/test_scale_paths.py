"""Ways that move less: repeats by bitmap, keys by hash, ids by split, tables by month."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallybook import annual_statements, daily_transactions
from tallybook.operators import repeats
from tallybook.operators.contracts import repeated_primary_keys
from tallybook.operators.numbering import number_rows, number_scanned
from tallybook.operators.repeats import mark_repeats, mark_repeats_by_bitmap
from tallybook.operators.sinks import publish_months, read_months
from tallybook.session import shared_folder
from tallybook.sources import adapters

SAMPLE = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Repeats by bitmap


def keyed(spark, rows):
    return spark.createDataFrame(rows, "ord long, a string, b int, reason string").repartition(4)


ROWS = [
    *[(at, f"k{at % 300}", None, None) for at in range(900)],
    *[(1000 + at, None, at % 2, None) for at in range(50)],
    *[(2000 + at, "k1", None, "BAD") for at in range(50)],
    *[(3000 + at, f"once{at}", 1, None) for at in range(500)],
    (5000, None, None, None), (5001, None, None, None),
]


def test_bitmap_finds_the_same_repeats(spark):
    df = keyed(spark, ROWS)
    wanted = sorted(map(tuple, mark_repeats(df, ["a", "b"], "ord").collect()), key=repr)
    assert sorted(map(tuple, mark_repeats_by_bitmap(df, ["a", "b"], "ord").collect()), key=repr) == wanted
    assert sum(row[-1] is not None for row in wanted) == 600 + 48 + 1


@pytest.mark.parametrize("most_bits", [1 << 15, 1 << 28])
def test_measured_keys_beyond_the_broadcast_take_the_bitmap(spark, monkeypatch, most_bits):
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(repeats, "MOST_BITS", most_bits)
    df = keyed(spark, ROWS)
    marked = mark_repeats(df, ["a", "b"], "ord", measure=True)
    assert sorted(map(tuple, marked.collect()), key=repr) == sorted(map(tuple, mark_repeats(df, ["a", "b"], "ord").collect()), key=repr)


def test_more_keys_than_bits_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(repeats, "MOST_BITS", 64)
    df = keyed(spark, ROWS)
    marked = mark_repeats(df, ["a", "b"], "ord", measure=True)
    assert "bitmap" not in plan(marked)
    assert sorted(map(tuple, marked.collect()), key=repr) == sorted(map(tuple, mark_repeats(df, ["a", "b"], "ord").collect()), key=repr)


def test_no_repeats_at_all(spark):
    df = keyed(spark, [(at, f"k{at}", 1, None) for at in range(100)])
    assert mark_repeats_by_bitmap(df, ["a", "b"], "ord").where("first_ord is not null").count() == 0
    assert mark_repeats_by_bitmap(df.limit(0), ["a", "b"], "ord").count() == 0


def test_few_records_reach_the_shuffle(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    df = keyed(spark, [*[(at, f"k{at}", 1, None) for at in range(20_000)], (90_000, "k7", 1, None)])
    marked = mark_repeats_by_bitmap(df, ["a", "b"], "ord")
    rows = sorted((row.ord, row.first_ord) for row in marked.where("first_ord is not null").collect())
    assert rows == [(90_000, 7)]
    text = plan(marked)
    assert "Union" in text and "bitmap_construct_agg" in text


# Primary keys by hash


@pytest.mark.parametrize("key", [["a"], ["a", "b"], ["b"], ["n"]])
def test_keys_by_hash_are_those_of_plain_counts(spark, key):
    rows = [(f"k{at % 70}", at % 3 or None, at % 90) for at in range(200)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "a string, b int, n long").repartition(3)
    wanted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    assert sorted(map(repr, repeated_primary_keys(df, key).collect())) == sorted(map(repr, wanted.collect()))


def test_a_table_without_violations_shuffles_hashes_alone(spark):
    df = spark.range(5000).selectExpr("concat('a long key of many bytes ', id) AS a", "id AS b")
    found = repeated_primary_keys(df, ["a", "b"])
    assert found.collect() == []
    final = plan(found).split("== Initial Plan ==")[0]
    assert "hashpartitioning(a" not in final


# Ids by split


def test_ids_of_files_follow_lines_whatever_the_splits(spark, csv, settings):
    settings(files__maxPartitionBytes="600", files__openCostInBytes="1")
    kinds = ("deposito", "ajuste", "retiro")
    for at in range(7):
        path = csv([f"{at * 100 + i},2024-01-01,{kinds[i % 3]},5,x" for i in range(10 + at * 25)], f"ids/f{at}.csv")
    path = path.rsplit("/", 1)[0]
    job = annual_statements()
    rows = job.accepted(job.read(spark, path, stage=False))
    assert rows.select(F.spark_partition_id()).distinct().count() > 3
    numbered = number_scanned(rows, "ord", "id")
    found = {row.id: row.cuenta_id for row in numbered.collect()}
    lines = [at * 100 + i for at in range(7) for i in range(10 + at * 25) if i % 3 != 1]
    assert found == dict(enumerate(lines, 1))
    staged = job.accepted(job.read(spark, path))
    assert found == {row.id: row.cuenta_id for row in number_rows(staged, "ord", "id").collect()}
    assert "rangepartitioning" not in plan(numbered) and "Exchange hashpartitioning(_file" not in plan(numbered).split("WriteFiles")[0]


def test_ids_of_no_rows(spark, csv):
    job = annual_statements()
    rows = job.accepted(job.read(spark, csv(["1,2024-01-01,ajuste,5,x"]), stage=False))
    assert number_scanned(rows, "ord", "id").count() == 0


# Tables by month


def test_a_month_is_republished_and_the_others_stay(spark):
    rows = spark.createDataFrame(
        [(1, "2024-01-05"), (2, "2024-01-31"), (3, "2024-02-01"), (4, "2024-03-09"), (5, None)], "id long, day string"
    ).select("id", F.col("day").cast("date").alias("fecha"))
    path = shared_folder(spark, "months")
    publish_months(rows, path, "fecha")
    publish_months(rows.where("id = 3").withColumn("id", F.col("id") + 100), path, "fecha")

    def held(first, last):
        return sorted(row.id for row in read_months(spark, path, rows.schema, first, last).collect())

    assert held("2024-01", "2024-12") == [1, 2, 4, 103]
    assert held("2024-02", "2024-02") == [103] and held("2025-01", "2025-02") == []
    assert spark.read.parquet(path).where("mes is null").count() == 1


def test_reports_read_the_months_they_ask_for(spark):
    rows = annual_statements().accepted(adapters.movements(spark, SAMPLE))
    path = shared_folder(spark, "months")
    publish_months(rows, path, "fecha")
    year = read_months(spark, path, rows.schema, "1996-01", "1996-02")
    assert {row[0] for row in year.select(F.date_format("fecha", "yyyy-MM")).distinct().collect()} == {"1996-01", "1996-02"}
    text = plan(year)
    assert "PartitionFilters: [isnotnull(mes" in text
    assert {row.fecha for row in year.select("fecha").collect()} <= {row.fecha for row in rows.select("fecha").collect()}


def test_prefix_of_a_job_without_repeats_keeps_every_month(spark):
    job = replace(daily_transactions(), key=())
    rows = job.accepted(adapters.transactions(spark, "/root/testdata/sf0.001"))
    path = shared_folder(spark, "months")
    publish_months(rows, path, "fecha")
    assert spark.read.parquet(path).count() == rows.count()
