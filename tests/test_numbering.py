from __future__ import annotations

import random

from tallybook import annual_statements
from tallybook.operators.numbering import number_rows


def test_dense_ids_by_any_order_column(spark):
    orders = random.Random(1).sample(range(10**9), 5000)
    df = spark.createDataFrame([(o, str(o)) for o in orders], "o long, v string").repartition(9)
    found = number_rows(df, "o", "id").collect()
    assert sorted((row.id, row.o) for row in found) == list(enumerate(sorted(orders), 1))
    assert all(row.v == str(row.o) for row in found)


def test_dense_ids_in_line_order(spark, csv, settings):
    settings(files__maxPartitionBytes="4000", files__openCostInBytes="0")
    lines = [f"{i},2024-01-01,{'deposito' if i % 3 else 'otro'},5,line {i}" for i in range(900)]
    csv(lines[600:], "in/b.csv")
    folder = csv(lines[:600], "in/a.csv").rsplit("/", 1)[0]
    job = annual_statements()
    found = number_rows(job.accepted(job.read(spark, folder)), "ord", "id").collect()
    assert sorted((row.id, row.cuenta_id) for row in found) == list(enumerate([i for i in range(900) if i % 3], 1))


def test_one_unsplittable_file_is_numbered_in_several_tasks(spark, tmp_path, settings):
    import gzip

    settings(adaptive__coalescePartitions__enabled="false")
    lines = [f"{i},2024-01-01,deposito,5,line {i}" for i in range(2000)]
    (tmp_path / "in.csv.gz").write_bytes(gzip.compress("\n".join(["header", *lines]).encode()))
    job = annual_statements()
    records = job.accepted(job.read(spark, str(tmp_path / "in.csv.gz")))
    assert records.rdd.getNumPartitions() == 1
    numbered = number_rows(records, "ord", "id")
    assert sorted((row.id, row.cuenta_id) for row in numbered.collect()) == [(i + 1, i) for i in range(2000)]
    assert len(numbered.inputFiles()) > 1  # one stored file per task


def test_no_rows(spark):
    assert number_rows(spark.createDataFrame([], "o long, v string"), "o", "id").collect() == []
