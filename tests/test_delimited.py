from __future__ import annotations

import random

from tallybook import daily_transactions
from tallybook.sources.delimited import BROKEN_LINE, scan_delimited

COLUMNS = ["id", "fecha", "monto", "tipo"]


def test_header_content_is_ignored_and_columns_bind_by_position(spark, csv):
    path = csv(["1,2024-01-01,5,debito"], header="tipo,monto,x,y")
    row = scan_delimited(spark, path, COLUMNS).first()
    assert (row.id, row.fecha, row.monto, row.tipo) == ("1", "2024-01-01", "5", "debito")


def test_quotes_comments_and_blank_lines(spark, csv):
    path = csv(['1,2024-01-01,5,"de,bi""to"', "# a comment, with, commas, here", "", "2,2024-01-01,6,c\\d"])
    rows = scan_delimited(spark, path, COLUMNS).orderBy("ord").collect()
    assert [(row.id, row.tipo, row[BROKEN_LINE]) for row in rows] == [("1", 'de,bi"to', None), ("2", "c\\d", None)]


def test_too_few_and_too_many_fields(spark, csv):
    path = csv(["1,2024-01-01,5", "2,2024-01-01,5,debito,x", "3,2024-01-01,5,debito"])
    rows = scan_delimited(spark, path, COLUMNS).orderBy("ord").collect()
    assert [row[BROKEN_LINE] for row in rows] == ["1,2024-01-01,5", "2,2024-01-01,5,debito,x", None]


def test_field_count_is_checked_even_when_few_columns_are_read(spark, csv):
    path = csv(["1,2024-01-01,5", "2,2024-01-01,5,debito"])
    rows = scan_delimited(spark, path, COLUMNS).select("id", BROKEN_LINE).orderBy("id").collect()
    assert [row[BROKEN_LINE] for row in rows] == ["1,2024-01-01,5", None]


def test_accents_survive(spark, csv):
    path = csv(["1,2024-01-01,5,año"])
    assert scan_delimited(spark, path, COLUMNS).first().tipo == "año"


def test_order_follows_path_then_line_over_uneven_files(spark, csv, settings):
    """The same winners whatever the split size and the packing of splits into tasks."""
    chance = random.Random(7)
    lines = [
        f"{i},2024-01-{chance.randint(1, 9):02d},{chance.randint(1, 40)},{chance.choice(['debito', 'Credito'])}"
        for i in range(3000)
    ]
    bounds = {"a.csv": lines[:200], "b.csv": lines[200:2300], "c.csv": lines[2300:]}
    folder = [csv(part, f"many/{name}") for name, part in bounds.items()][0].rsplit("/", 1)[0]
    seen, winners = set(), []
    for line in lines:
        number, key = line.split(",", 1)
        if key.lower() not in seen:
            seen.add(key.lower())
            winners.append(int(number))
    job = daily_transactions("literal")
    for size in ("128m", "9000", "1500"):
        settings(files__maxPartitionBytes=size, files__openCostInBytes="0")
        records = job.read(spark, folder)
        assert sorted(row.id for row in job.accepted(records).collect()) == winners
        kept = job.verdicts(records).where("outcome = 'ACCEPTED'")
        assert sorted(row.id for row in kept.collect()) == winners
        scan = job.read(spark, folder, stage=False)
        assert sorted(row.id for row in job.accepted(scan).collect()) == winners
        assert scan.rdd.getNumPartitions() >= {"128m": 1, "9000": 5, "1500": 20}[size]
