"""One row per rule branch, expectations worked out by hand."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook import annual_statements, daily_transactions, monthly_interest

TRANSACTIONS = [
    "1,2024-01-01,100,debito",
    "2,2024/01/02,0,CREDITO",
    '3,2024-01-03,-5.50," Debito "',
    "4,2024-01-01,100,DEBITO",
    "5,2024-01-01,100.00,debito",
    "6,2024-01-01,1E2,debito",
    "7,2024-01-01,0100,debito",
    "8,2024-01-04,10,transferencia",
    "9,2024-01-04,10,",
    "10,2024-01-03,-5.50,debito",
]
ACCOUNTS = [
    "1,Ana,0.50,18,ahorro",
    "2,Beto,3.00,100,PRESTAMO",
    "3,Caro,10,17,ahorro",
    "4,Dina,10,101,ahorro",
    "5,Elio,,30,ahorro",
    "6,Fede,0,30,hipoteca",
    "7,Gala,10,30,corriente",
    "8,Gala,10,30,corriente",
    '9," ANA ",0.50,18,Ahorro',
    "10,Hugo,0.4999,40,ahorro",
    "11,,10,17,ahorro",
    "12,Ana,0.500,18,ahorro",
]
MOVEMENTS = [
    "1,2024-01-01,Deposito,10,pago",
    "1,2024/01/02,retiro,4.25,",
    "1,2024-01-03,COMPRA,1,tienda",
    "1,2024-01-01,deposito,10,pago",
    "2,2024-01-01,transferencia,-1,x",
    "2,2024-01-01,retiro,0,x",
    "2,2024-01-01,,5,x",
]


def judged(job, spark, path):
    rows = job.verdicts(job.read(spark, path)).orderBy("ord").collect()
    return [(row.outcome, row.reason) for row in rows], rows


OK = ("ACCEPTED", None)


def skipped(reason):
    return ("SKIPPED", reason)


REPEAT = skipped("DUPLICATE")
NO_RATE = ("FILTERED", "NOT_ELIGIBLE")


@pytest.mark.parametrize("key, fifth", [("literal", OK), ("numeric", REPEAT)])
def test_daily_transactions(spark, csv, key, fifth):
    found, rows = judged(daily_transactions(key), spark, csv(TRANSACTIONS))
    assert found == [OK, OK, OK, REPEAT, fifth, fifth, REPEAT, skipped("BAD_TYPE"), skipped("INCOMPLETE"), REPEAT]
    kept = [row for row in rows if row.id in (1, 2, 3)]
    assert [(row.fecha, row.monto, row.tipo, row.anomalia, row.observacion) for row in kept] == [
        (date(2024, 1, 1), Decimal("100.00"), "debito", False, "OK"),
        (date(2024, 1, 2), Decimal("0.00"), "credito", True, "Monto cero detectado"),
        (date(2024, 1, 3), Decimal("-5.50"), "debito", True, "Monto negativo detectado"),
    ]
    assert rows[7].detail == "type: transferencia"
    assert rows[8].detail == "missing: tipo"
    assert rows[3].detail.startswith("repeats the record at ") and rows[3].detail.endswith(", 0, 0}")
    assert rows[0].detail is None and rows[0].record is None
    assert rows[3].id is None and '"id":4' in rows[3].record


@pytest.mark.parametrize("key, last", [("literal", OK), ("numeric", REPEAT)])
def test_monthly_interest(spark, csv, key, last):
    found, rows = judged(monthly_interest(key), spark, csv(ACCOUNTS))
    assert found == [
        OK, OK, skipped("BAD_AGE"), skipped("BAD_AGE"), skipped("BAD_BALANCE"), skipped("BAD_BALANCE"),
        NO_RATE, NO_RATE, REPEAT, OK, skipped("INCOMPLETE"), last,
    ]
    money = {row.cuenta_id: (row.saldo_inicial, row.tasa_interes, row.interes_calculado, row.saldo_final) for row in rows}
    assert money[1] == (Decimal("0.50"), Decimal("0.0100"), Decimal("0.01"), Decimal("0.51"))
    assert money[2] == (Decimal("3.00"), Decimal("0.0150"), Decimal("0.05"), Decimal("3.05"))
    assert money[10] == (Decimal("0.50"), Decimal("0.0100"), Decimal("0.00"), Decimal("0.50"))
    assert [rows[i].detail for i in (2, 4, 6, 10)] == ["age: 17", "balance: none", "type: corriente", "missing: nombre"]


def test_annual_statements(spark, csv):
    found, rows = judged(annual_statements(), spark, csv(MOVEMENTS))
    assert found == [OK, OK, OK, OK, skipped("BAD_TYPE"), skipped("BAD_AMOUNT"), skipped("INCOMPLETE")]
    assert [(row.transaccion, row.descripcion, row.clasificacion) for row in rows[:4]] == [
        ("deposito", "pago", "INGRESO"),
        ("retiro", "Sin descripcion", "EGRESO"),
        ("compra", "tienda", "EGRESO"),
        ("deposito", "pago", "INGRESO"),
    ]


@pytest.mark.parametrize(
    "line, reason",
    [
        ("x,2024-01-01,1,debito", "UNREADABLE_ID"),
        (",2024-01-01,1,debito", "UNREADABLE_ID"),
        ("1,2024-1-5,1,debito", "UNREADABLE_FECHA"),
        ("1,2024-02-30,1,debito", "UNREADABLE_FECHA"),
        ("1,,1,debito", "UNREADABLE_FECHA"),
        ("1,2024-01-01,abc,debito", "UNREADABLE_MONTO"),
        ("1,2024-01-01,,debito", "UNREADABLE_MONTO"),
        ("1,2024-01-01,1e99999999999,debito", "UNREADABLE_MONTO"),
        ("1,2024-01-01,1", "UNREADABLE_LINE"),
        ("1,2024-01-01,1,debito,x", "UNREADABLE_LINE"),
    ],
)
def test_unreadable_transactions(spark, csv, line, reason):
    found, rows = judged(daily_transactions("literal"), spark, csv([line, "2,2024-01-01,1,debito"]))
    assert found == [("READ_ERROR", reason), OK]
    assert rows[0].record is not None


@pytest.mark.parametrize(
    "line, reason",
    [
        ("1,Ana,x,30,ahorro", ("READ_ERROR", "UNREADABLE_SALDO")),
        ("1,Ana,5,,ahorro", ("READ_ERROR", "UNREADABLE_EDAD")),
        ("1,Ana,5,30.5,ahorro", ("READ_ERROR", "UNREADABLE_EDAD")),
        ("1,Ana,\t,30,ahorro", skipped("BAD_BALANCE")),
        ("1,Ana,5,30, ", skipped("INCOMPLETE")),
    ],
)
def test_blank_is_not_uniform(spark, csv, line, reason):
    assert judged(monthly_interest("literal"), spark, csv([line]))[0] == [reason]


def test_rates_are_a_parameter(spark, csv):
    path = csv(["1,Ana,100,30,Oro", "2,Ana,100,30,ahorro"])
    table = spark.createDataFrame([("oro", Decimal("0.0500"))], "tipo string, tasa decimal(5,4)")
    for rates in ({"oro": Decimal("0.0500")}, table):
        found, rows = judged(monthly_interest(rates=rates), spark, path)
        assert found == [OK, NO_RATE]
        assert rows[0].saldo_final == Decimal("105.00")


def test_rate_table_needs_unique_types(spark, csv):
    table = spark.createDataFrame([("oro", Decimal("0.05")), ("oro", Decimal("0.06"))], "tipo string, tasa decimal(5,4)")
    job = monthly_interest(rates=table)
    with pytest.raises(ValueError, match="unique"):
        job.verdicts(job.read(spark, csv(["1,Ana,100,30,oro"])))


def test_amounts_of_any_length(spark, csv):
    lines = ["1,2024-01-01,1.500000000,debito", "2,2024-01-01,0.123456789,debito"]
    lines += [f"3,2024-01-01,{'1' * 24},otro", f"4,2024-01-01,{'1' * 24},debito"]
    found, rows = judged(daily_transactions("literal"), spark, csv(lines))
    assert found == [OK, OK, skipped("BAD_TYPE"), OK]
    assert [str(row.monto) for row in rows[:2]] == ["1.50", "0.12"] and rows[3].violation == "OVERFLOW:monto"


def test_amount_key_is_checked():
    with pytest.raises(ValueError, match="amount_key"):
        daily_transactions("text")


def test_caller_can_add_rules(spark, csv):
    from dataclasses import replace

    from tallybook.operators.rules import FILTERED, Rule

    job = daily_transactions("literal")
    small = Rule("SMALL", F.col("monto") < 50, FILTERED)
    found, _ = judged(replace(job, rules=(*job.rules, small)), spark, csv(["1,2024-01-01,49,debito", "2,2024-01-01,50,debito"]))
    assert found == [("FILTERED", "SMALL"), OK]


@pytest.mark.parametrize(
    "job, lines",
    [
        (lambda: daily_transactions("literal"), TRANSACTIONS),
        (lambda: daily_transactions("numeric"), TRANSACTIONS),
        (lambda: monthly_interest("literal"), ACCOUNTS),
        (lambda: annual_statements(), MOVEMENTS),
    ],
)
def test_short_paths_agree_with_the_verdicts(spark, csv, job, lines):
    """The accepted-only path and the aggregated counts, each against the full classification."""
    job = job()
    records = job.read(spark, csv([*lines, "bad line"]))
    for measure in (False, True):
        verdicts = job.verdicts(records, measure)
        counted = verdicts.groupBy("outcome", "reason").count().collect()
        assert sorted(map(tuple, counted), key=repr) == sorted(map(tuple, job.outcome_counts(records).collect()), key=repr)
        assert sum(row["count"] for row in counted) == len(lines) + 1
        columns = ["ord", *[column.name for column in job.table.given]]
        full = verdicts.where("outcome = 'ACCEPTED'").select(*columns).orderBy("ord").collect()
        assert full == job.accepted(records).select(*columns).orderBy("ord").collect()


def test_tables_may_hold_nulls(spark):
    from tallybook.sources.records import table_records

    rows = [(1, None, date(2024, 1, 1), "debito"), (2, Decimal("5"), None, "debito"), (3, Decimal("5"), date(2024, 1, 1), None)]
    table = spark.createDataFrame(rows, "n long, monto decimal(15,2), fecha date, tipo string")
    columns = {"id": F.col("n"), "fecha": F.col("fecha"), "monto": F.col("monto"), "tipo": F.col("tipo")}
    found = daily_transactions().verdicts(table_records(table, "n", columns)).orderBy("ord").collect()
    assert [(row.reason, row.detail) for row in found] == [
        ("INCOMPLETE", "missing: monto"),
        ("INCOMPLETE", "missing: fecha"),
        ("INCOMPLETE", "missing: tipo"),
    ]
