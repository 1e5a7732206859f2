"""The three ledger jobs."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import money
from tallybook.functions.parse import parse_amount, parse_date, parse_int, parse_long
from tallybook.functions.text import canon, is_blank
from tallybook.operators.contracts import ColumnContract, TableContract
from tallybook.operators.lookup import add_from_table, from_mapping
from tallybook.operators.rules import FILTERED, Rule, missing
from tallybook.plans import reports
from tallybook.plans.job import Job
from tallybook.sources.records import SCALE, Field

# Type names, limits, rates and texts that results must carry exactly.
TRANSACTION_TYPES = ("debito", "credito")
NEGATIVE_AMOUNT = "Monto negativo detectado"
ZERO_AMOUNT = "Monto cero detectado"
AMOUNT_OK = "OK"
MIN_AGE = 18
MAX_AGE = 100
RATES = {"ahorro": Decimal("0.0100"), "prestamo": Decimal("0.0150")}
MOVEMENT_CLASSES = {"deposito": "INGRESO", "retiro": "EGRESO", "compra": "EGRESO"}
NO_DESCRIPTION = "Sin descripcion"

MONEY = T.DecimalType(15, 2)
RATE = T.DecimalType(5, 4)

# The three target tables.
TRANSACTIONS_TABLE = TableContract(
    "transacciones_diarias",
    (
        ColumnContract("id", T.LongType(), required=True),
        ColumnContract("fecha", T.DateType(), required=True),
        ColumnContract("monto", MONEY, required=True),
        ColumnContract("tipo", T.StringType(), required=True, max_length=20),
        ColumnContract("anomalia", T.BooleanType(), default=False),
        ColumnContract("observacion", T.StringType(), max_length=255),
    ),
    primary_key=("id",),
)
ACCOUNTS_TABLE = TableContract(
    "cuentas_con_interes",
    (
        ColumnContract("cuenta_id", T.LongType(), required=True),
        ColumnContract("nombre", T.StringType(), required=True, max_length=100),
        ColumnContract("saldo_inicial", MONEY, required=True),
        ColumnContract("edad", T.IntegerType(), required=True),
        ColumnContract("tipo", T.StringType(), required=True, max_length=20),
        ColumnContract("tasa_interes", RATE, required=True),
        ColumnContract("interes_calculado", MONEY, required=True),
        ColumnContract("saldo_final", MONEY, required=True),
    ),
    primary_key=("cuenta_id",),
)
STATEMENTS_TABLE = TableContract(
    "estados_cuenta_anuales",
    (
        ColumnContract("id", T.LongType(), required=True),
        ColumnContract("cuenta_id", T.LongType(), required=True),
        ColumnContract("fecha", T.DateType(), required=True),
        ColumnContract("transaccion", T.StringType(), required=True, max_length=50),
        ColumnContract("monto", MONEY, required=True),
        ColumnContract("descripcion", T.StringType(), max_length=255),
        ColumnContract("clasificacion", T.StringType(), max_length=50),
    ),
    generated="id",
)

# 'literal' keys tell 700 from 700.00 in text; records of a typed table have no scales.
AMOUNT_KEYS = ("literal", "numeric")


def daily_transactions(amount_key: str = "literal") -> Job:
    """Flag non-positive amounts, skip bad types and repeats of (date, amount, type)."""
    kind = F.col("kind")
    amount = F.col("monto")
    required, missing_names = missing("id", "fecha", "monto", text=["tipo"])
    return Job(
        name="daily_transactions",
        table=TRANSACTIONS_TABLE,
        fields=(
            Field("id", parse_long),
            Field("fecha", parse_date),
            Field("monto", parse_amount, amount=amount_key == "literal"),
            Field("tipo"),
        ),
        prepare=lambda records: records.withColumn("kind", canon(F.col("tipo"))),
        rules=(
            Rule("INCOMPLETE", required, detail=missing_names),
            Rule("BAD_TYPE", ~kind.isin(*TRANSACTION_TYPES), detail=F.concat(F.lit("type: "), F.col("tipo"))),
        ),
        key=("fecha", *_amount_key("monto", amount_key), "kind"),
        values={
            "id": F.col("id"),
            "fecha": F.col("fecha"),
            "monto": amount,
            "tipo": kind,
            "anomalia": amount <= 0,
            "observacion": F.when(amount < 0, NEGATIVE_AMOUNT).when(amount == 0, ZERO_AMOUNT).otherwise(AMOUNT_OK),
        },
        reports={"summary": reports.transaction_totals, "report": reports.transaction_report},
    )


def monthly_interest(
    amount_key: str = "literal", rates: Mapping[str, Decimal] | DataFrame = MappingProxyType(RATES)
) -> Job:
    """Interest and final balance for account types with a rate; repeats of (name, balance, type, age) are skipped.

    ``rates`` is a mapping from type to rate, or a table with the columns ``tipo`` and ``tasa``.
    """
    kind, balance, age, rate = F.col("kind"), F.col("saldo"), F.col("edad"), F.col("tasa")
    required, missing_names = missing("cuenta_id", "edad", text=["nombre", "tipo"])

    def prepare(records: DataFrame) -> DataFrame:
        named = records.withColumns({"kind": canon(F.col("tipo")), "name_key": canon(F.col("nombre"))})
        if isinstance(rates, DataFrame):
            return add_from_table(named, kind, rates, "tipo", "tasa", RATE)
        return named.withColumn("tasa", from_mapping(kind, rates, RATE))

    return Job(
        name="monthly_interest",
        table=ACCOUNTS_TABLE,
        fields=(
            Field("cuenta_id", parse_long),
            Field("nombre"),
            Field("saldo", parse_amount, optional=True, amount=amount_key == "literal"),
            Field("edad", parse_int),
            Field("tipo"),
        ),
        prepare=prepare,
        rules=(
            Rule("INCOMPLETE", required, detail=missing_names),
            Rule("BAD_AGE", ~age.between(MIN_AGE, MAX_AGE), detail=F.concat(F.lit("age: "), age.cast("string"))),
            Rule(
                "BAD_BALANCE",
                [balance.isNull(), balance <= 0],
                detail=F.concat(F.lit("balance: "), F.coalesce(balance.cast("string"), F.lit("none"))),
            ),
            Rule("NOT_ELIGIBLE", rate.isNull(), FILTERED, detail=F.concat(F.lit("type: "), F.col("tipo"))),
        ),
        key=("name_key", *_amount_key("saldo", amount_key), "kind", "edad"),
        values={
            "cuenta_id": F.col("cuenta_id"),
            "nombre": F.col("nombre"),
            "saldo_inicial": balance,
            "edad": age,
            "tipo": kind,
            "tasa_interes": rate,
            "interes_calculado": money.interest(balance, rate),
            "saldo_final": money.balance_after(balance, rate),
        },
        reports={"summary": reports.account_totals, "report": reports.account_report},
    )


def annual_statements() -> Job:
    """Classify positive movements as income or expense; equal movements all stay."""
    kind, amount = F.col("kind"), F.col("monto")
    required, missing_names = missing("cuenta_id", "fecha", "monto", text=["transaccion"])
    description = F.col("descripcion")
    return Job(
        name="annual_statements",
        table=STATEMENTS_TABLE,
        fields=(
            Field("cuenta_id", parse_long),
            Field("fecha", parse_date),
            Field("transaccion"),
            Field("monto", parse_amount),
            Field("descripcion"),
        ),
        prepare=lambda records: records.withColumn("kind", canon(F.col("transaccion"))),
        rules=(
            Rule("INCOMPLETE", required, detail=missing_names),
            Rule(
                "BAD_TYPE", ~kind.isin(*MOVEMENT_CLASSES), detail=F.concat(F.lit("type: "), F.col("transaccion"))
            ),
            Rule("BAD_AMOUNT", amount <= 0, detail=F.concat(F.lit("amount: "), amount.cast("string"))),
        ),
        values={
            "cuenta_id": F.col("cuenta_id"),
            "fecha": F.col("fecha"),
            "transaccion": kind,
            "monto": amount,
            "descripcion": F.when(is_blank(description), NO_DESCRIPTION).otherwise(description),
            "clasificacion": from_mapping(kind, MOVEMENT_CLASSES, T.StringType()),
        },
        reports={"summary": reports.statement_totals, "accounts": reports.account_movements},
    )


def _amount_key(name: str, amount_key: str) -> tuple[str, ...]:
    if amount_key not in AMOUNT_KEYS:
        raise ValueError(f"amount_key must be one of {AMOUNT_KEYS}")
    return (name, name + SCALE) if amount_key == "literal" else (name,)
