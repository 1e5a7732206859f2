"""Summary queries over the written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The column names and orders of the three reports below are those that results must carry.
WIDE_MONEY = "decimal(38,2)"


def transaction_totals(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("total"), F.count_if("anomalia").alias("anomalias"))


def transaction_report(table: DataFrame) -> DataFrame:
    return table.select("id", "fecha", "monto", "tipo", "anomalia", "observacion").orderBy("id")


def account_totals(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("total"))


def account_report(table: DataFrame) -> DataFrame:
    columns = ("cuenta_id", "nombre", "tipo", "saldo_inicial", "interes_calculado", "saldo_final")
    return table.select(*columns).orderBy("cuenta_id")


def statement_totals(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("total"))


def account_movements(table: DataFrame) -> DataFrame:
    """Movements and their sum per account; income and expense both add."""
    per_account = table.groupBy("cuenta_id").agg(
        F.count(F.lit(1)).alias("movimientos"), F.sum("monto").cast(WIDE_MONEY).alias("total")
    )
    return per_account.orderBy("cuenta_id")
