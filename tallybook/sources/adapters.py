"""The star-schema test tables as inputs of the three jobs; every adapter reads its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.lookup import from_mapping
from tallybook.operators.numbering import POSITION_BITS
from tallybook.session import shared_folder
from tallybook.sources.delimited import ORDER
from tallybook.sources.records import table_records

MONEY = "decimal(15,2)"
EVENT_KINDS = {
    "purchase": "debito",
    "view": " DEBITO ",
    "signup": "credito",
    "click": "Credito",
    "error": "otro",
}
SEGMENT_KINDS = {"AUTOMOBILE": "ahorro", "HOUSEHOLD": " Ahorro ", "FURNITURE": "hipoteca"}


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _event_columns() -> dict[str, Column]:
    return {
        "id": F.col("event_id"),
        "fecha": F.col("ts").cast("date"),
        "monto": (F.col("value").cast(MONEY) - 5).cast(MONEY),
        "tipo": from_mapping(F.col("event_type"), EVENT_KINDS, "string"),
    }


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as daily transactions, amounts shifted so that some are negative or zero."""
    return table_records(load(spark, folder, "events"), "event_id", _event_columns())


def transaction_text(spark: SparkSession, folder: str) -> DataFrame:
    """The same transactions as raw text: dates with slashes, whole amounts with 0 or 2 fraction digits."""
    columns = _event_columns()
    odd = F.col("event_id") % 2 == 1
    amount = columns["monto"]
    whole = odd & (amount == F.floor(amount))
    return load(spark, folder, "events").select(
        F.col("event_id").alias(ORDER),
        F.col("event_id").cast("string").alias("id"),
        F.date_format(columns["fecha"], "yyyy/MM/dd").alias("fecha"),
        F.when(whole, amount.cast("bigint").cast("string")).otherwise(amount.cast("string")).alias("monto"),
        columns["tipo"].alias("tipo"),
    )


def transaction_files(spark: SparkSession, folder: str) -> str:
    """The transactions as delimited files in record order, some lines hard to read; returns their folder.

    Types stand in quotes with padding or a comma, dates mix separators, and some records lack a field, have one
    too many or hold text that is no number or no date. Every file starts with a header line.
    """
    key = F.col("ord") % 50
    text = transaction_text(spark, folder)
    date = F.when(key == 11, F.concat(F.left("fecha", F.lit(8)), F.lit("31x")))
    date = date.when(key == 12, F.translate("fecha", "/", "-")).otherwise(F.col("fecha"))
    amount = F.when(key == 21, F.concat("monto", F.lit(" EUR"))).otherwise(F.col("monto"))
    quoted = F.concat(F.lit('"'), "tipo", F.lit('"'))
    kind = F.when(key == 31, "").when(key == 32, '"otro, ""raro"""').otherwise(quoted)
    line = F.concat_ws(",", "id", date, amount, kind)
    short, long = F.concat_ws(",", "id", date, amount), F.concat(line, F.lit(",x"))
    line = F.when(key == 41, short).when(key == 42, long).otherwise(line)
    return _write_lines(text.select("ord", line.alias("line")), "transactions", "id,fecha,monto,tipo")


def readable_transaction_files(spark: SparkSession, folder: str) -> str:
    """The transactions as delimited files in record order, every line readable; some types are not known."""
    text = transaction_text(spark, folder)
    line = F.concat_ws(",", "id", "fecha", "monto", F.coalesce("tipo", F.lit("")))
    return _write_lines(text.select("ord", line.alias("line")), "readable", "id,fecha,monto,tipo")


def wide_amount_files(spark: SparkSession, folder: str) -> str:
    """The transactions with amounts of more digits than a table column holds, on either side of the point."""
    key = F.col("ord") % 8
    amount = (
        F.when(key == 1, "0.123456789")
        .when(key == 2, "0.00000000000000000000000000001")
        .when(key == 3, "0.005000000000000000000000000001")
        .when(key == 4, "-0.00500000000000000000000")
        .when(key == 5, "123456789012345678901234.5")
        .when(key == 6, "-1.4999999999999999999999999e-2")
        .when(key == 7, F.concat("monto", F.when(F.instr("monto", ".") > 0, "").otherwise("."), F.lit("0" * 30)))
        .otherwise(F.col("monto"))
    )
    rows = transaction_text(spark, folder)
    line = F.concat_ws(",", "id", "fecha", amount, F.trim("tipo"))
    return _write_lines(rows.select("ord", line.alias("line")), "wide-amounts", "id,fecha,monto,tipo")


def two_spellings(spark: SparkSession, folder: str) -> str:
    """Coarse transactions, every third amount with two fraction digits and the others without."""
    day = F.date_format(F.trunc(F.col("ts").cast("date"), "month"), "yyyy-MM-dd")
    whole = F.floor(F.col("value") / 50).cast("string")
    amount = F.when(F.col("event_id") % 3 == 0, F.concat(whole, F.lit(".00"))).otherwise(whole)
    line = F.concat_ws(",", "event_id", day, amount, F.when(F.col("event_id") % 2 == 0, "debito").otherwise("credito"))
    rows = load(spark, folder, "events").select(F.col("event_id").alias("ord"), line.alias("line"))
    return _write_lines(rows, "two-spellings", "id,fecha,monto,tipo")


def account_files(spark: SparkSession, folder: str) -> str:
    """The accounts as delimited files: padded names, blank and bad balances, missing ages."""
    key = F.col("cuenta_id") % 50
    name = F.concat(F.lit('"  '), "nombre", F.lit(' "'))
    balance = F.when(key.isin(7, 27), " ").when(key == 11, "abc").otherwise(F.col("saldo").cast("string"))
    age = F.when(key != 21, F.col("edad").cast("string"))
    line = F.concat_ws(",", "cuenta_id", name, balance, F.coalesce(age, F.lit("")), "tipo")
    rows = accounts(spark, folder).select("ord", line.alias("line"))
    return _write_lines(rows, "accounts", "cuenta_id,nombre,saldo,edad,tipo")


def movement_files(spark: SparkSession, folder: str) -> str:
    """The movements as delimited files: dates with slashes, quoted commas, some account ids that are no number."""
    key = F.col("ord") % 50
    account = F.when(key == 11, F.concat(F.lit("x"), "cuenta_id")).otherwise(F.col("cuenta_id").cast("string"))
    text = F.coalesce("descripcion", F.lit(""))
    text = F.when(key == 31, F.concat(F.lit('"a, ""b"" '), text, F.lit('"'))).otherwise(text)
    line = F.concat_ws(",", account, F.date_format("fecha", "yyyy/MM/dd"), "transaccion", "monto", text)
    rows = movements(spark, folder).select("ord", line.alias("line"))
    return _write_lines(rows, "movements", "cuenta_id,fecha,transaccion,monto,descripcion")


def _write_lines(rows: DataFrame, purpose: str, header: str) -> str:
    """Text files in record order, each with a header line; returns their folder in the shared folder."""
    placed = rows.repartitionByRange("ord").sortWithinPartitions("ord")
    first_of_file = F.monotonically_increasing_id().bitwiseAND(POSITION_BITS) == 0
    lines = F.when(first_of_file, F.concat(F.lit(header + "\n"), "line")).otherwise(F.col("line"))
    path = shared_folder(rows.sparkSession, purpose)
    placed.select(lines.alias("value")).write.text(path)
    return path


def messy_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Event dates as text in eight spellings, good and bad."""
    day = F.col("ts").cast("date")
    kind = F.col("event_id") % 8
    text = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(day, "yyyy/MM/dd"))
        .when(kind == 2, F.date_format(day, "yyyy/MM-dd"))
        .when(kind == 3, F.date_format(day, "yyyy-M-d"))
        .when(kind == 4, F.concat(F.lit("  "), F.date_format(day, "yyyy-MM-dd"), F.lit("\t")))
        .when(kind == 5, F.date_format(day, "yyyy-02-30"))
        .when(kind == 6, F.date_format(day, "yyyy-MM"))
        .otherwise(F.lit(" "))
    )
    return load(spark, folder, "events").select("event_id", text.alias("fecha"))


def messy_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as text fields in ten spellings, good and bad."""
    kind = F.col("c_custkey") % 10
    key = F.col("c_custkey").cast("string")
    balance = F.col("c_acctbal").cast(MONEY).cast("string")
    whole = F.floor("c_acctbal").cast("string")
    number = (
        F.when(kind == 1, F.concat(F.lit("+"), key))
        .when(kind == 2, F.concat(key, F.lit(".0")))
        .when(kind == 3, F.concat(F.lit(" "), key, F.lit("\t")))
        .when(kind == 4, F.concat(key, F.lit("x")))
        .when(kind == 5, F.lit(""))
        .when(kind == 6, F.concat(F.lit("00"), key))
        .when(kind == 7, F.concat(key, F.lit("000000000000000000000")))
        .otherwise(key)
    )
    amount = (
        F.when(kind == 1, F.concat(balance, F.lit("0000000")))
        .when(kind == 2, F.concat(whole, F.lit("E1")))
        .when(kind == 3, F.concat(F.lit(" "), balance, F.lit(" ")))
        .when(kind == 4, F.concat(balance, F.lit("000000")))
        .when(kind == 5, F.lit("  "))
        .when(kind == 6, F.concat(whole, F.lit(".")))
        .when(kind == 7, F.concat(whole, F.lit("e-2")))
        .when(kind == 8, F.translate(balance, ".", ","))
        .otherwise(balance)
    )
    name = (
        F.when(kind == 1, F.concat(F.lit("\t "), F.upper("c_mktsegment"), F.lit(" \r")))
        .when(kind == 2, F.concat(F.lit("  "), F.initcap("c_mktsegment")))
        .when(kind == 3, F.lit(" \t "))
        .when(kind == 4, F.lit(None).cast("string"))
        .when(kind == 5, F.concat("c_mktsegment", F.lit(" X")))
        .otherwise(F.col("c_mktsegment"))
    )
    return load(spark, folder, "customer").select(
        "c_custkey", number.alias("cuenta_id"), amount.alias("saldo"), name.alias("tipo")
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as accounts in coarse buckets, so that many repeat."""
    key = F.col("c_custkey")
    return table_records(
        load(spark, folder, "customer"),
        "c_custkey",
        {
            "cuenta_id": key,
            "nombre": F.concat(F.lit("N"), (F.col("c_nationkey") % 5).cast("string")),
            "saldo": (F.floor(F.col("c_acctbal") / 1000) * 1000).cast(MONEY),
            "edad": (16 + (key % 9) * 12).cast("int"),
            "tipo": _segment_kind(),
        },
    )


def accounts_in_cents(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as accounts with their exact balance, so that interest meets half cents."""
    key = F.col("c_custkey")
    return table_records(
        load(spark, folder, "customer"),
        "c_custkey",
        {
            "cuenta_id": key,
            "nombre": F.col("c_name"),
            "saldo": F.col("c_acctbal").cast(MONEY),
            "edad": (18 + key % 83).cast("int"),
            "tipo": _segment_kind(),
        },
    )


def movements(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as account movements, amounts shifted so that some are not positive."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table_records(
        load(spark, folder, "orders"),
        "o_orderkey",
        {
            "cuenta_id": F.col("o_custkey"),
            "fecha": F.col("o_orderdate").cast("date"),
            "transaccion": F.when(status == "P", "Deposito")
            .when(status == "F", "retiro")
            .when((status == "O") & (priority == "5-LOW"), "ajuste")
            .when(status == "O", "compra"),
            "monto": (F.col("o_totalprice").cast(MONEY) - 50000).cast(MONEY),
            "descripcion": F.when(priority != "4-NOT SPECIFIED", priority),
        },
    )


def _segment_kind() -> Column:
    return F.coalesce(from_mapping(F.col("c_mktsegment"), SEGMENT_KINDS, "string"), F.lit("prestamo"))


def incomplete_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """The accounts, some without name, age or type."""
    key = F.col("ord") % 20
    gaps = {"nombre": F.when(key == 3, " ").otherwise(F.col("nombre")), "edad": F.when(~key.isin(3, 5), F.col("edad"))}
    return accounts(spark, folder).withColumns({**gaps, "tipo": F.when(key != 7, F.col("tipo"))})


def incomplete_movements(spark: SparkSession, folder: str) -> DataFrame:
    """The movements, some without account, date or kind."""
    key = F.col("ord") % 20
    gaps = {"cuenta_id": F.when(~key.isin(1, 2), F.col("cuenta_id")), "fecha": F.when(key != 2, F.col("fecha"))}
    return movements(spark, folder).withColumns({**gaps, "transaccion": F.when(key != 5, F.col("transaccion"))})
