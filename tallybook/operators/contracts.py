"""What a target table demands of its rows: types, nulls, lengths, a unique key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnContract:
    name: str
    type: T.DataType
    required: bool = False
    max_length: int | None = None
    default: object = None

    def breaches(self, value: Column) -> dict[str, Column]:
        """Rule name to the test that a value breaks it."""
        found = {}
        if self.default is not None:
            value = F.coalesce(value, F.lit(self.default))
        if self.required:
            found["NULL_VALUE"] = value.isNull()
        if self.max_length is not None:
            found["TOO_LONG"] = F.char_length(value) > self.max_length
        if isinstance(self.type, T.DecimalType):
            found["OVERFLOW"] = value.isNotNull() & value.try_cast(self.type).isNull()
        return found

    def stored(self, value: Column) -> Column:
        """The value as the table holds it; decimals round half up, an overflow is null here."""
        if self.default is not None:
            value = F.coalesce(value, F.lit(self.default))
        return value.try_cast(self.type)


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[ColumnContract, ...]
    primary_key: tuple[str, ...] = ()
    generated: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(column.name, column.type) for column in self.columns])

    @property
    def given(self) -> tuple[ColumnContract, ...]:
        """The columns a job supplies; the generated one is numbered at the write."""
        return tuple(column for column in self.columns if column.name != self.generated)

    def breach(self, values: Mapping[str, Column]) -> Column:
        """The first broken rule as ``RULE:column``, null for a row that fits."""
        tests = [
            F.when(test, f"{rule}:{column.name}")
            for column in self.given
            for rule, test in column.breaches(values[column.name]).items()
        ]
        return F.coalesce(*tests, F.lit(None).cast("string"))


def contract_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """``(column, rule, violations)`` for every rule that some row breaks; one pass, one row per task shuffled."""
    rules = [
        (column.name, rule, test)
        for column in contract.given
        for rule, test in column.breaches(F.col(column.name)).items()
    ]
    counts = df.agg(*[F.count_if(test).alias(f"n{i}") for i, (_, _, test) in enumerate(rules)])
    entries = [
        F.struct(F.lit(name).alias("column"), F.lit(rule).alias("rule"), F.col(f"n{i}").alias("violations"))
        for i, (name, rule, _) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*entries))).where("violations > 0")


def repeated_primary_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that more than one row has, with the number of ``copies``.

    Rows are counted by the 64-bit hash of their key first, so that only hashes are shuffled, eight bytes a row. Keys
    themselves are grouped only where a hash has more than one row: all repeats, and the rare keys of equal hash. A key of
    one number is its own hash.
    """
    if len(key) == 1 and isinstance(df.schema[key[0]].dataType, T.IntegralType):
        return _several(df, key)
    hashed = df.select(*key, F.xxhash64(*key).alias("_hash"))
    shared = _several(hashed, ["_hash"]).select("_hash")
    return _several(hashed.join(shared, "_hash", "left_semi"), key)


def _several(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
