"""Published tables in folders or in the catalog, and the scratch tables of a run.

Publishing is atomic. The tables of a run are written under names of their own; then one row is appended to the list of
publications, which names them all. Readers resolve a table through the latest row that has it, so they see the tables
of a whole run or of the one before, whatever fails in between. Older versions go after the switch.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.session import release, shared_folder

PUBLICATIONS = "_publications"
FAILED_RUNS = "_failed"
ENTRY = "name string, version string, moment bigint"


def settle(df: DataFrame, purpose: str, *partition_by: str, folder: str | None = None) -> DataFrame:
    """Write to a fresh shared folder, or below ``folder``, and read back: fixes the rows and cuts the lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose) if folder is None else f"{folder}/{purpose}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class FolderSink:
    """Tables below ``root``: a folder for each version, and the list of publications."""

    root: str
    format: str = "parquet"

    def publish(self, spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
        """Write all tables, then let readers see them at once."""
        version = uuid.uuid4().hex
        for name, df in tables.items():
            self._write(df, name, version)
        older = [(name, self._version(spark, name)) for name in tables]
        entries = [(name, version, time.time_ns()) for name in tables]
        # one task writes one file, and committing it is the switch
        self._append(spark.createDataFrame(entries, ENTRY).coalesce(1))
        for name, old in older:
            if old is not None:
                self._drop(spark, name, old)

    def read(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        """The published table; before the first publication there is none."""
        version = self._version(spark, name)
        if version is None:
            raise LookupError(f"{name} has not been published")
        return self._read(spark, name, version, schema)

    def keep_failed(self, df: DataFrame, name: str) -> DataFrame:
        """Store the log of a failed run apart from the published tables."""
        return self._read(df.sparkSession, f"{FAILED_RUNS}/{name}", self._write(df, f"{FAILED_RUNS}/{name}"), df.schema)

    def _version(self, spark: SparkSession, name: str) -> str | None:
        entries = self._entries(spark)
        if entries is None:
            return None
        latest = entries.where(F.col("name") == name).agg(F.max_by("version", "moment")).first()
        return latest[0]

    def _write(self, df: DataFrame, name: str, version: str | None = None) -> str:
        version = version or uuid.uuid4().hex
        df.write.format(self.format).save(f"{self.root}/{name}/{version}")
        return version

    def _read(self, spark: SparkSession, name: str, version: str, schema: T.StructType) -> DataFrame:
        return spark.read.format(self.format).schema(schema).load(f"{self.root}/{name}/{version}")

    def _append(self, entries: DataFrame) -> None:
        entries.write.mode("append").parquet(f"{self.root}/{PUBLICATIONS}")

    def _entries(self, spark: SparkSession) -> DataFrame | None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{PUBLICATIONS}")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return spark.read.schema(ENTRY).parquet(f"{self.root}/{PUBLICATIONS}")

    def _drop(self, spark: SparkSession, name: str, version: str) -> None:
        release(spark, f"{self.root}/{name}/{version}")


@dataclass(frozen=True)
class CatalogSink(FolderSink):
    """Tables of one database: one for each version, the list of publications, and a view with the table's name.

    The list decides for ``read``; the views follow it.
    """

    root: str = "default"

    def publish(self, spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
        super().publish(spark, tables)
        for name in tables:
            table = self._table(name, self._version(spark, name))
            spark.sql(f"CREATE OR REPLACE VIEW {self.root}.{name} AS SELECT * FROM {table}")

    def _table(self, name: str, version: str) -> str:
        return f"{self.root}.{name.replace('/', '_')}__{version}"

    def _write(self, df: DataFrame, name: str, version: str | None = None) -> str:
        version = version or uuid.uuid4().hex
        df.write.format(self.format).saveAsTable(self._table(name, version))
        return version

    def _read(self, spark: SparkSession, name: str, version: str, schema: T.StructType) -> DataFrame:
        return spark.table(self._table(name, version)).select(*schema.fieldNames())

    def _append(self, entries: DataFrame) -> None:
        entries.write.mode("append").saveAsTable(f"{self.root}.{PUBLICATIONS}")

    def _entries(self, spark: SparkSession) -> DataFrame | None:
        table = f"{self.root}.{PUBLICATIONS}"
        return spark.table(table) if spark.catalog.tableExists(table) else None

    def _drop(self, spark: SparkSession, name: str, version: str) -> None:
        """Kept: the view names the old version until it is replaced, and readers may hold it; see ``expire``."""

    def expire(self, spark: SparkSession, name: str) -> None:
        """Drop all versions of a table but the published one."""
        prefix, current = f"{name}__", self._version(spark, name)
        for table in spark.catalog.listTables(self.root):
            if table.name.startswith(prefix) and table.name != f"{prefix}{current}":
                spark.sql(f"DROP TABLE {self.root}.{table.name}")


Sink = FolderSink

MONTH = "mes"


def publish_months(rows: DataFrame, path: str, date: str) -> None:
    """Write rows into a table at ``path`` that is partitioned by the month of ``date``, in place of what it has of these months.

    Months that the rows do not have are left as they are. Rows of a month go to as many tasks as their number asks for,
    not to one. Spark replaces month by month: a reader may meet some months old and some new, which ``FolderSink`` rules
    out at the price of writing whole tables.
    """
    dated = rows.withColumn(MONTH, F.date_format(date, "yyyy-MM"))
    # a rebalance splits large months and gathers small ones; a shuffle by month would put a hot month into one task
    dated = dated.hint("rebalance", MONTH)
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def read_months(spark: SparkSession, path: str, schema: T.StructType, first: str, last: str) -> DataFrame:
    """The rows of the months from ``first`` to ``last`` (``yyyy-MM``), from their folders alone."""
    held = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])
    table = spark.read.schema(held).parquet(path)
    return table.where(F.col(MONTH).between(first, last)).drop(MONTH)


def reset(spark: SparkSession, sink: Sink, tables: Mapping[str, T.StructType]) -> None:
    """Publish empty tables in place of those there are."""
    sink.publish(spark, {name: spark.createDataFrame([], schema) for name, schema in tables.items()})
