"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

SCRATCH = "tallybook.scratch.dir"

_RUN: ContextVar[str | None] = ContextVar("run folder", default=None)

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app_name: str = "tallybook", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs assume; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path for intermediate data in the folder that the driver and every executor share.

    The folder is the one of ``spark.checkpoint.dir``; where that is unset, as in tests, the session setting
    ``tallybook.scratch.dir``. There is no default: a folder of one machine would lose data on a cluster.
    """
    base = _RUN.get() or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)
    if not base:
        raise ValueError(f"set spark.checkpoint.dir or {SCRATCH} to a folder that all executors share")
    return f"{base.rstrip('/')}/tallybook-{purpose}-{uuid.uuid4().hex}"


def use_local_scratch(spark: SparkSession) -> None:
    """Name a fresh temporary folder for a local session that names none, as tests do; a cluster must set its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)
    master = spark.sparkContext.master
    if not named and (master == "local" or master.startswith("local[")):
        spark.conf.set(SCRATCH, tempfile.mkdtemp(prefix="tallybook-"))


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A shared folder for all intermediate data of a run, to be released as a whole."""
    path = shared_folder(spark, "run")
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)


def release(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
