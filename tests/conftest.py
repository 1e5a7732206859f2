from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

from tallybook.session import get_session  # noqa: E402



@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("shared")
    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.checkpoint.dir": str(scratch / "checkpoints"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def csv(tmp_path):
    """Write lines as one file with a header; returns its path."""

    def write(lines, name="input.csv", header="any,header,line"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
        return str(path)

    return write


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    changed = {}

    def set_all(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_all
    for name, value in changed.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
