"""Exact decimal arithmetic; ``F.round`` on decimals rounds half up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def interest(balance: Column, rate: Column) -> Column:
    """Interest in cents, from the unrounded balance."""
    return F.round(balance * rate, 2)


def balance_after(balance: Column, rate: Column) -> Column:
    """The unrounded balance plus the rounded interest, in cents."""
    return F.round(balance + interest(balance, rate), 2)
