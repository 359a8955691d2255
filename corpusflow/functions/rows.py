"""Expressions that are evaluated once per row.

The optimizer may copy the expression behind a column into every filter and projection that uses the column. A
generator over a one-element array keeps a costly expression in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_present(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column and keep the rows in which it is not null."""
    return df.select("*", F.explode(F.array_compact(F.array(value))).alias(name))
