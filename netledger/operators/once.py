"""Costly expressions evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add ``expression`` as column ``name`` behind a one-element explode.

    The optimizer copies a projected expression into the filters above it, so a parsed
    message or a split line would be computed again for every condition. It does not
    move filters below an explode.
    """
    return df.select(*df.columns, F.explode(F.array(expression)).alias(name))
