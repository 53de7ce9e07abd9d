"""Wide rows from (row key, column, value) cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netledger.operators.joins import lookup


def wide_rows(cells: DataFrame, key: str, column: str, value: str, order: str,
              columns: list[str] | None = None) -> DataFrame:
    """One row per key; the last written cell wins and a NULL value is empty text.

    Without ``columns`` the row's cells are one map column ``cells``, which holds any number of names.
    """
    if columns is None:
        last = cells.groupBy(key, column).agg(F.max(F.struct(F.col(order), F.coalesce(
            F.col(value).cast("string"), F.lit("")).alias("v")))["v"].alias("v"))
        return last.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "v")))).alias("cells"))
    aggregates = []
    for name in columns:
        mine = F.col(column) == name
        last = F.max(F.when(mine, F.struct(F.col(order), F.coalesce(
            F.col(value).cast("string"), F.lit("")).alias("v"))))
        aggregates.append(last["v"].alias(name))
    return cells.groupBy(key).agg(*aggregates)


def one_cell(spark, key: str, row_key: str, column: str, value: str | None) -> DataFrame:
    """A single cell as a one-row wide table."""
    return spark.createDataFrame([(row_key, value or "")], f"{key} string, {column} string")


def delete_keys(table: DataFrame, keys: DataFrame, key: str, **options) -> DataFrame:
    """``table`` without the rows whose key is listed."""
    listed = keys.select(key)
    return lookup(table, listed.distinct(), [key], how="left_anti", bound=listed, **options)
