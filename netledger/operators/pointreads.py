"""Point reads and small dynamic lookups; every predicate reaches the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netledger.operators.joins import lookup

_COMPARE = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "like": lambda a, b: a.like(b),
}


def condition(column: str, operator: str, value) -> Column:
    """``column operator value`` with the value as a typed literal."""
    try:
        compare = _COMPARE[operator.strip().lower()]
    except KeyError:
        raise ValueError(f"operator {operator!r} is not one of {sorted(_COMPARE)}") from None
    return compare(F.col(column), value if operator.strip().lower() == "like" else F.lit(value))


def read_cell(table: DataFrame, key: str, row_key, column: str) -> DataFrame:
    """One row, column ``value``: the cell as text, empty when absent."""
    cell = F.max(F.col(column).cast("string"))
    return table.filter(F.col(key) == F.lit(row_key)).agg(F.coalesce(cell, F.lit("")).alias("value"))


def cell_exists(table: DataFrame, key: str, row_key, column: str) -> DataFrame:
    """One row, column ``found``."""
    return (table.filter((F.col(key) == F.lit(row_key)) & F.col(column).isNotNull())
            .agg((F.count(F.lit(1)) > 0).alias("found")))


def get_rows(table: DataFrame, key: str, row_key) -> DataFrame:
    return table.filter(F.col(key) == F.lit(row_key))


def where_number(table: DataFrame, column: str, operator: str, value) -> DataFrame:
    """Filter on a text column read as a number; text that is no number never matches."""
    number = F.col(column).try_cast("double")
    return table.withColumn("_number", number).filter(
        condition("_number", operator, value)).drop("_number")


def first_value(table: DataFrame, target: str, *conditions: Column) -> DataFrame:
    """The smallest ``target`` among the rows that meet all conditions (one row)."""
    rows = table
    for c in conditions:
        rows = rows.filter(c)
    return rows.agg(F.min(target).alias("value"))


def first_value_of_type(table: DataFrame, target: str, type_id, *conditions: Column) -> DataFrame:
    return first_value(table, target, F.col("type_id") == F.lit(type_id), *conditions)


def first_ranked(table: DataFrame, target: str, order: list[Column], *conditions: Column) -> DataFrame:
    """``target`` of the first row in ``order``; no row when nothing meets the conditions."""
    rows = table
    for c in conditions:
        rows = rows.filter(c)
    return rows.orderBy(*order).limit(1).select(F.col(target).alias("value"))


def has_match(flow: DataFrame, table: DataFrame, keys: list[str], **options) -> DataFrame:
    """Rows of ``flow`` that have a row in ``table``."""
    listed = table.select(*keys)
    return lookup(flow, listed.distinct(), keys, how="left_semi", bound=listed, **options)
