"""Dimension files to tables: last line per loader key wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netledger import schemas
from netledger.functions.text import pieces
from netledger.operators.dedup import top_one
from netledger.operators.lookups import loader_key
from netledger.operators.once import with_once
from netledger.sources.lines import read_lines

# Columns the loader leaves empty, and those a line must carry as numbers.
_EMPTY = ("upd_datetime", "upd_user_id")


def _typed(parts: dict[str, Column], types: dict[str, str]) -> tuple[list[Column], Column]:
    columns, bad = [], F.lit(False)
    for name, kind in types.items():
        if name in _EMPTY:
            columns.append(F.lit("").alias(name))
            continue
        piece = parts[name]
        value = piece if kind == "string" else F.trim(piece).try_cast(kind)
        columns.append(value.alias(name))
        bad = bad | value.isNull()
    return columns, F.when(bad, F.lit("column missing or not a number"))


def parse_positions(lines: DataFrame, types: dict[str, str],
                    positions: dict[str, int] | None = None) -> DataFrame:
    """Typed columns by configured 0-based position; ``problem`` marks unusable lines."""
    positions = positions or {name: i for i, name in enumerate(types)}
    split = with_once(lines, "_p", pieces(F.trim("line")))
    columns, problem = _typed({n: F.get("_p", F.lit(i)) for n, i in positions.items()}, types)
    return split.select(*columns, *lines.columns, problem.alias("problem"))


def parse_codes(lines: DataFrame) -> DataFrame:
    """Transaction codes: the key itself may hold the delimiter.

    Runs of pipes get a blank between them first, so empty pieces count. The other 11
    columns are taken from the end and all pieces before them form the key.
    """
    # The two replacements decide which pieces count.
    spaced = F.replace(F.replace("line", F.lit("|||"), F.lit("| | |")), F.lit("||"), F.lit("| |"))
    split = with_once(lines, "_p", pieces(F.trim(spaced))).withColumn("_n", F.size("_p"))
    names = list(schemas.CODE_COLUMNS)
    parts = {name: F.get("_p", F.col("_n") - len(names) + i) for i, name in enumerate(names)}
    parts["txn_key"] = F.when(F.col("_n") >= len(names), F.array_join(
        F.slice("_p", F.lit(1), F.col("_n") - len(names) + 1), "|"))
    columns, problem = _typed(parts, schemas.CODE_COLUMNS)
    return split.select(*columns, *lines.columns, problem.alias("problem"))


def keep_last(parsed: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Upsert semantics: per run-together key text the last line of the file stays."""
    usable = parsed.filter(F.col("problem").isNull())
    return top_one(usable.withColumn("_key", loader_key(key)), ["_key"],
                   [F.col("position").desc()]).select(*columns)


def parse_dimension(lines: DataFrame, name: str, positions: dict[str, int] | None = None) -> DataFrame:
    if name == "codes":
        return parse_codes(lines)
    return parse_positions(lines, schemas.DIMENSION_COLUMNS[name], positions)


def read_dimension(spark: SparkSession, name: str, paths: str | list[str],
                   positions: dict[str, int] | None = None) -> DataFrame:
    """One of ``fees``, ``codes``, ``groups``, ``mappings`` from its GBK file."""
    parsed = parse_dimension(read_lines(spark, paths), name, positions)
    return keep_last(parsed, schemas.LOADER_KEYS[name], list(schemas.DIMENSION_COLUMNS[name]))
