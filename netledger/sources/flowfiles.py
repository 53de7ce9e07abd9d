"""Payment flow files to JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netledger import schemas
from netledger.functions.text import slice_encoded
from netledger.operators.once import with_once
from netledger.sources.lines import read_lines


def delimited_fields(lines: DataFrame, positions: dict[str, int] = schemas.NORMAL_POSITIONS) -> DataFrame:
    """Pick the configured pieces of a pipe separated line, trimmed.

    ``problem`` names lines that are too short.
    """
    needed = max(positions.values()) + 1
    short = F.when(F.size("parts") < needed, F.lit("too few columns"))
    return (with_once(lines, "parts", F.split("line", r"\|"))
            .select(*[F.trim(F.get("parts", F.lit(i))).alias(name) for name, i in positions.items()],
                    *[c for c in lines.columns], short.alias("problem")))


def fixed_width_fields(lines: DataFrame, ranges: dict[str, tuple[int, int]] = schemas.INCRE_BYTES,
                       charset: str = "GBK") -> DataFrame:
    """Cut the configured byte ranges out of a line; the line is encoded once."""
    raw = with_once(lines, "_raw", F.encode("line", charset))
    first_end = min(end for _, end in ranges.values())
    short = F.when(F.octet_length("_raw") < first_end, F.lit("too few bytes"))
    return raw.select(*[slice_encoded(F.col("_raw"), b, e, charset).alias(name)
                        for name, (b, e) in ranges.items()],
                      *lines.columns, short.alias("problem"))


def to_messages(fields: DataFrame, names: list[str]) -> DataFrame:
    """One JSON object per usable line, in column ``value``; it carries where the line stood."""
    place = [F.col("position").alias(schemas.POSITION)] if "position" in fields.columns else []
    return (fields.filter(F.col("problem").isNull())
            .select(F.to_json(F.struct(*names, *place)).alias("value")))


def normal_messages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return to_messages(delimited_fields(read_lines(spark, paths)), list(schemas.NORMAL_POSITIONS))


def incre_messages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return to_messages(fixed_width_fields(read_lines(spark, paths)), list(schemas.INCRE_BYTES))


def bad_lines(fields: DataFrame) -> DataFrame:
    """Lines that gave no message, with the reason and where they stood."""
    place = ["position"] if "position" in fields.columns else []
    return fields.filter(F.col("problem").isNotNull()).select("line", "problem", *place)
