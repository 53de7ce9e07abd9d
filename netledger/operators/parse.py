"""Message text to typed records, with a quarantine for what cannot be used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netledger import schemas
from netledger.functions.text import is_blank, text_or_blank
from netledger.operators.once import with_once


def _number_problem(text: Column, name: str) -> Column:
    """Why a number is not taken as it stands; amounts are never rounded."""
    kind = schemas.NUMERIC[name]
    if kind != schemas.MONEY:
        return F.when(text.try_cast(kind).isNull(), f"{name} is not a number")
    wide, narrow = text.try_cast(schemas.WIDE), text.try_cast(kind)
    return (F.when(text.try_cast("double").isNull(), f"{name} is not a number")
            .when(wide.isNull() | narrow.isNull(), f"{name} is out of range")
            .when((wide != narrow) | text.rlike(r"\.\d{2}\d*[1-9]"), f"{name} has more than 2 decimals"))


def read_messages(raw: DataFrame, keys: dict[str, str], key_columns: list[str],
                  positioned: bool = False) -> DataFrame:
    """Parse ``raw.value`` (JSON text) into the columns named by ``keys``.

    Unknown keys are ignored, missing values get their defaults, blank numbers are 0.
    ``problem`` is NULL for usable rows and says what is wrong otherwise. Columns
    besides ``value`` are kept. An ``arrival`` is preceded by the line's position where the
    message carries one; ``positioned`` makes the position alone the arrival.
    """
    schema = schemas.message_schema(keys)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    others: list = [c for c in raw.columns if c not in ("value", "arrival")]
    parsed = with_once(raw, "m", F.from_json("value", schema, options))

    columns, problems = [], []
    for key, name in keys.items():
        text = F.col(f"m.{key}")
        if name in schemas.NUMERIC:
            number = F.trim(text).try_cast(schemas.NUMERIC[name])
            zero = F.lit(0).cast(schemas.NUMERIC[name])
            columns.append(F.when(is_blank(text), zero).otherwise(number).alias(name))
            problems.append(F.when(~is_blank(text), _number_problem(F.trim(text), name)))
        else:
            columns.append(text_or_blank(text).alias(name))
    broken = F.col("value").isNull() | F.col("m").isNull() | F.col("m._broken").isNotNull()
    for name in key_columns:
        key = next(k for k, v in keys.items() if v == name)
        problems.append(F.when(text_or_blank(F.col(f"m.{key}")) == "", f"{name} is missing"))
    place = F.col(f"m.{schemas.POSITION}")
    if "arrival" in raw.columns:
        others.append(F.struct(place.alias("position"), F.col("arrival").alias("order")).alias("arrival"))
    elif positioned:
        others.append(place.alias("arrival"))
    problem = F.coalesce(F.when(broken, "not a JSON object"), *problems)
    return parsed.select(*columns, *others, "value", problem.alias("problem"))


def read_normal(raw: DataFrame, positioned: bool = False) -> DataFrame:
    return read_messages(raw, schemas.NORMAL_KEYS, ["id"], positioned)


def read_incre(raw: DataFrame, positioned: bool = False) -> DataFrame:
    return read_messages(raw, schemas.INCRE_KEYS, ["plt_ssn"], positioned)


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull()).drop("problem", "value")


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNotNull()).select("value", "problem")


def message_text(keys: dict[str, str]) -> Column:
    """The JSON message of a row: every value is a string."""
    return F.to_json(F.struct(*[F.col(name).cast("string").alias(key)
                                for key, name in keys.items()]))
