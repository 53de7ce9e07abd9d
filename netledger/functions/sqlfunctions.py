"""SQL functions offered to users of ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession

from netledger.functions.text import decode_list_sql


def square(value: Column) -> Column:
    return value * value


def register(spark: SparkSession) -> None:
    """Register ``sqr(x)`` and ``decode_list(text)`` as temporary SQL functions.

    ``sqr`` is the product of two Java ints, of which the low 32 bits remain; ANSI arithmetic would stop at |x| > 46340.
    """
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION sqr(x INT) RETURNS INT RETURN "
              "CAST(shiftright(shiftleft(CAST(x AS BIGINT) * CAST(x AS BIGINT), 32), 32) AS INT)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION decode_list(t STRING) RETURNS INT "
              f"RETURN {decode_list_sql('t')}")
