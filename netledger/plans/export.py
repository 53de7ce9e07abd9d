"""Summary export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netledger.functions.text import label_value


def plain(total: Column) -> Column:
    """A decimal with all its digits: no exponent, no zeros at the end of its fraction."""
    return F.regexp_replace(F.regexp_replace(total.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def summary_lines(totals: DataFrame) -> DataFrame:
    """``merchant, total`` per row, the total in plain decimal notation."""
    return totals.select(label_value("mer_no", plain(F.col("total"))).alias("line"))


def export_summary(totals: DataFrame, path: str) -> None:
    """Write the lines as text files below ``path``, replacing what was there."""
    summary_lines(totals).write.mode("overwrite").text(path)
