"""Keyed sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_maps(pairs: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """Merge key -> number maps by adding; a missing key counts as 0."""
    return pairs.groupBy(key).agg(F.sum(value).alias(alias))


def merchant_totals(settled: DataFrame) -> DataFrame:
    """Exact net total per resolved merchant over the rows that settled."""
    return merge_maps(settled.filter("settled"), "mer_no", "net", "total")


def add_totals(*totals: DataFrame) -> DataFrame:
    """Add partial totals, e.g. of several batches."""
    job = totals[0]
    for other in totals[1:]:
        job = job.unionByName(other)
    return merge_maps(job, "mer_no", "total", "total")
