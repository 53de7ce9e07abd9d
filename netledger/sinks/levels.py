"""Totals of batches, rolled up into larger ones: 16 parts of a level make one of the next.

``path/level=L/part=K`` holds the sums of the batches from K * 16^L up to (K + 1) * 16^L - 1; ``path/rolled/L-K`` marks a part as whole. Readers
take the largest whole parts, so they open a number of parts that grows with the logarithm of the number of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from netledger.operators.totals import merge_maps
from netledger.sinks import publish

FAN_IN = 16


def write(totals: DataFrame, path: str, batch_id: int) -> None:
    """The totals (mer_no, total) of one batch; written again, they replace themselves."""
    totals.write.mode("overwrite").parquet(f"{path}/level=0/part={batch_id}")


def _rolled(spark: SparkSession, path: str) -> set[tuple[int, int]]:
    return {tuple(map(int, n.split("-"))) for n in publish.names(spark, f"{path}/rolled") if n[0].isdigit()}


def parts(spark: SparkSession, path: str, batches: list[int]) -> list[tuple[int, int]]:
    """The fewest whole parts (level, number) that hold the given batches, which are all committed ones."""
    rolled, out, left = _rolled(spark, path), [], sorted(batches)
    for level, part in sorted(rolled, reverse=True):
        low, high = part * FAN_IN ** level, (part + 1) * FAN_IN ** level
        own = [b for b in left if low <= b < high]
        if own:
            out.append((level, part))
            left = [b for b in left if not low <= b < high]
    return out + [(0, b) for b in left]


def read(spark: SparkSession, path: str, batches: list[int], schema: T.StructType) -> DataFrame:
    """mer_no -> total over the given batches."""
    chosen = parts(spark, path, batches)
    if not chosen:
        return merge_maps(spark.createDataFrame([], schema), "mer_no", "total", "total")
    rows = spark.read.schema(schema).parquet(*[f"{path}/level={level}/part={part}" for level, part in chosen])
    return merge_maps(rows, "mer_no", "total", "total")


def roll(spark: SparkSession, path: str, batch_id: int, batches: list[int], schema: T.StructType) -> None:
    """Sum up every part that ends with this committed batch. A part is marked after it is written."""
    level = 1
    while (batch_id + 1) % FAN_IN ** level == 0:
        part = batch_id // FAN_IN ** level
        own = [b for b in batches if b // FAN_IN ** level == part]
        summed = read(spark, path, own, schema)
        summed = summed.select(*[summed[f.name].cast(f.dataType) for f in schema.fields])
        summed.write.mode("overwrite").parquet(f"{path}/level={level}/part={part}")
        publish.put_text(spark, f"{path}/rolled/{level}-{part}", "")
        level += 1
