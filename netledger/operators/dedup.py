"""Deduplication and first-match reduction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a key that one task takes without cutting them before the exchange; hash ranges that are counted, and heavy ones listed at most.
HEAP_ROWS, HASH_RANGES, HEAPS = 1_000_000, 1 << 16, 1_000


def top_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key.

    ``row_number() = 1`` makes Spark cut every key to one row per map task before the
    exchange, so a key that holds much of the data sends next to nothing.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def top_one_of_many(df: DataFrame, keys: list[str], order: list[Column], heap_rows: int = HEAP_ROWS, dealt: tuple[str, ...] = ()) -> DataFrame:
    """``top_one`` for wide tables whose keys hardly repeat.

    Cutting each key before the exchange sorts all rows of a map task, more than its memory holds where they are wide. So only keys that may
    hold more than ``heap_rows`` rows are cut before: one narrow job counts the rows of hash ranges of the keys, and the heaviest go through
    ``top_one``. The counts decide the way a key goes, never the result; a range beyond the ``HEAPS`` listed ones has less than a
    ``HEAPS``-th of all rows. ``dealt`` names columns that follow from the keys: rows are dealt by them, as a write of the result may need.
    """
    heap = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(HASH_RANGES))
    counts = df.select(heap.alias("_heap")).groupBy("_heap").count().filter(F.col("count") > heap_rows)
    heavy = [r["_heap"] for r in counts.orderBy(F.col("count").desc()).limit(HEAPS).collect()]
    window = Window.partitionBy(*dealt, *keys).orderBy(*order)

    def first(rows: DataFrame) -> DataFrame:
        rows = rows.repartition(*dealt) if dealt else rows
        # Not a row number: a filter on that would bring the cut before the exchange back.
        return rows.withColumn("_before", F.lag(F.lit(True)).over(window)).filter(F.col("_before").isNull()).drop("_before")

    if not heavy:
        return first(df)
    return first(df.filter(~heap.isin(heavy))).unionByName(top_one(df.filter(heap.isin(heavy)), keys, order))


def latest(df: DataFrame, keys: list[str], arrival: str = "arrival", heap_rows: int = HEAP_ROWS) -> DataFrame:
    """Last arrival per key wins; ``arrival`` is any orderable column (or struct).

    Rows that tie on it are ordered by a hash of their values, so a repeated task
    chooses the same one.
    """
    others = [c for c in df.columns if c != arrival and c not in keys]
    order = [F.col(arrival).desc()] + ([F.xxhash64(*others).asc()] if others else [])
    return top_one_of_many(df, keys, order, heap_rows)
