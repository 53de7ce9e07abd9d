"""Divided joins give the broadcast result, keep rows and spread heavy keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from netledger.operators.joins import JoinPolicy, Spread, attach, fits_broadcast, heavy_values, lookup, measure, within_budget
from tests.helpers import frame

TINY = JoinPolicy(broadcast_bytes=0, rows_per_part=50)


@pytest.fixture(scope="module")
def flow(spark):
    """A third of the rows on one key, a third without a key, all exact copies."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (
        F.col("id") % 100).cast("string")))
    return spark.range(3000).repartition(8).select(key.alias("k"), F.lit("copy").alias("v"))


@pytest.fixture(scope="module")
def dim(spark):
    return frame(spark, [("hot", 1), ("k1", 2), ("k4", 3), ("unused", 4)], "k string, r int")


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_divided_equals_broadcast(flow, dim, how):
    a, b = lookup(flow, dim, ["k"], TINY, how), lookup(flow, dim, ["k"], JoinPolicy(), how)
    cols = sorted(b.columns)
    assert set(a.columns) == set(cols)
    assert a.select(cols).exceptAll(b.select(cols)).isEmpty()
    assert a.count() == b.count()


def test_left_keeps_every_row(flow, dim):
    assert lookup(flow, dim, ["k"], TINY).count() == 3000


def test_heavy_key_and_missing_keys_are_spread(flow):
    spread = Spread(flow, ["k"], "part", TINY)
    parts = {r.k: r.n for r in spread.divide(flow).groupBy("k").agg(
        F.count_distinct("part").alias("n")).collect()}
    assert parts["hot"] >= 4
    assert parts[None] >= 4
    assert parts["k1"] == 1


def test_several_keys_are_counted_together(spark, flow):
    heavy = heavy_values(flow.withColumn("w", F.lit("all")), ["k", "w"], TINY)
    assert [(r.k, r["_parts"]) for r in heavy["k"].collect()] == [("hot", 20)]
    assert [(r.w, r["_parts"]) for r in heavy["w"].collect()] == [("all", 60)]


def test_copies_are_bounded_by_the_flow(flow, dim):
    spread = Spread(flow, ["k"], "part", TINY)
    assert spread.copy(dim).count() == 3 + 1000 // 50


def test_measured_size_decides(spark):
    small, large = spark.range(10), spark.range(200_000)
    assert fits_broadcast({"s": small, "l": large}, JoinPolicy(broadcast_bytes=1 << 20)) == {"s"}
    text = spark.range(1000).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert measure({"t": text})["t"] > 1_000_000
    assert measure({"t": text.limit(0)})["t"] == 0


def test_growth_by_explode_is_measured(spark):
    grown = spark.range(1000).select(F.explode(F.sequence(F.lit(1), F.lit(100))).alias("x"))
    assert measure({"g": grown})["g"] >= 100_000 * 16


def test_no_broadcast_of_the_dimension_when_too_large(flow, dim):
    plan = attach(flow, dim, ["k"], False, Spread(flow, ["k"], "part", TINY))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") == 1
    assert text.count("BroadcastHashJoin") == 2  # only the bounded list of heavy keys


def test_all_sides_share_one_budget(spark):
    """Five sides just below the limit do not fit together; the largest go to the exchange first."""
    assert within_budget({"a": 99, "b": 98, "c": 97, "d": 1, "e": 1}, 100) == {"c", "d", "e"}
    assert within_budget(dict.fromkeys("abcde", 95), 100) == {"a"}
    sides = {f"s{k}": spark.range(900 + k) for k in range(5)}
    size = measure({"s": sides["s4"]})["s"]
    assert fits_broadcast(sides, JoinPolicy(broadcast_bytes=size + 1)) == {"s0"}
    assert len(fits_broadcast(sides, JoinPolicy(broadcast_bytes=5 * size))) == 5


def test_a_stream_join_is_balanced_without_counting(spark):
    """80 % of the rows have no store key, half of the others one merchant that an earlier count has listed."""
    flow = spark.range(40_000).repartition(8).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") % 10 < 8, None).when(F.col("id") % 10 == 8, "hot").otherwise(
            F.concat(F.lit("k"), "id")).alias("_store_item"))
    side = flow.select("_store_item").na.drop().distinct().withColumn("r", F.lit(1))
    listed = frame(spark, [("hot", 16)], "_store_item string, _parts bigint")
    session = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = Spread(flow, ["_store_item"], "_part", TINY, listed, ["id"])
        joined = attach(flow, side, ["_store_item"], False, spread)
        rows = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert joined.filter("r IS NOT NULL").count() == 8_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", session)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(rows) == 40_000 and len(rows) == 16 and max(rows) <= 2 * 40_000 / 16
