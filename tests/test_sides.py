"""Stored lookup sides: equal results, no exchange of a side, balanced tasks, publication."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from netledger import schemas
from netledger.operators.joins import JoinPolicy
from netledger.plans.settlement import NORMAL, Lookups, settle, settle_with
from netledger.plans.sides import open_sides, sides_version, write_sides
from netledger.sinks import publish
from tests.helpers import dimensions, normal_rows

# A budget below every side of the fixture but above its heavy rows, and none at all.
LARGE = JoinPolicy(broadcast_bytes=8_000, rows_per_part=100)
NONE = JoinPolicy(broadcast_bytes=0, rows_per_part=100)


def tables(spark):
    keys = range(400)
    return dimensions(
        spark, codes_=[(f"0200|{k}|00", "0", -1) for k in keys] + [("0200|00|00", "0", -1)],
        groups_=[(f"M{k}", g) for k in keys for g in ("APL", f"G{k}")] + [("\x000", "APL")],
        mappings_=[("1", "1", f"M{k},T{k % 7}", f"R{k}") for k in keys] + [("2", "1082", f"M{k},S{k % 9:03d}", f"Q{k}") for k in keys],
        fees_=[(f"M{k}", 1, "1", "11", "0", "0.5", "-1", "99") for k in keys if k % 3])


def flow(spark):
    k = F.col("id").cast("int")
    rows = spark.range(2_000).select(F.col("id").cast("string").alias("id"))
    base = normal_rows(spark, [{}]).drop("id")
    made = rows.crossJoin(F.broadcast(base))
    # A third of the rows belong to one merchant, a third have none.
    mid = F.when(k % 3 == 0, "M1").when(k % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("M"), (k % 450).cast("string")))
    return made.withColumns({"mid": mid, "tid": F.concat(F.lit("T"), (k % 7).cast("string")),
                             "proc_code": F.when(k % 2 == 0, (k % 400).cast("string")).otherwise("00"),
                             "rsv4": F.concat(F.lit(" " * 20), F.lit("S"), F.lpad((k % 9).cast("string"), 3, "0"))})


def settled(df):
    return sorted(map(str, df.select("id", "mer_no", "group_id", "filter_flag", "no_fee_profile", "fee", "net").collect()))


@pytest.mark.parametrize("policy", [LARGE, NONE, JoinPolicy()])
def test_stored_sides_settle_alike(spark, tmp_path, policy):
    target = str(tmp_path / "dims")
    write_sides(tables(spark), target, buckets=4)
    stored = Lookups(open_sides(spark, None, target), NORMAL, policy)
    got = settled(settle_with(flow(spark), stored))
    assert got == settled(settle(flow(spark), tables(spark), NORMAL)) and len(got) == 2_000
    assert any("group_id='APL,G1'" in row for row in got)


def test_no_exchange_of_a_side(spark, tmp_path):
    """Four sides are joined bucket by bucket: the flow is exchanged once per key, the sides never."""
    target = str(tmp_path / "dims")
    write_sides(tables(spark), target, buckets=4)
    opened = open_sides(spark, None, target)
    few = JoinPolicy(broadcast_bytes=1, rows_per_part=10_000)
    plan = settle_with(flow(spark), Lookups(opened, NORMAL, few), deduplicate=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SelectedBucketsCount: 4 out of 4") == 5 and plan.count("SortMergeJoin") == 5
    # codes, merchant (groups and fees), terminals, stores; the fifth would be a side's.
    assert plan.count("Exchange hashpartitioning") == 4


def test_keyless_and_heavy_rows_are_scattered(spark, tmp_path):
    target = str(tmp_path / "dims")
    write_sides(tables(spark), target, buckets=8)
    from netledger.operators.joins import attach_stored, heavy_rows

    side = open_sides(spark, None, target).stored["groups"][0]
    rows = flow(spark).withColumn("_merchant", F.col("mid"))
    listed = spark.createDataFrame([("M1", 7), ("absent", 2)], "_merchant string, _parts long")
    heavy, size = heavy_rows(side, "_merchant", listed)
    assert size > 0 and {r._merchant: r._found is None for r in heavy.collect()} == {"M1": False, "absent": True}
    out = attach_stored(rows, side, "_merchant", heavy, ["id"])
    held = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 2_000 and max(held) <= 2 * 2_000 / 8
    got = {(r.mid, r.group_id) for r in out.select("mid", "group_id").distinct().collect()}
    assert ("M1", "APL,G1") in got and (None, None) in got and ("M2", "APL,G2") in got and ("M449", None) in got


def test_publications_are_numbered_and_newer_ones_stay(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "dims")
    assert sides_version(spark, target) == "None"
    with pytest.raises(ValueError):
        open_sides(spark, None, target)

    def versioned(version):
        dims = tables(spark)
        return type(dims)(dims.codes, dims.groups, dims.mappings, dims.fees, version)

    assert write_sides(versioned("0,0,0,0"), target) == 0
    assert write_sides(versioned("0,0,0,1"), target) == 1
    # A writer that started from older tables leaves the newest publication.
    assert write_sides(versioned("0,0,0,0"), target) == 1 and sides_version(spark, target) == "1"
    # One that loses the race for a number publishes under the next.
    claim, raced = publish.claim, []

    def race(*args):
        if not raced:
            raced.append(claim(*args))
            return False
        return claim(*args)

    monkeypatch.setattr(publish, "claim", race)
    text = versioned("1,0,0,1")
    monkeypatch.setattr("netledger.plans.sides._covers", lambda published, versions: False)
    assert write_sides(text, target) == 3
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("netledger_")]


def test_another_session_opens_them(spark, tmp_path):
    target = str(tmp_path / "it's")
    write_sides(tables(spark), target, buckets=2)
    opened = open_sides(spark.newSession(), None, target)
    assert opened.stored["fees"][0].count() == 266 and opened.files()
    assert set(opened.stored) == {"codes", "groups", "fees", "terminals", "stores_normal", "stores_incre"}
    assert schemas.DIMENSION_COLUMNS  # whole tables are not needed
