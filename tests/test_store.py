"""The keyed store, its publications and the levels of totals."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netledger.sinks import levels, publish, tables
from netledger.sinks.store import KeyedStore
from tests.helpers import dec, frame


def held(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_puts_keep_the_cells_they_do_not_name(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=4)
    store.put_cells(frame(spark, [("x", "1", "2"), ("y", None, "3"), (None, "no", "key")], "k string, a string, b string"), 0)
    store.put_cells(frame(spark, [("x", "9"), ("z", "8")], "k string, a string"), 1)
    want = {"x": ("9", "2"), "y": ("", "3"), "z": ("8", None)}
    assert held(store.view(["a", "b"])) == want
    store.put_cell("y", "a", None, 2)
    store.put_cell("x", "c", "new", 3)
    want = {k: (*v, "new" if k == "x" else None) for k, v in want.items()}
    for _ in range(2):
        assert held(store.view(["a", "b", "c"])) == want
        assert [store.read_cell("z", c).first().value for c in "ab"] == ["8", ""]
        assert [store.cell_exists("y", c).first().found for c in "abc"] == [True, True, False]
        store.compact()


def test_deleted_keys_come_back_by_a_later_put(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=4)
    store.put_cells(frame(spark, [("x", "1", "2"), ("y", "3", "4")], "k string, a string, b string"), 0)
    store.delete(frame(spark, [("x",), ("x",), ("other",)], "k string"), 1)
    assert held(store.view(["a", "b"])) == {"y": ("3", "4")}
    assert not store.cell_exists("x", "a").first().found
    store.put_cells(frame(spark, [("x", "5")], "k string, a string"), 2)
    for _ in range(2):
        assert held(store.view(["a", "b"])) == {"x": ("5", None), "y": ("3", "4")}
        store.compact()
    store.delete(frame(spark, [("x",), ("y",)], "k string"), 3)
    store.compact()
    store.vacuum()
    assert held(store.view(["a", "b"])) == {}


def test_last_arrival_and_nulls_of_whole_rows(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=2)
    rows = [("x", dec("1.00"), 1), ("x", None, 2), ("y", dec("5.00"), 1)]
    store.put_rows(frame(spark, rows, "k string, v decimal(14,2), t int"), 0, "t")
    assert held(store.view()) == {"x": (None,), "y": (dec("5.00"),)}
    store.write(frame(spark, [("y", dec("6.00"), 1)], "k string, v decimal(14,2), t int"), 1, "t")
    assert held(store.view()) == {"x": (None,), "y": (dec("5.00"),)}  # not committed
    with pytest.raises(ValueError, match="another type"):
        store.put_rows(frame(spark, [("y", "6")], "k string, v string"), 2)


def test_buckets_are_compacted_while_batches_arrive(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=4)
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").cast("string").alias("v"))
    store.put_cells(rows, 0)
    store.compact([1, 2])
    store.put_cells(rows.filter("k % 2 = 0").withColumn("v", F.lit("even")), 1)
    store.compact([2, 3])
    store.vacuum()
    store.put_cells(rows.filter("k % 5 = 0").select("k", F.lit("w").alias("w")), 2)
    want = {str(k): ("even" if k % 2 == 0 else str(k), "w" if k % 5 == 0 else None) for k in range(100)}
    assert held(store.view(["v", "w"])) == want
    store.compact()
    store.vacuum()
    assert held(store.view(["v", "w"])) == want
    assert publish.names(spark, f"{store.path}/batches") == [] and len(publish.names(spark, f"{store.path}/bases")) == 1


def test_a_point_read_opens_one_bucket(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=16)
    rows = spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"), F.lit("x").alias("wide"))
    store.put_rows(rows, 0)
    store.compact()
    store.put_cells(rows.select("k", "v"), 1)
    read = store.row(7, ["v"])
    assert read.collect()[0].v == "7"
    scans = str(read._jdf.queryExecution().executedPlan().toString()).split("PartitionFilters: ")[1:]
    assert len(scans) >= 2
    for scan in scans:
        assert re.match(r"\[isnotnull\(_bucket#\d+\), \(_bucket#\d+ = \d+\)\]", scan) and "EqualTo(k,7)" in scan
        assert "wide" not in scan.split("ReadSchema: ")[1].split("\n")[0]


def test_a_read_does_not_exchange_the_bases(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=4)
    store.put_rows(spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v")), 0)
    store.compact()
    assert "Exchange" not in store.view()._jdf.queryExecution().executedPlan().toString()


def test_one_of_two_claims_wins(spark, tmp_path):
    folder = str(tmp_path / "p")
    assert publish.newest(spark, folder) is None
    assert [publish.claim(spark, folder, 1, t) for t in ("first", "second")] == [True, False]
    assert publish.newest(spark, folder) == (1, "first")
    assert publish.claim(spark, folder, 2, "é") and publish.newest(spark, folder) == (2, "é")
    assert not [n for n in publish.names(spark, folder) if n.startswith(".")]


def test_a_lost_compaction_is_refused(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=2)
    store.put_rows(frame(spark, [("x", "1")], "k string, v string"), 0)
    write, other = store._files, KeyedStore(spark, store.path, "k")
    monkeypatch.setattr(store, "_files", lambda *a: (write(*a), other.compact()))
    with pytest.raises(RuntimeError, match="another compaction"):
        store.compact()
    assert held(store.view()) == {"x": ("1",)}


def test_new_columns_survive_a_lost_claim(spark, tmp_path, monkeypatch):
    store, other = (KeyedStore(spark, str(tmp_path / "s"), "k", buckets=2) for _ in range(2))
    claim = publish.claim
    first = [True]

    def raced(*args):
        if first.pop() if first else False:
            other.put_cells(frame(spark, [("x", "1")], "k string, b string"), 0)
        return claim(*args)

    monkeypatch.setattr(publish, "claim", raced)
    store.put_cells(frame(spark, [("x", "2")], "k string, a string"), 1)
    assert held(store.view(["a", "b"])) == {"x": ("2", "1")}


def test_lasting_views(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), "id", buckets=2)
    from netledger import schemas
    columns = ", ".join(f"{c} string" for c in ["id", *schemas.NORMAL_VIEW])
    rows = frame(spark, [("1", *[c for c in schemas.NORMAL_VIEW])], columns)
    store.put_rows(rows, 0)
    for want in (0, 1):
        tables.create_lasting_views(spark, normal=store)
        view = spark.newSession().table("normal_specifics")
        assert view.columns[0] == "merNo_terNo_time" and "exchanges" in view.columns and view.count() == want
        store.compact()
    spark.sql("DROP VIEW normal_specifics")


def test_levels_of_totals(spark, tmp_path):
    path, schema = str(tmp_path / "t"), T.StructType.fromDDL("mer_no string, total decimal(24,2)")
    batches = [b for b in range(40) if b != 21]
    for b in batches:
        levels.write(frame(spark, [("M", dec("1.50"))], "mer_no string, total decimal(24,2)"), path, b)
        levels.roll(spark, path, b, [x for x in batches if x <= b], schema)
    assert levels.parts(spark, path, batches) == [(1, 1), (1, 0), *[(0, b) for b in range(32, 40)]]
    assert levels.read(spark, path, batches, schema).first().total == dec("58.50")
    assert levels.read(spark, path, batches[:20], schema).count() == 1 and levels.read(spark, path, [], schema).count() == 0
