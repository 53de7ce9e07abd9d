"""Sinks, views, point reads, cells and exports."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from netledger import schemas
from netledger.operators import cells, pointreads
from netledger.operators.totals import add_totals
from netledger.plans.export import export_summary
from netledger.plans.settlement import INCRE, NORMAL, detail, settle
from netledger.sinks import messages, tables
from netledger.sinks.store import KeyedStore
from tests.helpers import dec, dimensions, frame, incre_rows, normal_rows


def test_views_rename_and_leave_out_the_flags(spark):
    normal = detail(settle(normal_rows(spark, [{}]), dimensions(spark), NORMAL), schemas.NORMAL_DETAIL)
    incre = detail(settle(incre_rows(spark, [{}]), dimensions(spark), INCRE), schemas.INCRE_DETAIL)
    tables.create_views(spark, normal, incre)
    row = spark.sql("SELECT * FROM normal_specifics").first()
    assert (row.merNo_terNo_time, row.exchanges, row.filterFlag, row.txnAmt) == ("1", "0.0", "false", "100.00")
    assert len(row) == 18 and "noBmsStlInfo" not in row
    view = spark.table("incremental_specifics")
    assert len(view.columns) == 19
    assert {f.dataType.simpleString() for f in view.schema} == {"string"}


def test_create_if_absent(spark):
    for _ in range(2):
        tables.create_if_absent(spark, "detail_demo", "id STRING, v STRING")
    assert spark.table("detail_demo").columns == ["id", "v"]
    spark.sql("DROP TABLE detail_demo")


def test_bulk_upsert_and_delete(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "cells"), "key", buckets=2)
    store.put_cells(frame(spark, [("a", "1"), ("b", None)], "key string, v string"), 0)
    store.put_cells(cells.one_cell(spark, "key", "a", "v", "2"), 1)
    latest = store.view()
    assert {r.key: r.v for r in latest.collect()} == {"a": "2", "b": ""}
    left = cells.delete_keys(latest, frame(spark, [("a",), ("a",), ("z",)], "key string"), "key")
    assert [r.key for r in left.collect()] == ["b"]


def test_wide_rows(spark):
    rows = [("r1", "a", "1", 1), ("r1", "a", "2", 2), ("r1", "b", None, 3), ("r2", "c", "9", 1)]
    wide = cells.wide_rows(frame(spark, rows, "k string, c string, v string, t int"), "k", "c", "v", "t",
                           ["a", "b"])
    assert {r.k: (r.a, r.b) for r in wide.collect()} == {"r1": ("2", ""), "r2": (None, None)}
    found = cells.wide_rows(frame(spark, rows, "k string, c string, v string, t int"), "k", "c", "v", "t")
    assert {r.k: r.cells for r in found.collect()} == {"r1": {"a": "2", "b": ""}, "r2": {"c": "9"}}


def test_point_reads(spark):
    t = frame(spark, [("a", "x", 1), ("b", None, 2)], "k string, v string, type_id int")
    assert pointreads.read_cell(t, "k", "a", "v").first().value == "x"
    assert pointreads.read_cell(t, "k", "z", "v").first().value == ""
    assert [pointreads.cell_exists(t, "k", k, "v").first().found for k in "abz"] == [True, False, False]
    assert pointreads.get_rows(t, "k", "b").count() == 1
    assert pointreads.first_value(t, "v", pointreads.condition("type_id", "<", 2)).first().value == "x"
    assert pointreads.first_value_of_type(t, "k", 2, pointreads.condition("k", "like", "%")).first().value == "b"
    with pytest.raises(ValueError):
        pointreads.condition("k", "= 1 OR 1", "x")


def test_value_is_a_literal_not_sql(spark):
    t = frame(spark, [("a' OR '1'='1",), ("b",)], "k string")
    assert pointreads.get_rows(t, "k", "a' OR '1'='1").count() == 1


def test_number_predicate_on_text(spark):
    t = frame(spark, [("1",), ("x",), ("-1",), (None,)], "mapp_main string")
    assert [r.mapp_main for r in pointreads.where_number(t, "mapp_main", ">", 0).collect()] == ["1"]


def test_ranked_value_or_none(spark):
    t = frame(spark, [("m", 2), ("m", 1)], "k string, v int")
    assert pointreads.first_ranked(t, "v", [F.col("v").asc()], F.col("k") == "m").first().value == 1
    assert pointreads.first_ranked(t, "v", [F.col("v").asc()], F.col("k") == "z").isEmpty()


def test_export_replaces_and_is_plain(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = "mer_no string, total decimal(38,9)"
    export_summary(frame(spark, [("OLD", dec("1.000000000"))], schema), path)
    export_summary(frame(spark, [("M1", dec("123456789.500000000"))], schema), path)
    assert [r.value for r in spark.read.text(path).collect()] == ["M1, 123456789.5"]


def test_export_keeps_every_digit(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(str(i), dec(v)) for i, v in enumerate(("0.00000000012", "-0.00000000010", "0", "100", "123456789012345.00000000001"))]
    export_summary(frame(spark, rows, "mer_no string, total decimal(38,11)"), path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == [
        "0, 0.00000000012", "1, -0.0000000001", "2, 0", "3, 100", "4, 123456789012345.00000000001"]


def test_equal_keys_of_a_batch_have_one_winner(spark, tmp_path):
    path = str(tmp_path / "detail")
    rows = [("a", v, v % 7) for v in range(50)] + [("b", 1, 1)]
    for parts in (1, 7):
        tables.write_batch(frame(spark, rows, "key string, v int, arrival int").repartition(parts), path, 0)
        first = {r.key: r.v for r in tables.read_latest(spark, path, "key").collect()}
        tables.compact_latest(spark, path, "key", str(tmp_path / f"compact{parts}"))
        again = {r.key: r.v for r in tables.read_latest(spark, str(tmp_path / f"compact{parts}"), "key").collect()}
        assert first == again and first["a"] % 7 == 6
    assert tables.read_latest(spark, path, "key").columns == ["key", "v"]


def test_totals_merge_in_any_order(spark):
    schema = "mer_no string, total decimal(20,2)"
    a = frame(spark, [("x", dec("1.10")), ("y", dec("2.00"))], schema)
    b = frame(spark, [("x", dec("0.20"))], schema)
    merged = [{r.mer_no: r.total for r in m.collect()} for m in (add_totals(a, b), add_totals(b, a))]
    assert merged[0] == merged[1] == {"x": dec("1.30"), "y": dec("2.00")}


def test_message_key(spark):
    row = messages.keyed(frame(spark, [("{}",)], "value string"), "topic").first()
    assert row.key.startswith("topic_") and row.key.split("_")[1].isdigit()
