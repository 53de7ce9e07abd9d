"""What a task holds does not grow with the table: cuts before an exchange, files, tasks of a batch, parts of a bucket."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from contract import files, queries
from netledger.operators.dedup import latest, top_one
from netledger.plans.settlement import INCRE, NORMAL
from netledger.sinks.store import KeyedStore
from netledger.sources.lines import read_lines, write_lines
from netledger.session import gbk_session
from netledger.streaming.jobs import SettlementStream
from tests.helpers import dimensions, frame


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_sorted_before_the_exchange_for_heavy_keys_only(spark):
    rows = [(None if k % 11 == 0 else "heavy" if k % 3 == 0 else f"k{k % 40}", k % 7, f"v{k % 5}") for k in range(400)]
    df = frame(spark, rows, "id string, arrival int, v string")
    expected = sorted(map(str, top_one(df, ["id"], [F.col("arrival").desc(), F.xxhash64("v").asc()]).collect()))
    plain, cut = latest(df, ["id"]), latest(df, ["id"], heap_rows=50)
    assert "WindowGroupLimit" not in plan_of(plain)
    assert "WindowGroupLimit" in plan_of(cut)
    assert sorted(map(str, plain.collect())) == expected == sorted(map(str, cut.collect()))
    assert latest(df.filter("false"), ["id"]).count() == 0


def test_compressed_lines_keep_their_order(spark, tmp_path):
    session = gbk_session(spark)
    lines = session.range(0, 50, 1, 1).select(F.concat(F.lit("商户 "), F.lpad(F.col("id").cast("string"), 4, "0"), F.lit("  ")))
    write_lines(lines, str(tmp_path / "lines"), file_rows=7)
    written = sorted(p.name for p in (tmp_path / "lines").glob("part-*"))
    assert len(written) == 8 and all(n.endswith(".gz") for n in written)
    found = [r.line for r in read_lines(spark, str(tmp_path / "lines")).orderBy("position").collect()]
    assert found == [f"商户 {k:04d}  " for k in range(50)]


def orders(spark, folder, rows):
    names = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string")
    frame(spark, [(k, k % 5, "F", 10.0, "1995-01-01", "1-URGENT") for k in range(rows)], names).write.parquet(f"{folder}/orders.parquet")
    frame(spark, [(k,) for k in range(1, 4)], "s_suppkey bigint").write.parquet(f"{folder}/supplier.parquet")


def test_flow_files_are_compressed(spark, tmp_path):
    orders(spark, str(tmp_path), 30)
    path = files.incre_file(spark, str(tmp_path))
    assert all(f.endswith(".gz") for f in spark.read.text(path).inputFiles())
    assert read_lines(spark, path).count() == 30


def test_message_files_grow_in_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 10)
    orders(spark, str(tmp_path), 200)
    path, per_batch = queries._message_files(spark, str(tmp_path), INCRE)
    # Twenty parts are asked for; some may stay without rows and so without a file.
    found = spark.read.text(path).inputFiles()
    assert 12 <= len(found) <= 20 and per_batch == -(-len(found) // 3)
    text = spark.read.text(path).select(F.get_json_object("value", "$.PLT_SSN").alias("k"), F.input_file_name().alias("f"))
    assert text.count() == 200


def test_a_batch_is_not_gathered_in_fewer_tasks(spark, tmp_path):
    stream = SettlementStream(NORMAL, lambda s: dimensions(s), str(tmp_path / "run"), fan_out=3)
    raw = spark.range(0, 40, 1, 10).select(F.lit(json.dumps({"ID": "a"})).alias("value"), F.lit(1).alias("origin"))
    assert stream._parse(raw).rdd.getNumPartitions() == 10
    assert stream._parse(raw.coalesce(1)).rdd.getNumPartitions() == 3
    assert stream._parse(raw).filter("value IS NOT NULL").count() == 0
    broken = raw.withColumn("value", F.lit("{x"))
    assert stream._parse(broken).filter("value = '{x' AND problem IS NOT NULL").count() == 40


def test_a_bucket_is_written_by_several_tasks(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "store"), "k", buckets=2)
    rows = spark.range(4000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).cast("string").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.put_rows(rows.unionByName(rows), 0)
        store.compact()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for part in (tmp_path / "store" / "batches" / "batch_id=0", *(tmp_path / "store" / "bases").iterdir()):
        for bucket in (0, 1):
            assert len(list((part / f"_bucket={bucket}").glob("*.parquet"))) > 1
    assert store.view().count() == 4000
    assert store.read_cell("17", "v").first().value == "2"
    assert store.cell_exists("17", "v").first().found
    store.put_rows(rows.filter("k = '17'").withColumn("v", F.lit("new")), 1)
    store.compact()
    assert store.read_cell("17", "v").first().value == "new" and store.view().count() == 4000
