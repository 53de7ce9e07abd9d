"""Streams: batches, restart, repetition, refresh, quarantine, state store."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from netledger import schemas
from netledger.operators.joins import JoinPolicy
from netledger.plans.load import open_dimensions, version_of
from netledger.plans.settlement import INCRE, NORMAL
from netledger.sinks import publish
from netledger.sources.messages import file_messages, file_stream, union
from netledger.streaming.jobs import LatestStream, SettlementStream, progress, running_totals, running_totals_of
from tests.helpers import dec, dimensions, frame


def message(**fields):
    base = dict(ID="1", MSG_TYPE="0200", PROC_CODE="00", SER_CONCODE="00", TXN_AMT="100.00", TID="T1", MID="M1",
                TRAN_STATUS="1", RESP_CODE="00", RSV4="")
    return json.dumps({**base, **fields})


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    part = folder / f".{name}"
    part.write_text("\n".join(lines) + "\n", encoding="utf-8")
    part.rename(folder / name)


def run(spark, stream, folder, per_trigger=1, close=True):
    stream.start(file_stream(spark, str(folder), per_trigger), once=True).awaitTermination()
    if close:
        stream.close()


def totals(spark, stream):
    return {r.mer_no: r.total for r in stream.totals(spark).collect()}


def test_batches_restart_and_quarantine(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "1.json", message(ID="a"), message(ID="a", TXN_AMT="50.00"), "{broken")
    put(source, "2.json", message(ID="b", TXN_AMT="20.00"), message(ID=""), message(ID="c", TXN_AMT="1,5"))
    stream = SettlementStream(NORMAL, lambda s: dimensions(s), str(tmp_path / "run"))
    run(spark, stream, source)
    # Within a batch the last line of a key wins: 50 - 0.50, then 20 - 0.20.
    assert totals(spark, stream) == {"M1": dec("69.30")}
    bad = spark.read.parquet(stream.quarantine_path)
    assert {r.problem for r in bad.collect()} == {"not a JSON object", "id is missing", "txn_amt is not a number"}

    put(source, "3.json", message(ID="d", TXN_AMT="10.00"))
    run(spark, stream, source)
    assert totals(spark, stream) == {"M1": dec("79.20")}
    assert {r.id for r in stream.detail(spark).collect()} == {"a", "b", "d"}
    assert stream.committed(spark) == [0, 1, 2]


def test_a_repeated_batch_counts_once_and_a_new_version_replaces(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "1.json", message(ID="a"), message(ID="b"))
    stream = SettlementStream(NORMAL, lambda s: dimensions(s), str(tmp_path / "run"), fan_out=3)
    batch = file_messages(spark, str(source))
    stream.process(batch, 0)
    stream.process(batch, 0)
    assert totals(spark, stream) == {"M1": dec("198.00")}
    put(source, "1.json", message(ID="a", TXN_AMT="7.00"))
    stream.process(file_messages(spark, str(source)), 1)
    assert {r.id: r.txnAmt for r in stream.detail(spark).collect()} == {"a": dec("7.00"), "b": dec("100.00")}

    stream.close()
    store = stream.store(spark)
    store.compact()
    store.vacuum()
    assert {r.id: r.txnAmt for r in stream.detail(spark).collect()} == {"a": dec("7.00"), "b": dec("100.00")}
    assert totals(spark, stream) == {"M1": dec("204.93")}


def test_batches_stay_under_the_cap_and_go_on_after_a_stop(spark, tmp_path):
    source = tmp_path / "in"
    for k in range(5):
        put(source, f"{k}.json", *[message(ID=f"{k}-{i}") for i in range(k + 1)])
    stream = SettlementStream(NORMAL, lambda s: dimensions(s), str(tmp_path / "run"))
    running = stream.start(file_stream(spark, str(source), 2))
    while running.isActive and not stream.committed(spark):
        time.sleep(0.1)
    running.stop()
    before = stream.committed(spark)
    again = stream.start(file_stream(spark, str(source), 2), once=True)
    again.awaitTermination()
    stream.close()
    assert 1 <= len(before) < 3 and stream.committed(spark) == [0, 1, 2]
    measured = progress(again)
    assert {p["batch_id"] for p in measured} >= {2} and all(0 < p["rows"] <= 9 and p["ms"] > 0 for p in measured)
    assert totals(spark, stream) == {"M1": dec("1485.00")}


def test_a_run_without_batches_is_empty(spark, tmp_path):
    stream = SettlementStream(NORMAL, lambda s: dimensions(s), str(tmp_path / "run"))
    assert stream.detail(spark).count() == stream.totals(spark).count() == 0
    assert "merNo" in stream.detail(spark).columns


def test_dimensions_are_opened_per_batch(spark, tmp_path):
    source, rates = tmp_path / "in", iter(["1", "2"])
    put(source, "1.json", message(ID="a"))
    stream = SettlementStream(NORMAL, lambda s: dimensions(s, fees_=[
        ("M1", 1, "1", "11", "0", next(rates), "-1", "99")]), str(tmp_path / "run"))
    run(spark, stream, source)
    put(source, "2.json", message(ID="b"))
    run(spark, stream, source)
    assert totals(spark, stream) == {"M1": dec("197.00")}


@pytest.mark.parametrize("told", [False, True])
def test_reloaded_dimension_files_take_effect(spark, tmp_path, told):
    source, target = tmp_path / "in", str(tmp_path / "dims")

    def load(fee):
        dims = dimensions(spark, fees_=[("M1", 1, "1", "11", "0", fee, "-1", "99")])
        for name, columns in schemas.DIMENSION_COLUMNS.items():
            table = getattr(dims, name)
            filled = table.select(*[(F.col(c) if c in table.columns else F.lit(None)).cast(kind).alias(c)
                                    for c, kind in columns.items()])
            filled.write.parquet(f"{target}/{name}/load{fee}")
            assert publish.claim(spark, f"{target}/published/{name}", int(fee), f"load{fee}")

    load("1")
    before = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    stream = SettlementStream(NORMAL, lambda s: open_dimensions(s, target), str(tmp_path / "run"),
                              version=(lambda s: version_of(s, target)) if told else None)
    put(source, "1.json", message(ID="a"))
    run(spark, stream, source, close=False)
    first = stream._tables
    put(source, "2.json", message(ID="b"))
    run(spark, stream, source, close=False)
    assert stream._tables is first
    load("2")
    put(source, "3.json", message(ID="c"))
    run(spark, stream, source, close=False)
    assert stream._tables is not first
    stream.close()
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) <= before
    assert totals(spark, stream) == {"M1": dec("296.00")}


def test_new_run_starts_from_the_earliest_message(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "1.json", message(ID="a"))
    for name in ("one", "two"):
        stream = SettlementStream(NORMAL, lambda s: dimensions(s), str(tmp_path / name))
        run(spark, stream, source)
        assert totals(spark, stream) == {"M1": dec("99.00")}


def test_incre_stream(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "1.json", json.dumps(dict(PLT_SSN="1", TRANS_ST="0", TRANS_ST_RSVL="0", PROD_STYLE="51A2",
        ROUT_INST_ID_CD="0", MCHNT_ID_PAY="M1", TERM_ID_PAY="T1", TRANS_CD_PAY="02S221X0", PAY_ST="0",
        TRANS_AMT="", RSVD6="", UNKNOWN="x")), json.dumps(dict(PLT_SSN="2", TRANS_ST="0", TRANS_ST_RSVL="0",
        PROD_STYLE="51A2", MCHNT_ID_PAY="M1", TERM_ID_PAY="T1", TRANS_CD_PAY="02S221X0", PAY_ST="0",
        TRANS_AMT="10000", RSVD1=None, RSVD6="null")))
    stream = SettlementStream(INCRE, lambda s: dimensions(s, codes_=[("02S221X0", "1", -1)], fees_=[
        ("M1", 1, "1", "10", "1", "0", "-1", "99")]), str(tmp_path / "run"))
    run(spark, stream, source)
    assert totals(spark, stream) == {"M1": dec("99.00")}
    assert {r.pltSsn: (r.transAmt, r.dRsvd6) for r in stream.detail(spark).collect()} == {
        "1": (dec("0.00"), 0), "2": (dec("10000.00"), 0)}


def test_running_totals_in_the_state_store(spark, tmp_path):
    source, other = tmp_path / "in", tmp_path / "other"
    put(source, "1.json", message(ID="a"))
    put(other, "2.json", message(ID="b"))
    both = union(file_stream(spark, str(source)), file_stream(spark, str(other)))
    totals_ = running_totals(both, dimensions(spark), NORMAL)
    seen = []

    def go():
        (totals_.writeStream.outputMode("complete").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "cp"))
         .foreachBatch(lambda df, i: seen.append(df.agg(F.sum("total")).first()[0]) and None)
         .start().awaitTermination())
        return seen[-1]

    assert go() == dec("198.00")
    put(source, "3.json", message(ID="c"))
    assert go() == dec("297.00")


def test_runs_until_stopped(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "1.json", message(ID="a"))
    stream = SettlementStream(NORMAL, lambda s: dimensions(s), str(tmp_path / "run"))
    running = stream.start(file_stream(spark, str(source)))
    running.processAllAvailable()
    assert running.isActive
    running.stop()
    stream.close()
    assert totals(spark, stream) == {"M1": dec("99.00")}


def test_running_totals_count_the_last_message_of_a_key(spark, tmp_path):
    """Repeated ids of a micro-batch reach the first stream and count once in the state store, with divided joins too."""
    source = tmp_path / "in"
    put(source, "1.json", message(ID="a", TXN_AMT="40.00"), message(ID="a", TXN_AMT="50.00"), "{broken", message(ID="b", TXN_AMT="20.00"))
    put(source, "2.json", message(ID="c", TXN_AMT="10.00"), message(ID="c", TXN_AMT="30.00", PROC_CODE="01"))
    first = LatestStream(NORMAL, str(tmp_path / "latest"))
    first.start(file_stream(spark, str(source), 1), once=True).awaitTermination()
    first.process(file_messages(spark, str(source)), 0)  # a whole batch stays
    assert spark.read.parquet(first.records_path).count() == 3
    totals_ = running_totals_of(first.records(spark, 1), dimensions(spark), NORMAL, JoinPolicy(broadcast_bytes=0, rows_per_part=1))
    seen = []
    (totals_.writeStream.outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp"))
     .foreachBatch(lambda df, i: seen.append({r.mer_no: r.total for r in df.collect()}) and None).start().awaitTermination())
    # 50 - 0.50 and 20 - 0.20; the last message of c is no trade.
    assert seen[-1] == {"M1": dec("69.30")}
