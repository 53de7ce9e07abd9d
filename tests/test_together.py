"""Large sides of the merchant share one exchange: equal results for commas, blank and missing merchants, heavy ones; batches without a cache."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from netledger.operators.joins import JoinPolicy
from netledger.plans.settlement import INCRE, NORMAL, Lookups, settle, settle_with
from netledger.plans.sides import open_sides, write_sides
from netledger.session import LARGE_WRITES, large_writes
from netledger.sinks.store import KeyedStore
from netledger.sources.messages import file_messages
from netledger.streaming.jobs import SettlementStream
from tests.helpers import dimensions, frame, incre_rows, normal_rows

#: Codes fit, nothing else does; then with merchants of over 40 rows divided; then such that a division would copy too many rows.
POLICIES = [JoinPolicy(broadcast_bytes=1_000, rows_per_part=100_000), JoinPolicy(broadcast_bytes=1_000, rows_per_part=40),
            JoinPolicy(broadcast_bytes=1_000, rows_per_part=4)]
NAMES = ["M1", "M2", "a,b", "a", "", "none"]


def tables(spark):
    listed = [m for m in NAMES if m != "none"]
    return dimensions(
        spark, groups_=[(m, g) for m in listed for g in ("APL", f"G{m}")],
        mappings_=[("1", "1", f"{m},{t}", f"R{m}{t}") for m in listed for t in ("T1", "b,T2", ",T3")] + [("1", "1", "bare", "never")]
        + [("2", "1082", f"{m},{n:04d}", f"Q{m}{n}") for m in listed for n in range(4)] + [("3", "1068", f"S{n}", f"X{n}") for n in range(4)],
        fees_=[(m, 1, "1", "11", "0", f"0.{k + 1}", "-1", "99") for k, m in enumerate(listed)])


def normal(spark):
    terminals, n = ["T1", "b,T2", ",T3", "T2", "", None], 400
    return normal_rows(spark, [{"id": str(k % 390), "arrival": k, "mid": None if k % 9 == 0 else "M1" if k % 2 else NAMES[k % 6],
                                "tid": terminals[k % 5 if k % 7 else 5], "rsv4": "x" * 20 + f"{k % 5:04d}"} for k in range(n)])


def incre(spark):
    return incre_rows(spark, [{"plt_ssn": str(k), "mchnt_id_pay": "M1" if k % 2 else NAMES[k % 6], "term_id_pay": ["T1", "b,T2", ",T3"][k % 3],
                               "rsvd1": "SML0000S" + str(k % 5)} for k in range(300)])


def rows(df):
    kept = [c for c in df.columns if c not in ("arrival",)]
    return sorted(map(str, df.select(*sorted(kept)).collect()))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("job, policy, budget", [(NORMAL, POLICIES[0], 0), (NORMAL, POLICIES[1], 100_000), (NORMAL, POLICIES[2], 0),
                                                 (INCRE, POLICIES[1], 100_000)])
def test_sides_of_the_merchant_settle_alike(spark, tmp_path, job, policy, budget):
    """``budget`` is what stored sides may broadcast for heavy merchants."""
    flow, dims = normal(spark) if job is NORMAL else incre(spark), tables(spark)
    expected = rows(settle(flow, dims, job))
    # Without the settings of large writes there are more exchanges, and the same rows.
    assert rows(settle(flow, dims, job, policy, together=True)) == expected
    target = str(tmp_path / "dims")
    write_sides(dims, target, buckets=4)
    with large_writes(spark):
        assert rows(settle(flow, dims, job, policy, together=True)) == expected
        stored = Lookups(open_sides(spark, None, target), job, policy, together=True)
        stored.budget = budget
        assert rows(settle_with(flow, stored)) == expected
    assert len(expected) > 200


def test_one_exchange_of_the_flow_for_all_sides_of_the_merchant(spark, tmp_path):
    target = str(tmp_path / "dims")
    write_sides(tables(spark), target, buckets=6)
    flow, policy = normal(spark), POLICIES[0]
    with large_writes(spark):
        plan = plan_of(settle(flow, tables(spark), NORMAL, policy, deduplicate=False, together=True))
        stored = plan_of(settle_with(flow, Lookups(open_sides(spark, None, target), NORMAL, policy, together=True), deduplicate=False))
    apart = plan_of(settle(flow, tables(spark), NORMAL, policy, deduplicate=False))
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(_home" in line]
    assert len(moved) == 5 and plan.count("SortMergeJoin") == 4  # the flow once, each of the four sides once
    assert len([line for line in apart.splitlines() if "Exchange hashpartitioning(_terminal_item" in line]) == 2
    # Codes are broadcast from their buckets, the other four are joined in theirs.
    assert stored.count("Exchange hashpartitioning") == 1 and stored.count("SelectedBucketsCount: 6 out of 6") == 5


def test_settings_are_put_back(spark):
    spark.conf.set("spark.sql.parquet.compression.codec", "gzip")
    before = {k: spark.conf.get(k, None) for k in LARGE_WRITES}
    with pytest.raises(ValueError), large_writes(spark):
        assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"
        raise ValueError
    assert {k: spark.conf.get(k, None) for k in LARGE_WRITES} == before
    spark.conf.unset("spark.sql.parquet.compression.codec")


def test_a_batch_is_not_cached_and_leaves_nothing(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    lines = [json.dumps({"ID": str(k % 7), "MSG_TYPE": "0200", "PROC_CODE": "00", "SER_CONCODE": "00", "TXN_AMT": str(k), "TID": "T1", "MID": "M1",
                         "RSV4": ""}) for k in range(20)]
    (source / "1.json").write_text("\n".join(lines + ["{broken"]) + "\n", encoding="utf-8")
    stream = SettlementStream(NORMAL, lambda s: tables(s), str(tmp_path / "run"), policy=POLICIES[0])
    settle_, held = stream._settle, []
    monkeypatch.setattr(stream, "_settle", lambda parsed, i: (settle_(parsed, i), held.append(
        (parsed.storageLevel.useMemory, sorted(f.rsplit("/", 2)[0].rsplit("/", 1)[1] for f in parsed.inputFiles())[:1]))))
    stream.process(file_messages(spark, str(source)), 0)
    assert held == [(False, ["parsed"])] and not (tmp_path / "run" / "parsed" / "batch_id=0").exists()
    assert spark.read.parquet(stream.quarantine_path).count() == 1
    assert {r.id: int(r.txnAmt) for r in stream.detail(spark).collect()} == {str(k): k + 14 if k < 6 else k + 7 for k in range(7)}
    # The last row of a key is chosen before the store, which keeps no arrival.
    assert "_arrival" not in stream.store(spark).version().columns
    stream.close()


def test_a_batch_of_unique_keys_is_compacted_without_an_exchange(spark, tmp_path, monkeypatch):
    data = frame(spark, [(None if k == 50 else str(k), k % 4) for k in range(60)], "k string, v int")
    plans, files_ = [], KeyedStore._files
    monkeypatch.setattr(KeyedStore, "_files", lambda self, r, *more: (plans.append(plan_of(r)), files_(self, r, *more))[1])
    store = KeyedStore(spark, str(tmp_path / "once"), "k", buckets=3)
    store.put_rows(data, 0, once=True)
    store.compact()
    assert "Exchange" in plans[0] and "Exchange" not in plans[1]
    expected = {str(k): k % 4 for k in range(60) if k != 50}
    assert {r.k: r.v for r in store.view().collect()} == expected
    assert store.read_cell("17", "v").first().value == "1" and store.cell_exists("17", "v").first().found
    # Batches over a base, several batches and batches whose keys repeat are merged.
    store.put_rows(data.filter("k < '3'").withColumn("v", F.lit(9)), 1, once=True)
    store.compact()
    assert "Exchange" in plans[3] and {r.k: r.v for r in store.view().collect()} == {k: 9 if k < "3" else v for k, v in expected.items()}
    other = KeyedStore(spark, str(tmp_path / "twice"), "k", buckets=3)
    other.put_rows(data.unionByName(data), 0)
    other.compact()
    assert "Exchange" in plans[5] and other.view().count() == 59
