"""What a task holds: batches, the tables of one operator, the comparison of one group."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from netledger.llm import bpe, common, neardup
from netledger.llm.queries import vocabulary


def test_batches_are_bounded_by_bytes(spark):
    setting = common._BATCH_SETTING
    held = dict(spark.conf.getAll).get(setting)
    spark.conf.unset(setting)
    try:
        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

        frame = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("x"), 6000).alias("text"))
        got = common.in_arrow(frame, sizes, "rows long, bytes long").collect()
        assert sum(r["rows"] for r in got) == 6000 and max(r["bytes"] for r in got) < common.BATCH_BYTES + 100_000
        spark.conf.set(setting, "20000000")  # a bound of the session's own stays
        got = common.in_arrow(frame, sizes, "rows long, bytes long").collect()
        assert common.BATCH_BYTES < max(r["bytes"] for r in got) < 20_100_000
    finally:
        spark.conf.unset(setting)
        if held:
            spark.conf.set(setting, held)


def test_a_worker_keeps_the_tables_of_one_operator():
    with open(vocabulary(), encoding="utf-8") as file:
        content = file.read()
    first = common.hashed([b"some", b"words"])
    ids = bpe._bpe(content).encode("some words")
    assert bpe._BUILT and not common.WORDS
    assert common.hashed([b"some", b"words"]).tolist() == first.tolist()
    assert not bpe._BUILT
    assert bpe._bpe(content).encode("some words").tolist() == ids.tolist()


def test_links_hold_few_bytes_a_pair():
    draw = np.random.default_rng(0)
    base = draw.integers(0, 1 << 62, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[draw.random(300) < draw.choice([.85, .98])], draw.integers(0, 4000, 20).astype(np.uint64)]))
            for _ in range(1200)]
    tracemalloc.start()
    label = neardup.links(sets, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(sets) ** 2  # 38 bytes a pair before
    some = [0, 1, 2, 3, 500, 1199]
    few = neardup.links([sets[k] for k in some], 80)
    for a, x in enumerate(some):
        for b, y in enumerate(some):
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                assert label[x] == label[y] and few[a] == few[b]
