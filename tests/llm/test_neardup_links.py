"""Near duplicates around the threshold in heaps of texts that share a passage."""

from __future__ import annotations

import random

from netledger.llm import neardup


def classes_by_hand(texts, size, percent):
    sets = [neardup.shingles(t.encode(), size) for t in texts]
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            both = len(set(sets[a].tolist()) & set(sets[b].tolist()))
            if len(sets[a]) and len(sets[b]) and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(k) for k in range(len(texts))]


def test_links_of_mixed_heaps_equal_brute_force(spark):
    draw = random.Random(8)
    shared = [f"s{k}" for k in range(60)]
    texts = []
    for _ in range(150):
        own = draw.randint(4, 22)
        texts.append(" ".join(shared[:60 - own // 2] + [f"w{draw.randint(0, 40)}" for _ in range(own)]))
    rows = [(k, t) for k, t in enumerate(texts)]
    for percent, bins in ((80, 256),):
        want = classes_by_hand(texts, 2, percent)
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        found = neardup.near_duplicates(frame, size=2, percent=percent, bins=bins, part_nodes=7)
        assert {r["doc_id"]: r["component_id"] for r in found.collect()} == dict(enumerate(want))
    assert 5 < len(set(classes_by_hand(texts, 2, 80))) < 140
