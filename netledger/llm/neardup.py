"""MinHash near-duplicates: one-permutation hashing, banded buckets, star-shaped candidate edges.

1. Each text becomes its set of word shingles; equal sets share a node, so exact copies are one node however
   many there are.
2. One hash per shingle fills ``bins`` minima; empty bins borrow from full ones along probe sequences that do not depend on
   the text (optimal densification). ``rows`` consecutive minima make a bucket; ``rows`` is the largest number
   by which a pair at the threshold shares no bucket with a probability of at most ``miss``.
3. Each node of a bucket is joined to the bucket's smallest node only: a star, as many edges as members.
   Connected stars are a heap. Any two texts that share a bucket are in one heap.
4. Within a heap all links are found on the full sets: nodes are dealt to parts of bounded size, and each pair of parts is
   one group whose intersections are counted exactly. A group returns a spanning star per linked class, never its pairs.
5. Components of these links are the classes.

A heap of one part (up to ``part_nodes`` nodes) is compared within one bounded task; a larger heap costs one group
per pair of its parts, so its cost grows with the square of its number of parts. No partner is dropped.

Defined results: null or wordless texts have an empty set and link with nothing; texts of fewer words than a
shingle are one shingle; repeated rows (of one doc_id and one text) share a node, keep their rows and are kept together; a null
doc_id takes its class's smallest id (null if there is none). One text of each class is kept: that of the smallest doc_id, ties and
classes without an id by the hash of the row.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netledger.llm.common import (arrow_columns, aside, besides, components, gram_hashes, hashed, in_arrow, mixed, placed,
                                  text_bytes, written)

SIGNED = T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("node", T.BinaryType()),
                       T.StructField("buckets", T.ArrayType(T.LongType()))])


def shingles(data: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    hashes = hashed((data or b"").lower().split())
    if 0 < len(hashes) < size:
        return gram_hashes(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(gram_hashes(hashes, size))


def node_of(shingle_set: np.ndarray) -> bytes:
    return blake2b(shingle_set.tobytes(), digest_size=16).digest()


class Sketch:
    """Minima by one permutation, densified, and their buckets."""

    def __init__(self, bins: int, rows: int) -> None:
        self.bins, self.rows, self.bands = bins, rows, bins // rows
        self.shift = np.uint64(64 - (bins - 1).bit_length())
        self.probes = np.zeros((bins, 0), np.int64)

    def _probe(self, count: int) -> None:
        while self.probes.shape[1] < count:
            step = np.arange(self.probes.shape[1], self.probes.shape[1] + 64, dtype=np.uint64)
            keys = (np.arange(self.bins, dtype=np.uint64)[:, None] << np.uint64(32)) + step[None, :] + np.uint64(1)
            more = (mixed(keys) % np.uint64(self.bins)).astype(np.int64)
            self.probes = np.concatenate([self.probes, more], axis=1)

    def minima(self, shingle_set: np.ndarray) -> np.ndarray:
        values = np.sort(mixed(shingle_set ^ np.uint64(0x5851F42D4C957F2D)))
        bins, first = np.unique((values >> self.shift).astype(np.int64), return_index=True)
        out = np.zeros(self.bins, np.uint64)
        out[bins] = values[first]
        full = np.zeros(self.bins, bool)
        full[bins] = True
        left, place = np.flatnonzero(~full), 0
        while len(left):
            self._probe(place + 64)
            hit = full[self.probes[left, place:place + 64]]
            done = hit.any(axis=1)
            donor = self.probes[left[done], place + hit[done].argmax(axis=1)]
            out[left[done]] = out[donor]
            left, place = left[~done], place + 64
        return out

    def buckets(self, shingle_set: np.ndarray) -> np.ndarray:
        rows = self.minima(shingle_set)[:self.bands * self.rows].reshape(self.bands, self.rows)
        key = np.arange(self.bands, dtype=np.uint64)
        for k in range(self.rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
        return key.view(np.int64)


def rows_for(threshold: float, bins: int, miss: float) -> int:
    """The largest number of rows that keeps the chance of sharing no bucket at the threshold within ``miss``."""
    return max(r for r in range(1, bins + 1) if (1 - threshold ** r) ** (bins // r) <= miss or r == 1)


def links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the smallest place in its class; classes link where 100 * intersection >= percent * union.

    Shingles of many sets are counted by matrix products in slices, those of few by listing their pairs. Besides the
    counts (4 bytes a pair) and the links (one), everything is computed for a slice of columns or rows at once.
    """
    count = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    every, owner = np.concatenate(sets), np.repeat(np.arange(count, dtype=np.int32), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    del order
    starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    spread = np.diff(np.concatenate([starts, [len(every)]]))
    del every
    shared = np.zeros((count, count), np.float32)
    few = 24
    rare = np.repeat((spread <= few) & (spread > 1), spread)
    rare_owner, rare_name = owner[rare], np.repeat(np.arange(len(starts), dtype=np.int32), spread)[rare]
    del rare
    for step in range(1, few):
        if step >= len(rare_name):
            break
        same = rare_name[step:] == rare_name[:-step]
        if not same.any():
            break
        pair = rare_owner[:-step][same].astype(np.int64) * count + rare_owner[step:][same]
        np.add.at(shared.reshape(-1), pair, np.float32(1))
    del rare_owner, rare_name
    shared += shared.T
    often = np.flatnonzero(spread > few)
    for at in range(0, len(often), 1024):
        part = often[at:at + 1024]
        matrix = np.zeros((count, len(part)), np.float32)
        for column, k in enumerate(part):
            matrix[owner[starts[k]:starts[k] + spread[k]], column] = 1
        shared += matrix @ matrix.T
    linked = np.empty((count, count), bool)
    for at in range(0, count, 128):
        both = np.rint(shared[at:at + 128]).astype(np.int64)
        linked[at:at + 128] = 100 * both >= percent * (sizes[at:at + 128, None] + sizes[None, :] - both)
    del shared
    label = np.full(count, -1, np.int64)
    for place in range(count):
        if label[place] < 0:
            front = np.array([place])
            label[place] = place
            while len(front):
                reached = linked[front].any(axis=0) & (label < 0)
                label[reached] = place
                front = np.flatnonzero(reached)
    return label


def near_duplicates(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 5, percent: int = 80,
                    bins: int = 256, miss: float = 1e-4, part_nodes: int = 1024, part_shingles: int = 1_000_000,
                    keep: list[str] | None = None) -> DataFrame:
    """Documents with n_shingles, component_id (smallest doc_id that links reach) and kept."""
    rows = rows_for(percent / 100, bins, miss)
    # A row is named by its id and text, so rows without an id, or of one id, are told apart.
    row = F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id).cast("string"), F.col(text)).alias("_row")
    texts = documents.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), row)

    def sign(batch: pa.RecordBatch) -> list[pa.Array]:
        sketch = Sketch(bins, rows)
        counts, nodes, buckets = [], [], []
        for data, own in zip(text_bytes(batch, "_text"), batch.column("_row").to_pylist(), strict=True):
            found = shingles(data, size)
            counts.append(len(found))
            nodes.append(node_of(found) if len(found) else b"empty" + str(own).encode())
            buckets.append(sketch.buckets(found) if len(found) else [])
        return [pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))]

    signed = written(arrow_columns(texts, sign, SIGNED, ["_id", "_row"]), "signed")
    least = F.min(F.struct(F.col("_id").isNull().alias("unnamed"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    nodes = written(signed.groupBy("node").agg(least.alias("first"), F.first("n_shingles").alias("n_shingles"),
                                               F.first("buckets").alias("buckets")), "nodes")
    members = nodes.select("node", F.explode("buckets").alias("bucket"))
    # Aggregates are written before they are joined back, so that Spark can split the join at a hot key.
    stars = written(members.groupBy("bucket").agg(F.min("node").alias("center"), F.max("node").alias("other"))
                    .filter("center <> other").select("bucket", "center"), "stars")
    heaps = components(members.join(stars, "bucket").select(F.col("node").alias("a"), F.col("center").alias("b")))
    heaps = written(heaps.join(nodes.select("node", F.col("first.row").alias("row"), "n_shingles"), "node"), "heaps")
    edges = _exact(texts.select("_row", "_text"), heaps, size, percent, part_nodes, part_shingles)
    classes = components(edges)
    named = nodes.join(classes, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    best = written(named.groupBy("root").agg(F.min("first").alias("best")), "least")
    of_node = named.join(best, "root").select("node", "best")
    made = ["n_shingles", "component_id", "kept"]
    found = signed.join(of_node, "node").select("_id", "_row", "n_shingles", F.col("best.id").alias("component_id"),
                                                (F.col("_row") == F.col("best.row")).alias("kept"))
    keep = [doc_id] if keep is None else keep
    if keep == [doc_id]:
        return found.drop("_row").withColumnRenamed("_id", doc_id)
    own = found.groupBy("_row").agg(*[F.min(c).alias(c) for c in made])
    passed = besides(made, keep)
    return documents.select(*aside(passed), row).join(own, "_row").select(*placed(passed), *made).toDF(*passed, *made)


def _exact(texts: DataFrame, heaps: DataFrame, size: int, percent: int, part_nodes: int, part_shingles: int) -> DataFrame:
    """(a, b) links that span the classes of each heap."""
    parts = written(heaps.groupBy("root").agg(F.greatest(
        F.ceil(F.count("*") / part_nodes), F.ceil(F.sum("n_shingles") / part_shingles)).cast("int").alias("parts")), "parts")
    asked = heaps.join(parts, "root").select(
        "root", "node", "row", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    wanted = texts.join(asked, F.col("_row") == F.col("row"))

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # repeated rows follow one another; one of them is enough
        for batch in batches:
            sets, same = [], []
            for data, node in zip(text_bytes(batch, "_text"), batch.column("node").to_pylist(), strict=True):
                sets.append(shingles(data, size) if node != last else np.zeros(0, np.uint64))
                same.append(node != last and node_of(sets[-1]) == node)
                last = node if same[-1] else last
            made = pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("root", "node", "parts", "part")]
                + [pa.array([s.tobytes() for s in sets], pa.binary())], ["root", "node", "parts", "part", "shingles"])
            yield made.filter(pa.array(same, pa.bool_()))

    sets = in_arrow(wanted, full, "root binary, node binary, parts int, part int, shingles binary")
    partner = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: p != F.col("part")))
    pairs = (sets.withColumn("_with", F.explode(partner))
             .select("root", F.least("part", "_with").alias("i"), F.greatest("part", "_with").alias("j"), "node", "shingles"))

    def group(found: pa.Table) -> pa.Table:
        names = found.column("node").to_pylist()
        own = {n: np.frombuffer(s.as_buffer(), np.uint64) for n, s in zip(names, found.column("shingles"), strict=True)}
        names = sorted(own)
        label = links([own[n] for n in names], percent)
        return pa.table({"a": pa.array(names, pa.binary()), "b": pa.array([names[k] for k in label], pa.binary())})

    return pairs.groupBy("root", "i", "j").applyInArrow(group, "a binary, b binary").filter("a <> b")
