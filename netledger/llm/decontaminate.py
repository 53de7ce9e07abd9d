"""Benchmark decontamination by Wu-Manber search over words.

Each window of a benchmark item (``window`` consecutive words; a shorter item is one window) is a
pattern. Patterns of one length share a shift table over blocks of words: the block that ends at the
inspected word says how far no pattern can end, so most words of a document are never inspected.
Where the shift is zero, the bucket of that last block selects patterns, and a direct comparison of
all words confirms an occurrence. Every document is read whole; overlapping occurrences all count.

Items are searched in blocks of at most about ``block_bytes`` of text; a block is what a task holds
and what is sent to it. Up to ``together`` blocks follow one another over the same rows in one stage, each in its own
Python worker; then the rows with their hits are written to the shared folder, the blocks are given up and the table before is
deleted. So neither tasks nor the driver hold more than ``together`` blocks, however large the benchmark is. No exchange is needed.

Defined results: null or empty text has no words and no hit; items without id, text or words have no
window; repeated item ids count once; repeated rows each keep their row; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netledger.llm.common import arrow_columns, keeps, text_bytes
from netledger.session import work_path
from netledger.sinks.tables import drop

# A-Z in lower case; every other ASCII character but a-z and 0-9 ends a word.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
              else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("hit_spans", T.BinaryType())])


def words_of(data: bytes | None) -> list[bytes]:
    return data.translate(_FOLD).split() if data else []


class _Patterns:
    """Shift table and buckets of the patterns of one length."""

    def __init__(self, length: int, block: int) -> None:
        self.length, self.block = length, min(block, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], list[tuple[int, int]]] = {}

    def add(self, words: list[bytes], start: int, item: int) -> None:
        for end in range(self.block, self.length + 1):
            key = tuple(words[start + end - self.block:start + end])
            rest = self.length - end
            if rest < self.shift.get(key, self.far):
                self.shift[key] = rest
        self.bucket.setdefault(key, []).append((item, start))

    def search(self, words: list[bytes], items: list[list[bytes]], found: set[int], starts: list[int]) -> None:
        length, block, far, shift = self.length, self.block, self.far, self.shift.get
        end, last = length, len(words)
        while end <= last:
            key = tuple(words[end - block:end])
            step = shift(key, far)
            if step:
                end += step
                continue
            here = words[end - length:end]
            for item, start in self.bucket[key]:
                if items[item][start:start + length] == here:
                    found.add(item)
                    if not starts or starts[-1] != end - length:
                        starts.append(end - length)
            end += 1


class Search:
    """The tables of one block of items; built in the task from the items' words."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, block: int) -> None:
        self.ids = [i for i, _ in items]
        self.items = [words_of(t) for _, t in items]
        self.by_length: dict[int, _Patterns] = {}
        for number, words in enumerate(self.items):
            length = min(window, len(words))
            if length:
                patterns = self.by_length.setdefault(length, _Patterns(length, block))
                for start in range(len(words) - length + 1):
                    patterns.add(words, start, number)

    def __call__(self, words: list[bytes]) -> tuple[set[str], list[tuple[int, int]]]:
        found: set[int] = set()
        spans: list[tuple[int, int]] = []
        for length, patterns in self.by_length.items():
            starts: list[int] = []
            patterns.search(words, self.items, found, starts)
            spans += [(s, s + length) for s in starts]
        return {self.ids[i] for i in found}, spans


_BUILT: dict[str, Search] = {}


def _search(items: list[tuple[str, bytes]], window: int, block: int) -> Search:
    """One worker process keeps the tables of the block it works on."""
    key = hashlib.sha256(repr((items, window, block)).encode()).hexdigest()
    keeps(_BUILT.clear)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Search(items, window, block)
    return _BUILT[key]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 13, block: int = 3, block_bytes: int = 2_000_000,
                  keep: list[str] | None = None, together: int = 4) -> DataFrame:
    """Documents with n_words, n_hit, item_ids (sorted strings) and hit_spans (int32 word positions,
    start and end of each merged span)."""
    spark = documents.sparkSession
    items = (benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t"))
             .filter("i IS NOT NULL AND t IS NOT NULL"))
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    keep = list(documents.columns) if keep is None else keep
    out, held, before = documents, [], None
    for number in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == number).collect()
        sent = spark.sparkContext.broadcast(sorted((r["i"], r["t"].encode()) for r in rows))
        out = _pass(out, sent, text, window, block, number == 0,
                    keep if number == blocks - 1 else [*keep, *({text} - {*keep})])
        held.append(sent)
        if len(held) == together and number < blocks - 1:
            path = work_path(spark, "hits")
            out.write.parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
            while held:
                held.pop().destroy()
            if before:
                drop(spark, before)
            before = path
    return out


def _pass(frame: DataFrame, sent, text: str, window: int, block: int, first: bool, keep: list[str]) -> DataFrame:
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        search = _search(sent.value, window, block)
        rows = batch.num_rows
        old_items = [[]] * rows if first else batch.column("item_ids").to_pylist()
        old_spans = [b""] * rows if first else batch.column("hit_spans").to_pylist()
        n_words, n_hit, ids, spans = [], [], [], []
        for data, before, packed in zip(text_bytes(batch, text), old_items, old_spans, strict=True):
            words = words_of(data)
            found, hits = search(words)
            hits = _merged(hits + [tuple(x) for x in np.frombuffer(packed, np.int32).reshape(-1, 2).tolist()])
            n_words.append(len(words))
            n_hit.append(sum(e - s for s, e in hits))
            ids.append(sorted(found | set(before)))
            spans.append(np.array(hits, np.int32).tobytes())
        return [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(ids, pa.list_(pa.string())), pa.array(spans, pa.binary())]

    return arrow_columns(frame, compute, HITS, keep)


def contaminated() -> Column:
    """The share of hit words that makes a document contaminated: a twentieth."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
