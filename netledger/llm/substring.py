"""Substring dedup by recompression: repeated windows of words are found and removed.

Recompression names runs of equal symbols and pairs of neighbours, round by round. A name is a hash of what it
stands for, so all tasks give equal stretches the same interior symbols without exchanging a dictionary; only
symbols near the ends of a stretch can differ. Each symbol carries the range of words that decided it.

1. Anchors. Of the symbols whose whole range lies in a window, the one with the smallest key (a hash of the words of its
   range) is the window's anchor; a window without such a symbol is its own anchor. Equal windows have equal anchors.
   Consecutive windows of one anchor form a stretch, about one per dozen words.
2. A Spark round counts the anchors of all documents. An anchor that stands once rules its windows out. If all
   stretches of an anchor are equal word for word (two independent 64-bit hashes), all their windows repeat. Where they
   differ, the windows of these stretches go to
3. a second round, which counts them one by one by 128-bit hashes.
4. Words covered by repeated windows are removed from the text.

Counts are combined before their exchange; what a document learns (its repeated anchors, then windows) is no
longer than the document. Between the rounds, a bounded Bloom filter keeps out rows that cannot match, so that
only documents with something repeated are exchanged; it only saves work.

Defined results: null and empty texts have no words; texts shorter than a window keep everything; texts are read
whole; repeated rows count as documents of their own, so they repeat each other; doc_id may be null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netledger.llm.common import arrow_columns, aside, besides, in_arrow, mixed, placed, sift, text_bytes, written

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Words that are worked on at once, besides one longer document.
CHUNK = 40_000
#: Bytes of a text whose words are hashed at once, and the longest word that is hashed by table.
BLOCK, LONG = 1 << 18, 64
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_AFTER = re.compile(rb"[\x20\x09-\x0D]")


def recompress(hashes: np.ndarray, fixed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last word that each symbol depends on, after so many rounds.

    A round names runs of one symbol, then pairs whose round-salted bits are (1, 0). Symbols take part up to the
    round's length limit; those of ``fixed`` words (the borders between texts) never do.
    """
    count = len(hashes)
    name, start, takes_no = hashes, np.arange(count), fixed
    low, high = start.copy(), start.copy()
    for number in range(rounds):
        limit = 1.35 ** number
        takes = ~takes_no & (np.diff(np.append(start, count)) <= limit)
        # Runs. A symbol that takes part depends on both neighbours, which end its run.
        joins = np.zeros(len(name), bool)
        joins[1:] = (name[1:] == name[:-1]) & takes[1:] & takes[:-1]
        head = np.flatnonzero(~joins)
        length = np.diff(np.append(head, len(name)))
        tail = head + length - 1
        took = takes[head]
        left, right = np.maximum(head - 1, 0), np.minimum(tail + 1, len(name) - 1)
        low, high = np.where(took, low[left], low[head]), np.where(took, high[right], high[tail])
        name = np.where(length > 1, mixed(name[head] + length.astype(np.uint64) * _B), name[head])
        start, takes_no = start[head], takes_no[head]
        # Pairs. A symbol of bit 1 depends on the next one, a symbol of bit 0 on the one before.
        bit = mixed(name + np.uint64(number + 1)) >> np.uint64(63) == 1
        first = np.flatnonzero(took[:-1] & took[1:] & bit[:-1] & ~bit[1:])
        after, before = np.append(high[1:], high[-1]), np.insert(low[:-1], 0, low[0])
        low, high = np.where(took & ~bit, np.minimum(low, before), low), np.where(took & bit, np.maximum(high, after), high)
        low[first], high[first] = np.minimum(low[first], low[first + 1]), np.maximum(high[first], high[first + 1])
        name[first] = mixed(name[first] * _A + name[first + 1])
        rest = np.ones(len(name), bool)
        rest[first + 1] = False
        name, start, low, high, takes_no = name[rest], start[rest], low[rest], high[rest], takes_no[rest]
    return low, high


#: A 64-bit number for each byte at each place of a word.
_TABLE = mixed(mixed(np.arange(LONG * 256, dtype=np.uint64) * _A + _B) + _C)


def word_hashes(data: bytes | None) -> np.ndarray:
    """The 64-bit hashes of a text's words in their order, by tabulation: sums of a number per byte and place in the word.

    A text is read block by block (a block ends with a word); the few words longer than the table are hashed one by one.
    """
    if not data:
        return np.zeros(0, np.uint64)
    out, at = [], 0
    while at < len(data):
        cut = _AFTER.search(data, at + BLOCK)
        end = cut.start() if cut else len(data)
        codes = np.frombuffer(data, np.uint8, end - at, at)
        solid = ~_SPACE[codes]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
        head, tail = edges[::2], edges[1::2]
        if len(head):
            size = tail - head
            first = np.cumsum(size) - size  # among the bytes of words
            place = np.minimum(np.arange(int(size.sum())) - np.repeat(first, size), LONG - 1)
            sums = np.add.reduceat(_TABLE[place * 256 + codes[solid]], first)
            found = mixed(sums + size.astype(np.uint64) * _C)
            for k in np.flatnonzero(size > LONG).tolist():
                found[k] = int.from_bytes(blake2b(data[at + head[k]:at + tail[k]], digest_size=8).digest(), "little")
            out.append(found)
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Ranges:
    """Hashes of word ranges by prefix sums; the two ways are independent."""

    def __init__(self, hashes: np.ndarray, way: int) -> None:
        base = _A if way else _B
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        count = len(hashes) + 1
        powers = np.full(count, base)
        powers[0] = 1
        self.sums = np.zeros(count, np.uint64)
        np.cumsum(mixed(hashes ^ base) * np.multiply.accumulate(powers)[:-1], out=self.sums[1:])
        powers[1:] = inverse
        self.back = np.multiply.accumulate(powers)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def _least_over(first: np.ndarray, last: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` places the number of the first interval (in the order given) that covers it, else their number.

    An interval is two overlapping ones of a power of two places; those of one size hand down to the next smaller, so the work
    does not grow with the intervals' length.
    """
    none = len(first)
    depth = np.frexp(last - first + 1)[1] - 1
    out = np.full(count, none)
    for level in range(int(depth.max(initial=0)), -1, -1):
        size = 1 << level
        given = np.flatnonzero(depth == level)[::-1]  # written last, the first interval stays
        for at in (first[given], last[given] - size + 1):
            own = np.full(count, none)
            own[at] = given
            np.minimum(out, own, out=out)
        if level:
            half = size >> 1
            np.minimum(out[half:], out[:-half].copy(), out=out[half:])
    return out


def anchors(texts: list[np.ndarray], window: int, rounds: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text the anchor key of each of its windows, and where the first symbol of this key in it begins."""
    long = [t for t in texts if len(t) >= window]
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    if not long:
        return [none for _ in texts]
    size = np.array([len(t) for t in long])
    place = np.cumsum(size + 1) - size  # one border before each text, one at the end
    count = int(place[-1] + size[-1] + 1)
    hashes, fixed = np.zeros(count, np.uint64), np.ones(count, bool)
    borders = np.append(place - 1, count - 1)
    hashes[borders] = mixed(borders.astype(np.uint64) + _C)
    for at, text in zip(place, long, strict=True):
        hashes[at:at + len(text)] = text
        fixed[at:at + len(text)] = False
    low, high = recompress(hashes, fixed, rounds)
    crossed = np.cumsum(fixed)
    whole = (crossed[high] == crossed[low]) & ~fixed[low] & (high - low < window)
    low, high = low[whole], high[whole]
    ranges = Ranges(hashes, 0)
    key = ranges(low, high + 1)
    # The windows that hold a range run from its begin to its low: their least range by key, then place.
    begin = np.maximum(low - (window - (high - low)) + 1, 0)
    order = np.lexsort((low, key))
    least = _least_over(begin[order], low[order], count)
    bare = least == len(order)
    best, spot = np.full(count, _NONE), np.arange(count)
    best[~bare], spot[~bare] = key[order[least[~bare]]], low[order[least[~bare]]]
    bare = np.flatnonzero(bare[:count - window])
    best[bare] = ranges(bare, bare + window)
    found = iter([(best[at:at + n - window + 1], spot[at:at + n - window + 1]) for at, n in zip(place, size, strict=True)])
    return [next(found) if len(t) >= window else none for t in texts]


def stretches(best: np.ndarray, spot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each stretch: one anchor at one place, so no two windows of a stretch are equal."""
    if not len(best):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (spot[1:] != spot[:-1])]))
    return head, np.append(head[1:], len(best)) - 1


def _chunks(batch: pa.RecordBatch, text: str, window: int, rounds: int) -> Iterator[tuple[int, bytes, np.ndarray, tuple]]:
    """(row, text, hashes of its words, anchors) of each row; many short texts are worked on at once."""
    held: list[tuple[int, bytes, np.ndarray]] = []
    total = 0

    def flush():
        for (row, data, hashes), best in zip(held, anchors([h for _, _, h in held], window, rounds), strict=True):
            yield row, data, hashes, best

    for row, data in enumerate(text_bytes(batch, text)):
        hashes = word_hashes(data)
        held.append((row, data or b"", hashes))
        total += len(hashes)
        if total >= CHUNK:
            yield from flush()
            held, total = [], 0
    yield from flush()


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _result(words: list[bytes], covered: np.ndarray) -> tuple[int, int, bytes]:
    removed = int(covered.sum())
    kept = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone] if removed else words
    return len(words), removed, b" ".join(kept)


def _cover(count: int, starts: np.ndarray, window: int) -> np.ndarray:
    marks = np.zeros(count + 1, np.int64)
    marks[starts] += 1
    marks[starts + window] -= 1
    return np.cumsum(marks)[:count] > 0


def remove_repeats(documents: DataFrame, window: int = 35, text: str = "text", doc_id: str = "doc_id", rounds: int = 4,
                   digest: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Documents with n_words, n_removed and kept_text, or with kept_sha256 for ``digest``."""
    last = "kept_sha256" if digest else "kept_text"
    out = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField(last, T.StringType())])
    passed = besides(out.names, documents.columns if keep is None else keep)
    keep = placed(passed)
    rows = documents.select(*aside(passed), F.col(text).alias("_text"),
                            F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(text)).alias("_row"))

    def shown(kept: bytes) -> str:
        return sha256(kept).hexdigest() if digest else kept.decode()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("_row").to_numpy()
            found = []
            for place, _, hashes, best in _chunks(batch, "_text", window, rounds):
                head, tail = stretches(*best)
                if len(head):
                    found.append((best[0][head], Ranges(hashes, 1)(head, tail + window), np.full(len(head), row[place])))
            if found:
                anchor, stretch, own = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([_signed(anchor), _signed(stretch), pa.array(own)], ["anchor", "stretch", "_row"])

    seen = written(in_arrow(rows.select("_text", "_row"), first, "anchor long, stretch long, _row long"), "anchors")
    repeated = written(
        seen.groupBy("anchor").agg(F.count("*").alias("n"), F.min("stretch").alias("least"), F.max("stretch").alias("most"))
        .filter("n > 1").select("anchor", (F.col("least") == F.col("most")).alias("equal")), "repeated")
    learnt = (sift(seen.select("anchor", "_row").distinct(), "anchor", repeated, "anchor").join(repeated, "anchor")
              .groupBy("_row").agg(
                  F.collect_list(F.when(F.col("equal"), F.col("anchor"))).alias("sure"),
                  F.collect_list(F.when(~F.col("equal"), F.col("anchor"))).alias("open")))
    learnt = written(learnt, "learnt")

    second = T.StructType([*out.fields, T.StructField("_covered", T.BinaryType()), T.StructField("_windows", T.BinaryType())])

    def judge(batch: pa.RecordBatch) -> list[pa.Array]:
        sure = batch.column("sure").to_pylist() if "sure" in batch.schema.names else [None] * batch.num_rows
        undecided = batch.column("open").to_pylist() if "open" in batch.schema.names else [None] * batch.num_rows
        columns: list[list] = [[] for _ in second.names]
        for place, data, _, best in _chunks(batch, "_text", window, rounds) if any(s is not None for s in sure) else (
                (k, t or b"", None, None) for k, t in enumerate(text_bytes(batch, "_text"))):
            words = data.split()
            covered, asked = np.zeros(len(words), bool), b""
            if sure[place]:
                covered = _cover(len(words), np.flatnonzero(np.isin(best[0], _unsigned(sure[place]))), window)
            if undecided[place]:
                starts = np.flatnonzero(np.isin(best[0], _unsigned(undecided[place])))
                asked = starts.astype(np.int32).tobytes()
            total, removed, kept = _result(words, covered)
            for column, value in zip(columns, (total, removed, None if asked else shown(kept),
                                               np.packbits(covered).tobytes() if asked else None, asked or None), strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
        return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]

    may, cannot = sift(rows, "_row", learnt, "_row", both=True)
    judged = written(arrow_columns(may.join(learnt, "_row", "left"), judge, second, [*keep, "_text", "_row"])
                     .withColumn("_text", F.when(F.col("_windows").isNotNull(), F.col("_text"))), "judged")
    clear = arrow_columns(cannot, judge, second, keep).select(*keep, *out.names)
    done = judged.filter("_windows IS NULL").select(*keep, *out.names)
    undecided = judged.filter("_windows IS NOT NULL")

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("_row").to_numpy()
            found = []
            for place, (data, asked) in enumerate(zip(text_bytes(batch, "_text"), batch.column("_windows").to_pylist(), strict=True)):
                one, two = _window_hashes(data, asked, window)
                order = np.lexsort((two, one))
                one, two = one[order], two[order]
                fresh = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
                times = np.minimum(np.diff(np.append(fresh, len(one))), 2)
                found.append((one[fresh], two[fresh], np.full(len(fresh), row[place]), times))
            if found:
                one, two, own, times = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([_signed(one), _signed(two), pa.array(own), pa.array(times)], ["one", "two", "_row", "n"])

    windows = written(in_arrow(undecided.select("_text", "_windows", "_row"), single, "one long, two long, _row long, n long"), "windows")
    twice = written(windows.groupBy("one", "two").agg(F.sum("n").alias("n")).filter("n > 1").select("one", "two"), "twice")
    told = (sift(windows.select("one", "two", "_row").distinct(), "one", twice, "one").join(twice, ["one", "two"])
            .groupBy("_row").agg(F.collect_list("one").alias("ones"), F.collect_list("two").alias("twos")))

    def finish(batch: pa.RecordBatch) -> list[pa.Array]:
        columns: list[list] = [[], [], []]
        for data, asked, packed, ones, twos in zip(
                text_bytes(batch, "_text"), *(batch.column(c).to_pylist() for c in ("_windows", "_covered", "ones", "twos")), strict=True):
            words = (data or b"").split()
            covered = np.unpackbits(np.frombuffer(packed, np.uint8), count=len(words)).astype(bool)
            if ones:
                one, two = _window_hashes(data, asked, window)
                # The two hashes of a window are in the lists at places of their own: pair them.
                pairs = np.sort(mixed(_unsigned(ones)) + _unsigned(twos))
                covered |= _cover(len(words), np.frombuffer(asked, np.int32).astype(np.int64)[np.isin(mixed(one) + two, pairs)], window)
            for column, value in zip(columns, _result(words, covered), strict=True):
                column.append(shown(value) if isinstance(value, bytes) else value)
        return [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)]

    rest = undecided.drop(*out.names).join(told, "_row", "left")
    return clear.union(done).union(arrow_columns(rest, finish, out, keep).select(*keep, *out.names)).toDF(*passed, *out.names)


def _unsigned(values: list[int]) -> np.ndarray:
    return np.array(values, np.int64).view(np.uint64)


def _window_hashes(data: bytes, asked: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
    hashes = word_hashes(data)
    starts = np.frombuffer(asked, np.int32).astype(np.int64)
    return Ranges(hashes, 0)(starts, starts + window), Ranges(hashes, 1)(starts, starts + window)
