"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

1. Words are counted per task in a dictionary of bounded size; Spark adds the counts.
2. Two words one edit apart agree in the first half or in the second half of the shorter one. Each word is therefore a member of
   the lists of its halves (for the lengths ``n`` that the shorter word may have); a list holds the words that agree outside
   the stretch ``[lo, hi)`` of the shorter word. A list of more than ``list_words`` words is divided in the middle of its stretch,
   again and again, down to a stretch of one place, where the alphabet bounds it. No word or pair is left out.
3. Each list is scanned in sorted order. A row of the edit matrix, banded to one edit, belongs to all words that share a prefix:
   the rows of a prefix are computed once and reused as far as the longest common prefix (LCP) of adjacent words reaches,
   and where a prefix already costs more than one edit its whole range is skipped. The prefixes of one length are
   handled together, for all queries of the list.
4. A pair is reported by the one list in which it first differs inside the stretch, so near words count once.

Defined results: null and empty texts hold no words; repeated rows (of one doc_id and text too) count again, each by its own doc_id; a null
doc_id is the empty text in the hash; words and runs may have any length; an empty table gives no rows. Ties of the most frequent
near word go to the smallest in code-point order. Columns besides id and text are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netledger.llm.common import in_arrow, text_bytes, written

RUN = "[A-Za-zÀ-ÿ]{%d,}"
#: Bytes of distinct words a task holds before it passes their counts on.
HELD = 64_000_000
#: Queries whose matrix rows are in memory at once.
QUERIES = 2_048


def counts(documents: DataFrame, text: str, doc_id: str, every: int, shortest: int) -> DataFrame:
    """(word, n): runs of letters, one code point deleted where ``every`` divides the hash of document and run."""
    rows = documents.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
                            F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, found, held = re.compile(RUN % shortest), Counter(), 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                              ["word", "n"])

        for batch in batches:
            for own, data in zip(batch.column("id").to_pylist(), text_bytes(batch, "text"), strict=True):
                before = crc32(f"{own}:".encode())
                for word, n in Counter(pattern.findall((data or b"").lower().decode())).items():
                    code = crc32(word.encode(), before)
                    if code % every == 0:
                        place = code % len(word)
                        word = word[:place] + word[place + 1:]
                        if len(word) < shortest:
                            continue
                    if word not in found:
                        held += len(word) + 120
                    found[word] += n
                if held > HELD:
                    yield out()
                    found, held = Counter(), 0
        yield out()

    return in_arrow(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _key() -> Column:
    """The list of a member: all words alike outside the stretch."""
    tail = F.substr(F.col("word"), F.char_length("word") - (F.col("size") - F.col("hi")) + 1)
    return F.xxhash64("size", "lo", "hi", F.substr(F.col("word"), F.lit(1), F.col("lo")), tail)


def _halves(lo: Column, hi: Column) -> Column:
    middle = F.floor((lo + hi) / 2).cast("int")
    return F.array(F.struct(middle.alias("lo"), hi.alias("hi")), F.struct(lo.alias("lo"), middle.alias("hi")))


def lists(words: DataFrame, shortest: int, list_words: int) -> DataFrame:
    """(key, size, lo, hi, word, n): the members of every list, none of which is longer than its bound."""
    length = F.char_length("word")
    sized = words.withColumn("size", F.explode(F.filter(F.array(length, length - 1), lambda n: n >= shortest)))
    members = (sized.withColumn("s", F.explode(_halves(F.lit(0), F.col("size"))))
               .select("size", "s.lo", "s.hi", "word", "n").withColumn("key", _key()))
    done = None
    while True:
        large = written(members.groupBy("key").agg(F.count("*").alias("c"), F.max(F.col("hi") - F.col("lo")).alias("w"))
                        .filter((F.col("c") > list_words) & (F.col("w") > 1)).select("key"), "lists")
        if large.isEmpty():
            return members if done is None else done.unionByName(members)
        small = members.join(large, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        parts = members.join(large, "key", "left_semi").withColumn("s", F.explode(_halves(F.col("lo"), F.col("hi"))))
        members = written(parts.select("size", "s.lo", "s.hi", "word", "n").withColumn("key", _key()), "members")


class SortedList:
    """Sorted lists side by side: ``keys`` tells them apart, ``parts`` are the strings of each in order."""

    def __init__(self, keys: np.ndarray, parts: list[str]) -> None:
        self.count = len(parts)
        self.length = np.fromiter(map(len, parts), np.int64, self.count)
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        self.letters = np.concatenate([np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32), np.zeros(1, np.uint32)])
        self.lcp = self._adjacent(keys)
        heads = np.flatnonzero(self.lcp < 0)
        self.list_start = heads[np.searchsorted(heads, np.arange(self.count), "right") - 1]
        self.list_end = np.append(heads, self.count)[np.searchsorted(heads, np.arange(self.count), "right")]

    def letter(self, word: np.ndarray, place: np.ndarray | int) -> np.ndarray:
        """The letter at a place of a word, 0 outside."""
        inside = (place >= 0) & (place < self.length[word])
        return self.letters[np.where(inside, self.first[word] + place, len(self.letters) - 1)]

    def _adjacent(self, keys: np.ndarray) -> np.ndarray:
        """Common prefix of each string with the one before; -1 where a list begins."""
        lcp = np.full(self.count, -1, np.int64)
        same = np.flatnonzero(keys[1:] == keys[:-1]) + 1
        lcp[same] = 0
        depth = 0
        while len(same):
            one = self.letter(same, depth)
            same = same[(one != 0) & (one == self.letter(same - 1, depth))]
            depth += 1
            lcp[same] = depth
        return lcp

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places (a, b), a < b, of strings of one list that are exactly one edit apart."""
        runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def at(depth: int) -> tuple[np.ndarray, np.ndarray]:
            """Starts of the runs that share a prefix of this length, and the run of each place."""
            if depth not in runs:
                starts = np.flatnonzero(self.lcp < depth)
                runs[depth] = np.append(starts, self.count), np.cumsum(self.lcp < depth) - 1
            return runs[depth]

        lefts, rights = [], []
        for begin in range(0, self.count, QUERIES):
            query = np.arange(begin, min(begin + QUERIES, self.count))
            start, end = self.list_start[query], self.list_end[query]
            rows = np.tile(np.array([2, 0, 1], np.int8), (len(query), 1))
            depth = 0
            while len(query):
                off = self.length[query] - depth
                whole = np.flatnonzero((self.length[start] == depth) & (np.abs(off) <= 1) & (start > query))
                hit = whole[rows[whole, off[whole] + 1] == 1]
                lefts.append(query[hit])
                rights.append(start[hit])
                starts, run = at(depth + 1)
                low, high = run[start], run[end - 1] + 1
                times = high - low
                parent = np.repeat(np.arange(len(query)), times)
                child = np.arange(len(parent)) - np.repeat(np.cumsum(times) - times, times) + low[parent]
                query, start, end, rows = query[parent], starts[child], starts[child + 1], rows[parent]
                open_ = (self.length[start] > depth) & (end > query + 1)
                query, start, end, rows = query[open_], start[open_], end[open_], rows[open_]
                rows = self._row(query, self.letter(start, depth), rows, depth)
                alive = rows.min(axis=1) <= 1
                query, start, end, rows = query[alive], start[alive], end[alive], rows[alive]
                depth += 1
        return np.concatenate(lefts or [np.zeros(0, np.int64)]), np.concatenate(rights or [np.zeros(0, np.int64)])

    def _row(self, query: np.ndarray, letter: np.ndarray, rows: np.ndarray, depth: int) -> np.ndarray:
        """The matrix row after one more letter: distances to the query's prefixes one shorter, equal, one longer (2 stands for more)."""
        differs = [(letter != self.letter(query, depth + k)).astype(np.int8) for k in (-1, 0, 1)]
        out = np.empty_like(rows)
        out[:, 0] = np.minimum(rows[:, 0] + differs[0], rows[:, 1] + 1)
        out[:, 1] = np.minimum(np.minimum(rows[:, 1] + differs[1], rows[:, 2] + 1), out[:, 0] + 1)
        out[:, 2] = np.minimum(rows[:, 2] + differs[2], out[:, 1] + 1)
        return np.minimum(out, 2)


def _scan(members: pa.Table) -> pa.RecordBatch:
    """Near words of whole lists: per word their number in this list and the most frequent one."""
    words, n = members.column("word").to_pylist(), members.column("n").to_numpy()
    size, lo, hi = (members.column(c).to_numpy() for c in ("size", "lo", "hi"))
    keys = members.column("key").to_numpy()
    parts = [w[a:len(w) - (s - b)] for w, s, a, b in zip(words, size.tolist(), lo.tolist(), hi.tolist(), strict=True)]
    order = sorted(range(len(words)), key=lambda k: (keys[k], parts[k]))
    left, right = SortedList(keys[order], [parts[k] for k in order]).pairs()
    order = np.array(order, np.int64)
    number, best = Counter(), {}
    for a, b in zip(order[left].tolist(), order[right].tolist(), strict=True):
        one, two, s, h = words[a], words[b], size[a], hi[a]
        if min(len(one), len(two)) != s or one[:lo[a]] != two[:lo[a]] or (h < s and one[:h] == two[:h]):
            continue
        for own, other in ((a, b), (b, a)):
            number[own] += 1
            rank = (-n[other], words[other])
            if own not in best or rank < best[own]:
                best[own] = rank
    own = list(number)
    return pa.RecordBatch.from_arrays(
        [pa.array([words[k] for k in own], pa.string()), pa.array([n[k] for k in own], pa.int64()),
         pa.array([number[k] for k in own], pa.int64()), pa.array([-best[k][0] for k in own], pa.int64()),
         pa.array([best[k][1] for k in own], pa.string())], ["word", "n", "n_near", "near_n", "near"])


def near_words(words: DataFrame, shortest: int = 7, list_words: int = 4_096, batch_rows: int = 20_000) -> DataFrame:
    """(word, n, n_near, near_n, near) of the words (word, n) that have a near word: one inserted, deleted or replaced code point."""
    members = lists(words, shortest, list_words)
    columns = ["key", "size", "lo", "hi", "word", "n"]
    dealt = members.select(*columns).repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) < batch_rows:
                continue
            rows = pa.Table.from_batches(waiting).combine_chunks()
            keys = rows.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last list may go on in the next batch
            if cut:
                yield _scan(rows.slice(0, cut))
            waiting = rows.slice(cut).to_batches()
        if waiting:
            yield _scan(pa.Table.from_batches(waiting))

    found = in_arrow(dealt, run, "word string, n long, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("w")))
    return (found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n", "n_near", (-F.col("b.n")).alias("near_n"), F.col("b.w").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of (word, form) steps, whose length halves with every round.

    A form is at least ten times as frequent as its word, so chains have no cycle and few steps.
    """
    current = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ends = current.select(F.col("word").alias("root"), F.col("root").alias("end"))
        joined = written(current.join(ends, "root", "left").select(
            "word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "roots")
        current = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            return current


def spelling_variants(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", every: int = 31, shortest: int = 7,
                      least: int = 2, ratio: int = 10, list_words: int = 4_096) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of at least ``least`` occurrences.

    ``form`` is the most frequent near word if it is ``ratio`` times as frequent as the word; ``root`` the last of its chain of forms.
    """
    words = written(counts(documents, text, doc_id, every, shortest).filter(F.col("n") >= least), "words")
    near = written(near_words(words, shortest, list_words), "near")
    forms = near.filter(F.col("near_n") >= ratio * F.col("n")).select(
        "word", "n_near", F.col("near").alias("form"), F.col("near_n").alias("form_n"))
    chains = roots(forms)
    found = near.select("word", "n_near").join(
        forms.select("word", "form", "form_n").join(chains, "word"), "word", "left")
    return words.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n")
