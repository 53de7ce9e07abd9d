"""Source divergence: how far the words of each source are from those of the other sources and of its whole language.

1. Single-pass in-memory indexing. Each task adds the terms of its documents to a block of postings (language, term, source ->
   occurrences, documents) until ``HELD`` bytes are in use, then writes the block, sorted by shard, language, term and source, as a run.
2. A shard (a hash range of language and term) is one task: Spark hands it its pieces of all runs, sorted, and a heap merges them as a
   stream, a piece of a run at a time. A term's postings are added up, and it is kept if
   enough documents of its language hold it. More than ``FAN_IN`` runs are merged in several passes.
3. Probabilities are computed in integers of 1e-9 with long division, so nothing overflows or is rounded.
4. The divergence of two sources is the number of kept terms times the value of a term that neither has, plus corrections
   streamed from the postings: only terms that at least one of the two has change the sum. Sources are dealt to tiles of bounded
   size and terms to parts of bounded size; a task holds the postings of one part of a pair of tiles.

Defined results: null text, language and source are the empty text; a group without terms is listed with its pairs (value 0 where
the language keeps no term) and no term rows; repeated rows count again; texts of any length are read whole; ties are
ranked by item in UTF-8 order; an empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netledger.llm.common import in_arrow, text_bytes, written

#: ASCII letters fold to lower case, bytes from 0x80 on stay, all others part terms.
FOLD = bytes(b | 0x20 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of postings, and words, that a task holds before it writes them as a run.
HELD, WORDS_HELD = 48_000_000, 1 << 30
#: Postings in one row of a run (about 10 kB, as Spark hands rows to Python by the ten thousand), and rows of a run in one batch.
PIECE, PIECES = 256, 256
#: Runs that one heap merges; more are merged in several passes.
FAN_IN = 1_024
#: Postings that a merge step waits for.
STEP = 100_000
SCALE = 1_000_000_000
RUNS = "shard int, run long, piece int, first binary, key array<binary>, source array<string>, n array<long>, docs array<long>"
POSTING = pa.schema([("key", pa.binary()), ("source", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _batches(postings: pa.Table, shard: np.ndarray, run: int) -> Iterator[pa.RecordBatch]:
    """Rows of a run: the postings in order of shard, key and source, cut into pieces of one shard each."""
    ordered = postings.append_column("shard", pa.array(shard.astype(np.int32)))
    ordered = ordered.take(pc.sort_indices(ordered, [(c, "ascending") for c in ("shard", "key", "source")])).combine_chunks()
    shard = ordered.column("shard").to_numpy()
    cuts = [np.arange(a, b, PIECE) for a, b in zip(*(f(np.flatnonzero(np.diff(shard)) + 1) for f in (
        lambda c: np.concatenate([[0], c]), lambda c: np.append(c, len(shard)))), strict=True)] if len(shard) else []
    starts = np.concatenate([*cuts, [len(shard)]]).astype(np.int64)
    numbers = np.concatenate([np.arange(len(c)) for c in cuts] or [[]]).astype(np.int32)
    columns = [ordered.column(c).combine_chunks() for c in POSTING.names]
    for at in range(0, len(numbers), PIECES):
        own = starts[at:at + PIECES + 1]
        low, count = int(own[0]), int(own[-1] - own[0])
        offsets, firsts = pa.array((own - low).astype(np.int32)), pa.array(own[:-1])
        yield pa.RecordBatch.from_arrays(
            [ordered.column("shard").combine_chunks().take(firsts), pa.array(np.full(len(firsts), run, np.int64)),
             pa.array(numbers[at:at + PIECES]), columns[0].take(firsts),
             *[pa.ListArray.from_arrays(offsets, c.slice(low, count)) for c in columns]],
            ["shard", "run", "piece", "first", *POSTING.names])


def runs(documents: DataFrame, text: str, lang: str, source: str, shards: int) -> DataFrame:
    """Term-sorted runs of postings, in pieces of one shard each. The empty term counts the documents of a group.

    A posting's key is its language and its term, parted by a zero byte, which no term holds.
    """
    rows = documents.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
                              for c, name in ((lang, "lang"), (source, "source"), (text, "text"))],
                            F.spark_partition_id().cast("long").alias("task"))

    def spill(block: dict[tuple[str, str], tuple[Counter, Counter]], run: int) -> Iterator[pa.RecordBatch]:
        tables, hashes = [], []
        while block:
            (lang_, source_), (n, docs) = block.popitem()
            before = lang_.encode() + b"\0"
            salt = crc32(before)
            terms = list(docs)
            hashes.append(np.fromiter((crc32(t, salt) for t in terms), np.uint32, len(terms)))
            keys = pc.binary_join_element_wise(pa.scalar(before, pa.binary()), pa.array(terms, pa.binary()), pa.scalar(b"", pa.binary()))
            tables.append(pa.Table.from_arrays(
                [keys, pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(terms), np.int32)), pa.array([source_])).cast(pa.string()),
                 pa.array(map(n.__getitem__, terms), pa.int64(), size=len(terms)), pa.array(docs.values(), pa.int64(), size=len(terms))],
                schema=POSTING))
            del n, docs, terms
        yield from _batches(pa.concat_tables(tables), np.concatenate(hashes) % shards, run)
        del tables
        pa.default_memory_pool().release_unused()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, words_held, run = {}, 0, 0, None
        for batch in batches:
            if run is None and batch.num_rows:
                run = batch.column("task")[0].as_py() << 20
            for lang_, source_, data in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(),
                                            text_bytes(batch, "text"), strict=True):
                n, docs = block.get((lang_, source_)) or block.setdefault((lang_, source_), (Counter(), Counter()))
                before = len(docs)
                words = data.translate(FOLD).split()
                words.append(b"")
                n.update(words)
                docs.update(set(words))
                held += 280 * (len(docs) - before)
                words_held += len(words)
                if held > HELD or words_held > WORDS_HELD:
                    yield from spill(block, run)
                    block, held, words_held, run = {}, 0, 0, run + 1
        if block:
            yield from spill(block, run)

    return in_arrow(rows, index, RUNS)


def _merged(pieces: Iterator[tuple[bytes, pa.Table]]) -> Iterator[pa.Table]:
    """The postings of all runs added up by key and source, as tables whose keys follow one another.

    Pieces come sorted by their first key and wait in a heap by their last key. No later piece holds a key below the first of the next
    one: pieces that end below it leave the heap, the others are cut there, and all that is below is added up at once.
    So only pieces that overlap are open, one or two of each run.
    """
    heap: list[tuple[bytes, int, pa.Table]] = []
    number = waiting = 0

    def below(bound: bytes | None) -> Iterator[pa.Table]:
        done = []
        while heap and (bound is None or heap[0][0] < bound):
            done.append(heapq.heappop(heap)[2])
        for place, (last, own, piece) in enumerate(heap):
            cut = pc.sum(pc.less(piece.column("key"), pa.scalar(bound, pa.binary()))).as_py() or 0
            if cut:
                done.append(piece.slice(0, cut))
                heap[place] = (last, own, piece.slice(cut))
        if done:
            found = pa.concat_tables(done).group_by(["key", "source"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
            yield found.select(["key", "source", "n_sum", "docs_sum"]).rename_columns(POSTING.names)

    for first, piece in pieces:
        if waiting > STEP:
            yield from below(first)
            waiting = 0
        heapq.heappush(heap, (piece.column("key")[-1].as_py(), number, piece))
        number, waiting = number + 1, waiting + piece.num_rows
    yield from below(None)


def _shards(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[tuple[tuple, Iterator[pa.Table]]]:
    """(values of ``by``, merged postings) of each group of pieces."""
    def pieces() -> Iterator[tuple]:
        for batch in batches:
            names = zip(*[batch.column(c).to_pylist() for c in by], strict=True)
            columns = [batch.column(c) for c in POSTING.names]
            for k, (name, first) in enumerate(zip(names, batch.column("first").to_pylist(), strict=True)):
                yield name, first, pa.Table.from_arrays([c[k].values for c in columns], schema=POSTING)

    for name, found in groupby(pieces(), itemgetter(0)):
        yield name, _merged(piece[1:] for piece in found)


def _combined(pieces: DataFrame) -> DataFrame:
    """The runs merged, ``FAN_IN`` at a time, until one heap can hold them all."""
    while (number := pieces.select("run").distinct().count()) > FAN_IN:
        groups = -(-number // FAN_IN)
        dealt = (pieces.withColumn("into", F.pmod(F.xxhash64("run"), F.lit(groups))).repartition("shard", "into")
                 .sortWithinPartitions("shard", "into", "first", "run", "piece"))

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (shard, into), merged in _shards(batches, ("shard", "into")):
                for found in merged:
                    yield from _batches(found, np.full(found.num_rows, shard), into)

        pieces = written(in_arrow(dealt, merge, RUNS), "runs")
    return pieces


def frequencies(pieces: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, source, n, total, first) of kept terms; ``total`` is the term's count in the language, ``first`` true once a term.

    The empty term's rows list all groups, with the number of their documents.
    """
    dealt = _combined(pieces).repartition("shard").sortWithinPartitions("shard", "first", "run", "piece")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, merged in _shards(batches, ("shard",)):
            for found in merged:
                keys = found.column("key").combine_chunks().dictionary_encode()
                place, names = keys.indices.to_numpy(), keys.dictionary
                total, docs = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
                np.add.at(total, place, found.column("n").to_numpy())
                np.add.at(docs, place, found.column("docs").to_numpy())
                listed = np.flatnonzero(docs >= least_docs)
                parted = {k: names[k].as_py().rpartition(b"\0") for k in listed.tolist()}
                for k in np.flatnonzero(pc.ends_with(names, b"\0").to_numpy(zero_copy_only=False)).tolist():
                    parted[k] = names[k].as_py().rpartition(b"\0")
                number = np.full(len(names), -1, np.int64)
                number[list(parted)] = np.arange(len(parted))
                rows = np.flatnonzero(number[place] >= 0)
                own = place[rows]
                once = np.zeros(len(rows), bool)
                once[np.unique(own, return_index=True)[1]] = True
                texts = [pa.array([p[k].decode() for p in parted.values()], pa.string()).take(pa.array(number[own])) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays(
                    [*texts, found.column("source").combine_chunks().take(pa.array(rows)), pa.array(found.column("n").to_numpy()[rows]),
                     pa.array(total[own]), pa.array(once)], ["lang", "term", "source", "n", "total", "first"])
                del keys, found
                pa.default_memory_pool().release_unused()

    return in_arrow(dealt, merge, "lang string, term string, source string, n long, total long, first boolean")


def _p(count: Column, all_: Column, kept: Column) -> Column:
    """1 + floor(1e9 * (count + 2) / (all + 2 * kept)), exact for counts beyond 64 bits' products."""
    whole = (count + F.lit(2)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    parts = F.greatest(all_ + 2 * kept, F.lit(1)).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", whole, parts)


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def values(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _pairs(groups: DataFrame, scored: DataFrame, tile_sources: int, part_rows: int) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language."""
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / tile_sources).cast("int").alias("tiles"),
                                       F.ceil(F.sum("terms") / part_rows).cast("int").alias("parts"))
    sizes = written(sizes.withColumn("parts", F.greatest("parts", F.lit(1))), "sizes")

    def tiled(frame: DataFrame) -> DataFrame:
        """Copies of a row for each pair (i, j), i <= j, of tiles that its own is one of."""
        own = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
        return (frame.join(sizes, "lang").withColumn("_own", own)
                .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
                .withColumn("i", F.least("_own", "_with")).withColumn("j", F.greatest("_own", "_with")))

    terms = tiled(scored).withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int")).select(
        "lang", "i", "j", "part", "term", "source", "p")
    sides = (tiled(groups).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("lang", "i", "j", "part", F.col("_own").alias("own"), "source", "p0", "kept"))

    def correct(found: pa.Table, side: pa.Table) -> pa.Table:
        names, kept = side.column("source").to_pylist(), side.column("kept")[0].as_py()
        lang, i, j, part = (side.column(c)[0].as_py() for c in ("lang", "i", "j", "part"))
        order = {s: k for k, s in enumerate(names)}
        none = side.column("p0").to_numpy()
        base = values(none[:, None], none[None, :])
        total = base * (kept if part == 0 else 0)
        at = np.fromiter((order[s] for s in found.column("source").to_pylist()), np.int64, found.num_rows)
        p, words = found.column("p").to_numpy(), found.column("term").to_pylist()
        term = np.unique(np.array(words, object), return_inverse=True)[1] if words else np.zeros(0, np.int64)
        by_term = np.argsort(term, kind="stable")
        for places in np.split(by_term, np.flatnonzero(np.diff(term[by_term])) + 1):
            if not len(places):
                continue
            own, every = at[places], none.copy()
            every[own] = p[places]
            change = values(every[own][:, None], every[None, :]) - base[own]
            total[own] += change
            change[:, own] = 0
            total[:, own] += change.T
        # Two sources of one tile meet in all pairs of tiles that hold it; the pair (tile, tile) reports them.
        tile = side.column("own").to_numpy()
        a, b = np.nonzero(tile[:, None] != tile[None, :] if i != j else ~np.eye(len(names), dtype=bool))
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": pa.array([names[k] for k in a], pa.string()),
                         "item": pa.array([names[k] for k in b], pa.string()), "value": pa.array(total[a, b], pa.int64())})

    keys = ("lang", "i", "j", "part")
    parts = terms.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInArrow(
        correct, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 10,
                      top_terms: int = 10, shards: int | None = None, tile_sources: int = 512,
                      part_rows: int = 250_000) -> DataFrame:
    """lang, source, part, item, value and rank: ``pair`` rows for all other sources, ``term`` rows for the most over-used terms."""
    spark = documents.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = written(runs(documents, text, lang, source, shards), "runs")
    counted = written(frequencies(pieces, least_docs), "frequencies")
    terms = counted.filter("term <> ''")
    langs = terms.groupBy("lang").agg(F.sum("n").alias("all_lang"), F.sum(F.col("first").cast("long")).alias("kept"))
    own = terms.groupBy("lang", "source").agg(F.sum("n").alias("all"), F.count("*").alias("terms"))
    groups = (counted.filter("term = ''").select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left")
              .na.fill(0, ["all", "terms", "all_lang", "kept"]).withColumn("p0", _p(F.lit(0).cast("long"), F.col("all"), F.col("kept"))))
    groups = written(groups, "groups")
    scored = written(terms.select("lang", "term", "source", "n", "total").join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _p(F.col("n"), F.col("all"), F.col("kept")).alias("p"),
        _p(F.col("total"), F.col("all_lang"), F.col("kept")).alias("q")), "scored")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    best = (scored.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                          _f(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms))
    pairs = _pairs(groups, scored, tile_sources, part_rows).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)
