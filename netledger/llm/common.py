"""What several operators share: columns computed from Arrow batches, written steps, components."""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from hashlib import blake2b
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netledger.session import work_path
from netledger.sinks.publish import remove


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch. Spark and the Python worker each hold some copies of one, for every task that runs.
BATCH_BYTES = 8_000_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_arrow(frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` on workers that look for this package where the driver found it.

    A cluster whose machines do not have it there gets it as usual, with ``--py-files``. The session's batches are
    bounded by ``BATCH_BYTES`` unless it has a bound of its own; no result depends on it.
    """
    spark = frame.sparkSession
    if _BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, *known) if x)
    names = frame.columns
    if any(set(".`") & set(n) for n in names):  # Spark would read such a name as a path
        return frame.toDF(*placed(names)).mapInArrow(lambda batches: run(b.rename_columns(names) for b in batches), schema)
    return frame.mapInArrow(run, schema)


def text_bytes(batch: pa.RecordBatch, name: str, at_once: int = 64) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a text column; only some texts are copied out of the batch at once."""
    column = batch.column(name).cast(pa.binary())
    for place in range(0, len(column), at_once):
        yield from column.slice(place, at_once).to_pylist()


def besides(new: Iterable[str], columns: list[str]) -> list[str]:
    """The columns that no new one replaces; Spark takes names that differ in case for one."""
    taken = {n.lower() for n in new}
    return [c for c in columns if c.lower() not in taken]


def aside(columns: list[str]) -> list[Column]:
    """The columns by place (see ``placed``), so that no name an operator uses inside meets theirs."""
    return [F.col(f"`{c}`").alias(p) for c, p in zip(columns, placed(columns), strict=True)]


def placed(columns: list[str]) -> list[str]:
    return [f"_kept{i}" for i in range(len(columns))]


def arrow_columns(frame: DataFrame, compute: Callable[[pa.RecordBatch], list[pa.Array]],
                  fields: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """Append the columns that ``compute`` makes of each Arrow batch.

    Spark bounds a batch by rows and bytes (see ``in_arrow``). ``keep``
    names the input columns passed on (all by default); one named like a new column is replaced.
    """
    passed = besides(fields.names, frame.columns if keep is None else keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in passed] + made, [*passed, *fields.names])
            del batch, made
        pa.default_memory_pool().release_unused()

    schema = T.StructType([frame.schema[c] for c in passed] + list(fields.fields))
    return in_arrow(frame, run, schema)


#: The tables written inside ``discarding`` blocks that are open, innermost last.
_SCRATCH: list[list[str]] = []


def written(frame: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """The frame as a table in the shared folder, which any executor can read again.

    Inside a ``discarding`` block the table goes with the block unless it is to be kept.
    """
    spark = frame.sparkSession
    path = work_path(spark, label)
    frame.write.parquet(path)
    if _SCRATCH and not keep:
        _SCRATCH[-1].append(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Remove the tables written inside once the block has ended well; what its results are read from is written with ``keep``."""
    paths: list[str] = []
    _SCRATCH.append(paths)
    try:
        yield
    finally:
        _SCRATCH.pop()
    for path in paths:
        remove(spark, path)


MAX_BLOCKS = 1 << 20


def bloom_mask(value: Column, bits: int = 6) -> Column:
    """``bits`` bits of a 64-bit block, chosen by six bits of a hash each."""
    second, mask = F.xxhash64(F.lit(1), value), F.lit(0).cast("bigint")
    for k in range(bits):
        place = F.shiftrightunsigned(second, 6 * k).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return mask


def bloom(listed: DataFrame, value: str, blocks: int, bits: int = 6) -> DataFrame:
    """Blocked Bloom filter of the listed values as (block, mask): at most ``blocks`` rows."""
    return listed.groupBy(F.pmod(F.xxhash64(value), F.lit(blocks)).alias("block")).agg(
        F.bit_or(bloom_mask(F.col(value), bits)).alias("mask"))


def marked(frame: DataFrame, value: str, listed: DataFrame, listed_value: str, mark: str = "_may", bits: int = 6,
           per_block: int = 5, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The frame with a boolean that is true for all listed values (and few others).

    The broadcast side has at most ``max_blocks`` rows, however many values are listed.
    """
    blocks = max(1, min(max_blocks, -(-listed.count() // per_block)))
    own = bloom_mask(F.col(value), bits)
    return (frame.withColumn("_block", F.pmod(F.xxhash64(value), F.lit(blocks)))
            .join(F.broadcast(bloom(listed, listed_value, blocks, bits).toDF("_block", "_mask")), "_block", "left")
            .withColumn(mark, F.coalesce(F.col(value).isNotNull() & (F.col("_mask").bitwiseAND(own) == own), F.lit(False)))
            .drop("_block", "_mask"))


def sift(frame: DataFrame, value: str, listed: DataFrame, listed_value: str,
         both: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """The rows whose value may be listed, before a join that decides; with ``both`` also those that cannot."""
    judged = marked(frame, value, listed, listed_value, "_may")
    may = judged.filter("_may").drop("_may")
    return (may, judged.filter("NOT _may").drop("_may")) if both else may


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of each node of (a, b) links; root is the smallest node that can be reached.

    Large-star and small-star rounds: each points a node's neighbours at the smallest one, so the
    number of rounds is about the logarithm of the longest chain. Every step is written to the
    shared folder; no group is gathered, minima are combined before their exchange. Being tables, they are joined
    by exchanges that Spark splits where one node has a large part of all links.
    """
    current = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct(), "links")
    for _ in range(rounds):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = written(both.join(least, "a").filter("b > a")
                        .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), "links")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        following = written(small, "links")
        same = (following.groupBy().agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
                == current.groupBy().agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        current = following
        if same:
            break
    else:
        raise RuntimeError(f"links are not settled after {rounds} rounds")
    return (current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))


class Words(dict):
    """Numbers and 64-bit hashes of words, kept per worker process and emptied at ``limit`` bytes.

    A list of words becomes an array of numbers with one dictionary lookup a word; whatever depends
    on the word alone is then computed once per distinct word and gathered by number.
    """

    def __init__(self, limit: int = 8_000_000) -> None:
        super().__init__()
        self.limit, self.held, self.hashes = limit, 0, array("Q")

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(int.from_bytes(blake2b(word, digest_size=8).digest(), "little"))
        self.held += len(word) + 24
        return number

    def full(self) -> bool:
        return self.held > self.limit

    def forget(self) -> None:
        self.clear()
        self.held, self.hashes = 0, array("Q")

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashed(self, words: list[bytes]) -> np.ndarray:
        """The 64-bit hash of each word."""
        if self.full():
            self.forget()
        numbers = self.numbers(words)
        return np.frombuffer(self.hashes, np.uint64)[numbers] if len(words) else np.zeros(0, np.uint64)


#: The words of this worker process, shared by the operators that follow one another in it.
WORDS = Words()
#: Empties the tables that this worker process keeps from task to task.
_KEPT: list[Callable[[], None]] = []


def keeps(forget: Callable[[], None]) -> None:
    """From now on this worker process keeps the tables that ``forget`` empties; other operators' tables are given up."""
    if _KEPT != [forget]:
        for other in _KEPT:
            other()
        _KEPT[:] = [forget]


def hashed(words: list[bytes]) -> np.ndarray:
    """The 64-bit hash of each word, by the table of this worker process."""
    keeps(WORDS.forget)
    return WORDS.hashed(words)


_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    out = values ^ (values >> np.uint64(32))
    out = out * np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def gram_hashes(hashes: np.ndarray, size: int, way: int = 0) -> np.ndarray:
    """A 64-bit hash of each window of ``size`` word hashes; ``way`` 0 and 1 are independent."""
    count = len(hashes) - size + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    factor = np.uint64(_MIX[way])
    base = mixed(hashes + factor) if way else hashes
    out = base[:count].copy()
    for step in range(1, size):
        out *= factor
        out += base[step:step + count]
    return mixed(out)
