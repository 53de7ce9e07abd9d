"""Importance resampling of documents with hashed n-gram models.

Words (lower-cased A-Z) and neighbouring pairs are hashed to ``buckets``. The target model counts them in
target documents, the raw model in all documents, both with additive smoothing. A document's weight is
the log ratio of the two models, summed over its n-grams; Gumbel noise from a hash of id and text is
added and the highest ``fraction`` of the scores is drawn, which samples without replacement in
proportion to the weights.

Target documents are labelled ones; at most ``max_labelled`` ids (those with the smallest hash) are used, which
bounds the side that is broadcast. Everything else covers all documents. The model is two counts per bucket.
The k-th highest score is found digit by digit over a written score table: four counting rounds of 65,536
bins, no global sort.

Defined results: null and empty texts have weight 0 and take part; repeated rows have the same noise and are
drawn together or not at all, so the draw can pass k by the copies of its last row; without target documents
all weights are 0 and the draw is uniform; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netledger.llm.common import arrow_columns, aside, besides, gram_hashes, hashed, in_arrow, placed, text_bytes, written

WEIGHTS = T.StructType([
    T.StructField("log_weight", T.DoubleType()), T.StructField("score", T.DoubleType()),
    T.StructField("score_bits", T.LongType()), T.StructField("tie", T.LongType())])


def buckets_of(data: bytes | None, buckets: int) -> np.ndarray:
    hashes = hashed((data or b"").lower().split())
    both = np.concatenate([hashes, gram_hashes(hashes, 2)])
    return (both % np.uint64(buckets)).astype(np.int64)


def labelled(labels: DataFrame, condition: str, max_labelled: int, doc_id: str = "doc_id") -> DataFrame:
    """Ids of labelled documents that meet the condition: all of them, or those with the smallest hashes."""
    ids = labels.filter(condition).select(doc_id).filter(F.col(doc_id).isNotNull()).distinct()
    return ids.orderBy(F.xxhash64(doc_id), doc_id).limit(max_labelled)


def ratios(documents: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id",
           buckets: int = 10_000, smoothing: float = 1.0) -> np.ndarray:
    """The log ratio of each bucket's probability under the target and the raw model.

    ``target`` is broadcast: it must be bounded, as that of ``labelled`` is.
    """
    flagged = documents.select(doc_id, text).join(
        F.broadcast(target.select(doc_id).withColumn("is_target", F.lit(True))), doc_id, "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for data, aimed in zip(text_bytes(batch, text), batch.column("is_target").to_pylist(), strict=True):
                found = np.bincount(buckets_of(data, buckets), minlength=buckets)
                counts[0] += found
                if aimed:
                    counts[1] += found
        some = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0][some]), pa.array(counts[1][some])],
                                         ["bucket", "raw", "target"])

    counts = np.zeros((2, buckets))
    for row in (in_arrow(flagged, count, "bucket long, raw long, target long").groupBy("bucket")
                .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()):
        counts[:, row["bucket"]] = row["raw"], row["target"]
    if not counts[1].any():
        return np.zeros(buckets)
    share = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles."""
    bits = values.view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def uniform(keys: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1."""
    return ((keys.view(np.uint64) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


def kth_highest(frame: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The k-th highest value of a long column (k at least 1), and the number of higher ones."""
    above, prefix = 0, 0
    high = F.col(column).bitwiseXOR(F.lit(-(1 << 63)))  # from here on the order of unsigned numbers
    for shift in (48, 32, 16, 0):
        part = frame if shift == 48 else frame.filter(F.shiftrightunsigned(high, shift + 16) == prefix)
        counts = dict(part.groupBy(F.shiftrightunsigned(high, shift).bitwiseAND(0xFFFF).alias("digit"))
                      .agg(F.count("*").alias("n")).collect())
        for digit in sorted(counts, reverse=True):
            if above + counts[digit] >= k:
                prefix = (prefix << 16) | digit
                break
            above += counts[digit]
    value = prefix ^ (1 << 63)
    return value - (1 << 64) if value >= 1 << 63 else value, above


def resample(documents: DataFrame, target: DataFrame, fraction: float = 0.5, text: str = "text", doc_id: str = "doc_id",
             buckets: int = 10_000, smoothing: float = 1.0, seed: int = 0, keep: list[str] | None = None) -> DataFrame:
    """Documents with log_weight, score and selected."""
    log_ratio = ratios(documents, target, text, doc_id, buckets, smoothing)
    names = ["log_weight", "score", "selected"]
    passed = besides(names, documents.columns if keep is None else keep)
    keyed = documents.select(*aside(passed), F.col(text).alias("_text"),
                             F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), F.col(text)).alias("noise_key"))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        weights = np.array([log_ratio[buckets_of(t, buckets)].sum() for t in text_bytes(batch, "_text")], np.float64)
        keys = batch.column("noise_key").to_numpy(zero_copy_only=False)
        scores = weights - np.log(-np.log(uniform(keys)))
        return [pa.array(weights), pa.array(scores), pa.array(ordered_bits(scores)), pa.array(keys)]

    scored = written(arrow_columns(keyed, compute, WEIGHTS, placed(passed)), "scores")
    k = int(np.ceil(fraction * scored.count()))
    if k:
        bits, above = kth_highest(scored, "score_bits", k)
        tie, _ = kth_highest(scored.filter(F.col("score_bits") == bits), "tie", k - above)
        selected = (F.col("score_bits") > bits) | ((F.col("score_bits") == bits) & (F.col("tie") >= tie))
    else:
        selected = F.lit(False)
    return scored.withColumn("selected", selected).drop("score_bits", "tie").toDF(*passed, *names)
