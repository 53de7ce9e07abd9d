"""A corpus pipeline of five stages; each works on all that the one before kept.

Quality rules drop documents; of near-duplicates (five words, 0.8) the one with the smallest doc_id stays; contaminated
documents are dropped; secrets are replaced in the texts; the rest is encoded and decoded. Rows that repeat a doc_id and its
text are one document and stay or go together; rows without a doc_id are judged by their text. Columns besides those of documents are
passed on unchanged, whatever their names, by all stages but the last, which drops them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netledger.llm import bpe, decontaminate, neardup, quality, secrets
from netledger.llm.common import table
from netledger.llm.queries import vocabulary
from netledger.session import work_path


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def guarded(stage: Stage) -> Stage:
    """A stage that other columns pass under names no operator uses."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = {c: f"_other{k}" for k, c in enumerate(docs.columns) if c not in COLUMNS}
        return stage(spark, docs.withColumnsRenamed(others), sf_dir).withColumnsRenamed({p: c for c, p in others.items()})

    return run


@guarded
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality(docs).filter("kept").select(docs.columns)


@guarded
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(docs, size=5, percent=80, keep=docs.columns).filter("kept").select(docs.columns)


@guarded
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hits = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return hits.filter(~decontaminate.contaminated()).select(docs.columns)


@guarded
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and n_chars with the token ids (packed int32), their number, and digests of the round trip."""
    return bpe.round_trip(docs, vocabulary(), keep=[c for c in docs.columns if c in COLUMNS and c != "text"], with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("bpe_encoding", encoding),
]

#: Language references, sketches and vocabularies are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
