"""Dimension load and flow ingest jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netledger import schemas
from netledger.operators.dedup import top_one
from netledger.operators.lookups import loader_key
from netledger.plans.settlement import Dimensions
from netledger.plans.sides import write_sides
from netledger.sinks import publish
from netledger.sources import flowfiles
from netledger.sources.dimensions import keep_last, parse_dimension, read_dimension
from netledger.sources.lines import read_lines


def load_dimensions(spark: SparkSession, files: dict[str, str], target: str) -> None:
    """Put each named dimension file into ``target/<name>``: new keys are added, known ones replaced; bad lines go aside.

    A load writes its rows, merged over those of the version before, into a folder of its own and then claims the next version number
    for it. A load that finds the number taken by another one merges again over that one's rows, so loads at the same time keep the keys
    of both. Readers open the newest version; those that still read an older one keep it. Once all tables are loaded, their lookup
    sides are stored for the streams as well.
    """
    for name, paths in files.items():
        parsed = parse_dimension(read_lines(spark, paths), name)
        load = uuid.uuid4().hex
        bad = parsed.filter(F.col("problem").isNotNull()).select("line", "problem")
        bad.write.mode("overwrite").parquet(f"{target}/quarantine/{name}/load={load}")
        columns = list(schemas.DIMENSION_COLUMNS[name])
        rows = keep_last(parsed, schemas.LOADER_KEYS[name], columns)
        while True:
            current = published(spark, target, name)
            folder = uuid.uuid4().hex
            merged = rows
            if current is not None:
                # The lines' session can read GBK, so they stand on the left.
                both = rows.withColumn("_load", F.lit(1)).unionByName(
                    open_version(spark, target, name, current).withColumn("_load", F.lit(0))).withColumn(
                    "_key", loader_key(schemas.LOADER_KEYS[name]))
                merged = top_one(both, ["_key"], [F.col("_load").desc()]).select(*columns)
            merged.write.parquet(f"{target}/{name}/{folder}")
            if publish.claim(spark, f"{target}/published/{name}", 0 if current is None else current + 1, folder):
                break
            publish.remove(spark, f"{target}/{name}/{folder}")
    if all(published(spark, target, name) is not None for name in schemas.DIMENSION_COLUMNS):
        write_sides(open_dimensions(spark, target), target)


def published(spark: SparkSession, target: str, name: str) -> int | None:
    """The newest version of a table; None before the first load."""
    found = publish.newest(spark, f"{target}/published/{name}")
    return None if found is None else found[0]


def version_of(spark: SparkSession, target: str) -> str:
    """The versions of all tables, from the names of small files: no table is opened."""
    return ",".join(str(published(spark, target, name)) for name in schemas.DIMENSION_COLUMNS)


def open_version(spark: SparkSession, target: str, name: str, version: int) -> DataFrame:
    schema = ", ".join(f"{c} {kind}" for c, kind in schemas.DIMENSION_COLUMNS[name].items())
    folder = publish.get_text(spark, f"{target}/published/{name}/{version:012d}")
    return spark.read.schema(schema).parquet(f"{target}/{name}/{folder}")


def read_dimensions(spark: SparkSession, files: dict[str, str]) -> Dimensions:
    """The four tables straight from their files, by name."""
    return Dimensions(**{name: read_dimension(spark, name, files[name])
                         for name in schemas.DIMENSION_COLUMNS})


def open_dimensions(spark: SparkSession, target: str) -> Dimensions:
    """The loaded tables as last published; call again to see later loads."""
    versions = {name: published(spark, target, name) for name in schemas.DIMENSION_COLUMNS}
    absent = [name for name, version in versions.items() if version is None]
    if absent:
        raise ValueError(f"not loaded into {target}: {', '.join(absent)}")
    return Dimensions(**{name: open_version(spark, target, name, version) for name, version in versions.items()},
                      version=",".join(map(str, versions.values())))


def ingest(spark: SparkSession, flow: str, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Messages of a flow's files, and the lines that gave none with the reason."""
    lines = read_lines(spark, paths)
    if flow == "normal":
        fields, names = flowfiles.delimited_fields(lines), list(schemas.NORMAL_POSITIONS)
    else:
        fields, names = flowfiles.fixed_width_fields(lines), list(schemas.INCRE_BYTES)
    return flowfiles.to_messages(fields, names), flowfiles.bad_lines(fields)


def ingest_normal(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return flowfiles.normal_messages(spark, paths)


def ingest_incre(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return flowfiles.incre_messages(spark, paths)
