"""Parquet tables written once per batch.

Every batch owns the folder ``batch_id=N``. Writing a batch again replaces that
folder, so a replayed batch leaves one copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netledger import schemas
from netledger.operators.dedup import top_one
from netledger.sinks.store import KeyedStore


def write_batch(df: DataFrame, path: str, batch_id: int) -> str:
    target = f"{path}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(target)
    return target


def drop(spark: SparkSession, path: str) -> None:
    """Remove a table's folder from whatever store holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def read_batches(spark: SparkSession, path: str, committed: str | None = None) -> DataFrame:
    """All batches, or those that are marked below ``committed``."""
    rows = spark.read.parquet(path)
    if committed is None:
        return rows
    return rows.join(spark.read.parquet(committed).select("batch_id"), "batch_id", "left_semi")


def read_latest(spark: SparkSession, path: str, key: str, committed: str | None = None) -> DataFrame:
    """Keyed view: the newest batch that holds a key supplies its row.

    A batch can hold a key more than once where rows are deduplicated by more than the key. Then the last arrival
    wins (column ``arrival``, if the table has one), and rows of one arrival are ordered by their values.
    """
    return _newest(read_batches(spark, path, committed), key).drop("batch_id", "arrival")


def _newest(rows: DataFrame, key: str) -> DataFrame:
    arrival = [F.col("arrival").desc()] if "arrival" in rows.columns else []
    others = [c for c in rows.columns if c not in (key, "batch_id", "arrival")]
    return top_one(rows, [key], [F.col("batch_id").desc(), *arrival, F.xxhash64(*others).asc() if others else F.col(key)])


def compact_latest(spark: SparkSession, path: str, key: str, target: str) -> None:
    """Rewrite the keyed view as one batch at ``target`` (while no job writes)."""
    last = read_batches(spark, path).agg(F.max("batch_id")).first()[0]
    write_batch(_newest(read_batches(spark, path), key).drop("batch_id"), target, last)


def create_if_absent(spark: SparkSession, name: str, schema: str, path: str | None = None) -> None:
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{location}")


def specifics(detail: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The detail as text columns under the names of the SQL views."""
    renamed = {"exchange": "exchanges"}
    return detail.select(F.col(key).alias("merNo_terNo_time"), *[
        F.col(c).cast("string").alias(renamed.get(c, c)) for c in columns])


def create_lasting_views(spark: SparkSession, normal: KeyedStore | None = None, incre: KeyedStore | None = None) -> None:
    """The two views in the catalog, over the published bases of the stores: other sessions open them by name.

    Rows committed after the last compaction are not in them; call again after a compaction.
    """
    for store, name, columns in ((normal, "normal_specifics", schemas.NORMAL_VIEW), (incre, "incremental_specifics", schemas.INCRE_VIEW)):
        if store is not None:
            texts = {"merNo_terNo_time": f"`{store.key}`"}
            texts |= {"exchanges" if c == "exchange" else c: f"CAST(`{c}` AS STRING)" for c in columns}
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {store.base_sql(texts)}")


def create_views(spark: SparkSession, normal: DataFrame | None = None,
                 incre: DataFrame | None = None) -> None:
    """``normal_specifics`` and ``incremental_specifics`` for ``spark.sql``."""
    if normal is not None:
        specifics(normal, "id", schemas.NORMAL_VIEW).createOrReplaceTempView("normal_specifics")
    if incre is not None:
        specifics(incre, "pltSsn", schemas.INCRE_VIEW).createOrReplaceTempView("incremental_specifics")
