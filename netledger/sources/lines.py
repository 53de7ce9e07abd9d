"""GBK text files as one line per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netledger.session import gbk_session

# Read (and write) a whole line as one column: no quoting, nothing stripped.
ONE_COLUMN = {
    "sep": "\u0001",
    "quote": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def split_paths(paths: str | list[str]) -> list[str]:
    """A comma separated list (or a list) of paths; blank means nothing to read."""
    parts = paths.split(",") if isinstance(paths, str) else list(paths)
    return [p.strip() for p in parts if p.strip()]


def read_lines(spark: SparkSession, paths: str | list[str], charset: str = "GBK") -> DataFrame:
    """Columns ``line`` and ``position``; position orders lines as they stand in a file."""
    session = gbk_session(spark)
    files = split_paths(paths)
    if not files:
        return session.createDataFrame(
            [], "line string, position struct<path: string, block: bigint, row: bigint>")
    lines = (session.read.schema("line string").options(**ONE_COLUMN)
             .option("encoding", charset).csv(files))
    # Rows of one block are read in order, so the running id orders them within it.
    return lines.select("line", F.struct(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")).alias("position"))


def write_lines(lines: DataFrame, path: str, charset: str = "GBK", file_rows: int | None = None) -> None:
    """Write the single string column of ``lines`` as text in ``charset``.

    ``lines`` has to belong to a GBK-capable session when ``charset`` is GBK. With ``file_rows`` the files are compressed, which
    readers see by their names, and hold so many lines at most, as a compressed file is read by one task.
    """
    writer = (lines.write.mode("overwrite").options(**ONE_COLUMN).option("escapeQuotes", "false")
              .option("emptyValue", "").option("encoding", charset))
    if file_rows:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", file_rows)
    writer.csv(path)
