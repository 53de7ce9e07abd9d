"""Flow and dimension files written from the test tables, for the ingest queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import fixtures as fx
from netledger import schemas
from netledger.session import gbk_session, work_path
from netledger.sources.lines import write_lines

SHOP = "商户"
PURCHASE = "消费"
#: Lines in one compressed file.
FILE_ROWS = 500_000


def _write(lines: DataFrame, spark: SparkSession, label: str) -> str:
    path = work_path(spark, label)
    write_lines(lines, path, file_rows=FILE_ROWS)
    return path


def fee_file(spark: SparkSession, folder: str) -> str:
    """Fee profiles; every 50th supplier's rate is no number."""
    fees = fx.fees(gbk_session(spark), folder)
    rate = F.when(F.col("mer_no").cast("long") % 50 == 0, "n/a").otherwise(
        F.col("credit_calc_rate").cast("string"))
    return _write(fees.select(F.concat(F.concat_ws(
        "|", "mer_no", F.col("apptype_id").cast("string"), F.concat(F.lit(SHOP), F.col("mapp_main")),
        "credit_calc_type", rate, F.col("credit_calc_amt").cast("string"),
        F.col("credit_min_amt").cast("string"), F.col("credit_max_amt").cast("string")),
        F.lit("|"))), spark, "fees")


def mapping_file(spark: SparkSession, folder: str) -> str:
    """Mappings in table order; the second line of a key replaces the first."""
    maps = fx.mappings(gbk_session(spark), folder)
    lines = F.array(*[F.concat(F.concat_ws(
        "|", "inst_id", "bat_date", "map_id", "type_id", "src_item", F.concat(F.col("map_result"), F.lit(tail)),
        F.lit("19900101"), F.lit("99999999"), F.lit(version), F.lit("20131018153535"), F.lit("loader  ")),
        F.lit("|||")) for tail, version in (("old", "0"), ("new", "1"))])
    return _write(maps.select(F.explode(lines)), spark, "mappings")


def code_file(spark: SparkSession, folder: str) -> str:
    """Transaction codes from ``part``: keys of one, three or four pieces."""
    part = fx.table(gbk_session(spark), folder, "part")
    key = F.col("p_partkey")
    text = key.cast("string")
    txn_key = (F.when(key % 3 == 0, F.concat(F.lit("K"), text))
               .when(key % 3 == 1, F.concat(F.lit("0200|01|"), text))
               .otherwise(F.concat(F.lit("a|b|c|"), text)))
    lines = F.array(*[F.concat(F.concat_ws(
        "|", txn_key, F.lpad((key % 1000).cast("string"), 3, "0"), F.concat(F.lit(PURCHASE), F.col("p_name")),
        F.lit("B001"), F.lit(flag), ((key % 3).cast("int") - 1).cast("string"), F.lit(""),
        F.col("p_size").cast("string"), F.lit("20140819141406"), F.lit("loader")),
        F.lit("|||")) for flag in ("0", "5")])
    return _write(part.select(F.explode(lines)), spark, "codes")


def normal_file(spark: SparkSession, folder: str) -> str:
    """NORMAL flow as pipe separated lines of 70 pieces."""
    flow = fx.normal_flow(gbk_session(spark), folder)
    by_position = {position: schemas.NORMAL_KEYS[key] for key, position in schemas.NORMAL_POSITIONS.items()}
    parts: list[Column] = []
    for i in range(70):
        if i in by_position:
            parts.append(F.concat(F.lit(" "), F.col(by_position[i]).cast("string"), F.lit(" ")))
        else:
            parts.append(F.lit(SHOP if i == 3 else ""))
    return _write(flow.select(F.concat_ws("|", *parts)), spark, "normal")


def incre_file(spark: SparkSession, folder: str) -> str:
    """INCRE flow as fixed-width lines, with multi-byte text before most fields."""
    flow = fx.incre_flow(gbk_session(spark), folder)
    at, parts = 0, []
    fields = sorted([(b, e, F.col(schemas.INCRE_KEYS[key]).cast("string"))
                     for key, (b, e) in schemas.INCRE_BYTES.items()] + [(41, 45, None)], key=lambda f: f[0])
    for begin, end, column in fields:
        parts.append(F.lit(" " * (begin - at)))
        parts.append(F.lit(SHOP) if column is None else F.rpad(column, end - begin, " "))
        at = end
    return _write(flow.select(F.concat(*parts)), spark, "incre")
