"""Payment flows and dimensions derived from the TPC-H-like test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netledger.plans.settlement import Dimensions


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files once per process."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def merchant_id(key: Column) -> Column:
    return F.lpad(key.cast("string"), 15, "0")


def _digits(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def normal_flow(spark: SparkSession, folder: str, parts: int | None = None) -> DataFrame:
    """The NORMAL flow; with ``parts`` its rows are dealt to so many by their id (the table's rows, which are narrower)."""
    li = table(spark, folder, "lineitem")
    part = F.col("l_partkey")
    id_ = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    if parts:
        li = li.repartition(parts, id_)
    return li.select(
        id_.alias("id"),
        F.when(part % 2 == 0, "0200").otherwise("0400").alias("msg_type"),
        _digits(F.col("l_linenumber"), 2).alias("proc_code"),
        _digits(part % 3, 2).alias("ser_concode"),
        F.when(F.col("l_returnflag") == "R", "00").when(F.col("l_returnflag") == "A", "05")
        .otherwise("10").alias("resp_code"),
        F.when(F.col("l_linestatus") == "O", "1").otherwise("4").alias("tran_stat"),
        merchant_id(F.col("l_suppkey")).alias("mid"),
        _digits(part % 20, 8).alias("tid"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("txn_amt"),
        F.when(part % 5 != 0, F.concat(F.lit("x" * 20), _digits(part % 10, 4)))
        .otherwise("short").alias("rsv4"),
        F.struct("l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity").alias("arrival"))


def incre_flow(spark: SparkSession, folder: str, parts: int | None = None) -> DataFrame:
    """The INCRE flow; with ``parts`` its rows are dealt to so many by ``plt_ssn``."""
    orders = table(spark, folder, "orders")
    merchants = table(spark, folder, "supplier").agg(F.count(F.lit(1))).scalar()
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    if parts:
        orders = orders.repartition(parts, _digits(key, 12))
    codes = F.array(*[F.lit(c) for c in ("02S221X1", "02V523X1", "07S30609", "02S221X0", "02V523X0",
                                         "02R222X0", "99Z")])
    return orders.select(
        _digits(key, 12).alias("plt_ssn"),
        F.element_at(codes, (key % 7 + 1).cast("int")).alias("trans_cd_pay"),
        F.when(cust % 4 != 0, "0").otherwise("1").alias("pay_st"),
        F.when(F.col("o_orderpriority") != "5-LOW", "0").otherwise("1").alias("trans_st_rsvl"),
        F.when(F.col("o_orderstatus") != "P", "0").otherwise("1").alias("trans_st"),
        F.when(cust % 3 != 0, "3748020000").otherwise("0").alias("rout_inst_id_cd"),
        F.when(cust % 11 != 10, "51A2").otherwise("51B2").alias("prod_style"),
        F.when(F.floor(key / 7) % 2 == 0, 1001).otherwise(1002).alias("rsvd6"),
        merchant_id(cust % merchants).alias("mchnt_id_pay"),
        _digits(cust % 20, 8).alias("term_id_pay"),
        (F.col("o_totalprice").cast("decimal(14,2)") * 100).cast("decimal(14,2)").alias("trans_amt"),
        F.when(key % 5 == 0, F.concat(F.lit("SML0000"), F.rpad(
            F.concat(F.lit("S"), (cust % 10).cast("string")), 43, " "))).otherwise("").alias("rsvd1"),
        F.struct("o_orderdate", "o_orderkey").alias("arrival"))


def txn_codes(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    procs = nation.filter("n_nationkey < 7").select((F.col("n_nationkey") + 1).alias("proc"))
    combos = (procs.select("proc", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("ser"))
              .select("proc", "ser", F.explode(F.array(F.lit("0200"), F.lit("0400"))).alias("msg"))
              .filter(~((F.col("proc") == 7) & (F.col("ser") == 2))))
    flags = F.array(*[F.lit(f) for f in "3E071W5"])
    normal = combos.select(
        F.concat_ws("|", "msg", _digits(F.col("proc"), 2), _digits(F.col("ser"), 2)).alias("txn_key"),
        F.element_at(flags, F.col("proc")).alias("sett_flg"),
        F.when((F.col("proc") == 6) & (F.col("ser") == 1), 0)
        .when(F.col("msg") == "0200", -1).otherwise(1).alias("dc_flg"))
    rows = F.array(*[F.struct(F.lit(k).alias("txn_key"), F.lit(s).alias("sett_flg"), F.lit(d).alias("dc_flg"))
                     for k, s, d in (("02S221X1", "1", -1), ("02V523X1", "1", -1), ("02S221X0", "0", 1),
                                     ("02V523X0", "0", 1), ("07S30609", "5", -1))])
    incre = (nation.filter("n_nationkey < 5")
             .select(F.element_at(rows, F.col("n_nationkey") + 1).alias("r")).select("r.*"))
    return normal.unionByName(incre)


def groups(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier")
    ids = F.array_compact(F.array(F.when(F.col("s_suppkey") % 2 == 0, "APL"),
                                  F.concat(F.lit("G"), F.col("s_nationkey").cast("string"))))
    return supplier.select(merchant_id(F.col("s_suppkey")).alias("item"), F.explode(ids).alias("group_id"))


def mappings(spark: SparkSession, folder: str) -> DataFrame:
    """Terminal and store rules; every rule has a later, never chosen, duplicate."""
    supplier = table(spark, folder, "supplier")
    key, n = F.col("s_suppkey"), F.col("n")
    terminal = (supplier.select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("n"))
                .filter((key + n) % 4 == 0)
                .select(F.lit("1").alias("type_id"),
                        F.concat_ws(",", merchant_id(key), _digits(n, 8)).alias("src_item"),
                        F.when(n == 8, "").otherwise(
                            F.concat(F.lit("T"), (key % 13).cast("string"))).alias("map_result")))
    store = (supplier.select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("n"))
             .filter((key + n) % 3 == 0)
             .select(F.lit("1082").alias("type_id"),
                     F.concat_ws(",", merchant_id(key), _digits(n, 4)).alias("src_item"),
                     F.concat(F.lit("R"), (key % 7).cast("string")).alias("map_result")))
    shops = (table(spark, folder, "nation").filter("n_nationkey < 7")
             .select(F.lit("1068").alias("type_id"),
                     F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("src_item"),
                     F.concat(F.lit("M"), F.col("n_nationkey").cast("string")).alias("map_result")))
    first = terminal.unionByName(store).unionByName(shops)
    return (first.withColumn("again", F.explode(F.array(F.lit(False), F.lit(True))))
            .select(F.lit("48020000").alias("inst_id"), F.lit("20170724").alias("bat_date"),
                    F.when(F.col("again"), "200000").otherwise("100000").alias("map_id"),
                    "type_id", "src_item",
                    F.when(F.col("again"), "LATER").otherwise(F.col("map_result")).alias("map_result")))


def fees(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier")
    s, r = F.col("s_suppkey"), F.col("r")
    kind = (s + r) % 4
    rows = (supplier.filter(s % 10 != 9)
            .select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("r")))
    return rows.select(
        merchant_id(s).alias("mer_no"),
        F.element_at(F.array(F.lit(1), F.lit(86), F.lit(9), F.lit(40)), r + 1).alias("apptype_id"),
        F.when((s + r) % 3 == 0, "1").otherwise("u").alias("mapp_main"),
        F.when(kind == 0, "11").when(kind == 3, "00").otherwise("10").alias("credit_calc_type"),
        ((r * 20 + 38).cast("decimal(15,5)") * F.lit("0.01").cast("decimal(3,2)"))
        .cast("decimal(15,5)").alias("credit_calc_rate"),
        (r + 2).cast("decimal(14,2)").alias("credit_calc_amt"),
        F.lit(-1).cast("decimal(14,2)").alias("credit_min_amt"),
        F.when(s % 6 == 0, -1).when(s % 6 == 1, 25).otherwise(99999999).cast("decimal(14,2)")
        .alias("credit_max_amt"))


def dimensions(spark: SparkSession, folder: str) -> Dimensions:
    return Dimensions(codes=txn_codes(spark, folder), groups=groups(spark, folder),
                      mappings=mappings(spark, folder), fees=fees(spark, folder))
