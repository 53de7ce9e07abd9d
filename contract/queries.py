"""The registered queries: each reads whole tables and returns a lazy DataFrame."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import files
from contract import fixtures as fx
from netledger import schemas
from netledger.functions import money
from netledger.functions.sqlfunctions import register, square
from netledger.functions.text import decode_list, describe
from netledger.operators import cells, filters, lookups, parse, pointreads
from netledger.operators.dedup import latest, top_one
from netledger.operators.joins import JoinPolicy, lookup
from netledger.operators.totals import merge_maps
from netledger.plans import export, load, settlement, sides
from netledger.plans.settlement import INCRE, NORMAL
from netledger.session import gbk_session, large_writes, work_path
from netledger.sinks import levels, tables
from netledger.sinks import messages as message_sinks
from netledger.sinks.store import KeyedStore
from netledger.sources import dimensions, flowfiles, messages
from netledger.sources.lines import read_lines, write_lines
from netledger.streaming.jobs import LatestStream, SettlementStream, running_totals, running_totals_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# No broadcast at all and small parts: the same results by divided exchanges.
DIVIDED = JoinPolicy(broadcast_bytes=0, rows_per_part=2_000)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def as_double(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(28,6)").cast("double")


def _money_out(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison across engines."""
    return df.select(*[as_double(f.name).alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
                       for f in df.schema.fields])


# Filters and rules

@query
def normal_filter(spark, folder):
    flow = fx.normal_flow(spark, folder).filter(filters.normal_trade())
    return _money_out(flow.select("id", "proc_code", "resp_code", "tran_stat", "txn_amt"))


@query
def incre_filter(spark, folder):
    flow = fx.incre_flow(spark, folder).filter(filters.incre_trade())
    return _money_out(flow.select("plt_ssn", "trans_cd_pay", "rsvd6", "trans_amt"))


@query
def trade_rules(spark, folder):
    """The INCRE trade filter as rules that flag instead of dropping."""
    return filters.flag_by_rules(fx.incre_flow(spark, folder), filters.INCRE_RULES).select(
        "plt_ssn", "trans_cd_pay", "filter_flag")


RULES = ["proc_code NOT IN ('01', '02')", "tran_stat = '4' AND resp_code <> '00'"]


@query
def rule_flags(spark, folder):
    return filters.flag_by_rules(fx.normal_flow(spark, folder), RULES).select(
        "id", "proc_code", "resp_code", "filter_flag")


@query
def flagged_rows(spark, folder):
    flagged = filters.flag_by_rules(fx.normal_flow(spark, folder), RULES)
    return _money_out(filters.keep_flagged(flagged).select("id", "mid", "txn_amt"))


@query
def cleared_trades(spark, folder):
    flow = fx.normal_flow(spark, folder).withColumn("txn_key", NORMAL.txn_key())
    return filters.keep_cleared(lookup(flow, fx.txn_codes(spark, folder), ["txn_key"])).select(
        "id", "txn_key", "sett_flg")


# Deduplication and lookups

@query
def flow_dedup(spark, folder):
    return _money_out(latest(fx.normal_flow(spark, folder), NORMAL.dedup_keys).drop("arrival"))


def _lookup(spark, folder, job, *names):
    """A keyed flow and the means to join the named sides to it."""
    flow = fx.normal_flow(spark, folder) if job is NORMAL else fx.incre_flow(spark, folder)
    tables_ = settlement.Lookups(fx.dimensions(spark, folder), job, names=names)
    return settlement.lookup_keys(flow, job), settlement.Attacher(tables_, flow)


@query
def txn_code_lookup(spark, folder):
    return settlement.with_code(*_lookup(spark, folder, NORMAL, "codes")).select(
        "id", "txn_key", "filter_flag", "dc_flag")


@query
def txn_code_lookup_incre(spark, folder):
    return settlement.with_code(*_lookup(spark, folder, INCRE, "codes")).select(
        "plt_ssn", "txn_key", "filter_flag", "dc_flag")


@query
def group_concat_lookup(spark, folder):
    return settlement.with_groups(*_lookup(spark, folder, NORMAL, "groups")).select(
        "id", "mid", "group_id", "in_store_group")


@query
def terminal_mapping(spark, folder):
    return settlement.with_terminal(*_lookup(spark, folder, NORMAL, "terminals")).select(
        "id", "mid", "tid", "map_result_from_terminal")


@query
def store_mapping_normal(spark, folder):
    flow, attacher = _lookup(spark, folder, NORMAL, "groups", "stores")
    return settlement.with_store(settlement.with_groups(flow, attacher), attacher).select(
        "id", "mid", "store_no", "map_result_from_rsv")


@query
def store_mapping_incre(spark, folder):
    return settlement.with_store(*_lookup(spark, folder, INCRE, "stores")).select(
        "plt_ssn", "store_no", "map_result_from_rsv")


def _resolved(flow, spark, folder, job):
    tables_ = settlement.Lookups(fx.dimensions(spark, folder), job)
    return settlement.enrich(flow, tables_).select(job.row_key, job.merchant, "mer_no")


@query
def merchant_resolution(spark, folder):
    return _resolved(fx.normal_flow(spark, folder), spark, folder, NORMAL)


@query
def merchant_resolution_incre(spark, folder):
    return _resolved(fx.incre_flow(spark, folder), spark, folder, INCRE)


@query
def fee_profile_top1(spark, folder):
    return _money_out(lookups.best_profile(fx.fees(spark, folder)))


@query
def first_match_lookup(spark, folder):
    maps = fx.mappings(spark, folder)
    return lookups.first_mapping(maps, lookups.TERMINAL_TYPE, "src_item", "map_result")


@query
def like_lookup(spark, folder):
    flow = fx.normal_flow(spark, folder).select(
        "id", F.when(F.length("msg_type") >= 3, F.substring("msg_type", 2, 2)).alias("msg_part"),
        F.when(F.length("proc_code") >= 2, F.substring("proc_code", 1, 2)).alias("proc_part"),
        F.col("ser_concode").alias("ser_part"))
    path = work_path(spark, "patterns")  # written, so that it is not computed once to be measured and again to be joined
    lookups.first_like(flow, fx.txn_codes(spark, folder)).write.parquet(path)
    return lookup(flow, spark.read.parquet(path), ["msg_part", "proc_part", "ser_part"]).select(
        "id", "msg_part", "proc_part", "ser_part", "txn_key")


@query
def exists_lookup(spark, folder):
    flow = fx.normal_flow(spark, folder).withColumn("mer_no", F.col("mid"))
    return _money_out(pointreads.has_match(flow, fx.fees(spark, folder), ["mer_no"]).select(
        "id", "mer_no", "txn_amt"))


@query
def key_delete(spark, folder):
    flow = fx.normal_flow(spark, folder).withColumn("mer_no", F.col("mid"))
    return _money_out(cells.delete_keys(flow, fx.fees(spark, folder), "mer_no").select(
        "id", "mer_no", "txn_amt"))


# Fees

def _fees(spark, folder, divisor, unbounded=False):
    flow = fx.normal_flow(spark, folder).withColumn("mer_no", F.col("mid"))
    fees = fx.fees(spark, folder)
    raw = money.raw_fee(F.col("txn_amt"), F.col("credit_calc_type"), F.col("credit_calc_rate"),
                        F.col("credit_calc_amt"), divisor)
    fee = money.clamp(raw, F.col("credit_min_amt"), F.col("credit_max_amt"), unbounded)
    return lookup(flow, lookups.best_profile(fees), ["mer_no"], bound=fees).select(
        "id", "mid", as_double("txn_amt").alias("txn_amt"),
        as_double(F.coalesce(fee, F.lit(0))).alias("fee"),
        money.is_supported(F.col("credit_calc_type")).alias("supported"))


@query
def fee_calc(spark, folder):
    return _fees(spark, folder, 100)


@query
def fee_calc_unscaled(spark, folder):
    return _fees(spark, folder, 1)


@query
def fee_calc_open_cap(spark, folder):
    return _fees(spark, folder, 100, unbounded=True)


# Settlement

def _settled(spark, folder, job, policy=JoinPolicy(), together=False):
    flow = fx.normal_flow(spark, folder) if job is NORMAL else fx.incre_flow(spark, folder)
    return settlement.settle(flow, fx.dimensions(spark, folder), job, policy, together=together)


def _layout(job):
    return schemas.NORMAL_DETAIL if job is NORMAL else schemas.INCRE_DETAIL


@query
def normal_settlement(spark, folder):
    return _money_out(settlement.summary(_settled(spark, folder, NORMAL)))


@query
def incre_settlement(spark, folder):
    return _money_out(settlement.summary(_settled(spark, folder, INCRE)))


@query
def normal_settlement_divided(spark, folder):
    return _money_out(settlement.summary(_settled(spark, folder, NORMAL, DIVIDED)))


@query
def incre_settlement_divided(spark, folder):
    return _money_out(settlement.summary(_settled(spark, folder, INCRE, DIVIDED)))


@query
def normal_detail(spark, folder):
    return _money_out(settlement.detail(_settled(spark, folder, NORMAL), _layout(NORMAL)))


@query
def incre_detail(spark, folder):
    return _money_out(settlement.detail(_settled(spark, folder, INCRE), _layout(INCRE)))


@query
def normal_specifics(spark, folder):
    detail = settlement.detail(_settled(spark, folder, NORMAL), _layout(NORMAL))
    return tables.specifics(detail, "id", schemas.NORMAL_VIEW)


@query
def incremental_specifics(spark, folder):
    detail = settlement.detail(_settled(spark, folder, INCRE), _layout(INCRE))
    return tables.specifics(detail, "pltSsn", schemas.INCRE_VIEW)


@query
def normal_rejects(spark, folder):
    return settlement.rejects(_settled(spark, folder, NORMAL), NORMAL)


@query
def incre_rejects(spark, folder):
    return settlement.rejects(_settled(spark, folder, INCRE), INCRE)


@query
def export_lines(spark, folder):
    path = work_path(spark, "export")
    export.export_summary(settlement.summary(_settled(spark, folder, NORMAL)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def keyed_upsert(spark, folder):
    """Three batches (by return flag) written as detail; the newest batch wins."""
    path = work_path(spark, "detail")
    flow = fx.normal_flow(spark, folder)
    for batch_id, resp in enumerate(("00", "05", "10")):
        batch = latest(flow.filter(F.col("resp_code") == resp), NORMAL.dedup_keys).drop("arrival")
        tables.write_batch(batch, path, batch_id)
    return _money_out(tables.read_latest(spark, path, "id").select("id", "mid", "resp_code", "txn_amt"))


@query
def record_text(spark, folder):
    """``name:value`` text of all fields of each record."""
    flow = fx.normal_flow(spark, folder)
    return flow.select("id", describe(list(schemas.NORMAL_KEYS.values())).alias("text"))


@query
def map_merge(spark, folder):
    events = fx.table(spark, folder, "events").withColumn("value", F.col("value").cast("decimal(14,2)"))
    return _money_out(merge_maps(events, "user_id", "value", "total"))


# Point reads

@query
def point_read(spark, folder):
    return pointreads.read_cell(fx.table(spark, folder, "customer"), "c_custkey", 7, "c_mktsegment")


@query
def point_read_absent(spark, folder):
    return pointreads.read_cell(fx.table(spark, folder, "customer"), "c_custkey", -1, "c_mktsegment")


@query
def cell_exists(spark, folder):
    return pointreads.cell_exists(fx.table(spark, folder, "customer"), "c_custkey", 7, "c_name")


@query
def key_get(spark, folder):
    return pointreads.get_rows(fx.table(spark, folder, "supplier"), "s_suppkey", 3)


@query
def cast_predicate(spark, folder):
    return _money_out(pointreads.where_number(fx.fees(spark, folder), "mapp_main", ">", 0))


@query
def dynamic_lookup(spark, folder):
    return pointreads.first_value(fx.mappings(spark, folder), "map_result",
                                  pointreads.condition("src_item", "=", "000000000000004,00000004"))


@query
def dynamic_lookup_two(spark, folder):
    return pointreads.first_value(fx.table(spark, folder, "customer"), "c_name",
                                  pointreads.condition("c_nationkey", "=", 3),
                                  pointreads.condition("c_mktsegment", "like", "B%"))


@query
def dynamic_lookup_type(spark, folder):
    return pointreads.first_value_of_type(fx.mappings(spark, folder), "src_item", "1082",
                                          pointreads.condition("map_result", "=", "R5"))


@query
def ranked_lookup(spark, folder):
    order = [lookups.main_profile_rank().asc(), lookups.apptype_rank().asc_nulls_first(),
             F.col("apptype_id").asc()]
    return pointreads.first_ranked(fx.fees(spark, folder), "credit_calc_type", order,
                                   pointreads.condition("mer_no", "=", "000000000000005"))


@query
def wide_from_cells(spark, folder):
    events = fx.table(spark, folder, "events").withColumn(
        "value", F.when(F.col("event_id") % 5 != 0, F.col("value").cast("decimal(14,2)").cast("string")))
    return cells.wide_rows(events, "user_id", "event_type", "value", "event_id",
                           ["click", "view", "purchase", "signup", "error"])


# Messages

def _edge_messages(spark, folder):
    """NORMAL messages with blank, null, broken and unknown parts by line number."""
    flow = fx.normal_flow(spark, folder)
    line = F.col("proc_code")
    text = parse.message_text(schemas.NORMAL_KEYS)
    amount = F.concat(F.lit('"TXN_AMT":"'), F.col("txn_amt").cast("string"), F.lit('"'))
    return flow.select(
        (F.when(line == "01", F.replace(text, amount, F.lit('"TXN_AMT":""')))
         .when(line == "02", F.replace(text, amount, F.lit('"TXN_AMT":"null"')))
         .when(line == "03", F.replace(text, amount, F.lit('"TXN_AMT":"1x"')))
         .when(line == "04", F.substr(text, F.lit(1), F.length(text) - 5))
         .when(line == "05", F.replace(text, F.lit('"ID":'), F.lit('"NO_ID":')))
         .when(line == "06", F.replace(text, F.lit('{"ID"'), F.lit('{"EXTRA":"y","ID"')))
         .otherwise(F.replace(text, F.lit('"RSV4":"short"'), F.lit('"RSV4":"null"')))).alias("value"))


@query
def json_parse(spark, folder):
    return _money_out(parse.usable(parse.read_normal(_edge_messages(spark, folder))))


@query
def json_quarantine(spark, folder):
    bad = parse.quarantined(parse.read_normal(_edge_messages(spark, folder)))
    return bad.groupBy("problem").agg(F.count(F.lit(1)).alias("messages"))


@query
def json_parse_incre(spark, folder):
    text = fx.incre_flow(spark, folder).select(parse.message_text(schemas.INCRE_KEYS).alias("value"))
    return _money_out(parse.usable(parse.read_incre(text)))


@query
def json_serialize(spark, folder):
    return fx.normal_flow(spark, folder).select(parse.message_text(schemas.NORMAL_KEYS).alias("value"))


@query
def props_parse(spark, folder):
    parsed = fx.table(spark, folder, "events").withColumn("p", F.from_json("props", "k STRING"))
    return parsed.select("event_id", F.coalesce(F.col("p.k").try_cast("int"), F.lit(0)).alias("k"))


@query
def decode_fn(spark, folder):
    events = fx.table(spark, folder, "events")
    ranks = [str(n) for pair in lookups.APPTYPE_RANK for n in pair]
    by_list = decode_list(F.concat((F.col("user_id") % 90).cast("string"), F.lit("," + ",".join(ranks))))
    return events.select("event_id", by_list.alias("with_last"),
                         decode_list(F.concat((F.col("user_id") % 3).cast("string"),
                                              F.lit(",1,10,1,11,2,20,9"))).alias("last_wins"),
                         F.expr(f"decode(CAST(user_id % 90 AS INT), {', '.join(ranks)})").cast("int").alias("plain"))


@query
def sql_functions(spark, folder):
    register(spark)
    events = fx.table(spark, folder, "events").withColumn("u", F.col("user_id").cast("int"))
    return events.select("event_id", F.expr("sqr(u)").alias("squared"),
                         F.expr("decode_list(concat(cast(u % 3 AS STRING), ',1,5,2,6,0'))").alias("decoded"))


@query
def square_fn(spark, folder):
    return fx.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", square(F.col("l_linenumber")).alias("squared"))


@query
def union_flows(spark, folder):
    normal = fx.normal_flow(spark, folder).select(
        "id", F.col("mid").alias("merchant"), F.col("tid").alias("terminal"), F.col("txn_amt").alias("amount"))
    incre = fx.incre_flow(spark, folder).select(
        F.col("plt_ssn").alias("id"), F.col("mchnt_id_pay").alias("merchant"),
        F.col("term_id_pay").alias("terminal"),
        money.to_yuan(F.col("trans_amt")).cast("decimal(14,2)").alias("amount"))
    return _money_out(messages.union(normal, incre))


# Streams

#: Messages in one compressed file; a flow of fewer than six times as many is dealt to six files.
FILE_ROWS = 250_000


def _message_files(spark, folder, job, batches: int = 3) -> tuple[str, int]:
    """The whole flow, with its repeated keys, as compressed JSON text files; returns the folder and files per batch.

    All rows of a key are in one file, so batches of files deduplicate as the whole does; messages carry their order.
    The number of files grows with the table, that of batches does not.
    """
    name, flow_of = ("lineitem", fx.normal_flow) if job is NORMAL else ("orders", fx.incre_flow)
    flow = flow_of(spark, folder, max(6, -(-fx.table(spark, folder, name).count() // FILE_ROWS)))
    path = work_path(spark, "messages")
    text = _positioned(flow) if job is NORMAL else parse.message_text(schemas.INCRE_KEYS).alias("value")
    with large_writes(spark):
        flow.select(text).write.text(path, compression="gzip")
    return path, max(1, -(-len(spark.read.text(path).inputFiles()) // batches))


def _streamed(spark, folder, job):
    path, per_batch = _message_files(spark, folder, job)
    stream = SettlementStream(job, lambda s: fx.dimensions(s, folder), work_path(spark, "run"))
    try:
        stream.start(messages.file_stream(spark, path, per_batch), once=True).awaitTermination()
    finally:
        stream.close()
    return _money_out(stream.totals(spark))


@query
def stream_equals_batch(spark, folder):
    return _streamed(spark, folder, NORMAL)


@query
def stream_equals_batch_incre(spark, folder):
    return _streamed(spark, folder, INCRE)


# Too little memory for most sides, enough for the rows of heavy keys.
STORED = JoinPolicy(broadcast_bytes=16 << 10, rows_per_part=500)


@query
def stream_stored_sides(spark, folder):
    """The stream over stored lookup sides: micro-batches are joined with their buckets, heavy keys and rows without a key are scattered."""
    path, per_batch = _message_files(spark, folder, NORMAL)
    target = work_path(spark, "sides")
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))  # a micro-batch is joined in as many tasks
    sides.write_sides(fx.dimensions(spark, folder), target, buckets)
    stream = SettlementStream(NORMAL, lambda s: sides.open_sides(s, None, target), work_path(spark, "run"), policy=STORED,
                              version=lambda s: sides.sides_version(s, target))
    try:
        stream.start(messages.file_stream(spark, path, per_batch), once=True).awaitTermination()
    finally:
        stream.close()
    return _money_out(stream.totals(spark))


@query
def stream_restarted(spark, folder):
    """A stream with its interval and a sixth of the files a batch, stopped in the middle and started again: the totals are those of one run."""
    path, per_batch = _message_files(spark, folder, NORMAL, batches=6)
    stream = SettlementStream(NORMAL, lambda s: fx.dimensions(s, folder), work_path(spark, "run"))
    try:
        running = stream.start(messages.file_stream(spark, path, per_batch))
        while running.isActive and len(stream.committed(spark)) < 2:
            time.sleep(0.1)
        running.stop()
        stream.start(messages.file_stream(spark, path, per_batch), once=True).awaitTermination()
    finally:
        stream.close()
    return _money_out(stream.totals(spark))


def _kept_totals(spark, totals):
    """Runs a stream of running totals over what is there; the newest total of each merchant."""
    out, checkpoint = work_path(spark, "state"), work_path(spark, "checkpoint")
    (totals.writeStream.outputMode("update").trigger(availableNow=True)
     .option("checkpointLocation", checkpoint)
     .foreachBatch(lambda batch, batch_id: tables.write_batch(batch, out, batch_id) and None)
     .start().awaitTermination())
    return _money_out(tables.read_latest(spark, out, "mer_no"))


@query
def stream_running_totals(spark, folder):
    path, per_batch = _message_files(spark, folder, NORMAL)
    return _kept_totals(spark, running_totals(messages.file_stream(spark, path, per_batch), fx.dimensions(spark, folder), NORMAL))


@query
def stream_running_totals_divided(spark, folder):
    """Totals in the state store over the last message of each key, with no dimension of broadcast size.

    All messages reach the first stream, which deduplicates each micro-batch; the second looks up, prices and adds.
    """
    path, per_batch = _message_files(spark, folder, NORMAL)
    first = LatestStream(NORMAL, work_path(spark, "latest"))
    first.start(messages.file_stream(spark, path, per_batch), once=True).awaitTermination()
    files_ = len(spark.read.parquet(first.records_path).inputFiles())
    records = first.records(spark, max(1, -(-files_ // 3)))
    return _kept_totals(spark, running_totals_of(records, fx.dimensions(spark, folder), NORMAL, DIVIDED))


@query
def stream_with_duplicates(spark, folder):
    """The whole flow, with its repeated ids, in three batches by response code."""
    flow = fx.normal_flow(spark, folder)
    path, run = work_path(spark, "messages"), work_path(spark, "run")
    stream = SettlementStream(NORMAL, lambda s: fx.dimensions(s, folder), run, fan_out=3)
    try:
        for code in ("00", "05", "10"):
            part = flow.filter(F.col("resp_code") == code)
            (part.select(_positioned(part)).write.mode("append").option("maxRecordsPerFile", FILE_ROWS)
             .text(path, compression="gzip"))
            stream.start(messages.file_stream(spark, path), once=True).awaitTermination()
    finally:
        stream.close()
    return _money_out(stream.totals(spark))


def _positioned(flow: DataFrame) -> Column:
    """Messages that carry the flow's own order as their line positions."""
    place = F.struct(
        F.concat_ws("/", F.col("arrival.l_shipdate").cast("string"),
                    F.lpad((F.col("arrival.l_extendedprice") * 100).cast("decimal(18,0)").cast("string"), 18, "0")).alias("path"),
        F.col("arrival.l_partkey").cast("long").alias("block"),
        (F.col("arrival.l_suppkey") * 1000 + F.col("arrival.l_quantity")).cast("long").alias("row"))
    return F.to_json(F.struct(*[F.col(name).cast("string").alias(key) for key, name in schemas.NORMAL_KEYS.items()],
                              place.alias(schemas.POSITION))).alias("value")


# Stores and jobs

@query
def incre_keyed_upsert(spark, folder):
    """A keyed view whose batches hold a key once per terminal: the newest batch, then the last arrival wins."""
    li = fx.table(spark, folder, "lineitem")
    flow = li.select(F.col("l_orderkey").alias("plt_ssn"), F.col("l_suppkey").alias("mchnt_id_pay"),
                     F.col("l_linenumber").alias("term_id_pay"), F.col("l_quantity").cast("double").alias("qty"), "l_returnflag",
                     F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("arrival"))
    path = work_path(spark, "keyed")
    for batch_id, flag in enumerate(("A", "N", "R")):
        batch = latest(flow.filter(F.col("l_returnflag") == flag), INCRE.dedup_keys)
        tables.write_batch(batch.drop("l_returnflag"), path, batch_id)
    compacted = work_path(spark, "compacted")
    tables.compact_latest(spark, path, "plt_ssn", compacted)
    return tables.read_latest(spark, compacted, "plt_ssn")


def _store(spark, label: str, key: str, buckets: int = 8) -> KeyedStore:
    return KeyedStore(spark, work_path(spark, label), key, buckets)


@query
def cell_upsert(spark, folder):
    """Three puts of other columns of the orders: what a put does not name stays, NULL is empty text, a row may lack cells."""
    orders = fx.table(spark, folder, "orders")
    key, store = F.col("o_orderkey"), _store(spark, "cells", "o_orderkey")
    store.put_cells(orders.filter(key % 3 != 0).select("o_orderkey", F.col("o_orderstatus").alias("status"),
                                                       F.col("o_orderpriority").alias("priority")), 0)
    store.put_cells(orders.filter(key % 2 == 0).select("o_orderkey", F.when(key % 4 != 0, F.concat(F.lit("c"), "o_custkey")).alias("status")), 1)
    store.put_cells(orders.filter(key % 5 == 0).select("o_orderkey", F.col("o_custkey").alias("customer")), 2)
    return store.view(["status", "priority", "customer"])


@query
def store_delete(spark, folder):
    """Puts, a deletion, puts, with a compaction in between: deleted keys are gone until a later put revives them."""
    customer = fx.table(spark, folder, "customer")
    key, store = F.col("c_custkey"), _store(spark, "deleted", "c_custkey")
    store.put_cells(customer.select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), 0)
    store.delete(customer.filter(key % 3 == 0), 1)
    store.compact()
    store.delete(customer.filter(key % 7 == 0), 2)
    store.put_cells(customer.filter(key % 2 == 0).select("c_custkey", F.col("c_nationkey").alias("nation")), 3)
    return store.view(["name", "segment", "nation"])


@query
def store_upsert_compacted(spark, folder):
    """The detail by batches of response codes, some buckets compacted after the first batch, all after the second."""
    flow = fx.normal_flow(spark, folder)
    store = _store(spark, "detail", "id")
    for batch_id, (resp, buckets) in enumerate((("00", [0, 3, 5]), ("05", None), ("10", []))):
        rows = latest(flow.filter(F.col("resp_code") == resp), NORMAL.dedup_keys)
        store.put_rows(rows.select("id", "mid", "resp_code", "txn_amt", "arrival"), batch_id, "arrival")
        if buckets != []:
            store.compact(buckets)
    store.vacuum()
    return _money_out(store.view(["mid", "resp_code", "txn_amt"]))


@query
def store_point_read(spark, folder):
    """One cell, one absent cell and two existence tests in a store of all order lines."""
    lines = fx.table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_extendedprice").cast("decimal(14,2)").cast("string").alias("price"), F.max("l_returnflag").alias("mode"))
    store = _store(spark, "points", "l_orderkey", 32)
    store.put_rows(lines.select("l_orderkey", "price"), 0)
    store.compact()
    store.put_cells(lines.filter(F.col("l_orderkey") % 2 == 0).select("l_orderkey", "mode"), 1)
    cells_ = [store.read_cell(4, "price"), store.read_cell(4, "mode"), store.read_cell(-1, "price")]
    found = [store.cell_exists(4, "mode"), store.cell_exists(5, "mode")]
    rows = [c.select(F.lit(k).alias("place"), "value") for k, c in enumerate(cells_)]
    rows += [f.select(F.lit(len(cells_) + k).alias("place"), F.col("found").cast("string").alias("value")) for k, f in enumerate(found)]
    return reduce(DataFrame.unionByName, rows)


@query
def store_sql_view(spark, folder):
    """The settled detail in a store, read in another session through the view of the catalog."""
    detail = settlement.detail(_settled(spark, folder, NORMAL, together=True), _layout(NORMAL))
    store = _store(spark, "views", "id")
    store.put_rows(detail, 0, once=True)  # deduplicated by id
    store.compact()
    tables.create_lasting_views(spark, normal=store)
    return spark.newSession().table("normal_specifics")


@query
def stream_levels(spark, folder):
    """Totals of 40 batches of suppliers' lines, rolled up under way; equal to the sum over all lines."""
    lines = fx.table(spark, folder, "lineitem").select(
        fx.merchant_id(F.col("l_suppkey")).alias("mer_no"), F.col("l_extendedprice").cast("decimal(14,2)").alias("total"),
        (F.col("l_orderkey") % 40).cast("int").alias("batch"))
    path, sums = work_path(spark, "totals"), work_path(spark, "sums")
    merge_maps(lines.withColumn("key", F.struct("mer_no", "batch")), "key", "total", "total").select(
        "key.*", "total").repartition("batch").write.partitionBy("batch").parquet(sums)
    schema = spark.read.parquet(sums).select("mer_no", "total").schema
    for batch in range(40):
        levels.write(spark.read.schema(schema).parquet(f"{sums}/batch={batch}"), path, batch)
        levels.roll(spark, path, batch, list(range(batch + 1)), schema)
    return _money_out(levels.read(spark, path, list(range(40)), schema))


@query
def dimension_upsert(spark, folder):
    """Two loads with keys in common: the second adds some and replaces others."""
    supplier = fx.table(gbk_session(spark), folder, "supplier")
    key = F.col("s_suppkey")
    target = work_path(spark, "dimensions")
    for keep, rate in ((key % 3 != 0, "1.5"), (key % 2 == 0, "2.5")):
        path = work_path(spark, "fees")
        write_lines(supplier.filter(keep).select(F.concat_ws(
            "|", fx.merchant_id(key), F.lit("1"), F.lit("1"), F.lit("10"), F.lit(rate), F.lit("0"), F.lit("0"), F.lit("9"))), path)
        load.load_dimensions(spark, {"fees": path}, target)
    stored = load.open_version(spark, target, "fees", load.published(spark, target, "fees"))
    return stored.select("mer_no", F.col("credit_calc_rate").cast("double").alias("rate"))


@query
def amount_limits(spark, folder):
    """Amounts with too many decimals or digits are set aside with the reason, never rounded."""
    line = F.col("l_linenumber")
    amount = (F.when(line == 1, F.concat(F.col("l_partkey").cast("string"), F.lit(".239")))
              .when(line == 2, F.concat(F.lit("9999999"), F.lpad(F.col("l_partkey").cast("string"), 8, "0"), F.lit(".00")))
              .when(line == 3, F.lit("1,5")).when(line == 4, F.concat(F.col("l_partkey").cast("string"), F.lit(".5000")))
              .otherwise(F.col("l_partkey").cast("string")))
    raw = fx.table(spark, folder, "lineitem").select(F.to_json(F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ID"), amount.alias("TXN_AMT"))).alias("value"))
    parsed = parse.read_normal(raw)
    return parsed.groupBy(F.coalesce("problem", F.lit("")).alias("problem")).agg(
        F.count(F.lit(1)).alias("messages"), F.sum("txn_amt").cast("double").alias("amount"))


@query
def ingest_rejects(spark, folder):
    """Every line of a file gives a message or a reject; short lines keep their text."""
    li = fx.table(gbk_session(spark), folder, "lineitem")
    line = F.concat_ws("|", F.col("l_orderkey").cast("string"), *[F.lit("")] * 67, F.lit("end"))
    short = F.concat_ws("|", F.lit("short"), F.col("l_orderkey").cast("string"))
    path = work_path(spark, "lines")
    write_lines(li.select(F.when(F.col("l_linenumber") == 2, short).otherwise(line)), path)
    good, bad = load.ingest(spark, "normal", path)
    ids = good.select(F.get_json_object("value", "$.ID").alias("text"), F.lit("message").alias("kind"))
    rows = ids.unionByName(bad.select(F.col("line").alias("text"), F.col("problem").alias("kind")))
    return rows.groupBy("kind", "text").agg(F.count(F.lit(1)).alias("lines"))


@query
def multi_file_flow(spark, folder):
    """A comma list of files with blank entries; a blank list reads nothing."""
    first, second = files.normal_file(spark, folder), files.normal_file(spark, folder)
    lines = read_lines(spark, f" {first}, ,{second},")
    none = read_lines(spark, " , ")
    fields = flowfiles.delimited_fields(lines.unionByName(none))
    return fields.groupBy(F.col("MID").alias("mid")).agg(F.count(F.lit(1)).alias("lines"))


@query
def single_cell_write(spark, folder):
    """One cell put over a wide table of the events; the other cells stay."""
    events = fx.table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("user_id"), "event_type", F.col("event_id").cast("string").alias("value"), "event_id")
    cell = cells.one_cell(spark, "user_id", "7", "click", None)
    put = cell.select("user_id", F.lit("click").alias("event_type"), F.col("click").alias("value"),
                      F.lit(1 << 40).alias("event_id"))
    return cells.wide_rows(events.unionByName(put), "user_id", "event_type", "value", "event_id", ["click", "view"])


@query
def cell_maps(spark, folder):
    """Wide rows whose column names are not given: one map per key, here as text."""
    events = fx.table(spark, folder, "events").withColumn("value", F.col("event_id").cast("string"))
    wide = cells.wide_rows(events, "user_id", "event_type", "value", "event_id")
    entries = F.transform(F.array_sort(F.map_entries("cells")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return wide.select("user_id", F.array_join(entries, ",").alias("cells"))


@query
def table_if_absent(spark, folder):
    """Creating a table a second time leaves its rows."""
    name, path = f"regions_{uuid.uuid4().hex}", work_path(spark, "table")
    tables.create_if_absent(spark, name, "r_regionkey BIGINT, r_name STRING", path)
    fx.table(spark, folder, "nation").select(F.col("n_regionkey").cast("long").alias("r_regionkey"),
                                             F.col("n_name").alias("r_name")).write.insertInto(name)
    tables.create_if_absent(spark, name, "r_regionkey BIGINT, r_name STRING", path)
    return spark.table(name)


@query
def message_key_shape(spark, folder):
    """Keyed messages for a topic: its name and the time of sending in milliseconds."""
    text = fx.normal_flow(spark, folder).select(parse.message_text(schemas.NORMAL_KEYS).alias("value"))
    keyed = message_sinks.keyed(text, "flow")
    return keyed.select("value", F.col("key").rlike(r"^flow_[0-9]{13}$").alias("key_fits"))


# Files

@query
def delimited_load(spark, folder):
    return _money_out(dimensions.read_dimension(spark, "fees", files.fee_file(spark, folder)))


@query
def mapping_load(spark, folder):
    return dimensions.read_dimension(spark, "mappings", files.mapping_file(spark, folder)).select(
        "map_id", "type_id", "src_item", "map_result", "rcd_ver", "upd_datetime")


@query
def variable_arity_load(spark, folder):
    return dimensions.read_dimension(spark, "codes", files.code_file(spark, folder))


@query
def delimited_flow(spark, folder):
    fields = flowfiles.delimited_fields(read_lines(spark, files.normal_file(spark, folder)))
    return fields.select(*[F.col(k).alias(v) for k, v in schemas.NORMAL_KEYS.items()])


@query
def gbk_fixed_width(spark, folder):
    fields = flowfiles.fixed_width_fields(read_lines(spark, files.incre_file(spark, folder)))
    return fields.select(*[F.col(k).alias(v) for k, v in schemas.INCRE_KEYS.items()])


@query
def file_to_settlement(spark, folder):
    """Fixed-width file to messages to records to totals, end to end."""
    found = flowfiles.incre_messages(spark, files.incre_file(spark, folder))
    records = parse.usable(parse.read_incre(found, positioned=True))
    return _money_out(settlement.summary(settlement.settle(records, fx.dimensions(
        records.sparkSession, folder), INCRE)))
