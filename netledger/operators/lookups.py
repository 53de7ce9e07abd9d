"""Dimension tables reduced to one row per lookup key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netledger.functions.money import is_cleared
from netledger.functions.text import contains_item
from netledger.operators.dedup import top_one

# Mapping types and the group that carries a store number.
TERMINAL_TYPE = "1"
NORMAL_STORE_TYPE = "1082"
INCRE_STORE_TYPE = "1068"
STORE_GROUP = "APL"

# Rank of the application types; other types have no rank.
APPTYPE_RANK = [(1, 1), (86, 2), (74, 3), (18, 4), (39, 5), (40, 6), (68, 7)]


def loader_key(names: list[str]) -> Column:
    return F.concat(*[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names])


def codes(txn_codes: DataFrame) -> DataFrame:
    """txn_key -> filter_flag, dc_flag."""
    unique = top_one(txn_codes.select("txn_key", "sett_flg", "dc_flg"), ["txn_key"],
                     [F.col("sett_flg"), F.col("dc_flg")])
    return unique.select("txn_key", is_cleared(F.col("sett_flg")).alias("filter_flag"),
                         F.col("dc_flg").alias("dc_flag"))


def group_lists(groups: DataFrame) -> DataFrame:
    """item -> group_id (all ids joined by a comma, sorted) and in_store_group.

    Equal ids are counted first, so one item's list is built from its distinct ids.
    """
    counted = (groups.select("item", "group_id").groupBy("item", "group_id")
               .agg(F.count(F.lit(1)).cast("int").alias("times")))
    lists = counted.groupBy("item").agg(
        F.array_sort(F.collect_list(F.struct("group_id", "times"))).alias("ids"),
        F.coalesce(F.max(contains_item("group_id", STORE_GROUP)), F.lit(False)).alias("in_store_group"))
    repeated = F.flatten(F.transform("ids", lambda g: F.array_repeat(g["group_id"], g["times"])))
    # An id may itself hold a comma, as its pieces count.
    return lists.select("item", F.array_join(repeated, ",").alias("group_id"), "in_store_group")


def first_mapping(mappings: DataFrame, type_id: str, key_name: str, result_name: str) -> DataFrame:
    """src_item (as ``key_name``) -> first map_result by loader key, for one type."""
    order = [c for c in ("inst_id", "bat_date", "map_id", "type_id", "src_item")
             if c in mappings.columns]
    of_type = mappings.filter(F.col("type_id") == type_id)
    one = top_one(of_type.select(*dict.fromkeys(order + ["src_item", "map_result"])), ["src_item"],
                  [loader_key(order), F.col("map_result")])
    return one.select(F.col("src_item").alias(key_name), F.col("map_result").alias(result_name))


def main_profile_rank() -> Column:
    return F.when(F.trim("mapp_main") == "1", 1).otherwise(2)


def apptype_rank() -> Column:
    """Rank of the application type; NULL for types without one."""
    pairs = ", ".join(f"{value}, {rank}" for value, rank in APPTYPE_RANK)
    return F.expr(f"decode(apptype_id, {pairs})")


def best_profile(fees: DataFrame) -> DataFrame:
    """One fee profile per merchant: main first, then type rank with unranked first."""
    return top_one(fees, ["mer_no"], [
        main_profile_rank().asc(), apptype_rank().asc_nulls_first(), F.col("apptype_id").asc(),
        F.col("credit_calc_type").asc(), F.col("credit_calc_rate").asc(),
        F.col("credit_calc_amt").asc(), F.col("credit_min_amt").asc(), F.col("credit_max_amt").asc()])


def _pieces(text: Column, size: int) -> Column:
    """The distinct pieces of a text that are ``size`` characters long."""
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - (size - 1)), lambda i: F.substring(text, i, F.lit(size))))
    ).otherwise(F.array().cast("array<string>"))


def like_postings(txn_codes: DataFrame) -> DataFrame:
    """(piece, txn_key): every key under its pieces of two characters, of one, and the empty one; as many rows as the key is long."""
    key = F.col("txn_key")
    pieces = F.concat(_pieces(key, 2), _pieces(key, 1), F.array(F.lit("")))
    return txn_codes.select("txn_key").na.drop().distinct().select("txn_key", F.explode(pieces).alias("piece"))


def first_like(patterns: DataFrame, txn_codes: DataFrame) -> DataFrame:
    """(msg_part, proc_part, ser_part) -> first txn_key like ``%msg%proc%ser%`` (as literal text) for each distinct pattern that has one.

    A pattern meets the keys that hold its rarest piece by equality; only those are compared with the whole of it.
    """
    parts = ["msg_part", "proc_part", "ser_part"]
    asked, postings = patterns.select(*parts).na.drop("any").distinct(), like_postings(txn_codes)
    two, one = (F.flatten(F.array(*[_pieces(F.col(c), size) for c in parts])) for size in (2, 1))
    pieces = F.when(F.size(two) > 0, two).when(F.size(one) > 0, one).otherwise(F.array(F.lit("")))
    rarest = (asked.withColumn("piece", F.explode(pieces)).join(postings.groupBy("piece").agg(F.count("*").alias("keys")), "piece", "left")
              .groupBy(*parts).agg(F.min(F.struct(F.coalesce("keys", F.lit(0)).alias("keys"), "piece")).alias("least"))
              .filter("least.keys > 0").select(*parts, F.col("least.piece").alias("piece")))
    rest, fits = F.col("txn_key"), F.lit(True)
    for part in map(F.col, parts):
        fits = fits & (F.instr(rest, part) > 0)
        rest = F.substr(rest, F.instr(rest, part) + F.length(part))
    return rarest.join(postings, "piece").filter(fits).groupBy(*parts).agg(F.min("txn_key").alias("txn_key"))
