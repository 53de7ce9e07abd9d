"""Trade filters, rule flags and settlement guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netledger.functions.money import CLEARED

# A NORMAL trade is left out only if all three match.
EXCLUDED_PROC = ["01", "02"]
EXCLUDED_RESP = ["00", "10", "11", "16", "A2", "A4", "A5", "A6", "Y1", "Y3"]
EXCLUDED_STAT = ["1", "2", "3"]

# Codes of the INCRE whitelist.
ROUTED_CODES = ["02S221X1", "02V523X1", "07S30609"]
ROUTE = "3748020000"
PRODUCT = "51A2"
PLAIN_CODES = ["02S221X0", "02V523X0", "02R222X0"]
SPLIT_CODE = "07S30609"
ROUTED_KIND = 1001
PLAIN_KIND = 1002


# The two trade filters as rule text, for ``flag_by_rules``.
NORMAL_RULES = [
    "proc_code NOT IN ('01', '02')",
    "resp_code NOT IN ('00', '10', '11', '16', 'A2', 'A4', 'A5', 'A6', 'Y1', 'Y3')",
    "tran_stat NOT IN ('1', '2', '3')",
]
_SUCCEEDED = "pay_st = '0' AND trans_st_rsvl = '0' AND trans_st = '0' AND prod_style = '51A2'"
INCRE_RULES = [
    f"{_SUCCEEDED} AND trans_cd_pay IN ('02S221X1', '02V523X1', '07S30609') "
    "AND rout_inst_id_cd = '3748020000' AND rsvd6 = 1001",
    f"{_SUCCEEDED} AND trans_cd_pay IN ('02S221X0', '02V523X0', '02R222X0')",
    f"{_SUCCEEDED} AND trans_cd_pay = '07S30609' AND rsvd6 = 1002",
]


def normal_trade() -> Column:
    return (~F.col("proc_code").isin(EXCLUDED_PROC)
            | ~F.col("resp_code").isin(EXCLUDED_RESP)
            | ~F.col("tran_stat").isin(EXCLUDED_STAT))


def incre_trade() -> Column:
    succeeded = ((F.col("pay_st") == "0") & (F.col("trans_st_rsvl") == "0")
                 & (F.col("trans_st") == "0") & (F.col("prod_style") == PRODUCT))
    code = F.col("trans_cd_pay")
    routed = (code.isin(ROUTED_CODES) & (F.col("rout_inst_id_cd") == ROUTE)
              & (F.col("rsvd6") == ROUTED_KIND))
    plain = code.isin(PLAIN_CODES) | ((code == SPLIT_CODE) & (F.col("rsvd6") == PLAIN_KIND))
    return succeeded & (routed | plain)


def flag_by_rules(flow: DataFrame, rules: list[str], flag: str = "filter_flag") -> DataFrame:
    """Set ``flag`` where any of the SQL predicates holds; no row is dropped."""
    hit = F.lit(False)
    for rule in rules:
        hit = hit | F.coalesce(F.expr(rule), F.lit(False))
    return flow.withColumn(flag, hit)


def keep_flagged(flow: DataFrame, flag: str = "filter_flag") -> DataFrame:
    return flow.filter(F.col(flag))


def keep_cleared(flow: DataFrame, column: str = "sett_flg") -> DataFrame:
    """Rows whose settlement flag is one of the cleared ones."""
    return flow.filter(F.col(column).isin(*CLEARED))


def settles() -> Column:
    """Profile found, fee type supported, direction known."""
    return (F.col("eligible") & ~F.col("no_fee_profile") & F.col("supported_calc_type")
            & F.col("dc_flag").isin(1, -1))


def reject_reason() -> Column:
    """Why an eligible row is not settled; NULL when it is."""
    return F.when(F.col("eligible"), F.coalesce(
        F.when(F.col("no_fee_profile"), "no fee profile"),
        F.when(~F.col("supported_calc_type"), "fee type not supported"),
        F.when(~F.col("dc_flag").isin(1, -1), "direction is not 1 or -1")))
