"""Record shapes: JSON keys, file positions, column types and defaults."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)
WIDE = T.DecimalType(38, 18)
RATE = T.DecimalType(15, 5)

# JSON key -> column of a NORMAL message.
NORMAL_KEYS = {
    "ID": "id",
    "MSG_TYPE": "msg_type",
    "PROC_CODE": "proc_code",
    "SER_CONCODE": "ser_concode",
    "TXN_AMT": "txn_amt",
    "TID": "tid",
    "MID": "mid",
    "TRAN_STATUS": "tran_stat",
    "RESP_CODE": "resp_code",
    "RSV4": "rsv4",
}

# JSON key -> column of an INCRE message.
INCRE_KEYS = {
    "PLT_SSN": "plt_ssn",
    "TRANS_ST": "trans_st",
    "TRANS_ST_RSVL": "trans_st_rsvl",
    "PROD_STYLE": "prod_style",
    "ROUT_INST_ID_CD": "rout_inst_id_cd",
    "MCHNT_ID_PAY": "mchnt_id_pay",
    "TERM_ID_PAY": "term_id_pay",
    "TRANS_CD_PAY": "trans_cd_pay",
    "PAY_ST": "pay_st",
    "TRANS_AMT": "trans_amt",
    "RSVD1": "rsvd1",
    "RSVD6": "rsvd6",
}

# Columns that are numbers; every other message column is a string.
NUMERIC = {"txn_amt": MONEY, "trans_amt": MONEY, "rsvd6": T.IntegerType()}

# 0-based piece of a delimited NORMAL line -> JSON key.
NORMAL_POSITIONS = {
    "ID": 0,
    "MSG_TYPE": 4,
    "PROC_CODE": 5,
    "SER_CONCODE": 7,
    "TXN_AMT": 25,
    "TID": 33,
    "MID": 34,
    "TRAN_STATUS": 42,
    "RESP_CODE": 61,
    "RSV4": 68,
}

# Half-open GBK byte range of a fixed-width INCRE line.
INCRE_BYTES = {
    "PLT_SSN": (0, 12),
    "TRANS_ST": (212, 213),
    "TRANS_ST_RSVL": (216, 217),
    "PROD_STYLE": (381, 385),
    "ROUT_INST_ID_CD": (1307, 1332),
    "MCHNT_ID_PAY": (1381, 1396),
    "TERM_ID_PAY": (1397, 1415),
    "TRANS_CD_PAY": (1447, 1455),
    "PAY_ST": (1499, 1500),
    "TRANS_AMT": (1657, 1669),
    "RSVD1": (2175, 2239),
    "RSVD6": (2367, 2379),
}

# Columns of the dimension files in file order, with their types.
FEE_COLUMNS = {
    "mer_no": "string",
    "apptype_id": "int",
    "mapp_main": "string",
    "credit_calc_type": "string",
    "credit_calc_rate": "decimal(15,5)",
    "credit_calc_amt": "decimal(14,2)",
    "credit_min_amt": "decimal(14,2)",
    "credit_max_amt": "decimal(14,2)",
}
CODE_COLUMNS = {
    "txn_key": "string",
    "txn_code": "string",
    "txn_des": "string",
    "bms_txn_code": "string",
    "sett_flg": "string",
    "dc_flg": "int",
    "txn_code_grp": "string",
    "rcd_ver": "int",
    "add_datetime": "string",
    "add_user_id": "string",
    "upd_datetime": "string",
    "upd_user_id": "string",
}
GROUP_COLUMNS = {
    "inst_id": "string",
    "bat_date": "string",
    "group_id": "string",
    "group_type_id": "string",
    "item": "string",
    "become_effective_date": "string",
    "lost_effective_date": "string",
    "rcd_ver": "int",
    "add_datetime": "string",
    "add_user_id": "string",
    "upd_datetime": "string",
    "upd_user_id": "string",
}
MAPPING_COLUMNS = {
    "inst_id": "string",
    "bat_date": "string",
    "map_id": "string",
    "type_id": "string",
    "src_item": "string",
    "map_result": "string",
    "become_effective_date": "string",
    "lost_effective_date": "string",
    "rcd_ver": "int",
    "add_datetime": "string",
    "add_user_id": "string",
    "upd_datetime": "string",
    "upd_user_id": "string",
}

# A dimension line is stored under the text of these columns run together.
LOADER_KEYS = {
    "fees": ["mer_no", "apptype_id"],
    "codes": ["txn_key"],
    "groups": ["inst_id", "bat_date", "group_id", "group_type_id", "item"],
    "mappings": ["inst_id", "bat_date", "map_id", "type_id", "src_item"],
}
DIMENSION_COLUMNS = {
    "fees": FEE_COLUMNS,
    "codes": CODE_COLUMNS,
    "groups": GROUP_COLUMNS,
    "mappings": MAPPING_COLUMNS,
}

# Stored detail column -> column of the settled flow, in write order;
# fee and net are added.
NORMAL_DETAIL = {
    "id": "id",
    "mId": "mid",
    "tId": "tid",
    "txnAmt": "txn_amt",
    "exchange": "exchange",
    "procCode": "proc_code",
    "respCode": "resp_code",
    "tranStat": "tran_stat",
    "serConcode": "ser_concode",
    "msgType": "msg_type",
    "filterFlag": "filter_flag",
    "RSV4": "rsv4",
    "dcFlag": "dc_flag",
    "merNo": "mer_no",
    "groupId": "group_id",
    "storeNo": "store_no",
    "mapResultFromTerminal": "map_result_from_terminal",
    "mapResultFromRSV": "map_result_from_rsv",
    "noBmsStlInfo": "no_fee_profile",
    "supportedCreditCalcType": "supported_calc_type",
    "fee": "fee",
    "net": "net",
}
INCRE_DETAIL = {
    "pltSsn": "plt_ssn",
    "mchntIdPay": "mchnt_id_pay",
    "transCdPay": "trans_cd_pay",
    "paySt": "pay_st",
    "transStRsvl": "trans_st_rsvl",
    "routInstIdCd": "rout_inst_id_cd",
    "transSt": "trans_st",
    "termIdPay": "term_id_pay",
    "filterFlag": "filter_flag",
    "prodStyle": "prod_style",
    "dRsvd6": "rsvd6",
    "transAmt": "trans_amt",
    "exchange": "exchange",
    "dcFlag": "dc_flag",
    "merNo": "mer_no",
    "groupId": "group_id",
    "storeNo": "store_no",
    "mapResultFromTerminal": "map_result_from_terminal",
    "mapResultFromRSV": "map_result_from_rsv",
    "noBmsStlInfo": "no_fee_profile",
    "supportedCreditCalcType": "supported_calc_type",
    "fee": "fee",
    "net": "net",
}
# Columns of the SQL views over the detail store, in view order.
NORMAL_VIEW = [
    "mId", "tId", "txnAmt", "exchange", "procCode", "respCode", "tranStat",
    "serConcode", "msgType", "filterFlag", "RSV4", "dcFlag", "merNo", "groupId",
    "storeNo", "mapResultFromTerminal", "mapResultFromRSV",
]
INCRE_VIEW = [
    "mchntIdPay", "transCdPay", "paySt", "transStRsvl", "routInstIdCd", "transSt",
    "termIdPay", "filterFlag", "prodStyle", "dRsvd6", "transAmt", "exchange",
    "dcFlag", "merNo", "groupId", "storeNo", "mapResultFromTerminal",
    "mapResultFromRSV",
]


# Where an ingested line stood: an extra key of its message, so that later jobs know the order of a file's lines.
POSITION = "_position"
POSITION_TYPE = "struct<path: string, block: bigint, row: bigint>"


def message_schema(keys: dict[str, str]) -> T.StructType:
    """All-string JSON schema, the line's position, and the raw text of messages that do not parse."""
    fields = [T.StructField(key, T.StringType()) for key in keys]
    place = T.StructType([T.StructField("path", T.StringType()), T.StructField("block", T.LongType()),
                          T.StructField("row", T.LongType())])
    return T.StructType(fields + [T.StructField(POSITION, place), T.StructField("_broken", T.StringType())])
