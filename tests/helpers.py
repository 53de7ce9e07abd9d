"""Small hand-written flows and dimensions."""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql.types import StructType

from netledger.plans.settlement import Dimensions

FAR = Decimal("99999999.00")


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(),
          "boolean": pa.bool_()}


def frame(spark, rows, ddl: str):
    """A local relation (no Python worker) from rows and a DDL schema."""
    schema = StructType.fromDDL(ddl)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrays = []
    for field, values in zip(schema, columns):
        kind = field.dataType.simpleString()
        arrow = (pa.decimal128(field.dataType.precision, field.dataType.scale)
                 if kind.startswith("decimal") else _ARROW[kind])
        arrays.append(pa.array(list(values), arrow))
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema)


def dec(text: str) -> Decimal:
    return Decimal(text)


def normal_rows(spark, rows):
    """Rows as dicts over defaults that pass the trade filter."""
    base = dict(id="1", msg_type="0200", proc_code="00", ser_concode="00", resp_code="00", tran_stat="1",
                mid="M1", tid="T1", txn_amt=dec("100.00"), rsv4="", arrival=0)
    schema = ("id string, msg_type string, proc_code string, ser_concode string, resp_code string, "
              "tran_stat string, mid string, tid string, txn_amt decimal(14,2), rsv4 string, arrival int")
    return frame(spark, [tuple({**base, **r}.values()) for r in rows], schema)


def incre_rows(spark, rows):
    """Rows as dicts over defaults that pass the trade filter."""
    base = dict(plt_ssn="1", trans_cd_pay="02S221X0", pay_st="0", trans_st_rsvl="0", trans_st="0",
                rout_inst_id_cd="0", prod_style="51A2", rsvd6=0, mchnt_id_pay="M1", term_id_pay="T1",
                trans_amt=dec("10000.00"), rsvd1="", arrival=0)
    schema = ("plt_ssn string, trans_cd_pay string, pay_st string, trans_st_rsvl string, trans_st string, "
              "rout_inst_id_cd string, prod_style string, rsvd6 int, mchnt_id_pay string, "
              "term_id_pay string, trans_amt decimal(14,2), rsvd1 string, arrival int")
    return frame(spark, [tuple({**base, **r}.values()) for r in rows], schema)


def codes(spark, rows=(("0200|00|00", "0", -1),)):
    return frame(spark, list(rows), "txn_key string, sett_flg string, dc_flg int")


def groups(spark, rows=()):
    return frame(spark, list(rows), "item string, group_id string")


def mappings(spark, rows=()):
    """Rows of (map_id, type_id, src_item, map_result)."""
    full = [("48020000", "20170724", *r) for r in rows]
    return frame(spark, full, "inst_id string, bat_date string, map_id string, type_id string, "
                                       "src_item string, map_result string")


def fees(spark, rows=(("M1", 1, "1", "10", "1.0", "0", "-1", "99999999"),)):
    """Rows of (mer_no, apptype, main, type, rate, amount, min, max) with decimals as text."""
    full = [(r[0], r[1], r[2], r[3], *[dec(x) for x in r[4:]]) for r in rows]
    return frame(spark, full, "mer_no string, apptype_id int, mapp_main string, "
                                       "credit_calc_type string, credit_calc_rate decimal(15,5), "
                                       "credit_calc_amt decimal(14,2), credit_min_amt decimal(14,2), "
                                       "credit_max_amt decimal(14,2)")


def dimensions(spark, codes_=None, groups_=(), mappings_=(), fees_=None):
    return Dimensions(codes=codes(spark) if codes_ is None else codes(spark, codes_),
                      groups=groups(spark, groups_), mappings=mappings(spark, mappings_),
                      fees=fees(spark) if fees_ is None else fees(spark, fees_))
