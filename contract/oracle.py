"""DuckDB SQL for the registered queries, written from the field definitions."""

from __future__ import annotations


def _double(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(28,6)) AS DOUBLE)"


def _mid(expr: str) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), 15, '0')"


NORMAL = f"""
nf AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
         CASE WHEN l_partkey % 2 = 0 THEN '0200' ELSE '0400' END AS msg_type,
         lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS proc_code,
         lpad(CAST(l_partkey % 3 AS VARCHAR), 2, '0') AS ser_concode,
         CASE l_returnflag WHEN 'R' THEN '00' WHEN 'A' THEN '05' ELSE '10' END AS resp_code,
         CASE WHEN l_linestatus = 'O' THEN '1' ELSE '4' END AS tran_stat,
         {_mid('l_suppkey')} AS mid,
         lpad(CAST(l_partkey % 20 AS VARCHAR), 8, '0') AS tid,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS txn_amt,
         CASE WHEN l_partkey % 5 <> 0 THEN repeat('x', 20) || lpad(CAST(l_partkey % 10 AS VARCHAR), 4, '0')
              ELSE 'short' END AS rsv4,
         l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_quantity
  FROM lineitem),
nd AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY l_shipdate DESC,
    l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM nf) t WHERE rn = 1),
nk AS (
  SELECT * FROM nd WHERE NOT (proc_code IN ('01', '02')
    AND resp_code IN ('00', '10', '11', '16', 'A2', 'A4', 'A5', 'A6', 'Y1', 'Y3')
    AND tran_stat IN ('1', '2', '3')))"""

INCRE = f"""
inf AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS plt_ssn,
         CASE o_orderkey % 7 WHEN 0 THEN '02S221X1' WHEN 1 THEN '02V523X1' WHEN 2 THEN '07S30609'
              WHEN 3 THEN '02S221X0' WHEN 4 THEN '02V523X0' WHEN 5 THEN '02R222X0' ELSE '99Z' END AS trans_cd_pay,
         CASE WHEN o_custkey % 4 <> 0 THEN '0' ELSE '1' END AS pay_st,
         CASE WHEN o_orderpriority <> '5-LOW' THEN '0' ELSE '1' END AS trans_st_rsvl,
         CASE WHEN o_orderstatus <> 'P' THEN '0' ELSE '1' END AS trans_st,
         CASE WHEN o_custkey % 3 <> 0 THEN '3748020000' ELSE '0' END AS rout_inst_id_cd,
         CASE WHEN o_custkey % 11 <> 10 THEN '51A2' ELSE '51B2' END AS prod_style,
         CASE WHEN (o_orderkey // 7) % 2 = 0 THEN 1001 ELSE 1002 END AS rsvd6,
         {_mid('o_custkey % (SELECT count(*) FROM supplier)')} AS mchnt_id_pay,
         lpad(CAST(o_custkey % 20 AS VARCHAR), 8, '0') AS term_id_pay,
         CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 100 AS DECIMAL(14,2)) AS trans_amt,
         CASE WHEN o_orderkey % 5 = 0 THEN 'SML0000' || rpad('S' || CAST(o_custkey % 10 AS VARCHAR), 43, ' ')
              ELSE '' END AS rsvd1
  FROM orders),
ik AS (
  SELECT * FROM inf WHERE trans_st = '0' AND trans_st_rsvl = '0' AND pay_st = '0' AND prod_style = '51A2' AND (
    (trans_cd_pay IN ('02S221X1', '02V523X1', '07S30609') AND rout_inst_id_cd = '3748020000' AND rsvd6 = 1001)
    OR trans_cd_pay IN ('02S221X0', '02V523X0', '02R222X0')
    OR (trans_cd_pay = '07S30609' AND rsvd6 = 1002)))"""

CODES = """
codes AS (
  SELECT m.msg || '|' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') || '|'
           || lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS txn_key,
         substr('3E071W5', CAST(n_nationkey + 1 AS BIGINT), 1) AS sett_flg,
         CASE WHEN n_nationkey = 5 AND r_regionkey = 1 THEN 0 WHEN m.msg = '0200' THEN -1 ELSE 1 END AS dc_flg
  FROM nation, region, (VALUES ('0200'), ('0400')) m(msg)
  WHERE n_nationkey < 7 AND r_regionkey < 3 AND NOT (n_nationkey = 6 AND r_regionkey = 2)
  UNION ALL
  SELECT * FROM (VALUES ('02S221X1', '1', -1), ('02V523X1', '1', -1), ('02S221X0', '0', 1),
                        ('02V523X0', '0', 1), ('07S30609', '5', -1)) v(txn_key, sett_flg, dc_flg))"""

GROUPS = f"""
grp AS (
  SELECT item, string_agg(group_id, ',' ORDER BY group_id) AS group_id, bool_or(group_id = 'APL') AS in_store_group
  FROM (SELECT {_mid('s_suppkey')} AS item, 'APL' AS group_id FROM supplier WHERE s_suppkey % 2 = 0
        UNION ALL
        SELECT {_mid('s_suppkey')}, 'G' || CAST(s_nationkey AS VARCHAR) FROM supplier) g
  GROUP BY item)"""

MAPS = f"""
maps AS (
  SELECT '1' AS type_id, {_mid('s_suppkey')} || ',' || lpad(CAST(n_nationkey AS VARCHAR), 8, '0') AS src_item,
         CASE WHEN n_nationkey = 8 THEN '' ELSE 'T' || CAST(s_suppkey % 13 AS VARCHAR) END AS map_result
  FROM supplier, nation WHERE n_nationkey < 20 AND (s_suppkey + n_nationkey) % 4 = 0
  UNION ALL
  SELECT '1082', {_mid('s_suppkey')} || ',' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0'),
         'R' || CAST(s_suppkey % 7 AS VARCHAR)
  FROM supplier, nation WHERE n_nationkey < 10 AND (s_suppkey + n_nationkey) % 3 = 0
  UNION ALL
  SELECT '1068', 'S' || CAST(n_nationkey AS VARCHAR), 'M' || CAST(n_nationkey AS VARCHAR)
  FROM nation WHERE n_nationkey < 7)"""

FEES = f"""
fees AS (
  SELECT {_mid('s_suppkey')} AS mer_no,
         CASE r_regionkey WHEN 0 THEN 1 WHEN 1 THEN 86 WHEN 2 THEN 9 ELSE 40 END AS apptype_id,
         CASE WHEN (s_suppkey + r_regionkey) % 3 = 0 THEN '1' ELSE 'u' END AS mapp_main,
         CASE (s_suppkey + r_regionkey) % 4 WHEN 0 THEN '11' WHEN 3 THEN '00' ELSE '10' END AS credit_calc_type,
         CAST(CAST(38 + 20 * r_regionkey AS DECIMAL(15,5)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(15,5))
           AS credit_calc_rate,
         CAST(r_regionkey + 2 AS DECIMAL(14,2)) AS credit_calc_amt,
         CAST(-1 AS DECIMAL(14,2)) AS credit_min_amt,
         CAST(CASE s_suppkey % 6 WHEN 0 THEN -1 WHEN 1 THEN 25 ELSE 99999999 END AS DECIMAL(14,2))
           AS credit_max_amt
  FROM supplier, region WHERE s_suppkey % 10 <> 9 AND r_regionkey < 4)"""

_RANKS = """CASE WHEN trim(mapp_main) = '1' THEN 1 ELSE 2 END,
    CASE apptype_id WHEN 1 THEN 1 WHEN 86 THEN 2 WHEN 74 THEN 3 WHEN 18 THEN 4 WHEN 39 THEN 5
                    WHEN 40 THEN 6 WHEN 68 THEN 7 END NULLS FIRST, apptype_id"""

BEST = f"""
best AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY mer_no ORDER BY {_RANKS}) AS rn FROM fees) t WHERE rn = 1)"""

DIMS = ",".join([CODES, GROUPS, MAPS, FEES, BEST])

_CENT = "CAST(0.01 AS DECIMAL(3,2))"


def _raw(amount: str, divisor: int = 100) -> str:
    scaled = f"{amount} * credit_calc_rate" + (f" * {_CENT}" if divisor == 100 else "")
    return (f"CASE credit_calc_type WHEN '10' THEN {scaled} WHEN '11' THEN credit_calc_amt "
            "ELSE CAST(0 AS DECIMAL(14,2)) END")


def _clamped(raw: str, open_cap: bool = False) -> str:
    cap = " AND credit_max_amt >= 0" if open_cap else ""
    return (f"CASE WHEN ({raw}) < credit_min_amt THEN credit_min_amt "
            f"WHEN ({raw}) > credit_max_amt{cap} THEN credit_max_amt ELSE ({raw}) END")


def _coded(source: str, key: str) -> str:
    return (f"SELECT f.*, coalesce(c.sett_flg IN ('1', '2', '3', '4', '5', '6'), false) AS filter_flag, "
            f"coalesce(c.dc_flg, 0) AS dc_flag, {key} AS txn_key "
            f"FROM {source} f LEFT JOIN codes c ON c.txn_key = {key}")


NORMAL_KEY = "f.msg_type || '|' || f.proc_code || '|' || f.ser_concode"
INCRE_KEY = "f.trans_cd_pay"


def _normal_mapped(source: str) -> str:
    return f"""
coded AS ({_coded(source, NORMAL_KEY)}),
grouped AS (
  SELECT f.*, coalesce(g.group_id, '') AS group_id, coalesce(g.in_store_group, false) AS in_store_group,
         coalesce(t.map_result, '') AS map_result_from_terminal
  FROM coded f LEFT JOIN grp g ON g.item = f.mid
  LEFT JOIN maps t ON t.type_id = '1' AND t.src_item = f.mid || ',' || f.tid),
stored AS (
  SELECT *, CASE WHEN in_store_group AND length(rsv4) >= 24 THEN substr(rsv4, 21, 4) ELSE '' END AS store_no
  FROM grouped),
mapped AS (
  SELECT f.*, coalesce(s.map_result, '') AS map_result_from_rsv,
         coalesce(nullif(s.map_result, ''), nullif(f.map_result_from_terminal, ''), f.mid) AS mer_no
  FROM stored f LEFT JOIN maps s ON s.type_id = '1082' AND f.store_no <> ''
    AND s.src_item = f.mid || ',' || f.store_no)"""


def _incre_mapped(source: str) -> str:
    return f"""
coded AS ({_coded(source, INCRE_KEY)}),
grouped AS (
  SELECT f.*, coalesce(g.group_id, '') AS group_id, coalesce(t.map_result, '') AS map_result_from_terminal,
         CASE WHEN f.rsvd1[1:3] = 'SML' THEN trim(substr(f.rsvd1, 8, 43)) ELSE '' END AS store_no
  FROM coded f LEFT JOIN grp g ON g.item = f.mchnt_id_pay
  LEFT JOIN maps t ON t.type_id = '1' AND t.src_item = f.mchnt_id_pay || ',' || f.term_id_pay),
mapped AS (
  SELECT f.*, coalesce(s.map_result, '') AS map_result_from_rsv,
         coalesce(nullif(s.map_result, ''), nullif(f.map_result_from_terminal, ''), f.mchnt_id_pay) AS mer_no
  FROM grouped f LEFT JOIN maps s ON s.type_id = '1068' AND f.store_no <> '' AND s.src_item = f.store_no)"""


def _fee_steps(amount: str, merchant: str, when: str) -> str:
    return f"""
profiled AS (
  SELECT f.*, p.mer_no IS NOT NULL AS found, p.credit_calc_type, p.credit_calc_rate, p.credit_calc_amt,
         p.credit_min_amt, p.credit_max_amt, {amount} AS amount, f.filter_flag = {when} AS eligible
  FROM mapped f LEFT JOIN best p ON p.mer_no = f.{merchant}),
feed AS (
  SELECT *, eligible AND NOT found AS no_fee_profile,
         eligible AND found AND coalesce(credit_calc_type IN ('10', '11'), false) AS supported_calc_type,
         CASE WHEN eligible AND found THEN {_clamped(_raw('amount'))} END AS fee0
  FROM profiled),
done AS (
  SELECT *, coalesce(fee0, 0) AS fee,
         CASE WHEN supported_calc_type AND dc_flag = 1 THEN fee0 - amount
              WHEN supported_calc_type AND dc_flag = -1 THEN amount - fee0 END AS net
  FROM feed)"""


NORMAL_DONE = "WITH " + ",".join([NORMAL, DIMS, _normal_mapped("nk"), _fee_steps("f.txn_amt", "mid", "false")])
INCRE_DONE = "WITH " + ",".join([INCRE, DIMS, _incre_mapped("ik"), _fee_steps(
    f"CAST(f.trans_amt * {_CENT} AS DECIMAL(18,4))", "mchnt_id_pay", "true")])

_TOTALS = f"SELECT mer_no, {_double('sum(net)')} AS total FROM done WHERE net IS NOT NULL GROUP BY mer_no"
NORMAL_TOTALS = f"{NORMAL_DONE} {_TOTALS}"
INCRE_TOTALS = f"{INCRE_DONE} {_TOTALS}"

_REJECTS = """SELECT {key}, CASE WHEN no_fee_profile THEN 'no fee profile'
  WHEN NOT supported_calc_type THEN 'fee type not supported' ELSE 'direction is not 1 or -1' END AS reason
FROM done WHERE eligible AND net IS NULL"""

_NORMAL_FLOW_TEXT = """id, msg_type, proc_code, ser_concode, CAST(txn_amt AS VARCHAR) AS txn_amt, tid, mid,
  tran_stat, resp_code, rsv4"""

_MAPPED_OF_FLOW = "WITH " + ",".join([NORMAL, DIMS, _normal_mapped("nf")])
_MAPPED_OF_INCRE = "WITH " + ",".join([INCRE, DIMS, _incre_mapped("inf")])


def _fee_query(divisor: int, open_cap: bool = False) -> str:
    fee = _clamped(_raw("txn_amt", divisor), open_cap)
    return f"""WITH {NORMAL}, {FEES}, {BEST}
SELECT id, mid, {_double('txn_amt')} AS txn_amt,
       {_double(f'CASE WHEN mer_no IS NULL THEN 0 ELSE {fee} END')} AS fee,
       coalesce(credit_calc_type IN ('10', '11'), false) AS supported
FROM nf LEFT JOIN best ON mer_no = mid"""


def _pivot(event: str) -> str:
    return (f"arg_max(CASE WHEN event_type = '{event}' THEN v END, event_id) "
            f"FILTER (WHERE event_type = '{event}') AS \"{event}\"")


ORACLES: dict[str, str] = {
    "normal_filter": f"""WITH {NORMAL} SELECT id, proc_code, resp_code, tran_stat, {_double('txn_amt')} AS txn_amt
        FROM nf WHERE proc_code NOT IN ('01', '02')
          OR resp_code NOT IN ('00', '10', '11', '16', 'A2', 'A4', 'A5', 'A6', 'Y1', 'Y3')
          OR tran_stat NOT IN ('1', '2', '3')""",
    "incre_filter": f"""WITH {INCRE} SELECT plt_ssn, trans_cd_pay, rsvd6, {_double('trans_amt')} AS trans_amt
        FROM ik""",
    "rule_flags": f"""WITH {NORMAL} SELECT id, proc_code, resp_code, proc_code NOT IN ('01', '02')
        OR (tran_stat = '4' AND resp_code <> '00') AS filter_flag FROM nf""",
    "trade_rules": f"""WITH {INCRE} SELECT plt_ssn, trans_cd_pay,
        plt_ssn IN (SELECT plt_ssn FROM ik) AS filter_flag FROM inf""",
    "flagged_rows": f"""WITH {NORMAL} SELECT id, mid, {_double('txn_amt')} AS txn_amt FROM nf
        WHERE proc_code NOT IN ('01', '02') OR (tran_stat = '4' AND resp_code <> '00')""",
    "cleared_trades": f"""WITH {NORMAL}, {CODES} SELECT id, txn_key, sett_flg FROM nf f
        JOIN codes c ON c.txn_key = {NORMAL_KEY} WHERE sett_flg IN ('1', '2', '3', '4', '5', '6')""",
    "flow_dedup": f"""WITH {NORMAL} SELECT id, msg_type, proc_code, ser_concode, resp_code, tran_stat, mid, tid,
        {_double('txn_amt')} AS txn_amt, rsv4 FROM nd""",
    "txn_code_lookup": f"""WITH {NORMAL}, {CODES}, coded AS ({_coded('nf', NORMAL_KEY)})
        SELECT id, txn_key, filter_flag, dc_flag FROM coded""",
    "txn_code_lookup_incre": f"""WITH {INCRE}, {CODES}, coded AS ({_coded('inf', INCRE_KEY)})
        SELECT plt_ssn, txn_key, filter_flag, dc_flag FROM coded""",
    "group_concat_lookup": f"{_MAPPED_OF_FLOW} SELECT id, mid, group_id, in_store_group FROM mapped",
    "terminal_mapping": f"{_MAPPED_OF_FLOW} SELECT id, mid, tid, map_result_from_terminal FROM mapped",
    "store_mapping_normal": f"{_MAPPED_OF_FLOW} SELECT id, mid, store_no, map_result_from_rsv FROM mapped",
    "store_mapping_incre": f"{_MAPPED_OF_INCRE} SELECT plt_ssn, store_no, map_result_from_rsv FROM mapped",
    "merchant_resolution": f"{_MAPPED_OF_FLOW} SELECT id, mid, mer_no FROM mapped",
    "merchant_resolution_incre": f"{_MAPPED_OF_INCRE} SELECT plt_ssn, mchnt_id_pay, mer_no FROM mapped",
    "fee_profile_top1": f"""WITH {FEES}, {BEST} SELECT mer_no, apptype_id, mapp_main, credit_calc_type,
        {_double('credit_calc_rate')} AS credit_calc_rate, {_double('credit_calc_amt')} AS credit_calc_amt,
        {_double('credit_min_amt')} AS credit_min_amt, {_double('credit_max_amt')} AS credit_max_amt FROM best""",
    "first_match_lookup": f"WITH {MAPS} SELECT src_item, map_result FROM maps WHERE type_id = '1'",
    "like_lookup": f"""WITH {NORMAL}, {CODES}, parts AS (
          SELECT DISTINCT substr(msg_type, 2, 2) AS msg_part, substr(proc_code, 1, 2) AS proc_part,
                 ser_concode AS ser_part FROM nf),
        found AS (SELECT p.*, (SELECT min(c.txn_key) FROM codes c WHERE c.txn_key LIKE
          '%' || p.msg_part || '%' || p.proc_part || '%' || p.ser_part || '%') AS txn_key FROM parts p)
        SELECT f.id, p.msg_part, p.proc_part, p.ser_part, p.txn_key FROM nf f JOIN found p
          ON p.msg_part = substr(f.msg_type, 2, 2) AND p.proc_part = substr(f.proc_code, 1, 2)
          AND p.ser_part = f.ser_concode""",
    "exists_lookup": f"""WITH {NORMAL}, {FEES} SELECT id, mid AS mer_no, {_double('txn_amt')} AS txn_amt FROM nf
        WHERE mid IN (SELECT mer_no FROM fees)""",
    "key_delete": f"""WITH {NORMAL}, {FEES} SELECT id, mid AS mer_no, {_double('txn_amt')} AS txn_amt FROM nf
        WHERE mid NOT IN (SELECT mer_no FROM fees)""",
    "fee_calc": _fee_query(100),
    "fee_calc_unscaled": _fee_query(1),
    "fee_calc_open_cap": _fee_query(100, open_cap=True),
    "normal_settlement": NORMAL_TOTALS,
    "incre_settlement": INCRE_TOTALS,
    "normal_settlement_divided": NORMAL_TOTALS,
    "incre_settlement_divided": INCRE_TOTALS,
    "normal_detail": f"""{NORMAL_DONE} SELECT id, mid AS "mId", tid AS "tId", {_double('txn_amt')} AS "txnAmt",
        CAST(0 AS DOUBLE) AS exchange, proc_code AS "procCode", resp_code AS "respCode", tran_stat AS "tranStat",
        ser_concode AS "serConcode", msg_type AS "msgType", filter_flag AS "filterFlag", rsv4 AS "RSV4",
        dc_flag AS "dcFlag", mer_no AS "merNo", group_id AS "groupId", store_no AS "storeNo",
        map_result_from_terminal AS "mapResultFromTerminal", map_result_from_rsv AS "mapResultFromRSV",
        no_fee_profile AS "noBmsStlInfo", supported_calc_type AS "supportedCreditCalcType",
        {_double('fee')} AS fee, {_double('net')} AS net FROM done""",
    "incre_detail": f"""{INCRE_DONE} SELECT plt_ssn AS "pltSsn", mchnt_id_pay AS "mchntIdPay",
        trans_cd_pay AS "transCdPay", pay_st AS "paySt", trans_st_rsvl AS "transStRsvl",
        rout_inst_id_cd AS "routInstIdCd", trans_st AS "transSt", term_id_pay AS "termIdPay",
        filter_flag AS "filterFlag", prod_style AS "prodStyle", rsvd6 AS "dRsvd6",
        {_double('trans_amt')} AS "transAmt", CAST(0 AS DOUBLE) AS exchange, dc_flag AS "dcFlag",
        mer_no AS "merNo", group_id AS "groupId", store_no AS "storeNo",
        map_result_from_terminal AS "mapResultFromTerminal", map_result_from_rsv AS "mapResultFromRSV",
        no_fee_profile AS "noBmsStlInfo", supported_calc_type AS "supportedCreditCalcType",
        {_double('fee')} AS fee, {_double('net')} AS net FROM done""",
    "normal_specifics": f"""{NORMAL_DONE} SELECT id AS "merNo_terNo_time", mid AS "mId", tid AS "tId",
        CAST(txn_amt AS VARCHAR) AS "txnAmt", '0.0' AS exchanges, proc_code AS "procCode",
        resp_code AS "respCode", tran_stat AS "tranStat", ser_concode AS "serConcode", msg_type AS "msgType",
        CASE WHEN filter_flag THEN 'true' ELSE 'false' END AS "filterFlag", rsv4 AS "RSV4",
        CAST(dc_flag AS VARCHAR) AS "dcFlag", mer_no AS "merNo", group_id AS "groupId", store_no AS "storeNo",
        map_result_from_terminal AS "mapResultFromTerminal", map_result_from_rsv AS "mapResultFromRSV"
        FROM done""",
    "incremental_specifics": f"""{INCRE_DONE} SELECT plt_ssn AS "merNo_terNo_time",
        mchnt_id_pay AS "mchntIdPay", trans_cd_pay AS "transCdPay", pay_st AS "paySt",
        trans_st_rsvl AS "transStRsvl", rout_inst_id_cd AS "routInstIdCd", trans_st AS "transSt",
        term_id_pay AS "termIdPay", CASE WHEN filter_flag THEN 'true' ELSE 'false' END AS "filterFlag",
        prod_style AS "prodStyle", CAST(rsvd6 AS VARCHAR) AS "dRsvd6", CAST(trans_amt AS VARCHAR) AS "transAmt",
        '0.0' AS exchanges, CAST(dc_flag AS VARCHAR) AS "dcFlag", mer_no AS "merNo", group_id AS "groupId",
        store_no AS "storeNo", map_result_from_terminal AS "mapResultFromTerminal",
        map_result_from_rsv AS "mapResultFromRSV" FROM done""",
    "normal_rejects": f"{NORMAL_DONE} {_REJECTS.format(key='id')}",
    "incre_rejects": f"{INCRE_DONE} {_REJECTS.format(key='plt_ssn')}",
    "export_lines": f"""{NORMAL_DONE} SELECT mer_no || ', '
        || regexp_replace(regexp_replace(CAST(sum(net) AS VARCHAR), '([.][0-9]*?)0+$', '\\1'), '[.]$', '') AS line FROM done WHERE net IS NOT NULL GROUP BY mer_no""",
    "keyed_upsert": f"""WITH {NORMAL} SELECT id, mid, resp_code, {_double('txn_amt')} AS txn_amt FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY resp_code DESC, l_shipdate DESC,
          l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM nf) t
        WHERE rn = 1""",
    "record_text": f"""WITH {NORMAL} SELECT id, 'id:' || id || ' msg_type:' || msg_type || ' proc_code:' || proc_code
        || ' ser_concode:' || ser_concode || ' txn_amt:' || CAST(txn_amt AS VARCHAR) || ' tid:' || tid || ' mid:' || mid
        || ' tran_stat:' || tran_stat || ' resp_code:' || resp_code || ' rsv4:' || rsv4 AS text FROM nf""",
    "map_merge": f"""SELECT user_id, {_double('sum(CAST(value AS DECIMAL(14,2)))')} AS total FROM events
        GROUP BY user_id""",
    "point_read": "SELECT coalesce(max(c_mktsegment), '') AS value FROM customer WHERE c_custkey = 7",
    "point_read_absent": "SELECT coalesce(max(c_mktsegment), '') AS value FROM customer WHERE c_custkey = -1",
    "cell_exists": "SELECT count(c_name) > 0 AS found FROM customer WHERE c_custkey = 7",
    "key_get": "SELECT * FROM supplier WHERE s_suppkey = 3",
    "cast_predicate": f"""WITH {FEES} SELECT mer_no, apptype_id, mapp_main, credit_calc_type,
        {_double('credit_calc_rate')} AS credit_calc_rate, {_double('credit_calc_amt')} AS credit_calc_amt,
        {_double('credit_min_amt')} AS credit_min_amt, {_double('credit_max_amt')} AS credit_max_amt
        FROM fees WHERE try_cast(mapp_main AS DOUBLE) > 0""",
    "dynamic_lookup": f"""WITH {MAPS} SELECT min(r) AS value FROM (
        SELECT map_result AS r, src_item FROM maps UNION ALL SELECT 'LATER', src_item FROM maps) t
        WHERE src_item = '000000000000004,00000004'""",
    "dynamic_lookup_two": """SELECT min(c_name) AS value FROM customer WHERE c_nationkey = 3
        AND c_mktsegment LIKE 'B%'""",
    "dynamic_lookup_type": f"""WITH {MAPS} SELECT min(src_item) AS value FROM maps WHERE type_id = '1082'
        AND map_result = 'R5'""",
    "ranked_lookup": f"""WITH {FEES} SELECT credit_calc_type AS value FROM fees
        WHERE mer_no = '000000000000005' ORDER BY {_RANKS} LIMIT 1""",
    "wide_from_cells": f"""SELECT user_id, {', '.join(_pivot(e) for e in (
        'click', 'view', 'purchase', 'signup', 'error'))} FROM (
        SELECT user_id, event_id, event_type, CASE WHEN event_id % 5 <> 0
          THEN CAST(CAST(value AS DECIMAL(14,2)) AS VARCHAR) ELSE '' END AS v FROM events) t GROUP BY user_id""",
    "json_parse": f"""WITH {NORMAL} SELECT id, msg_type, proc_code, ser_concode,
        {_double("CASE WHEN proc_code IN ('01', '02') THEN 0 ELSE txn_amt END")} AS txn_amt, tid, mid, tran_stat,
        resp_code, CASE WHEN proc_code = '07' AND rsv4 = 'short' THEN '' ELSE rsv4 END AS rsv4
        FROM nf WHERE proc_code NOT IN ('03', '04', '05')""",
    "json_quarantine": f"""WITH {NORMAL} SELECT CASE proc_code WHEN '03' THEN 'txn_amt is not a number'
        WHEN '04' THEN 'not a JSON object' ELSE 'id is missing' END AS problem, count(*) AS messages
        FROM nf WHERE proc_code IN ('03', '04', '05') GROUP BY 1""",
    "json_parse_incre": f"""WITH {INCRE} SELECT plt_ssn, trans_st, trans_st_rsvl, prod_style, rout_inst_id_cd,
        mchnt_id_pay, term_id_pay, trans_cd_pay, pay_st, {_double('trans_amt')} AS trans_amt, rsvd1, rsvd6
        FROM inf""",
    "json_serialize": f"""WITH {NORMAL} SELECT '{{"ID":"' || id || '","MSG_TYPE":"' || msg_type
        || '","PROC_CODE":"' || proc_code || '","SER_CONCODE":"' || ser_concode || '","TXN_AMT":"'
        || CAST(txn_amt AS VARCHAR) || '","TID":"' || tid || '","MID":"' || mid || '","TRAN_STATUS":"'
        || tran_stat || '","RESP_CODE":"' || resp_code || '","RSV4":"' || rsv4 || '"}}' AS value FROM nf""",
    "props_parse": """SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS INTEGER), 0) AS k
        FROM events""",
    "decode_fn": """SELECT event_id,
        CASE user_id % 90 WHEN 1 THEN 1 WHEN 86 THEN 2 WHEN 74 THEN 3 WHEN 18 THEN 4 WHEN 39 THEN 5
          WHEN 40 THEN 6 ELSE 7 END AS with_last,
        CASE user_id % 3 WHEN 1 THEN 11 WHEN 2 THEN 20 ELSE 9 END AS last_wins,
        CASE user_id % 90 WHEN 1 THEN 1 WHEN 86 THEN 2 WHEN 74 THEN 3 WHEN 18 THEN 4 WHEN 39 THEN 5
          WHEN 40 THEN 6 WHEN 68 THEN 7 END AS plain FROM events""",
    "sql_functions": """SELECT event_id, CAST(user_id * user_id AS INTEGER) AS squared,
        CASE user_id % 3 WHEN 1 THEN 5 WHEN 2 THEN 6 ELSE 0 END AS decoded FROM events""",
    "square_fn": """SELECT l_orderkey, l_linenumber, l_linenumber * l_linenumber AS squared FROM lineitem""",
    "union_flows": f"""WITH {NORMAL}, {INCRE} SELECT id, mid AS merchant, tid AS terminal,
        {_double('txn_amt')} AS amount FROM nf UNION ALL
        SELECT plt_ssn, mchnt_id_pay, term_id_pay, {_double(f'trans_amt * {_CENT}')} FROM inf""",
    "stream_equals_batch": NORMAL_TOTALS,
    "stream_equals_batch_incre": INCRE_TOTALS,
    "stream_stored_sides": NORMAL_TOTALS,
    "stream_restarted": NORMAL_TOTALS,
    "stream_running_totals": NORMAL_TOTALS.replace("SELECT * FROM nd WHERE NOT", "SELECT * FROM nf WHERE NOT"),
    "delimited_load": f"""WITH {FEES} SELECT mer_no, apptype_id, '商户' || mapp_main AS mapp_main,
        credit_calc_type, {_double('credit_calc_rate')} AS credit_calc_rate,
        {_double('credit_calc_amt')} AS credit_calc_amt, {_double('credit_min_amt')} AS credit_min_amt,
        {_double('credit_max_amt')} AS credit_max_amt FROM fees WHERE CAST(mer_no AS BIGINT) % 50 <> 0""",
    "mapping_load": f"""WITH {MAPS}, two(map_id, other) AS (VALUES ('100000', NULL), ('200000', 'LATER'))
        SELECT map_id, type_id, src_item, coalesce(other, map_result) || 'new' AS map_result,
        1 AS rcd_ver, '' AS upd_datetime FROM maps, two""",
    "variable_arity_load": """SELECT CASE p_partkey % 3 WHEN 0 THEN 'K' WHEN 1 THEN '0200|01|' ELSE 'a|b|c|' END
          || CAST(p_partkey AS VARCHAR) AS txn_key,
        lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS txn_code, '消费' || p_name AS txn_des,
        'B001' AS bms_txn_code, '5' AS sett_flg, CAST(p_partkey % 3 - 1 AS INTEGER) AS dc_flg,
        ' ' AS txn_code_grp, p_size AS rcd_ver, '20140819141406' AS add_datetime, 'loader' AS add_user_id,
        '' AS upd_datetime, '' AS upd_user_id FROM part""",
    "delimited_flow": f"WITH {NORMAL} SELECT {_NORMAL_FLOW_TEXT} FROM nf",
    "gbk_fixed_width": f"""WITH {INCRE} SELECT plt_ssn, trans_st, trans_st_rsvl, prod_style, rout_inst_id_cd,
        mchnt_id_pay, term_id_pay, trans_cd_pay, pay_st, CAST(trans_amt AS VARCHAR) AS trans_amt,
        rtrim(rsvd1) AS rsvd1, CAST(rsvd6 AS VARCHAR) AS rsvd6 FROM inf""",
    "file_to_settlement": INCRE_TOTALS,
    "stream_running_totals_divided": NORMAL_TOTALS,
    "stream_with_duplicates": NORMAL_TOTALS.replace("PARTITION BY id ORDER", "PARTITION BY id, resp_code ORDER"),
    "incre_keyed_upsert": """SELECT l_orderkey AS plt_ssn, l_suppkey AS mchnt_id_pay, l_linenumber AS term_id_pay,
        CAST(l_quantity AS DOUBLE) AS qty FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag DESC,
        l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem) t WHERE rn = 1""",
    "cell_upsert": """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 4 <> 0 THEN 'c' || o_custkey ELSE '' END
        WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS priority,
        CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey AS VARCHAR) END AS customer
        FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0 OR o_orderkey % 5 = 0""",
    "store_delete": """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 7 <> 0 THEN c_name END AS name,
        CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 7 <> 0 THEN c_mktsegment END AS segment,
        CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation
        FROM customer WHERE c_custkey % 2 = 0 OR (c_custkey % 3 <> 0 AND c_custkey % 7 <> 0)""",
    "store_upsert_compacted": f"""WITH {NORMAL} SELECT id, mid, resp_code, {_double('txn_amt')} AS txn_amt FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY resp_code DESC, l_shipdate DESC,
          l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM nf) t
        WHERE rn = 1""",
    "store_point_read": """WITH l AS (SELECT l_orderkey, CAST(CAST(max(l_extendedprice) AS DECIMAL(14,2)) AS VARCHAR) AS price,
        max(l_returnflag) AS mode FROM lineitem GROUP BY l_orderkey)
        SELECT 0 AS place, coalesce(max(price), '') AS value FROM l WHERE l_orderkey = 4
        UNION ALL SELECT 1, coalesce(max(mode), '') FROM l WHERE l_orderkey = 4 UNION ALL SELECT 2, ''
        UNION ALL SELECT 3, CASE WHEN count(*) > 0 THEN 'true' ELSE 'false' END FROM l WHERE l_orderkey = 4 UNION ALL SELECT 4, 'false'""",
    "stream_levels": f"""SELECT {_mid('l_suppkey')} AS mer_no, {_double('sum(CAST(l_extendedprice AS DECIMAL(14,2)))')} AS total
        FROM lineitem GROUP BY 1""",
    "dimension_upsert": """SELECT lpad(CAST(s_suppkey AS VARCHAR), 15, '0') AS mer_no,
        CASE WHEN s_suppkey % 2 = 0 THEN 2.5 ELSE 1.5 END::DOUBLE AS rate
        FROM supplier WHERE s_suppkey % 3 <> 0 OR s_suppkey % 2 = 0""",
    "amount_limits": """SELECT problem, count(*) AS messages, CAST(sum(amount) AS DOUBLE) AS amount FROM (SELECT
        CASE l_linenumber WHEN 1 THEN 'txn_amt has more than 2 decimals' WHEN 2 THEN 'txn_amt is out of range'
          WHEN 3 THEN 'txn_amt is not a number' ELSE '' END AS problem,
        CASE l_linenumber WHEN 1 THEN l_partkey + 0.24 WHEN 4 THEN l_partkey + 0.5
          WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE l_partkey END::DECIMAL(14,2) AS amount FROM lineitem) t GROUP BY problem""",
    "ingest_rejects": """SELECT CASE WHEN l_linenumber = 2 THEN 'too few columns' ELSE 'message' END AS kind,
        CASE WHEN l_linenumber = 2 THEN 'short|' ELSE '' END || l_orderkey AS text, count(*) AS lines FROM lineitem GROUP BY 1, 2""",
    "multi_file_flow": f"WITH {NORMAL} SELECT mid, 2 * count(*) AS lines FROM nf GROUP BY mid",
    "single_cell_write": """SELECT CAST(user_id AS VARCHAR) AS user_id,
        CASE WHEN user_id = 7 THEN '' ELSE arg_max(event_id, event_id) FILTER (event_type = 'click')::VARCHAR END AS click,
        arg_max(event_id, event_id) FILTER (event_type = 'view')::VARCHAR AS view FROM events GROUP BY user_id""",
    "cell_maps": """SELECT user_id, string_agg(event_type || '=' || last, ',' ORDER BY event_type) AS cells FROM (
        SELECT user_id, event_type, max(event_id) AS last FROM events GROUP BY ALL) t GROUP BY user_id""",
    "table_if_absent": "SELECT CAST(n_regionkey AS BIGINT) AS r_regionkey, n_name AS r_name FROM nation",
    "message_key_shape": f"""WITH {NORMAL} SELECT '{{"ID":"' || id || '","MSG_TYPE":"' || msg_type || '","PROC_CODE":"' || proc_code
        || '","SER_CONCODE":"' || ser_concode || '","TXN_AMT":"' || CAST(txn_amt AS VARCHAR) || '","TID":"' || tid || '","MID":"' || mid
        || '","TRAN_STATUS":"' || tran_stat || '","RESP_CODE":"' || resp_code || '","RSV4":"' || rsv4 || '"}}' AS value,
        true AS key_fits FROM nf""",
}
ORACLES["store_sql_view"] = ORACLES["normal_specifics"]
