"""Hand-computed cases for the settlement rules and the decisions on odd behaviour."""

from __future__ import annotations

from dataclasses import replace

from netledger.plans.settlement import INCRE, NORMAL, detail, rejects, settle, summary
from netledger import schemas
from tests.helpers import dec, dimensions, incre_rows, normal_rows


def totals(settled):
    return {r.mer_no: r.total for r in summary(settled).collect()}


def rows(settled, key="id"):
    return {r[key]: r for r in settled.collect()}


def test_credit_pays_out_less_fee_and_debit_takes_back(spark):
    flow = normal_rows(spark, [dict(id="a"), dict(id="b", msg_type="0400", txn_amt=dec("30.00"))])
    dims = dimensions(spark, codes_=[("0200|00|00", "0", -1), ("0400|00|00", "0", 1)])
    # +100 - 1.00, then -30 + 0.30
    assert totals(settle(flow, dims, NORMAL)) == {"M1": dec("69.30")}


def test_incre_amount_is_in_cents_and_debit_sign(spark):
    flow = incre_rows(spark, [dict(plt_ssn="a"), dict(plt_ssn="b", trans_cd_pay="02V523X0",
                                                      trans_amt=dec("3000.00"))])
    dims = dimensions(spark, codes_=[("02S221X0", "1", -1), ("02V523X0", "2", 1)])
    assert totals(settle(flow, dims, INCRE)) == {"M1": dec("69.30")}


def test_polarity_of_the_flag_differs(spark):
    dims = dimensions(spark, codes_=[("0200|00|00", "1", -1), ("02S221X0", "0", -1)])
    assert totals(settle(normal_rows(spark, [{}]), dims, NORMAL)) == {}
    assert totals(settle(incre_rows(spark, [{}]), dims, INCRE)) == {}


def test_code_miss_keeps_defaults_and_never_settles(spark):
    settled = settle(normal_rows(spark, [dict(ser_concode="99")]), dimensions(spark), NORMAL)
    row = rows(settled)["1"]
    assert (row.filter_flag, row.dc_flag, row.supported_calc_type) == (False, 0, True)
    assert totals(settled) == {}
    assert [r.reason for r in rejects(settled, NORMAL).collect()] == ["direction is not 1 or -1"]


def test_flags_only_where_eligible(spark):
    dims = dimensions(spark, codes_=[("0200|00|00", "1", -1)], fees_=[])
    row = rows(settle(normal_rows(spark, [{}]), dims, NORMAL))["1"]
    assert (row.no_fee_profile, row.supported_calc_type, row.exchange) == (False, False, 0.0)
    dims = dimensions(spark, fees_=[])
    assert rows(settle(normal_rows(spark, [{}]), dims, NORMAL))["1"].no_fee_profile is True


def test_settlement_flag_domain(spark):
    flags = "012345678EFHNZW"
    dims = dimensions(spark, codes_=[(f"0200|00|{f}", f, -1) for f in flags])
    flow = normal_rows(spark, [dict(id=f, ser_concode=f) for f in flags])
    assert {k for k, r in rows(settle(flow, dims, NORMAL)).items() if r.filter_flag} == set("123456")


def test_fee(spark):
    cases = [
        ("10", "0.5", "0", "-1", "99999999", "0.50"),
        ("10", "0.5", "0", "2", "99999999", "2.00"),
        ("10", "50", "0", "-1", "25", "25.00"),
        ("10", "0.5", "0", "-1", "-1", "-1.00"),
        ("10", "0.5", "0", "5", "1", "5.00"),
        ("11", "0.5", "3", "-1", "99999999", "3.00"),
        ("00", "0.5", "3", "-1", "99999999", "0.00")]
    dims = dimensions(spark, fees_=[(f"M{i}", 1, "1", *c[:-1]) for i, c in enumerate(cases)])
    flow = normal_rows(spark, [dict(id=str(i), mid=f"M{i}") for i in range(len(cases))])
    got = rows(settle(flow, dims, NORMAL))
    assert [got[str(i)].fee for i in range(len(cases))] == [dec(c[-1]) for c in cases]


def test_negative_cap_can_mean_unlimited(spark):
    dims = dimensions(spark, fees_=[("M1", 1, "1", "10", "0.5", "0", "-1", "-1")])
    job = replace(NORMAL, unbounded_negative_cap=True)
    assert rows(settle(normal_rows(spark, [{}]), dims, job))["1"].fee == dec("0.50")


def test_older_fee_form_without_division(spark):
    dims = dimensions(spark, fees_=[("M1", 1, "1", "10", "0.006", "0", "-1", "99")])
    assert rows(settle(normal_rows(spark, [{}]), dims, replace(NORMAL, rate_divisor=1)))["1"].fee == dec("0.6")


def test_unsupported_type_is_rejected(spark):
    dims = dimensions(spark, fees_=[("M1", 1, "1", "00", "1", "1", "-1", "9")])
    settled = settle(normal_rows(spark, [{}]), dims, NORMAL)
    assert [r.reason for r in rejects(settled, NORMAL).collect()] == ["fee type not supported"]


def test_profile_order(spark):
    cases = {
        "main first, trimmed": [(68, " 1 ", "2"), (1, "x", "3")],
        "then the type rank": [(86, "x", "2"), (74, "x", "3")],
        "rank is not the number": [(40, "x", "2"), (68, "x", "3")],
        "unranked types first": [(9, "x", "2"), (1, "x", "3")],
        "then the type itself": [(2, "x", "2"), (9, "x", "3")]}
    dims = dimensions(spark, fees_=[(m, app, main, "11", "0", amt, "-1", "999")
                                    for m, profiles in cases.items() for app, main, amt in profiles])
    got = rows(settle(normal_rows(spark, [dict(id=m, mid=m) for m in cases]), dims, NORMAL))
    assert {m: r.fee for m, r in got.items()} == dict.fromkeys(cases, dec("2.00"))


def test_profile_by_own_merchant_total_by_resolved(spark):
    dims = dimensions(spark, mappings_=[("1", "1", "M1,T1", "R1")],
                      fees_=[("M1", 1, "1", "11", "0", "2", "-1", "9"), ("R1", 1, "1", "11", "0", "7", "-1", "9")])
    assert totals(settle(normal_rows(spark, [{}]), dims, NORMAL)) == {"R1": dec("98.00")}


def test_store_beats_terminal_and_works_without_one(spark):
    rsv4 = "x" * 20 + "0007zz"
    rules = [("1", "1", "M1,T1", "TERM"), ("1", "1082", "M1,0007", "STORE")]
    flow = normal_rows(spark, [dict(id="a", rsv4=rsv4), dict(id="b", rsv4=rsv4, tid="T2"),
                               dict(id="c", rsv4=rsv4[:23]), dict(id="d", rsv4=rsv4, mid="M2")])
    dims = dimensions(spark, groups_=[("M1", "B"), ("M1", "APL"), ("M2", "APLX")], mappings_=rules)
    got = rows(settle(flow, dims, NORMAL))
    assert {k: r.mer_no for k, r in got.items()} == {"a": "STORE", "b": "STORE", "c": "TERM", "d": "M2"}
    assert (got["a"].store_no, got["a"].map_result_from_rsv, got["a"].map_result_from_terminal) == (
        "0007", "STORE", "TERM")
    assert got["a"].group_id == "APL,B"
    assert got["d"].store_no == ""


def test_empty_mapping_results_do_not_count(spark):
    rsv4 = "x" * 20 + "0007"
    dims = dimensions(spark, groups_=[("M1", "APL")],
                      mappings_=[("1", "1", "M1,T1", ""), ("1", "1082", "M1,0007", "")])
    assert rows(settle(normal_rows(spark, [dict(rsv4=rsv4)]), dims, NORMAL))["1"].mer_no == "M1"


def test_incre_store_number_may_be_short(spark):
    dims = dimensions(spark, codes_=[("02S221X0", "1", -1)], mappings_=[("1", "1068", "S5", "M5")])
    flow = incre_rows(spark, [dict(plt_ssn="a", rsvd1="SML0000S5"), dict(plt_ssn="b", rsvd1="SML0000S5" + " " * 41),
                              dict(plt_ssn="c", rsvd1="SM"), dict(plt_ssn="d", rsvd1="XML0000S5")])
    got = rows(settle(flow, dims, INCRE), "plt_ssn")
    assert {k: r.mer_no for k, r in got.items()} == {"a": "M5", "b": "M5", "c": "M1", "d": "M1"}
    assert got["b"].store_no == "S5"


def test_first_mapping_by_loader_key_and_no_row_growth(spark):
    dims = dimensions(spark, codes_=[("0200|00|00", "0", -1), ("0200|00|00", "1", 1)],
                      groups_=[("M1", "A"), ("M1", "A"), ("M1", "B")],
                      mappings_=[("2", "1", "M1,T1", "LATE"), ("1", "1", "M1,T1", "EARLY")],
                      fees_=[("M1", 1, "1", "10", "1", "0", "-1", "9"), ("M1", 86, "1", "10", "1", "0", "-1", "9")])
    got = settle(normal_rows(spark, [{}]), dims, NORMAL).collect()
    assert len(got) == 1
    assert (got[0].mer_no, got[0].group_id) == ("EARLY", "A,A,B")


def test_last_arrival_wins_before_the_filter(spark):
    flow = normal_rows(spark, [
        dict(id="a", txn_amt=dec("1.00"), arrival=1), dict(id="a", txn_amt=dec("2.00"), arrival=2),
        dict(id="b", arrival=1), dict(id="b", proc_code="01", arrival=2)])
    got = rows(settle(flow, dimensions(spark), NORMAL))
    assert set(got) == {"a"} and got["a"].txn_amt == dec("2.00")


def test_ties_on_arrival_are_settled_by_value(spark):
    tied = [dict(id="a", txn_amt=dec(f"{i}.00")) for i in range(1, 9)]
    kept = {settle(normal_rows(spark, rows_).repartition(n), dimensions(spark), NORMAL).first().txn_amt
            for n, rows_ in ((1, tied), (5, tied[::-1]))}
    assert len(kept) == 1


def test_incre_key_has_three_parts(spark):
    dims = dimensions(spark, codes_=[("02S221X0", "1", -1)])
    flow = incre_rows(spark, [dict(arrival=1), dict(term_id_pay="T2", arrival=2), dict(arrival=3)])
    assert settle(flow, dims, INCRE).count() == 2


def test_normal_filter_leaves_out_only_full_matches(spark):
    flow = normal_rows(spark, [dict(id="out", proc_code="01"), dict(id="proc", proc_code="03"),
                               dict(id="resp", proc_code="01", resp_code="05"),
                               dict(id="stat", proc_code="01", tran_stat="4")])
    assert set(rows(settle(flow, dimensions(spark), NORMAL))) == {"proc", "resp", "stat"}


def test_incre_whitelist(spark):
    routed = dict(rout_inst_id_cd="3748020000", rsvd6=1001)
    cases = {
        "a": dict(trans_cd_pay="02S221X1", **routed), "b": dict(trans_cd_pay="02S221X1"),
        "c": dict(trans_cd_pay="07S30609", rsvd6=1002), "d": dict(trans_cd_pay="07S30609", rsvd6=1001),
        "e": dict(trans_cd_pay="07S30609", **routed), "f": dict(trans_cd_pay="02R222X0"),
        "g": dict(pay_st="1"), "h": dict(trans_st="1"), "i": dict(trans_st_rsvl="1"),
        "j": dict(prod_style="51B2"), "k": dict(trans_cd_pay="99Z", **routed)}
    flow = incre_rows(spark, [dict(plt_ssn=k, **v) for k, v in cases.items()])
    assert set(rows(settle(flow, dimensions(spark), INCRE), "plt_ssn")) == {"a", "c", "e", "f"}


def test_detail_layouts(spark):
    normal = detail(settle(normal_rows(spark, [{}]), dimensions(spark), NORMAL), schemas.NORMAL_DETAIL)
    incre = detail(settle(incre_rows(spark, [{}]), dimensions(spark), INCRE), schemas.INCRE_DETAIL)
    assert len(normal.columns) == 1 + 19 + 2
    assert len(incre.columns) == 1 + 20 + 2
    assert incre.first()["exchange"] == 0.0


def test_totals_do_not_depend_on_partitioning(spark):
    flow = normal_rows(spark, [dict(id=str(i), mid=f"M{i % 3}", txn_amt=dec(f"{i}.37")) for i in range(60)])
    dims = dimensions(spark, fees_=[(f"M{i}", 1, "1", "10", "0.38", "0", "-1", "25") for i in range(3)])
    assert totals(settle(flow.repartition(7), dims, NORMAL)) == totals(settle(flow.coalesce(1), dims, NORMAL))
