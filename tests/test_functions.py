"""Expressions against plain Python models."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contract import fixtures as fx
from netledger.functions.sqlfunctions import register
from netledger.functions.text import contains_item, decode_list, describe, key_of, pieces, slice_text
from netledger.operators import filters
from netledger.operators.lookups import first_like
from tests.helpers import codes, frame, normal_rows


@st.composite
def decode_case(draw):
    """A translation text and its result: the table says what each key means last."""
    wanted = draw(st.integers(0, 3))
    table = draw(st.lists(st.tuples(st.integers(0, 3), st.integers(10, 99)), max_size=4))
    default = draw(st.integers(100, 200))
    text = ",".join([str(wanted), *(f"{a},{b}" for a, b in table), str(default)])
    return text, dict(table).get(wanted, default)


@settings(max_examples=3, deadline=None)
@given(st.lists(decode_case(), min_size=30, max_size=30))
def test_decode_list_model(spark, cases):
    register(spark)
    df = frame(spark, cases, "t string, expected int")
    for row in df.select("*", decode_list("t").alias("a"), F.expr("decode_list(t)").alias("b")).collect():
        assert row.a == row.b == row.expected


def test_decode_list_forms(spark):
    df = frame(spark, [("7,5,50,6,60,7,70,0",), ("q,1,10,99",), (" 4 ,4,1,4,2,0",), ("8",), ("3,3,5,,,",)], "t string")
    assert [r[0] for r in df.select(decode_list("t")).collect()] == [70, 99, 2, 8, 5]


def test_sqr(spark):
    register(spark)
    assert spark.sql("SELECT sqr(-3) AS v").first().v == 9


def test_sqr_of_large_values(spark):
    register(spark)
    for x in (46340, 46341, 89999, -65536, 2147483647, -2147483648):
        wrapped = (x * x + (1 << 31)) % (1 << 32) - (1 << 31)
        assert spark.sql(f"SELECT sqr(CAST({x}L AS INT)) AS v").first().v == wrapped
    assert spark.sql("SELECT sqr(NULL) AS v").first().v is None


def test_text_helpers(spark):
    df = frame(spark, [("abcdef", "a,APL", None)], "a string, g string, n string")
    row = df.select(slice_text("a", 2, 4).alias("s"), slice_text("a", 4, 50).alias("t"),
                    contains_item("g", "APL").alias("c"), contains_item("g", "AP").alias("d"),
                    key_of("a", "n", "g", sep="|").alias("k"), describe(["a", "n"]).alias("r"),
                    pieces(F.lit("a||b|||")).alias("p")).first()
    assert (row.s, row.t, row.c, row.d) == ("cd", "ef", True, False)
    assert (row.k, row.r, row.p) == ("abcdef||a,APL", "a:abcdef n:", ["a", "", "b"])


def test_rules_flag_without_dropping(spark):
    flow = normal_rows(spark, [dict(id="a", proc_code="03"), dict(id="b", proc_code=None), dict(id="c")])
    flagged = filters.flag_by_rules(flow, ["proc_code > '02'", "tid = 'none'"])
    assert {r.id: r.filter_flag for r in flagged.collect()} == {"a": True, "b": False, "c": False}
    assert [r.id for r in filters.keep_flagged(flagged).collect()] == ["a"]


def test_rule_text_is_the_trade_filter(spark):
    flow = fx.normal_flow(spark, "/root/testdata/sf0.001")
    flagged = filters.flag_by_rules(flow, filters.NORMAL_RULES)
    assert flagged.filter(F.col("filter_flag") != filters.normal_trade()).isEmpty()


def test_pattern_index_is_like(spark):
    keys = ["0200|01|00", "0400|20|00", "02000200", "0202020", "2|0", "", "0123456789" * 5]
    pairs = ["20", "02", "00", "01", "|0", "40", "99", "", "2", "567890123456"]
    texts = ["", "0", "00", "20", "|00", "7", "0200"]
    asked = frame(spark, [(a, b, c) for a in pairs for b in pairs for c in texts], "msg_part string, proc_part string, ser_part string")
    index = {(r.msg_part, r.proc_part, r.ser_part): r.txn_key
             for r in first_like(asked, codes(spark, [(k, "1", 1) for k in keys])).collect()}

    def like(key, parts):
        at = 0
        for part in parts:
            found = key.find(part, at)
            if found < 0:
                return False
            at = found + len(part)
        return True

    for a in pairs:
        for b in pairs:
            for c in texts:
                expected = min((k for k in keys if like(k, (a, b, c))), default=None)
                assert index.get((a, b, c)) == expected, (a, b, c)
