"""File ingest: GBK bytes, delimited lines, dimension files."""

from __future__ import annotations

import json

from netledger import schemas
from netledger.operators import parse
from netledger.plans.load import (ingest_incre, ingest_normal, load_dimensions, open_dimensions, open_version, published,
                                  read_dimensions)
from netledger.sinks import publish
from netledger.sources.dimensions import parse_dimension, read_dimension
from netledger.sources.flowfiles import bad_lines, delimited_fields, fixed_width_fields
from netledger.sources.lines import read_lines, split_paths


def put(path, *lines, end="\n"):
    path.write_bytes(end.join(lines).encode("gbk"))
    return str(path)


def incre_line(**fields):
    """A fixed-width line built on bytes, with multi-byte text in an unused range."""
    line = bytearray(b" " * 2400)
    line[41:49] = "商户名称".encode("gbk")
    for name, text in fields.items():
        begin, end = schemas.INCRE_BYTES[name]
        raw = text.encode("gbk")
        assert len(raw) <= end - begin
        line[begin:begin + len(raw)] = raw
    return bytes(line).decode("gbk")


def test_fixed_width_cuts_bytes_not_characters(spark, tmp_path):
    path = put(tmp_path / "f.txt", incre_line(PLT_SSN="000000000001", MCHNT_ID_PAY="898630159989365",
                                             TRANS_AMT="000000012345", RSVD1="SML门店0007", RSVD6="1001"))
    row = fixed_width_fields(read_lines(spark, path)).first()
    assert (row.PLT_SSN, row.MCHNT_ID_PAY, row.TRANS_AMT) == ("000000000001", "898630159989365", "000000012345")
    assert (row.RSVD1, row.RSVD6, row.TRANS_ST) == ("SML门店0007", "1001", "")


def test_short_fixed_width_line_leaves_later_fields_blank(spark, tmp_path):
    line = incre_line(PLT_SSN="000000000001", TRANS_AMT="5").encode("gbk")[:2000].decode("gbk")
    path = put(tmp_path / "f.txt", line, "short")
    fields = fixed_width_fields(read_lines(spark, path))
    assert bad_lines(fields).first().line == "short"
    record = parse.usable(parse.read_incre(ingest_incre(spark, path))).first()
    assert (record.plt_ssn, record.rsvd1, record.rsvd6, float(record.trans_amt)) == ("000000000001", "", 0, 5.0)


def test_split_range_in_a_character_does_not_fail(spark, tmp_path):
    line = bytearray(incre_line(PLT_SSN="1").encode("gbk"))
    line[11:13] = "商".encode("gbk")
    path = tmp_path / "f.txt"
    path.write_bytes(bytes(line))
    assert fixed_width_fields(read_lines(spark, str(path))).first().PLT_SSN.startswith("1")


def normal_line(pieces=70, **fields):
    values = ["x"] * pieces
    for name, text in fields.items():
        values[schemas.NORMAL_POSITIONS[name]] = text
    return "|".join(values)


def test_delimited_flow(spark, tmp_path):
    # The second byte of this character is the pipe, so decoding has to come first.
    tricky = b"\x81\x7c".decode("gbk")
    path = put(tmp_path / "n.txt", normal_line(ID=" 1 ", MID='a"b\\c', RSV4=tricky, TXN_AMT=" 12.50"),
               "too|few", end="\r\n")
    fields = delimited_fields(read_lines(spark, path))
    good = fields.filter("problem IS NULL").first()
    assert (good.ID, good.MID, good.RSV4, good.TXN_AMT) == ("1", 'a"b\\c', tricky, "12.50")
    assert [r.line for r in bad_lines(fields).collect()] == ["too|few"]
    message = json.loads(ingest_normal(spark, path).first().value)
    assert set(message) == {*schemas.NORMAL_KEYS, schemas.POSITION}


def test_several_files_and_none(spark, tmp_path):
    a, b = put(tmp_path / "a.txt", "1"), put(tmp_path / "b.txt", "2", "3")
    assert read_lines(spark, f"{a}, {b}").count() == 3
    assert read_lines(spark, "  ").count() == 0
    assert read_lines(spark, "").columns == ["line", "position"]
    assert split_paths(" a ,,b") == ["a", "b"]


FEE = "M1|86|1|10|.6|0|-1|25|"
GROUP = "48020000|20170724|APL|02|M1|19900101|99999999|0|20140819141406|loader  |||"
MAP = "48020000|20170724|101151|1|M1,T1|R1|19900101|99999999|0|20131018153535|loader  |||"


def test_fee_file(spark, tmp_path):
    path = put(tmp_path / "fees.txt", FEE, "M1|86|1|11|.6|2|-1|30|", "M2|x|1|10|1|0|-1|9|", "M3|1|1|10", end="\r\n")
    rows = read_dimension(spark, "fees", path).collect()
    assert [(r.mer_no, r.apptype_id, r.credit_calc_type, str(r.credit_max_amt)) for r in rows] == [
        ("M1", 86, "11", "30.00")]
    parsed = parse_dimension(read_lines(spark, path), "fees")
    assert parsed.filter("problem IS NOT NULL").count() == 2


def test_loader_keys_run_together(spark, tmp_path):
    """Key text is concatenated without a separator, so these two lines share a key."""
    path = put(tmp_path / "fees.txt", "M1|11|1|10|1|0|-1|9|", "M11|1|1|10|1|0|-1|8|")
    assert [r.mer_no for r in read_dimension(spark, "fees", path).collect()] == ["M11"]


def test_group_and_mapping_files_in_table_order(spark, tmp_path):
    groups = read_dimension(spark, "groups", put(tmp_path / "g.txt", GROUP)).first()
    assert (groups.item, groups.group_id, groups.rcd_ver, groups.upd_datetime) == ("M1", "APL", 0, "")
    maps = read_dimension(spark, "mappings", put(tmp_path / "m.txt", MAP)).first()
    assert (maps.map_id, maps.type_id, maps.src_item, maps.map_result) == ("101151", "1", "M1,T1", "R1")


def test_positions_can_be_configured(spark, tmp_path):
    lines = read_lines(spark, put(tmp_path / "g.txt", "2|M1|1"))
    row = parse_dimension(lines, "fees", {n: {"mer_no": 1, "apptype_id": 0}.get(n, 2)
                                          for n in schemas.FEE_COLUMNS}).first()
    assert (row.mer_no, row.apptype_id) == ("M1", 2)


def test_code_keys_of_any_length(spark, tmp_path):
    tail = "T01|消费|B001|1|-1||0|20140819141406|loader|||"
    path = put(tmp_path / "c.txt", "K1|" + tail, "0200|00|00|" + tail, "a|b|c|d|" + tail, "no|code")
    rows = {r.txn_key: r for r in read_dimension(spark, "codes", path).collect()}
    assert set(rows) == {"K1", "0200|00|00", "a|b|c|d"}
    assert {(r.txn_code, r.txn_des, r.sett_flg, r.dc_flg, r.upd_user_id) for r in rows.values()} == {
        ("T01", "消费", "1", -1, "")}


def test_last_line_wins_across_blocks(spark, tmp_path):
    lines = [f"M{i % 7}|1|1|10|{i}|0|-1|9|" for i in range(2000)]
    path = put(tmp_path / "fees.txt", *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r.mer_no: int(r.credit_calc_rate) for r in read_dimension(spark, "fees", path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"M{i % 7}": i for i in range(1993, 2000)}


def test_load_job(spark, tmp_path):
    target = str(tmp_path / "dims")
    files = {
        "fees": put(tmp_path / "f.txt", FEE, "bad"), "groups": put(tmp_path / "g.txt", GROUP),
        "mappings": put(tmp_path / "m.txt", MAP),
        "codes": put(tmp_path / "c.txt", "K|T01|d|B001|1|-1|G|0|20140819141406|loader|||")}
    load_dimensions(spark, files, target)
    for dims in (open_dimensions(spark, target), read_dimensions(spark, files)):
        assert [dims.fees.count(), dims.groups.count(), dims.mappings.count(), dims.codes.count()] == [1] * 4
    assert spark.read.parquet(f"{target}/quarantine/fees").first().line == "bad"
    # A second load adds keys, replaces known ones, and leaves what a reader of the first version has opened.
    before = open_dimensions(spark, target)
    other = FEE.replace(FEE.split("|")[0], "M9", 1)
    load_dimensions(spark, {"fees": put(tmp_path / "f2.txt", other)}, target)
    after = open_dimensions(spark, target)
    assert (before.fees.count(), after.fees.count(), after.codes.count()) == (1, 2, 1)


def test_session_settings_stay_with_the_caller(spark, tmp_path):
    read_lines(spark, put(tmp_path / "a.txt", "1")).count()
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_two_loads_at_once_keep_the_keys_of_both(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "dims")
    lines = [FEE.replace(FEE.split("|")[0], f"M{k}", 1) for k in range(3)]
    load_dimensions(spark, {"fees": put(tmp_path / "f0.txt", lines[0])}, target)
    claim, waiting = publish.claim, [lines[2]]

    def raced(*args):
        if waiting:  # another load of the table publishes between this one's merge and its claim
            load_dimensions(spark, {"fees": put(tmp_path / "f2.txt", waiting.pop())}, target)
        return claim(*args)

    monkeypatch.setattr(publish, "claim", raced)
    load_dimensions(spark, {"fees": put(tmp_path / "f1.txt", lines[1])}, target)
    assert published(spark, target, "fees") == 2
    assert {r.mer_no for r in open_version(spark, target, "fees", 2).collect()} == {"M0", "M1", "M2"}
