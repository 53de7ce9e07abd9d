"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names, for every operator and stage."""

from __future__ import annotations

import pytest

import corpus_pipeline
from netledger.llm import bpe, chat, decontaminate, langid, neardup, quality, resample, secrets, substring, urlfilter
from netledger.llm.queries import vocabulary

FOLDER = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n_words string, kept string, score string, host string, n_hit string, secrets string, component_id string, "
          "_id string, _row string, _text string, open string, tie string, _salt string, `a.b` string")
ROWS = [
    (1, None, "en", "s", None), (2, "", None, None, 0), (3, LONG, "en", "s", 1), (4, "the same row of text", "en", "s", 2),
    (4, "the same row of text", "en", "s", 2), (None, "text without an id", "fr", None, 3), (None, None, None, None, None),
    (5, "  \n\t ", "en", "s", 4), (6, "the same row of text", "de", "s", 5)]


EXTRA = ("n", "k", "x", "h", "w", "q", "c", "i", "r", "t", "o", "e", "s", "d")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame([(*r, *EXTRA) for r in ROWS], SCHEMA).repartition(3).cache()
    yield rows
    rows.unpersist()


def operators(spark):
    benchmark = spark.createDataFrame([(1, "the same row"), (None, "x"), (2, None), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(3,), (None,)], "doc_id long")
    pages = spark.createDataFrame([("http://a.example/x",), (None,)], "url string")
    return {
        "decontaminate": lambda d: decontaminate.decontaminate(d, benchmark),
        "identify": lambda d: langid.identify(d, langid.train(d)),
        "identify_untrained": lambda d: langid.identify(d, langid.train(d.limit(0))),
        "encode": lambda d: bpe.encode(d, vocabulary()),
        "round_trip": lambda d: bpe.round_trip(d, vocabulary()),
        "secrets": secrets.scan,
        "redacted": secrets.redacted,
        "urls": lambda d: urlfilter.filter_urls(d, pages, [("allow", "org", "/")], url="text"),
        "substring": lambda d: substring.remove_repeats(d),
        "neardup": lambda d: neardup.near_duplicates(d, keep=d.columns),
        "quality": lambda d: quality.quality(d),
        "resample": lambda d: resample.resample(d, labels),
    }


NAMES = ["decontaminate", "identify", "identify_untrained", "encode", "round_trip", "secrets", "redacted", "urls", "substring",
         "neardup", "quality", "resample"]


@pytest.mark.parametrize("name", NAMES)
def test_edges(spark, docs, name):
    out = operators(spark)[name](docs)
    assert len(out.columns) == len(set(out.columns))
    rows = out.collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ROWS)
    assert {r["source"] for r in rows} == {"s", None}
    if name == "decontaminate":
        assert (by_id[1]["n_words"], by_id[4]["n_hit"], by_id[4]["item_ids"]) == (0, 3, ["1"])
    if name == "secrets":
        assert all(r["secrets"] == [] for r in rows)
    if name == "substring":
        assert by_id[3]["n_words"] == 120_000 and by_id[1]["n_words"] == 0 and by_id[1]["kept_text"] == ""
    if name == "neardup":
        assert (by_id[6]["component_id"], by_id[6]["kept"], by_id[4]["kept"]) == (4, False, True)
        assert by_id[1]["n_shingles"] == 0 and by_id[1]["kept"]
    if name == "quality":
        assert by_id[1]["base_failed"] and not by_id[2]["kept"]
    if name == "resample":
        assert sum(r["selected"] for r in rows) in (5, 6)
    if name == "identify_untrained":
        assert {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)}


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, docs, name):
    assert operators(spark)[name](docs.limit(0)).collect() == []


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stage_edges(spark, docs, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    out = run(spark, docs, FOLDER)
    if stage != "bpe_encoding":
        assert out.columns == docs.columns
    rows = out.collect()
    if stage != "bpe_encoding":
        assert {tuple(r)[5:] for r in rows} <= {EXTRA}
    if stage == "minhash_near_dedup":
        kept = [(str(r["doc_id"]), r["text"] and r["text"][:8]) for r in rows]
        assert sorted(kept, key=repr) == sorted([("1", None), ("2", ""), ("3", LONG[:8]), ("4", "the same"), ("4", "the same"), ("5", "  \n\t "),
                        ("None", None), ("None", "text wit")], key=repr)
    if stage in ("bpe_encoding", "secret_scan", "benchmark_decontamination"):
        assert len(rows) == len(ROWS)
    assert run(spark, docs.limit(0), FOLDER).collect() == []


def test_near_duplicates_without_ids(spark):
    """Of rows without an id, one text of each class stays; one id with two texts is judged by text."""
    words = [f"w{k}" for k in range(200)]
    near = " ".join(["x", *words[1:]])
    rows = [(None, " ".join(words)), (None, near), (None, near), (None, "quite other words are in here"), (7, "one text of seven words is here"),
            (7, "another text that seven has besides the first"), (None, ""), (None, None)]
    table = spark.createDataFrame(rows * 20, "doc_id long, text string")
    out = neardup.near_duplicates(table, keep=table.columns).filter("kept").groupBy("doc_id", "text").count().collect()
    texts = [r["text"] for r in out]
    assert len(texts) == 6 and (near in texts) != (rows[0][1] in texts)
    assert {r["count"] for r in out} <= {20, 40}


def test_chat_edges(spark):
    call = '{"tool_calls":[{"id":"a","name":"t","arguments":{"b":1,"a":"x"}}]}'
    rows = [(1, 0, "assistant", call, 9), (1, 0, "assistant", call, 9), (1, 1, "tool", '{"tool_call_id":"a","content":"r"}', 9),
            (1, 2, "tool", '{"tool_call_id":"a","content":"s"}', 9), (1, 3, "tool", '{"tool_call_id":"z"}', 9),
            (None, None, None, None, None), (2, 0, "assistant", "", 9), (2, 1, "assistant", "{broken", 9)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record int")
    out = chat.link_tools(table, {"t": {"a": ("string", True), "b": ("integer", False)}})
    found = sorted((r["kind"], r["status"], r["problems"]) for r in out.collect())
    assert found == [("call", "linked", ""), ("call", "linked", ""), ("message", "plain", ""), ("message", "plain", ""),
                     ("message", "plain", ""), ("result", "linked", ""), ("result", "orphan", ""), ("result", "repeated", "")]
    assert {r["record"] for r in out.filter("kind = 'call'").collect()} == {
        '{"arguments":{"a":"x","b":1},"id":"a","name":"t","type":"tool_call"}'}
    assert chat.link_tools(table.limit(0), {}).count() == 0


def test_chat_text_beside_calls(spark):
    calls = '"tool_calls":[{"id":"a","name":"t","arguments":{}},{"id":"b","name":"t","arguments":{}}]'
    rows = [(1, 0, "assistant", '{"content":"I look it up.",%s}' % calls), (1, 0, "assistant", '{"content":"I look it up.",%s}' % calls),
            (2, 0, "assistant", '{%s,"content":[{"text":"parts","type":"text"}]}' % calls), (3, 0, "assistant", '{"content":"",%s}' % calls),
            (4, 0, "assistant", '{"content":null,%s}' % calls), (5, 0, "assistant", "{%s}" % calls)]
    out = chat.link_tools(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), {"t": {}})
    assert sorted((r["conv_id"], r["place"], r["status"], r["level"], r["record"]) for r in out.filter("kind = 'message'").collect()) == [
        (1, -1, "plain", 0, '{"content":"I look it up.","role":"assistant","type":"message"}')] * 2 + [
        (2, -1, "plain", 0, '{"content":"[{\\"text\\":\\"parts\\",\\"type\\":\\"text\\"}]","role":"assistant","type":"message"}')]
    assert out.filter("kind = 'call'").count() == 12


def test_chat_levels_and_validation(spark):
    calls = [("c1", ["c2"], '{"n":"1"}'), ("c2", ["c3"], '{"n":1.5,"x":2}'), ("c3", [], "[]"), ("c4", ["c5"], '{"n":2}'), ("c5", ["c4"], "{}"),
             ("c6", ["c2", "c3", "none"], '{"n":1.0}'), ("c7", ["c3"], '{"n":7}')]
    import json
    rows = [(7, k, "assistant", json.dumps({"tool_calls": [{"id": i, "name": "t" if i != "c5" else "u", "arguments": json.loads(a), "after": after}]}))
            for k, (i, after, a) in enumerate(calls)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["call_id"]: r for r in chat.link_tools(table, {"t": {"n": ("integer", True)}}).collect()}
    assert {k: r["level"] for k, r in out.items()} == {"c1": 2, "c2": 1, "c3": 0, "c4": -1, "c5": -1, "c6": 1, "c7": 0}
    assert {k: r["problems"] for k, r in out.items()} == {
        "c1": "n is no integer", "c2": "unknown x; n is no integer", "c3": "no object", "c4": "", "c5": "unknown tool", "c6": "", "c7": ""}
    assert out["c6"]["record"] == '{"arguments":{"n":1},"id":"c6","name":"t","type":"tool_call"}'
    assert all(r["status"] == "unanswered" for r in out.values())


def test_chat_arguments_that_are_no_json_are_kept(spark):
    import json
    texts = ["{broken", '{"a":1,"a":2}', "", "word " * 100_000]
    rows = [(k, 0, "assistant", json.dumps({"tool_calls": [{"id": "a", "name": "t", "arguments": a}]})) for k, a in enumerate(texts)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "kind long, level long, role string, text string, conv_id string, `a.b` int")
    out = chat.link_tools(table, {"t": {}}, conv="kind", turn="level")
    found = {r["conv_id"]: r for r in out.collect()}
    assert {k: json.loads(r["record"])["arguments_text"] for k, r in found.items()} == dict(enumerate(texts))
    assert {r["problems"] for r in found.values()} == {"no object"} and len(set(out.columns)) == len(out.columns)
