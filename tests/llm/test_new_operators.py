"""WARC archives, spelling variants and source divergence against plain versions, with nulls, ties, long texts and clashing names."""

from __future__ import annotations

import gzip
import io
import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from netledger.llm import divergence, variants, warc

LONG = "word " * 300_000


# WARC

PAGES = [(5, "http://b", "x" * 200), (3, "http://a", "x" * 200), (3, "http://a", "x" * 200), (3, "http://z", "x" * 200), (7, None, None),
         (8, "http://c\r\nX: y", ""), (9, "http://d", "é" * 49), (10, "http://e", "é" * 49), (11, "http://f", LONG), (12, "http://g", LONG),
         (None, "http://h", LONG), (None, "http://i", "y" * 120), (None, "http://j", "y" * 120), (None, None, None)]


def archived(spark, folder, rows=PAGES, **options):
    table = spark.createDataFrame([(*r, 1, "s", "t") for r in rows],
                                  "page_id long, url string, html string, digest int, first string, payload string")
    warc.archive(table.repartition(3) if rows else table, str(folder), **options)
    return str(folder)


def test_archive_round_trip(spark, tmp_path):
    path = archived(spark, tmp_path / "w", file_bytes=500)
    rows = warc.read_warc(spark, path).collect()
    assert len(rows) == len(PAGES) and len({r["record_id"] for r in rows}) == len(PAGES)
    by_id = {r["record_id"]: r for r in rows}
    held = Counter()
    for r in rows:
        answer = by_id[r["refers_to"]] if r["record_type"] == "revisit" else r
        assert answer["record_type"] == "response" and answer["payload_digest"] == r["payload_digest"]
        assert sha256(answer["payload"]).hexdigest() == r["payload_digest"][7:] and r["payload_length"] == len(answer["payload"])
        assert r["refers_to_page"] == (answer["page_id"] if answer is not r else None)
        held[(r["page_id"] and int(r["page_id"]), r["target_uri"], answer["payload"].decode())] += 1
    assert held == Counter((p, u and " ".join(u.split()), h or "") for p, u, h in PAGES)
    assert Counter((r["page_id"], r["record_type"]) for r in rows if r["payload_length"] == 200) == {
        ("3", "response"): 1, ("3", "revisit"): 2, ("5", "revisit"): 1}
    assert {(r["page_id"], r["record_type"], r["refers_to_page"]) for r in rows if r["payload_length"] == len(LONG)} == {
        ("11", "response", None), ("12", "revisit", "11"), (None, "revisit", "11")}
    assert sorted(r["record_type"] for r in rows if r["payload_length"] == 120) == ["response", "revisit"]
    assert all(r["record_type"] == "response" for r in rows if r["payload_length"] < 100)


def test_archive_of_an_empty_table(spark, tmp_path):
    path = archived(spark, tmp_path / "w", rows=[])
    assert warc.read_warc(spark, path).collect() == []


def test_header_predicates_are_pushed(spark, tmp_path):
    path = archived(spark, tmp_path / "w")
    found = warc.read_warc(spark, path).filter("record_type = 'revisit' AND target_uri >= 'http://b' AND NOT page_id <=> '12'")
    assert sorted((r["page_id"] or "", r["target_uri"]) for r in found.collect()) == [
        ("", "http://h"), *([("", "http://j")]), ("3", "http://z"), ("5", "http://b")]
    assert " Filter (" not in found._jdf.queryExecution().executedPlan().toString()
    beyond = warc.read_warc(spark, path).filter("payload_length > 1")
    assert " Filter (" in beyond._jdf.queryExecution().executedPlan().toString()
    assert "payload" not in warc.read_warc(spark, path, payload=False).columns


class Counting(io.BytesIO):
    taken = 0

    def read(self, size=-1):
        data = super().read(size)
        self.taken += len(data)
        return data


def test_unwanted_payloads_are_skipped():
    noise = bytes(random.Random(1).randbytes(2_000_000))
    pack = b"".join(warc.member({"record_type": kind, "record_id": "<urn:x>", "content_type": "application/http"}, noise, 6)
                    for kind in ("response", "metadata", "response"))
    file = Counting(pack)
    kept = list(warc.records(file, "a.warc.gz", [warc.EqualTo(("record_type",), "metadata")], True))
    assert [r["payload"] == noise for r in kept] == [True] and file.taken < len(pack) / 2
    assert gzip.decompress(pack).count(b"WARC/1.1\r\n") == 3


def foreign(kind: str, uri: str, block: bytes, more: str = "") -> bytes:
    return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\n\t/folded\r\n{more}Content-Length: {len(block)}\r\n\r\n".encode()
            + block + b"\r\n\r\n")


@pytest.mark.parametrize("packed", [False, True])
def test_archives_from_elsewhere(spark, tmp_path, packed):
    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4;x=y\r\nWARC\r\n3\r\n/1.\r\n0\r\n\r\n"
    parts = [foreign("warcinfo", "a", b"software: x\r\n"), foreign("response", "b", http, "Content-Type: application/http\r\n"),
             foreign("resource", "c", b""), foreign("resource", "d", b"WARC/1.0\r\n\r\n" * 9000)]
    path = tmp_path / ("x.warc.gz" if packed else "x.warc")
    path.write_bytes(b"".join(map(gzip.compress, parts)) if packed else b"".join(parts))
    rows = {r["target_uri"]: r for r in warc.read_warc(spark, str(tmp_path)).collect()}
    assert {k: bytes(r["payload"]) for k, r in rows.items()} == {
        "a /folded": b"software: x\r\n", "b /folded": b"WARC/1.", "c /folded": b"", "d /folded": b"WARC/1.0\r\n\r\n" * 9000}
    assert warc.read_warc(spark, str(tmp_path), payload=False).filter("record_type = 'resource'").count() == 2


def test_uncommitted_and_broken_archives(spark, tmp_path):
    path = archived(spark, tmp_path / "w")
    (tmp_path / "w" / "part-lost.warc.gz").write_bytes(b"half a file")
    assert warc.read_warc(spark, path).count() == len(PAGES)
    archived(spark, tmp_path / "w")
    assert warc.read_warc(spark, path, partition_bytes=1).count() == 2 * len(PAGES)
    (tmp_path / "broken").mkdir()
    whole = warc.member({"record_type": "response"}, b"payload" * 100, 6)
    (tmp_path / "broken" / "a.warc.gz").write_bytes(whole + whole[:60])
    with pytest.raises(PythonException, match=f"record at byte {len(whole)}"):
        warc.read_warc(spark, str(tmp_path / "broken")).collect()


# Spelling variants

def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


@pytest.mark.parametrize("letters", ["ab", "abcdé", "aÿ"])
def test_sorted_list_scan(letters):
    draw = random.Random(letters)
    for longest in (3, 6, 9):
        words = sorted({"".join(draw.choices(letters, k=draw.randint(0, longest))) for _ in range(120)})
        keys = np.sort(np.array([draw.randint(0, 1) for _ in words]))
        parts = [w for k in (0, 1) for w in sorted(w for w, own in zip(words, keys, strict=True) if own == k)]
        left, right = variants.SortedList(keys, parts).pairs()
        got = [(keys[a], parts[a], parts[b]) for a, b in zip(left, right, strict=True)]
        want = {(k, a, b) for k in (0, 1) for a in words for b in words if a < b and one_edit(a, b)
                and keys[parts.index(a)] == k == keys[parts.index(b)]}
        assert len(got) == len(set(got)) and set(got) == want


def plain_variants(rows, every=31, shortest=7, least=2, ratio=10):
    n = Counter()
    for own, text in rows:
        run = ""
        for letter in (text or "") + " ":
            if letter.isascii() and letter.isalpha() or "À" <= letter <= "ÿ":
                run += letter.lower() if letter.isascii() else letter
            elif run:
                code = zlib.crc32(f"{'' if own is None else own}:{run}".encode())
                n[run[:code % len(run)] + run[code % len(run) + 1:] if code % every == 0 else run] += 1
                run = ""
    n = {w: c for w, c in n.items() if len(w) >= shortest and c >= least}
    near = {w: sorted((-n[x], x) for x in n if one_edit(w, x)) for w in n}
    form = {w: x[0][1] if x and -x[0][0] >= ratio * n[w] else None for w, x in near.items()}
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def test_variants_equal_the_plain_version(spark):
    draw = random.Random(4)
    stems = ["".join(draw.choices("abÀé", k=draw.randint(6, 12))) for _ in range(30)] + ["aaaaaaaa", "x" * 5_000]
    rows = [(k if k % 9 else None, " ".join(draw.choices(stems, weights=[1 / (i + 1) for i in range(32)], k=80)).title())
            for k in range(60)] + [(1, None), (2, ""), (3, stems[0] + "×÷-" + stems[1].upper())] * 2
    rows += [(k, text) for k in range(100, 112) for text in ("qwertyui " * 900, "qwertyuo " * 30, "qwertypo")]
    table = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, n long, word string").repartition(3)
    want = plain_variants(rows, every=3)
    assert sum(w[1] is not None for w in want) > 20 and any(w[2] not in (w[0], w[1]) for w in want)
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    for bound in (4_096, 3):
        found = variants.spelling_variants(table, every=3, list_words=bound).select(columns).collect()
        assert len(found) == len(want) and {tuple(r) for r in found} == want
    assert variants.spelling_variants(table.limit(0)).collect() == []


# Source divergence

def plain_divergence(rows, least_docs):
    import re
    from itertools import groupby
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]+", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for g, _, w in docs if g == lang for t in set(w))
        kept = sorted(t for t, n in df.items() if n >= least_docs)
        by_source = {s: Counter(t for g, o, w in docs if (g, o) == (lang, s) for t in w) for s in {d[1] for d in docs if d[0] == lang}}
        whole = sum(by_source.values(), Counter())

        def p(counts, t):
            return 1 + 10**9 * (counts[t] + 2) // (sum(counts[x] for x in kept) + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s, counts in by_source.items():
            pairs = [(-sum(f(p(counts, t), p(other, t)) for t in kept), o) for o, other in by_source.items() if o != s]
            terms = [(-f(p(counts, t), p(whole, t)), t) for t in kept if counts[t] and p(counts, t) > p(whole, t)]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out += [(lang, s, part, item, -value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


@pytest.fixture(scope="module")
def sourced():
    draw = random.Random(5)
    words = ["".join(draw.choices("abcDÉ漢", k=draw.randint(1, 4))) for _ in range(60)]
    rows = [(" ".join(draw.choices(words, k=draw.randint(0, 30))) + " 1-x_y", draw.choice(["en", "fr", None, "en"]),
             draw.choice(["s0"] * 6 + [f"s{k}" for k in range(7)] + [None])) for _ in range(150)]
    return rows + [(None, "en", "empty"), (None, "xx", "a"), ("", "xx", "b"), ("one\0two", "a\0b", "s"), (LONG, "en", "s0")] * 2


@pytest.mark.parametrize("small", [False, True])
def test_divergence_equals_the_plain_version(spark, sourced, small, monkeypatch):
    """Also with runs of a few documents, merged in several passes, and with many tiles and parts."""
    options = {"tile_sources": 2, "part_rows": 40, "shards": 3} if small else {}
    if small:
        for name, value in (("HELD", 20_000), ("FAN_IN", 4), ("PIECE", 3), ("PIECES", 2), ("STEP", 10)):
            monkeypatch.setattr(divergence, name, value)
        monkeypatch.setattr(divergence, "in_arrow", by_value)
    table = spark.createDataFrame([(*r, "t", 2) for r in sourced], "text string, lang string, source string, term string, n int").repartition(5)
    found = divergence.source_divergence(table, least_docs=3, **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = sorted(tuple(r) for r in found.collect())
    assert rows == plain_divergence(sourced, 3)
    assert {r[4] for r in rows if r[0] == "xx"} == {0} and sum(r[0] == "xx" for r in rows) == 2


def by_value(frame, run, schema):
    """mapInArrow whose function carries the module's present values to the workers."""
    cloudpickle.register_pickle_by_value(divergence)
    return frame.mapInArrow(run, schema)


def test_divergence_of_an_empty_table(spark):
    assert divergence.source_divergence(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_probabilities_of_large_counts(spark):
    big = spark.createDataFrame([(10**17, 3 * 10**17, 10**6)], "c long, a long, k long")
    assert big.select(divergence._p(F.col("c"), F.col("a"), F.col("k"))).first()[0] == 1 + 10**9 * (10**17 + 2) // (3 * 10**17 + 2 * 10**6)
