"""WARC archives as a Python data source: written and read by Spark, a record per row.

Reading: a partition is a list of whole archive files, small ones together. Predicates on the record type and on
other header columns are pushed into the reader. Of each record the header is parsed first; if a predicate excludes it, its payload is
neither decoded nor inflated where the archive says how long the record is (the ``sl`` field of a gzip member, or
Content-Length in a plain archive). Without the option ``payload`` no payload is decoded at all.

Writing: a record per row, each a gzip member of its own with its lengths, in files of about ``file_bytes``. A file counts when the
job has committed: readers take the files that commits list, so attempts that were lost leave nothing that is read. Folders
without commits (archives from elsewhere) are read whole: ``*.warc`` and ``*.warc.gz``.

Paths are those of any store that Arrow opens (local, HDFS, S3, GCS).

Defined results: null payloads are empty, null header values are left out; a null page id is the greatest of its group
and gives a record without one; repeated rows are records each, of equal payloads one is the response; an empty table gives an archive without records; a
record that is no WARC, or ends early, fails with its file and place. Columns besides id, url and payload are not read, whatever their names.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import IO, Any

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not,
                                    StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)

from netledger.llm.common import marked, written
from netledger.operators.dedup import top_one

#: Column -> header of the record.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "content_type": "Content-Type",
           "page_id": "Page-Id", "refers_to_page": "Refers-To-Page-Id"}
#: Columns of numbers: the block's length, and the length of the payload according to the HTTP header.
LENGTHS = ("content_length", "payload_length")
SCHEMA = ", ".join([*(f"{c} string" for c in HEADERS), *(f"{c} long" for c in LENGTHS)])
PAYLOAD = ", payload binary"
BATCH_BYTES = 8 << 20
CHUNK = 1 << 16


class Broken(ValueError):
    """A record that is no WARC or not whole."""


class Plain:
    """The bytes of a plain archive, from one record on."""

    def __init__(self, file: IO[bytes]) -> None:
        self.file = file

    def begin(self) -> bool:
        self.start = self.file.tell()
        return bool(self.file.read(1)) and self.file.seek(self.start) >= 0

    def read(self, count: int) -> bytes:
        return self.file.read(count)

    def leave(self, block: int, taken: int) -> None:
        """Go on behind the block, of which ``taken`` bytes were read, and the two line ends."""
        self.file.seek(block - taken, 1)
        if self.file.read(4) != b"\r\n\r\n":
            raise Broken("the record does not end with its block")


class Members:
    """The bytes of an archive of gzip members, one record each."""

    def __init__(self, file: IO[bytes]) -> None:
        self.file, self.ahead = file, b""

    def begin(self) -> bool:
        self.start = self.file.tell() - len(self.ahead)
        head = self._raw(12)
        if not head:
            return False
        if head[:3] != b"\x1f\x8b\x08":
            raise Broken("no gzip member")
        self.length = None
        if head[3] & 4:
            extra = self._raw(struct.unpack("<H", head[10:12])[0])
            head += extra
            if extra[:4] == b"sl\x08\x00":
                self.length = struct.unpack("<I", extra[4:8])[0]
        self.inflate = zlib.decompressobj(31)
        self.rest, self.raw, self.left = b"", head, None
        return True

    def _raw(self, count: int) -> bytes:
        data = self.ahead[:count]
        self.ahead = self.ahead[count:]
        return data + (self.file.read(count - len(data)) if len(data) < count else b"")

    def read(self, count: int) -> bytes:
        """Up to ``count`` bytes of the record; input is inflated as far as needed."""
        parts = []
        while count and not self.inflate.eof:
            data = self.raw or self._raw(CHUNK)
            if not data:
                raise Broken("the member ends early")
            part = self.inflate.decompress(data, count)
            self.raw = self.inflate.unconsumed_tail
            parts.append(part)
            count -= len(part)
        return b"".join(parts)

    def leave(self, block: int, taken: int) -> None:
        """Go on at the next member; with its length known, nothing more is inflated."""
        if self.length is not None:
            self.file.seek(self.start + self.length)
            self.ahead = b""
            return
        while not self.inflate.eof:
            self.read(CHUNK)
        self.ahead = self.inflate.unused_data + self.ahead


def fields(text: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that begins with a blank continues the one before."""
    found: dict[str, str] = {}
    name = ""
    for line in text.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            found[name] = value.strip()
    return found


def unchunked(data: bytes) -> bytes:
    """The body of a chunked transfer."""
    out, at = [], 0
    while (end := data.find(b"\r\n", at)) >= 0:
        size = int(data[at:end].split(b";")[0], 16)
        if not size:
            break
        out.append(data[end + 2:end + 2 + size])
        at = end + 4 + size
    return b"".join(out)


@dataclass
class Head:
    """A record's header and where its block stands."""

    values: dict[str, Any]
    block: int
    before: bytes


def read_head(source: Plain | Members) -> Head:
    data = source.read(4096)
    while (end := data.find(b"\r\n\r\n")) < 0:
        more = source.read(4096)
        if not more or len(data) > 1 << 20:
            raise Broken("no end of the header")
        data += more
    if not data.startswith(b"WARC/"):
        raise Broken("no WARC header")
    header = fields(data[:end])
    if "content-length" not in header:
        raise Broken("no Content-Length")
    block = int(header["content-length"])
    before = data[end + 4:]
    values: dict[str, Any] = {c: header.get(h.lower()) for c, h in HEADERS.items()}
    return Head(values | {"content_length": block, "payload_length": None}, block, before)


def read_http(source: Plain | Members, head: Head) -> dict[str, str] | None:
    """The HTTP header of the block, if it holds one; the bytes behind it are left in ``before``."""
    if not (head.values["content_type"] or "").startswith("application/http"):
        return None
    held = head.before
    while (end := held.find(b"\r\n\r\n")) < 0 and len(held) < min(head.block, 1 << 20):
        held += (more := source.read(4096))
        if not more:
            break
    head.before = held
    if end < 0 or end + 4 > head.block:
        return None
    http = fields(held[:end])
    head.before, head.block = held[end + 4:], head.block - end - 4
    if (http.get("content-length") or "").isdigit():
        head.values["payload_length"] = int(http["content-length"])
    return http


def keeps(condition: Filter, values: dict[str, Any]) -> bool:
    """Whether a record with these header values can pass, as SQL judges it (unknown does not pass)."""
    if isinstance(condition, Not):
        inner = condition.child
        column = inner.attribute[0]
        return (values[column] is not None or isinstance(inner, (IsNull, IsNotNull, EqualNullSafe))) and not keeps(inner, values)
    value = values[condition.attribute[0]]
    if isinstance(condition, IsNull):
        return value is None
    if isinstance(condition, IsNotNull):
        return value is not None
    if isinstance(condition, EqualNullSafe):
        return value == condition.value
    if value is None:
        return False
    if isinstance(condition, In):
        return value in condition.value
    compare = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
               LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, StringStartsWith: str.startswith,
               StringEndsWith: str.endswith, StringContains: lambda a, b: b in a}[type(condition)]
    # Text is ordered by its UTF-8 bytes, which for text without surrogates is the order of code points.
    return condition.value is not None and compare(value, condition.value)


COMPARED = (EqualTo, EqualNullSafe, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringStartsWith, StringEndsWith,
            StringContains, IsNull, IsNotNull, In)


def pushable(condition: Filter) -> bool:
    """Predicates on one header column that do not need the block; ``Not`` of an In list with nulls stays with Spark."""
    if isinstance(condition, Not):
        return pushable(condition.child) and not (isinstance(condition.child, In) and None in condition.child.value)
    return isinstance(condition, COMPARED) and len(condition.attribute) == 1 and condition.attribute[0] in (*HEADERS, "content_length")


def records(file: IO[bytes], name: str, filters: Iterable[Filter], payload: bool) -> Iterator[dict[str, Any]]:
    """The records of one archive whose headers pass; blocks of others are skipped."""
    source = Members(file) if name.endswith(".gz") else Plain(file)
    while True:
        try:
            if not source.begin():
                return
            head = read_head(source)
            block = head.block
            taken = len(head.before)
            if all(keeps(f, head.values) for f in filters):
                http = read_http(source, head)
                taken = len(head.before) + block - head.block
                if payload:
                    while len(head.before) < head.block:
                        more = source.read(head.block - len(head.before))
                        if not more:
                            raise Broken("the block ends early")
                        head.before += more
                        taken += len(more)
                    body = head.before[:head.block]
                    chunked = (http or {}).get("transfer-encoding", "").lower() == "chunked"
                    head.values["payload"] = unchunked(body) if chunked else body
                yield head.values
            source.leave(block, taken)
        except (Broken, ValueError, zlib.error, struct.error) as fault:
            raise ValueError(f"{name}, record at byte {source.start}: {fault}") from fault


@dataclass
class Files(InputPartition):
    """Whole files of one partition."""

    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.payload = options["path"], options.get("payload", "true").lower() == "true"
        self.together = int(options.get("partition_bytes", 128 << 20))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for condition in filters:
            if pushable(condition):
                self.filters.append(condition)
            else:
                yield condition

    def partitions(self) -> list[Files]:
        """Small files together, so that a partition has about ``partition_bytes``."""
        store, root = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        sizes = {f.path: f.size for f in found if f.type == fs.FileType.File and f.path.endswith((".warc", ".warc.gz"))}
        listed = [f.path for f in found if f.base_name.startswith("_commit-")]
        if listed:
            names: list[str] = []
            for commit in listed:
                with store.open_input_stream(commit) as file:
                    names += [f"{root.rstrip('/')}/{n}" for n in json.loads(file.read())]
            if absent := [n for n in names if n not in sizes]:
                raise FileNotFoundError(f"{self.path}: committed archives are missing: {absent[:5]}")
            sizes = {n: sizes[n] for n in names}
        out: list[Files] = []
        held = self.together
        for name in sorted(sizes):
            if held + sizes[name] > self.together:
                out.append(Files([]))
                held = 0
            out[-1].names.append(name)
            held += sizes[name]
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        schema = pa.schema([*((c, pa.string()) for c in HEADERS), *((c, pa.int64()) for c in LENGTHS),
                            *([("payload", pa.binary())] if self.payload else [])])
        rows, held = [], 0
        for name in partition.names:
            with store.open_input_file(name) as file:
                for row in records(file, name, self.filters, self.payload):
                    rows.append(row)
                    held += 300 + len(row.get("payload") or b"")
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


@dataclass
class Written(WriterCommitMessage):
    """The files of one task."""

    names: list[str]


def member(values: dict[str, Any], payload: bytes, level: int) -> bytes:
    """A record as a gzip member that tells its own lengths.

    A response holds its payload behind an HTTP header, a revisit the HTTP header alone.
    """
    length = values.get("payload_length")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload) if length is None else length}\r\n\r\n").encode()
    block = http + payload
    lines = ["WARC/1.1"]
    for column, name in {**HEADERS, "profile": "WARC-Profile"}.items():
        if values.get(column) is not None:
            lines.append(f"{name}: " + " ".join(str(values[column]).split()))
    text = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    body = text + block + b"\r\n\r\n"
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    data = deflate.compress(body) + deflate.flush()
    # Header of 10 bytes, extra field of 2 + 12, data, checksum and size of 8.
    total = 24 + len(data) + 8
    known = total < 1 << 32 and len(body) < 1 << 32
    extra = struct.pack("<H2sHII", 12, b"sl", 8, total, len(body)) if known else b""
    head = b"\x1f\x8b\x08" + (b"\x04" if known else b"\0") + bytes(5) + b"\xff"
    return head + extra + data + struct.pack("<II", zlib.crc32(body), len(body) & 0xFFFFFFFF)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        if overwrite:
            raise ValueError("archives are only added to; write to a new folder")
        self.path, self.level = options["path"], int(options.get("level", 6))
        self.file_bytes = int(options.get("file_bytes", 128 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        names: list[str] = []
        file, held = None, 0
        try:
            for batch in iterator:
                for k in range(batch.num_rows):
                    row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                    if file is None or held > self.file_bytes:
                        if file is not None:
                            file.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        file, held = store.open_output_stream(f"{root.rstrip('/')}/{names[-1]}", compression=None), 0
                    held += file.write(member(row, row.pop("payload") or b"", self.level))
        finally:
            if file is not None:
                file.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root.rstrip('/')}/_commit-{uuid.uuid4().hex}.json", compression=None) as file:
            file.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        for name in (n for m in messages if m for n in m.names):
            store.delete_file(f"{root.rstrip('/')}/{name}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA + (PAYLOAD if self.options.get("payload", "true").lower() == "true" else "")

    def reader(self, schema: Any) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: Any, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def _located(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def register(spark: SparkSession) -> None:
    """Make the format ``warc`` known; its code travels with the plan, so workers need not have this package."""
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, payload: bool = True, **options: Any) -> DataFrame:
    """The committed records below ``path``; filters on header columns reach the reader."""
    register(spark)
    return spark.read.format("warc").options(path=_located(path), payload=str(payload).lower(), **options).load()


def write_warc(rows: DataFrame, path: str, **options: Any) -> None:
    """Add records: any of the header columns, and ``payload``."""
    register(rows.sparkSession)
    rows.write.format("warc").mode("append").options(path=_located(path), **options).save()


def _uuid(*parts: Column) -> Column:
    """A record id that the same parts give again."""
    text = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    cut = [F.substring(text, *at) for at in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 100,
            **options: Any) -> None:
    """Write a record per row: a response, or a revisit of the response with an equal payload of at least ``least`` bytes.

    Of equal payloads the row with the smallest id (then url) is the response; of rows alike in all of these, one. Only rows whose digest may
    be shared are exchanged, with the digests that are; a payload that much of the table shares is one row of that side.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{page_id}`").alias("page"), F.col(f"`{url}`").cast("string").alias("target_uri"), body.alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size"),
                       F.struct(F.col("page").isNull().alias("unnamed"), "page", "target_uri").alias("own"))
    alike = rows.filter(F.col("size") >= least).groupBy("digest", "own").agg(F.count("*").alias("alike"))
    shared = written(alike.groupBy("digest").agg(F.min(F.struct("own", "alike")).alias("least"), F.sum("alike").alias("rows"))
                     .filter("rows > 1").select("digest", F.col("least.own").alias("first"), F.col("least.alike").alias("alike")), "shared")
    judged = marked(rows, "digest", shared, "digest", "may")
    joined = judged.filter("may").join(shared, "digest", "left")
    first = F.col("own") == F.col("first")
    single = joined.filter(F.col("first").isNull() | ~first | (F.col("alike") == 1)).withColumn(
        "revisits", F.col("first").isNotNull() & ~first)
    out = _headed(single.unionByName(judged.filter("NOT may").withColumns(
        {"first": F.lit(None).cast(shared.schema["first"].dataType), "alike": F.lit(1).cast("long"), "revisits": F.lit(False)})))
    several = shared.filter("alike > 1")
    if not several.isEmpty():
        one = top_one(judged.filter("may").join(several, "digest").filter(first), ["digest"], [F.col("size").asc()])
        out = out.unionByName(_headed(one.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("alike"))))
                                      .withColumn("revisits", F.col("number") > 1).drop("number")))
    write_warc(out, path, **options)


def _headed(rows: DataFrame) -> DataFrame:
    """The columns of a record from those of a page and its decision."""
    revisits = F.col("revisits")

    def named(page: Column) -> Column:
        return _uuid(F.lit("response"), F.col("digest"), page)

    answered = F.col("first").isNotNull() & ~revisits
    return rows.select(
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(answered, named(F.col("page"))).otherwise(F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))).alias("record_id"),
        "target_uri", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"), F.when(revisits, named(F.col("first.page"))).alias("refers_to"),
        F.lit("application/http; msgtype=response").alias("content_type"), F.col("page").cast("string").alias("page_id"),
        F.when(revisits, F.col("first.page").cast("string")).alias("refers_to_page"),
        F.when(revisits, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")).alias("profile"),
        F.col("size").cast("long").alias("payload_length"), F.when(~revisits, F.col("payload")).alias("payload"))
