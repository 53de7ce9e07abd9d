"""Secret scans with structural confirmation.

Three plain kinds come from fixed patterns: ``assign`` (a named value), ``access`` (a cloud access
id) and ``hex`` (a long run of hexadecimal digits). Three more kinds are reported only after their
structure is decoded and holds together: ``signed_token`` (base64url header and payload that are JSON
objects, the header naming its algorithm), ``key_block`` (an armoured private key whose body decodes
to a key encoding) and ``encoded_key`` (base64 or hexadecimal digits that are a key encoding or hold such an
armoured key; white space and spelled-out line ends may divide them, and a key's own lengths say how many belong to it). A key
encoding is DER whose nested lengths fill their parents exactly and whose members are those of a
known private key form, or an OpenSSH key whose length-prefixed parts fill the value.

Spans count code points, end exclusive. Defined results: null and empty texts hold no secret; texts
are scanned whole; repeated rows keep their rows; spans of different kinds may overlap.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netledger.llm.common import arrow_columns, text_bytes

# The plain kinds, in the order that ties follow, and their patterns (on lower-cased text for assign).
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "signed_token", "key_block", "encoded_key")
_ASSIGN = re.compile(
    rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{32,}")

_SIGNED = re.compile(rb"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{16,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
# Headers of the body may hold hyphens, but not five in a row.
_ARMOUR = re.compile(rb"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----((?:[^-]|-(?!----))*+)-----END \1-----")
_HEADERS_END = re.compile(rb"\n[\x20\t]*\n")

SPANS = T.StructType([T.StructField("secrets", T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType())])))])


def decoded(data: bytes) -> bytes | None:
    """The value of base64 in either alphabet, padded or not."""
    body = data.translate(bytes.maketrans(b"-_", b"+/")).rstrip(b"=")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + b"=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


_MAGIC = b"openssh-key-v1\0"
_GAP = rb"(?:[\x20\t\r\n]|\\[rn])+"


def _spelled(digits: bytes, case: bytes = b"") -> bytes:
    """The pattern of digits that gaps may divide."""
    return case + (rb"(?:%s)?" % _GAP).join(re.escape(bytes([d])) for d in digits)


class _Digits:
    """How one encoding spells bytes: its digits, their bits, and what keys and armour look like in it."""

    def __init__(self, chars: bytes, bits: int, sequence: bytes, after: bytes, more: bytes) -> None:
        self.bits, self.unit = bits, 4 if bits == 6 else 2
        self.piece = re.compile(rb"([%s]+)(?:%s(?=[%s]))?" % (chars, _GAP, chars))
        self.region = re.compile(rb"(?:(?<=\\)[rn])?([%s]+(?:%s[%s]+)*)" % (chars, _GAP, chars))
        self.sequence = re.compile(sequence)
        self.after = re.compile(after)
        self.more = re.compile(more)
        #: The start of an OpenSSH key, and "PRIVATE KEY-----" at each of its places among the digits (digits it fills, digits before).
        self.openssh = re.compile(_spelled(self.encoded(_MAGIC), self.case))
        self.armour = [(re.compile(_spelled(self.encoded(b"\0" * k + b"PRIVATE KEY-----")[first:last], self.case)), first)
                       for k in range(1 if bits == 4 else 3)
                       for first, last in [(-(-8 * k // bits), 8 * (k + 16) // bits)]]

    @property
    def case(self) -> bytes:
        return b"(?i)" if self.bits == 4 else b""

    def encoded(self, value: bytes) -> bytes:
        return value.hex().encode() if self.bits == 4 else base64.b64encode(value).rstrip(b"=")

    def decoded(self, digits: bytes) -> bytes | None:
        if self.bits == 4:
            return bytes.fromhex(digits[:len(digits) // 2 * 2].decode())
        return decoded(digits[:-1] if len(digits) % 4 == 1 else digits)

    def count(self, octets: int) -> int:
        return -(-8 * octets // self.bits)

    def gathered(self, data: bytes, start: int, need: int) -> bytes:
        """Up to ``need`` digits from ``start`` on."""
        out, have, at = [], 0, start
        while have < need and (found := self.piece.match(data, at)):
            out.append(found[1][:need - have])
            have, at = have + len(out[-1]), found.end()
        return b"".join(out)


class _Region:
    """Digits that only gaps divide, decoded once from each shift."""

    def __init__(self, digits: _Digits, data: bytes, start: int, end: int) -> None:
        self.digits, self.end = digits, end
        self.places: list[int] = []  # of the undivided runs: where they start, and the digits before each
        self.counts = [0]
        runs = []
        for found in digits.piece.finditer(data, start, end):
            self.places.append(found.start())
            self.counts.append(self.counts[-1] + len(found[1]))
            runs.append(found[1])
        self.every = b"".join(runs)
        self.values: dict[int, bytes] = {}

    def value(self, shift: int) -> bytes:
        if shift not in self.values:
            self.values[shift] = self.digits.decoded(self.every[shift:]) or b""
        return self.values[shift]

    def number(self, place: int) -> int:
        """The digits before a place in the text."""
        run = bisect_right(self.places, place) - 1
        return self.counts[run] + place - self.places[run]

    def run(self, number: int) -> int:
        return bisect_right(self.counts, number) - 1

    def ends(self, number: int) -> int:
        """Where that many digits end in the text."""
        run = self.run(number - 1)
        return self.places[run] + number - self.counts[run]


# A key starts with a sequence: its tag is 0x30, its length one octet below 0x80 or one of 0x81 to 0x84 before more.
_ENCODINGS = (
    _Digits(rb"A-Za-z0-9+/_-", 6, rb"M(?:(?<![A-Za-z0-9]M)|(?<=\\[rn]M))(?:[A-H]|I[E-T])", rb"={0,2}", rb"[A-Za-z0-9+/_=]|-(?!-)"),
    _Digits(rb"0-9A-Fa-f", 4, rb"30(?<![0-9A-Fa-f]30)(?:[0-7]|8[1-4])", rb"", rb"[0-9A-Fa-f]"))


def _header(data: bytes, place: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value of the element at ``place``; None if it does not fit."""
    if place + 2 > end:
        return None
    tag, size = data[place], data[place + 1]
    place += 2
    if size >= 0x80:
        count = size & 0x7F
        if not 1 <= count <= 4 or place + count > end or data[place] == 0:
            return None
        size = int.from_bytes(data[place:place + count], "big")
        place += count
        if size < 0x80:
            return None
    return (tag, place, place + size) if place + size <= end else None


def _members(data: bytes, place: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill a value exactly."""
    out = []
    while place < end:
        found = _header(data, place, end)
        if found is None:
            return None
        out.append(found)
        place = found[2]
    return out


INTEGER, OCTETS, OBJECT, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_der_key(data: bytes, at: int = 0, end: int | None = None) -> bool:
    end = len(data) if end is None else end
    whole = _header(data, at, end)
    if whole is None or whole[0] != SEQUENCE or whole[2] != end:
        return False
    members = _members(data, whole[1], whole[2])
    if not members:
        return False
    tags = [m[0] for m in members]

    def number(k: int) -> int:
        return int.from_bytes(data[members[k][1]:members[k][2]], "big") if members[k][2] > members[k][1] else -1

    def named(k: int) -> bool:
        inner = _members(data, members[k][1], members[k][2])
        return bool(inner) and inner[0][0] == OBJECT and inner[0][2] > inner[0][1]

    if tags[:9] == [INTEGER] * 9:  # RSA: version, modulus, exponents, primes
        return number(0) in (0, 1) and number(4) > 1 and number(4) * number(5) == number(1)
    if tags == [INTEGER] * 6:  # DSA
        return number(0) == 0
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # any algorithm, named by its identifier
        return number(0) in (0, 1) and named(1)
    if tags == [SEQUENCE, OCTETS]:  # the same, encrypted
        return named(0) and members[1][2] - members[1][1] >= 16
    if tags[:2] == [INTEGER, OCTETS] and all(t in (0xA0, 0xA1) for t in tags[2:]):  # elliptic curve
        return number(0) == 1 and 16 <= members[1][2] - members[1][1] <= 72
    return False


def _openssh_end(data: bytes, at: int = 0) -> int | None:
    """Where the OpenSSH key that starts there ends."""
    if not data.startswith(_MAGIC, at):
        return None
    place, end = at + len(_MAGIC), len(data)

    def part() -> bool:
        nonlocal place
        if place + 4 > end:
            return False
        place += 4 + int.from_bytes(data[place:place + 4], "big")
        return place <= end

    if not all(part() for _ in range(3)) or place + 4 > end:
        return None
    keys = int.from_bytes(data[place:place + 4], "big")
    place += 4
    return place if 1 <= keys <= end // 4 and all(part() for _ in range(keys + 1)) else None


def is_openssh_key(data: bytes) -> bool:
    return _openssh_end(data) == len(data)


def is_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_openssh_key(data))


def _object(data: bytes) -> dict | None:
    value = decoded(data)
    if not value or value[:1] not in (b"{", b" ", b"\n", b"\r", b"\t"):
        return None
    try:
        value = json.loads(value)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _is_signed(found: re.Match[bytes]) -> bool:
    header = _object(found[1])
    if header is None or not isinstance(header.get("alg"), str) or _object(found[2]) is None:
        return False
    return header["alg"].lower() == "none" or bool(decoded(found[3]))


def _armoured(data: bytes) -> list[tuple[int, int]]:
    """The spans of armoured private keys."""
    out: list[tuple[int, int]] = []
    if b"PRIVATE KEY-----" not in data:
        return out
    for found in _ARMOUR.finditer(data):
        # Inside a quoted string the line ends are spelled out.
        body = found[2].replace(b"\\r", b"").replace(b"\\n", b"\n").replace(b"\r", b"")
        headed = b":" in body
        if headed:  # encapsulated headers end at an empty line
            body = _HEADERS_END.split(body.lstrip(), maxsplit=1)[-1]
        value = decoded(b"".join(body.split()))
        # An encrypted body has no inner structure left; its header must name the cipher.
        if is_key(value) or headed and b"DEK-Info:" in found[2] and value:
            out.append(found.span())
    return out


def _keys_in(data: bytes, digits: _Digits) -> list[tuple[int, int]]:
    """The spans of digits that are a key encoding and end where it ends."""
    out: list[tuple[int, int]] = []
    starts = []
    for found in digits.sequence.finditer(data):
        head = digits.decoded(digits.gathered(data, found.start(), digits.count(12))) or b""
        whole = _header(head, 0, len(data)) if len(head) >= 12 else None
        if whole and head[whole[1]] in (INTEGER, SEQUENCE):
            starts.append((found.start(), False))
    starts += [(m.start(), True) for m in digits.openssh.finditer(data)]
    region = None
    for start, openssh in sorted(starts):
        if region is None or start >= region.end:
            region = _Region(digits, data, start, digits.region.match(data, start).end())
        number = region.number(start)
        shift = number % digits.unit
        value, at = region.value(shift), (number - shift) * digits.bits // 8
        if openssh:
            size = _openssh_end(value, at)
        else:
            whole = _header(value, at, len(value))
            size = whole[2] if whole and is_der_key(value, at, whole[2]) else None
        if size is not None:
            end = digits.after.match(data, region.ends(number + digits.count(size - at))).end()
            if not digits.more.match(data, end):
                out.append((start, end))
    return out


def _armour_in(data: bytes, digits: _Digits) -> list[tuple[int, int]]:
    """The spans of digits that hold armoured keys, widened to whole undivided runs."""
    marks = sorted((m.start(), first) for pattern, first in digits.armour for m in pattern.finditer(data))
    out: list[tuple[int, int]] = []
    at = 0
    for found in digits.region.finditer(data) if marks else ():
        if at == len(marks) or found.end() <= marks[at][0]:
            continue
        region, shifts = _Region(digits, data, *found.span(1)), set()
        while at < len(marks) and marks[at][0] < region.end:
            shifts.add((region.number(marks[at][0]) - marks[at][1]) % digits.unit)
            at += 1
        for shift in shifts:
            for a, b in _armoured(region.value(shift)):
                last = region.run(shift + digits.count(b) - 1)
                out.append((region.places[region.run(shift + 8 * a // digits.bits)],
                            digits.after.match(data, region.ends(region.counts[last + 1])).end()))
    return out


def byte_spans(data: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes."""
    out: list[tuple[int, int, str]] = []
    for found in _ASSIGN.finditer(data.lower()):
        if found.end(1) - found.start(1) >= 8:
            out.append((*found.span(), "assign"))
    if b"AKIA" in data:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(data) if m.end() - m.start() >= 16]
    out += [(*m.span(), "hex") for m in _HEX.finditer(data)]
    blocks = _armoured(data)
    out += [(*b, "key_block") for b in blocks]
    for found in _SIGNED.finditer(data):
        if _is_signed(found):
            out.append((*found.span(), "signed_token"))
    keys = {k for digits in _ENCODINGS for k in (*_keys_in(data, digits), *_armour_in(data, digits))}
    out += [(s, e, "encoded_key") for s, e in keys if not any(a <= s and e <= b for a, b in blocks)]
    return out


def spans_of(data: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    found = byte_spans(data)
    if not found:
        return []
    if not data.isascii():
        at, code_points, before = 0, 0, {}
        for place in sorted({p for s, e, _ in found for p in (s, e)}):
            code_points += len(data[at:place].decode())
            at = place
            before[place] = code_points
        found = [(before[s], before[e], k) for s, e, k in found]
    return [(k, s, e) for s, e, k in sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))]


def scan(documents: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with the array ``secrets`` of (kind, start, end)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans_of(t)] if t else []
                          for t in text_bytes(batch, text)], kind)]

    return arrow_columns(documents, compute, SPANS, keep)


def listed(spans: Column) -> Column:
    """The spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(documents: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """Documents whose texts have each secret (overlapping spans as one) replaced by ``mark``."""
    def clean(data: bytes | None) -> str | None:
        if not data:
            return None if data is None else ""
        out, at = [], 0
        for start, end, _ in sorted(byte_spans(data)):
            if end <= at:
                continue
            if start >= at:
                out += [data[at:start], mark.encode()]
            at = end
        return b"".join([*out, data[at:]]).decode() if out else data.decode()

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([clean(t) for t in text_bytes(batch, text)], pa.string())]

    return arrow_columns(documents, compute, T.StructType([T.StructField(text, T.StringType())])).select(
        *[f"`{c}`" for c in documents.columns])
