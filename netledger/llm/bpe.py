"""Exact byte-level BPE with a backtracking encoder, and decoding through an offset table.

A text is cut into the vocabulary's added tokens and, between them, into pieces by the pattern that
byte-level vocabularies of this kind fix. In a piece, one Aho-Corasick pass finds the longest token
at each byte. The encoder takes longest tokens from left to right; two neighbours must be compatible,
which means that merging by rank would leave exactly this border between them. If no token fits, it
steps back one token and marks the place, so each place fails once and the work is linear. Decoding
gathers the tokens' bytes from one flat array by an offset table.

Defined results: null is an empty text without tokens; texts of any length are encoded whole (memory is
a small multiple of the longest text); repeated rows keep their rows. Pieces are cached per worker
process, and the cache is emptied at ``CACHE_CHARS`` characters.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from netledger.llm.common import arrow_columns, keeps, text_bytes

CACHE_CHARS = 8_000_000
# Fixed value: the piece pattern of this vocabulary family.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same pattern for texts of Latin script below U+0250, where the classes are short, and what such a
# text may not hold: other characters, numbers besides 0-9, and controls that the modules class differently.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_LATIN = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")
_OTHER = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0250-\U0010ffff]")

ENCODED = T.StructType([T.StructField("token_ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])
DIGESTS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                        T.StructField("decoded_sha256", T.StringType())])


def _byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Flat:
    """Byte strings by number in one array with an offset table."""

    def __init__(self, values: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(values), np.uint8)
        self.size = np.array([len(v) for v in values], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def join(self, numbers: np.ndarray) -> bytes:
        return gather(self.data, self.start[numbers], self.size[numbers]).tobytes()


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """data[start:start+size] of all entries, one after another."""
    before = np.cumsum(size) - size
    return data[np.repeat(start - before, size) + np.arange(int(size.sum()))]


class _Known(dict):
    """Numbers of pieces; a new piece is encoded when it is first asked for."""

    def __init__(self, learn: Callable[[str], int]) -> None:
        super().__init__()
        self.learn = learn

    def __missing__(self, piece: str) -> int:
        return self.learn(piece)


class Bpe:
    """Encoder and decoder of one vocabulary file of the tokenizers library."""

    def __init__(self, content: str) -> None:
        parsed = json.loads(content)
        names = _byte_names()
        vocabulary = {bytes(names[c] for c in k): v for k, v in parsed["model"]["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.count = 1 + max([*vocabulary.values(), *self.added.values()])
        self.spelled = [b""] * self.count
        for token, number in vocabulary.items():
            self.spelled[number] = token
        for token, number in self.added.items():
            self.spelled[number] = token.encode()
        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.whole: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(parsed["model"]["merges"]):
            left, right = (bytes(names[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            number = vocabulary[left + right]
            self.whole[vocabulary[left], vocabulary[right]] = number
            self.rank.setdefault(number, rank)
            self.halves.setdefault(number, (vocabulary[left], vocabulary[right]))
        self.find = ahocorasick.Automaton()
        for token, number in vocabulary.items():
            self.find.add_word(token.decode("latin-1"), (len(token) - 1, number))
        self.find.make_automaton()
        self.shorter = {}
        for token, number in vocabulary.items():
            cut = len(token) - 1
            while cut and token[:cut] not in vocabulary:
                cut -= 1
            self.shorter[number] = vocabulary[token[:cut]] if cut else None
        self.length = [len(x) for x in self.spelled]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pattern = regex.compile(PIECES)
        self.special = regex.compile("|".join(regex.escape(x) for x in sorted(self.added, key=len, reverse=True))) \
            if self.added else None
        self.text = Flat(self.spelled)
        self.digits = Flat([b"%d," % i for i in range(self.count)])
        self.forget()

    def forget(self) -> None:
        self.known = _Known(self._learn)
        self.known_chars = 0
        self.pool, self.start, self.size = array("i"), array("q"), array("i")

    def fits(self, left: int, right: int) -> bool:
        """Whether merging by rank keeps the border between the two tokens.

        Undoing merges latest first on either side of the border shows every pair of neighbours that
        stood there. The border falls if one of these pairs merges before the merge that ended it.
        """
        if len(self.pairs) > 500_000:
            self.pairs.clear()
        known = self.pairs[left, right] = self._border(left, right)
        return known

    def _border(self, left: int, right: int) -> bool:
        rank, halves, whole = self.rank, self.halves, self.whole
        ended = 1 << 60  # rank and side of the merge that replaced this pair of neighbours
        while True:
            joined = whole.get((left, right))
            if joined is not None and rank[joined] * 2 < ended:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            # Merges of equal rank run from left to right: the left one first.
            if a > b:
                ended, left = a * 2, halves[left][1]
            else:
                ended, right = b * 2 + 1, halves[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        spelled, pairs = piece.decode("latin-1"), self.pairs
        # Where the longest tokens, taken from the left, are compatible, they are the answer.
        out = [x[1] for _, x in self.find.iter_long(spelled)]
        left = -1
        for right in out:
            if left >= 0 and not (pairs[left, right] if (left, right) in pairs else self.fits(left, right)):
                break
            left = right
        else:
            return out
        longest: list[int | None] = [None] * len(piece)
        for end, (before, number) in self.find.iter(spelled):
            longest[end - before] = number  # of one start, the longer ones end later
        out, length, shorter = [], self.length, self.shorter
        dead = bytearray(len(piece) + 1)
        place, token = 0, longest[0]
        while place < len(piece):
            while token is not None:
                end = place + length[token]
                if not dead[end]:
                    if not out:
                        break
                    pair = (out[-1], token)
                    if pairs[pair] if pair in pairs else self.fits(*pair):
                        break
                token = shorter[token]
            if token is None:
                dead[place] = 1
                token = out.pop()
                place -= length[token]
            else:
                out.append(token)
                place = end
                token = longest[end] if end < len(piece) else None
        return out

    def _learn(self, piece: str) -> int:
        tokens = self.encode_piece(piece.encode())
        number = self.known[piece] = len(self.start)
        self.start.append(len(self.pool))
        self.size.append(len(tokens))
        self.pool.extend(tokens)
        self.known_chars += len(piece) + 20
        return number

    def _plain(self, text: str) -> np.ndarray:
        if self.known_chars > CACHE_CHARS:
            self.forget()
        pieces = (self.pattern if _OTHER.search(text) else _LATIN).findall(text)
        numbers = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        if not pieces:
            return np.zeros(0, np.int32)
        start, size = np.frombuffer(self.start, np.int64), np.frombuffer(self.size, np.int32)
        return gather(np.frombuffer(self.pool, np.int32), start[numbers], size[numbers].astype(np.int64))

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text; added tokens in it become their ids."""
        parts: list[np.ndarray] = []
        place = 0
        for found in self._specials(text):
            parts += [self._plain(text[place:found.start()]), np.array([self.added[found.group()]], np.int32)]
            place = found.end()
        parts.append(self._plain(text[place:] if place else text))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def _specials(self, text: str) -> Iterator:
        if self.special is None or not any(x in text for x in self.added):
            return iter(())
        return self.special.finditer(text)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.text.join(ids)

    def listed(self, ids: np.ndarray) -> bytes:
        """The ids as decimals joined by commas."""
        return self.digits.join(ids)[:-1]


_BUILT: dict[str, Bpe] = {}


def _bpe(content: str) -> Bpe:
    key = hashlib.sha256(content.encode()).hexdigest()
    keeps(_BUILT.clear)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Bpe(content)
    return _BUILT[key]


def _sent(frame: DataFrame, path: str):
    """The vocabulary file, a few MB, goes to every executor; only the driver opens the path."""
    with open(path, encoding="utf-8") as file:
        return frame.sparkSession.sparkContext.broadcast(file.read())


def encode(documents: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with token_ids (little-endian int32, packed) and n_tokens."""
    content = _sent(documents, path)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        bpe = _bpe(content.value)
        ids = [bpe.encode((t or b"").decode()) for t in text_bytes(batch, text)]
        return [pa.array([x.astype("<i4").tobytes() for x in ids], pa.binary()),
                pa.array([len(x) for x in ids], pa.int64())]

    return arrow_columns(documents, compute, ENCODED, keep)


def decode(encoded: DataFrame, path: str, ids: str = "token_ids", into: str = "decoded",
           keep: list[str] | None = None) -> DataFrame:
    """Texts of packed token ids; bytes that are not UTF-8 become U+FFFD, null ids stay null."""
    content = _sent(encoded, path)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        bpe = _bpe(content.value)
        return [pa.array([None if x is None else bpe.decode(np.frombuffer(x, "<i4")).decode("utf-8", "replace")
                          for x in batch.column(ids).to_pylist()], pa.string())]

    return arrow_columns(encoded, compute, T.StructType([T.StructField(into, T.StringType())]), keep)


def round_trip(documents: DataFrame, path: str, text: str = "text", keep: list[str] | None = None,
               with_ids: bool = False) -> DataFrame:
    """Digests of a whole text's ids and of what they decode to; ``with_ids`` adds the packed token_ids."""
    content = _sent(documents, path)
    fields = T.StructType(DIGESTS.fields + ENCODED.fields[:1]) if with_ids else DIGESTS

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        bpe = _bpe(content.value)
        counts, ids, texts, packed = [], [], [], []
        for data in text_bytes(batch, text):
            tokens = bpe.encode((data or b"").decode())
            counts.append(len(tokens))
            packed.append(tokens.astype("<i4").tobytes() if with_ids else None)
            ids.append(hashlib.sha256(bpe.listed(tokens)).hexdigest())
            texts.append(hashlib.sha256(bpe.decode(tokens).decode("utf-8", "replace").encode()).hexdigest())
        made = [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
        return [*made, pa.array(packed, pa.binary())] if with_ids else made

    return arrow_columns(documents, compute, fields, keep)
