"""Quality rules by distribution divergence.

The corpus gives each language two references: the histogram of character classes and the frequencies
of its ``common`` most frequent words (all other words are one bin). A document is compared with the
reference of its language by Jensen-Shannon distance (0: same, 1: disjoint); one whose language is
null or has no reference is compared with all, and the nearest counts. A text without one common word is no
further than the reference's own bins allow, so two more rules judge the words, both by length: a document lacks its
reference's words if their share is below ``min_share`` of the reference's and ``noise`` standard deviations (of a
text of its length drawn from the reference) below it; and it is nearer to another reference if the likelihood ratio of its
words is above exp(``margin``). A word outside a reference's common ones counts there as its least common one. Guards: the classes are judged from ``min_chars``
characters on, the words from ``min_words`` words on, because short texts diverge by chance; a language needs
``min_reference`` words to be a reference.

Counts cover all documents; they are summed per task and then per key, so no language or word is gathered.
Only the references (classes + common words per language) reach the driver.

Defined results: null or empty texts have zero counts and fail the word minimum; very long texts are
read whole; repeated rows keep their rows; without any reference no document diverges.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netledger.llm.common import arrow_columns, gram_hashes, hashed, in_arrow, text_bytes

_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = b"#*$%&|<>"  # fixed value
#: Class of each byte; continuation bytes are no character.
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "mark", "control", "latin", "wide")


def _class(byte: int) -> int:
    char = chr(byte)
    if byte >= 0x80:
        return -1 if byte < 0xC0 else 8 if byte < 0xCE else 9
    if char.isalpha():
        return 0 if char.islower() else 1
    if char.isdigit():
        return 2
    if byte in (0x0A, 0x0D):
        return 4
    if byte in (0x20, 0x09):
        return 3
    if byte < 0x20 or byte == 0x7F:
        return 7
    return 5 if char in ".,;:!?'\"()-" else 6


_FOLD = np.zeros((256, len(CLASSES)))
for _byte in range(256):
    if _class(_byte) >= 0:
        _FOLD[_byte, _class(_byte)] = 1

COUNTS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
RULES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField(n, T.BooleanType()) for n in ("base_failed", "kept")]
    + [T.StructField(n, T.DoubleType()) for n in ("class_distance", "word_distance")])


def classes_of(data: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _FOLD


def distance(found: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms that are not empty."""
    p, q = found / found.sum(), reference / reference.sum()
    m = (p + q) / 2

    def against(x: np.ndarray) -> float:
        some = x > 0
        return float((x[some] * np.log2(x[some] / m[some])).sum())

    return max(0.0, (against(p) + against(q)) / 2) ** 0.5


def references(documents: DataFrame, text: str = "text", lang: str = "lang", common: int = 100,
               min_reference: int = 1000) -> list[dict]:
    """Per language its class counts, its most frequent words with counts, and its number of words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}
        for batch in batches:
            for data, language in zip(text_bytes(batch, text), batch.column(lang).to_pylist(), strict=True):
                if data and language is not None:
                    words.setdefault(language, Counter()).update(data.split())
                    classes[language] = classes.get(language, 0) + classes_of(data)
                    if sum(map(len, words.values())) > 150_000:
                        yield from flush(words, classes)
        yield from flush(words, classes)

    def flush(words: dict[str, Counter], classes: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for language, counts in words.items():
            yield rows(language, "word", list(counts), list(counts.values()))
            yield rows(language, "class", [b"%d" % i for i in range(len(CLASSES))], classes[language])
            yield rows(language, "total", [b""], [sum(counts.values())])
        words.clear()
        classes.clear()

    def rows(language: str, kind: str, keys: list[bytes], numbers) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([language] * len(keys), pa.string()), pa.array([kind] * len(keys), pa.string()),
             pa.array(keys, pa.binary()), pa.array(np.asarray(numbers, np.int64))], COUNTS.names)

    counts = in_arrow(documents.select(text, lang), count, COUNTS).groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    most = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "word")
    top = (counts.withColumn("place", F.row_number().over(most)).filter(F.col("place") <= max(common, len(CLASSES)))
           .filter((F.col("kind") != "word") | (F.col("place") <= common)))
    out: dict[str, dict] = {}
    for row in top.collect():
        entry = out.setdefault(row["lang"], {"lang": row["lang"], "classes": [0] * len(CLASSES), "words": {}, "total": 0})
        if row["kind"] == "class":
            entry["classes"][int(row["word"])] = row["n"]
        elif row["kind"] == "word":
            entry["words"][bytes(row["word"])] = row["n"]
        else:
            entry["total"] = row["n"]
    return sorted((e for e in out.values() if e["total"] >= min_reference), key=lambda e: e["lang"])


def repeated_words(hashes: np.ndarray, size: int = 5) -> int:
    """Words in windows of ``size`` words found twice or more (told apart by 64-bit hashes)."""
    grams = gram_hashes(hashes, size)
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = np.unique(twice)
    place = np.minimum(np.searchsorted(twice, grams), len(twice) - 1)
    covered = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(twice[place] == grams)
    covered[starts] += 1  # a start stands once, so plain assignment adds
    np.subtract.at(covered, starts + size, 1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def repeated_lines(data: bytes) -> int:
    lines = [x for x in data.split(b"\n") if x.strip(_SPACES)]
    return len(lines) - len(set(lines))


class _Model:
    def __init__(self, references: list[dict]) -> None:
        self.place = {r["lang"]: i for i, r in enumerate(references)}
        self.classes = [np.array(r["classes"], float) for r in references]
        self.common: list[dict[bytes, int]] = [{w: i for i, w in enumerate(r["words"])} for r in references]
        self.words = [np.array([*r["words"].values(), r["total"] - sum(r["words"].values())], float) for r in references]
        self.share = np.array([sum(r["words"].values()) / r["total"] for r in references])
        self.every = {w: k for k, w in enumerate(sorted({w for r in references for w in r["words"]}))}
        self.own = np.zeros((len(references), len(self.every)), bool)
        self.log = np.zeros((len(references), len(self.every) + 1))  # the last for all other words
        for i, r in enumerate(references):
            least = min(r["words"].values())
            numbers = np.full(len(self.every) + 1, float(least))
            for word, n in r["words"].items():
                self.own[i, self.every[word]] = True
                numbers[self.every[word]] = n
            numbers[-1] = max(r["total"] - numbers[:-1].sum(), least)
            self.log[i] = np.log(numbers / numbers.sum())

    def distances(self, language: str | None, data: bytes, words: list[bytes], judged: tuple[bool, bool]) -> tuple:
        which = [self.place[language]] if language in self.place else range(len(self.classes))
        by_class = by_word = None
        if judged[0]:
            found = classes_of(data)
            by_class = min((distance(found, self.classes[i]) for i in which), default=None)
        if judged[1]:
            counts, total = Counter(words), len(words)
            for i in which:
                bins = np.zeros(len(self.words[i]))
                for word, k in self.common[i].items():
                    bins[k] = counts.get(word, 0)
                bins[-1] = total - bins.sum()
                near = distance(bins, self.words[i])
                by_word = near if by_word is None else min(by_word, near)
        return by_class, by_word

    def foreign(self, language: str | None, words: list[bytes], min_share: float, noise: float, margin: float) -> bool:
        """Whether the words are too few of the reference's, or nearer to another one."""
        if not self.common:
            return False
        counts, total = Counter(words), len(words)
        found = np.zeros(len(self.every) + 1)
        for word in counts.keys() & self.every.keys():
            found[self.every[word]] = counts[word]
        found[-1] = total - found.sum()
        limit = np.minimum(min_share * self.share, self.share - noise * (self.share * (1 - self.share) / total) ** 0.5)
        few = self.own @ found[:-1] < limit * total
        if language not in self.place:
            return bool(few.all())
        fits = self.log @ found
        return bool(few[self.place[language]] or fits.max() - fits[self.place[language]] > margin)


def quality(documents: DataFrame, text: str = "text", lang: str = "lang", max_class: float = 0.33, max_word: float = 0.55,
            min_chars: int = 200, min_words: int = 50, common: int = 100, min_reference: int = 1000,
            keep: list[str] | None = None, min_share: float = 0.5, noise: float = 4.0, margin: float = 10.0) -> DataFrame:
    """Documents with their counts, both distances (null below the guards), base_failed and kept."""
    model = _Model(references(documents, text, lang, common, min_reference))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        columns: list[list] = [[] for _ in RULES.names]
        for data, language in zip(text_bytes(batch, text), batch.column(lang).to_pylist(), strict=True):
            data = data or b""
            words = data.split()
            in_words = sum(map(len, words))
            if not data.isascii():
                in_words -= int((np.frombuffer(data, np.int8) < -64).sum())
            repeats = repeated_words(hashed(words)) if len(words) > 5 else 0
            failed = len(words) < 10 or 100 * repeats > 20 * len(words)
            by_class, by_word = model.distances(language, data, words, (len(data) >= min_chars, len(words) >= min_words))
            kept = not failed and not (by_class or 0) > max_class and not (by_word or 0) > max_word
            kept = kept and not (len(words) >= min_words and model.foreign(language, words, min_share, noise, margin))
            for column, value in zip(columns, (
                    len(words), in_words, len(data) - len(data.translate(None, _SYMBOLS)), repeated_lines(data),
                    repeats, failed, kept, by_class, by_word), strict=True):
                column.append(value)
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
        return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]

    return arrow_columns(documents, compute, RULES, keep)
