"""Language identification of mixed text: script ranges, per-word scores, Viterbi with a switching penalty.

Training counts, per language of labelled documents, the hashed character n-grams (1 to 4 bytes and the whole word) of
all words, and the scripts of words. A word's script narrows its candidates to the languages that use that script
for at least ``min_share`` of their words; a candidate's score is the mean log probability of the word's n-grams times
``weight``. Viterbi over the words then labels spans: leaving a language costs ``penalty``.

Most texts are of one language. One label for all words is the best path whenever no run of words gains more than
``penalty`` elsewhere, which a running sum tells; the step-by-step recursion runs for all other texts.

Counts are summed per task and then per key. The model (languages x ``buckets``) is what reaches the driver and the
tasks; any number of languages, each with as many numbers in the model.

Defined results: null texts, and texts without a letter, are ``und`` with score 0 and no span; words are runs of letters and of characters
beyond ASCII, and those without a letter take the label of their span and do not count; repeated rows keep their rows; without training rows all is ``und``.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netledger.llm.common import Words, arrow_columns, in_arrow, mixed, text_bytes

# First code points of script ranges (Unicode blocks): fixed values.
SCRIPT_STARTS = (0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0900, 0x0E00, 0x10A0, 0x1100, 0x1E00, 0x1F00, 0x2000,
                 0x3040, 0x3100, 0xAC00, 0xD7B0)
SCRIPT_NAMES = ("latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "southeast", "georgian", "hangul",
                "latin", "greek", "other", "kana", "han", "hangul", "other")
SCRIPTS = tuple(dict.fromkeys(SCRIPT_NAMES))
_SCRIPT = [SCRIPTS.index(n) for n in SCRIPT_NAMES]

LABELS = T.StructType([
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("lang_spans", T.ArrayType(T.StructType([
        T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
        T.StructField("lang", T.StringType())])))])


# Words are runs of letters and of characters beyond ASCII; A-Z in lower case.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words_of(data: bytes | None) -> list[bytes]:
    return data.translate(_FOLD).split() if data else []


def spelled(word: bytes) -> tuple[bytes, int]:
    """A word's letters in lower case, and its script; no bytes and -1 without a letter."""
    if word.isascii():
        return word, 0
    text = word.decode("utf-8", "replace").lower()
    if not text.isalpha():
        text = "".join(c for c in text if c.isalpha())
    letter = next((c for c in text if c > "\x7f"), "a" if text else "")
    return text.encode(), _SCRIPT[bisect_right(SCRIPT_STARTS, ord(letter)) - 1] if letter else -1


def features(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words, and how many each word has (words must not be empty)."""
    padded = [b" " + w + b" " for w in words]
    size = np.array([len(w) for w in padded], np.int64)
    data = np.frombuffer(b"".join(padded), np.uint8).astype(np.uint64)
    count = len(data)
    word = np.repeat(np.arange(len(words)), size)
    end = np.cumsum(size)[word]
    place, kinds, value = np.arange(count), [], np.zeros(count, np.uint64)
    for length in range(1, 5):
        value = value.copy()
        value[:count - length + 1] = value[:count - length + 1] * np.uint64(257) + data[length - 1:] + np.uint64(1)
        whole = place + length <= end
        kinds.append((word[whole], mixed(value[whole] * np.uint64(8) + np.uint64(length))))
    sums = np.zeros(count + 1, np.uint64)
    np.cumsum(mixed(data + (place - (end - size[word])).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), out=sums[1:])
    kinds.append((np.arange(len(words)), mixed(sums[np.cumsum(size)] - sums[np.cumsum(size) - size])))
    owner, found = (np.concatenate(x) for x in zip(*kinds, strict=True))
    order = np.argsort(owner, kind="stable")
    return (found[order] % np.uint64(buckets)).astype(np.int64), np.bincount(owner, minlength=len(words))


#: Distinct words whose n-grams are held at once.
PART = 10_000


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", buckets: int = 1 << 15,
          smoothing: float = 0.1) -> dict:
    """The model: languages, log probabilities per bucket, and the share of each script per language.

    It has ``buckets`` numbers per language, whatever the size of the corpus; a language is one packed row of what the driver gathers.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages: dict[str, int] = {}
        numbers = Words(6_000_000)
        totals: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            known = [spelled(w) for w in numbers]
            some = np.array([i for i, (w, _) in enumerate(known) if w], np.int64)
            sums = {language: np.zeros(buckets + len(SCRIPTS)) for language in languages}
            for at in range(0, len(some), PART):
                part = some[at:at + PART]
                found, sizes = features([known[i][0] for i in part], buckets)
                scripts = np.array([known[i][1] for i in part])
                for language, place in languages.items():
                    times = totals[place][part]
                    sums[language][:buckets] += np.bincount(found, weights=np.repeat(times, sizes), minlength=buckets)
                    sums[language][buckets:] += np.bincount(scripts, weights=times, minlength=len(SCRIPTS))
            for language, values in sums.items():
                key = np.flatnonzero(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(key)), pa.array(key), pa.array(values[key].astype(np.int64))], ["lang", "key", "n"])
            numbers.forget()
            languages.clear()
            totals.clear()

        for batch in batches:
            for data, language in zip(text_bytes(batch, text), batch.column(lang).to_pylist(), strict=True):
                if not data or language is None:
                    continue
                found = numbers.numbers(words_of(data))
                place = languages.setdefault(language, len(languages))
                if place == len(totals):
                    totals.append(np.zeros(1 << 16, np.int64))
                for other, counts in enumerate(totals):
                    if len(numbers) > len(counts):
                        totals[other] = np.concatenate([counts, np.zeros(2 * len(numbers) - len(counts), np.int64)])
                np.add.at(totals[place], found, 1)
                if numbers.full():
                    yield from flush()
        yield from flush()

    counts = (in_arrow(labelled.select(text, lang), count, "lang string, key long, n long")
              .groupBy("lang", "key").agg(F.sum("n").alias("n")))
    packed = counts.groupBy("lang").agg(F.collect_list(F.struct("key", "n")).alias("c")).select("lang", "c.key", "c.n").toArrow().sort_by("lang")
    languages = packed.column("lang").to_pylist()
    values = np.zeros((len(languages), buckets + len(SCRIPTS)))
    for place, (keys, n) in enumerate(zip(packed.column("key"), packed.column("n"), strict=True)):
        values[place, keys.values.to_numpy()] = n.values.to_numpy()
    grams, scripts = values[:, :buckets] + smoothing, values[:, buckets:]
    return {"languages": languages, "log": np.log(grams / grams.sum(axis=1, keepdims=True)).T.astype(np.float32),
            "scripts": scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1), "buckets": buckets}


class Labeller:
    """Scores per distinct word and Viterbi per text."""

    def __init__(self, model: dict, penalty: float, weight: float, min_share: float) -> None:
        self.languages, self.log, self.buckets = model["languages"], model["log"], model["buckets"]
        self.penalty, self.weight = penalty, weight
        self.barred = model["scripts"] < min_share  # languages x scripts
        self.barred[:, self.barred.all(axis=0)] = False  # a script that none uses narrows nothing
        self.words = Words(6_000_000)
        self.scores = np.zeros((0, len(self.languages)), np.float32)
        self.letters = np.zeros(0, bool)

    def _score(self) -> None:
        """Scores of the words that came since the last call."""
        new = list(islice(self.words, len(self.scores), None))
        if not new:
            return
        known = [spelled(w) for w in new]
        scores = np.zeros((len(new), len(self.languages)), np.float32)
        some = np.array([i for i, (w, _) in enumerate(known) if w], np.int64)
        for at in range(0, len(some), PART):
            part = some[at:at + PART]
            found, sizes = features([known[i][0] for i in part], self.buckets)
            sums = np.add.reduceat(self.log[found], np.cumsum(sizes) - sizes, axis=0)
            means = sums / sizes[:, None] * self.weight
            scripts = np.array([known[i][1] for i in part])
            scores[part] = means - means.max(axis=1, keepdims=True)
            scores[part] = np.where(self.barred[:, scripts].T, -50, scores[part])
        self.scores = np.concatenate([self.scores, scores])
        self.letters = np.concatenate([self.letters, np.array([bool(w) for w, _ in known])])

    def path(self, scores: np.ndarray) -> np.ndarray:
        totals = scores.sum(axis=0)
        best = int(totals.argmax())
        others = np.delete(scores, best, axis=1)
        if not others.shape[1]:
            return np.zeros(len(scores), np.int64)
        gains = np.concatenate([[0.0], np.cumsum(others.max(axis=1).astype(np.float64) - scores[:, best])])
        if (gains - np.minimum.accumulate(gains)).max() <= self.penalty:
            return np.full(len(scores), best)
        rows = scores.tolist()
        value, penalty, back = rows[0], self.penalty, []
        for row in rows[1:]:
            most = max(value)
            top, leave = value.index(most), most - penalty
            back.append([k if v >= leave else top for k, v in enumerate(value)])
            value = [(v if v >= leave else leave) + s for v, s in zip(value, row, strict=True)]
        place = value.index(max(value))
        out = [place]
        for choice in reversed(back):
            place = choice[place]
            out.append(place)
        return np.array(out[::-1])

    def __call__(self, texts: list[bytes | None]) -> list[tuple[str, float, list[dict]]]:
        if not self.languages:
            return [("und", 0.0, []) for _ in texts]
        out: list[tuple[str, float, list[dict]]] = []
        held: list[np.ndarray] = []
        for data in texts:
            held.append(self.words.numbers(words_of(data)))
            if len(held) == 500 or self.words.full():
                out += self._labelled(held)
                held = []
        return out + self._labelled(held)

    def _labelled(self, texts: list[np.ndarray]) -> list[tuple[str, float, list[dict]]]:
        self._score()
        out = []
        for numbers in texts:
            letters = self.letters[numbers]
            if not letters.any():
                out.append(("und", 0.0, []))
                continue
            path = self.path(self.scores[numbers])
            share = np.bincount(path[letters], minlength=len(self.languages)) / letters.sum()
            head = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
            tail = np.append(head[1:], len(path)) - 1
            top = int(share.argmax())
            out.append((self.languages[top], float(share[top]), [
                {"first_word": int(a), "last_word": int(b), "lang": self.languages[path[a]]}
                for a, b in zip(head, tail, strict=True)]))
        if self.words.full():
            self.words.forget()
            self.scores, self.letters = self.scores[:0], self.letters[:0]
        return out


_BUILT: dict[str, Labeller] = {}


def identify(documents: DataFrame, model: dict, text: str = "text", penalty: float = 8.0, weight: float = 2.0,
             min_share: float = 0.005, keep: list[str] | None = None) -> DataFrame:
    """Documents with lang_pred, score (the share of its words with a letter) and lang_spans (word places)."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    key = uuid4().hex  # of this model, in the worker's cache
    kind = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("lang", pa.string())]))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = Labeller(sent.value, penalty, weight, min_share)
        labels, scores, spans = zip(*_BUILT[key](text_bytes(batch, text)), strict=True) if batch.num_rows else ((), (), ())
        return [pa.array(labels, pa.string()), pa.array(scores, pa.float64()), pa.array(list(spans), kind)]

    return arrow_columns(documents, compute, LABELS, keep)
