"""Quality rules, and how far a text's histograms are from those of its language.

Plain rules come first: length, and words in windows that the text repeats. For texts that pass
them, two histograms are compared with a reference of the language: characters by class and
common words, by the Jensen-Shannon distance. References are the sums over all texts that pass
the plain rules and name their language. Short texts are far from anything by chance, so each
histogram is compared from a least length on, and the divergence that sampling alone would give
is taken off.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import LOWER, UPPER, blobs, pieces, shielded, stored

LEAST_WORDS = 20
MOST_REPEATED = 0.3
WINDOW = 8
# A word is common to a language if at least so large a share of its words is that.
COMMON = 0.002
# A language has a reference if the texts in it have so many words, and this share of all words.
REFERENCE_WORDS, REFERENCE_SHARE = 2_000, 0.001
# Least lengths for a comparison, and the distances that are too far.
CLASS_CHARS, CLASS_DISTANCE = 300, 0.3
COMMON_WORDS, WORD_DISTANCE = 100, 0.3
# Words counted before a task sends what it has.
FLUSH = 500_000

_SPACES = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_POINTS = b".,;:!?'\"()-"
_LATER_BYTES = bytes(range(0x80, 0xC0))
CLASSES = ("vowels", "consonants", "capitals", "digits", "spaces", "points", "signs", "letters of two bytes", "others")


def _class_table() -> np.ndarray:
    """The class of each byte; later bytes of a code point have one beyond all classes."""
    table = np.full(256, 6, np.int64)
    for number, members in enumerate(
        (b"aeiou", bytes(set(range(97, 123)) - set(b"aeiou")), bytes(range(65, 91)), b"0123456789", _SPACES, _POINTS)
    ):
        table[list(members)] = number
    table[0xC0:0xE0], table[0xE0:], table[0x80:0xC0] = 7, 8, len(CLASSES)
    return table


_CLASS = _class_table()
_PLAIN = bytes.maketrans(UPPER + _POINTS, LOWER + b" " * len(_POINTS))
_ODD = np.random.default_rng(7).integers(1, 1 << 62, WINDOW, np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Measures:
    """What the plain rules and both histograms need of one text."""

    n_words: int = 0
    word_chars: int = 0
    n_symbols: int = 0
    n_dup_lines: int = 0
    n_repeat_words: int = 0

    @property
    def base_failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > round(100 * MOST_REPEATED) * self.n_words


def _hashes(text: bytes) -> np.ndarray:
    """A number a word, the same for equal words."""
    parts = [np.fromiter(map(hash, words), np.int64, len(words)) for words in map(bytes.split, pieces(text))]
    return np.concatenate(parts or [np.zeros(0, np.int64)])


def _ids(text: bytes) -> np.ndarray:
    """A number a word, from 0, the same for equal words only."""
    index: dict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    parts = [np.fromiter(map(index.__getitem__, words), np.int64, len(words)) for words in map(bytes.split, pieces(text))]
    return np.concatenate(parts or [np.zeros(0, np.int64)])


def repeated_words(ids: np.ndarray) -> int:
    """Words in windows of eight that occur twice or more, the first one included.

    ``ids`` number the words from 0. Windows are numbered as well, their length doubling three times.
    """
    if len(ids) <= WINDOW:
        return 0
    windows, kinds = ids, int(ids.max()) + 1
    for half in (1, 2, 4):
        pairs = windows[:-half] * np.int64(kinds) + windows[half:]
        windows, counts = np.unique(pairs, return_inverse=True, return_counts=True)[1:]
        kinds = len(counts)
    again = counts[windows] > 1
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[: len(again)] += again
    edges[WINDOW : WINDOW + len(again)] -= again
    return int((np.cumsum(edges) > 0).sum())


def _may_repeat(hashes: np.ndarray) -> bool:
    """False if no window of eight occurs twice: then no two of their hashes are equal either."""
    last = len(hashes) - WINDOW + 1
    if last < 2:
        return False
    mixed = hashes.view(np.uint64)
    windows = mixed[:last] * _ODD[0]
    for at in range(1, WINDOW):
        windows += mixed[at : at + last] * _ODD[at]
    windows.sort()
    return bool((windows[1:] == windows[:-1]).any())


def measure(text: bytes) -> Measures:
    """The measures of a text in UTF-8; its words are split part by part, not all at once."""
    hashes = _hashes(text)
    dense = text.translate(None, _SPACES)
    seen, copies = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            copies += 1
        elif line.strip(_SPACES):
            seen.add(line)
    return Measures(
        len(hashes),
        len(dense.translate(None, _LATER_BYTES)),
        len(dense) - len(dense.translate(None, _SYMBOLS)),
        copies,
        repeated_words(_ids(text)) if _may_repeat(hashes) else 0,
    )


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]


def forms(text: bytes) -> Iterator[list[bytes]]:
    """The words for the histogram of common ones: A-Z in lower case, points end a word."""
    return map(bytes.split, pieces(text.translate(_PLAIN)))


def _bits(shares: np.ndarray) -> float:
    """Entropy."""
    some = shares[shares > 0]
    return float(-(some @ np.log2(some)))


def divergence(found: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance (bits) of two histograms, less what sampling gives on average.

    ``reference`` are shares, ``found`` counts.
    """
    size = found.sum()
    shares = found / size
    apart = _bits((shares + reference) / 2) - (_bits(shares) + _bits(reference)) / 2
    chance = (np.count_nonzero(reference) - 1) / (8 * size * np.log(2))
    return float(np.sqrt(max(0.0, apart - chance)))


@dataclass(frozen=True)
class Reference:
    """A language's shares: of classes, and of its common words and all others together (last)."""

    classes: np.ndarray
    words: tuple[bytes, ...]
    shares: np.ndarray

    def distances(self, classes: np.ndarray, counts: Counter[bytes]) -> tuple[float | None, float | None]:
        """By classes and by common words; None where the text is too short for either."""
        by_class = divergence(classes, self.classes) if classes.sum() >= CLASS_CHARS else None
        total = counts.total()
        if total < COMMON_WORDS:
            return by_class, None
        found = np.array([*map(counts.__getitem__, self.words), 0], float)
        found[-1] = total - found.sum()
        return by_class, divergence(found, self.shares)


def _excess(distances: tuple[float | None, float | None]) -> float:
    """How far out the worse distance is: at most 1 is near enough."""
    return max((d / most for d, most in zip(distances, (CLASS_DISTANCE, WORD_DISTANCE)) if d is not None), default=0.0)


class References(dict[str, Reference]):
    """References by language."""

    def nearest(self, lang: str | None, text: bytes):
        """Language and distances of the reference to judge by; None if there is none.

        That of the language which the text names if it is near enough, else the nearest of
        all. A text in a language without a reference is not judged.
        """
        if not self or (lang is not None and lang not in self):
            return None
        counts: Counter[bytes] = Counter()
        for words in forms(text):
            counts.update(words)
        classes = class_counts(text)
        best = None
        for name in sorted(self, key=lambda name: (name != lang, name)):
            distances = self[name].distances(classes, counts)
            if best is None or _excess(distances) < _excess(best[1]):
                best = (name, distances)
            if name == lang and _excess(distances) <= 1:
                break
        return best


def _taught(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Language and text of what references are made of: texts that pass the plain rules."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang, text in zip(langs, blobs(batch.column(1)), strict=True):
            if lang is not None and text and not measure(text).base_failed:
                yield lang, text


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language and portion of a task: totals, and the words that may be common.

    A word that makes up a share of the whole makes up that share of some portion. Those of
    a quarter of the share are sent, so that few of them need a second look.
    """
    counts: dict[str, Counter] = defaultdict(Counter)
    totals: dict[str, list] = {}
    names = ["lang", "word", "n", "portion", "classes"]

    def flushed(lang: str) -> pa.RecordBatch:
        n, classes = totals.pop(lang)
        often = [(w, c) for w, c in counts.pop(lang).items() if c >= COMMON / 4 * n]
        rows = [(lang, None, n, n, classes.tolist()), *((lang, w, c, n, None) for w, c in often)]
        kinds = (pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for lang, text in _taught(batches):
        total = totals.setdefault(lang, [0, np.zeros(len(CLASSES), np.int64)])
        for words in forms(text):
            counts[lang].update(words)
            total[0] += len(words)
        total[1] += class_counts(text)
        if total[0] >= FLUSH:
            yield flushed(lang)
    for lang in list(totals):
        yield flushed(lang)


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> References:
    """The references of all languages that enough texts name.

    Two passes over all texts: one sums classes and finds what words may be common (at most
    4 / 3 / ``COMMON`` a language by their upper bounds), the other counts those words exactly.
    No table of all words is made or shuffled. Languages are at most 1 / ``REFERENCE_SHARE``.
    """
    spark = docs.sparkSession
    rows, (text, lang) = shielded(docs, text_col, lang_col)
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    told = rows.mapInArrow(_frequent, "lang string, word binary, n long, portion long, classes array<long>")
    told = stored(told, "frequent")
    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))]
    totals = told.where("word IS NULL").groupBy("lang").agg(F.sum("n").alias("total"), *sums)
    every = totals.agg(F.sum("total")).first()[0] or 0
    large = totals.where(F.col("total") >= max(REFERENCE_WORDS, REFERENCE_SHARE * every))
    classes = {r.lang: (r.total, np.array(r[2:], float)) for r in large.collect()}
    if not classes:
        return References()
    seen = told.where("word IS NOT NULL").groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("portion").alias("portion"))
    upper = F.col("n") + COMMON / 4 * (F.col("total") - F.col("portion"))
    hopeful = seen.join(F.broadcast(large.select("lang", "total")), "lang").where(upper >= COMMON * F.col("total"))
    candidates: dict[str, set] = defaultdict(set)
    for row in hopeful.select("lang", "word").collect():
        candidates[row.lang].add(bytes(row.word))
    shared = spark.sparkContext.broadcast(dict(candidates))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        counts: dict[str, Counter] = {lang: Counter() for lang in wanted}
        for lang, text in _taught(batches):
            if lang in wanted:
                for words in forms(text):
                    counts[lang].update(filter(wanted[lang].__contains__, words))
        rows = [(lang, word, n) for lang, own in counts.items() for word, n in own.items()]
        if rows:
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.binary(), pa.int64()))]
            yield pa.record_batch(arrays, names=["lang", "word", "n"])

    counted = rows.mapInArrow(exact, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    common: dict[str, dict[bytes, int]] = defaultdict(dict)
    for row in counted.collect():
        if row.n >= COMMON * classes[row.lang][0]:
            common[row.lang][bytes(row.word)] = row.n
    made = References()
    for lang, (total, histogram) in classes.items():
        words = tuple(sorted(common[lang]))
        known = [common[lang][w] for w in words]
        shares = np.array([*known, total - sum(known)], float) / total
        made[lang] = Reference(histogram / histogram.sum(), words, shares)
    return made


RESULT = pa.struct(
    [
        *((name, pa.int64()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        *((name, pa.bool_()) for name in ("base_failed", "kept")),
        ("reference", pa.string()), ("class_distance", pa.float64()), ("word_distance", pa.float64()),
    ]
)
_LAYOUT = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "base_failed:boolean,kept:boolean,reference:string,class_distance:double,word_distance:double>"
)


def judge(text: bytes, lang: str | None, known: References) -> dict:
    found = measure(text)
    row = {name: getattr(found, name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")}
    near = None if found.base_failed else known.nearest(lang, text)
    if near is None:
        return row | {"kept": not found.base_failed, "reference": None, "class_distance": None, "word_distance": None}
    name, (by_class, by_words) = near
    kept = _excess((by_class, by_words)) <= 1
    return row | {"kept": kept, "reference": name, "class_distance": by_class, "word_distance": by_words}


def judged(text: Column, lang: Column, known: References, session) -> Column:
    """Measures of a text, ``base_failed``, ``kept``, and the reference and distances that decided.

    A null or empty text has no words and fails the plain rules, which leave the rest null. A
    text in a language without a reference (unless null) is kept by the plain rules alone, as
    are all texts where nothing could be learned.
    """
    shared = session.sparkContext.broadcast(known)

    @F.arrow_udf(_LAYOUT)
    def rule(texts: pa.Array, langs: pa.Array) -> pa.Array:
        own = shared.value
        return pa.array([judge(t, name, own) for t, name in zip(blobs(texts), langs.to_pylist(), strict=True)], RESULT)

    return rule(text, lang.cast("string"))
