"""Benchmark decontamination by winnowing.

Documents and benchmark items are cut into words; of the hashes of all runs of ``k`` words
the smallest of each window of consecutive runs is kept. Both sides keep it wherever they
share a whole window, so every shared span of ``k + window - 1`` words has a fingerprint in
common. A shared fingerprint is extended to the longest common span around it, compared word
by word.

The benchmark's fingerprints are broadcast in blocks of a bounded number of words; documents
meet every block. Items shorter than the guaranteed span match as a whole, by the hash of
all their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import LOWER, UPPER, blobs, resident, shielded

SPAN = 10
GRAM = 5
BLOCK_WORDS = 2_000_000
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes.maketrans(UPPER, LOWER)
_TABLE = bytes(b if b in _WORD_BYTES else 0x20 for b in _TABLE)
_POWERS = np.random.default_rng(8).integers(1, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GRAM_POWERS = np.random.default_rng(9).integers(1, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES_AT_ONCE = 1 << 20
_NONE = np.uint64(2**64 - 1)


class _Words:
    """The words of several texts as one array of 64-bit hashes, with their texts and places."""

    def __init__(self, texts: list[bytes]):
        self.body = b" ".join(t.translate(_TABLE) for t in texts) + b" "
        raw = np.frombuffer(self.body, np.uint8)
        inside = raw != 0x20
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.begins, self.ends = edges[::2], edges[1::2]
        self.hashes = self._hash(raw)
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        self.text_of = np.searchsorted(np.cumsum(lengths), self.begins, side="right")
        self.counts = np.bincount(self.text_of, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def _hash(self, raw: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(self.begins), np.uint64)
        for low in range(0, len(raw), _BYTES_AT_ONCE):
            high = min(low + _BYTES_AT_ONCE, len(raw))
            a, b = np.searchsorted(self.ends, low, side="right"), np.searchsorted(self.begins, high)
            if a == b:
                continue
            begins, ends = np.maximum(self.begins[a:b], low), np.minimum(self.ends[a:b], high)
            sizes = ends - begins
            offsets = np.cumsum(sizes) - sizes
            at = np.arange(sizes.sum()) + np.repeat(begins - offsets, sizes)
            place = at - np.repeat(self.begins[a:b], sizes)
            values = (raw[at].astype(np.uint64) + np.uint64(1)) * _POWERS[place & 1023]
            values *= (place >> 10).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            sums[a:b] += np.add.reduceat(values, offsets)
        return _mixed(sums)

    def grams(self, n: int) -> np.ndarray:
        """The hash of the ``n`` words from each word on; all ones where its text ends before."""
        total = len(self.hashes)
        out = np.full(total, _NONE, np.uint64)
        if total >= n:
            sums = np.zeros(total - n + 1, np.uint64)
            for i in range(n):
                sums += self.hashes[i : total - n + 1 + i] * _GRAM_POWERS[i]
            same = self.text_of[: total - n + 1] == self.text_of[n - 1 :]
            out[: total - n + 1] = np.where(same, np.minimum(_mixed(sums), _NONE - np.uint64(1)), _NONE)
        return out

    def winnowed(self, k: int, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the fingerprints: the least of each ``span - k + 1`` grams."""
        grams = self.grams(k)
        width = span - k + 1
        padded = np.concatenate([np.full(width - 1, _NONE), grams, np.full(width - 1, _NONE)])
        n = len(grams) + width - 1
        least = padded[:n].copy()
        for i in range(1, width):
            np.minimum(least, padded[i : i + n], out=least)
        keep = np.zeros(len(grams), bool)
        for i in range(width):
            keep |= grams == least[i : i + len(grams)]
        places = np.flatnonzero(keep & (grams != _NONE))
        return places, grams[places]

    def same(self, a: int, other: _Words, b: int, n: int) -> bool:
        """Whether ``n`` words from ``a`` on are those of ``other`` from ``b`` on."""
        mine = self.body[self.begins[a] : self.ends[a + n - 1]].split()
        return mine == other.body[other.begins[b] : other.ends[b + n - 1]].split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Benchmark:
    """Fingerprints of a block of items."""

    def __init__(self, names: list[str | None], texts: list[bytes], span: int, gram: int):
        self.names, self.span, self.gram = names, span, gram
        self.words = _Words(texts)
        counts = self.words.counts
        places, hashes = self.words.winnowed(gram, span)
        long = counts[self.words.text_of[places]] >= span
        self.tables = [(0, *_sorted(hashes[long], places[long]))]
        short = np.flatnonzero((counts > 0) & (counts < span))
        for n in np.unique(counts[short]).tolist():
            starts = self.words.first[:-1][short[counts[short] == n]]
            self.tables.append((n, *_sorted(self.words.grams(n)[starts], starts)))

    def marks(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set]]:
        """For each text: its number of words, the spans of hit words, the items that occur."""
        words = _Words(texts)
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        found: list[set] = [set() for _ in texts]
        for n, hashes, places in self.tables:
            if not len(hashes) or not len(words.hashes):
                continue
            if n:
                mine = words.grams(n)
                at = np.arange(len(mine))
            else:
                at, mine = words.winnowed(self.gram, self.span)
            low, high = np.searchsorted(hashes, mine), np.searchsorted(hashes, mine, side="right")
            reached: dict[tuple[int, int], int] = {}
            for i in np.flatnonzero(high > low).tolist():
                for j in places[low[i] : high[i]].tolist():
                    self._extend(words, int(at[i]), j, n, reached, spans, found)
        first = words.first
        return [
            (int(words.counts[t]), [(a - int(first[t]), b - int(first[t])) for a, b in spans[t]], found[t])
            for t in range(len(texts))
        ]

    def _extend(self, words, a, b, n, reached, spans, found) -> None:
        """Extends the hit of document word ``a`` and item word ``b`` to both sides."""
        item = int(self.words.text_of[b])
        diagonal = (item, a - b)
        if reached.get(diagonal, -1) > a:
            return
        text = int(words.text_of[a])
        if n:
            left, right = 0, n
        else:
            back = min(a - int(words.first[text]), b - int(self.words.first[item]))
            ahead = min(int(words.first[text + 1]) - a, int(self.words.first[item + 1]) - b)
            mine, other = words.hashes, self.words.hashes
            left = _common(mine[a - back : a][::-1], other[b - back : b][::-1])
            right = _common(mine[a : a + ahead], other[b : b + ahead])
        reached[diagonal] = a + right
        length = left + right
        if length >= (n or self.span) and words.same(a - left, self.words, b - left, length):
            spans[text].append((a - left, a + right))
            found[text].add(item)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else len(x)


def _sorted(hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    return hashes[order], places[order]


def _blocks(items: DataFrame, words: int) -> Iterator[tuple[list, list]]:
    """The items in blocks of about so many words; the driver holds one block at a time."""
    names, texts, size = [], [], 0
    for name, text in items.toLocalIterator():
        names.append(name)
        texts.append((text or "").encode())
        size += len(texts[-1]) // 2 + 1
        if size >= words:
            yield names, texts
            names, texts, size = [], [], 0
    if names:
        yield names, texts


_RESULT = "struct<n_words:bigint,spans:array<struct<a:int,b:int>>,items:array<string>>"


def contamination(
    text: Column,
    benchmark: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    block_words: int = BLOCK_WORDS,
) -> Column:
    """What of ``text`` also stands in ``benchmark``: ``n_words``, ``spans`` and ``items``.

    Words are runs of ASCII letters and digits (A-Z lower-cased) and all other non-ASCII
    characters. ``spans`` are the disjoint runs of words (from, to exclusive) that lie in an
    occurrence of ``span`` consecutive words of an item, or of a whole shorter item; ``items``
    the sorted ids, as text, of the items with such an occurrence. Null texts and items have
    no words; items of null id mark words but are not listed.
    """
    items, (key, body) = shielded(benchmark, item_id, item_text)
    items = items.select(F.col(key).cast("string"), F.col(body))
    context = benchmark.sparkSession.sparkContext
    shared = [
        context.broadcast(Benchmark(names, texts, span, gram))
        for names, texts in _blocks(items, block_words)
    ]
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
            ("items", pa.list_(pa.string())),
        ]
    )

    @F.arrow_udf(_RESULT)
    def scan(texts: pa.Array) -> pa.Array:
        resident("winnow", dict)  # of other operators nothing stays
        out = []
        for group in _groups(blobs(texts)):
            merged = None
            for block in shared:
                table = block.value
                marks = [(n, s, {table.names[i] for i in f}) for n, s, f in table.marks(group)]
                if merged is None:
                    merged = marks
                else:
                    merged = [(n, s + t, f | g) for (n, s, f), (_, t, g) in zip(merged, marks, strict=True)]
            if merged is None:
                merged = [(int(n), [], set()) for n in _Words(group).counts]
            out += [
                {
                    "n_words": n,
                    "spans": [{"a": a, "b": b} for a, b in _disjoint(s)],
                    "items": sorted(f - {None}),
                }
                for n, s, f in merged
            ]
        return pa.array(out, kind)

    return scan(text)


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= _BYTES_AT_ONCE:
            yield group
            group, size = [], 0
    if group:
        yield group


def _disjoint(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
