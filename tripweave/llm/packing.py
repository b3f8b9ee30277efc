"""Harmonic packing of tokenized documents into sequences of fixed capacity.

A piece of ``n`` tokens belongs to reciprocal class ``k = capacity // n``: exactly ``k`` such
pieces fill a bin. Every task fills bins of its own, class by class, and holds back at most
``k - 1`` pieces of a class. What the tasks hold back is numbered over all of them and fills
bins the same way, and of that again at most ``k - 1`` pieces of a class remain: a number
bounded by the capacity alone, packed by first fit.

Documents may be cut. A piece that would leave more than ``slack`` of its bins empty gives up
a piece of the exact size of the next class, and the rest is classed again; class numbers
grow as squares, so a rest needs five pieces at most.
"""

from __future__ import annotations

import re
import string
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripweave.llm.common import resident, shielded, stored

CAPACITY = 4096
END_ID = 2
SLACK = 0.01
_END = END_ID.to_bytes(4, "little")
_CACHED = 600_000  # words, signs and chunks remembered by a Python worker
_AT_ONCE = 2_000  # words or signs tokenized as one text
# Letters that lower-casing and normal form NFC treat alone, and ASCII signs.
_LETTER, _SIGNS = "[A-Za-zÀ-ÖØ-öø-ÿ]", string.punctuation
_ONE_KIND = re.compile(f"{_LETTER}+|[{re.escape(_SIGNS)}]+")
_ROUND = 1 << 61


@lru_cache(maxsize=100_000)
def cuts(tokens: int, capacity: int = CAPACITY, slack: float = SLACK) -> tuple[int, ...]:
    """The lengths of the pieces of a document of so many tokens, in order."""
    pieces = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        k = capacity // rest
        fits = capacity - k * rest <= slack * capacity
        pieces.append(rest if fits else capacity // (k + 1))
        rest -= pieces[-1]
    return tuple(pieces)


class TokenIds:
    """Token ids of texts as little-endian bytes, by a tokenizer file that drops white space.

    White space separates tokens and nothing in this tokenizer reaches across it, so a text's
    ids are those of its chunks in turn. A plain chunk is a word, learned in lower case, and the
    signs behind it; a worker remembers words, signs and other chunks. New words and signs are
    tokenized many at a time and told apart by their last token, which ends a word.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.last[number] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        # The ids of the part with number n are those from ends[n] to ends[n + 1].
        self.known: dict[str, int] = {"": 0}
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(2, np.int64)

    def _tokenize(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _learn(self, parts: list[str], joined: bool) -> None:
        """Remember new parts; ``joined`` ones are letters or signs only, a word to the tokenizer."""
        learned, sizes = [self.ids], [np.zeros(0, np.int64)]
        for at in range(0, len(parts), _AT_ONCE):
            some = parts[at : at + _AT_ONCE]
            if joined:
                (ids,) = self._tokenize([" ".join(some)])
                ends = np.flatnonzero(self.last[ids]) + 1
                if len(ends) == len(some):
                    learned.append(ids)
                    sizes.append(np.diff(ends, prepend=0))
                    continue
            each = self._tokenize(some)
            learned += each
            sizes.append(np.array([len(ids) for ids in each], np.int64))
        first = len(self.known)
        self.known.update(zip(parts, range(first, first + len(parts)), strict=True))
        self.ids = np.concatenate(learned)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])

    def _numbers(self, parts: list[str]) -> np.ndarray:
        """The number of each of the different ``parts``, new ones learned."""
        found = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
        new = np.flatnonzero(found < 0)
        if len(self.known) + len(new) > _CACHED and len(self.known) > 1:
            self._forget()
            return self._numbers(parts)
        missing = [parts[i] for i in new.tolist()]
        of_one_kind = [_ONE_KIND.fullmatch(part) is not None for part in missing]
        for joined in (True, False):
            self._learn([part for part, one in zip(missing, of_one_kind, strict=True) if one is joined], joined)
        found[new] = [self.known[part] for part in missing]
        return found

    def _chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different ``chunks`` one after another, and where each ends."""
        words = pc.ascii_rtrim(chunks, characters=_SIGNS)
        plain = pc.match_substring_regex(words, f"^{_LETTER}*$")
        heads = pc.if_else(plain, pc.utf8_lower(words), chunks)
        signs = pc.subtract(pc.binary_length(chunks), pc.binary_length(words)).to_numpy()
        signed = np.flatnonzero(plain.to_numpy(zero_copy_only=False) & (signs > 0))
        behind = zip(chunks.take(pa.array(signed)).to_pylist(), signs[signed].tolist(), strict=True)
        tails = pa.array([chunk[-n:] for chunk, n in behind], heads.type)
        parts = pa.concat_arrays([heads, tails]).dictionary_encode()
        numbers = self._numbers(parts.dictionary.to_pylist())[parts.indices.to_numpy()]
        pairs = np.zeros((len(chunks), 2), np.int64)
        pairs[:, 0], pairs[signed, 1] = numbers[: len(chunks)], numbers[len(chunks) :]
        ids, ends = _joined(self.ids, self.ends, pairs.ravel())
        return ids, ends[::2]

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, a null one as empty; a group's new chunks are learned together."""
        for group in _groups(texts):
            chunks = pc.ascii_split_whitespace(group)
            coded = chunks.flatten().dictionary_encode()
            ids, ends = _joined(*self._chunk_ids(coded.dictionary), coded.indices.to_numpy())
            sizes = pc.list_value_length(chunks).to_numpy()
            for start, end in pairwise(ends[np.cumsum([0, *sizes])].tolist()):
                yield ids[start:end].tobytes()


def _joined(ids: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of parts in turn, given by their ``numbers``, and where each part ends, from 0 on."""
    starts, sizes = ends[numbers], np.diff(ends)[numbers]
    stops = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(starts - stops[:-1], sizes)
    places += np.arange(len(places))
    return ids[places], stops


def _groups(texts: pa.Array, size: int = 1 << 22) -> Iterator[pa.Array]:
    texts = texts.cast(pa.large_string()).fill_null("")
    held = np.cumsum(pc.binary_length(texts).to_numpy())
    at = 0
    while at < len(texts):
        before = held[at - 1] if at else 0
        end = min(int(np.searchsorted(held, before + size)) + 1, len(texts))
        yield texts[at:end]
        at = end


def _token_ids(path: str) -> TokenIds:
    return resident(("packing", path), lambda: TokenIds(path))


class _Bins:
    """Fills bins of one task; rows are lists that begin with the piece's length."""

    def __init__(self, capacity: int):
        self.capacity, self.open, self.done = capacity, {}, 0

    def add(self, length: int, row: tuple) -> list[tuple]:
        """The rows of the bin that this piece completes, with their places; else nothing."""
        k = self.capacity // length
        held = self.open.setdefault(k, [])
        held.append((length, row))
        if len(held) < k:
            return []
        filled, offset = [], 0
        for size, each in held:
            filled.append((*each, k, self.done, offset))
            offset += size
        self.done += 1
        held.clear()
        return filled

    def rest(self) -> list[tuple]:
        return [
            (*row, k, None, slot)
            for k, held in self.open.items()
            for slot, (_, row) in enumerate(held)
        ]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    slack: float = SLACK,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of each document, with its place in a sequence.

    Columns: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset``, and ``ids`` (array) if ``with_ids``. A null text is an empty one: its piece
    holds the end id only. Repeated rows are packed as often as given. ``capacity`` tokens
    are never exceeded, and pieces of a sequence lie without gaps from 0.
    """
    rows, (key, text) = shielded(docs, id_col, text_col)
    id_type = rows.schema[key].dataType.simpleString()
    layout = f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"
    names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
    if with_ids:
        layout, names = layout + ", ids array<int>", [*names, "ids"]
    layout += ", worker long, class long, bin long, place long"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        worker = context.partitionId() if context else 0
        ids_of, bins, kind = _token_ids(tokenizer_path), _Bins(capacity), None

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*((*r[:-3], worker, *r[-3:]) for r in out), strict=True))
            kinds = [kind, *[pa.int64()] * 4]
            kinds += [pa.list_(pa.int32())] * with_ids + [pa.int64()] * 4
            return pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=[*names, "worker", "class", "bin", "place"],
            )

        for batch in batches:
            kind, keys, out = batch.schema.field(0).type, batch.column(0).to_pylist(), []
            for name, raw in zip(keys, ids_of(batch.column(1)), strict=True):
                raw += _END
                total, start = len(raw) // 4, 0
                for length in cuts(total, capacity, slack):
                    part = raw[4 * start : 4 * (start + length)]
                    row = (name, start, length, zlib.crc32(part), total)
                    if with_ids:
                        row = (*row, np.frombuffer(part, "<i4").tolist())
                    out += bins.add(length, row)
                    start += length
                if len(out) > 20_000:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)
        if left := bins.rest():
            yield batch_of(left)

    packed = stored(rows.select(key, text).mapInArrow(pieces, layout), "pieces")
    filled = packed.where("bin IS NOT NULL").select(
        *names,
        (F.shiftleft("worker", 32) + F.col("bin")).alias("sequence_id"),
        F.col("place").alias("offset"),
    )
    left = packed.where("bin IS NULL")
    sequences = filled.unionByName(_pack_rest(left, names, capacity))
    return sequences.withColumnRenamed("id", id_col)


def _pack_rest(left: DataFrame, names: list[str], capacity: int) -> DataFrame:
    """Fills bins over all tasks from the pieces that each has held back."""
    held = left.groupBy("class", "worker").agg(F.count(F.lit(1)).alias("n"))
    by_class = Window.partitionBy("class")
    earlier = by_class.orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        "class",
        "worker",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(by_class).alias("total"),
    )
    ranked = left.join(held, ["class", "worker"]).withColumn("rank", F.expr("before + place"))
    whole = "rank < total - total % class"
    in_bin = Window.partitionBy("class", "number").orderBy("rank")
    joined = (
        ranked.where(whole)
        .withColumn("number", F.expr("rank div class"))
        .withColumn("end", F.sum("length").over(in_bin))
        .select(
            *names,
            (F.lit(_ROUND) + F.shiftleft("class", 44) + F.col("number")).alias("sequence_id"),
            (F.col("end") - F.col("length")).alias("offset"),
        )
    )
    last = ranked.where(f"NOT ({whole})").select(*names)
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in last.schema.fields)
    final = last.withColumn("every", F.lit(0)).groupBy("every").applyInPandas(
        lambda rows: _first_fit(rows.drop(columns="every"), capacity),
        f"{layout}, sequence_id long, offset long",
    )
    return joined.unionByName(final)


def _first_fit(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Largest first, into the fullest bin that has room."""
    rows = rows.sort_values(["length", "ids_crc32", "start"], ascending=[False, True, True])
    room: list[tuple[int, int]] = []  # free tokens and bin, ascending
    bins, offsets, opened = [], [], 0
    for length in rows["length"]:
        at = bisect_left(room, (length, -1))
        if at < len(room):
            free, number = room.pop(at)
        else:
            free, number, opened = capacity, opened, opened + 1
        bins.append(2 * _ROUND + number)
        offsets.append(capacity - free)
        if free > length:
            insort(room, (free - int(length), number))
    return rows.assign(sequence_id=np.array(bins, "int64"), offset=np.array(offsets, "int64"))


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id`` and its ``ids``, from pieces packed ``with_ids``."""
    part = F.struct("offset", "ids")
    ordered = F.array_sort(F.collect_list(part))
    return pieces.groupBy("sequence_id").agg(F.flatten(ordered["ids"]).alias("ids"))
