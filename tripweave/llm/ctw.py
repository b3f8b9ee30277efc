"""Language-model scores by context-tree weighting over bytes.

A text is its lower-cased words, each closed by a space, and an end token. Every byte is
eight binary decisions, and each decision is predicted from the ``DEPTH`` bytes before it in
the running text, across spaces. For each decision the contexts of all depths form a tree. A
node's Krichevsky-Trofimov estimate and the product of its children's weighted probabilities
count half each, which weighs all prunings of the tree at once; read along a path this gives
each depth's share in the prediction.

The grams (a context and its next byte) of all texts are counted by task and shuffled. A
gram's number begins with the nearest byte of its context, so that sorted grams are the tree
in order: every subtree is one run. Subtrees below the ``NEAR`` nearest bytes are dealt over
tasks, each summed from the leaves up; the few levels above them, whose size is bounded
whatever the input, are weighed on the driver; then the subtrees hand the predictions down.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import blobs, shielded, stored

# Bytes that contexts reach back; a gram's number holds no more.
DEPTH = 6
# Context bytes by which subtrees are dealt over tasks. Above them stand at most 1 + 256 + 256^2
# contexts of 255 decisions, of which UTF-8 text can form only a part.
NEAR = 3
# Bytes of text of which the grams are in memory at once, and different grams held by a task.
_SLICE = 1 << 21
_HELD = 3 << 20
# Grams of whole subtrees that are weighed together.
_CHUNK = 1 << 18
END = b"\n"
# Words whose scores go to every worker, the most frequent ones; others are joined.
HEAD = 200_000
# Gram scores that go to every worker, those of the most frequent grams; others are joined.
MAX_BROADCAST_GRAMS = 2_000_000
_FLUSH = 300_000
_LN10 = float(np.log(10))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def _token_counts(docs: DataFrame) -> DataFrame:
    """``token`` and its occurrences ``c`` in the rows that are learned from; 0 for others' tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned, others = Counter(), set()

        def batch() -> pa.RecordBatch:
            rest = others.difference(learned)
            return pa.record_batch(
                [
                    pa.array([*learned, *rest], pa.binary()),
                    pa.array([*learned.values(), *[0] * len(rest)], pa.int64()),
                ],
                names=["token", "c"],
            )

        for part in batches:
            for learn, text in zip(part.column(0).to_pylist(), blobs(part.column(1)), strict=True):
                words = words_of(text)
                if learn:
                    learned.update(words)
                    learned[END] += 1
                else:
                    others.update(words)
                    others.add(END)
                if len(learned) + len(others) > _FLUSH:
                    yield batch()
                    learned.clear()
                    others.clear()
        if learned or others:
            yield batch()

    counts = docs.select("learn", "text").mapInArrow(count, "token binary, c long")
    return counts.groupBy("token").agg(F.sum("c").alias("c"))


def stream_grams(text: bytes, depth: int = DEPTH) -> Iterator[np.ndarray]:
    """The grams of a text's stream: the context from its nearest byte on, then the byte itself.

    The stream is the text's words, each closed by a space, and the end token; before it stand
    bytes that no word holds.
    """
    body = END * (depth - 1) + b" " + b" ".join([*words_of(text), END]) + b" "
    for at in range(depth, len(body), _SLICE):
        part = np.frombuffer(body[at - depth : at + _SLICE], np.uint8).astype(np.int64)
        grams = part[depth:].copy()
        for k in range(1, depth + 1):
            grams |= part[depth - k : len(part) - k] << (8 * (depth + 1 - k))
        yield grams


def _summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different grams in order, and their counts."""
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    starts = np.flatnonzero(np.diff(grams, prepend=-1))
    return grams[starts], np.add.reduceat(counts, starts)


class _Tally:
    """Counts of grams: slices are summed, sums of like size are merged."""

    def __init__(self) -> None:
        self.raw: list[np.ndarray] = []
        self.pending = 0
        self.sums: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, grams: np.ndarray, weight: int) -> None:
        self.raw.append(grams)
        self.pending += len(grams)
        if self.pending >= _SLICE:
            self.fold(weight)

    def fold(self, weight: int) -> None:
        if self.raw:
            grams, counts = np.unique(np.concatenate(self.raw), return_counts=True)
            self.sums.append((grams, counts * weight))
            self.raw, self.pending = [], 0
        while len(self.sums) > 1 and len(self.sums[-2][0]) <= 2 * len(self.sums[-1][0]):
            self.merge()

    def merge(self) -> None:
        (a, m), (b, n) = self.sums.pop(), self.sums.pop()
        self.sums.append(_summed(np.concatenate([a, b]), np.concatenate([m, n])))

    def size(self) -> int:
        return sum(len(grams) for grams, _ in self.sums)

    def take(self, weight: int) -> pa.RecordBatch | None:
        self.fold(weight)
        while len(self.sums) > 1:
            self.merge()
        if not self.sums:
            return None
        grams, counts = self.sums.pop()
        return pa.record_batch([pa.array(grams), pa.array(counts, pa.int64())], names=["gram", "c"])


def gram_counts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``gram`` and ``c``, its occurrences in the rows whose ``learn`` is true; 0 for others' grams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {True: _Tally(), False: _Tally()}
        for part in batches:
            for learn, text in zip(part.column(0).to_pylist(), blobs(part.column(1)), strict=True):
                for grams in stream_grams(text, depth):
                    tallies[learn].add(grams, int(learn))
                    if tallies[learn].size() >= _HELD:
                        yield tallies[learn].take(int(learn))
        for learn, tally in tallies.items():
            last = tally.take(int(learn))
            if last is not None:
                yield last

    # Tasks have summed their own grams; summing again before the shuffle would save nothing.
    counts = docs.select("learn", "text").mapInArrow(count, "gram long, c long").repartition("gram")
    return counts.groupBy("gram").agg(F.sum("c").alias("c"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For x >= 1/2, by Stirling's series seven steps on."""
    product = x.copy()
    for i in range(1, 7):
        product *= x + i
    y = x + 7
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


# Of small counts, which most are; larger ones are worked out.
_SMALL = 1 << 12
_HALVES = _log_gamma(np.arange(_SMALL) + 0.5)
_WHOLES = _log_gamma(np.arange(_SMALL) + 1.0)


def _looked_up(n: np.ndarray, table: np.ndarray, step: float) -> np.ndarray:
    found = table[np.minimum(n, _SMALL - 1)]
    large = n >= _SMALL
    if large.any():
        found[large] = _log_gamma(n[large] + step)
    return found


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of so many outcomes of either kind in any one order."""
    halves = _looked_up(zeros, _HALVES, 0.5) + _looked_up(ones, _HALVES, 0.5)
    return halves - _looked_up(zeros + ones, _WHOLES, 1.0) - np.log(np.pi)


class _Level(NamedTuple):
    """Decisions in contexts of one length, in order of ``ids``."""

    ids: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    estimate: np.ndarray
    weighted: np.ndarray
    leaf: bool

    def handed(self, mass: np.ndarray, rest: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, ...]:
        """What is settled, still open and best so far, after this level.

        A decision that a context has never seen is left to the shorter ones.
        """
        seen = self.zeros + self.ones > 0
        chance = (self.ones + 0.5) / (self.zeros + self.ones + 1)
        stop = 1.0 if self.leaf else np.exp(self.estimate - self.weighted) / 2
        best = np.where(seen, mass + rest * chance, best)
        mass = np.where(seen, mass + rest * stop * chance, mass)
        rest = np.where(seen, rest * (1 - stop), rest)
        return mass, rest, best


def _above(ids: np.ndarray, below: _Level) -> tuple[_Level, np.ndarray]:
    """The level of the next shorter contexts, and the place there of each decision below.

    ``ids`` number the decisions below as that level does.
    """
    own, place = np.unique(ids, return_inverse=True)
    zeros, ones = (np.bincount(place, n, len(own)).astype(np.int64) for n in (below.zeros, below.ones))
    return _inner(own, zeros, ones, np.bincount(place, below.weighted, len(own))), place


def _inner(ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, deeper: np.ndarray) -> _Level:
    estimate = _log_kt(zeros, ones)
    return _Level(ids, zeros, ones, estimate, np.logaddexp(estimate, deeper) - np.log(2), False)


def _subtrees(
    grams: np.ndarray, counts: np.ndarray, j: int, depth: int, near: int
) -> tuple[list[_Level], list[np.ndarray]]:
    """Levels ``depth`` to ``near`` of the decision on bit ``j``, and the places that lead up there.

    Of each gram in the first level, of each decision in the level above it. A decision's number
    is its context's, followed by the bits already known.
    """
    ids = grams >> (8 - j)
    firsts = np.diff(ids, prepend=-1) != 0
    starts = np.flatnonzero(firsts)
    ones = np.add.reduceat(counts * ((grams >> (7 - j)) & 1), starts)
    zeros = np.add.reduceat(counts, starts) - ones
    estimate = _log_kt(zeros, ones)
    levels = [_Level(ids[starts], zeros, ones, estimate, estimate, True)]
    places = [np.cumsum(firsts) - 1]
    for _ in range(depth - near):
        ids = levels[-1].ids
        level, place = _above(((ids >> (8 + j)) << j) | (ids & ((1 << j) - 1)), levels[-1])
        levels.append(level)
        places.append(place)
    return levels, places


def _crown_ids(ids: np.ndarray, j: int) -> np.ndarray:
    """The decisions above the subtrees: a shorter context, and bits known after a leading one."""
    return ((ids >> (8 + j)) << 8) | (1 << j) | (ids & ((1 << j) - 1))


def _whole_subtrees(batches: Iterator[pa.RecordBatch], shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sorted grams of a partition and their counts, in chunks that cut no subtree."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def joined() -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.concatenate(column) for column in zip(*held, strict=True))

    for part in batches:
        if not part.num_rows:
            continue
        grams, counts = part.column(0).to_numpy(), part.column(1).to_numpy()
        cut = int(np.searchsorted(grams, (grams[-1] >> shift) << shift))
        if size + cut >= _CHUNK and (cut or grams[0] >> shift != held[-1][0][-1] >> shift):
            held.append((grams[:cut], counts[:cut]))
            yield joined()
            held, size, grams, counts = [], 0, grams[cut:], counts[cut:]
        held.append((grams, counts))
        size += len(grams)
    if held:
        yield joined()


def _crown(sums: pa.Table, near: int) -> tuple[np.ndarray, ...]:
    """Decisions in contexts of ``near - 1`` bytes, and what they hand to the longer contexts."""
    ids, zeros, ones, deeper = (sums[name].to_numpy() for name in ("id", "zeros", "ones", "deeper"))
    order = np.argsort(ids)
    levels = [_inner(ids[order], zeros[order], ones[order], deeper[order])]
    places = []
    for _ in range(near - 1):
        ids = levels[-1].ids
        level, place = _above(((ids >> 16) << 8) | (ids & 255), levels[-1])
        levels.append(level)
        places.append(place)
    size = len(levels[-1].ids)
    state = levels[-1].handed(np.zeros(size), np.ones(size), np.full(size, 0.5))
    for level, place in zip(levels[-2::-1], places[::-1], strict=True):
        state = level.handed(*(part[place] for part in state))
    return levels[0].ids, *state


def gram_scores(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``gram``, ``c`` and ``lp``, its weighted log10 probability, from grams and their counts.

    A task holds the grams that share their ``NEAR`` nearest context bytes at once.
    """
    near = min(NEAR, depth)
    shift = 8 * (depth + 1 - near)

    def crown_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, counts in _whole_subtrees(batches, shift):
            for j in range(8):
                level = _subtrees(own, counts, j, depth, near)[0][-1]
                ids, place = np.unique(_crown_ids(level.ids, j), return_inverse=True)
                sums = [np.bincount(place, n, len(ids)) for n in (level.zeros, level.ones, level.weighted)]
                columns = [ids, sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2]]
                yield pa.record_batch([pa.array(c) for c in columns], names=["id", "zeros", "ones", "deeper"])

    dealt = grams.select("gram", "c").repartition(F.shiftright("gram", shift)).sortWithinPartitions("gram")
    sums = dealt.mapInArrow(crown_sums, "id long, zeros long, ones long, deeper double")
    sums = sums.groupBy("id").agg(*(F.sum(name).alias(name) for name in ("zeros", "ones", "deeper")))
    table = sums.toArrow()
    shared = grams.sparkSession.sparkContext.broadcast(_crown(table, near) if table.num_rows else ())

    def score_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, counts in _whole_subtrees(batches, shift):
            known, *states = shared.value
            total = np.zeros(len(own))
            for j in range(8):
                levels, places = _subtrees(own, counts, j, depth, near)
                at = np.searchsorted(known, _crown_ids(levels[-1].ids, j))
                state = levels[-1].handed(*(part[at] for part in states))
                for level, place in zip(levels[-2::-1], places[:0:-1], strict=True):
                    state = level.handed(*(part[place] for part in state))
                best = state[2][places[0]]
                total += np.log(np.where((own >> (7 - j)) & 1, best, 1 - best))
            columns = [pa.array(own), pa.array(counts), pa.array(total / _LN10)]
            yield pa.record_batch(columns, names=["gram", "c", "lp"])

    return dealt.mapInArrow(score_grams, "gram long, c long, lp double")


def _digest(name: object, body: bytes) -> tuple[bytes, list[int]]:
    """A row's digest, and as two numbers."""
    digest = hashlib.blake2b(repr(name).encode() + b"\0" + body, digest_size=16).digest()
    return digest, np.frombuffer(digest, "<i8").tolist()


_MIX = np.uint64(0x9E3779B97F4A7C15)  # 2^64 over the golden ratio


def _slot(grams: np.ndarray, bits: int) -> np.ndarray:
    return ((grams.view(np.uint64) * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def _hashed(grams: np.ndarray) -> np.ndarray:
    """Slots of different grams: each holds a gram's place, or that of an entry after the last one.

    A gram whose slot is taken stands in the next free one.
    """
    bits = max(int(2 * len(grams)).bit_length(), 1)
    slots = np.full(1 << bits, len(grams), np.int32)
    left = np.arange(len(grams))
    at = _slot(grams, bits)
    while len(left):
        free = slots[at] == len(grams)
        slots[at[free]] = left[free]
        out = slots[at] != left
        left, at = left[out], (at[out] + 1) & (len(slots) - 1)
    return slots


def _places(own: np.ndarray, grams: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The place of each of ``own`` in ``grams``, whose last entry stands for those not found."""
    at = _slot(own, len(slots).bit_length() - 1)
    places = slots[at].astype(np.int64)
    left = np.flatnonzero((grams[places] != own) & (places < len(grams) - 1))
    at = at[left]
    while len(left):
        at = (at + 1) & (len(slots) - 1)
        places[left] = slots[at]
        more = (grams[places[left]] != own[left]) & (places[left] < len(grams) - 1)
        left, at = left[more], at[more]
    return places


def _frequent(scores: DataFrame) -> int:
    """The least count of grams that go to every worker; -1 if all do."""
    power = F.when(F.col("c") > 0, F.length(F.bin("c"))).otherwise(0).alias("power")
    sizes = dict(scores.groupBy(power).count().collect())
    if sum(sizes.values()) <= MAX_BROADCAST_GRAMS:
        return -1
    total, least = 0, max(sizes) + 1
    for each in sorted(sizes, reverse=True):
        total += sizes[each]
        if total > MAX_BROADCAST_GRAMS:
            break
        least = each
    return 1 << (least - 1)


def _stream_scores(rows: DataFrame, scores: DataFrame, depth: int) -> DataFrame:
    """``a``, ``b`` (the row's digest) and ``lp``, parts of the score of each text's stream.

    ``rows`` hold an id and a text. Workers add the scores of frequent grams; of the others a
    text gives one row each, which are joined with the scores.
    """
    least = _frequent(scores)
    table = scores.where(F.col("c") >= least).select("gram", "lp").toArrow()
    grams, values = table["gram"].to_numpy(), table["lp"].to_numpy()
    del table
    slots = _hashed(grams)
    # The last entry is no gram.
    shared = rows.sparkSession.sparkContext.broadcast((np.append(grams, -1), np.append(values, 0.0), slots))
    del grams, values, slots
    names = ["a", "b", "gram", "n", "lp"]

    def score_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lps, slots = shared.value
        for part in batches:
            held: list[list[np.ndarray]] = []
            size = 0
            for name, body in zip(part.column(0).to_pylist(), blobs(part.column(1)), strict=True):
                _, (a, b) = _digest(name, body)
                for stream in stream_grams(body, depth):
                    own, n = np.unique(stream, return_counts=True)
                    at = _places(own, known, slots)
                    rest = at == len(known) - 1
                    # The sum's number is below those of grams, and differs between texts.
                    own = np.append(own[rest], a | np.int64(-1 << 63))
                    lp = np.zeros(len(own))
                    lp[-1] = n @ lps[at]
                    held.append([np.full(len(own), a), np.full(len(own), b), own, np.append(n[rest], 1), lp])
                    size += len(own)
                    if size > _FLUSH:
                        yield _columns(held, names)
                        held, size = [], 0
            if held:
                yield _columns(held, names)

    parts = rows.mapInArrow(score_streams, "a long, b long, gram long, n long, lp double")
    if least < 0:
        return parts.select("a", "b", "lp")
    rare = scores.where(F.col("c") < least).select("gram", F.col("lp").alias("own"))
    total = F.col("lp") + F.coalesce(F.col("n") * F.col("own"), F.lit(0.0))
    return parts.join(rare, "gram", "left").select("a", "b", total.alias("lp"))


def _columns(rows: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names=names)


def score(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    head: int = HEAD,
) -> DataFrame:
    """Scores of all texts by a model of the rows where ``learn`` is true.

    Columns: the id, ``n_tokens`` (words and the end), ``n_known`` (of them learned),
    ``train_tokens``, ``base_score`` (add-one unigrams), ``score`` (context-tree weighting),
    both log10, and ``n_bytes`` (of the modelled text; -score / n_bytes is the code length a
    byte). A null text is an empty one, a null ``learn`` is false. Equal rows are scored once
    and come back as often as given. Without rows to learn from every decision is even.
    """
    rows, (key, text) = shielded(docs.withColumn("learn", F.coalesce(learn, F.lit(False))), id_col, text_col)
    id_type = rows.schema[key].dataType.simpleString()
    both = docs.select(F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_col).alias("text"))
    tokens = stored(_token_counts(both), "tokens")
    known = F.col("c") > 0
    total, distinct = tokens.agg(F.sum("c"), F.count(F.when(known, 1))).first()
    total = total or 0
    scores = stored(gram_scores(stored(gram_counts(both, depth), "grams"), depth), "scores")
    floor = np.log10(total + distinct + 1)

    top = tokens.orderBy(F.desc("c"), "token").limit(head).toArrow()
    table = {
        bytes(token): (c > 0, float(np.log10(c + 1) - floor))
        for token, c in zip(top["token"].to_pylist(), top["c"].to_pylist(), strict=True)
    }
    shared = docs.sparkSession.sparkContext.broadcast(table)
    del top, table
    layout = f"a long, b long, id {id_type}, copies long, n long, bytes long, known long, base double, token binary, tf long"
    names = [part.split()[0] for part in layout.split(", ")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for part in batches:
            kind = part.column(0).type
            own: list[tuple] = []
            rare: list[tuple[int, int]] = []
            sizes: list[int] = []
            words: list[bytes] = []
            times: list[int] = []

            def batch(kind=kind, own=own, rare=rare, sizes=sizes, words=words, times=times) -> pa.RecordBatch:
                # Texts first, then the words of texts that the joined table scores.
                columns = list(zip(*own, strict=True)) or [()] * 9
                more = len(words)
                ab = np.repeat(np.array(rare, np.int64).reshape(-1, 2), sizes, axis=0)
                given = [np.append(np.array(columns[i], np.int64), ab[:, i]) for i in (0, 1)]
                named = pa.concat_arrays([pa.array(columns[2], kind), pa.nulls(more, kind)])
                none = np.zeros(more, np.int64)
                counted = [np.append(np.array(columns[i], np.int64), none) for i in (3, 4, 5, 6)]
                base = np.append(np.array(columns[7], float), np.zeros(more))
                tf = np.append(np.zeros(len(own), np.int64), np.array(times, np.int64))
                tokens = pa.array([*columns[8], *words], pa.binary())
                made = [*map(pa.array, given), named, *map(pa.array, counted), pa.array(base), tokens, pa.array(tf)]
                for each in (own, rare, sizes, words, times):
                    each.clear()
                return pa.record_batch(made, names=names)

            for name, body in zip(part.column(0).to_pylist(), blobs(part.column(1)), strict=True):
                digest, (a, b) = _digest(name, body)
                counts = Counter(words_of(body))
                size = sum(n * (len(w) + 1) for w, n in counts.items()) + 2
                n_tokens = sum(counts.values()) + 1
                counts[END] += 1
                n_known, base, before = 0, 0.0, len(words)
                for word, n in counts.items():
                    found = frequent.get(word)
                    if found is None:
                        words.append(word)
                        times.append(n)
                    else:
                        n_known += n * found[0]
                        base += n * found[1]
                rare.append((a, b))
                sizes.append(len(words) - before)
                # No word holds a space, so this row meets none in the join.
                own.append((a, b, name, 1, n_tokens, size, n_known, base, b" " + digest))
                if len(words) > 50_000:
                    yield batch()
            if own:
                yield batch()

    counted = rows.select(key, text).mapInArrow(count, layout)
    rare = tokens.select(
        "token",
        known.cast("long").alias("t_known"),
        (F.log10(F.col("c") + 1) - float(floor)).alias("t_base"),
    )
    joined = counted.join(rare, "token", "left").select(
        "a",
        "b",
        "id",
        "copies",
        "n",
        "bytes",
        (F.col("known") + F.coalesce(F.expr("tf * t_known"), F.lit(0))).alias("known"),
        (F.col("base") + F.coalesce(F.expr("tf * t_base"), F.lit(0.0))).alias("base"),
        F.lit(0.0).alias("score"),
    )
    nothing = [F.lit(0).cast("long").alias(c) for c in ("copies", "n", "bytes", "known")]
    streams = _stream_scores(rows.select(key, text), scores, depth).select(
        "a", "b", F.lit(None).cast(id_type).alias("id"), *nothing, F.lit(0.0).alias("base"), F.col("lp").alias("score")
    )
    joined = joined.unionByName(streams)
    sums = joined.groupBy("a", "b").agg(
        F.max("id").alias("id"), *(F.sum(c).alias(c) for c in ("copies", "n", "bytes", "known", "base", "score"))
    )
    each = F.expr("explode(sequence(1L, copies))")
    return sums.withColumn("copy", each).select(
        F.col("id").alias(id_col),
        F.expr("n div copies").alias("n_tokens"),
        F.expr("known div copies").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
        F.expr("bytes div copies").alias("n_bytes"),
    )
