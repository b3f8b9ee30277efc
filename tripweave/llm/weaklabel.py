"""Quality scores from weak labels.

Heuristic labellers vote good, bad or nothing on each text. Expectation-maximisation over the
counts of vote patterns estimates how often each labeller votes what for good and for bad
texts, without any true label, and with it each pattern's posterior. The posteriors of a
bounded sample of different texts then train a linear scorer on hashed features, which sees
the words and their shapes and not the labellers.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import blobs, shielded, stored

GOOD, BAD, NONE = "+", "-", "."
BUCKETS = 1 << 15
SAMPLE = 20_000
EM_ROUNDS = 50
STEPS = 40
# What a Python worker holds at a time: texts of a batch, and remembered words.
TEXTS = 256
WORDS = 1 << 17
_SIGNS = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_SHAPE = bytes.maketrans(
    bytes(range(97, 123)) + _UPPER + bytes(range(128, 256)) + _DIGITS, b"a" * 26 + b"A" * 26 + b"a" * 128 + b"0" * 10
)
# What ends words in tables, markup and noise, and seldom in prose.
_ODD_ENDS = tuple(bytes([c]) for c in b"#$%&*|~^=<>+_\\") + (b"!!", b"??")
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)


def _vote(value: float, good: tuple[float, float], fair: tuple[float, float]) -> str:
    """Good inside the inner interval, bad outside the outer, else none."""
    if good[0] <= value <= good[1]:
        return GOOD
    return NONE if fair[0] <= value <= fair[1] else BAD


def _share(part: int, whole: int) -> float:
    return part / whole if whole else 0.0


def votes(text: bytes) -> str:
    """One sign a labeller."""
    words = text.lower().split()
    n, size = len(words), len(text)
    if not n:
        return BAD + NONE * 8
    dense = size - text.count(b" ") - text.count(b"\n")
    signs = size - len(text.translate(None, _SIGNS))
    upper = size - len(text.translate(None, _UPPER))
    letters = size - len(text.translate(None, _LETTERS))
    digits = size - len(text.translate(None, _DIGITS))
    lines = [line for line in text.split(b"\n") if line]
    kinds = len(set(words))
    short = sum(1 for w in words if len(w) <= 3)
    ends = sum(1 for w in words if w.endswith((b".", b"!", b"?")))
    odd = sum(1 for w in words if w.endswith(_ODD_ENDS))
    enough = n >= 30
    infinite = float("inf")
    return "".join(
        [
            _vote(n, (60, infinite), (20, infinite)),
            _vote(_share(signs, dense), (0, 0.05), (0, 0.12)),
            _vote(_share(upper, letters), (0, 0.08), (0, 0.4)),
            _vote(_share(digits, dense), (0, 0.03), (0, 0.15)),
            _vote(_share(len(lines) - len(set(lines)), len(lines)), (0, 0.02), (0, 0.25)) if len(lines) > 2 else NONE,
            _vote(_share(kinds, min(n, 2000)), (0.45, infinite), (0.25, infinite)) if enough else NONE,
            _vote(_share(short, n), (0.2, 0.7), (0.1, 0.85)) if enough else NONE,
            _vote(_share(ends, n), (0.01, 0.25), (0.003, 0.5)) if enough else NONE,
            _vote(_share(odd, n), (0, 0.02), (0, 0.1)),
        ]
    )


LABELLERS = len(votes(b""))


def accuracies(counts: dict[str, int], rounds: int = EM_ROUNDS) -> dict[str, float]:
    """The posterior of being good for each pattern, by expectation-maximisation.

    Starts from the bad votes: the labellers look for faults, and good votes mean that one has
    found none. Patterns are at most three to the number of labellers.
    """
    if not counts:
        return {}
    patterns = sorted(counts)
    table = np.array([[(GOOD, BAD, NONE).index(v) for v in p] for p in patterns])
    weight = np.array([counts[p] for p in patterns], float)
    faults = (table == 1).sum(axis=1)
    good = np.array([0.95, 0.7, 0.2, 0.05])[np.minimum(faults, 3)]
    for _ in range(rounds):
        chances = []
        for share in (good, 1 - good):
            own = share * weight
            each = np.stack([((table == v) * own[:, None]).sum(axis=0) for v in range(3)], axis=1) + 0.5
            chances.append(np.log(each / each.sum(axis=1, keepdims=True)))
        prior = np.clip((good * weight).sum() / weight.sum(), 0.02, 0.98)
        places = np.arange(table.shape[1])
        odds = np.log(prior / (1 - prior)) + (
            chances[0][places, table].sum(axis=1) - chances[1][places, table].sum(axis=1)
        )
        good = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(patterns, good.tolist(), strict=True))


class _Buckets(dict):
    """The buckets of a word and of its shape, as one number; a worker remembers them."""

    def __missing__(self, word: bytes) -> int:
        shape = _RUNS.sub(rb"\1\1", word.translate(_SHAPE))
        found = zlib.crc32(b"w" + word.lower()) % BUCKETS * BUCKETS + zlib.crc32(b"s" + shape) % BUCKETS
        if len(self) >= WORDS:
            self.clear()
        self[word] = found
        return found


_BUCKETS = _Buckets()


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and word shapes, damped counts at length one."""
    counts = Counter(text.split())
    if not counts:
        return np.zeros(0, np.int64), np.zeros(0)
    both = np.array(list(map(_BUCKETS.__getitem__, counts)), np.int64)
    times = np.array(list(counts.values()), float)
    totals = np.bincount(both // BUCKETS, times, BUCKETS) + np.bincount(both % BUCKETS, times, BUCKETS)
    at = np.flatnonzero(totals)
    values = np.log1p(totals[at])
    return at, values / np.linalg.norm(values)


def bodies(column: pa.Array) -> Iterator[bytes]:
    """``blobs`` of a column, with the bytes of ``TEXTS`` texts in memory beside it, not of all."""
    for at in range(0, len(column), TEXTS):
        yield from blobs(column.slice(at, TEXTS))


def voted(text: Column) -> Column:
    """The votes on a text; a null text is an empty one."""

    @F.arrow_udf("string")
    def vote(texts: pa.Array) -> pa.Array:
        return pa.array([votes(t) for t in bodies(texts)], pa.string())

    return vote(text)


class Scorer:
    """The posteriors of vote patterns, and the linear scorer's weights and bias."""

    def __init__(self, posteriors: dict[str, float], weights: np.ndarray, bias: float):
        self.posteriors, self.weights, self.bias = posteriors, weights, bias

    def __call__(self, text: bytes) -> float:
        at, values = features(text)
        margin = float(self.weights[at] @ values) + self.bias
        return 1 / (1 + float(np.exp(-np.clip(margin, -30, 30))))


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, steps: int = STEPS) -> Scorer:
    """EM over all texts, then the scorer on at most ``sample`` different texts.

    The sample are the texts of smallest hash. Each step adds up gradients task by task; the
    driver sees one vector of fixed size a task. No rows give an even scorer.
    """
    rows, (text,) = shielded(docs, text_col)
    rows = rows.select(F.coalesce(text, F.lit("")).alias("text"))
    counts = rows.select(voted(F.col("text")).alias("votes")).groupBy("votes").count().collect()
    posteriors = accuracies({row.votes: row["count"] for row in counts})
    draw = F.xxhash64("text")
    drawn = rows.select(draw.alias("draw")).distinct().orderBy("draw").limit(sample)
    last = drawn.agg(F.max("draw")).first()[0]
    picked = rows.withColumn("draw", draw).where(F.col("draw") <= F.lit(last).cast("bigint"))
    picked = picked.groupBy("draw").agg(F.first("text").alias("text"))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(at, TEXTS) for batch in batches for at in range(0, batch.num_rows, TEXTS)):
            texts = blobs(part.column(0))
            pairs = [features(t) for t in texts]
            yield pa.record_batch(
                [
                    pa.array([posteriors[votes(t)] for t in texts], pa.float64()),
                    pa.array([p[0].astype(np.int32) for p in pairs], pa.list_(pa.int32())),
                    pa.array([p[1] for p in pairs], pa.list_(pa.float64())),
                ],
                names=["good", "at", "value"],
            )

    prepared = picked.select("text").mapInArrow(prepare, "good double, at array<int>, value array<double>")
    prepared = stored(prepared.coalesce(8), "sample")
    total = prepared.count()
    weights, bias = np.zeros(BUCKETS), 0.0
    speed = np.zeros(BUCKETS + 1)
    for _ in range(steps if total else 0):
        gradient = _gradient(prepared, weights, bias) / total
        gradient[:-1] += 1e-5 * weights
        speed = 0.8 * speed - 4.0 * gradient
        weights, bias = weights + speed[:-1], bias + speed[-1]
    return Scorer(posteriors, weights, float(bias))


def _gradient(prepared: DataFrame, weights: np.ndarray, bias: float) -> np.ndarray:
    shared = prepared.sparkSession.sparkContext.broadcast((weights, bias))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        total = np.zeros(BUCKETS + 1)
        for part in batches:
            goods, lists, values = part.column(0).to_numpy(), part.column(1), part.column(2)
            at, value = lists.flatten().to_numpy(), values.flatten().to_numpy()
            row = np.repeat(np.arange(len(goods)), np.diff(lists.offsets.to_numpy()))
            margins = np.bincount(row, w[at] * value, minlength=len(goods)) + b
            error = 1 / (1 + np.exp(-np.clip(margins, -30, 30))) - goods
            total[:-1] += np.bincount(at, error[row] * value, minlength=BUCKETS)
            total[-1] += error.sum()
        yield pa.record_batch([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sum"])

    sums = prepared.mapInArrow(add, "sum array<double>").toArrow()["sum"].to_pylist()
    shared.unpersist()
    return np.sum(np.array(sums), axis=0)


def scored(text: Column, scorer: Scorer, session) -> Column:
    """``votes``, the ``posterior`` of the votes (null for votes never met) and the ``score``."""
    shared = session.sparkContext.broadcast(scorer)

    @F.arrow_udf("struct<votes:string,posterior:double,score:double>")
    def judge(texts: pa.Array) -> pa.Array:
        own, marks, scores = shared.value, [], []
        for body in bodies(texts):
            marks.append(votes(body))
            scores.append(own(body))
        posteriors = pa.array([own.posteriors.get(mark) for mark in marks], pa.float64())
        return pa.StructArray.from_arrays(
            [pa.array(marks, pa.string()), posteriors, pa.array(scores, pa.float64())],
            names=["votes", "posterior", "score"],
        )

    return judge(text)
