"""Near-duplicate vectors by spherical-cap filters from a random product code.

A filter is a direction; a vector passes it if its projection on the direction exceeds a
bound, and two close vectors are likely to pass the same. Directions are a product code: the
rotated space is cut into blocks, each block has its own list of random code vectors, and
every combination of one code vector a block is a direction. So a vector's filters are list-decoded
from a few projections a block, without trying all directions. Vectors that share a label and
a filter are joined, and the cosine of each pair is verified in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import shielded, stored
from tripweave.llm.components import connected_components

THRESHOLD = 0.93
# Share of pairs at the threshold itself that may miss each other.
MISSED = 0.0005
# Vectors of one label that a filter takes on average.
PER_FILTER = 1.0
BLOCKS = 2
# Codes of independent rotations: a vector whose weight lies unevenly in the blocks of one
# lies evenly in those of another. Measured on pairs at the threshold, one code of so many
# filters as these together misses one in a hundred.
CODES = 5


@dataclass(frozen=True)
class Code:
    """``blocks`` lists of ``size`` code vectors, and the bound on a vector's summed projections.

    There are ``CODES`` of them, which differ in ``seed``.
    """

    dimensions: int
    blocks: int
    size: int
    bound: float
    seed: int = 3

    def parts(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """The rotation, and each block's code vectors, scaled to unit directions together."""
        draw = np.random.default_rng(self.seed)
        rotation = np.linalg.qr(draw.standard_normal((self.dimensions, self.dimensions)))[0]
        edges = np.linspace(0, self.dimensions, self.blocks + 1).astype(int)
        lists = []
        for low, high in zip(edges, edges[1:], strict=False):
            code = draw.standard_normal((self.size, high - low))
            code /= np.linalg.norm(code, axis=1, keepdims=True)
            lists.append(code * math.sqrt((high - low) / self.dimensions))
        return rotation, lists


def plan_code(dimensions: int, vectors: int, threshold: float = THRESHOLD, missed: float = MISSED) -> Code:
    """A code for so many vectors of one label.

    The more vectors, the more and the narrower the caps, so that a cap keeps about
    ``PER_FILTER`` of them; the number of filters that a vector passes follows from the share
    of missed pairs. Projections on random directions are nearly normal.
    """
    normal = NormalDist()
    share = min(0.2, PER_FILTER / max(vectors, 1))
    bound = -normal.inv_cdf(share)
    both = _passing_both(bound, threshold) / share
    # Vectors differ in how many filters they pass, so it takes three times as many as if not.
    mean = 3.0 * math.log(1 / missed) / both / CODES
    blocks = min(BLOCKS, dimensions)
    size = max(2, math.ceil((mean / share) ** (1 / blocks)))
    return _calibrated(Code(dimensions, blocks, size, bound / math.sqrt(dimensions)), mean)


def _calibrated(code: Code, mean: float) -> Code:
    """The code with the bound that random vectors exceed so many times on average.

    The sum of a few projections is less than normal in its tail.
    """
    unit = np.random.default_rng(code.seed).standard_normal((40, code.dimensions))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    low, high = 0.0, code.bound
    for _ in range(12):
        middle = (low + high) / 2
        passed = np.mean([len(f) for f in _decoder_of(replace(code, bound=middle))(unit, 8 * mean)])
        low, high = (middle, high) if passed >= mean else (low, middle)
    return replace(code, bound=low)


def _passing_both(bound: float, correlation: float) -> float:
    """Probability that two standard normals of this correlation both exceed the bound."""
    normal, spread = NormalDist(), math.sqrt(1 - correlation**2)
    xs = np.linspace(bound, bound + 6, 600)
    tail = np.array([1 - normal.cdf((bound - correlation * x) / spread) for x in xs])
    return float(np.trapezoid(np.exp(-xs * xs / 2) / math.sqrt(2 * math.pi) * tail, xs))


def _decoder(code: Code):
    """The list decoder of all codes of these measures."""
    each = [_decoder_of(replace(code, seed=code.seed + at)) for at in range(CODES)]

    def decode(unit: np.ndarray) -> Iterator[np.ndarray]:
        for found in zip(*(one(unit) for one in each), strict=True):
            yield np.concatenate([f * CODES + at for at, f in enumerate(found)])

    return decode


def _decoder_of(code: Code):
    rotation, lists = code.parts()

    def decode(unit: np.ndarray, most: float = math.inf) -> Iterator[np.ndarray]:
        """For each vector the numbers of all directions that it exceeds, or of its nearest.

        ``most`` stands in for more than so many, where only their number is asked for.
        """
        turned = unit @ rotation.T
        edges = np.linspace(0, code.dimensions, code.blocks + 1).astype(int)
        scores = [
            turned[:, low:high] @ codes.T
            for low, high, codes in zip(edges, edges[1:], lists, strict=False)
        ]
        for at in range(len(unit)):
            found = np.zeros(1, np.int64)
            reached = np.zeros(1)
            # The best that the blocks to come can add tells which prefixes are worth keeping.
            hope = [sum(float(s[at].max()) for s in scores[b + 1 :]) for b in range(code.blocks)]
            bound = min(code.bound, hope[0] + float(scores[0][at].max()) - 1e-9)
            for b in range(code.blocks):
                order = np.argsort(-scores[b][at])
                values = scores[b][at][order]
                enough = np.searchsorted(-values, reached + hope[b] - bound, side="right")
                if enough.sum() > most and b == code.blocks - 1:
                    found = np.zeros(int(min(enough.sum(), 64 * most)), np.int64)
                    break
                found = np.concatenate(
                    [f * code.size + order[:n] for f, n in zip(found, enough, strict=True)]
                )
                reached = np.concatenate([r + values[:n] for r, n in zip(reached, enough, strict=True)])
            yield found

    return decode


def _unit(values: list) -> np.ndarray | None:
    """The vector at length one; None if it is null, zero or not finite."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    vector = np.array(values, np.float64)
    with np.errstate(all="ignore"):
        scale = np.abs(vector).max()
        if not np.isfinite(scale) or scale == 0:
            return None
        vector = vector / scale
        return vector / np.linalg.norm(vector)


def _units(rows: np.ndarray) -> np.ndarray:
    """Rows that are neither zero nor infinite, at length one."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    missed: float = MISSED,
) -> tuple[DataFrame, DataFrame]:
    """Members and links of a similarity join within labels.

    Members: id and ``node`` (null for a vector that links with nothing: null or zero, a null
    or non-finite component, a null label). Equal vectors of a label share a node. Links:
    ``src``, ``dst`` nodes with cosine at or above the threshold, each pair once. Vectors of
    different lengths do not link.
    """
    rows, (key, vector, label) = shielded(vectors, id_col, vector_col, label_col)
    rows = rows.select(
        F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("label")
    )
    bad = "v IS NULL OR label IS NULL OR exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    bad += " OR NOT exists(v, x -> x <> 0)"
    fit = F.coalesce(F.expr(bad), F.lit(True))
    # -0.0 and 0.0 are one component.
    rows = rows.withColumn("v", F.when(~fit, F.transform("v", lambda x: x + F.lit(0.0))))
    content = F.struct(F.xxhash64("label", "v").alias("a"), F.xxhash64(F.lit(7), "v", "label").alias("b"))
    rows = rows.withColumn("content", F.when(F.col("v").isNotNull(), content))
    nodes = rows.where("v IS NOT NULL").groupBy("content").agg(
        F.min("id").alias("low"), F.first("label").alias("label"), F.first("v").alias("v"),
    )
    # Nodes are numbered by what they hold, not by when they come.
    nodes = nodes.withColumn("node", F.col("content.a"))
    nodes = stored(nodes.select("node", "low", "label", "v"), "vectors")
    members = rows.select("id", F.col("content.a").alias("node"))

    sizes = nodes.groupBy("label", F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    plans = sizes.groupBy("d").agg(F.max("n").alias("n")).collect()  # one row a vector length
    codes = {row.d: plan_code(row.d, row.n, threshold, missed) for row in plans}

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoders = {}
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            by_length: dict[int, list] = {}
            for node, name, values in zip(*columns, strict=True):
                by_length.setdefault(len(values), []).append((node, name, _unit(values)))
            for length, group in by_length.items():
                if length not in decoders:
                    decoders[length] = _decoder(codes[length])
                out = [[], [], []]
                found = decoders[length](np.stack([unit for _, _, unit in group]))
                for (node, name, _), passed in zip(group, found, strict=True):
                    out[0] += [node] * len(passed)
                    out[1] += [name] * len(passed)
                    out[2] += passed.tolist()
                yield pa.record_batch(
                    [
                        pa.array(out[0], pa.int64()),
                        pa.array(out[1], batch.column(1).type),
                        pa.array(out[2], pa.int64()),
                    ],
                    names=["node", "label", "filter"],
                )

    layout = f"node long, label {nodes.schema['label'].dataType.simpleString()}, filter long"
    passed = nodes.select("node", "label", "v").mapInArrow(filters, layout)
    passed = stored(passed, "filters")
    a, b = passed.alias("a"), passed.alias("b")
    met = (F.col("a.filter") == F.col("b.filter")) & (F.col("a.label") == F.col("b.label"))
    pairs = a.join(b, met & (F.col("a.node") < F.col("b.node")))
    pairs = pairs.select(F.col("a.node").alias("src"), F.col("b.node").alias("dst")).distinct()
    held = nodes.select("node", "v")
    pairs = pairs.join(held.withColumnsRenamed({"node": "src", "v": "v1"}), "src")
    pairs = pairs.join(held.withColumnsRenamed({"node": "dst", "v": "v2"}), "dst")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(i) for i in (2, 3)]
            sizes = [np.diff(part.offsets.to_numpy()) for part in lists]
            keep = np.zeros(len(batch), bool)
            for size in np.unique(sizes[0]).tolist():
                rows = np.flatnonzero((sizes[0] == size) & (sizes[1] == size))
                x, y = (
                    part.values.to_numpy()[part.offsets.to_numpy()[rows][:, None] + np.arange(size)]
                    for part in lists
                )
                keep[rows] = np.einsum("ij,ij->i", _units(x), _units(y)) >= threshold
            yield batch.select([0, 1]).filter(pa.array(keep))

    pairs = pairs.select("src", "dst", "v1", "v2").mapInArrow(verified, "src long, dst long")
    return members.join(nodes.select("node", "low"), "node", "left"), stored(pairs, "pairs")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", **options) -> DataFrame:
    """Each vector's id, ``n_links``, ``component_id`` (smallest id reachable) and ``kept``.

    A vector links directly to the other vectors of its node and to all of the nodes linked
    with it. Vectors that link with nothing are their own component; a null id is never the
    smallest. Repeated rows count as vectors of their own.
    """
    members, links = near_vectors(vectors, id_col, **options)
    members = stored(members, "members")
    sizes = members.where("node IS NOT NULL").groupBy("node").agg(
        F.count(F.lit(1)).alias("size"), F.min("low").alias("low")
    )
    sizes = stored(sizes, "sizes")
    both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    size_of = sizes.select(F.col("node").alias("dst"), "size")
    others = both.join(size_of, "dst").groupBy(F.col("src").alias("node")).agg(F.sum("size").alias("others"))
    parts = connected_components(links)
    lowest = sizes.join(parts, "node").groupBy("component").agg(F.min("low").alias("least"))
    reach = parts.join(lowest, "component").select("node", "least")
    classes = sizes.join(others, "node", "left").join(reach, "node", "left").select(
        "node",
        (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
        F.coalesce("least", "low").alias("least"),
    )
    found = members.select("id", "node").join(classes, "node", "left")
    component = F.coalesce("least", "id")
    return found.select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
