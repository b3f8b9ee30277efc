import numpy as np
import pytest

from tests.llm.test_simhash import plain_components
from tripweave.llm import capfilters
from tripweave.llm.queries import op3_cap_filters


def plain(rows, threshold=0.93):
    units = [
        None if v is None or not len(v) or label is None or any(x is None for x in v) or not np.isfinite(v).all() or not np.any(v)
        else np.array(v, float) / np.linalg.norm(v)
        for _, v, label in rows
    ]

    def near(a, b):
        x, y = units[a], units[b]
        if x is None or y is None or rows[a][2] != rows[b][2] or len(x) != len(y):
            return False
        return x @ y >= threshold

    links = [sum(near(a, b) for b in range(len(rows)) if b != a) for a in range(len(rows))]
    parts = plain_components([r[0] for r in rows], near)
    return sorted((r[0], n, c, r[0] == c) for r, n, c in zip(rows, links, parts, strict=True))


def clustered(seed, clusters, size, dimensions=64):
    draw, rows = np.random.default_rng(seed), []
    for c in range(clusters):
        centre = draw.standard_normal(dimensions)
        for _ in range(size):
            noise = draw.standard_normal(dimensions) * draw.uniform(0, 0.3)
            rows.append((len(rows), [float(x) for x in (centre + noise).astype(np.float32)], c % 3))
    return rows


def test_links_of_clusters(spark):
    rows = clustered(1, 60, 20)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = sorted(tuple(r) for r in capfilters.near_duplicates(frame).collect())
    wanted = plain(rows)
    linked = sum(r[1] for r in wanted)
    assert all(f[1] <= w[1] for f, w in zip(found, wanted, strict=True))
    assert sum(r[1] for r in found) >= 0.99 * linked > 1000
    assert sum(f[2:] == w[2:] for f, w in zip(found, wanted, strict=True)) >= 0.99 * len(rows)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = sorted(tuple(r) for r in op3_cap_filters(spark, folder).collect())
    assert found == plain(rows)


def test_odd_vectors(spark):
    one = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, one, 1), (2, one, 1), (3, [2 * x for x in one], 1), (4, one, 2), (5, one, None), (6, None, 1),
        (7, [0.0] * 4, 1), (8, [1.0, None, 3.0, 4.0], 1), (9, [1.0, float("nan"), 3.0, 4.0], 1), (10, [], 1),
        (11, [float("inf")] * 4, 1), (12, one[:3], 1), (13, [1e-30 * x for x in one], 1), (14, [-x for x in one], 1),
        (15, [0.0, -0.0, 0.0, 1.0], 3), (16, [0.0, 0.0, 0.0, 1.0], 3),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for extra in ("node", "v", "filter"):
        frame = frame.withColumn(extra, frame.label)
    assert sorted(tuple(r) for r in capfilters.near_duplicates(frame).collect()) == plain(rows)
    assert capfilters.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("vectors", [1, 1000, 100_000, 10_000_000])
def test_codes_grow_with_the_vectors(vectors):
    code = capfilters.plan_code(64, vectors)
    assert code.size ** code.blocks >= vectors / 4
