import random

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import no_documents, odd_documents
from tripweave.llm import weaklabel
from tripweave.llm.queries import op10_weak_labels


def test_em_finds_the_accuracies_of_labellers():
    draw, counts, truth = random.Random(1), {}, {}
    rights = (0.9, 0.8, 0.7, 0.85, 0.6)
    for _ in range(20_000):
        good = draw.random() < 0.7
        pattern = "".join(
            "." if draw.random() < 0.2 else "+-"[(draw.random() < right) != good] for right in rights
        )
        counts[pattern] = counts.get(pattern, 0) + 1
        truth[pattern] = truth.get(pattern, 0) + good
    found = weaklabel.accuracies(counts)
    gap = sum(abs(found[p] * n - truth[p]) for p, n in counts.items()) / 20_000
    assert gap < 0.04
    sure = sum(n if (found[p] >= 0.5) == (truth[p] * 2 >= n) else 0 for p, n in counts.items())
    assert sure > 0.95 * 20_000
    assert weaklabel.accuracies({}) == {}


def test_held_labels(spark):
    """Against the table of true labels, which training never sees."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality IS NOT NULL").select("doc_id", "quality")
    rows = op10_weak_labels(spark, folder).join(labels.dropDuplicates(["doc_id"]), "doc_id").collect()
    clean = [r for r in rows if r.quality == 1]
    poor = [r for r in rows if r.quality == 0]
    kept = sum(r.kept for r in clean) / len(clean)
    wrong = sum(r.kept for r in poor) / len(poor)
    print("kept of good", kept, "kept of bad", wrong, len(clean), len(poor))
    assert kept > 0.95 and wrong < 0.5


def test_gradient_equals_its_plain_sum(spark):
    import numpy as np

    texts = ["Some words here.", "OTHER words ###", "x 1 2 3"]
    goods = [0.9, 0.2, 0.5]
    pairs = [weaklabel.features(t.encode()) for t in texts]
    rows = [(g, at.tolist(), value.tolist()) for g, (at, value) in zip(goods, pairs, strict=True)]
    frame = spark.createDataFrame([*rows, (0.3, [], [])], "good double, at array<int>, value array<double>")
    weights = np.sin(np.arange(weaklabel.BUCKETS))
    wanted = np.zeros(weaklabel.BUCKETS + 1)
    for good, at, value in [*rows, (0.3, [], [])]:
        margin = sum(weights[a] * v for a, v in zip(at, value, strict=True)) + 0.4
        error = 1 / (1 + np.exp(-margin)) - good
        for a, v in zip(at, value, strict=True):
            wanted[a] += error * v
        wanted[-1] += error
    assert weaklabel._gradient(frame.repartition(3), weights, 0.4) == pytest.approx(wanted)


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("draw", F.lit(1))
    scorer = weaklabel.train(docs, steps=3)
    rows = docs.select(weaklabel.scored(F.col("text"), scorer, spark).alias("r")).collect()
    assert len(rows) == docs.count() and all(0 <= r.r.score <= 1 and r.r.posterior is not None for r in rows)
    even = weaklabel.train(no_documents(spark))
    rows = docs.select(weaklabel.scored(F.col("text"), even, spark).alias("r")).collect()
    assert {(r.r.posterior, r.r.score) for r in rows} == {(None, 0.5)}


def test_workers_hold_few_texts_and_words():
    """Of a batch only some texts at a time, and a bounded number of remembered words."""
    import tracemalloc

    import pyarrow as pa

    column = pa.array([None, *(f"{k:05d}" * 1000 for k in range(4000))], pa.string())
    tracemalloc.start()
    found = [(len(body), body[:5]) for body in weaklabel.bodies(column)]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(0, b""), *((5000, b"%05d" % k) for k in range(4000))]
    assert most < 5_000_000
    buckets = weaklabel._Buckets()
    alone = {b"w%d" % k: weaklabel._Buckets()[b"w%d" % k] for k in range(0, 300_000, 1000)}
    for k in range(300_000):
        word = b"w%d" % k
        assert buckets[word] == alone.get(word, buckets[word]) and len(buckets) <= 1 << 17


def test_batches_of_many_texts(spark, monkeypatch):
    """Each text of a batch is trained on and judged once, in its place."""
    texts = [f"Text number {k} of {k % 7} with some Words, and a few ### more." for k in range(700)] + [None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    seen, plain = [], weaklabel._gradient
    monkeypatch.setattr(weaklabel, "_gradient", lambda frame, *rest: seen.append(frame) or plain(frame, *rest))
    scorer = weaklabel.train(docs, steps=2)
    wanted = sorted([len(weaklabel.features((t or "").encode())[0]) for t in texts])
    assert sorted(len(r["at"]) for r in seen[0].collect()) == wanted
    rows = docs.select("doc_id", weaklabel.scored(F.col("text"), scorer, spark).alias("r")).collect()
    assert len(rows) == len(texts)
    for row in rows:
        body = (texts[row.doc_id] or "").encode()
        mark = weaklabel.votes(body)
        assert (row.r.votes, row.r.posterior, row.r.score) == (mark, scorer.posteriors[mark], scorer(body))
