import random

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.cases import LAYOUT, no_documents, odd_documents
from tripweave.llm import stages

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def random_text(seed, n=120):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(n))


def write_tables(spark, folder, rows, items):
    spark.createDataFrame(rows, LAYOUT).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_take_effect(spark, tmp_path):
    folder = str(tmp_path)
    passage = random_text(99, 30)
    rows = [(i, random_text(i), "en", "s", 1) for i in range(20)]
    rows += [(100 + i, random_text(3), "en", "s", 1) for i in range(5)]  # copies of 3
    rows += [(200, random_text(200) + " " + passage, "en", "s", 1)]  # contaminated
    rows += [(201, random_text(201) + " token=abcdefgh99 end", "en", "s", 1)]
    rows += [(202, None, "en", "s", 1), (203, "123 456", "en", "s", 1), (5, random_text(5), "en", "s", 1)]
    write_tables(spark, folder, rows, [(1, passage), (2, None)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert docs.columns == COLUMNS
            seen.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
    language, unique, clean, scanned = seen
    assert language == sorted([*range(20), 5, *range(100, 105), 200, 201])
    assert unique == [*range(20), 200, 201]
    assert clean == scanned == [*range(20), 201]
    texts = dict(spark.read.parquet(f"{folder}/secret_scan").select("doc_id", "text").collect())
    assert texts[201].endswith(" [MASKED] end") and texts[7] == random_text(7)
    assert {r.doc_id for r in docs.select("doc_id").collect()} == set(clean)


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.count() > 0 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows.columns)


def test_odd_rows(spark, tmp_path):
    folder = str(tmp_path)
    write_tables(spark, folder, [], [])
    for docs in (odd_documents(spark), no_documents(spark)):
        kept = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, folder)
            assert kept.columns == docs.columns, name
        found = sorted(((r.doc_id, r.n_chars) for r in kept.select("doc_id", "n_chars").collect()), key=str)
        wanted = [(-9, 2), (1, 1), (6, len("the long road of words and more words " * 20_000)), (7, 9), (8, 2), (None, 3)]
        assert found == (sorted(wanted, key=str) if docs.count() else [])
        assert stages.pack(spark, kept, folder).select(F.countDistinct("doc_id")).first()[0] == max(0, len(found) - 1)


def texts_kept(frame):
    return sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in frame.select("doc_id", "text").collect())


def test_every_text_is_judged_by_its_own_group(spark):
    """One id on two texts, near copies without an id, and groups that only rows without an id make up."""
    text = {n: random_text(n) for n in "abcdef"}
    near = {n: t.upper() for n, t in text.items()}  # of the same fingerprint
    rows = [(0, text["a"]), (2, text["a"]), (2, text["b"]), (3, near["b"]), (3, text["c"]), (3, text["c"])]
    rows += [(None, near["a"]), (None, text["d"]), (None, near["d"]), (None, text["e"]), (None, text["e"]), (7, text["f"]), (None, text["f"])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], LAYOUT).repartition(3)
    links = stages.simhash.near_duplicates(docs).select("fp", "component").distinct().collect()
    assert len({r.component for r in links}) == 6
    kept = stages.simhash_near_dedup(spark, docs, "")
    assert kept.columns == COLUMNS
    wanted = [(0, text["a"]), (2, text["b"]), (3, text["c"]), (7, text["f"]), (None, near["d"]), (None, text["e"])]
    assert texts_kept(kept) == sorted(((i is None, i or 0), t) for i, t in wanted)


def test_without_labels_lettered_texts_stay(spark):
    rows = [(i, random_text(i), None, "s", 1) for i in range(6)] + [(7, "12 34", None, "s", 1), (8, None, None, "s", 1)]
    docs = spark.createDataFrame(rows, LAYOUT)
    assert {i for (_, i), _ in texts_kept(stages.language_id(spark, docs, ""))} == set(range(6))


def test_only_wanted_languages_stay(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = stages.language_id(spark, docs, small, wanted=["de", "fr"])
    counts = {r.lang: r["count"] for r in kept.groupBy("lang").count().collect()}
    every = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    assert counts["de"] >= 0.9 * every["de"] and counts.get("en", 0) <= 0.05 * every["en"]
