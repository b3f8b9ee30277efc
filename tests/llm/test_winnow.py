import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.cases import no_documents, odd_documents
from tripweave.llm import winnow
from tripweave.llm.queries import op8_winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, span=10):
    words, hit, found = words_of(text), set(), set()
    for name, body in items:
        own = words_of(body)
        n = min(span, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(name)
    return len(words), len(hit), {str(f) for f in found if f is not None}


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    found = {r.doc_id: r for r in op8_winnowing(spark, small).collect()}
    assert len(found) == len(docs)
    for doc, text in docs:
        n, hits, names = plain(text, items)
        row = found[doc]
        assert (row.n_words, row.n_hit, row.n_items) == (n, hits, len(names))
        assert row.contaminated == (hits > 0)
        assert row.items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    assert any(row.contaminated for row in found.values())


def test_random_texts_in_blocks(spark):
    """Few different words: many matches, short items, repeats, several blocks."""
    draw = random.Random(3)

    def text(n):
        return draw.choice([" ", ", ", "\n"]).join(draw.choice("a B c dé") for _ in range(n))

    items = [(i, text(draw.choice([0, 1, 2, 3, 5, 9, 10, 11, 14, 20]))) for i in range(40)]
    items += [(40, None), (None, "only null id"), (3, "again and again"), (3, items[0][1])]
    docs = [(i, text(draw.randint(0, 120)) + draw.choice(["", " only NULL id", " again, and again"])) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for block in (30, 10_000):
        column = winnow.contamination(F.col("text"), bench, block_words=block)
        for row in frame.select("doc_id", column.alias("r")).collect():
            n, hits, names = plain(docs[row.doc_id][1], items)
            assert row.r.n_words == n and set(row.r["items"]) == names
            assert sum(s.b - s.a for s in row.r.spans) == hits


def test_odd_rows(spark):
    docs = odd_documents(spark)
    bench = spark.createDataFrame([(1, "road of words and more words the long road of words and")], "item_id long, text string")
    rows = docs.select("doc_id", "text", winnow.contamination(F.col("text"), bench).alias("r")).collect()
    assert len(rows) == docs.count()
    for row in rows:
        n, hits, names = plain(row.text if row.doc_id != 6 else "", [(1, bench.first().text)])
        if row.doc_id == 6:
            assert row.r.n_words == 160_000 and row.r["items"] == ["1"]
        else:
            assert (row.r.n_words, row.r["items"], hits) == (n, [], 0)
    empty = bench.limit(0)
    assert docs.select(winnow.contamination(F.col("text"), empty).alias("r")).where("size(r.spans) > 0").count() == 0
    assert no_documents(spark).select(winnow.contamination(F.col("text"), bench)).count() == 0


def test_long_words_and_block_borders():
    texts = [b"x" * 3_000_000 + b" tail of text", b"y " * 700_000, b"tail of text"]
    words = winnow._Words(texts)
    assert words.counts.tolist() == [4, 700_000, 3]
    assert words.hashes[1:4].tolist() == words.hashes[-3:].tolist()
    assert len(set(words.hashes[4:-3].tolist())) == 1
