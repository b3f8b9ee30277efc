import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import LONG, no_documents, odd_documents
from tripweave.llm import divergence, queries

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
POINTS = ".,;:!?'\"()-"


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered), failed,
    )


def plain_words(text):
    lowered = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else " " if c in POINTS else c for c in text)
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def plain_classes(text):
    tests = ("[aeiou]", "[b-df-hj-np-tv-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"[.,;:!?'\"()\-]")
    counts = [len(re.findall(t, text)) for t in tests]
    two = sum(0x80 <= ord(c) < 0x800 for c in text)
    more = sum(ord(c) >= 0x800 for c in text)
    return [*counts, len(text) - sum(counts) - two - more, two, more]


def plain_references(docs):
    taught = [(lang, text) for lang, text in docs if lang is not None and text and not plain_base(text)[-1]]
    words, classes = {}, {}
    for lang, text in taught:
        words.setdefault(lang, Counter()).update(plain_words(text))
        classes[lang] = [a + b for a, b in zip(classes.get(lang, [0] * 9), plain_classes(text))]
    every, made = sum(c.total() for c in words.values()), {}
    for lang, counts in words.items():
        n = counts.total()
        if n >= max(2000, every / 1000):
            common = {w: c / n for w, c in counts.items() if c >= 0.002 * n}
            made[lang] = ([c / sum(classes[lang]) for c in classes[lang]], common)
    return made


def plain_distance(found, reference):
    size = sum(found)
    p = [f / size for f in found]
    apart = 0
    for a, b in zip(p, reference):
        m = (a + b) / 2
        apart += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
    return math.sqrt(max(0, apart - (sum(b > 0 for b in reference) - 1) / (8 * size * math.log(2))))


def plain_kept(text, lang, known):
    if plain_base(text)[-1]:
        return False, None, None
    if not known or (lang is not None and lang not in known):
        return True, None, None
    words, classes, results = Counter(plain_words(text)), plain_classes(text), {}
    for name, (class_shares, common) in known.items():
        by_class = plain_distance(classes, class_shares) if sum(classes) >= 300 else None
        by_word = None
        if words.total() >= 100:
            counts = [words[w] for w in common]
            by_word = plain_distance([*counts, words.total() - sum(counts)], [*common.values(), 1 - sum(common.values())])
        results[name] = by_class, by_word
    excess = {n: max((d for d in ((c or 0) / 0.3, (w or 0) / 0.3)), default=0) for n, (c, w) in results.items()}
    name = lang if lang is not None and excess[lang] <= 1 else min(excess, key=lambda n: (excess[n], n != lang, n))
    return excess[name] <= 1, *results[name]


def test_query_equals_a_plain_version(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").collect()
    known = plain_references([(r.lang, r.text) for r in docs])
    assert known.keys() == {"en", "de", "fr", "es"}
    found = {r.doc_id: r for r in queries.op12_distribution_divergence(spark, small).collect()}
    assert len(found) == len(docs)
    for row in docs:
        got = found[row.doc_id]
        assert tuple(got[name] for name in BASE) == plain_base(row.text)
        kept, by_class, by_word = plain_kept(row.text, row.lang, known)
        assert got.kept == kept, row.doc_id
        assert got.class_distance == (by_class and pytest.approx(by_class, abs=1e-9))
        assert got.word_distance == (by_word and pytest.approx(by_word, abs=1e-9))


def test_clean_texts_stay_and_junk_goes(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = queries.op12_distribution_divergence(spark, folder).join(labels, "doc_id").where("NOT base_failed")
    rows = {(r.quality, r.kept): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    assert (1, False) not in rows and rows[1, True] > 250
    assert rows[0, False] > 4 * rows.get((0, True), 0)


def test_references_are_counts_of_all_texts(spark):
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(800)]
    docs = []
    for i in range(260):
        words = draw.choices(vocabulary, [1 / (j + 1) for j in range(800)], k=draw.randrange(10, 120))
        docs.append((draw.choice(["aa", "aa", "bb", None]), ". ".join(words).title()))
    docs += [("cc", "rare language " * 3 + "with only a few words of its own " * 2), ("aa", "the same " * 90)]
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(7)
    known, plain = divergence.references(frame), plain_references(docs)
    assert known.keys() == plain.keys() == {"aa", "bb"}
    for lang, (classes, common) in plain.items():
        own = known[lang]
        assert own.classes == pytest.approx(classes)
        assert dict(zip(own.words, own.shares)) == pytest.approx({w.encode(): s for w, s in common.items()})
        assert own.shares.sum() == pytest.approx(1) and len(own.shares) == len(common) + 1


@pytest.mark.parametrize("seed", range(20))
def test_repeated_windows(seed):
    draw = random.Random(seed)
    words = draw.choices("abcd", k=draw.randrange(40))
    words += words[: draw.randrange(20)] + draw.choices("efgh", k=draw.randrange(9)) + words[-11:]
    text = "".join(w + draw.choice([" ", "\n", "\t \x0b"]) for w in words)
    got = divergence.measure(text.encode())
    assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words, got.base_failed) == plain_base(text)


def test_a_text_without_a_reference_is_kept_by_the_plain_rules():
    sound = " ".join(f"word{i}" for i in range(200)).encode()
    other = divergence.Reference(divergence.class_counts(b"abc " * 9) / 36, (b"the",), np.array([0.5, 0.5]))
    known = divergence.References(en=other)
    assert divergence.judge(sound, "xx", known) | {"kept": True, "reference": None} == divergence.judge(sound, "xx", known)
    assert not divergence.judge(sound, None, known)["kept"] and divergence.judge(sound, None, known)["reference"] == "en"
    assert divergence.judge(sound, "en", divergence.References())["kept"]
    # Too short for either comparison.
    short = " ".join(f"W{i}#" for i in range(30)).encode()
    row = divergence.judge(short, "en", known)
    assert row["kept"] and row["class_distance"] is None and row["word_distance"] is None


def test_odd_rows_and_none(spark):
    docs = odd_documents(spark)
    known = divergence.references(docs)
    assert known == {}  # the one long text repeats itself
    found = docs.select("doc_id", "text", divergence.judged(F.col("text"), F.col("lang"), known, spark).alias("f"))
    rows = found.select("doc_id", "text", "f.*").collect()
    assert len(rows) == docs.count()
    for row in rows:
        if row.text != LONG:  # too slow for the plain version
            assert tuple(row[name] for name in BASE) == plain_base(row.text)
        assert row.kept == (not row.base_failed)
    assert divergence.references(no_documents(spark)) == {}
