import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.cases import no_documents, odd_documents
from tripweave.llm import langid
from tripweave.llm.queries import op5_language_id

WORD = re.compile(r"[^\W\d_]+")


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op5_language_id(spark, folder).collect()
    assert len(rows) == len(truth)
    tested = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in tested)
    assert len(tested) > 100 and right >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 for r in rows)


def test_unknown_words_fall_back_to_grams(spark):
    rows = [(i, text, lang) for i, (text, lang) in enumerate([("the then there other", "en"), ("straße größe über", "de")] * 5)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    classify = langid.Classifier(model)
    assert classify(b"thenother")[0] == "en" and classify("größer".encode())[0] == "de"
    assert classify("中文".encode())[0] in ("de", "en")  # no known character: the first language
    # a document of more words than a worker remembers
    many = " ".join(f"then{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(9000))
    assert classify(many.encode())[0] == "en"


def test_odd_rows(spark):
    docs = odd_documents(spark)
    model = langid.train(docs)
    rows = docs.select("doc_id", langid.predict(F.col("text"), model, spark).alias("r")).collect()
    assert len(rows) == docs.count()
    found = {r.doc_id: r.r for r in rows}
    assert [tuple(found[i]) for i in (2, 3, 4, 5)] == [("und", 0.0)] * 4
    assert found[6].lang == "en" and found[1].lang in model.languages
    nothing = langid.train(no_documents(spark))
    rows = docs.select(langid.predict(F.col("text"), nothing, spark).alias("r")).collect()
    assert {tuple(r.r) for r in rows} == {("und", 0.0)}


def test_the_sample_is_bounded_and_repeatable(spark):
    rows = [(i, f"word{chr(97 + i % 26)} text", "en") for i in range(500)] + [(1, "seul mot", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = [langid.train(docs.repartition(n), rows_per_language=50) for n in (1, 5)]
    assert models[0].words == models[1].words and models[0].languages == ["en", "fr"]
    assert "text" in models[0].words.split("\n") and (models[0].word_rows == models[1].word_rows).all()


def plain_scores(samples, text):
    """Log scores of each language, straight from the counts of all words and n-grams."""
    languages = sorted({lang for _, lang in samples})
    words = {lang: Counter() for lang in languages}
    for body, lang in samples:
        words[lang].update(WORD.findall(body.lower()))
    grams = {(lang, n): Counter() for lang in languages for n in langid.ORDERS}
    for lang in languages:
        for word, count in words[lang].items():
            padded = f"<{word}>"
            for n in langid.ORDERS:
                for i in range(len(padded) - n + 1):
                    if padded[i : i + n] != "<":
                        grams[lang, n][padded[i : i + n]] += count

    def logs(feature, tables):
        every = sum(t[feature] for t in tables.values()) / sum(t.total() for t in tables.values())
        return {lang: math.log((t[feature] + 20 * every) / (t.total() + 20)) for lang, t in tables.items()}

    total = dict.fromkeys(languages, 0.0)
    for word, times in Counter(WORD.findall(text.lower())).items():
        if any(word in t for t in words.values()):
            parts, weight = [logs(word, words)], times
        else:
            padded, parts, weight = f"<{word}>", [], times * 0.5
            for end in range(2, len(padded) + 1):
                for n in sorted(langid.ORDERS, reverse=True):
                    tables = {lang: grams[lang, n] for lang in languages}
                    if n <= end and any(padded[end - n : end] in t for t in tables.values()):
                        parts.append(logs(padded[end - n : end], tables))
                        break
        for part in parts:
            for lang, value in part.items():
                total[lang] += weight * value
    return total


def test_scores_are_those_of_a_plain_scorer(spark):
    samples = [
        ("The cat and the dog, the house a", "en"), ("der Hund und die Katze im Haus", "de"),
        ("le chat et le chien a la maison", "fr"), ("le chat, encore", "fr"), ("naïve Maße 漢字", "xx"),
    ]
    model = langid.train(spark.createDataFrame(samples, "text string, lang string"))
    classify = langid.Classifier(model)
    texts = ["the hound", "chatte", "Hunde und hausen", "a", "qqq zzz", "漢", "maison the Haus le", "naïveté " * 3]
    for text in texts:
        plain = plain_scores(samples, text)
        best = max(plain.values())
        share = 1 / sum(math.exp(v - best) for v in plain.values())
        lang, score = classify(text.encode())
        assert abs(score - share) < 1e-4
        assert plain[lang] >= best - 1e-4


def test_no_task_ranks_the_rows_of_a_language(spark):
    """A language of many texts gives its sample from a few candidates; a rare word of it counts."""
    rows = spark.range(20_000).selectExpr("concat('text of number ', id) AS text", "'en' AS lang")
    rows = rows.unionByName(spark.createDataFrame([("selten Wort", "de")], "text string, lang string"))
    model = langid.train(rows, rows_per_language=100)
    words = model.words.split("\n")
    en = model.word_rows["lang"] == model.languages.index("en")
    assert {"selten", "wort", "number"} <= set(words) and en.sum() == 3
