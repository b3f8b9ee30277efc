"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import (
    capfilters, credentials, ctw, divergence, filteraudit, langid, licences, packing, pii, simhash, weaklabel,
    whitening, winnow,
)
from tripweave.llm.common import remainder

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


def op2_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = ctw.score(docs, remainder("doc_id", 7) != 2)
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"
    )


def op3_cap_filters(spark: SparkSession, folder: str) -> DataFrame:
    return capfilters.near_duplicates(table(spark, folder, "embeddings"))


def op4_bootstrapped_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii.find_all(docs, pii.pattern_table(docs))
    found = found.withColumn("base", F.filter("every", lambda s: s["base"]))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in pii.KINDS
    ]
    number = F.array(*(F.lit(kind) for kind in pii.KINDS))

    def written(spans: Column) -> Column:
        placed = F.transform(
            spans,
            lambda s: F.struct(
                F.array_position(number, s["kind"]).alias("at"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
            ),
        )
        shown = F.transform(
            F.array_sort(placed),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        )
        return F.array_join(shown, ",")

    return found.select(
        "doc_id",
        *counts,
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("every")).alias("spans"),
    )


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    part = remainder("doc_id", 5)
    model = langid.train(docs.where(part != 0))
    found = docs.select("doc_id", langid.predict(F.col("text"), model, spark).alias("found"))
    return found.select(
        "doc_id",
        F.coalesce(part == 0, F.lit(False)).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )


def op6_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = licences.scan(docs, licences.train(docs))
    families = F.array_sort(F.array_distinct(F.transform("paragraphs", lambda p: p["family"])))
    known = F.filter("paragraphs", lambda p: p["family"] != licences.UNKNOWN)
    return found.select(
        "doc_id",
        F.size("paragraphs").cast("long").alias("n_paragraphs"),
        F.size(known).cast("long").alias("n_licensed"),
        F.array_join(F.array_remove(families, licences.UNKNOWN), ",").alias("families"),
        F.array_max(F.transform(known, lambda p: p["probability"])).alias("probability"),
    )


def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = simhash.near_duplicates(docs, shingle_words=3, max_bits=2)
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")


def op8_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = docs.select("doc_id", winnow.contamination(F.col("text"), items).alias("found"))
    hits = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hits.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def op9_credential_linking(spark: SparkSession, folder: str) -> DataFrame:
    found = credentials.scan(table(spark, folder, "documents"))
    numbers = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(numbers) - F.size(F.array_remove(numbers, at))).cast("long").alias(f"n_{kind.name}")
        for at, kind in enumerate(credentials.BASE)
    ]
    every = F.array_sort(F.concat("base", "linked"))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(credentials.written(F.col("base")), 256).alias("base_sha256"),
        credentials.written(every).alias("spans"),
    )


def op10_weak_labels(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scorer = weaklabel.train(docs)
    found = docs.select("doc_id", weaklabel.scored(F.col("text"), scorer, spark).alias("found"))
    return found.select("doc_id", "found.*", (F.col("found.score") >= 0.5).alias("kept"))


def op11_feast_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_distribution_divergence(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    known = divergence.references(docs)
    found = docs.select("doc_id", divergence.judged(F.col("text"), F.col("lang"), known, spark).alias("found"))
    return found.select("doc_id", "found.*")


def op13_gray_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    cells, letters = filteraudit.cells_of(docs, labels)
    return filteraudit.audit(cells, letters, followed=("good", "toxic"))


def queries() -> dict[str, Query]:
    return {
        "op1_harmonic_packing": op1_harmonic_packing,
        "op2_context_tree": op2_context_tree,
        "op3_cap_filters": op3_cap_filters,
        "op4_bootstrapped_pii": op4_bootstrapped_pii,
        "op5_language_id": op5_language_id,
        "op6_licence_scan": op6_licence_scan,
        "op7_simhash_near_dedup": op7_simhash_near_dedup,
        "op8_winnowing": op8_winnowing,
        "op9_credential_linking": op9_credential_linking,
        "op10_weak_labels": op10_weak_labels,
        "op11_feast_whitening": op11_feast_whitening,
        "op12_distribution_divergence": op12_distribution_divergence,
        "op13_gray_filter_audit": op13_gray_filter_audit,
    }


_FILTER_AUDIT = r"""
WITH whole AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents
),
seen AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        min(doc_id) OVER (PARTITION BY text) AS low
    FROM whole
),
marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
        max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
),
masked AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
            + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
            + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text)
                THEN 4 ELSE 0 END
            + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
            + CASE WHEN low < doc_id THEN 16 ELSE 0 END AS mask
    FROM seen LEFT JOIN marks USING (doc_id)
),
cells AS (
    SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM masked GROUP BY part, mask
),
filters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
        [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM filters a, filters b, filters c, filters d, filters e
    WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps AS (
    SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit,
        coalesce(list_sum(bits[1:step - 1]), 0) AS earlier
    FROM orders, range(1, 6) AS steps(step)
),
counted AS (
    SELECT part, filter_order, step, bit,
        coalesce(sum(n) FILTER (mask & (earlier + bit) = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (mask & earlier <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT
            AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT * EXCLUDE (bit),
    CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""


def oracle_sql() -> dict[str, str]:
    return {"op13_gray_filter_audit": _FILTER_AUDIT}
