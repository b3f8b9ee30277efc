"""The stages of the corpus pipeline: each keeps, drops or mends rows of documents."""

from __future__ import annotations

from collections.abc import Collection

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.llm import credentials, langid, packing, simhash, winnow
from tripweave.llm.common import remainder, stored
from tripweave.llm.queries import TOKENIZER, table


# Ids of at most 24 bytes each: 24 MB.
BROADCAST_IDS = 1_000_000
SHINGLE_WORDS = 3


def language_id(
    spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: Collection[str] | None = None
) -> DataFrame:
    """Drops documents without an identifiable language, and those not in a ``wanted`` one.

    Null texts and texts without a letter have none. What language the others have is the
    trained model's decision; by default every language that it knows is wanted. Where no
    document is labelled there is no model: then all texts with a letter stay, unless some
    languages are wanted.
    """
    model = langid.train(docs.where(remainder("doc_id", 5) != 0))
    if not model.languages and wanted is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.predict(F.col("text"), model, spark)["lang"]
    return docs.where(found != langid.UNKNOWN if wanted is None else found.isin(*wanted))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: of smallest id (null last), then text.

    Every row is judged by the group of its own text, also where an id stands on several texts or
    is null. An id that occurs once names its row, so texts of such rows are filtered by the ids
    to drop, which are far fewer than those to keep, and not shuffled where their number, which
    is checked, allows a broadcast. Rows of other ids, and of none, are fingerprinted again to
    tell them apart.
    """
    found = simhash.near_duplicates(docs, shingle_words=SHINGLE_WORDS, max_bits=2)
    ids = found.groupBy("doc_id").agg(
        F.max((F.col("doc_id") != F.col("component_id")).cast("int")).alias("extra"),
        F.count(F.lit(1)).alias("rows"),
    )
    odd = stored(ids.where("extra = 1 OR rows > 1 OR doc_id IS NULL"), "odd-ids")
    repeated = odd.where("rows > 1 OR doc_id IS NULL")
    small = odd.count() <= BROADCAST_IDS  # texts stay where they are; beyond, they are shuffled
    if small:
        odd, repeated = F.broadcast(odd), F.broadcast(repeated)
    single = docs.join(odd, docs["doc_id"].eqNullSafe(odd["doc_id"]), "left_anti")

    groups = found.join(repeated, found["doc_id"].eqNullSafe(repeated["doc_id"]), "left_semi")
    groups = groups.where("doc_id IS NULL AND component_id IS NULL OR doc_id = component_id")
    groups = groups.select(F.col("fp").alias("_fp_"), F.col("component").alias("_group_"), F.col("doc_id").alias("_id_")).distinct()
    several = docs.join(repeated, docs["doc_id"].eqNullSafe(repeated["doc_id"]), "left_semi")
    several = several.withColumn("_fp_", simhash.fingerprint(F.col("text"), SHINGLE_WORDS))
    several = several.join(groups, several["doc_id"].eqNullSafe(groups["_id_"]) & (several["_fp_"] == groups["_fp_"]))
    first = Window.partitionBy("_group_").orderBy(F.col("text").asc_nulls_last())
    several = several.withColumn("_place_", F.row_number().over(first)).where("_place_ = 1")
    return single.unionByName(several.select(*(several[name] for name in docs.columns)))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item, or a whole shorter one."""
    found = winnow.contamination(F.col("text"), table(spark, sf_dir, "benchmark"))
    return docs.where(F.size(found["spans"]) == 0)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret in the text; ``n_chars`` follows where it is a number."""
    return credentials.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))
