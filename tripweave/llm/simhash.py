"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments, so that of two fingerprints that differ in at
most two bits one segment differs in at most one. Each segment is indexed as it is and once
for each of its bits with that bit wild; an equality join on these signatures finds every
pair, and the distance of the whole fingerprints is verified in the join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import blobs, pieces, resident, shielded, stored
from tripweave.llm.components import connected_components

MAX_BITS = 2
SEED = 42
# A signature shared by more fingerprints than this is split by the other segment.
LARGE_BUCKET = 64
_TEXTS = 500  # texts copied at once


def fingerprint(text: Column, shingle_words: int = 3) -> Column:
    """The signed 64-bit fingerprint of a text.

    Words are runs without ASCII white space, A-Z lower-cased. A bit is 1 if it is set in
    over half of the XXH64 hashes of the shingles, repeats included. Fewer words than a
    shingle: one shingle of all of them; none, or a null text: 0.
    """

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        resident("simhash", dict)  # of other operators nothing stays
        parts = (texts.slice(at, _TEXTS) for at in range(0, len(texts), _TEXTS))
        return pa.array(
            [_fingerprint(t, shingle_words) for part in parts for t in blobs(part)], pa.int64()
        )

    return prints(text)


def _fingerprint(text: bytes, n: int) -> int:
    counts, total, words = np.zeros(64, np.int64), 0, []
    form, digest = b" ".join([b"%b"] * n), xxhash.xxh64_intdigest

    def count(hashes: list[int]) -> int:
        bits = np.unpackbits(
            np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        np.add(counts, bits.sum(axis=0, dtype=np.int64), out=counts)
        return len(hashes)

    for part in pieces(text):
        words += part.lower().split()
        if len(words) >= n:
            grams = zip(*(words[i:] for i in range(n)), strict=False)
            total += count([digest(form % gram, SEED) for gram in grams])
            words = words[len(words) - n + 1 :]
    if not total and words:
        total = count([digest(b" ".join(words), SEED)])
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<i8")[0])


def _signatures(prints: DataFrame) -> DataFrame:
    """``fp`` with each of its signatures: segment, wild bit (0: none) and masked segment."""
    seg, wild = F.expr("`at` div 33"), F.expr("`at` % 33")
    rows = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("at"))
    rows = rows.select("fp", seg.cast("int").alias("seg"), wild.cast("int").alias("wild"))
    half = "(shiftrightunsigned(fp, 32 * seg) & 4294967295)"
    mask = "(CASE WHEN wild = 0 THEN 0L ELSE shiftleft(1L, wild - 1) END)"
    key = f"({half} & ~{mask}) | shiftleft(cast(wild AS bigint), 32) | shiftleft(cast(seg AS bigint), 38)"
    return rows.select("fp", "seg", "wild", F.expr(key).alias("key"))


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links ``src``, ``dst`` that join the same distinct ``fp`` as all pairs within two bits.

    Small buckets are joined with themselves and verified. In a large bucket the other
    segment decides: fingerprints in it that also agree with one of its bits wild (or, for a
    signature without a wild bit, with a value one flip away) are within two bits of each
    other. Such a group has at most 33 members, and each links to its smallest. So no
    bucket, however large, is compared pair by pair, and no link between groups is lost.
    """
    all_signatures = _signatures(prints)
    sizes = all_signatures.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stored(all_signatures.join(sizes, "key"), "signatures")

    small = shared.where(F.col("size") <= LARGE_BUCKET).select("key", "fp")
    a, b = small.alias("a"), small.alias("b")
    near = F.expr(f"a.fp < b.fp AND bit_count(a.fp ^ b.fp) <= {MAX_BITS}")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & near)
    pairs = pairs.select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))

    other = "(shiftrightunsigned(fp, 32 * (1 - seg)) & 4294967295)"
    bit = "(CASE WHEN j = 0 THEN 0L ELSE shiftleft(1L, j - 1) END)"
    large = (
        shared.where(F.col("size") > LARGE_BUCKET)
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(32))))
        .where("wild = 0 OR j > 0")
        .withColumn("sub", F.expr(f"CASE WHEN wild = 0 THEN {other} ^ {bit} ELSE {other} & ~{bit} END"))
        .withColumn("j", F.expr("CASE WHEN wild = 0 THEN 0 ELSE j END"))
        .groupBy("key", "j", "sub")
        .agg(F.collect_set("fp").alias("group"))
        .where(F.size("group") > 1)
        .select(F.array_min("group").alias("src"), F.explode("group").alias("dst"))
        .where("src <> dst")
    )
    return pairs.unionByName(large)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Each row's id, ``fp`` (signed fingerprint), ``component_id``, the smallest id reachable, and
    ``component``, a fingerprint that names the group also where all its ids are null.

    Rows of equal fingerprint are one node of the link graph. A null id stays null and
    counts for nothing; repeated rows come back as often as given; an empty table gives none.
    """
    if max_bits != MAX_BITS:
        raise ValueError("signatures of two segments serve a distance of two bits")
    rows, (key, text) = shielded(docs, id_col, text_col)
    rows = stored(
        rows.select(F.col(key).alias("id"), fingerprint(F.col(text), shingle_words).alias("fp")),
        "fingerprints",
    )
    nodes = stored(rows.groupBy("fp").agg(F.min("id").alias("low")), "nodes")
    parts = connected_components(fingerprint_links(nodes.select("fp")))
    parts = parts.select(F.col("node").alias("fp"), "component")
    lowest = nodes.join(parts, "fp").groupBy("component").agg(F.min("low").alias("least"))
    moved = parts.join(lowest, "component").select("fp", "least", "component")
    classes = nodes.join(moved, "fp", "left").select(
        "fp",
        F.coalesce("least", "low").alias("component_id"),
        F.coalesce("component", "fp").alias("component"),
    )
    return rows.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id", "component")
