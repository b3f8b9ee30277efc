"""Personal data: fixed patterns as seeds, and bootstrapped contextual extraction beyond them.

Seed entities induce lexical patterns: the two words before an entity with its kind. In a
graph of patterns and instances (identifier-like tokens: such as hold three digits or an at
sign) each scores the other in turn: a pattern by the share of its occurrences in the whole
corpus that extract trusted instances, an instance by the patterns that extract it. Patterns
of high confidence then extract the identifiers that no fixed pattern knows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import blobs, content_key, shielded, stored

# Kinds and their forms. At-signs and plus-signs are looked for first and their
# matches built around them, which finds what matching from the left finds, in linear time.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
# A word ends behind the signs that follow it, so a label and a value glued to it are two words.
_SIGNS = r",;:\"'()<>\[\]{}=|!?*&#$%"
_WORD = re.compile(rf"[{_SIGNS}]*+[^\s{_SIGNS}]++[{_SIGNS}]*+|[{_SIGNS}]++")
# An identifier-like token: what a word holds without the signs around it.
_TOKEN = re.compile(rf"[^\W_](?:[^\s{_SIGNS}]*[^\W_])?")
_LONG_WORD = 80

CONTEXT_WORDS = 2
MIN_SUPPORT = 3  # different seed instances that a pattern must extract
MIN_CONFIDENCE = 0.6
ROUNDS = 3
# Patterns that go to every worker; more of them are joined instead.
MAX_BROADCAST_PATTERNS = 50_000
_FLUSH = 300_000


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns' matches, by kind and start."""
    found = []
    if "@" in text:
        last = 0
        for match in _DOMAIN.finditer(text):
            start = match.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < match.start():
                last = match.end()
                found.append((0, start, last))
    if _DIGIT.search(text):
        for match in _IP.finditer(text):
            if all(_at_most_255(part) for part in match[0].split(".")):
                found.append((1, *match.span()))
        for match in _CARD.finditer(text):
            if 16 <= match.end() - match.start() and _is_card(match[0]):
                found.append((2, *match.span()))
        if "+" in text:
            for match in _PHONE.finditer(text):
                if 8 <= sum(map(str.isdigit, match[0])) <= 15:
                    found.append((3, *match.span()))
    return found


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _is_card(text: str) -> bool:
    digits = [int(c) for c in text if c.isdigit()]
    if not 16 <= len(digits) <= 19:
        return False
    doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


class _Words:
    """The words of a text: their places, and the contexts of places. Learning, counting and finding all use it."""

    def __init__(self, text: str):
        self.text = text
        self.spans = [m.span() for m in _WORD.finditer(text)]
        self.starts = [a for a, _ in self.spans]

    def pattern(self, at: int) -> str | None:
        """The words before word number ``at``, lower-cased; None if there are too few."""
        if at < CONTEXT_WORDS:
            return None
        return " ".join(_shown(self.text[a:b]) for a, b in self.spans[at - CONTEXT_WORDS : at])

    def context(self, start: int) -> str | None:
        """The words before the one that holds a place."""
        return self.pattern(bisect_right(self.starts, start) - 1)


def _shown(word: str) -> str:
    """A word as it stands in patterns: long ones by their beginning and digest."""
    word = word.lower()
    if len(word) <= _LONG_WORD:
        return word
    return f"{word[:16]}#{hashlib.blake2b(word.encode('utf-8', 'replace'), digest_size=16).hexdigest()}"


def _candidates(words: _Words, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like tokens beside the base spans."""
    taken = sorted((a, b) for _, a, b in base)
    at = 0
    for first, last in words.spans:
        body = words.text[first:last]
        if "@" not in body and len(_DIGIT.findall(body)) < 3:
            continue
        inner = _TOKEN.search(body)
        if inner is None or sum(map(str.isdigit, inner[0])) < 3 and "@" not in inner[0]:
            continue
        start, end = first + inner.start(), first + inner.end()
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at == len(taken) or taken[at][0] >= end:
            yield start, end


def _edges(docs: DataFrame) -> DataFrame:
    """``pattern``, ``kind`` (null for candidates), ``instance`` and occurrences ``n``."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            counts: Counter = Counter()
            for body in blobs(part.column(0)):
                text = body.decode("utf-8", "replace")
                if not _DIGIT.search(text) and "@" not in text:
                    continue
                base, words = base_spans(text), _Words(text)
                for kind, a, b in base:
                    if (pattern := words.context(a)) is not None:
                        counts[pattern, KINDS[kind], text[a:b].lower()] += 1
                for a, b in _candidates(words, base):
                    if (pattern := words.context(a)) is not None:
                        counts[pattern, None, text[a:b].lower()] += 1
            if counts:
                columns = zip(*counts, strict=True)
                yield pa.record_batch(
                    [*(pa.array(c, pa.string()) for c in columns), pa.array(counts.values(), pa.int64())],
                    names=["pattern", "kind", "instance", "n"],
                )

    found = docs.select("text").mapInArrow(extract, "pattern string, kind string, instance string, n long")
    return found.groupBy("pattern", "kind", "instance").agg(F.sum("n").alias("n"))


def _totals(docs: DataFrame, support: DataFrame) -> DataFrame:
    """How often each pattern of ``support`` stands in the corpus before any word."""
    few = support.limit(MAX_BROADCAST_PATTERNS + 1).count() <= MAX_BROADCAST_PATTERNS
    patterns = frozenset(row.pattern for row in support.select("pattern").collect()) if few else None
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, counts = shared.value, Counter()
        firsts = None if wanted is None else {pattern.split(" ")[0] for pattern in wanted}

        def batch() -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(list(counts), pa.string()), pa.array(counts.values(), pa.int64())],
                names=["pattern", "total"],
            )

        for part in batches:
            for body in blobs(part.column(0)):
                words = [_shown(word) for word in _WORD.findall(body.decode("utf-8", "replace"))]
                for at in range(len(words) - CONTEXT_WORDS):
                    if firsts is None or words[at] in firsts:
                        pattern = " ".join(words[at : at + CONTEXT_WORDS])
                        if wanted is None or pattern in wanted:
                            counts[pattern] += 1
                if len(counts) > _FLUSH:
                    yield batch()
                    counts.clear()
        if counts:
            yield batch()

    counted = docs.select("text").mapInArrow(count, "pattern string, total long")
    if not few:
        counted = counted.join(support.select("pattern"), "pattern", "left_semi")
    return counted.groupBy("pattern").agg(F.sum("total").alias("total"))


def pattern_table(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``pattern`` and ``own``, the kind it extracts, of all patterns of high confidence."""
    rows, (text,) = shielded(docs, text_col)
    rows = rows.select(F.col(text).alias("text"))
    edges = stored(_edges(rows), "edges")
    seeds = edges.where("kind IS NOT NULL")
    support = seeds.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("support"))
    support = support.groupBy("pattern").agg(
        F.max(F.struct("support", "kind")).alias("best")
    ).select("pattern", "best.*")
    support = stored(support.where(F.col("support") >= MIN_SUPPORT), "support")
    if support.isEmpty():
        return support.select("pattern", F.col("kind").alias("own"))
    weighed = support.join(_totals(rows, support), "pattern")
    graph = edges.join(weighed.select("pattern", F.col("kind").alias("own"), "total"), "pattern")
    graph = stored(graph, "graph")
    # Seeds of the pattern's kind are sure; other instances start at nothing.
    sure = F.col("kind").eqNullSafe(F.col("own")).cast("double")
    scored = graph.withColumn("trust", F.coalesce(sure, F.lit(0.0)))
    for _ in range(ROUNDS):
        confidence = scored.groupBy("pattern", "own").agg(
            (F.sum(F.col("trust") * F.col("n")) / F.max("total")).alias("confidence")
        )
        # Independent patterns that agree on an instance make it surer.
        doubt = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999))))
        trusted = graph.join(confidence, ["pattern", "own"]).groupBy("instance", "own").agg(
            (1 - F.exp(doubt)).alias("believed")
        )
        scored = graph.join(trusted, ["instance", "own"]).withColumn(
            "trust", F.when(F.col("kind").isNotNull(), F.coalesce(sure, F.lit(0.0))).otherwise(F.col("believed"))
        )
        scored = stored(scored.drop("believed"), "trust")
    final = scored.groupBy("pattern", "own").agg((F.sum(F.col("trust") * F.col("n")) / F.max("total")).alias("confidence"))
    return stored(final.where(F.col("confidence") >= MIN_CONFIDENCE).select("pattern", "own"), "patterns")


def learn_patterns(docs: DataFrame, text_col: str = "text") -> dict[str, str]:
    """``pattern_table`` on the driver, for patterns that fit there."""
    return {row.pattern: row.own for row in pattern_table(docs, text_col).collect()}


_RESULT = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find(text: Column, patterns: dict[str, str], session) -> Column:
    """All spans of a text, base ones first: ``kind``, ``start``, ``end`` in code points, ``base``.

    A null text is an empty one.
    """
    shared = session.sparkContext.broadcast(patterns)
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
    )

    @F.arrow_udf(_RESULT)
    def spans(texts: pa.Array) -> pa.Array:
        known, out = shared.value, []
        for body in blobs(texts):
            text = body.decode("utf-8", "replace")
            base = base_spans(text)
            found = [{"kind": KINDS[k], "start": a, "end": b, "base": True} for k, a, b in base]
            if known and _DIGIT.search(text) or "@" in text:
                words = _Words(text)
                for a, b in _candidates(words, base):
                    if (own := known.get(words.context(a))) is not None:
                        found.append({"kind": own, "start": a, "end": b, "base": False})
            out.append(found)
        return pa.array(out, kind)

    return spans(text)


def find_all(docs: DataFrame, patterns: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id and ``every``, its spans as by ``find``, by a pattern table of any size."""
    if patterns.limit(MAX_BROADCAST_PATTERNS + 1).count() <= MAX_BROADCAST_PATTERNS:
        known = {row.pattern: row.own for row in patterns.collect()}
        return docs.select(F.col(id_col), find(F.col(text_col), known, docs.sparkSession).alias("every"))
    return _found_by_join(docs, patterns, id_col, text_col)


def _found_by_join(docs: DataFrame, patterns: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows, (name, text) = shielded(docs, id_col, text_col)
    rows = rows.select(F.col(name).alias("id"), F.col(text).alias("text"), content_key(name, text).alias("key"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "start", "end", "pattern"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
        for part in batches:
            out: list[tuple] = []
            keys = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
            for (a, b), body in zip(keys, blobs(part.column(2)), strict=True):
                text = body.decode("utf-8", "replace")
                if not _DIGIT.search(text) and "@" not in text:
                    continue
                words = _Words(text)
                for start, end in _candidates(words, base_spans(text)):
                    if (pattern := words.context(start)) is not None:
                        out.append((a, b, start, end, pattern))
            if out:
                columns = zip(*out, strict=True)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    placed = rows.select("key.a", "key.b", "text").mapInArrow(contexts, "a long, b long, start int, end int, pattern string")
    met = placed.join(patterns, "pattern").dropDuplicates(["a", "b", "start", "end"])
    span = F.struct("start", "end", F.col("own").alias("kind"))
    more = met.groupBy(F.struct("a", "b").alias("key")).agg(F.array_sort(F.collect_list(span)).alias("more"))
    spans = F.transform(
        "more", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(False).alias("base"))
    )
    base = rows.select("id", "key", find(F.col("text"), {}, docs.sparkSession).alias("base"))
    every = F.concat("base", F.coalesce(spans, F.expr(f"cast(array() AS {_RESULT})")))
    return base.join(more, "key", "left").select(F.col("id").alias(id_col), every.alias("every"))
