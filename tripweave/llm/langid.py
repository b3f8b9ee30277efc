"""Language identification by known words, with back-off to character n-grams.

A word that the model knows counts with its log frequency in each language. An unknown word
is spelled: at each place the longest n-gram that the model knows counts, down to single
characters. The model is learned by aggregating words and n-grams of a bounded sample of
labelled rows of each language, and holds all words and n-grams of the sample, each with the
languages that it occurs in.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import blobs, pieces, resident, shielded, stored

UNKNOWN = "und"
ROWS_PER_LANGUAGE = 2_000
ORDERS = (1, 2, 3, 4)
_WORDS = re.compile(r"[^\W\d_]+")
_CACHED = 100_000
_AT_ONCE = 10_000  # words spelled at once
# Weight of a spelled word beside a known one: n-grams of one word are not independent.
_SPELLED = 0.5
# Candidates of a language's sample beside the texts taken: an estimate of their number is 5 % off.
_SPARE, _SPARE_TEXTS = 1.5, 100
# Weight of all languages' frequencies in one language's, in occurrences.
_PRIOR = 20.0


def words_of(text: bytes) -> Counter:
    words: Counter = Counter()
    for part in pieces(text):
        words.update(_WORDS.findall(part.decode("utf-8", "replace").lower()))
    return words


class _Longest(dict):
    """For a run of characters the place of its longest known suffix; a worker remembers runs."""

    def __init__(self, known: dict[str, int], nothing: int):
        self.known, self.nothing = known, nothing

    def __missing__(self, run: str) -> int:
        suffixes = (run[at:] for at in range(len(run)))
        found = next((self.known[s] for s in suffixes if s in self.known), self.nothing)
        if len(self) >= _CACHED:
            self.clear()
        self[run] = found
        return found


def _runs(word: str) -> list[str]:
    """For each place of the padded word but the first, the characters that end there, as many as the longest order."""
    padded, most = f"<{word}>", max(ORDERS)
    return [padded[:end] for end in range(2, min(most, len(padded) + 1))] + [
        padded[at : at + most] for at in range(len(padded) - most + 1)
    ]


_ENTRY = np.dtype([("feature", np.int32), ("lang", np.int32), ("weight", np.float32)])


class LanguageModel:
    """Log frequencies of words and n-grams in each language, by their places in one text.

    A frequency is log((n + p) / (all n of the language + _PRIOR)), p being what the feature's
    share in all languages makes of ``_PRIOR``. Less log(p), which is the same for every
    language, it is the feature's weight, 0 for n = 0, and the language's share: only languages
    that have a feature need an entry.
    """

    def __init__(self, languages: list[str], words: pa.Table, grams: pa.Table):
        self.languages = languages
        self.words, self.word_rows, shares = self._rows(words)
        self.word_share = shares
        length = pa.compute.utf8_length(grams["feature"])
        parts = [self._rows(grams.filter(pa.compute.equal(length, n))) for n in ORDERS]
        names = [name for part, _, _ in parts for name in (part.split("\n") if part else [])]
        self.grams, self.gram_rows, low = "\n".join(names), [], 0
        for part, rows, _ in parts:
            rows["feature"] += low
            low += part.count("\n") + 1 if part else 0
            self.gram_rows.append(rows)
        self.gram_rows = np.concatenate(self.gram_rows)
        # By order; a place of no known n-gram tells nothing.
        self.gram_share = np.array([np.zeros(len(languages)), *(shares for _, _, shares in parts)])

    def _rows(self, table: pa.Table) -> tuple[str, np.ndarray, np.ndarray]:
        table = table.sort_by([("feature", "ascending"), ("lang", "ascending")])
        coded = table["feature"].combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        feature = coded.indices.to_numpy(zero_copy_only=False)
        at = {name: place for place, name in enumerate(self.languages)}
        lang = np.array([at[name] for name in table["lang"].to_pylist()], np.int32)
        n = table["n"].to_numpy().astype(float)
        shared = np.bincount(feature, weights=n, minlength=len(coded.dictionary)) / max(n.sum(), 1)
        rows = np.zeros(len(n), _ENTRY)
        rows["feature"], rows["lang"] = feature, lang
        rows["weight"] = np.log1p(n / (_PRIOR * shared[feature]))
        totals = np.bincount(lang, weights=n, minlength=len(self.languages))
        return "\n".join(coded.dictionary.to_pylist()), rows, -np.log(totals + _PRIOR)


class _Weights:
    """The entries of features, looked up by the features' places."""

    def __init__(self, rows: np.ndarray, features: int):
        self.lang, self.weight = rows["lang"].astype(np.int64), rows["weight"].copy()
        self.starts = np.searchsorted(rows["feature"], np.arange(features + 1))

    def sums(self, places: np.ndarray, group: np.ndarray, times: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        """The summed weights of features, ``times`` each, in each group and language."""
        sizes = self.starts[places + 1] - self.starts[places]
        offsets = np.cumsum(sizes) - sizes
        flat = np.arange(sizes.sum()) + np.repeat(self.starts[places] - offsets, sizes)
        cells = np.repeat(group * shape[1], sizes) + self.lang[flat]
        weights = self.weight[flat] * np.repeat(times, sizes)
        return np.bincount(cells, weights, shape[0] * shape[1]).astype(float).reshape(shape)


class Classifier:
    """Classifies texts and remembers the words that it has spelled."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.known = {word: at for at, word in enumerate(model.words.split("\n") if model.words else [])}
        self.word_weights = _Weights(model.word_rows, len(self.known))
        grams = {gram: at for at, gram in enumerate(model.grams.split("\n") if model.grams else [])}
        self.orders = np.array([*map(len, grams), 0])
        self.longest = _Longest(grams, len(grams))
        # The place after the last n-gram is that of none.
        self.gram_weights = _Weights(model.gram_rows, len(grams) + 1)
        self.spelled: dict[str, int] = {}
        self.rows = np.zeros((_CACHED, len(model.languages)))

    def spell(self, words: list[str]) -> None:
        """Remembers unknown words by what their n-grams tell."""
        found, sizes, place = [], [], self.longest.__getitem__
        for word in words:
            runs = _runs(word)
            sizes.append(len(runs))
            found += map(place, runs)
        places, group = np.array(found), np.repeat(np.arange(len(words)), sizes)
        sums = self.gram_weights.sums(places, group, np.ones(len(places)), (len(words), len(self.model.languages)))
        orders = len(self.model.gram_share)
        of_order = np.bincount(group * orders + self.orders[places], minlength=len(words) * orders)
        sums += of_order.reshape(-1, orders) @ self.model.gram_share
        low = len(self.spelled)
        self.rows[low : low + len(words)] = _SPELLED * sums
        self.spelled.update(zip(words, range(low, low + len(words)), strict=True))

    def __call__(self, text: bytes | None) -> tuple[str, float]:
        words = words_of(text or b"")
        languages = self.model.languages
        if not words or not languages:
            return UNKNOWN, 0.0
        if not any(c.isalpha() for word in words for c in word):
            return UNKNOWN, 0.0
        every, times = list(words), np.fromiter(words.values(), np.float64, len(words))
        at = np.array([self.known.get(word, -1) for word in every])
        held = np.flatnonzero(at >= 0)
        total = self.word_weights.sums(at[held], np.zeros(len(held), np.int64), times[held], (1, len(languages)))[0]
        total += times[held].sum() * self.model.word_share
        others = np.flatnonzero(at < 0)
        for low in range(0, len(others), _AT_ONCE):
            part = others[low : low + _AT_ONCE]
            unknown = [every[i] for i in part]
            if len(self.spelled) + len(part) > len(self.rows):
                self.spelled.clear()
            if new := [word for word in unknown if word not in self.spelled]:
                self.spell(new)
            total += times[part] @ self.rows[[*map(self.spelled.__getitem__, unknown)]]
        shares = np.exp(total - total.max())
        best = int(total.argmax())
        return languages[best], float(shares[best] / shares.sum())


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> LanguageModel:
    """The model of at most ``rows_per_language`` different texts of each non-null language.

    Texts are drawn by the hash of their content, so the same rows give the same model. Rows
    without text or language teach nothing; no such rows give a model without languages.

    How many texts a language has is estimated first; only texts whose hash lies in the part of
    the range that holds half as many again as are wanted are candidates, and of these the
    smallest hashes are taken, so no task sees all rows of a language.
    """
    rows, (text, lang) = shielded(labelled, text_col, lang_col)
    rows = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    draw = F.xxhash64(F.length(text), text)
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), draw.alias("draw"))
    wanted = F.lit(_SPARE * rows_per_language + _SPARE_TEXTS) / F.approx_count_distinct("draw")
    share = rows.groupBy("lang").agg(wanted.alias("share"))
    # One row a language, as the model itself has.
    near = rows.join(F.broadcast(share), "lang").where(F.col("draw") / F.lit(2.0**64) + 0.5 <= F.col("share"))
    near = stored(near.groupBy("lang", "draw").agg(F.first("text").alias("text")), "candidates")
    hashes = F.array_sort(F.collect_list("draw"))
    last = F.element_at(hashes, F.least(F.size(hashes), F.lit(rows_per_language))).alias("last")
    last = near.groupBy("lang").agg(last)
    drawn = near.join(F.broadcast(last), "lang").where("draw <= last").select("text", "lang")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def batch() -> pa.RecordBatch:
            keys = list(counts)
            parts = [pa.array(column) for column in zip(*keys, strict=True)]
            return pa.record_batch(
                [*parts, pa.array(counts.values(), pa.int64())], names=["lang", "word", "n"]
            )

        for part in batches:
            for body, name in zip(blobs(part.column(0)), part.column(1).to_pylist(), strict=True):
                for word, n in words_of(body).items():
                    counts[name, word] += n
                if len(counts) > _CACHED:
                    yield batch()
                    counts.clear()
        if counts:
            yield batch()

    words = drawn.mapInArrow(features, "lang string, word string, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = stored(words, "words")
    languages = sorted(row.lang for row in words.select("lang").distinct().collect())
    padded = F.concat(F.lit("<"), "word", F.lit(">"))
    cut = F.expr(
        f"flatten(transform(sequence(1, least({max(ORDERS)}, length(padded))), n -> transform("
        "sequence(1, length(padded) - n + 1), i -> substring(padded, i, n))))"
    )
    grams = (
        words.withColumn("padded", padded)
        .select("lang", "n", F.explode(cut).alias("feature"))
        .where("feature <> '<'")
        .groupBy("feature", "lang")
        .agg(F.sum("n").alias("n"))
    )
    return LanguageModel(languages, words.withColumnRenamed("word", "feature").toArrow(), grams.toArrow())


def predict(text: Column, model: LanguageModel, session) -> Column:
    """The language of a text and its posterior probability: ``lang``, ``score``.

    ``und`` with score 0 for a null text or one without a letter, or if the model has no
    languages.
    """
    shared = session.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang:string,score:double>")
    def classified(texts: pa.Array) -> pa.Array:
        classify = _classifier(shared)
        parts = (texts.slice(at, 500) for at in range(0, len(texts), 500))
        found = [classify(text) for part in parts for text in blobs(part)]
        return pa.array([{"lang": lang, "score": score} for lang, score in found], kind)

    return classified(text)


def _classifier(shared) -> Classifier:
    """The classifier of this Python worker for a broadcast model."""
    model = shared.value
    return resident(("langid", id(model)), lambda: Classifier(model))
