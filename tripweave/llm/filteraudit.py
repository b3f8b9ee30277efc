"""What each filter of a chain removes, in every order of the chain.

A document's failures are a bit mask, and all that an order can remove follows from how many
documents have which mask. So documents are counted by mask (the cells), and the subsets of
filters are walked in Gray code: from one subset to the next a single filter is switched on or
off, which moves a counter of active failures in the cells that fail it, and the running number
of survivors where a counter leaves or reaches zero. The survivors of all subsets are kept; what
a filter removes in an order is the difference of two of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import shielded, stored

# Orders of a chain are all written out: 120 for five filters, 40,320 for eight.
MOST_FILTERS = 8
SPACE = " \t\n\x0b\f\r"


def gray_states(masks: np.ndarray, counts: np.ndarray, filters: int) -> np.ndarray:
    """Survivors of every subset of filters: one row a subset, by its bits.

    ``counts`` has a row a cell and a column for each number that is followed.
    """
    states = np.zeros((1 << filters, counts.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)
    alive = counts.sum(axis=0)
    states[0] = alive
    subset = 0
    for step in range(1, 1 << filters):
        at = (step & -step).bit_length() - 1  # the bit that changes in the reflected code
        subset ^= 1 << at
        hit = (masks >> at & 1).astype(bool)
        before = failing == 0
        failing[hit] += 1 if subset >> at & 1 else -1
        after = failing == 0
        alive = alive + counts[after & ~before].sum(axis=0) - counts[before & ~after].sum(axis=0)
        states[subset] = alive
    return states


def _steps(letters: str, masks: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
    """Order, step, then kept, removed, redundant, unique failures, further numbers lost, Shapley sum."""
    n = len(letters)
    states = gray_states(masks, counts, n)
    fails = [int(counts[(masks >> at & 1) == 1, 0].sum()) for at in range(n)]
    alone = [int(counts[masks == 1 << at, 0].sum()) for at in range(n)]
    shapley = [0] * n
    for subset in range(1 << n):
        size = subset.bit_count()
        for at in range(n):
            if not subset >> at & 1:
                # So many orders have exactly this subset before the filter.
                orders = factorial(size) * factorial(n - 1 - size)
                shapley[at] += orders * int(states[subset, 0] - states[subset | 1 << at, 0])
    for order in permutations(range(n)):
        name, subset = "".join(letters[at] for at in order), 0
        for step, at in enumerate(order, 1):
            lost = states[subset] - states[subset | 1 << at]
            subset |= 1 << at
            removed = int(lost[0])
            yield (
                name, step, int(states[subset, 0]), removed, fails[at] - removed, alone[at],
                *(int(x) for x in lost[1:]), shapley[at],
            )


def audit(
    cells: DataFrame, letters: str, part_col: str = "part", mask_col: str = "mask",
    count_col: str = "n", followed: Sequence[str] = (),
) -> DataFrame:
    """One row per part, order of filters and step.

    ``cells`` hold how many documents (``count_col``, and of them ``followed``) of a part have a
    mask: bit i is set if they fail the filter named by the i-th letter. Several rows of one cell
    add up; null numbers are none, a null mask fails nothing. Parts are worked on apart; a part
    is at most two to the number of filters rows here, however many documents it has. Columns:
    the part, ``filter_order``, ``step``, ``kept`` after it, ``removed`` by it, ``redundant``
    (failing its filter but gone before), ``unique_fails`` (failing its filter only),
    ``<followed>_lost`` and ``shapley``: what its filter removes, summed over all orders.
    No cells give no rows.
    """
    if not 1 <= len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"one to {MOST_FILTERS} filters with different letters, not {letters!r}")
    numbers = [F.coalesce(F.sum(F.col(name)), F.lit(0)).cast("long") for name in (count_col, *followed)]
    merged = cells.groupBy(
        F.col(part_col).alias("part"), F.coalesce(F.col(mask_col), F.lit(0)).cast("int").alias("mask")
    ).agg(*(c.alias(f"n{i}") for i, c in enumerate(numbers)))
    kind = merged.schema["part"].dataType.simpleString()
    width = len(numbers)
    lost = [f"{name}_lost" for name in followed]
    fields = [
        ("filter_order", "string"), ("step", "int"),
        *((name, "long") for name in ("kept", "removed", "redundant", "unique_fails", *lost, "shapley")),
    ]

    def walk(table: pa.Table) -> pa.Table:
        masks = table["mask"].to_numpy()
        counts = np.column_stack([table[f"n{i}"].to_numpy() for i in range(width)])
        columns = list(zip(*_steps(letters, masks, counts), strict=True))
        kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
        arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
        part = pa.chunked_array([table["part"].combine_chunks().take(pa.array([0] * len(columns[0])))])
        return pa.table([part, *arrays], names=[part_col, *(name for name, _ in fields)])

    layout = ", ".join([f"`{part_col}` {kind}", *(f"{name} {k}" for name, k in fields)])
    return merged.groupBy("part").applyInArrow(walk, layout)


def text_failures(text: Column) -> dict[str, Column]:
    """The four filters that look at one text (not null), by letter, as conditions of failure.

    A: under 200 words; B: fewer than half of the words are different; C: over 3 in 100 code
    points are capitals A-Z; D: holds a sign of tables and markup.
    """
    body = F.trim(text, F.lit(SPACE))
    words = F.when(body != "", F.split(body, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 3,
        "D": text.rlike("[#$%&*|]"),
    }


# Copies of earlier texts; looks at the whole table, so it is no condition on one text.
COPY = "E"


def cells_of(
    docs: DataFrame, labels: DataFrame, failures: Mapping[str, Column] | None = None,
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> tuple[DataFrame, str]:
    """How many documents of a part have which mask, with those labelled good and toxic.

    The text filters' letters come first, then ``E``: the text is that of a smaller id, anywhere
    in the table. A null text is empty; a null part is the empty string; a null id is neither
    smaller than another nor has a smaller one, and rows of one id are no copies of each other.
    An id counts as good or toxic if any of its label rows says 1; a null id has no labels.

    Texts are read once, for their digest and mask, and are not shuffled. Rows are counted by
    id and digest, then by digest, before they are dealt by digest, so that a text of very many
    copies is a few rows there.
    """
    rows, (key, text, part) = shielded(docs, id_col, text_col, part_col)
    whole = rows.select(
        F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
    )
    tests = failures or text_failures(F.col("text"))
    letters = "".join(tests) + COPY
    mask = sum((F.coalesce(test, F.lit(False)).cast("int") * (1 << at) for at, test in enumerate(tests.values())), F.lit(0))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    marked = stored(whole.select("id", "part", digest.alias("digest"), mask.alias("mask")), "marked")

    known, (labelled, quality, toxic) = shielded(labels, "doc_id", "quality", "toxic")
    known = known.groupBy(F.col(labelled).alias("id")).agg(
        F.coalesce(F.max((F.col(quality) == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col(toxic) == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    both = marked.join(known, "id", "left").select(
        "id", "part", "digest", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )
    same = ("digest", "mask", "part", "good", "toxic")
    one = both.groupBy("id", *same).agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    groups = one.groupBy(*same).agg(
        F.sum("n").alias("n"), least.alias("least"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
    )
    groups = stored(groups, "texts")
    lows = groups.groupBy("digest").agg(F.min("least.id").alias("low"))
    first = F.when(F.col("least.id") == F.col("low"), F.col("least.n")).otherwise(0) + F.col("nameless")
    bit = 1 << (len(letters) - 1)
    split = groups.join(lows, "digest").select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask"), first.alias("n")),
            F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - first).alias("n")),
        )),
    )
    counted = split.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )
    return counted, letters
