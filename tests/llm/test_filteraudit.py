import re
from itertools import permutations
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import no_documents, odd_documents
from tripweave.llm import filteraudit, queries

LABELS = "doc_id long, quality int, toxic int"


def plain_masks(docs, labels):
    """Part, failing letters, good and toxic of every (id, text, lang), in plain Python."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    low = {}
    for key, text, _ in docs:
        if key is not None:
            low[text or ""] = min(low.get(text or "", key), key)
    for key, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "A" * (len(words) < 200)
        fails += "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text))
        fails += "D" * bool(re.search("[#$%&*|]", text))
        fails += "E" * (key is not None and low[text] < key)
        yield lang or "", fails, key in good, key in toxic


def plain_audit(docs, labels):
    masks = list(plain_masks(docs, labels))
    rows = {}
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                out = [m for m in left if letter in m[1]]
                left = [m for m in left if letter not in m[1]]
                shapley[letter] += len(out)
                failing = sum(letter in m[1] for m in own)
                rows[part, "".join(order), step] = [
                    len(left), len(out), failing - len(out), sum(m[1] == letter for m in own),
                    sum(m[2] for m in out), sum(m[3] for m in out),
                ]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {key: tuple(row) for key, row in rows.items()}


def audited(docs, labels):
    cells, letters = filteraudit.cells_of(docs, labels)
    found = filteraudit.audit(cells, letters, followed=("good", "toxic"))
    return {tuple(row)[:3]: tuple(row)[3:] for row in found.collect()}


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_equals_a_plain_count(spark):
    many = " ".join(f"w{i}" for i in range(220))
    docs = [
        (1, many, "en"), (2, many, "en"), (2, many, "en"), (3, many, "de"), (None, many, "en"),
        (4, "A B C D", None), (5, "A B C D", ""), (6, None, "en"), (7, "", "en"), (7, "x", "en"),
        (8, "word " * 300, "en"), (9, "word " * 300 + "#", "en"), (10, many + " #", "de"),
        (11, many.upper(), "en"), (12, "ÜÉ \x1c   " * 80, "fr"), (None, None, None),
        (13, "\t a\x0bb ", "en"),
    ]
    labels = [(1, 1, 0), (2, 0, 0), (2, 1, 1), (8, 1, None), (9, None, 1), (None, 1, 1), (99, 1, 1), (6, 1, 1)]
    found = audited(documents(spark, docs), spark.createDataFrame(labels, LABELS))
    assert len(found) == 120 * 5 * 4
    assert found == plain_audit(docs, labels)


def test_query_equals_its_twin(spark, small):
    engine = duckdb.connect()
    for table in Path(small).glob("*.parquet"):
        engine.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    found = queries.op13_gray_filter_audit(spark, small).toArrow()
    wanted = engine.sql(queries.oracle_sql()["op13_gray_filter_audit"]).to_arrow_table()
    assert {f.name: str(f.type) for f in found.schema} == {f.name: str(f.type) for f in wanted.schema}
    order = [("part", "ascending"), ("filter_order", "ascending"), ("step", "ascending")]
    names = found.column_names
    assert found.sort_by(order).to_pylist() == wanted.select(names).sort_by(order).to_pylist()
    assert found.num_rows == 4 * 600


def test_walk_toggles_to_the_same_survivors_as_counting():
    draw = np.random.default_rng(5)
    masks, counts = draw.integers(0, 64, 90), draw.integers(0, 9, (90, 3))
    states = filteraudit.gray_states(masks, counts, 6)
    for subset in range(64):
        assert (states[subset] == counts[masks & subset == 0].sum(axis=0)).all()


def test_odd_rows_and_none(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (5, None, None)], LABELS).withColumn("id", F.lit("x"))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    found = audited(docs, labels)
    assert found == plain_audit(rows, [(1, 1, 0), (5, None, None)])
    none = spark.createDataFrame([], LABELS)
    assert audited(no_documents(spark), none) == {}
    assert audited(docs, none).keys() == found.keys()


def test_cells_merge_and_letters_are_checked(spark):
    cells = spark.createDataFrame([(None, 1, 2), (None, 1, 3), (None, None, 4)], "part string, mask int, n long")
    rows = {(r.filter_order, r.step): r for r in filteraudit.audit(cells, "XY").collect()}
    assert len(rows) == 4 and rows["XY", 1].part is None
    assert (rows["YX", 2].kept, rows["YX", 2].removed, rows["YX", 2].shapley) == (4, 5, 10)
    for letters in ("", "AA", "ABCDEFGHI"):
        with pytest.raises(ValueError, match="filters"):
            filteraudit.audit(cells, letters)
