import pytest
from pyspark.sql import functions as F

from tests.llm.cases import no_documents, odd_documents
from tripweave.llm import licences
from tripweave.llm.queries import op6_licence_scan

LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "Released under the MIT License.": "mit",
    "Licensed under the Apache License, Version 2.0.": "apache",
}


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    rows = op6_licence_scan(spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        wanted = sorted({family for line, family in LINES.items() if line in texts[row.doc_id].split("\n")})
        assert row.families == ",".join(wanted)
    assert sum(r.n_licensed for r in rows) > 5


@pytest.fixture(scope="module")
def model(spark, small):
    return licences.train(spark.read.parquet(f"{small}/documents.parquet"))


def test_unseen_wordings_and_the_unknown_class(spark, model):
    cases = [
        ("Our code is released under the MIT License, as always.", "mit"),
        ("# SPDX-License-Identifier: LGPL-3.0-or-later", "lgpl"),
        ("modify it under the terms of the GNU Lesser General Public License", "lgpl"),
        ("Licensed under CC BY-SA 4.0 by its authors.", "cc-by-sa"),
        ("Licensed under CC BY 4.0", "cc-by"),
        ("The licence of the shop was granted by the town last year.", "unknown"),
        ("Permission to land was asked for twice.", "unknown"),
        ("Copyright is a difficult subject.", "unknown"),
        ("licensing", "unknown"),
    ]
    docs = spark.createDataFrame([(i, f"before\n{t}\nafter") for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    found = {r.doc_id: [(p.at, p.family) for p in r.paragraphs] for r in licences.scan(docs, model).collect()}
    assert [found[i] for i in range(len(cases))] == [[(1, family)] for _, family in cases]


def test_odd_rows(spark, model):
    docs = odd_documents(spark).withColumn("words", F.lit("x"))
    more = docs.withColumn("text", F.lit("Released under the MIT License.\n" * 50))
    rows = licences.scan(docs.unionByName(more), model).collect()
    assert sorted(len(r.paragraphs) for r in rows) == [0] * docs.count() + [50] * docs.count()
    assert licences.scan(no_documents(spark), model).count() == 0
    licences.train(no_documents(spark))


WRAPPED = [
    (
        "Redistribution and use in source and binary forms, with or without\n"
        "modification, are permitted provided that the following conditions are\n"
        "met:\n",
        "bsd",
    ),
    (
        " * Permission is hereby granted, free of charge, to any person\n"
        " * obtaining a copy of this software and associated documentation\n"
        ' * files (the "Software"), to deal in the Software without restriction.\n',
        "mit",
    ),
    (
        "// Licensed under the Apache\n"
        '// License, Version 2.0 (the "License"); you may not use this file except in\n'
        "// compliance with the License.\n",
        "apache",
    ),
    (
        "This program is free software: you can redistribute it and/or modify\n"
        "it under the terms of the GNU General Public License as published by\n"
        "the Free Software Foundation, either version 3 of the License, or\n"
        "(at your option) any later version.\n",
        "gpl",
    ),
    ("This work is released into the public\n# domain.\n", "public-domain"),
    ("The licence of the shop was granted\nby the town last year. Permission to land\nwas asked for twice.\n", None),
    # A blank line ends a paragraph.
    ("Redistribution and use in source and binary forms, with or without\n\nmodification, are permitted provided that\n", None),
]


def test_wrapped_notices(spark, model):
    rows = [(i, f"int main;\n\n{text}\nint x;") for i, (text, _) in enumerate(WRAPPED)]
    rows.append((99, "\n".join(text for text, _ in WRAPPED[:4]) + "\n" + "Released under the MIT License.\n" * 3))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [p.family for p in r.paragraphs if p.family != "unknown"] for r in licences.scan(docs, model).collect()}
    assert [found[i] for i in range(len(WRAPPED))] == [[f] if f else [] for _, f in WRAPPED]
    assert found[99] == ["bsd", "mit", "apache", "gpl", "mit", "mit", "mit"]


BARE = [
    ("Available under CC BY 4.0", "cc-by"),
    ("This Source Code Form is subject to the terms of the Mozilla Public", "mpl"),
    ("free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Use of this source code is governed\nby a BSD-style file.", "bsd"),
    ("The source of the software is a matter of documentation.", None),
]


def test_notices_without_a_cue_are_found(spark, model):
    docs = spark.createDataFrame([(i, f"int main;\n\n{text}\n\nint x;") for i, (text, _) in enumerate(BARE)], "doc_id long, text string")
    found = {r.doc_id: [(p.at, p.family) for p in r.paragraphs] for r in licences.scan(docs, model).collect()}
    assert [found[i] for i in range(len(BARE))] == [[(2, family)] if family else [] for _, family in BARE]


def test_what_is_passed_over_can_be_of_no_family(spark):
    grams = licences._notices(spark)
    words = [*licences.MARKS, *(cue for cue in licences.CUES if " " not in cue)]
    bare = grams.where(~F.exists(F.array(*map(F.lit, words)), lambda w: F.contains("gram", w)))
    left = bare.groupBy("number").agg((F.count(F.lit(1)) / F.max("size")).alias("share"))
    assert left.where(F.col("share") >= licences.MIN_CONTAINED).count() == 0
