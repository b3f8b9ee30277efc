"""Rows that every operator over documents must bear."""

from pyspark.sql import functions as F

LAYOUT = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the long road of words and more words " * 20_000
ODD_ROWS = [
    (1, "The plain text of one document, in English words.", "en", "a", 1),
    (1, "The plain text of one document, in English words.", "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n ", "en", None, 0),
    (None, "no id on this row of text", "en", "a", 3),
    (5, "1234 5678 --- !!!", "de", "b", 4),
    (6, LONG, "en", "b", len(LONG)),
    (7, "Ünïcödé straße Ελλάδα 中文 text é́ \x1c \x00   <|endoftext|> don't", "fr", "b", 9),
    (8, "two words", None, "c", 2),
    (-9, "negative id " * 3, "es", "c", 2),
]


def odd_documents(spark):
    """The rows above, with further columns whose names operators use themselves."""
    docs = spark.createDataFrame(ODD_ROWS, LAYOUT)
    names = ("id", "fp", "key", "found", "n", "class", "worker", "score", "spans", "component_id")
    return docs.withColumns({name: F.lit("other") for name in names})


def no_documents(spark):
    return spark.createDataFrame([], LAYOUT)
