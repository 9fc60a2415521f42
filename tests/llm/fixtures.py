"""Small document tables with the awkward cases: nulls, blanks, copies, ties, clashing names."""

from __future__ import annotations

DOCS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=False):
    """Documents of (doc_id, text); `extra` adds columns named like those operators make."""
    full = [(i, t, None, None, None if t is None else len(t)) for i, t in rows]
    docs = spark.createDataFrame(full, DOCS_SCHEMA)
    if extra:
        for name in ("key", "row", "fp", "pos", "fingerprint", "component_id", "keep", "word", "start"):
            docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


def sample(spark, n=120):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(n)


EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r"),
    (4, "one"),
    (5, "one two"),
    (6, "One TWO"),
    (7, "a b c d e f g " * 3000),
    (8, "a b c d e f g " * 3000),
    (9, "Ünï çødé ÀÉ   text with odd spaces 語言 текст"),
    (10, "Ünï çødé àÉ   text with odd spaces 語言 текст"),
    (10, "Ünï çødé àÉ   text with odd spaces 語言 текст"),
    (None, "a row without an id but with a line of some length"),
    (12, "a row without an id but with a line of some length"),
]
