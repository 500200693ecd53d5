import pytest

from eventrill.llm.common import prepared

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, start bigint, bits string, node int"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang]); the last columns clash with names used inside the operators."""
    prepared(spark)

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None, 7, -1, "x", 3) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3, "doc_id")

    return make


LONG = " ".join(f"w{i % 977} and x{i * 31 % 613}." for i in range(20_000))
ODD = [
    (5, None), (1, ""), (2, " \t\n"), (3, "One two  three\tfour."), (4, "one TWO three four."), (7, "Onetwothreefour."),
    (8, LONG), (9, LONG + " end"), (10, LONG), (11, "é" * 300), (12, "é" * 301), (13, "!!! ### $$$"),
    (14, "\0 control \x1c \x85 signs"), (6, "One two  three\tfour."), (6, "One two  three\tfour."),
]


@pytest.fixture
def odd_docs(make_docs):
    return make_docs(ODD)
