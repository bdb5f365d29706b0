import pytest

from tablewright.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """(doc_id, text) rows as a documents table, with a column whose name clashes with the operators' own."""

    def make(rows):
        table = [(i, t, "en", "src", None if t is None else len(t), "clash", "clash") for i, t in rows]
        return spark.createDataFrame(
            table, "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, k string"
        ).repartition(3)

    return make


#: NULL ids and texts, empty and blank texts, repeated rows, texts without letters, a long text, all planes of Unicode.
EDGES = [
    (1, "The cat sat on the mat."), (1, "The cat sat on the mat."), (2, None), (3, ""), (4, " \t\n"), (None, "The cat sat on the mat."),
    (5, "x"), (6, "é漢\U0001f600 İK  a b\r\nc"), (7, "!!! ... ???"), (8, "word " * 3000 + "end"), (9, "a" * 3000), (10, "0"),
]
