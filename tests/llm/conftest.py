import pytest


ODD_DOCS = "doc_id long, text string, label string, score double, n int, rank int"
#: Null and empty texts, a tie of ids, repeated rows, a null id, columns whose names the operators use.
ODD_ROWS = [(1, None, "x", 0.5, 1, 1), (2, "", "x", 0.5, 1, 1), (3, "a b c d e f g", "x", None, 1, 1), (3, "a b c d e f g", "x", None, 1, 1),
            (4, "A b C d e f g", None, 0.1, 2, 2), (5, "  \n\t ", "y", 0.1, 2, 2), (None, "a b c d e f g", "z", 0.1, 3, 3),
            (6, "two words", "z", 0.1, 3, 3), (7, "long " * 20000 + "é日本　x", "z", 0.1, 3, 3), (8, "two words", None, None, None, None)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_DOCS)
