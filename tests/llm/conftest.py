import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_text string, key long, held boolean, fp long, size long, place long, cell int, row_number long, score double"
)


def _row(doc_id, text, source):
    return (doc_id, text, None, source, None, "clash", 1, True, 2, 3, 4, 5, 6, 0.5)


EDGE = [
    _row(None, "a text without an id", None),
    _row(10, None, "b"),
    _row(10, None, "b"),
    _row(11, "", "b"),
    _row(12, " \n\t ", None),
    _row(13, "one two three four five six " * 20_000, "a"),
    _row(14, "x", "a"),
    _row(14, "x", "a"),
    _row(15, "İstanbul  ß 漢字  mark \U0001f600 \x0b end\r\n  ", "c"),
    _row(16, "İstanbul  ß 漢字  mark \U0001f600 \x0b end\r\n  ", "c"),
    _row(17, "word", "c"),
    _row(18, "z" * 3000, "c"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
