import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, h long, spans string, base string, terms string, ids string, n long, sig long"
LONG = "The quick brown fox no %d jumps over a lazy dog while the rain in spain stays mainly in the plain. "


def _row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), 1, 2, "x", "y", "z", "w", 3, 4)


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty, blank and very long texts, ties, fully repeated rows, columns with clashing names."""
    base = "".join(LONG % k for k in range(12))
    near = base.replace("no 7", "no 77")
    return [
        _row(1, None), _row(2, ""), _row(3, " \n\t "), _row(4, "one"), _row(5, "one two"), _row(6, base), _row(6, base), _row(7, near), _row(8, base),
        _row(None, base), _row(None, None, None, None), _row(9, "".join(LONG % k for k in range(3000)), None), _row(10, "a" * 3000), _row(11, "é漢\U0001f600 " * 300, "zz"),
        _row(12, "mail a.b@c.de or 10.0.0.300 and +1 (588) 555-1833, card 4539 1488 0343 6467 " + base, "en"), _row(13, base.upper()),
    ]


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
