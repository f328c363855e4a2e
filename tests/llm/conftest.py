import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


ODD = [(0, None), (1, ""), (2, "one two three four five six seven eight nine ten"), (3, "one two three four five six seven eight nine ten"),
       (4, "  \n\t "), (5, "x"), (None, "a text without an id, of more than fifty bytes, that nobody else has"), (7, "long " * 30_000),
       (7, "long " * 30_000), (8, "ünïcödé ñ 漢字 🙂   nbsp"), (9, "<|endoftext|> a  b <|startoftext|>")]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties and repeated rows, and columns named like results."""
    rows = [(i, t, "en", "s", 1, "x", 0.0, 1) for i, t in ODD]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, "
              "kept string, score double, _text long")
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
