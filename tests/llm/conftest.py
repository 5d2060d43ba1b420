import pytest

LONG = "lorem ipsum dolor " * 4000


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names the operators use inside."""
    rows = [
        (1, "the cat sat on the mat today", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, " \n\t ", "en", "b"), (5, LONG, "en", "b"), (None, "no id here at all", "en", "c"),
        (7, "same words in the same order twice", "en", "a"), (7, "same words in the same order twice", "en", "a"), (8, "same words in the same order twice", "en", "a"), (9, "one", "de", None), (10, "two words", "de", "c"), (11, "Ünïcödé — “quotes” 中文 \U0001f600 x", "fr", "a"),
    ]
    names = "score kept digest base rate copy n_copies part word c sig node text2 found spans piece length".split()
    data = [(*r, len(r[1] or ""), *["z"] * len(names)) for r in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))


@pytest.fixture(scope="session")
def empty(messy):
    return messy.where("false")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def plain(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
