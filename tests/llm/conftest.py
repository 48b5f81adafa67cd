import pytest

ODD_TEXTS = [
    None,
    "",
    " ",
    "a",
    "two words",
    "tabs\tand\x0bmore\n\n lines  \r\n",
    "É ÀÉ ΑΣ Σ İ ǅ don't 'S ..' x.'s 日本語 。 é",
    "<|endoftext|> between  <|endoftext|>\n and <|startoftext|> <|STARTOFTEXT|>",
    "same text", "same text", "same text",
    "x" * 30_000,
    "word " * 12_000,
    "mail a.b@c-d.example.org or 10.0.0.1 or 4111 1111 1111 1111 or +49 (030) 123-4567 x\n" * 3,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, and extra columns with clashing names."""
    rows = [(i, t, "en", "s", 0, 7, "k", 1) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "a", None, None, None, None, None, None), (None, "no id", "en", None, 1, 1, "k", 1), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, class int, key string, score int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark, root):
    return spark.read.parquet(f"{root}/documents.parquet")
