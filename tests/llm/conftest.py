import pytest

LONG = " ".join(f"word{i % 977} über{i % 31}." for i in range(6000))
#: Null, empty, blank, ties, repeated rows, odd characters, one very long text.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. The quick brown fox."), (2, "The quick brown fox jumps over the lazy dog. The quick brown fox."), (3, None), (4, ""), (5, "   \n\t "), (6, "don't  STOP… <|endoftext|> 3.14  naïve"),
    (7, LONG), (8, "x"), (None, "a row without a key"), (9, "repeated row"), (9, "repeated row"), (10, "ΑΣΣ Σ 日本語テキスト 🙂"), (11, "<s>[INST]\x1c\x00é́ ½ ①▁▁ a▁b"), (12, LONG + " tail"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with extra columns whose names clash with those that operators use inside."""
    rows = [(k, t, "k!", 7, None, "zz") for k, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, k string, n long, lang string, t string").repartition(3)


@pytest.fixture(scope="session")
def texts():
    return TEXTS
