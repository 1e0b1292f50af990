import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, ties, repeated rows, one long text, and
    extra columns whose names clash with what the operators add."""
    long = "\n".join(f"line {i} of a rather long text, number {i * i}" for i in range(3000))
    rows = [(1, "A short text of some words for this test, and one more."), (2, None), (3, ""), (4, "  \n\t "),
            (5, long), (6, long + " tail"), (7, "A short text of some words for this test, and one more."),
            (7, "A short text of some words for this test, and one more."), (None, "no id"), (8, "x"),
            (9, "Grüße aus Köln – ½ 漢字 😀 \x85 end\x1c ."), (10, "same same same same same same same same same same same"),
            (11, " leading and trailing "), (12, "<|endoftext|> inside <|startoftext|> a text"), (13, "two  spaces\n\nand lines")]
    return spark.createDataFrame([(i, t, "en", "src", 1, True, 0.5, "w", 7) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_words int, kept boolean, "
                                 "score double, words string, file int").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
