import pytest

#: Texts that every operator on documents has to take.
ODD = [None, "", " \n\t ", "a", "The same row.", "The same row.", "word " * 30_000, "x" * 50_000, "Ünïcödé ẞ ΑΣ ﬁ é \x00 \x1c b\x85c 世界 😀", "<|endoftext|> don't WE'RE 123"]


@pytest.fixture
def odd_docs(spark):
    """Documents with nulls in any column, repeated rows and a column that operators use for themselves."""
    rows = [(i if i != 5 else 4, t, "en" if i % 3 else None, f"src{i % 2}" if i % 4 else None, len(t or ""), "mine") for i, t in enumerate(ODD)]
    names = "doc_id long, text string, lang string, source string, n_chars long, score string"
    return spark.createDataFrame([*rows, (None, "no id", None, None, None, None)], names)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.where("false")
