import pytest

from strata.llm.shipping import ship

LONG = " ".join(f"word{i % 977}x{i}" for i in range(20000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, empty and long texts, ties, repeats and near copies."""
    base = " ".join(f"term{i}" for i in range(80))
    near = base.replace("term40 ", "changed ")
    return [
        (1, base, "en"), (2, base, "en"), (3, near, None), (4, None, "en"), (5, "", None), (6, " \n\t ", "fr"),
        (7, "one two three", "en"), (8, "ONE two\nthree", "en"), (None, base, "en"), (None, None, None), (9, LONG, "de"),
        (9, LONG, "de"), (10, "début " + PASSAGE + " fin", "fr"), (11, "start " + PASSAGE + " other end", "en"),
        (12, "12 + 34 = 46 !!", "en"), (13, "日本語 🙂 text<|endoftext|>x", None),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows as documents, with columns whose names the operators use inside."""
    rows = [(i, t, lang, "src", len(t) if t else None, "x", 1, "y", True) for i, t, lang in odd_rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, digest string, rep long, key string, kept boolean").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
