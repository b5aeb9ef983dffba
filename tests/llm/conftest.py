import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the and of to in that is was he for it with as his on be at by had not are but from or have an they which one you were her all she there would their".split()


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "er", "ing", "ly", "ness"]) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and clean prose."""
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \n\t ", None, "a", None), (None, prose(3, 80), "en", "a", 1), (5, prose(5, 90), "en", "b", 1), (5, prose(5, 90), "en", "b", 1),
        (7, prose(7, 20_000), "en", "b", 1), (8, "one two", "en", "b", 1), (9, prose(5, 90), "en", "c", 1), (10, "123 456 !!", "en", "c", 1),
        *((20 + k, prose(100 + k, 70 + k), "en", "d", 1) for k in range(12)),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
