import random

import pytest

from solvind.llm.queries import on_workers

# Names that operators use inside.
CLASHING = ("rep", "n", "part", "key", "value", "size", "copies", "s", "task", "y", "word", "term", "c", "score", "shard")


@pytest.fixture(scope="session")
def rng():
    return random.Random(5)


@pytest.fixture(scope="session")
def prose(rng):
    """Texts of random words."""
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    return lambda words, source=rng: " ".join(source.choice(vocabulary) for _ in range(words))


@pytest.fixture
def documents(spark):
    """A frame of (doc_id, text, source) rows with columns whose names clash with those inside the operators."""
    on_workers(spark)

    def make(rows):
        extra = ", ".join(f"{name} string" for name in CLASHING)
        full = [(*row[:2], row[2] if len(row) > 2 else "src0", "en", 1, *["x"] * len(CLASHING)) for row in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, source string, lang string, n_chars long, {extra}")

    return make


@pytest.fixture
def odd_rows(prose):
    """Null, empty, blank, very long, tied and repeated rows."""
    long = prose(40_000)
    rows = [(1, None, None), (2, "", "a"), (3, " \t\n ", "a"), (4, long, "b"), (5, "ab cd", "a"), (6, "ab cd", None), (7, "AB CD", "b")]
    return rows + [(8, "x" * 200_000, "a"), (9, prose(30), "b"), (9, prose(30), "b"), (10, "é ß 中文 😀", "a"), (10, "é ß 中文 😀", "a"), (11, "one", "c")]
