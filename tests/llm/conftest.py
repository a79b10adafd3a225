from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        """documents from (doc_id, text) rows."""
        return spark.createDataFrame([(i, t, None, None, len(t) if t is not None else None) for i, t in rows], DOCS)

    return make


def words(seed: int, n: int) -> list[str]:
    import random

    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n)]


@pytest.fixture(scope="session")
def prose():
    return lambda seed, n: " ".join(words(seed, n))
