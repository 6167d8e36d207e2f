import random

import pytest

#: Names that operators use themselves, as a user's further columns.
CLASHES = ["row", "h", "h2", "k", "k2", "fp", "size", "src", "counts", "kept", "key", "drop", "n_lines", "copies", "target", "limits", "node"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    names = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 8))) for _ in range(400)]
    return " ".join(draw.choice(names) for _ in range(words))


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang, source]) rows, with columns whose names clash."""

    def docs(rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, None, None)[:4] if len(r) < 4 else r
            full.append((doc_id, text, lang, source, None if text is None else len(text), *CLASHES))
        return spark.createDataFrame(full, SCHEMA)

    return docs


@pytest.fixture(scope="session")
def messy(make):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long_text = prose(1, 30_000)
    rows = [
        (1, prose(2, 60), "en", "a"),
        (1, prose(2, 60), "en", "a"),
        (2, prose(2, 60), "en", "b"),
        (3, None, None, None),
        (4, "", "en", "a"),
        (None, prose(3, 40), None, "a"),
        (None, prose(3, 40), None, "a"),
        (None, None, "en", None),
        (5, " \n\t\n ", "de", "b"),
        (6, long_text, "en", "a"),
        (7, long_text + " more", "en", None),
        (8, "\n".join([prose(4, 30)] * 3), "fr", "c"),
    ]
    return make(rows)


@pytest.fixture(scope="session")
def empty(make):
    return make([]).limit(0)
