from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(rows):
    """Documents from (doc_id, text) pairs, or with language and source as well."""

    def build(*found):
        full = [(*f, *("en", "s")[len(f) - 2 :]) if len(f) < 4 else f for f in found]
        return rows(DOCS, [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in full])

    return build


@pytest.fixture(scope="session")
def awkward(documents):
    """NULLs in every column, empty, short and long texts, ties and repeated rows, clashing columns."""
    from pyspark.sql import functions as F

    words = " ".join(f"word{i}" for i in range(60))
    frame = documents(
        (1, words, "en", "a"),
        (1, words, "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \t\n", "en", "b"),
        (None, words, None, None),
        (None, None, None, None),
        (5, words + " more", "xx", "b"),
        (6, "one two", "en", "b"),
        (7, "x" * 50_000, "en", "b"),
        (8, (words + "\n") * 200, "en", "c"),
    )
    clashing = {c: F.lit("clash") for c in ("mark", "id", "rank", "size", "target", "score", "kept", "spans", "_hash", "batch", "family")}
    return frame.withColumns(clashing)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents()
