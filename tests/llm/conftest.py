from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(seed: int, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{random.Random(seed * 100003 + i).randrange(vocabulary)}" for i in range(n)]


@pytest.fixture(scope="session")
def documents(spark):
    """Edge cases: null, empty and long texts, copies, near copies, null ids and sources."""
    base = sentence(1, 300)
    rows = []

    def add(doc_id, text, source="a"):
        rows.append((doc_id, text, "en", source, None if text is None else len(text)))

    add(0, None)
    add(1, "")
    add(2, " \n\t ")
    add(3, "One")
    add(4, "one")
    for i in range(30):
        copy = list(base)
        for j in random.Random(i).sample(range(300), i):
            copy[j] = f"edit{i}x{j}"
        add(10 + i, " ".join(copy), source=f"s{i % 12}")
    add(50, " ".join(base), "s1")
    add(51, "  ".join(base).upper(), "s2")
    add(52, "\n".join(base[:100]))
    for i in range(15):
        add(60 + i, f"Shared footer line here\n{' '.join(sentence(200 + i, 40))}\n  Shared footer line here ", f"s{i}")
    add(80, "x" * 200_000)
    add(81, " ".join(["same"] * 5000))
    add(82, " ".join(sentence(9, 30_000)))
    add(83, "Some text. Released under the  MIT license! More text", None)
    add(83, "Some text. Released under the  MIT license! More text", None)
    add(84, "Tail\n" + " ".join(sentence(300, 70) + base[100:170] + sentence(301, 70)))
    add(None, "a row without an id")
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(documents):
    """The same with columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    extra = ("row", "n", "id", "key", "name", "block", "n_tokens", "hash", "score", "text_hash", "place", "labels", "quality", "kept", "n_lines")
    return documents.withColumns({name: F.lit("extra") for name in extra})
