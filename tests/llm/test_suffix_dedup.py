from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from basketlens.llm import suffix_dedup
from basketlens.llm.suffix_dedup import prefixes, remove_repeats


def removed(texts: list[tuple], length: int) -> dict:
    """(spans, kept) of every key, with all strings in one dictionary; texts in their order."""
    seen, out = set(), {}
    for key, text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            string = data[at : at + length]
            if string in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(string)
        spans, at = [], 0
        while (at := gone.find(1, at)) >= 0:
            stop = gone.find(0, at)
            spans.append((at, stop if stop >= 0 else len(data)))
            at = spans[-1][1]
        out[key] = (len(data), spans, bytes(b for b, g in zip(data, gone) if not g))
    return out


def found(df) -> dict:
    return {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()}


@pytest.mark.parametrize("length", [4, 12, 23, 100])
def test_spans_equal_brute_force(spark, length):
    """Texts spliced from each other, from a small alphabet, periodic, short and with wide letters."""
    draw = random.Random(length)
    texts = ["", None, "ab" * 60, "a" * 300, "é" * 90, "x" * (length - 1), "y" * length, "y" * (length + 1)]
    for _ in range(150):
        parts = []
        for _ in range(draw.randrange(1, 7)):
            source = draw.choice(texts) or ""
            at = draw.randrange(len(source) + 1)
            parts.append(source[at : at + draw.randrange(3 * length)])
            parts.append("".join(draw.choice("abcdéü 世") for _ in range(draw.randrange(length))))
        texts.append("".join(parts))
    rows = list(enumerate(texts))
    expected = removed(rows, length)
    docs = spark.createDataFrame(draw.sample(rows, len(rows)), "doc_id long, text string").repartition(5)
    assert found(remove_repeats(docs, length)) == expected
    assert sum(len(spans) for _, spans, _ in expected.values()) > 100


def test_the_common_documents(documents):
    """With slices so short that texts span several; ids that repeat or are null keep their rows."""
    docs = documents.where("doc_id <> 83")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert found(remove_repeats(docs)) == removed(rows, suffix_dedup.LENGTH)


def test_repeated_and_null_ids(spark):
    a, b, c = ("".join(random.Random(i).choices("abcdefgh", k=200)) for i in range(3))
    rows = [(1, a), (1, a), (2, a + b), (None, b + c), (7, c), (7, "z" + c), (7, c)]
    result = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(result) == len(rows)
    kept = {}
    for r in result:
        kept.setdefault(r.doc_id, []).append(bytes(r.kept).decode())
    assert kept[1] == [a, a] and kept[2] == [b]
    # Of the two texts of id 7 one comes first, as their hashes order them; the null id is last.
    assert sorted(kept[7]) in ([c, c, "z"], ["", "", "z" + c]) and kept[None] == [""]


def test_rounds_reach_the_length():
    for length in range(4, 300):
        half, steps, needed = prefixes(length)
        size = 2 * half
        for step in steps:
            assert 0 < step <= size
            size += step
        assert size == length and max(needed) == sum(steps) and 0 in needed


def test_other_columns_and_empty_tables(documents, clashing):
    extra = clashing.withColumns({name: F.lit(1) for name in ("tie", "at", "runs", "seed", "run", "left", "right", "own", "shared", "spans")})
    plain, more = (sorted(map(str, remove_repeats(d.where("doc_id < 55")).collect())) for d in (documents, extra))
    assert plain == more
    assert remove_repeats(documents.limit(0)).count() == 0


def test_the_session_keeps_its_setting(spark, documents):
    before = spark.conf.get(suffix_dedup.CLEANS, None)
    remove_repeats(documents.limit(3)).count()
    assert spark.conf.get(suffix_dedup.CLEANS, None) == before
