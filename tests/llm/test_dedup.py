from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import substring_dedup
from basketlens.llm.components import connected_components
from basketlens.llm.exact_dedup import exact_duplicates
from basketlens.llm.line_dedup import dedup_lines
from basketlens.llm.near_dedup import keep_one_of_each, near_duplicates
from basketlens.llm.substring_dedup import collinear_chains, pieces_of_pair, repeated_passages
from tests.llm import brute
from tests.llm.conftest import sentence


def bare(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


@pytest.mark.parametrize("block, fingerprint", [(4096, F.xxhash64), (64, lambda b: F.xxhash64(b) % 5)])
def test_exact_duplicates(documents, block, fingerprint):
    """With five fingerprints nearly all blocks are twins, so names must come from texts."""
    rows = documents.select("doc_id", "text").collect()
    found = exact_duplicates(documents, block, fingerprint).collect()
    assert len(found) == len(rows)
    groups = {}
    for r in rows:
        groups.setdefault(hashlib.sha256(bare(r.text).encode()).hexdigest(), []).append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
    by_sha = {}
    for r in found:
        best = min(groups[r.text_sha256])
        assert (r.keep_id, r.group_size) == (None if best[1] else best[2], len(groups[r.text_sha256]))
        by_sha[r.text_sha256] = by_sha.get(r.text_sha256, 0) + r.kept
    assert set(by_sha) == set(groups) and set(by_sha.values()) == {1}


def test_dedups_ignore_other_columns_and_take_empty_tables(documents, clashing):
    for operator in (exact_duplicates, near_duplicates, repeated_passages):
        plain, extra = (sorted(map(str, operator(d.where("doc_id > 5 AND doc_id < 53")).collect())) for d in (documents, clashing))
        assert plain == extra
        assert operator(documents.limit(0)).count() == 0
    assert dedup_lines(documents.limit(0)).count() == 0
    assert "key" in dedup_lines(clashing).columns


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(documents, k):
    texts = {r.doc_id: r.text for r in documents.where("doc_id IS NOT NULL").collect()}
    expected = brute.components(texts, k)
    found = {r.doc_id: r for r in near_duplicates(documents, k).collect()}
    assert found[None].component_id is None and found[None].kept
    for i, text in texts.items():
        assert found[i].n_shingles == len(brute.shingles(text, k))
        assert found[i].component_id == expected[i], i
        assert found[i].kept == (expected[i] == i)


def _six(spark):
    a, b, c = (" ".join(sentence(i, 40)) for i in (900, 901, 902))
    rows = [(1, a), (2, b), (3, a), (5, c), (5, b), (7, c)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_texts_of_one_id_all_link_it(spark):
    rows, docs = _six(spark)
    found = near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (2, 2), (3, 1), (5, 2), (5, 2), (7, 2)]
    assert [r.doc_id for r in found if r.kept] in ([1, 2], [2, 1])


def test_each_text_keeps_a_row(spark):
    """Repeated ids, repeated rows and rows without id; columns may have any name."""
    rows, docs = _six(spark)
    kept = keep_one_of_each(docs).collect()
    assert len(kept) == 3 and {r.text for r in kept} == {t for _, t in rows}
    d = " ".join(sentence(903, 40))
    more = spark.createDataFrame([(None, d), (None, d), (None, rows[0][1]), (9, d + " x"), (5, rows[4][1]), (11, ""), (11, ""), (12, None)], docs.schema)
    extra = {name: F.lit(1) for name in ("node", "shared_id", "is_shared", "row", "component", "a.b")}
    kept = keep_one_of_each(docs.unionByName(more).withColumns(extra)).collect()
    assert sorted(str((r.doc_id, r.text)) for r in kept) == sorted(
        map(str, [(1, rows[0][1]), (2, rows[1][1]), (5, rows[3][1]), (9, d + " x"), (11, ""), (12, None)])
    )
    assert kept[0].asDict().keys() == {"doc_id", "text", *extra}
    assert keep_one_of_each(docs.limit(0)).count() == 0


def test_near_copies_of_an_absent_original(spark):
    """Copies at all distances, without their original, so hubs link only a part."""
    rows = []
    for group in range(3):
        random_ = random.Random(group)
        base = [f"g{group}w{i}" for i in range(200)]
        for copy in range(60):
            text = list(base)
            for j in random_.sample(range(200), random_.randrange(1, 26)):
                text[j] = f"e{random_.randrange(40)}"
            rows.append((group * 100 + copy, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute.components(dict(rows), 2)
    assert len(set(expected.values())) > 3
    found = {r.doc_id: r.component_id for r in near_duplicates(docs, 2).collect()}
    wrong = [i for i in expected if found[i] != expected[i]]
    assert not wrong


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 150)]
    found = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(found[i] == 1 for i in range(1, 41))
    assert all(found[100 + i] == 100 for i in range(30)) and found[200] == found[150] == 150


def test_line_dedup(documents):
    rows = {(r.doc_id, r.text): r for r in dedup_lines(documents, min_sites=10).collect()}
    cleaned = {r.doc_id: r for r in rows.values()}
    assert cleaned[60].text.startswith("Shared footer line here\n") and cleaned[60].n_removed == 1
    for i in range(61, 75):
        assert cleaned[i].n_removed == 2 and "footer" not in cleaned[i].text and cleaned[i].n_lines == 3
    assert cleaned[0].text is None and cleaned[0].n_lines == 0
    assert cleaned[2].text == " \n\t " and cleaned[2].n_removed == 0


def test_line_dedup_counts_near_the_threshold_exactly(spark):
    rows = [(i, "common line", f"s{i % 100}") for i in range(300)] + [(1000 + i, "rarer line", f"s{i % 99}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r.text for r in dedup_lines(docs, min_sites=100).collect()}
    assert found[0] == "common line" and all(found[i] == "" for i in range(1, 300))
    assert all(found[1000 + i] == "rarer line" for i in range(300))


def test_repeated_passages(documents):
    found = {}
    for r in repeated_passages(documents).collect():
        found.setdefault(r.doc_id, []).append(r)
    copies = {*range(10, 40), 50, 51, 52}
    assert copies <= set(found)
    passage = found[84]
    # Document 84 begins with one word more than its 70 own ones.
    assert len(passage) == 1 and abs(passage[0].start_word - 71) <= 1 and abs(passage[0].stop_word - 141) <= 1
    assert not set(found) & {0, 1, 2, 3, 4, 80, 81, 82, 83}
    assert set(found) == copies | {84}


def test_chains_rise_and_pay_for_gaps():
    line = [(i, i + 100) for i in range(0, 60, 10)]
    assert collinear_chains(line + [(30, 5)])[0] == line
    assert len(collinear_chains([(0, 0), (500, 500)])) == 2
    crossed = collinear_chains([(0, 50), (10, 60), (50, 0), (60, 10)])
    assert sorted(map(len, crossed)) == [2, 2]


def covered(found):
    out = {}
    for r in found:
        out.setdefault(r.doc_id, set()).update(range(r.start_word, r.stop_word))
    return out


def test_passages_that_repeat_themselves(spark):
    """Lines many times over, and a shared passage twice in one document or in both."""
    own = iter(range(1000, 2000))
    new = lambda n: sentence(next(own), n, 10**6)
    line, shared, both, word = new(9), new(60), new(70), new(1)
    texts = {
        1: new(30) + line * 12 + new(30), 2: new(80) + line * 7 + new(10), 3: line * 6,
        11: new(20) + shared + new(20), 12: shared + new(100) + shared, 13: new(5) + shared + new(30) + shared + new(3) + shared,
        21: both + new(40) + both, 22: new(9) + both + new(30) + both,
        31: word * 400 + new(30), 32: new(15) + word * 900, 33: word * 49,
        41: new(200), 42: line * 2 + new(50),
    }
    texts = {i: " ".join(w) for i, w in texts.items()}
    found = covered(repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect())
    for i, expected in brute.repeated_words(texts, 50).items():
        assert expected <= found.get(i, set()), i
        assert len(found.get(i, set()) - expected) <= 6, i


def test_many_matches_give_way_to_longest_runs():
    """The pieces of two texts that repeat themselves without end stay few and cover both."""
    x, y = np.r_[[7] * 3000, range(100, 200)].astype(np.uint32), np.r_[range(300, 350), [7] * 2500].astype(np.uint32)
    pieces = pieces_of_pair([(np.arange(2993), np.arange(50, 2543))], x, y)
    assert len(pieces) < 20
    assert {i for p in pieces for i in range(p[0], p[1])} == set(range(3000))
    assert {i for p in pieces for i in range(p[2], p[3])} == set(range(50, 2550))


def test_fuzzy_passages_are_found(spark):
    """Of planted passages with a window of 50 words that agree in 0.8, nearly all are found."""
    texts, windows = [], {}
    for size in (60, 100):
        for change in (5, 10, 15, 20):
            for _ in range(60):
                number = len(texts)
                random_ = random.Random(number)
                new = lambda n: [f"v{random_.randrange(10**9)}" for _ in range(n)]
                passage = new(size)
                edited = [new(1)[0] if random_.random() * 100 < change else w for w in passage]
                same = [a == b for a, b in zip(passage, edited)]
                texts += [(number, " ".join(new(40) + passage + new(40))), (number + 1, " ".join(new(30) + edited + new(50)))]
                if any(sum(same[a:b]) >= 0.8 * (b - a) for a in range(size) for b in range(a + 50, size + 1)):
                    windows.setdefault((size, change), []).append(number)
    found = covered(repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect())
    share = {
        key: sum(len(found.get(n, set()) & set(range(40, 40 + key[0]))) >= 50 and n + 1 in found for n in numbers) / len(numbers)
        for key, numbers in windows.items()
    }
    print({key: (round(value, 3), len(windows[key])) for key, value in share.items()})
    assert all(value >= {5: 0.98, 10: 0.96, 15: 0.9, 20: 0.8}[change] for (_, change), value in share.items()), share


def sentences_of_earlier_documents(words: int, change: int, cases: int = 60) -> tuple[list[tuple[int, str]], list[int]]:
    """Pairs of documents that share four sentences, each of which an earlier document holds too."""
    texts, seconds = [], []
    for case in range(cases):
        random_ = random.Random(f"{words} {change} {case}")
        new = lambda n: [f"v{random_.randrange(10**9)}" for _ in range(n)]
        parts = [new(words) for _ in range(4)]
        texts += [" ".join(new(40) + part + new(40)) for part in parts]
        passage = [w for part in parts for w in part]
        edited = [new(1)[0] if random_.random() * 100 < change else w for w in passage]
        texts += [" ".join(new(40) + passage + new(40)), " ".join(new(30) + edited + new(50))]
        # A passage is a window of 50 words or more that agree in 0.8; unrelated words are around.
        same = [False] * 30 + [a == b for a, b in zip(passage, edited)] + [False] * 30
        if any(sum(same[a:b]) >= 0.8 * (b - a) for a in range(len(same)) for b in range(a + 50, len(same) + 1)):
            seconds.append(len(texts) - 1)
    return list(enumerate(texts)), seconds


@pytest.mark.parametrize("words", [12, 15, 19, 25])
def test_passages_of_sentences_that_stand_elsewhere(spark, words):
    for change, least in ((0, 1.0), (10, 0.9)):
        texts, seconds = sentences_of_earlier_documents(words, change)
        found = covered(repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect())
        # Four sentences of 12 words are a passage too: 48 equal words of 50.
        needed = min(50, 4 * words)
        both = [len(found.get(n - 1, set()) & set(range(40, 40 + 4 * words))) >= needed and n in found for n in seconds]
        print(words, change, sum(both) / len(both))
        assert sum(both) >= least * len(both), (words, change, sum(both))


def test_copies_and_texts_of_one_document(spark):
    """Exact copies are compared once; two texts of a document meet where others have one too."""
    own = iter(range(3000, 4000))
    new = lambda n: sentence(next(own), n, 10**6)
    shared = new(60)
    a, b, c, d = (" ".join(w) for w in (new(30) + shared, shared + new(20), new(70), shared[:30] + new(200)))
    rows = [(1, a), (2, a), (3, a), (3, a), (1, b), (5, c), (5, c), (6, c), (7, d), (8, " ".join(shared[:30])), (9, " ".join(shared[:30]))]
    found = sorted(tuple(r) for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == [(1, 0, 60, 60, 2), (1, 0, 90, 90, 2), (2, 0, 90, 90, 1), (3, 0, 90, 90, 1), (5, 0, 70, 70, 6), (6, 0, 70, 70, 5)]


def test_matches_come_once_and_in_order():
    """Places of seeds that stand once or several times in either text, and the seeds behind them."""
    draws = np.random.default_rng(3)
    for most in (2, 4):
        for _ in range(30):
            pairs = [[draws.integers(0, 40, int(draws.integers(1, most))).astype(np.int32) for _ in range(2)] for _ in range(int(draws.integers(0, 30)))]
            gaps = draws.integers(0, 3, len(pairs))
            expected = {(int(p) + g, int(q) + g) for (own, other), gap in zip(pairs, gaps.tolist()) for p in own for q in other for g in {0, gap}}
            own, other = (np.concatenate([np.zeros(0, np.int32), *(pair[side] for pair in pairs)]) for side in (0, 1))
            counts = [np.array([len(pair[side]) for pair in pairs], np.int64) for side in (0, 1)]
            a, b = substring_dedup._matches(own, counts[0], other, counts[1], gaps.astype(np.int64))
            assert list(zip(a.tolist(), b.tolist())) == sorted(expected, key=lambda m: (m[0] - m[1], m[0]))


def test_pieces_are_aligned_together_as_one_by_one():
    """Ends of all runs of a pair are followed at once, to where each alone would be."""
    draws = np.random.default_rng(8)
    widened = 0
    for _ in range(60):
        x = draws.integers(0, 5000, 400).astype(np.uint32)
        y = np.concatenate([draws.integers(0, 5000, int(draws.integers(0, 30))), x[int(draws.integers(0, 40)) :], x[:60]]).astype(np.uint32)
        y[draws.random(len(y)) < draws.choice([0.02, 0.1, 0.2])] = 7
        places = {int(w): np.flatnonzero(y == w) for w in np.unique(x)}
        k = substring_dedup.K
        found = [(a, b) for a in range(len(x) - k + 1) for b in places[int(x[a])].tolist() if np.array_equal(x[a : a + k], y[b : b + k])]
        runs = substring_dedup._equal_runs(*(np.array(c, np.int64) for c in zip(*found)), x, y)
        chains = substring_dedup.chains_of_runs(runs)
        seeds = [[m for a, b, n in chain for m in dict.fromkeys([(a, b), (a + n - k, b + n - k)])] for chain in chains]
        pieces = substring_dedup._first_pieces(chains, x, y)
        assert pieces == [substring_dedup.align_chain(chain, x, y) for chain in seeds]
        movable = substring_dedup._can_widen(pieces, x, y)
        assert [p for p in pieces if p not in movable] == [substring_dedup._widened(p, x, y) for p in pieces if p not in movable]
        widened += len(movable)
    assert widened
